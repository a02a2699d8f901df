"""Group-wise collapsing and flag pivots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def collapse(
    df: DataFrame, keys: Sequence[str], attributes: Sequence[str], **extra: Column
) -> DataFrame:
    """One row per key with the greatest value of each attribute."""
    return df.groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in attributes], *[F.max(e).alias(n) for n, e in extra.items()]
    )


def flag_pivot(
    df: DataFrame,
    keys: Sequence[str],
    kind: str,
    kinds: dict[str, str],
    measures: dict[str, str],
    **totals: Column,
) -> DataFrame:
    """Greatest value of each measure per kind, as columns, in one aggregation.

    ``kinds`` maps a short name to the value of ``kind``; ``measures`` maps a column-name pattern
    with ``{}`` for the short name to the measured column.
    """
    cells = [
        F.max(F.when(F.col(kind) == value, F.coalesce(F.col(m), F.lit(0))).otherwise(0)).alias(
            pattern.format(short)
        )
        for pattern, m in measures.items()
        for short, value in kinds.items()
    ]
    return df.groupBy(*keys).agg(*cells, *[e.alias(n) for n, e in totals.items()])
