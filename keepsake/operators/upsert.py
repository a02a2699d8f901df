"""MERGE for plain partitioned files: one writer at a time, repeatable after a failure.

Plain files have no atomic swap; see ``sources.tables.rewrite_partitions`` for what a lost driver leaves.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import stage
from ..sources.tables import read_table, rewrite_partitions, table_exists, write_partitions


def incremental_window(
    df: DataFrame,
    date_col: str,
    as_of: object,
    start: object = None,
    end: object = None,
    days: int = 7,
) -> DataFrame:
    """Rows of the last ``days`` days before ``as_of``, or of an explicit window."""
    last = F.to_date(F.lit(as_of if end is None else end))
    first = F.date_sub(F.to_date(F.lit(as_of)), days) if start is None else F.to_date(F.lit(start))
    return df.filter(F.col(date_col).between(first, last))


def in_partitions_of(df: DataFrame, like: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Rows of ``df`` in the partitions that occur in ``like``.

    The distinct values of each partition column, as few as the table has folders, become a literal
    filter, which prunes the scan for certain; the semi join then keeps the exact combinations.
    """
    touched = like.select(*partition_cols).distinct()
    per_column = touched.agg(*[F.collect_set(c).alias(c) for c in partition_cols]).first()
    for c in partition_cols:
        values = F.col(c).isin(*per_column[c]) if per_column[c] else F.lit(False)
        df = df.filter(values | F.col(c).isNull())
    same = [F.col(f"o.{c}").eqNullSafe(F.col(f"p.{c}")) for c in partition_cols]
    return df.alias("o").join(touched.alias("p"), same, "left_semi")


def _refuse(found: DataFrame, message: str) -> None:
    if not found.isEmpty():
        raise ValueError(message)


def merged_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    insert_only: bool = False,
) -> DataFrame:
    """Target rows updated by key, plus the source rows that are new."""
    updated = set() if insert_only else set(source.columns if update_cols is None else update_cols)
    t = target.select(F.struct(*target.columns).alias("t"), *[F.col(k).alias(f"__t_{k}") for k in keys])
    s = source.select(F.struct(*source.columns).alias("s"), *[F.col(k).alias(f"__s_{k}") for k in keys])
    joined = t.join(s, [F.col(f"__t_{k}") == F.col(f"__s_{k}") for k in keys], "full")

    def pick(name: str):
        old = F.col(f"t.{name}")
        if name not in source.columns:
            return old.alias(name)
        new = F.col(f"s.{name}").cast(target.schema[name].dataType)
        inserted = F.when(F.col("t").isNull(), new)
        if name in updated:
            return inserted.when(F.col("s").isNotNull(), new).otherwise(old).alias(name)
        return inserted.otherwise(old).alias(name)

    return joined.select(*[pick(c) for c in target.columns])


def merge_upsert(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    partition_cols: Sequence[str],
    update_cols: Sequence[str] | None = None,
    insert_only: bool = False,
    fmt: str = "parquet",
) -> int:
    """Update matching rows and insert new ones; only the partitions of ``source`` are rewritten.

    Source keys must be unique and not NULL (a NULL key matches nothing, so it would be inserted
    again by every merge), and a key must stay in its partition. All are checked, the last one only
    where the partition is not part of the key, and so are the types of partition columns. The source is
    staged, so its plan runs once. Returns the rows written.
    """
    source = stage(source, "source")
    unkeyed = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    _refuse(source.filter(unkeyed), f"a source row lacks a key of {list(keys)}")
    doubled = source.groupBy(*keys).count().filter(F.col("count") > 1)
    _refuse(doubled, f"several source rows share one key {list(keys)}")
    if not table_exists(spark, path):
        return write_partitions(source, path, partition_cols, fmt)
    # Partition values are compared and written as they are stored, not as their folders' names look.
    target = read_table(spark, path, source.schema, fmt)
    if not set(partition_cols) <= set(keys):
        homes = lambda df, tag: df.select(
            *keys, F.struct(*[F.col(c) for c in partition_cols]).alias(f"__{tag}")
        )
        both = homes(target, "old").join(homes(source, "new"), list(keys))
        _refuse(both.filter("__old <> __new"), "a key would move to another partition")
    affected = in_partitions_of(target, source, partition_cols)
    merged = merged_rows(affected, source, keys, update_cols, insert_only)
    return rewrite_partitions(merged, path, partition_cols, fmt)
