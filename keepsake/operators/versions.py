"""Versions of rows: snapshots as of a point, slowly changing dimensions, schema evolution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .joins import one_per_key


def as_of_snapshot(
    df: DataFrame, keys: Sequence[str], version_col: str, as_of: object
) -> DataFrame:
    """Latest version of each key at or before ``as_of``; an aggregate, combined map-side."""
    rest = [c for c in df.columns if c not in (*keys, version_col)]
    latest = F.max(F.struct(version_col, *rest)).alias("__v")
    picked = df.filter(F.col(version_col) <= F.lit(as_of)).groupBy(*keys).agg(latest)
    return picked.select(*[F.col(c) if c in keys else F.col(f"__v.{c}") for c in df.columns])


def evolve(
    df: DataFrame, target: StructType, defaults: dict[str, object] | None = None
) -> DataFrame:
    """``df`` in the shape of ``target`` plus its own new columns; missing ones get a default."""
    defaults = defaults or {}
    known = [
        (F.col(f.name) if f.name in df.columns else F.lit(defaults.get(f.name)))
        .cast(f.dataType)
        .alias(f.name)
        for f in target.fields
    ]
    return df.select(*known, *[c for c in df.columns if c not in target.fieldNames()])


def append_evolved(old: DataFrame, new: DataFrame, defaults: dict[str, object] | None = None) -> DataFrame:
    """Both tables under their joint schema; old rows get the defaults of new columns."""
    both = evolve(old, new.schema, defaults).unionByName(
        evolve(new, old.schema, defaults), allowMissingColumns=True
    )
    order = [*old.columns, *[c for c in new.columns if c not in old.columns]]
    return both.select(*order)


def _fingerprint(tracked: Sequence[str]) -> Column:
    return F.struct(*tracked)


def scd2(
    snapshots: DataFrame, keys: Sequence[str], tracked: Sequence[str], effective: str
) -> DataFrame:
    """Type-2 history from dated snapshots: a row per change with ``valid_from`` and ``valid_to``.

    Snapshots are first reduced to one row per key and date, so a window holds at most one row per
    date of a key.
    """
    daily = one_per_key(snapshots.select(*keys, *tracked, effective), [*keys, effective])
    timeline = Window.partitionBy(*keys).orderBy(effective)
    changed = daily.withColumn("__was", F.lag(_fingerprint(tracked)).over(timeline)).filter(
        F.col("__was").isNull() | ~F.col("__was").eqNullSafe(_fingerprint(tracked))
    )
    return changed.select(
        *keys,
        *tracked,
        F.col(effective).alias("valid_from"),
        F.lead(effective).over(timeline).alias("valid_to"),
    ).withColumn("is_current", F.col("valid_to").isNull())


def scd2_apply(
    history: DataFrame,
    snapshot: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    effective: object,
) -> DataFrame:
    """History after one more snapshot: changed rows are closed and reopened, new keys are added."""
    day = F.lit(effective).cast(history.schema["valid_from"].dataType)
    incoming = snapshot.select(*keys, F.struct(*tracked).alias("__new"))
    closed = history.filter(~F.col("is_current"))
    joined = history.filter("is_current").join(incoming, list(keys), "full")
    is_new = F.col("valid_from").isNull()
    changes = F.col("__new").isNotNull() & ~F.col("__new").eqNullSafe(_fingerprint(tracked))
    kept = joined.filter(~is_new).withColumn("__changed", F.coalesce(changes, F.lit(False)))
    old = kept.select(
        *keys,
        *tracked,
        "valid_from",
        F.when(F.col("__changed"), day).alias("valid_to"),
        (~F.col("__changed")).alias("is_current"),
    )
    opened = joined.filter(is_new | changes).select(
        *keys,
        *[F.col(f"__new.{c}").alias(c) for c in tracked],
        day.alias("valid_from"),
        F.lit(None).cast(history.schema["valid_to"].dataType).alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    return closed.select(*old.columns).unionByName(old).unionByName(opened)
