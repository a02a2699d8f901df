"""Joins for dimensions, salted joins and day-window lookups."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

SALT = "__salt"


def heavy_keys(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """Keys with more than ``rows`` rows: at most ``total / rows`` of them, so safe to broadcast."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    return counted.filter(F.col("__rows") > rows).select(*keys)


def salted_join(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    salts: int = 16,
    heavy_rows: int = 1_000_000,
) -> DataFrame:
    """Equi-join that splits each heavy key of ``big`` over ``salts`` tasks.

    Keys with more than ``heavy_rows`` rows get a salt and only their rows in ``small`` are
    repeated; with ``heavy_rows=0`` every key is salted and nothing is counted. The salt is a hash
    of the row, so that a recomputed task places it the same way; remove exact copies of rows
    beforehand. ``how`` is any join that keeps only or all rows of ``big``.
    """
    if how not in {"inner", "left", "left_semi", "left_anti"}:
        raise ValueError(f"a salted join cannot be {how!r}: rows of the small side are repeated")
    spread = F.pmod(F.xxhash64(*big.columns), F.lit(salts).cast("long"))
    every = F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))
    if heavy_rows:
        heavy = F.broadcast(heavy_keys(big, keys, heavy_rows).withColumn("__heavy", F.lit(True)))
        big, small = big.join(heavy, list(keys), "left"), small.join(heavy, list(keys), "left")
        # Rows without a key match nothing, but they too may be many.
        keyless = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        spread = F.when(F.col("__heavy") | keyless, spread).otherwise(F.lit(0).cast("long"))
        every = F.when(F.col("__heavy"), every).otherwise(F.array(F.lit(0).cast("long")))
    salted = big.withColumn(SALT, spread).drop("__heavy")
    repeated = small.withColumn(SALT, F.explode(every)).drop("__heavy")
    return salted.join(repeated, [*keys, SALT], how).drop(SALT)


def dimension_join(
    fact: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    heavy_rows: int | None = None,
    salts: int = 16,
) -> DataFrame:
    """Equi-join with a dimension, without a hint: sizes are known only when the sides have run.

    Adaptive execution broadcasts a side whose measured size is below the session's threshold and
    splits the partitions that measure as skewed. Give ``heavy_rows`` to salt the keys with more rows
    beforehand, where adaptive execution is off.
    """
    if heavy_rows is not None:
        return salted_join(fact, dim, keys, how, salts, heavy_rows)
    return fact.join(dim, list(keys), how)


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = ()) -> DataFrame:
    """First row of each key by ``order``, then by all other columns.

    The planner limits each key to its first row before the shuffle, so a group of copies shrinks
    on the side where it is read.
    """
    lead = [F.col(c) if isinstance(c, str) else c for c in order]
    rest = [F.col(c) for c in df.columns if c not in keys]
    if not lead and not rest:
        return df.dropDuplicates(list(keys))
    ranked = Window.partitionBy(*keys).orderBy(*lead, *rest)
    return df.withColumn("__row", F.row_number().over(ranked)).filter("__row = 1").drop("__row")


def day_span(stored: DataFrame, day: Column | str) -> tuple[dt.date, dt.date] | None:
    """First and last day of a stored table, one column of which is read; None without days."""
    first, last = stored.agg(F.min(day), F.max(day)).first()
    return None if first is None else (first, last)


def flags_on_days(
    df: DataFrame,
    keys: Sequence[str],
    day: str,
    facts: DataFrame,
    fact_day: str,
    days: int,
    measures: dict[str, Column],
    span: tuple[dt.date, dt.date] | None = None,
) -> DataFrame:
    """Aggregates of the facts dated ``[day, day + days]`` for every row, NULL without any.

    ``span`` is the first and last ``day`` of all rows (``day_span``), where the caller knows it: facts outside of what
    they can see are left out by a literal range, which prunes their scan.

    The facts are reduced to one row per key and day, each is then offered to the ``days + 1`` days
    that can see it, and the join is an equality on (key, day): no range join, no pairs. The
    measures must be idempotent under regrouping (min, max). Facts of keys that no row has are left
    out first. What is looked up is merged, never gathered in the driver for a broadcast.
    """
    if span:
        facts = facts.filter(F.col(fact_day).between(F.lit(span[0]), F.lit(span[1] + dt.timedelta(days=days))))
    facts = facts.join(df.select(*keys).distinct(), list(keys), "left_semi")
    combine = {n: (F.min if n.startswith("first_") else F.max) for n in measures}
    daily = facts.groupBy(*keys, F.col(fact_day).alias("__d")).agg(
        *[combine[n](e).alias(n) for n, e in measures.items()]
    )
    seen_from = daily.withColumn(
        "__day", F.explode(F.sequence(F.date_sub("__d", days), F.col("__d")))
    )
    per_day = seen_from.groupBy(*keys, "__day").agg(*[combine[n](n).alias(n) for n in measures])
    return (
        df.withColumn("__day", F.col(day)).join(per_day.hint("merge"), [*keys, "__day"], "left").drop("__day")
    )


def exists_after(
    df: DataFrame,
    keys: Sequence[str],
    day: str,
    snapshots: DataFrame,
    snapshot_day: str,
    offsets: dict[str, int],
    days_of: DataFrame | None = None,
) -> DataFrame:
    """0/1 per offset: does a snapshot of the key exist exactly that many days after ``day``?

    ``days_of`` is a stored table that has all days of ``df`` in the same column; without it the first and last
    day are found by running ``df`` once more. One pass over the snapshots for all offsets. The wanted (key, day) pairs are few and distinct,
    so they, not the rows, meet the snapshot table; repeated snapshots fall together in the
    aggregate that follows. Snapshots are sorted and merged, never broadcast: the planner takes a compressed or
    exploded table for a small one, and would gather all its days in the driver.
    """
    pairs = df.select(*keys, F.col(day).alias("__from")).filter("__from IS NOT NULL").distinct()
    wanted = pairs.select(
        "*",
        F.explode(F.array(*[F.struct(F.lit(n).alias("n"), F.date_add("__from", d).alias("on"))
                            for n, d in offsets.items()])).alias("__p"),
    ).select(*keys, "__from", "__p.n", F.col("__p.on").alias("__on"))
    # The bare column is compared with the literal range of wanted days, so partitions are pruned.
    span, ahead = day_span(df if days_of is None else days_of, day), list(offsets.values())
    range_ = [None, None]
    if span:
        range_ = [span[0] + dt.timedelta(days=min(ahead)), span[1] + dt.timedelta(days=max(ahead))]
    if isinstance(snapshots.schema[snapshot_day].dataType, StringType):
        range_ = [None if d is None else d.isoformat() for d in range_]
    snapshots = snapshots.filter(F.col(snapshot_day).between(F.lit(range_[0]), F.lit(range_[1])))
    present = snapshots.select(*keys, F.col(snapshot_day).try_cast("date").alias("__on"))
    found = (
        wanted.join(present.hint("merge"), [*keys, "__on"])
        .groupBy(*keys, "__from")
        .agg(*[F.max(F.when(F.col("n") == n, 1)).alias(n) for n in offsets])
    )
    joined = df.withColumn("__from", F.col(day)).join(found.hint("merge"), [*keys, "__from"], "left")
    kept = [c for c in df.columns if c not in offsets]
    return joined.select(*kept, *[F.coalesce(n, F.lit(0)).alias(n) for n in offsets])


def left_with_defaults(
    left: DataFrame, right: DataFrame, keys: Sequence[str], defaults: dict[str, object]
) -> DataFrame:
    """Left join of tables by the same key, which are merged; missing right-hand values get a default."""
    joined = left.join(right.hint("merge"), list(keys), "left")
    return joined.fillna(defaults) if defaults else joined
