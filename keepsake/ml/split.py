"""Training rows, the split in time and stratified folds."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.timeline import along
from ..plans.features import MODEL_FEATURES

TARGET = "churned_31d"


def training_set(
    features: DataFrame, columns: Sequence[str] = MODEL_FEATURES, target: str = TARGET
) -> DataFrame:
    """Baked rows with a label; missing values become 0, columns that do not exist are left out."""
    available = [c for c in columns if c in features.columns]
    keys = [c for c in ("company_id", "initiation_rank", "cancel_flow_start_timestamp") if c in features.columns]
    return (
        features.filter((F.col("baked_31d") == 1) & F.col(target).isNotNull())
        .select(*keys, F.col(target).cast("int").alias(target), *available)
        .fillna(0, available)
    )


def _first_reaching(counts: DataFrame, unit: str, wanted: int, before: int = 0):
    """First unit whose running count reaches ``wanted``, and the count before it.

    ``counts`` has a row per day, or per second of one day, so the window stays small.
    """
    so_far = Window.orderBy(unit).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = counts.withColumn("reached", F.sum("n").over(so_far) + before)
    return (
        running.filter(F.col("reached") >= wanted)
        .agg(F.min(F.struct(unit, "reached", "n")).alias("hit"))
        .select("hit.*")
        .first()
    )


def temporal_cutoff(df: DataFrame, ts: str, share: float = 0.8) -> int | None:
    """The second by which ``share`` of the rows, in time order, has happened; None without rows.

    Two small histograms, days and then seconds of one day, instead of a sort of all rows.
    """
    counted = lambda rows, unit: rows.groupBy(unit.alias("u")).agg(F.count(F.lit(1)).alias("n"))
    wanted = int(df.count() * share)
    day = _first_reaching(counted(df, F.to_date(ts)), "u", wanted)
    if day["u"] is None:
        return None
    inside = df.filter(F.to_date(ts) == F.lit(day["u"]))
    second = F.unix_seconds(F.col(ts).cast("timestamp"))
    hit = _first_reaching(counted(inside, second), "u", wanted, day["reached"] - day["n"])
    return hit["u"]


def temporal_split(df: DataFrame, ts: str, share: float = 0.8) -> DataFrame:
    """Adds ``is_validation``: the rows after the cut-off second."""
    cut = temporal_cutoff(df, ts, share)
    if cut is None:
        return df.withColumn("is_validation", F.lit(False))
    return df.withColumn("is_validation", F.unix_seconds(F.col(ts).cast("timestamp")) > F.lit(cut))


def stratified_folds(
    df: DataFrame, label: str, keys: Sequence[str], folds: int = 5, name: str = "fold"
) -> DataFrame:
    """Folds of equal size per label, dealt in the order of a hash of the keys.

    The hash also gives the slots of the ordered numbering, so a label's rows spread over many tasks.
    """
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))
    hashed = df.withColumn("__h", digest)
    slot = F.conv(F.substring("__h", 1, 3), 16, 10).cast("long")
    numbered = along(hashed, [label], ["__h", *keys], slot, rank="__rank")
    return numbered.withColumn(name, F.pmod(F.col("__rank") - 1, F.lit(folds))).drop("__h", "__rank")
