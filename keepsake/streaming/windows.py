"""Event-time operators on streams. All of them drop rows that arrive behind the watermark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_late_duplicates(
    stream: DataFrame, keys: Sequence[str], ts: str, lateness: str = "5 minutes"
) -> DataFrame:
    """First arrival per key within the watermark; later rows than that are dropped as late."""
    return stream.withWatermark(ts, lateness).dropDuplicatesWithinWatermark(list(keys))


def tumbling_counts(
    stream: DataFrame, ts: str, by: Sequence[str], width: str = "1 hour", lateness: str = "5 minutes"
) -> DataFrame:
    """Rows per window and group; append mode emits a window once the watermark has passed it."""
    return (
        stream.withWatermark(ts, lateness)
        .groupBy(F.window(ts, width), *by)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *by, "n"
        )
    )


def sessionize(
    stream: DataFrame, key: str, ts: str, gap: str = "30 minutes", lateness: str = "5 minutes"
) -> DataFrame:
    """Sessions per key: a pause of ``gap`` closes one."""
    merged = (
        stream.withWatermark(ts, lateness)
        .groupBy(key, F.session_window(ts, gap).alias("w"))
        .agg(F.count(F.lit(1)).alias("events"), F.min(ts).alias("first_at"), F.max(ts).alias("last_at"))
    )
    seconds = (F.unix_micros("last_at") - F.unix_micros("first_at")) / 1e6
    return merged.select(
        key, "events", "first_at", "last_at", F.round(seconds, 6).alias("duration_s")
    )


def matched_within(
    starts: DataFrame,
    events: DataFrame,
    key: str,
    start: str,
    at: str,
    seconds: int = 3600,
    lateness: str = "5 minutes",
) -> DataFrame:
    """Stream-stream left join: events of the key in ``[start, start + seconds)`` per start.

    Both sides also join on a time bucket as long as the horizon, an event being offered to its own
    bucket and the one before, so that state and work of a busy key spread over many tasks. A
    start without any event is emitted once the watermark has passed its horizon.
    """
    left = starts.withWatermark(start, lateness).withColumn(
        "__bucket", F.floor(F.unix_seconds(start) / seconds)
    )
    own = F.floor(F.unix_seconds(at) / seconds)
    right = events.withWatermark(at, lateness).select(
        F.col(key).alias("__key"), at, F.explode(F.array(own - 1, own)).alias("__b")
    )
    condition = (
        (F.col(key) == F.col("__key"))
        & (F.col("__bucket") == F.col("__b"))
        & (F.col(at) >= F.col(start))
        & (F.col(at) < F.col(start) + F.expr(f"INTERVAL {seconds} SECONDS"))
    )
    return left.join(right, condition, "left_outer").select(*starts.columns, at)
