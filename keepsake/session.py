"""Session defaults. Every value can be overridden by the caller or by spark-submit."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Shuffle width per kind of job; AQE coalesces downwards from here.
SHUFFLE_PARTITIONS = {
    "local": 8,
    "small": 200,
    "medium": 1000,
    "large": 4000,
    "huge": 20000,
}

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Merge session windows map-side, so that one busy key is combined before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def get_session(
    app_name: str = "keepsake",
    profile: str = "local",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the defaults above; ``profile`` picks the shuffle width."""
    if profile not in SHUFFLE_PARTITIONS:
        raise ValueError(f"unknown profile {profile!r}; one of {sorted(SHUFFLE_PARTITIONS)}")
    settings = {
        **DEFAULTS,
        "spark.sql.shuffle.partitions": str(SHUFFLE_PARTITIONS[profile]),
        **(conf or {}),
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
