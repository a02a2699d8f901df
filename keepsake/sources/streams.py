"""Stream sources and sinks by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def source_options(kind: str, cfg: dict) -> tuple[str, dict[str, str], str]:
    """Reader format, options and payload column of a broker source."""
    if kind == "kafka":
        options = {
            "kafka.bootstrap.servers": cfg["bootstrap_servers"],
            "subscribe": cfg["topic"],
            "startingOffsets": cfg.get("starting_offsets", "latest"),
            "maxOffsetsPerTrigger": str(cfg.get("max_offsets", 100_000)),
        }
        return "kafka", options, "value"
    if kind == "kinesis":
        options = {
            "streamName": cfg["stream_name"],
            "region": cfg.get("region", "us-east-1"),
            "initialPosition": cfg.get("initial_position", "LATEST"),
            "roleArn": cfg.get("role_arn", ""),
        }
        return "kinesis", options, "data"
    raise ValueError(f"unsupported stream source: {kind!r}")


def stream_source(spark: SparkSession, kind: str, cfg: dict) -> DataFrame:
    """Streaming frame with one ``raw_json`` column.

    ``files`` reads text files with one JSON document per line and needs no broker; the broker
    sources need their connector on the class path.
    """
    if kind == "files":
        reader = spark.readStream.format("text")
        if "max_files" in cfg:
            reader = reader.option("maxFilesPerTrigger", cfg["max_files"])
        return reader.load(cfg["path"]).select(F.col("value").alias("raw_json"))
    fmt, options, payload = source_options(kind, cfg)
    loaded = spark.readStream.format(fmt).options(**options).load()
    return loaded.select(F.col(payload).cast("string").alias("raw_json"))


def stream_sink(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_cols: tuple[str, ...] = (),
    fmt: str = "parquet",
    trigger: dict | None = None,
) -> DataStreamWriter:
    """Append writer with its own checkpoint; the caller starts it."""
    writer = (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
    )
    return writer.partitionBy(*partition_cols) if partition_cols else writer
