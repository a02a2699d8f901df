"""Intermediate tables in the shared folder of the cluster.

A staged table cuts the lineage of an expensive intermediate that several branches read, and it
outlives lost executors, which block storage does not.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


_SCRATCH: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a scratch folder only in local mode."""
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _SCRATCH:
        _SCRATCH[application] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _SCRATCH[application]


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and read it back: columnar, prunable, with known size."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged.staged_path = path
    return staged


def discard(*frames: DataFrame) -> None:
    """Remove the files of staged frames that nothing reads any more."""
    for df in frames:
        drop_path(df.sparkSession, df.staged_path)


def stage_bucketed(
    df: DataFrame, buckets: int, *keys: str, label: str = "stage", gather: bool = False
) -> DataFrame:
    """``stage`` in buckets by ``keys``: joins and groups by them read it without a shuffle.

    Choose keys that no single value of holds a large part of the rows, as buckets are not split. With ``gather``
    rows are shuffled to their bucket first, for one file a bucket. Buckets are known to Spark through a catalog
    table, which is gone again when this returns; the frame holds the files and their buckets.
    """
    spark, name = df.sparkSession, f"staged_{uuid.uuid4().hex}"
    path = fresh_path(spark, label)
    rows = df.repartition(buckets, *keys) if gather else df
    rows.write.bucketBy(buckets, *keys).option("path", path).format("parquet").saveAsTable(name)
    staged = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    staged.staged_path = path
    return staged


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library made in the shared folder."""
    if not path.startswith(f"{shared_dir(spark)}/"):
        raise ValueError(f"{path} is not in the shared folder")
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)
