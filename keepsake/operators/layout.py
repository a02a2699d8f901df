"""File layout: compaction and multi-column clustering."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import partition_columns, read_table, rewrite_partitions
from .timeline import along

SAMPLE_ROWS = 20_000
MAX_BITS = 12


def compact(
    spark: SparkSession,
    path: str,
    partition_cols: Sequence[str],
    where: Column | str | None = None,
    target_mb: int = 128,
    fmt: str = "parquet",
) -> int:
    """Rewrite partitions selected by ``where`` (over partition columns) into files of about ``target_mb``.

    Partition columns have the types that the table keeps, or else are text.

    File sizes are read from the files; partitions that need no fewer files stay untouched. The
    partition columns must be all the table has: the stream ingest has its own ``compact_batches``.
    Returns the rows rewritten.
    """
    actual = partition_columns(spark, path)
    if not partition_cols or list(partition_cols) != actual:
        raise ValueError(f"{path} is partitioned by {actual}, not by {list(partition_cols)}")
    df = read_table(spark, path, fmt=fmt)
    if where is not None:
        df = df.filter(where)
    files = df.select(
        *partition_cols, F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_size").alias("__size")
    ).distinct()
    wanted = F.greatest(F.lit(1), F.ceil(F.sum("__size") / F.lit(target_mb * 1024 * 1024))).cast("int")
    loose = (
        files.groupBy(*partition_cols)
        .agg(F.count(F.lit(1)).alias("__files"), wanted.alias("__wanted"))
        .filter("__files > __wanted")
        .drop("__files")
    )
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"l.{c}")) for c in partition_cols]
    picked = df.alias("d").join(loose.alias("l"), same).select("d.*", "__wanted")

    def layout(rows: DataFrame) -> DataFrame:
        part = F.pmod(F.xxhash64(*[c for c in rows.columns if c != "__wanted"]), F.col("__wanted"))
        return rows.withColumn("__part", part).repartition(*partition_cols, "__part").drop("__part", "__wanted")

    return rewrite_partitions(picked, path, partition_cols, fmt, layout)


def cut_points(df: DataFrame, name: str, buckets: int) -> list:
    """At most ``buckets`` - 1 values that split a bounded sample of the column evenly.

    Any ordered type, on its full value; the sample is random and of ``SAMPLE_ROWS`` rows.
    """
    known = df.select(name).filter(F.col(name).isNotNull())
    sample = sorted(r[0] for r in known.orderBy(F.rand(17)).limit(SAMPLE_ROWS).collect())
    return sorted({sample[len(sample) * n // buckets] for n in range(1, buckets)}) if sample else []


def bucket(name: str, cuts: list, kind) -> Column:
    """How many cut points are at or below the value, by halving; NULL sorts first."""
    if not cuts:
        return F.lit(0)
    bounds = F.array(*[F.lit(c).cast(kind) for c in cuts])
    steps = F.array(*[F.lit(1 << b) for b in range(len(cuts).bit_length() - 1, -1, -1)])
    value = F.col(name)
    return F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(F.get(bounds, at + step - 1) <= value, at + step).otherwise(at),
    )


def z_value(df: DataFrame, cols: Sequence[str], files: int) -> Column:
    """Interleaved quantile buckets of the columns: near in all columns means near in the value.

    Each column has as many buckets as there are files (a power of two, at most ``2 ** MAX_BITS``), so
    the curve is as fine as the layout needs.
    """
    bits = min(MAX_BITS, 62 // len(cols), max(1, math.ceil(math.log2(max(2, files)))))
    pieces = []
    for j, name in enumerate(cols):
        place = bucket(name, cut_points(df, name, 1 << bits), df.schema[name].dataType)
        for b in range(bits):
            bit = F.shiftright(place, b).bitwiseAND(F.lit(1)).cast("long")
            pieces.append(F.shiftleft(bit, b * len(cols) + j))
    return reduce(lambda a, b: a.bitwiseOR(b), pieces)


def zorder(df: DataFrame, cols: Sequence[str], files: int) -> DataFrame:
    """Rows range-partitioned and sorted by the interleaved value, so file min/max skip on each."""
    z = df.withColumn("__z", z_value(df, cols, files))
    return z.repartitionByRange(files, "__z", *cols).sortWithinPartitions("__z").drop("__z")


def write_for_lookups(df: DataFrame, path: str, cols: Sequence[str], files: int, distinct: int = 100_000) -> None:
    """Write ``df`` so that lookups by any of ``cols`` read few files, and few pages of those.

    Rows are clustered by the interleaved value, which narrows each file's minimum and maximum; within files every column has
    a Bloom filter for about ``distinct`` values a row group, which tells absent values in ranges that hold them, and page
    indexes, which Parquet writes by itself.
    """
    writer = zorder(df, cols, files).write.mode("overwrite")
    for c in cols:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{c}", str(distinct))
    writer.parquet(path)


def file_ranges(spark: SparkSession, path: str, column: str) -> DataFrame:
    """(file, bytes, rows, least, greatest) of a stored table: what a lookup by ``column`` is skipped by."""
    stored = spark.read.parquet(path)
    return stored.groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(column).alias("least"), F.max(column).alias("greatest")
    )


def lookup_pruning(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One row: files and bytes of the table, and how many of them a lookup of one value reads on average and at most.

    All values of ``column`` are looked up. A value is counted per file by two running sums over file bounds, openings less
    closings, so neither values nor files are paired; the sums run over files and values, not over rows.
    """
    ranges = file_ranges(spark, path, column)
    values = spark.read.parquet(path).select(F.col(column).alias("at")).filter("at IS NOT NULL").distinct()
    marks = (
        ranges.select(F.col("least").alias("at"), F.lit(0).alias("turn"), F.lit(1).alias("files"), F.col("bytes"))
        .unionByName(values.select("at", F.lit(1).alias("turn"), F.lit(0).alias("files"), F.lit(0).cast("long").alias("bytes")))
        .unionByName(ranges.select(F.col("greatest").alias("at"), F.lit(2).alias("turn"), F.lit(-1).alias("files"), (-F.col("bytes")).alias("bytes")))
        .filter("at IS NOT NULL")
    )
    cuts = F.array(*[F.lit(c) for c in cut_points(values, "at", 256)]) if not values.isEmpty() else F.array()
    slot = F.size(F.filter(cuts, lambda c: c <= F.col("at")))
    # A range that opens or closes at a value covers it: openings come first, closings last.
    marks = marks.groupBy("at", "turn").agg(F.sum("files").alias("files"), F.sum("bytes").alias("bytes"))
    swept = along(marks, [], ["at", "turn"], slot, running={"open": F.col("files"), "open_bytes": F.col("bytes")})
    seen = swept.filter("turn = 1").agg(
        F.count(F.lit(1)).alias("lookups"), F.avg("open").alias("files_read"), F.max("open").alias("most_files"),
        F.min("open").alias("least_files"), F.avg("open_bytes").alias("bytes_read"),
    )
    whole = ranges.agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    return whole.withColumn("__one", F.lit(1)).join(seen.withColumn("__one", F.lit(1)), "__one").drop("__one")
