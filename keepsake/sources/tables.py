"""Batch reads and writes of partitioned tables.

A written table keeps its schema beside its files. Readers take the types of partition columns from there or from
the caller, never from folder names, which say that ``01`` is the number 1.
"""

from __future__ import annotations

import calendar
import datetime as dt
import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .staging import drop_path, fresh_path

#: In a table's folder; Spark passes over names that begin so.
SCHEMA_FILE = "_table_schema.json"
FILE_FORMATS = ("parquet", "orc", "json", "csv")


def _location(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark._jsc.hadoopConfiguration())


def kept_schema(spark: SparkSession, path: str) -> StructType | None:
    """The schema that the last writer kept, if one did."""
    location, files = _location(spark, f"{path}/{SCHEMA_FILE}")
    if not files.exists(location):
        return None
    stream = files.open(location)
    try:
        return StructType.fromJson(json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def keep_schema(spark: SparkSession, path: str, schema: StructType) -> None:
    location, files = _location(spark, f"{path}/{SCHEMA_FILE}")
    stream = files.create(location, True)
    try:
        stream.writeBytes(json.dumps(schema.jsonValue()))
    finally:
        stream.close()


def with_new_fields(old: StructType, new: StructType) -> StructType:
    """``old`` and the fields that only ``new`` has."""
    return StructType([*old.fields, *[f for f in new.fields if f.name not in old.fieldNames()]])


# What Parquet files of the first type can be read as.
WIDER = {
    "tinyint": ("smallint", "int", "bigint", "double"),
    "smallint": ("int", "bigint", "double"),
    "int": ("bigint", "double"),
    "float": ("double",),
    "date": ("timestamp_ntz",),
}


def widened(old: StructType, new: StructType) -> StructType:
    """One schema for files of both: fields of either, each of the wider type; others are refused."""
    fields = []
    for f in with_new_fields(old, new).fields:
        if f.name in old.fieldNames() and f.name in new.fieldNames():
            a, b = old[f.name].dataType, new[f.name].dataType
            names = a.simpleString(), b.simpleString()
            if a != b and names[0] not in WIDER.get(names[1], ()) and names[1] not in WIDER.get(names[0], ()):
                raise ValueError(f"{f.name} is {names[0]} in old files and {names[1]} in new ones")
            f = StructField(f.name, b if names[1] in WIDER.get(names[0], ()) else a)
        fields.append(StructField(f.name, f.dataType))
    return StructType(fields)


def append_merged(df: DataFrame, path: str) -> StructType:
    """Append a generation of rows to a table without partitions whose columns may differ from those before.

    The kept schema grows by new columns and widens types where that loses nothing; files stay as they are, and
    ``read_table`` reads all generations under that one schema, absent columns being NULL.
    """
    kept = kept_schema(df.sparkSession, path) or df.schema
    schema = widened(kept, df.schema)
    df.write.mode("append").parquet(path)
    keep_schema(df.sparkSession, path, schema)
    return schema


def _refuse_other_types(path: str, kept: StructType, given: StructType, names: Sequence[str]) -> None:
    for c in names:
        if c in kept.fieldNames() and kept[c].dataType != given[c].dataType:
            have, want = kept[c].dataType.simpleString(), given[c].dataType.simpleString()
            raise ValueError(f"partition column {c} of {path} is {have}, not {want}")


def table_schema(spark: SparkSession, path: str, given: StructType | None = None, fmt: str = "parquet") -> StructType:
    """Schema of a table: the kept one, else that of a file and its partition columns as text.

    ``given`` types partition columns of tables that keep no schema; where one is kept both must agree.
    """
    names, kept = partition_columns(spark, path), kept_schema(spark, path)
    stated = [c for c in names if given is not None and c in given.fieldNames()]
    if kept is not None:
        _refuse_other_types(path, kept, given, stated)
        return kept
    # A leaf folder by itself has no partition columns, whatever its name.
    leaf, files = _location(spark, path)
    for _ in names:
        leaf = next(f.getPath() for f in files.listStatus(leaf) if f.isDirectory() and "=" in f.getPath().getName())
    schema = spark.read.format(fmt).load(leaf.toString()).schema
    for c in names:
        schema = schema.add(c, given[c].dataType if c in stated else StringType())
    return schema


def read_table(
    spark: SparkSession, path: str, given: StructType | None = None, fmt: str = "parquet"
) -> DataFrame:
    """A table with its partition values as they were written; see ``table_schema``.

    A folder name that does not cast to its column's type is an error, not a NULL.
    """
    if fmt not in FILE_FORMATS or not partition_columns(spark, path) and kept_schema(spark, path) is None:
        return spark.read.format(fmt).load(path)
    schema = table_schema(spark, path, given, fmt)
    return spark.read.format(fmt).schema(schema).load(path).select(*[f"`{c}`" for c in schema.fieldNames()])


def scan(
    spark: SparkSession,
    path: str,
    date_col: str | None = None,
    start: object = None,
    end: object = None,
    columns: Sequence[str] | None = None,
    fmt: str = "parquet",
    schema: StructType | None = None,
) -> DataFrame:
    """Rows with ``date_col`` in ``[start, end]``.

    The bare column is compared, so the filter prunes partitions or reaches the reader; ``columns``
    narrows the read schema.
    """
    df = spark.read.format(fmt).schema(schema).load(path) if schema else read_table(spark, path, fmt=fmt)
    if date_col and start is not None:
        df = df.filter(F.col(date_col) >= F.lit(start))
    if date_col and end is not None:
        df = df.filter(F.col(date_col) <= F.lit(end))
    return df.select(*columns) if columns else df


def load(
    spark: SparkSession, path: str | None = None, table: str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """The path when given, else the catalog table."""
    if path:
        return read_table(spark, path, fmt=fmt)
    if table:
        return spark.table(table)
    raise ValueError("give a path or a catalog table")


def read_version(
    spark: SparkSession,
    path: str,
    version: int | None = None,
    timestamp: str | None = None,
    fmt: str = "delta",
) -> DataFrame:
    """Time travel for formats that keep versions; see ``as_of_snapshot`` for plain files."""
    if fmt == "parquet":
        raise ValueError("Parquet keeps no versions: use operators.versions.as_of_snapshot")
    option = ("versionAsOf", version) if version is not None else ("timestampAsOf", timestamp)
    return spark.read.format(fmt).option(*option).load(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Does ``path`` hold a table? Leftovers of an aborted write (``_temporary``, hidden folders) are none."""
    location, files = _location(spark, path)
    if not files.exists(location):
        return False
    return any(not f.getPath().getName().startswith(("_", ".")) for f in files.listStatus(location))


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Names of the partition folders below ``path``, from one branch of the folder tree."""
    location, files = _location(spark, path)
    names: list[str] = []
    while True:
        folders = [f.getPath() for f in files.listStatus(location) if f.isDirectory()]
        below = next((f for f in folders if "=" in f.getName() and not f.getName().startswith(("_", "."))), None)
        if below is None:
            return names
        names.append(below.getName().partition("=")[0])
        location = below


def _write(
    df: DataFrame, path: str, partition_cols: Sequence[str], fmt: str, how: str, rebalance: bool = True
) -> int:
    """Write once and take the row count from the write itself, not from a second run."""
    spark, kept, foreign = df.sparkSession, None, False
    schema = StructType([f for f in df.schema if f.name not in partition_cols]
                        + [df.schema[c] for c in partition_cols])
    if fmt in FILE_FORMATS and how == "dynamic" and table_exists(spark, path):
        kept = kept_schema(spark, path)
        foreign = kept is None  # of a table written elsewhere the types are only assumed
        if kept is not None:
            _refuse_other_types(path, kept, schema, partition_cols)
    seen = Observation()
    # Rebalancing gathers a partition's rows into few files and still splits a big partition.
    laid_out = df.hint("rebalance", *partition_cols) if partition_cols and rebalance else df
    counted = laid_out.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", how)
    (writer.partitionBy(*partition_cols) if partition_cols else writer).save(path)
    if fmt in FILE_FORMATS and partition_cols and not foreign:
        whole = schema if kept is None else with_new_fields(kept, schema)
        if whole != kept:
            keep_schema(spark, path, whole)
    return int(seen.get["rows"])


def write_partitions(
    df: DataFrame, path: str, partition_cols: Sequence[str], fmt: str = "parquet"
) -> int:
    """Overwrite only the partitions that occur in ``df``; returns the rows written."""
    return _write(df, path, partition_cols, fmt, "dynamic")


def rewrite_partitions(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str],
    fmt: str = "parquet",
    layout: Callable[[DataFrame], DataFrame] | None = None,
) -> int:
    """Overwrite partitions of a table from which ``df`` itself is computed.

    The new rows are first written aside, in the shared folder, and the table is overwritten from that
    copy, in the order of files that ``layout`` gives it; the row counts must agree. Plain files have
    no atomic swap: a driver lost during the
    overwrite leaves those partitions to be overwritten again from the copy, which is kept then.
    """
    aside = fresh_path(df.sparkSession, "rewrite")
    copied = replace_table(df, aside, fmt=fmt)
    again = df.sparkSession.read.format(fmt).schema(df.schema).load(aside)
    laid_out = again if layout is None else layout(again)
    written = _write(laid_out, path, partition_cols, fmt, "dynamic", rebalance=layout is None)
    if written != copied:
        raise RuntimeError(f"{written} of {copied} rows written to {path}; all are in {aside}")
    drop_path(df.sparkSession, aside)
    return written


def replace_table(
    df: DataFrame, path: str, partition_cols: Sequence[str] = (), fmt: str = "parquet"
) -> int:
    """Overwrite the whole table; returns the rows written."""
    return _write(df, path, partition_cols, fmt, "static")


def month_slices(start: str, end: str, whole: bool = False) -> list[tuple[str, str]]:
    """Calendar months of ``[start, end]``, the first and last one clipped unless ``whole``."""
    first, last = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    if whole and first <= last:
        first = first.replace(day=1)
        last = last.replace(day=calendar.monthrange(last.year, last.month)[1])
    slices = []
    while first <= last:
        month_end = first.replace(day=calendar.monthrange(first.year, first.month)[1])
        slices.append((first.isoformat(), min(month_end, last).isoformat()))
        first = month_end + dt.timedelta(days=1)
    return slices


def backfill(
    step: Callable[[str, str], DataFrame],
    start: str,
    end: str,
    path: str,
    partition_cols: Sequence[str],
    fmt: str = "parquet",
    date_col: str | None = None,
) -> dict[tuple[str, str], int]:
    """Run ``step(start, end)`` month by month; a slice can be run again without harm.

    Without ``date_col`` the first and last slice are widened to whole months, as an overwrite replaces whole
    partitions; partitions must lie within a month then. With ``date_col`` slices stay as asked, and
    the stored rows of their partitions that are dated outside the slice are written back with them.
    """
    out = {}
    for first, last in month_slices(start, end, whole=date_col is None):
        rows = step(first, last)
        if date_col and table_exists(rows.sparkSession, path):
            stored = rows.sparkSession.read.format(fmt).schema(rows.schema).load(path)
            day = F.to_date(date_col)
            outside = (day < F.lit(first).cast("date")) | (day > F.lit(last).cast("date")) | day.isNull()
            touched = rows.select(*partition_cols).distinct()
            same = [stored[c].eqNullSafe(touched[c]) for c in partition_cols]
            kept = stored.filter(outside).join(touched, same, "left_semi").select(*rows.columns)
            out[first, last] = rewrite_partitions(rows.union(kept), path, partition_cols, fmt)
        else:
            out[first, last] = write_partitions(rows, path, partition_cols, fmt)
    return out
