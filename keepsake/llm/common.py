"""What the operators share: Arrow row maps, ASCII-only lower case, links to groups."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import sys
from collections.abc import Callable, Hashable, Iterable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from keepsake.sources.staging import discard, stage

T = TypeVar("T")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
READ_ROWS = 128
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 2 << 20


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def width(spark: SparkSession) -> int:
    """The shuffle width the session asks for: how many ways hot work is salted."""
    return max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))


def ascii_lower(text):
    """Lower case for A to Z only, as a column."""
    return F.translate(text, UPPER, UPPER.lower())


def kept_by_worker(key: Hashable, make: Callable[[], T]) -> T:
    """What a worker process keeps between tasks; module globals travel with each task anew."""
    held = sys.__dict__.setdefault("_kept_by_worker", {})
    if key not in held:
        held[key] = make()
    return held[key]


def release_memory() -> None:
    """Gives back to the system what this worker no longer uses; workers outlive their tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def releasing(run: Callable[[Iterable], Iterator]) -> Callable[[Iterable], Iterator]:
    """``run`` over the batches of a task, after which the worker gives its memory back."""

    def through(batches: Iterable) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release_memory()

    return through


def map_arrow(df: DataFrame, run: Callable[[Iterable], Iterator], schema: str | StructType) -> DataFrame:
    """``run`` over Arrow batches of few bytes, however long the texts are, unless the session asks for others.

    A task and its worker each hold some batches; Spark's own bounds are 10000 rows and 64 MB. The setting stays
    with the session, as frames run when they are used.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_CONF, None) is None:
        conf.set(BATCH_CONF, str(BATCH_BYTES))
    return df.mapInArrow(releasing(run), schema)


def shared_object(spark: SparkSession, value: T) -> Callable[[], T]:
    """A broadcast of an object of this package's classes, which travel by value as functions do."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: cloudpickle.loads(sent.value)


def map_rows(
    df: DataFrame,
    schema: str,
    rows: Callable[[Iterator[tuple]], Iterable[tuple]],
    batch: int = 2000,
    batch_bytes: int = 8 << 20,
) -> DataFrame:
    """Tuples in, tuples out, within each partition; Arrow batches stay small on both sides."""
    out = to_arrow_schema(StructType.fromDDL(schema))

    def taken(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for b in batches:
            for at in range(0, b.num_rows, READ_ROWS):
                yield from zip(*(c.to_pylist() for c in b.slice(at, READ_ROWS).columns), strict=True)

    def given(held: list[tuple]) -> pa.RecordBatch:
        columns = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, out, strict=True)], schema=out
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in rows(taken(batches)):
            held.append(row)
            size += sum(len(v) for v in row if isinstance(v, str | bytes))
            if len(held) >= batch or size >= batch_bytes:
                yield given(held)
                held, size = [], 0
        if held:
            yield given(held)

    return map_arrow(df, run, schema)


def append_column(
    df: DataFrame, source: str, name: str, kind: str, values: Callable[[list], list]
) -> DataFrame:
    """``df`` with a column computed from one other, a list at a time; a clashing column gives way."""
    columns = [c for c in df.columns if c != name]
    out = to_arrow_schema(StructType.fromDDL(f"{name} {kind}")).field(0)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = []
            for at in range(0, b.num_rows, READ_ROWS):
                new += values(b.slice(at, READ_ROWS).column(source).to_pylist())
            kept = [b.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(new, out.type)], names=[*columns, name])

    picked = df.select(source, *[c for c in columns if c != source])
    schema = StructType([df.schema[c] for c in columns]).add(name, kind)
    return map_arrow(picked, run, schema)


def _nearest(edges: DataFrame, salt: int) -> DataFrame:
    """(node, next, least): of each node its neighbour of least hash, and the lesser of the two."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    order = F.when(F.col("a") != F.col("b"), F.xxhash64("b", F.lit(salt)))
    nodes = both.groupBy(F.col("a").alias("node")).agg(F.min_by("b", order).alias("next"), F.min(order).alias("hash"))
    mine = F.col("hash").isNull() | (F.xxhash64("node", F.lit(salt)) < F.col("hash"))
    least = F.when(mine, F.col("node")).otherwise(F.col("next"))
    return nodes.select("node", F.coalesce("next", "node").alias("next"), least.alias("least"))


def components(links: DataFrame) -> DataFrame:
    """(node, component) of the nodes of ``links`` (a, b), component being the smallest node.

    Every round each node becomes the least neighbour of its least neighbour (or that one, if it is less), by a
    hash that is another each round, and links are carried over to what the nodes became. So rounds grow with the
    logarithm of a group and not with its length: a shuffled chain of 20000 takes ten, a star one. What nodes became
    is staged, and followed from the last round back; only whether links are left reaches the driver. Joins meet
    a popular node on one side only, which adaptive execution can split.
    """
    edges = stage(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    became = []
    while not became or not edges.isEmpty():
        nodes = _nearest(edges, len(became))
        through = nodes.select(F.col("node").alias("at"), F.col("least").alias("image"))
        became.append(stage(nodes.join(through, F.col("next") == F.col("at")).select("node", "image"), "became"))
        for end in ("a", "b"):
            to = became[-1].select(F.col("node").alias("__node"), F.col("image").alias("__image"))
            moved = (edges if end == "a" else moved).join(to, F.col(end) == F.col("__node"))
            moved = moved.withColumn(end, F.col("__image")).drop("__node", "__image")
        left = moved.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        left = stage(left, "links")
        discard(edges)
        edges = left
    discard(edges)
    rooted = became[-1].select("node", F.col("image").alias("root"))
    for step in reversed(became[:-1]):
        further = rooted.select(F.col("node").alias("at"), F.col("root").alias("further"))
        rooted = step.join(further, F.col("image") == F.col("at"), "left").select(
            "node", F.coalesce("further", "image").alias("root")
        )
    rooted = stage(rooted, "rooted")
    discard(*became)
    smallest = rooted.groupBy(F.col("root").alias("of")).agg(F.min("node").alias("component"))
    return rooted.join(smallest, F.col("root") == F.col("of")).select("node", "component")
