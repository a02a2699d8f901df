"""Best-fit-decreasing sharding: indivisible groups enter the tightest bin that has room.

Groups are equal texts. Only how many groups there are of each size reaches the driver, sizes over four digits
rounded up to four: at most 9000 counts for each power of ten, whatever the number of documents. Groups of
one size are placed run by run: the tightest bin with room takes as many as fit. Groups learn their rank among those of
their size in the cluster and look up the run they are in. A group larger than a shard can't stay whole; it
is cut by row into ``PARTS`` parts, which are groups again, and a row larger than a shard has one to itself.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keepsake.llm.common import width
from keepsake.sources.staging import stage

PARTS = 1_000  # of a group that exceeds a shard
DIGITS = 4
TOLERANCE = 10_000  # the least capacity is found to this fraction of itself


@dataclass
class _Node:
    """A treap over (remaining capacity, bin): balanced by pseudo-random priorities."""

    key: tuple[int, int]
    priority: int
    left: _Node | None = None
    right: _Node | None = None


class Bins:
    """Bins by remaining capacity: the tightest one that fits is found in logarithmic time."""

    def __init__(self) -> None:
        self.root: _Node | None = None

    def insert(self, rest: int, number: int) -> None:
        low, high = self._cut(self.root, (rest, number))
        new = _Node((rest, number), zlib.crc32(b"%d,%d" % (rest, number)))
        self.root = self._join(self._join(low, new), high)

    def take(self, size: int) -> tuple[int, int] | None:
        """Removes and returns the bin with the least capacity of at least ``size``."""
        node, best = self.root, None
        while node:
            if node.key[0] >= size:
                best, node = node.key, node.left
            else:
                node = node.right
        if best is None:
            return None
        low, rest = self._cut(self.root, best)
        _, high = self._cut(rest, (best[0], best[1] + 1))
        self.root = self._join(low, high)
        return best

    def _cut(self, node, key):
        """Nodes below ``key``, and the others."""
        if node is None:
            return None, None
        if node.key < key:
            low, high = self._cut(node.right, key)
            node.right = low
            return node, high
        low, high = self._cut(node.left, key)
        node.left = high
        return low, node

    def _join(self, a, b):
        if a is None or b is None:
            return a or b
        if a.priority > b.priority:
            a.right = self._join(a.right, b)
            return a
        b.left = self._join(a, b.left)
        return b


Run = tuple[int, int, int]  # first item of the size, how many, bin


def best_fit_decreasing(counts: dict[int, int], capacity: int, most: int | None = None) -> tuple[dict[int, list[Run]], int]:
    """Runs of items of each size, largest first, and the number of bins.

    A new bin is opened only where no open one has room. It stops, with too many bins, beyond ``most``.
    """
    bins, opened = Bins(), 0
    out: dict[int, list[Run]] = {}
    for size in sorted(counts, reverse=True):
        if size > capacity:
            raise ValueError(f"an item of {size} exceeds the capacity of {capacity}")
        at, n = 0, counts[size]
        while at < n:
            found = bins.take(size)
            if found is None:
                found, opened = (capacity, opened), opened + 1
                if most is not None and opened > most:
                    return out, opened
            each = min(n - at, found[0] // size)
            bins.insert(found[0] - each * size, found[1])
            out.setdefault(size, []).append((at, each, found[1]))
            at += each
    return out, opened


def least_capacity(counts: dict[int, int], shards: int) -> dict[int, list[Run]]:
    """Bins of the least capacity, found by halving, at which ``shards`` bins hold everything.

    Items larger than an equal share have a bin each, so that the others are levelled among the rest.
    """
    counts, alone = dict(counts), []
    total = sum(size * n for size, n in counts.items())
    while counts and shards - len(alone) > 1 and max(counts) > -(-total // (shards - len(alone))):
        size = max(counts)
        alone.append(size)
        total -= size
        counts[size] -= 1
        if not counts[size]:
            del counts[size]
    free = shards - len(alone)
    low = max(-(-total // free), max(counts, default=0))
    high, best, close = low, None, low // TOLERANCE
    while best is None:
        tried, used = best_fit_decreasing(counts, high, free)
        if used <= free:
            best = tried
        else:
            low, high = high + 1, high + max(1, high // 64)
    while high - low > close:
        mid = (low + high) // 2
        tried, used = best_fit_decreasing(counts, mid, free)
        if used <= free:
            high, best = mid, tried
        else:
            low = mid + 1
    for n, size in enumerate(alone):
        runs = best.setdefault(size, [])
        runs.append((sum(r[1] for r in runs), 1, free + n))
    return best


def _salted_rank(df: DataFrame, by: str, order: Sequence[str], name: str) -> DataFrame:
    """``df`` with the place (from 0) of each row among those of equal ``by``, counted in salted parts.

    ``order`` must be unique within ``by``; a part starts where the ones before end.
    """
    salted = df.withColumn("salt", F.pmod(F.xxhash64(*order), F.lit(width(df.sparkSession))))
    sizes = salted.groupBy(by, "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(by).orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(by, "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy(by, "salt").orderBy(*order)
    return (
        salted.withColumn("at", F.row_number().over(within) - 1)
        .join(starts, [by, "salt"])
        .select(*df.columns, (F.col("before") + F.col("at")).alias(name))
    )


def _size_class(size):
    """The size, rounded up to ``DIGITS`` digits."""
    unit = F.pow(F.lit(10.0), F.greatest(F.lit(0), F.length(size.cast("string")) - DIGITS)).cast("long")
    return (F.ceil(size / unit) * unit).cast("long")


def shard(docs: DataFrame, shards: int = 16, capacity: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): equal texts stay together, bytes are near equal.

    With ``capacity`` in bytes the number of shards is what best fit needs, else the capacity is the
    least at which ``shards`` suffice; a size of over four digits counts as up to a thousandth more than it is.
    Size is the UTF-8 length plus one; a null text counts as empty. Copies are cut apart only if their
    group exceeds a shard. Repeated rows each get a slot; slots of a shard count from 0 without a gap. An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.md5(text).alias("group"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = stage(rows, "sizes")
    total = rows.agg(F.sum("size")).first()[0] or 0
    share = capacity or -(-total // shards)
    groups = rows.groupBy("group").agg(F.sum("size").alias("bytes"))
    # Fewer groups than shards can exceed a share, with a given capacity fewer than total / capacity.
    over = groups.where(F.col("bytes") > share).select(F.col("group").alias("large"))
    part = F.pmod(F.xxhash64("row"), F.lit(PARTS))
    keyed = rows.join(over, F.col("group") == F.col("large"), "left").withColumn(
        "item", F.when(F.col("large").isNotNull(), F.concat_ws("/", "group", part)).otherwise(F.col("group"))
    )
    keyed = stage(keyed.drop("group", "large"), "items")
    size_class = _size_class(F.col("bytes"))
    if capacity:
        size_class = F.when(F.col("bytes") <= capacity, F.least(size_class, F.lit(capacity))).otherwise(size_class)
    items = keyed.groupBy("item").agg(F.sum("size").alias("bytes")).withColumn("class", size_class)
    items = stage(items, "groups")
    counts = {r["class"]: r["n"] for r in items.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = best_fit_decreasing(counts, capacity)[0] if capacity else least_capacity(counts, shards)
    runs = spark.createDataFrame(
        [(size, first, first + n, b) for size, found in plan.items() for first, n, b in found],
        "of_class long, first long, after long, shard int",
    )
    ranked = _salted_rank(items, "class", ["item"], "rank")
    homes = ranked.join(
        runs,
        (F.col("class") == F.col("of_class")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("after")),
    ).select(F.col("item").alias("home"), "shard")
    placed = keyed.join(homes, F.col("item") == F.col("home")).drop("item", "home")
    slots = _salted_rank(placed, "shard", ["row"], "slot")
    return slots.select("doc_id", "size", "text_crc32", "shard", "slot")
