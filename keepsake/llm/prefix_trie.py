"""A trie of conversation prefixes, with subtree totals by parallel tree contraction.

Conversations are numbered by turn in sorted runs, so that one long conversation spreads over many
tasks, and rebuilt with the opening turns of their block. A prefix is known by its depth and four sums
over its turns, each of a hash of the turn and its place; sums of equal prefixes are equal, and those of
different ones differ but for a chance of about one in 2^120 a pair. Texts are hashed where they are read
and go no further.

Totals of all subtrees come from contraction (``subtree_totals``): rounds of joins rake all leaves into
their parents and splice every second node or so out of chains, so that a trie of n nodes is gone after about
log n rounds, however deep it is. Spliced nodes are then put back in reverse order of the rounds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepsake.llm.common import map_rows, width
from keepsake.sources.staging import stage

HEADS = 9  # an opening has fewer turns than this
BLOCK = 5
LANES = ("l1", "l2", "l3", "l4")
PACKED_IDS = 50_000
PREFIX = ("depth", *LANES)
NO_IDS = hashlib.sha256(b"").hexdigest()


def running(df: DataFrame, key: str, order: list[str], sums: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with ``rank`` (from 1) in each ``key`` by ``order``, and running sums of ``sums``, inclusive.

    Rows are sorted into ranges of (key, order), so a key may span many tasks; each task counts from its own
    first row, and what earlier tasks hold of its first key is added after. One row a task reaches the driver.
    """
    spark = df.sparkSession
    columns, sums = df.columns, list(sums)
    added = ["task", "rank", *[f"sum_{s}" for s in sums]]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, last, held = TaskContext.get().partitionId(), None, np.zeros(1 + len(sums), np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            keys = b.column(key).to_numpy()
            values = np.stack([np.ones(len(keys), np.int64), *[b.column(s).to_numpy() for s in sums]])
            begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            total = np.cumsum(values, axis=1)
            # What the batch holds before each key's first row; the first key may go on from the last batch.
            before = np.concatenate([np.zeros((len(values), 1), np.int64), total], axis=1)[:, begins]
            if last is not None and keys[0] == last:
                before[:, 0] -= held
            total -= np.repeat(before, np.diff(np.append(begins, len(keys))), axis=1)
            last, held = keys[-1], total[:, -1]
            new = [pa.array(np.full(len(keys), task, np.int64)), *map(pa.array, total)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in columns), *new], [*columns, *added])

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in df.schema] + [f"{a} long" for a in added]
    ordered = df.repartitionByRange(width(spark), key, *order).sortWithinPartitions(key, *order)
    local = stage(ordered.mapInArrow(run, ", ".join(fields)), "running")

    totals = ["rank", *[f"sum_{s}" for s in sums]]
    ends = (
        local.groupBy("task")
        .agg(F.min(key).alias("first"), F.max(F.struct(key, *totals)).alias("last"))
        .orderBy("task")
        .collect()
    )
    carried, held, of = [], [0] * len(totals), None
    for e in ends:
        if e["first"] != of:
            held = [0] * len(totals)
        elif any(held):
            carried.append((e["task"], of, *held))
        mine = list(e["last"])
        held = [h + m for h, m in zip(held, mine[1:], strict=True)] if mine[0] == of == e["first"] else mine[1:]
        of = mine[0]
    before = spark.createDataFrame(carried, ", ".join(f"{c} long" for c in ("in_task", "of", *[f"b_{t}" for t in totals])))
    joined = local.join(
        F.broadcast(before), (F.col("task") == F.col("in_task")) & (F.col(key) == F.col("of")), "left"
    )
    whole = [(F.col(t) + F.coalesce(f"b_{t}", F.lit(0))).alias(t) for t in totals]
    return joined.select(*columns, *whole)


def opening(conv_id: str | Column) -> Column:
    """How many opening turns a conversation takes from its block's first."""
    return F.pmod(F.crc32(F.col(conv_id).cast("string").cast("binary")), F.lit(HEADS))


def _numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, mark, bytes, rank): all turns in order, their texts as hashes."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        role.alias("role"),
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("mark"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    return running(turns, "conv_id", ["turn", "role", "mark"])


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns (conv_id, depth, mark, bytes, last) of rebuilt conversations, and (conv_id, size) of each."""
    turns = _numbered(conversations)
    sizes = turns.groupBy("conv_id").agg(F.max("rank").alias("n"))
    known = sizes.select(
        "conv_id", "n", opening("conv_id").alias("h"), (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("base")
    )
    bases = sizes.select(F.col("conv_id").alias("of"), F.col("n").alias("base_n"))
    inherits = F.least("h", F.coalesce("base_n", F.lit(0)))
    info = stage(
        known.join(bases, F.col("base") == F.col("of"), "left")
        .select("conv_id", "base", "h", inherits.alias("m"), (inherits + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("size")),
        "conversations",
    )
    own = (
        turns.join(info, "conv_id")
        .where("rank > h")
        .select("conv_id", (F.col("rank") - F.col("h") + F.col("m")).alias("depth"), "mark", "bytes", "size")
    )
    heads = turns.where((F.col("rank") < HEADS) & (F.col("conv_id") % BLOCK == 0)).select(
        F.col("conv_id").alias("from"), F.col("rank").alias("depth"), "mark", "bytes"
    )
    taken = info.join(heads, (F.col("base") == F.col("from")) & (F.col("depth") <= F.col("m")))
    every = own.union(taken.select("conv_id", "depth", "mark", "bytes", "size"))
    return every.select("conv_id", "depth", "mark", "bytes", (F.col("depth") == F.col("size")).alias("last")), info


def _lanes() -> list[Column]:
    """Four hashes of 31 bits of a turn and its place, whose sums name a prefix."""
    one = F.xxhash64(F.lit("one"), "depth", "mark")
    two = F.xxhash64(F.lit("two"), "mark", "depth")
    low = F.lit((1 << 31) - 1)
    return [
        part.alias(n)
        for n, part in zip(
            LANES,
            [e for h in (one, two) for e in (F.shiftrightunsigned(h, 33), h.bitwiseAND(low))],
            strict=True,
        )
    ]


def prefixes(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two tables: every (conversation, prefix) but the root's, and the conversations.

    The first has the prefix's ``depth`` and lane sums, those of its parent (``u1`` to ``u4``), the bytes of its last text and
    whether the conversation ends there.
    """
    turns, info = rebuilt(conversations)
    summed = running(turns.select("conv_id", "depth", "bytes", "last", *_lanes()), "conv_id", ["depth"], LANES)
    sums = [F.col(f"sum_{n}").alias(n) for n in LANES]
    ups = [(F.col(f"sum_{n}") - F.col(n)).alias(f"u{k}") for k, n in enumerate(LANES, 1)]
    return summed.select("conv_id", "depth", *sums, *ups, "bytes", "last"), info


def _ends(ended: DataFrame) -> DataFrame:
    """SHA-256 of the ids that end at each prefix, ascending: packed in sorted runs, then read as a stream."""
    spark = ended.sparkSession

    def packed(taken: Iterable[tuple]) -> Iterator[tuple]:
        of, ids = None, []
        for *prefix, conv_id in taken:
            if ids and (prefix != of or len(ids) >= PACKED_IDS):
                yield *of, ids[0], ",".join(map(str, ids))
                ids = []
            of = prefix
            ids.append(conv_id)
        if ids:
            yield *of, ids[0], ",".join(map(str, ids))

    def digests(taken: Iterable[tuple]) -> Iterator[tuple]:
        of, digest = None, hashlib.sha256()
        for *prefix, _, ids in taken:
            if prefix == of:
                digest.update(b",")
            elif of is not None:
                yield *of, digest.hexdigest()
            if prefix != of:
                of, digest = prefix, hashlib.sha256()
            digest.update(ids.encode())
        if of is not None:
            yield *of, digest.hexdigest()

    key = "depth long, l1 long, l2 long, l3 long, l4 long"
    runs = ended.repartitionByRange(width(spark), *PREFIX, "conv_id").sortWithinPartitions(*PREFIX, "conv_id")
    runs = map_rows(runs.select(*PREFIX, "conv_id"), f"{key}, first long, ids string", packed)
    streams = runs.repartition(width(spark), *PREFIX).sortWithinPartitions(*PREFIX, "first")
    return map_rows(streams, f"{key}, ends_sha256 string", digests)


def subtree_totals(tree: DataFrame, measures: list[str]) -> DataFrame:
    """(id, *measures): of each node the sums over its subtree, itself included.

    ``tree`` has a unique ``id``, ``parent`` (null: a root), ``depth`` and the measures. A live node passes
    ``measure`` + ``x_measure`` to its parent once its subtree is known: its own sum so far, and that of
    nodes spliced out above it. Every round

    * rakes all leaves: what they hold is their total, and goes to their parents;
    * splices out chain nodes (one child, no root) that precede both neighbours in an order by one bit of the
      depth, another each round, then by hash: of an even chain every second one. The child takes its place.

    Then rounds are undone: a spliced node's total is what it held and what its child passed on.
    """
    extras = [f"x_{m}" for m in measures]
    own = [F.col(m) for m in measures]
    live = tree.join(
        tree.select(F.col("id").alias("at"), F.col("depth").alias("up")), F.col("parent") == F.col("at"), "left"
    ).select("id", "parent", "depth", "up", *own, *[F.lit(0).cast("long").alias(x) for x in extras])
    live = stage(live, "live")
    found: list[DataFrame] = []
    spliced: list[DataFrame] = []
    passed = [(F.col(m) + F.col(x)).alias(f"p_{m}") for m, x in zip(measures, extras, strict=True)]
    turn = 0
    while True:
        above = live.where("parent is not null").select(F.col("parent").alias("of")).distinct()
        seen = stage(live.join(above, F.col("id") == F.col("of"), "left"), "seen")
        leaves = seen.where("of is null")
        found.append(leaves.select("id", *measures))
        inner = seen.where("of is not null").drop("of")
        if inner.isEmpty():
            break
        gifts = (
            leaves.where("parent is not null")
            .select(F.col("parent").alias("of"), *passed)
            .groupBy("of")
            .agg(*[F.sum(f"p_{m}").alias(f"p_{m}") for m in measures])
        )
        raked = inner.join(gifts, F.col("id") == F.col("of"), "left").select(
            "id", "parent", "depth", "up",
            *[(F.col(m) + F.coalesce(f"p_{m}", F.lit(0))).alias(m) for m in measures], *extras,
        )
        raked = stage(raked, "raked")

        def before(depth: str, node: str, k: int = turn) -> Column:
            bit = F.shiftright(F.col(depth).cast("long"), k % 62).bitwiseAND(F.lit(1))
            return F.struct(bit, F.xxhash64(F.col(node), F.lit(k)), F.col(node))

        chain = (
            raked.where("parent is not null")
            .groupBy(F.col("parent").alias("of"))
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.min("id").alias("child"),
                F.min("depth").alias("child_depth"),
                *[F.sum(x).alias(f"child_{x}") for x in extras],
            )
            .where("n = 1")
        )
        first = (before("depth", "id") > before("up", "parent")) & (before("depth", "id") > before("child_depth", "child"))
        marked = raked.join(chain, F.col("id") == F.col("of"), "left").withColumn(
            "out", F.coalesce(F.col("parent").isNotNull() & F.col("child").isNotNull() & first, F.lit(False))
        )
        marked = stage(marked, "marked")
        gone = marked.where("out")
        spliced.append(
            gone.select("id", "child", *[(F.col(m) + F.col(f"child_x_{m}")).alias(m) for m in measures])
        )
        new = gone.select(
            F.col("child").alias("of_child"), F.col("parent").alias("new_parent"), F.col("up").alias("new_up"), *passed
        )
        live = (
            marked.where("not out")
            .select("id", "parent", "depth", "up", *measures, *extras)
            .join(new, F.col("id") == F.col("of_child"), "left")
            .select(
                "id",
                F.coalesce("new_parent", "parent").alias("parent"),
                "depth",
                F.coalesce("new_up", "up").alias("up"),
                *measures,
                *[(F.col(x) + F.coalesce(f"p_{m}", F.lit(0))).alias(x) for m, x in zip(measures, extras, strict=True)],
            )
        )
        live = stage(live, "live")
        turn += 1

    totals = found[-1]
    for k in range(len(spliced) - 1, -1, -1):
        below = totals.select(F.col("id").alias("of"), *[F.col(m).alias(f"p_{m}") for m in measures])
        back = spliced[k].join(below, F.col("child") == F.col("of")).select(
            "id", *[(F.col(m) + F.col(f"p_{m}")).alias(m) for m in measures]
        )
        totals = totals.union(stage(back, "expanded")).union(found[k])
    return totals


def trie(conversations: DataFrame) -> DataFrame:
    """One row for each distinct prefix of the rebuilt conversations, the empty one included.

    Turns go by ``turn``, null first; of equal ones by role, then by MD5 of role and text. Null roles and texts
    are empty, rows without ``conv_id`` belong to no conversation, repeated rows are turns of their own, and
    other columns are ignored. A block is ``conv_id - conv_id % 5`` with the sign of SQL. No conversations
    give no rows. ``saved_tokens`` counts bytes of UTF-8.
    """
    rows, info = prefixes(conversations)
    rows = stage(rows, "prefixes")
    ups = [f"u{k}" for k in range(1, 5)]
    inner = rows.groupBy(*PREFIX).agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.min("bytes").alias("bytes"),
        *[F.min(u).alias(u) for u in ups],
    )
    zero = F.lit(0).cast("long")
    root = (
        info.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
        .where("n_convs > 0")
        .select(
            *[zero.alias(c) for c in PREFIX], "conv_id", "n_convs", zero.alias("bytes"), *[F.lit(None).cast("long").alias(u) for u in ups]
        )
    )
    nodes = stage(inner.union(root).withColumn("id", F.monotonically_increasing_id()), "nodes")
    parents = nodes.select(
        (F.col("depth") + 1).alias("p_depth"), *[F.col(n).alias(f"p_{n}") for n in LANES],
        F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"),
    )
    same = F.col("depth") == F.col("p_depth")
    for n, u in zip(LANES, ups, strict=True):
        same &= F.col(f"p_{n}") == F.col(u)
    linked = nodes.join(parents, same, "left").select(
        *PREFIX, "conv_id", "n_convs", "id", "parent", "parent_conv_id",
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("own_saved"),
    )
    linked = stage(linked, "linked")
    children = linked.where("parent is not null").groupBy(F.col("parent").alias("of")).agg(F.count(F.lit(1)).alias("n_children"))
    sized = stage(
        linked.join(children, F.col("id") == F.col("of"), "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))).drop("of"),
        "sized",
    )
    tree = sized.select(
        "id", "parent", "depth", (F.col("n_children") == 0).cast("long").alias("n_leaves"), F.col("own_saved").alias("saved_tokens")
    )
    totals = subtree_totals(tree, ["n_leaves", "saved_tokens"])
    ended = rows.where("last").select(*PREFIX, "conv_id").union(
        info.where("size = 0").select(*[zero.alias(c) for c in PREFIX], "conv_id")
    )
    return (
        sized.join(totals, "id")
        .join(_ends(ended), list(PREFIX), "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.col("n_children").cast("long").alias("n_children"),
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(NO_IDS)).alias("ends_sha256"),
        )
    )
