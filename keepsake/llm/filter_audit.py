"""What filters remove alone, together and in every order, from one contingency tensor for each part.

Every document fails or passes five conditions. A part's documents are counted in a tensor of shape
2x2x2x2x2, an axis for each filter (0: passes, 1: fails), and all figures of every order and step are
contractions of it: an axis is contracted with (1, 0) for pass, (0, 1) for fail, (1, 1) for all. A part
has 32 cells of three counts, whatever its size; documents meet only to find out which texts are copies,
by a hash of the text and after equal rows are counted together.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepsake.llm.common import READ_ROWS, map_rows
from keepsake.sources.staging import stage

FILTERS = "ABCDE"
ORDERS = list(permutations(range(len(FILTERS))))
MEASURES = ("n", "good", "toxic")
_CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SYMBOL = re.compile(r"[#$%&*|]")
MARKED = "doc_id long, part string, bits int, copy binary"
AUDIT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def conditions(text: str | None) -> int:
    """Bits of the failed conditions A to D; bit 0 is A. Words are parted by ASCII white space."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    return (
        (len(words) < 50)
        | (100 * len(set(words)) < 65 * len(words)) << 1
        | (100 * (len(raw) - len(raw.translate(None, _CAPITALS))) > 5 * len(text)) << 2
        | (_SYMBOL.search(text) is not None) << 3
    )


def marked(docs: DataFrame) -> DataFrame:
    """(doc_id, part, bits, copy): conditions A to D of each row; equal texts have equal ``copy``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bits, copies = [], []
            for at in range(0, b.num_rows, READ_ROWS):
                for text in b.slice(at, READ_ROWS).column("text").to_pylist():
                    bits.append(conditions(text))
                    copies.append(hashlib.blake2b((text or "").encode("utf-8", "surrogatepass"), digest_size=16).digest())
            new = [pa.array(bits, pa.int32()), pa.array(copies, pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("part"), *new], ["doc_id", "part", "bits", "copy"])

    source = F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), source, "text").mapInArrow(run, MARKED)


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, cell, n, good, toxic): rows that fail exactly the filters in the bits of ``cell``.

    A row fails E if a smaller id has its text. Rows without an id are no copies and no originals.
    Labels of one id count as good or toxic if any of them says so; others than 1 say nothing.
    """
    known = (
        labels.where("doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("of"))
        .agg(F.max((F.coalesce("quality", F.lit(0)) == 1).cast("long")).alias("is_good"),
             F.max((F.coalesce("toxic", F.lit(0)) == 1).cast("long")).alias("is_toxic"))
        .where("is_good = 1 or is_toxic = 1")
    )
    # Repeated rows become one before anything is joined; rows without an id have keys of their own.
    one = marked(docs).groupBy("doc_id", "part", "copy", "bits").agg(F.count(F.lit(1)).alias("n"))
    one = one.withColumn("key", F.coalesce("doc_id", F.xxhash64("copy", "part")))
    one = one.withColumn("no_id", F.col("doc_id").isNull())
    on = (F.col("key") == F.col("of")) & (F.col("no_id") == F.col("never"))
    labelled = one.join(known.withColumn("never", F.lit(False)), on, "left").select(
        "doc_id", "part", "copy", "bits", "no_id", "n",
        (F.col("n") * F.coalesce("is_good", F.lit(0))).alias("good"),
        (F.col("n") * F.coalesce("is_toxic", F.lit(0))).alias("toxic"),
    )
    # Copies of a text within a part: their sums, and what the smallest id among them holds.
    measures = [F.sum(m).alias(m) for m in MEASURES]
    groups = labelled.groupBy("copy", "part", "bits", "no_id").agg(
        *measures, F.min(F.struct("doc_id", *MEASURES)).alias("first")
    )
    groups = stage(groups, "copies")
    originals = groups.where("not no_id").groupBy(F.col("copy").alias("same")).agg(F.min("first.doc_id").alias("least"))
    judged = groups.join(originals, F.col("copy") == F.col("same"), "left")
    passing = F.when(F.col("no_id"), F.struct(*MEASURES)).when(
        F.col("first.doc_id") == F.col("least"), F.struct(*[F.col(f"first.{m}") for m in MEASURES])
    )
    passed = [F.coalesce(passing[m], F.lit(0)).alias(m) for m in MEASURES]
    failed = [(F.col(m) - F.coalesce(passing[m], F.lit(0))).alias(m) for m in MEASURES]
    both = F.array(
        F.struct(F.col("bits").alias("cell"), *passed),
        F.struct((F.col("bits") + F.lit(1 << 4)).alias("cell"), *failed),
    )
    return (
        judged.select("part", F.inline(both))
        .where("n > 0")
        .groupBy("part", "cell")
        .agg(*measures)
    )


def _selectors() -> dict[str, np.ndarray]:
    """For each figure the vectors of every (order, step) and axis, in the order of the result."""
    passes, fails, every = (1, 0), (0, 1), (1, 1)
    out: dict[str, list] = {"kept": [], "removed": [], "failing": [], "unique": []}
    for order in ORDERS:
        for step, f in enumerate(order):
            before = set(order[:step])
            axes = range(len(FILTERS))
            out["kept"].append([passes if a in before or a == f else every for a in axes])
            out["removed"].append([passes if a in before else fails if a == f else every for a in axes])
            out["failing"].append([fails if a == f else every for a in axes])
            out["unique"].append([fails if a == f else passes for a in axes])
    return {k: np.array(v, np.int64) for k, v in out.items()}


def contract(tensor: np.ndarray, selectors: np.ndarray) -> np.ndarray:
    """The sum of the cells that each row of ``selectors`` (rows, axes, 2) picks."""
    axes = [selectors[:, k] for k in range(selectors.shape[1])]
    return np.einsum("abcde,sa,sb,sc,sd,se->s", tensor, *axes)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step, zeros included.

    A part is a source, null being the empty one. Null texts are empty; repeated rows count each;
    other columns are ignored; no documents give no rows.
    """
    counted = cells(docs, labels)
    tensors = counted.groupBy("part").agg(F.collect_list(F.struct("cell", *MEASURES)).alias("cells"))
    names = ["".join(FILTERS[f] for f in order) for order in ORDERS]

    def rows(taken: Iterable[tuple]) -> Iterator[tuple]:
        picks = _selectors()
        steps = [(names[k], step + 1, f) for k, order in enumerate(ORDERS) for step, f in enumerate(order)]
        filters = np.array([f for _, _, f in steps])
        for part, held in taken:
            flat = np.zeros((len(MEASURES), 1 << len(FILTERS)), np.int64)
            for c in held:
                flat[:, c["cell"]] = [c[m] for m in MEASURES]
            # Bit 0 is filter A, so A is the last axis until they are turned round.
            n, good, toxic = (t.reshape((2,) * len(FILTERS)).transpose() for t in flat)
            kept, removed, failing, unique = (contract(n, picks[k]) for k in ("kept", "removed", "failing", "unique"))
            lost = [contract(t, picks["removed"]) for t in (good, toxic)]
            shapley = np.zeros(len(FILTERS), np.int64)
            np.add.at(shapley, filters, removed)
            columns = (kept, removed, failing - removed, unique, *lost, shapley[filters])
            for (name, step, _), figures in zip(steps, zip(*(c.tolist() for c in columns), strict=True), strict=True):
                yield part, name, step, *figures

    return map_rows(tensors, AUDIT, rows)
