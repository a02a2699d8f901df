"""SimHash near-dedup by anchor points of a covering code.

Two fingerprints of 64 bits within two differing bits have a half (32 bits) in which they differ in
at most one. Anchors of a half are the words of the perfect Hamming code of length 31 with the last
bit free: each half word is within the covering radius 1 of exactly one anchor, its home. A
fingerprint is replicated to all anchors within covering radius plus threshold (1 + 1 = 2) of its
half, 17 or so, so that it meets at the home of every near partner, and pairs are compared there
over all 64 bits. A second key, equal in at least one of three parts of the other half,
keeps groups small where many fingerprints share a half. Where very many share both, as pages of one
template do, they are not compared in pairs but linked through the words one bit from both.

Only distinct fingerprints take part, so groups of copies have no weight, and a fingerprint has at
most 2080 others within two bits. Components are found in the cluster.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keepsake.llm.common import append_column, components, width
from keepsake.sources.staging import stage

SEED = 42
_CHUNK = 1 << 16
_TASK_ROWS = 1 << 14
_COLUMN = np.arange(1, 32, dtype=np.uint32)  # the check matrix of the code: bit k has column k + 1


def shingles(text: str | None, size: int) -> list[bytes]:
    """Word shingles of the text in lower case (A-Z); a shorter text is one; without words none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    if size == 3:
        return [b"%b %b %b" % t for t in zip(words, words[1:], words[2:], strict=False)]
    return [b" ".join(t) for t in zip(*(words[k:] for k in range(size)), strict=False)]


def fingerprint(parts: list[bytes]) -> int:
    """Bits set in over half of the shingles' XXH64 values."""
    import xxhash

    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.uint64)
    for at in range(0, len(parts), _CHUNK):
        h = np.array([digest(p, SEED) for p in parts[at : at + _CHUNK]], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0)
    return int(np.packbits(counts * np.uint64(2) > np.uint64(len(parts)), bitorder="little").view("<u8")[0])


def _marks(size: int):
    def marks(texts: list[str | None]) -> list[int]:
        return np.array([fingerprint(shingles(t, size)) for t in texts], np.uint64).view(np.int64).tolist()

    return marks


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """``docs`` with ``fp``, the fingerprint's 64 bits as a signed long; zero for texts without words."""
    return append_column(docs, "text", "fp", "long", _marks(size))


def _syndrome(half: np.ndarray) -> np.ndarray:
    """Of the lower 31 bits: the position (from 1) of the bit that leads to the anchor, 0 for none."""
    out = np.zeros(len(half), np.uint32)
    for k in range(31):
        out ^= ((half >> np.uint32(k)) & np.uint32(1)) * _COLUMN[k]
    return out


def _flip(half: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Flips bit ``place`` - 1; place 0 flips nothing."""
    return np.where(place > 0, half ^ (np.uint32(1) << np.maximum(place, 1).astype(np.uint32) - np.uint32(1)), half)


def home(half: np.ndarray) -> np.ndarray:
    """The anchor within radius 1 of each half word."""
    return _flip(half, _syndrome(half))


def anchors_near(half: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, anchors): together every anchor within distance 2 of each half word, once.

    The home, alone or with the free bit flipped; and for each pair of the 31 bits whose columns sum
    to the syndrome, the word with both flipped. A word of the code has no other within distance 2.
    """
    s, every = _syndrome(half), np.arange(len(half))
    near = _flip(half, s)
    yield every, near
    yield every, near ^ (np.uint32(1) << np.uint32(31))
    for i in range(1, 32):
        rows = np.flatnonzero((s ^ np.uint32(i) > i) & (s > 0))
        first = half[rows] ^ np.uint32(1 << (i - 1))
        yield rows, _flip(first, s[rows] ^ np.uint32(i))


_PARTS = ((0, 11), (11, 11), (22, 10))


CROWD = 64  # homes that may share a key and still be compared in pairs


def _keys(fp: np.ndarray, homes: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, key, is home): the anchor of one half and one part of the other half, as one number."""
    word = fp.view(np.uint64)
    for side in range(2):
        half = (word >> np.uint64(32 * side)).astype(np.uint32)
        other = (word >> np.uint64(32 * (1 - side))).astype(np.uint32)
        own = home(half)
        near = [(np.arange(len(half)), own)] if homes else anchors_near(half)
        row, anchor = (np.concatenate(x) for x in zip(*near, strict=True))
        for part, (low, bits) in enumerate(_PARTS):
            piece = ((other[row] >> np.uint32(low)) & np.uint32((1 << bits) - 1)).astype(np.uint64)
            key = (anchor.astype(np.uint64) << np.uint64(32)) | (piece << np.uint64(8)) | np.uint64(2 * part + side)
            yield row, key.view(np.int64), anchor == own[row]


def _spread(distinct: DataFrame) -> DataFrame:
    """Fingerprints are few bytes and their replicas many, so tasks go by rows."""
    tasks = 1 + distinct.count() // _TASK_ROWS
    return distinct.select("fp").repartition(min(tasks, width(distinct.sparkSession)))


def _replicas(spread: DataFrame, homes: bool = False) -> DataFrame:
    """(key, fp, home): the fingerprints at all their keys, or only at those of their homes."""

    def replicate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False)
            for row, key, own in _keys(fp, homes):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key, fp[row], own)], ["key", "fp", "home"])

    return spread.mapInArrow(replicate, "key long, fp long, home boolean")


def _met(homes: DataFrame, replicas: DataFrame, threshold: int) -> DataFrame:
    """(a, b) with a < b: pairs within the threshold that meet at the home of one."""
    near = replicas.select(F.col("key").alias("at"), F.col("fp").alias("b"), F.col("home").alias("too"))
    close = (F.col("key") == F.col("at")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("b"))) <= threshold)
    once = (~F.col("too") & (F.col("fp") != F.col("b"))) | (F.col("fp") < F.col("b"))
    pairs = homes.join(near, close & once)
    return pairs.select(F.least("fp", "b").alias("a"), F.greatest("fp", "b").alias("b")).distinct()


def links(distinct: DataFrame, threshold: int = 2) -> DataFrame:
    """(a, b) with a < b: all pairs of the distinct ``fp`` that differ in at most two bits."""
    if threshold > 2:
        raise ValueError("the anchors cover a threshold of two bits")
    spread = _spread(distinct)
    return _met(_replicas(spread, homes=True), _replicas(spread), threshold)


def _bridged(distinct: DataFrame) -> DataFrame:
    """(a, b) with a < b, two bits apart at most, that connect whatever ``links`` connects.

    Words within one bit of a third are within two of each other, and words within two have such a third. So
    for each third the least of its words, of which there are 65 at most, is linked with the others.
    """
    fp = F.col("fp")
    bits = [(1 << k) - (1 << 64 if k == 63 else 0) for k in range(64)]
    thirds = F.explode(F.array(fp, *[fp.bitwiseXOR(F.lit(bit)) for bit in bits])).alias("third")
    least = F.min("fp").over(Window.partitionBy("third"))
    pairs = distinct.select("fp", thirds).select(least.alias("a"), fp.alias("b"))
    return pairs.where("a < b").distinct()


def bonds(distinct: DataFrame, threshold: int = 2, crowd: int = CROWD) -> DataFrame:
    """(a, b) with a < b: pairs out of ``links`` that connect the same fingerprints.

    The pairs at a key grow with the square of the fingerprints there. So where a key is home to more than
    ``crowd``, all that meet there are bridged instead, at 65 words each.
    """
    if threshold != 2:
        return links(distinct, threshold)
    spread = _spread(distinct)
    homes, replicas = _replicas(spread, homes=True), _replicas(spread)
    crowded = stage(homes.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowd).select("key"), "crowded")
    if crowded.isEmpty():
        return _met(homes, replicas, threshold)
    dense = stage(replicas.join(crowded, "key", "left_semi").select("fp").distinct(), "dense")
    return _met(homes.join(crowded, "key", "left_anti"), replicas, threshold).union(_bridged(dense)).distinct()


def _classes(marked: DataFrame, threshold: int) -> DataFrame:
    """(fp, component, component_id) of the rows' distinct fingerprints."""
    distinct = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct")
    linked = stage(bonds(distinct, threshold), "near")
    groups = components(linked).select(F.col("node").alias("fp"), "component")
    named = stage(distinct.join(groups, "fp", "left").withColumn("component", F.coalesce("component", "fp")), "classes")
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    return named.join(least, "component").select("fp", "component", "component_id")


def near_duplicates(docs: DataFrame, size: int = 3, threshold: int = 2) -> DataFrame:
    """(doc_id, fp, component_id): the smallest id reachable over links of at most ``threshold`` bits.

    Texts without words (null, empty, blank) have fingerprint zero and link like others. Repeated
    rows stay; null ids take part but name no component, unless it has no other id. Columns other
    than ``doc_id`` and ``text`` are ignored; an empty table gives no rows.
    """
    marked = stage(fingerprints(docs.select("doc_id", "text"), size).select("doc_id", "fp"), "fingerprints")
    names = _classes(marked, threshold).select("fp", "component_id")
    return marked.join(names, "fp").select("doc_id", "fp", "component_id")


def deduplicated(docs: DataFrame, size: int = 3, threshold: int = 2) -> DataFrame:
    """One row of each group, with all columns of ``docs``: that of the smallest id.

    Of several rows with that id (repeated rows) one stays. Groups without an id keep one row each.
    """
    marked = stage(append_column(docs, "text", "__fp", "long", _marks(size)), "fingerprints")
    light = marked.select("doc_id", F.col("__fp").alias("fp"))
    keepers = (
        light.join(_classes(light, threshold), "fp")
        .where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("component", F.col("doc_id").alias("__keeper"), "fp")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("component", "__keeper")
        .agg(F.min_by("fp", "fp").alias("__of"), F.min_by("n", "fp").alias("__rows"))
        .select("__keeper", "__of", "__rows")
    )
    kept = marked.join(keepers, (F.col("__fp") == F.col("__of")) & F.col("doc_id").eqNullSafe(F.col("__keeper")))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    # Only the few groups whose keeper is a repeated row are shuffled once more.
    once = kept.where("__rows = 1").select(columns)
    return once.union(kept.where("__rows > 1").dropDuplicates(["__of"]).select(columns))
