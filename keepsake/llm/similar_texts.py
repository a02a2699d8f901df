"""Near copies by word shingles: SimHash anchors of a covering code, candidates confirmed by their Jaccard similarity.

Two texts whose sets of five-word shingles have a Jaccard similarity of 0.8 differ in a seventh of their
fingerprints' bits, too many for the narrow radius of ``simhash``. So the fingerprint is cut into bytes, of which
some differ in at most one bit, and each byte is covered by the Hamming code of length 7 with a free bit: it is
replicated to all anchors within covering radius plus threshold (1 + 1), and meets its near partners at their homes.
Bytes alone tell little apart, so every two of them are keyed by a witness, a shingle of least hash that similar
texts share with a probability of their similarity. Two texts of similarity 0.8 miss each other in all of
``WITNESSES`` times two keys with a probability below 0.01, more similar ones hardly ever.

Texts of one key are not paired with each other. A key's leader is the home nearest to the majority of its fingerprints, which
is next to the text that copies were made from. First every text meets two leaders of its keys; then only those
in other groups than a key's leader meet the rest of the key, and only pairs of different groups come out that have one of their rarest shingles in
common, as similar texts must. So a large group of near copies costs about as many comparisons as it has texts, those included that are too far from their source.

Only texts that share a key with another are read again for their shingles; which they are, a bitmap of fixed size
tells. Similarity is counted over 32-bit hashes of all shingles, in built-in array functions.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepsake.llm.common import append_column, components, map_arrow, map_rows, width
from keepsake.llm.simhash import SEED, shingles
from keepsake.sources.staging import stage, stage_bucketed

WITNESSES = 3
BITS = 128
#: Fingerprints of texts of similarity 0.8 differ in 19 bits, give or take 4; those of unlike texts in 64.
MOST_BITS = 36
MAP_BITS = 25
_ROW = 33  # bits of a row's number within its task
MARKS = "row long, doc_id long, same binary, place int, f1 long, f2 long, " + ", ".join(
    f"w{k} long" for k in range(WITNESSES)
)


def _mixed(h: np.ndarray, k: int) -> np.ndarray:
    """Another 64-bit hash of each hash (the finalizer of SplitMix64)."""
    z = h + np.uint64(0x9E3779B97F4A7C15 * (k + 1) & (1 << 64) - 1)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Distinct shingles as sorted 64-bit hashes; none of a text without words."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(s, SEED) for s in set(shingles(text, size))], np.uint64))


def _sums(h: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of 64 bits set."""
    out = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        part = h[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        out += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return out


def fingerprint(h: np.ndarray) -> tuple[int, int]:
    """128 bits in two words: those set in over half of the shingles' hashes."""
    words = []
    for k in range(2):
        bits = _sums(_mixed(h, WITNESSES + k)) * 2 > len(h)
        words.append(int(np.packbits(bits, bitorder="little").view("<i8")[0]))
    return words[0], words[1]


def _same(text: str | None) -> bytes:
    """Equal for texts with equal words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _place(same: bytes, doc_id: int | None) -> int:
    """The place of a row in the bitmap; copies with other ids have others."""
    return zlib.crc32(b"%s %s" % (same, str(doc_id).encode())) >> (32 - MAP_BITS)


def marks(docs: DataFrame, size: int) -> DataFrame:
    """Of each row its number, what equal texts share, the place in the bitmap, the fingerprint and witnesses."""

    def rows(taken: Iterable[tuple]) -> Iterator[tuple]:
        number = TaskContext.get().partitionId() << _ROW
        for n, (doc_id, text) in enumerate(taken):
            h, same = shingle_set(text, size), _same(text)
            row = number + n, doc_id, same, _place(same, doc_id)
            if len(h):
                yield *row, *fingerprint(h), *[int(_mixed(h, k).min().view(np.int64)) for k in range(WITNESSES)]
            else:
                yield *row, 0, 0, *[None] * WITNESSES

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), MARKS, rows)


def _byte_anchors() -> tuple[np.ndarray, list[np.ndarray]]:
    """For each byte its home, the code word within one bit (the top bit is free), and all anchors within two."""
    byte = np.arange(256)
    syndrome = np.zeros(256, np.int64)
    for k in range(7):
        syndrome ^= (byte >> k & 1) * (k + 1)
    home = np.where(syndrome > 0, byte ^ (1 << np.maximum(syndrome, 1) - 1), byte)
    code = np.unique(home)
    near = [code[np.bitwise_count(code ^ b) <= 2] for b in byte]
    return home, near


def _keys(texts: DataFrame) -> DataFrame:
    """(key, text, home): each fingerprint byte at every anchor near it, within its witness."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home, near = _byte_anchors()
        sizes = np.array([len(n) for n in near])
        starts = np.cumsum(sizes) - sizes
        flat = np.concatenate(near)
        for b in batches:
            text = b.column("text").to_numpy()
            fingers = [b.column(f).to_numpy().view(np.uint64) for f in ("f1", "f2")]
            for k in range(WITNESSES):
                witness = b.column(f"w{k}").to_numpy().view(np.uint64)
                for part in range(2 * k, 2 * k + 2):
                    byte = ((fingers[part // 8] >> np.uint64(8 * (part % 8))) & np.uint64(255)).astype(np.int64)
                    each = sizes[byte]
                    row = np.repeat(np.arange(len(byte)), each)
                    at = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
                    anchor = flat[starts[byte][row] + at]
                    key = _mixed(witness[row] ^ (anchor + 256 * part).astype(np.uint64), 99)
                    columns = (key.view(np.int64), text[row], anchor == home[byte][row])
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "text", "home"])

    picked = texts.where("w0 is not null").select("text", "f1", "f2", *[f"w{k}" for k in range(WITNESSES)])
    return map_arrow(picked, run, "key long, text long, home boolean")


def _apart(a1: str, a2: str, b1: str, b2: str) -> Column:
    """Differing bits of two fingerprints."""
    return sum(F.bit_count(F.col(a).bitwiseXOR(F.col(b))) for a, b in ((a1, b1), (a2, b2)))


def _near(a: str, b: str) -> Column:
    return _apart(f"{a}f1", f"{a}f2", f"{b}f1", f"{b}f2") <= MOST_BITS


def _majority(held: DataFrame) -> DataFrame:
    """(key, m1, m2): the bits that over half of the key's fingerprints have, counted two to a number."""
    bit = lambda f, k: F.shiftrightunsigned(F.col(f), k).bitwiseAND(F.lit(1))
    sums = held.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(bit("f1", k) + F.shiftleft(bit("f2", k), 32)).alias(f"s{k}") for k in range(64)],
    )

    def word(low: bool) -> Column:
        counts = [F.col(f"s{k}").bitwiseAND(F.lit((1 << 32) - 1)) if low else F.shiftrightunsigned(f"s{k}", 32) for k in range(64)]
        marks = F.array(*[F.when(2 * c > F.col("n"), F.shiftleft(F.lit(1).cast("long"), k)).otherwise(F.lit(0)) for k, c in enumerate(counts)])
        return F.aggregate(marks, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))

    return sums.select("key", word(True).alias("m1"), word(False).alias("m2"))


def shingle_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(text, shingles) of the ``wanted`` (text, same, place), in buckets by text.

    Documents are read once more; those whose place in a bitmap is empty are passed over. The bitmap has a fixed size,
    however many are wanted: if it fills up, more sets are made in vain.
    """
    spark = docs.sparkSession
    word = F.shiftright("place", 6)
    bit = F.expr("shiftleft(1L, place & 63)")
    words = wanted.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")).collect()
    bitmap = np.zeros(1 << (MAP_BITS - 6), np.int64)
    for r in words:
        bitmap[r["word"]] = r["bits"]
    sent = spark.sparkContext.broadcast(bitmap.tobytes())

    def rows(taken: Iterable[tuple]) -> Iterator[tuple]:
        held = np.frombuffer(sent.value, np.uint64)
        for doc_id, text in taken:
            same = _same(text)
            place = _place(same, doc_id)
            if int(held[place >> 6]) >> (place & 63) & 1:
                yield same, np.unique(shingle_set(text, size).astype(np.uint32)).view(np.int32)

    found = map_rows(docs.select(F.col("doc_id").cast("long"), "text"), "like binary, shingles array<int>", rows, 128, 1 << 20)
    named = found.join(wanted.select("text", "same"), F.col("like") == F.col("same")).select("text", "shingles")
    # Repeated rows give a set each.
    one = named.groupBy("text").agg(F.first("shingles").alias("shingles"))
    return stage_bucketed(one, width(spark), "text", label="sets", gather=True)


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The distinct ``pairs`` (a, b) whose ``sets`` (text, shingles) have at least that Jaccard similarity."""
    distinct = stage(pairs.select("a", "b").distinct(), "pairs")
    left = sets.select(F.col("text").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("text").alias("b"), F.col("shingles").alias("right"))
    both = distinct.join(left, "a").join(right, "b")
    n, m = F.size("left"), F.size("right")
    shared = F.size(F.array_intersect("left", "right"))
    alike = (F.least(n, m) >= similarity * F.greatest(n, m)) & (shared >= similarity * (n + m - shared))
    return both.where(alike).select("a", "b")


def _least_shared(n: Column | str, m: Column | str, similarity: float) -> Column:
    """How many shingles sets of sizes ``n`` and ``m`` must share for that similarity; rounding never asks for more."""
    return F.ceil((F.col(n) + F.col(m)) * (similarity / (1 + similarity)) - 1e-6)


def rarest(sets: DataFrame, similarity: float) -> DataFrame:
    """(of, n, rare) of each text of ``sets``: its size, and as many of its rarest shingles as similar texts may lack, and one.

    Similar texts share one of these: in one order of all shingles, here by rarity, the first of what they share comes
    before either has left out more than it may.
    """
    held = sets.select("text", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    known = held.groupBy("shingle").agg(F.count(F.lit(1)).alias("texts"))
    ranked = F.row_number().over(Window.partitionBy("text").orderBy("texts", "shingle"))
    first = held.join(known, "shingle").withColumn("rank", ranked)
    first = first.where(F.col("rank") <= F.col("n") - F.ceil(F.col("n") * similarity - 1e-6) + 1)
    return first.groupBy(F.col("text").alias("of")).agg(
        F.min("n").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("rank", "shingle"))), lambda x: x["shingle"]).alias("rare")
    )


def links(texts: DataFrame, docs: DataFrame, size: int, similarity: float) -> DataFrame:
    """(a, b): confirmed links that connect all similar texts found, through leaders where they can.

    ``texts`` has (text, same, place, f1, f2, witnesses) of the distinct texts of ``docs``.
    """
    keys = _keys(texts)
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("home").alias("any")).where("n > 1 and any")
    fingers = texts.select(F.col("text").alias("of"), "f1", "f2")
    held = keys.join(shared.select("key"), "key", "left_semi").join(fingers, F.col("text") == F.col("of")).drop("of")
    held = stage(held, "held")
    leaders = (
        held.join(_majority(held), "key")
        .where("home")
        .groupBy("key")
        .agg(F.min(F.struct(_apart("f1", "f2", "m1", "m2").alias("bits"), "text"))["text"].alias("leader"))
    )
    met = stage(held.select("key", "text", "home").join(leaders, "key"), "met")
    members = met.select(F.col("text").alias("member")).distinct()
    wanted = texts.join(members, F.col("text") == F.col("member"), "left_semi").select("text", "same", "place")
    sets = shingle_sets(docs, stage(wanted, "wanted"), size)

    def with_fingers(rows: DataFrame, name: str, prefix: str) -> DataFrame:
        named = fingers.select(*[F.col(c).alias(f"{prefix}{c}") for c in fingers.columns])
        return rows.join(named, F.col(name) == F.col(f"{prefix}of")).drop(f"{prefix}of")

    # Of the leaders of its keys every text meets the nearest one and the one that most texts are near to.
    first = met.where("text != leader").select("leader", "text").distinct()
    first = with_fingers(with_fingers(first, "leader", "l_"), "text", "r_").where(_near("l_", "r_"))
    first = stage(first.select("text", "leader", _apart("l_f1", "l_f2", "r_f1", "r_f2").alias("bits")), "first")
    followed = first.groupBy(F.col("leader").alias("led_by")).agg((-F.count(F.lit(1))).alias("less"))
    first = first.join(followed, F.col("leader") == F.col("led_by")).groupBy("text").agg(
        F.array_distinct(
            F.array(F.min(F.struct("bits", "leader"))["leader"], F.min(F.struct("less", "bits", "leader"))["leader"])
        ).alias("leaders")
    )
    first = first.select("text", F.explode("leaders").alias("leader"))
    starred = stage(
        confirmed(first.select(F.least("leader", "text").alias("a"), F.greatest("leader", "text").alias("b")), sets, similarity),
        "starred",
    )
    groups = components(starred).select(F.col("node").alias("of"), F.col("component").alias("group"))

    def group_of(rows: DataFrame, name: str, to: str) -> DataFrame:
        found = groups.select(F.col("of").alias("__of"), F.col("group").alias("__group"))
        joined = rows.join(found, F.col(name) == F.col("__of"), "left")
        return joined.withColumn(to, F.coalesce("__group", F.col(name))).drop("__of", "__group")

    grouped = with_fingers(group_of(group_of(met, "text", "mine"), "leader", "its"), "text", "")
    grouped = stage(grouped, "grouped")
    open_keys = grouped.where("mine != its").select("key").distinct()
    contested = stage(grouped.join(open_keys, "key", "left_semi"), "contested")
    compared = stage(sets.join(contested.select("text").distinct(), "text", "left_semi"), "compared")
    contested = contested.join(stage(rarest(compared, similarity), "rarest"), F.col("text") == F.col("of")).drop("of")
    columns = ("key", "text", "home", "mine", "f1", "f2", "n", "rare")
    least = _least_shared("o_n", "n", similarity)
    leading = lambda p: F.slice(f"{p}rare", 1, F.greatest(F.col(f"{p}n") - least + 1, F.lit(0)).cast("int"))
    others = contested.where("mine != its").select(*[F.col(c).alias(f"o_{c}") for c in columns])
    rest = contested.select(*columns, (F.col("mine") != F.col("its")).alias("is_other"))
    pairs = others.join(
        rest,
        (F.col("o_key") == F.col("key"))
        & (F.col("o_mine") != F.col("mine"))
        & (F.col("o_home") | F.col("home"))
        & (~F.col("is_other") | (F.col("o_text") < F.col("text")))
        & _near("o_", "")
        & F.arrays_overlap(leading("o_"), leading("")),
    )
    crossed = confirmed(pairs.select(F.least("o_text", "text").alias("a"), F.greatest("o_text", "text").alias("b")), sets, similarity)
    return starred.union(crossed)


def groups(docs: DataFrame, size: int = 5, similarity: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(row, doc_id, same) of every row, and (same, text, component, first) of every distinct text.

    ``first`` orders texts and rows: known ids first, the smallest leading.
    """
    marked = stage(marks(docs, size), "marks")
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row")
    texts = marked.groupBy("same").agg(
        F.min("row").alias("text"),
        F.min(order).alias("first"),
        F.min_by("place", order).alias("place"),
        *[F.min(c).alias(c) for c in ("f1", "f2", *[f"w{k}" for k in range(WITNESSES)])],
    )
    texts = stage(texts, "texts")
    linked = stage(links(texts, docs, size, similarity), "links")
    found = components(linked).select(F.col("node").alias("of"), "component")
    named = texts.join(found, F.col("text") == F.col("of"), "left").select(
        "same", "text", F.coalesce("component", "text").alias("component"), "first"
    )
    return marked.select("row", "doc_id", "same"), stage(named, "classes")


def near_copies(docs: DataFrame, size: int = 5, similarity: float = 0.8) -> DataFrame:
    """(doc_id, component_id) of every row: the smallest id of its group of near copies.

    Near copies are texts whose sets of word shingles (in lower case, A-Z) have at least that Jaccard similarity,
    and those connected through such. A shorter text is one shingle; texts without words are copies of each
    other. Repeated rows stay; null ids name no group unless it has no other; other columns are ignored; an
    empty table gives no rows.
    """
    rows, classes = groups(docs, size, similarity)
    least = classes.groupBy("component").agg(F.min("first")["doc_id"].alias("component_id"))
    return rows.join(classes.join(least, "component").select("same", "component_id"), "same").select("doc_id", "component_id")


def deduplicated(docs: DataFrame, size: int = 5, similarity: float = 0.8) -> DataFrame:
    """One row of each group of near copies, with all columns of ``docs``: that of the smallest id.

    Of several rows with that id and equal words one stays, and groups without an id keep one row each.
    """
    rows, classes = groups(docs, size, similarity)
    keepers = classes.groupBy("component").agg(F.min(F.struct("first", "same")).alias("k"))
    keepers = keepers.select(F.col("k.first.doc_id").alias("__id"), F.col("k.same").alias("__of"))
    copies = (
        rows.join(keepers, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("same") == F.col("__of")))
        .groupBy("__id", "__of")
        .agg(F.count(F.lit(1)).alias("__rows"))
    )
    columns = [F.col(f"`{c}`") for c in docs.columns]
    named = append_column(docs, "text", "__same", "binary", lambda texts: list(map(_same, texts)))
    kept = named.join(
        copies, (F.col("__same") == F.col("__of")) & F.col("doc_id").cast("long").eqNullSafe(F.col("__id"))
    )
    # Only keepers that are repeated rows are shuffled once more.
    once = kept.where("__rows = 1").select(columns)
    return once.union(kept.where("__rows > 1").dropDuplicates(["__of"]).select(columns))
