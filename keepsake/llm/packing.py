"""Best-fit packing: length patterns fitted to the histogram by non-negative least squares.

Only the histogram of piece lengths (at most ``max_len`` counts) reaches the driver. The plan made
from it names, for every length, which rank goes to which sequence and place; pieces learn their
rank in the cluster and look their place up. The plan's size depends on ``max_len`` alone.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keepsake.llm.common import kept_by_worker, map_arrow, map_rows, release_memory, width
from keepsake.sources.staging import stage

CACHED_WORDS = 150_000
CACHED_PARTS = 10_000
LONGEST_CACHED = 48
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

# Words of these characters are split and put in lower case here as the vocabulary's file says;
# words with others are left to the tokenizer as they are.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


# Byte-level vocabularies write printable bytes as themselves and the others from 256 on, in order.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LETTERS = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


class WordTokenizer:
    """Token ids as little-endian bytes; words and word parts seen before are not encoded again.

    The vocabulary's pre-tokenizer never joins across white space, so the ids of a text are those of
    its words, and those of a word are those of its parts. Texts with added tokens, or with control
    characters on which notions of white space differ, are encoded whole. When a memory reaches its bound it
    becomes the older one, from which what occurs again comes back; ``forget`` empties all at the end of a task.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        added = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.whole = [*added, "\x1c", "\x1d", "\x1e", "\x1f"]
        self.merges = self.model.model.tokenize
        self.empty()

    def empty(self) -> None:
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.older_words: dict[str, bytes] = {}
        self.older_parts: dict[str, bytes] = {}

    def forget(self) -> None:
        self.empty()
        release_memory()

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.model.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _part(self, part: str) -> bytes:
        """Ids of a part of a plain word: its UTF-8 bytes, as the vocabulary writes them, to the model."""
        letters = part if part.isascii() else part.encode().decode("latin-1").translate(_BYTE_LETTERS)
        return array("I", [t.id for t in self.merges(letters)]).tobytes()

    def _word(self, word: str) -> bytes:
        parts, older, out = self.parts, self.older_parts, []
        for p in _PARTS.findall(word.lower()):
            ids = parts.get(p)
            if ids is None:
                ids = older.get(p) or self._part(p)
                if len(p) <= LONGEST_CACHED:
                    parts[p] = ids
            out.append(ids)
        return out[0] if len(out) == 1 else b"".join(out)

    def ids(self, text: str) -> bytes:
        if any(w in text for w in self.whole):
            return self._encode([text])[0]
        words, known = text.split(), self.words
        found = list(map(known.get, words))
        try:
            return b"".join(found)
        except TypeError:  # words not seen before
            pass
        if len(known) > CACHED_WORDS:
            self.older_words, self.words = known, {}
            known = self.words
        if len(self.parts) > CACHED_PARTS:
            self.older_parts, self.parts = self.parts, {}
        older = self.older_words
        fresh: dict[str, bytes] = {}
        for n, ids in enumerate(found):
            if ids is None:
                w = words[n]
                ids = fresh.get(w)
                if ids is None:
                    ids = older.get(w) or (self._word(w) if _PLAIN.fullmatch(w) else self._encode([w])[0])
                    fresh[w] = ids
                    if len(w) <= LONGEST_CACHED:
                        known[w] = ids
                found[n] = ids
        return b"".join(found)


def tokenizer(path: str) -> WordTokenizer:
    """The tokenizer that this worker process keeps between tasks."""
    return kept_by_worker(("word tokenizer", path), lambda: WordTokenizer(path))


def document_pieces(
    docs: DataFrame, tokenizer_path: str, max_len: int = 2048, end_id: int = 0, with_ids: bool = False
) -> DataFrame:
    """Each document as token ids and ``end_id``, cut into pieces of ``max_len`` where it is longer.

    A null or empty text is the one id ``end_id``. Repeated rows each give their own pieces.
    """
    end = np.array([end_id], "<u4").tobytes()
    step = 4 * max_len

    def rows(taken):
        words = tokenizer(tokenizer_path)
        try:
            for doc_id, text in taken:
                ids = words.ids(text or "") + end
                for n, at in enumerate(range(0, len(ids), step)):
                    cut = ids[at : at + step]
                    row = (doc_id, n, at // 4, len(cut) // 4, zlib.crc32(cut))
                    yield (*row, cut) if with_ids else row
        finally:
            words.forget()

    return map_rows(docs.select("doc_id", "text"), PIECES + (", ids binary" if with_ids else ""), rows)


def _patterns(present: np.ndarray, max_len: int) -> np.ndarray:
    """All exact fills by one, two or three present lengths, as rows (a, b, c); 0 means no piece."""
    here = np.flatnonzero(present)
    two = here[(here <= max_len - here) & present[max_len - here]] if len(here) else here
    found = [np.stack([two, max_len - two, np.zeros_like(two)], 1)]
    for a in here[3 * here <= max_len]:
        b = here[(here >= a) & (2 * here <= max_len - a)]
        b = b[present[max_len - a - b]]
        found.append(np.stack([np.full_like(b, a), b, max_len - a - b], 1))
    return np.concatenate(found)


def _fit(patterns: np.ndarray, counts: np.ndarray, rounds: int) -> np.ndarray:
    """Repeat counts x >= 0 of least ||A x - counts||, by accelerated projected gradients."""
    n = len(counts)

    def apply(x: np.ndarray) -> np.ndarray:
        out = sum(np.bincount(patterns[:, k], x, n) for k in range(3))
        out[0] = 0
        return out

    used = np.bincount(patterns.ravel(), minlength=n).astype(float)
    used[0] = 0
    # A row sum bound on A'A: three lengths, each shared with the patterns that use it.
    step = 1 / max(1.0, 3 * used.max())
    x = momentum = np.zeros(len(patterns))
    t = 1.0
    for _ in range(rounds):
        miss = apply(momentum) - counts
        miss[0] = 0
        new = np.maximum(0, momentum - step * miss[patterns].sum(1))
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        momentum = new + (t - 1) / after * (new - x)
        x, t = new, after
    return x


def packing_plan(counts: np.ndarray, max_len: int, rounds: int = 150) -> tuple[np.ndarray, int]:
    """Where pieces go, by length and rank, and the number of sequences.

    ``counts[n]`` pieces have length n. Rows of the plan: length, first rank, sequence of that rank,
    offset, pieces of this row in one sequence; the next row of the length ends it. Patterns that
    fill a sequence exactly get repeat counts by least squares, first all of them, then the strongest
    ``4 * max_len`` again; counts are rounded to what is there. What is left goes best fit
    decreasing, whole lengths at a time. At most about ``20 * max_len`` rows whatever the counts.
    """
    left = counts.astype(np.int64).copy()
    rank = np.zeros(max_len + 1, np.int64)
    rows: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def place(length: int, bins: int, first: int, offset: int, each: int = 1) -> None:
        rows.append((length, int(rank[length]), first, offset, each))
        rank[length] += bins * each
        left[length] -= bins * each

    if left[max_len]:
        n = int(left[max_len])
        place(max_len, n, 0, 0)
        sequences += n
    patterns = _patterns(left > 0, max_len)
    if len(patterns):
        scale = float(left.max())
        wanted = left / scale
        x = _fit(patterns, wanted, rounds)
        if len(patterns) > 4 * max_len:
            patterns = patterns[np.argsort(-x, kind="stable")[: 4 * max_len]]
            x = _fit(patterns, wanted, 2 * rounds)
        for k in np.argsort(-x, kind="stable"):
            kinds, times = np.unique(patterns[k][patterns[k] > 0], return_counts=True)
            n = int(min(round(x[k] * scale), (left[kinds] // times).min()))
            if n <= 0:
                continue
            at = 0
            for length, each in zip(kinds.tolist(), times.tolist(), strict=True):
                place(length, n, sequences, at, each)
                at += length * each
            sequences += n
    room: dict[int, list[tuple[int, int]]] = {}  # remaining capacity: runs (first sequence, how many)
    order: list[int] = []

    def keep(rest: int, first: int, bins: int) -> None:
        if rest and bins:
            if rest not in room:
                room[rest] = []
                insort(order, rest)
            room[rest].append((first, bins))

    for length in range(max_len, 0, -1):
        while left[length]:
            at = bisect_left(order, length)
            if at < len(order):
                rest = order[at]
                first, bins = room[rest].pop()
                if not room[rest]:
                    del room[rest], order[at]
            else:
                rest, first = max_len, sequences
                bins = -(-int(left[length]) // (max_len // length))
                sequences += bins
            each = rest // length
            full, some = divmod(int(left[length]), each)
            full = min(full, bins)
            if full:
                place(length, full, first, max_len - rest, each)
                keep(rest - each * length, first, full)
            if full < bins and left[length]:
                place(length, 1, first + full, max_len - rest, some)
                keep(rest - some * length, first + full, 1)
                full += 1
            keep(rest, first + full, bins - full)
    plan = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return plan, sequences


def pack(
    docs: DataFrame, tokenizer_path: str, max_len: int = 2048, end_id: int = 0, with_ids: bool = False
) -> DataFrame:
    """Pieces of all documents with ``sequence_id`` and ``offset``; each sequence is gapless from 0.

    Columns ``doc_id`` and ``text`` are read, others ignored. Tied pieces (equal length) may swap
    places; repeated rows are packed once each. An empty table gives no rows. One length that holds
    most pieces is ranked in as many salted parts as the session has shuffle partitions.
    """
    spark = docs.sparkSession
    pieces = document_pieces(docs, tokenizer_path, max_len, end_id, with_ids)
    old = pieces.columns
    # Copies of one row are told apart by their number only.
    pieces = stage(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(width(spark))))
    sizes = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    counts = np.zeros(max_len + 1, np.int64)
    for length, n in sizes.groupBy("length").agg(F.sum("n")).collect():
        counts[length] = n
    plan, _ = packing_plan(counts, max_len)
    keys = (plan[:, 0] << 44) + plan[:, 1]

    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "salt").orderBy("row")
    ranked = (
        salted.withColumn("at", F.row_number().over(within) - 1)
        .join(starts, ["length", "salt"])
        .withColumn("rank", F.col("before") + F.col("at"))
        .select(*old, "rank")
    )

    def rows(batches):
        for b in batches:
            length = b.column("length").to_numpy(zero_copy_only=False)
            rank = b.column("rank").to_numpy(zero_copy_only=False)
            row = plan[np.searchsorted(keys, (length << 44) + rank, "right") - 1]
            at, each = rank - row[:, 1], row[:, 4]
            new = [row[:, 2] + at // each, row[:, 3] + at % each * length]
            kept = [b.column(c) for c in old]
            yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, new)], names=[*old, "sequence_id", "offset"])

    columns = ", ".join(f"{c} {pieces.schema[c].dataType.simpleString()}" for c in old)
    return map_arrow(ranked, rows, f"{columns}, sequence_id long, offset long")
