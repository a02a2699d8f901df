"""Benchmark decontamination by Wu-Manber search over words.

Patterns are windows of ``window`` consecutive item words (a shorter item is one pattern). Patterns of
one length share a table: the last two words of the scan position give a shift, which skips all
positions where no pattern can end; shift zero leads to the bucket of that ending, split by the first
words, and every pattern there is compared directly. The benchmark is a query set: it is
brought to the executors in blocks of at most ``block`` patterns, and each block scans all documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from keepsake.llm.common import map_arrow, map_rows
from keepsake.sources.staging import stage

# Lower case for A-Z; ASCII bytes other than 0-9 and letters part words; all others belong to words.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
RESULT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
CARRIED = "doc_id long, text string, spans array<long>, items array<string>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def item_windows(text: str | None, window: int) -> Iterator[tuple[bytes, ...]]:
    words = words_of(text)
    for at in range(max(1, len(words) - window + 1) if words else 0):
        yield tuple(words[at : at + window])


class WuManber:
    """Patterns of one length. ``find`` yields the end of every occurrence and the pattern's items."""

    def __init__(self, patterns: dict[tuple[bytes, ...], set[str]]):
        self.m = m = len(next(iter(patterns)))
        self.b = b = min(2, m)
        self.skip = m - b + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.bucket: dict[tuple[bytes, ...], dict[tuple[bytes, ...], list]] = {}
        for p, items in patterns.items():
            for end in range(b, m + 1):
                block = p[end - b : end]
                self.shift[block] = min(self.shift.get(block, self.skip), m - end)
            self.bucket.setdefault(p[m - b :], {}).setdefault(p[:b], []).append((p, items))

    def find(self, words: list[bytes]) -> Iterator[tuple[int, set[str]]]:
        m, b, skip, shift, n = self.m, self.b, self.skip, self.shift, len(words)
        end = m
        while end <= n:
            ending = tuple(words[end - b : end])
            step = shift.get(ending, skip)
            if step:
                end += step
                continue
            begin = tuple(words[end - m : end - m + b])
            for p, items in self.bucket[ending].get(begin, ()):
                if p == tuple(words[end - m : end]):
                    yield end, items
            end += 1


def searchers(patterns: dict[tuple[bytes, ...], set[str]]) -> list[WuManber]:
    by_length: dict[int, dict] = {}
    for p, items in patterns.items():
        by_length.setdefault(len(p), {})[p] = items
    return [WuManber(by_length[m]) for m in sorted(by_length)]


def _blocks(benchmark: DataFrame, window: int, block: int) -> Iterator[dict[tuple[bytes, ...], set[str]]]:
    held: dict[tuple[bytes, ...], set[str]] = {}
    for item_id, text in benchmark.select("item_id", "text").toLocalIterator():
        for p in item_windows(text, window):
            held.setdefault(p, set())
            if item_id is not None:
                held[p].add(str(item_id))
            if len(held) >= block:
                yield held
                held = {}
    yield held  # also when empty: the last pass gives the result


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def scan(docs: DataFrame, benchmark: DataFrame, window: int = 10, block: int = 200_000) -> DataFrame:
    """(doc_id, n_words, spans, items) per document row: hit word ranges [from, to) and item ids.

    Null or wordless texts have no hits; null items match nothing, an item without an id is hit but
    not listed; repeated rows give a row each. An empty benchmark hits nothing.
    """
    spark = docs.sparkSession
    out = "doc_id long, n_words long, spans array<long>, items array<string>"
    carried, blocks = None, _blocks(benchmark, window, block)
    patterns = next(blocks)
    while patterns is not None:
        following = next(blocks, None)
        sent = spark.sparkContext.broadcast(patterns)
        last = following is None

        def rows(taken: Iterable[tuple], sent=sent, last=last) -> Iterator[tuple]:
            tables = searchers(sent.value)
            for doc_id, text, *before in taken:
                flat, items = (list(before[0]), set(before[1])) if before else ([], set())
                spans = list(zip(flat[::2], flat[1::2], strict=True))
                words = words_of(text)
                for table in tables:
                    for end, found in table.find(words):
                        spans.append((end - table.m, end))
                        items |= found
                flat = [x for s in merged(spans) for x in s]
                yield (doc_id, len(words) if last else text, flat, sorted(items))

        source = docs.select("doc_id", "text") if carried is None else carried
        carried = map_rows(source, out if last else CARRIED, rows)
        carried = carried if last else stage(carried, "scanned")
        patterns = following
    return carried


def digest(scanned: DataFrame) -> DataFrame:
    """Counts and the item digest of every scanned row."""

    def rows(taken: Iterable[tuple]) -> Iterator[tuple]:
        for doc_id, n_words, spans, items in taken:
            n_hit = sum(spans[1::2]) - sum(spans[::2])
            named = hashlib.sha256(",".join(items).encode()).hexdigest()
            yield doc_id, n_words, n_hit, len(items), named, n_hit > 0

    return map_rows(scanned, RESULT, rows)


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 10, block: int = 200_000) -> DataFrame:
    """The rows of ``docs``, with all columns, in which no benchmark window occurs."""
    spark = docs.sparkSession
    blocks = _blocks(benchmark, window, block)
    patterns = next(blocks)
    while patterns is not None:
        following = next(blocks, None)
        sent = spark.sparkContext.broadcast(patterns)

        def run(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            tables = searchers(sent.value)
            for b in batches:
                texts = map(words_of, b.column("text").to_pylist())
                free = [not any(next(t.find(words), None) for t in tables) for words in texts]
                yield b.filter(pa.array(free, pa.bool_()))

        docs = map_arrow(docs, run, docs.schema)
        docs = docs if following is None else stage(docs, "clean")
        patterns = following
    return docs
