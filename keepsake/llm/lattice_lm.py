"""Language-model scores: subword lattice likelihood beside a smoothed word model.

Pieces of an existing subword vocabulary get unigram scores from the training texts; a word's
probability is the sum over all its segmentations, found by a forward recursion in log space, and a
text's is the product over its words and one end symbol.

The work follows the number of distinct words, not of tokens. Each task turns about
``CHUNK_BYTES`` of text into a chunk: its distinct words, with training counts, and for each document the
word numbers. Words meet by word across chunks once to be counted and scored; the scores go back to
the chunks by number. A frequent word counts once for each chunk; a chunk is a bounded group.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepsake.llm.common import kept_by_worker, map_rows, shared_object
from keepsake.sources.staging import stage

CHUNK_BYTES = 24 << 20
END = "\n"  # no word holds white space
SPACE = "▁"
FOLDS, HELD_OUT_FOLD = 5, 1
RESULT = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)
CHUNKS = (
    "chunk long, words array<string>, counts array<long>, doc_ids array<long>, held array<boolean>, "
    "lengths array<long>, numbers array<binary>, times array<binary>"
)


def held_out(doc_id: int | None) -> bool:
    """By the id as text; a null id is in training."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_OUT_FOLD


def _pack(numbers: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(1).compress(numbers.astype("<u4").tobytes())


def _unpack(blob: bytes) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), "<u4")


def chunks(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row for each chunk. A text longer than a chunk is one by itself."""

    def rows(taken: Iterable[tuple]) -> Iterator[tuple]:
        part, made = TaskContext.get().partitionId(), 0
        known: dict[bytes, int] = {}
        counts: list[int] = []
        docs: list[tuple] = []
        size = 0

        def chunk() -> tuple:
            words = [w.decode("utf-8", "surrogatepass") for w in known]
            return ((part << 32) + made, words, counts, *map(list, zip(*docs, strict=True)))

        for doc_id, text in taken:
            raw = (text or "").encode("utf-8", "surrogatepass").lower()
            times = Counter(raw.split())
            times[END.encode()] = 1
            held = held_out(doc_id)
            numbers = np.array([known.setdefault(w, len(known)) for w in times], np.int64)
            often = np.array(list(times.values()), np.int64)
            counts += [0] * (len(known) - len(counts))
            if not held:
                for n, c in zip(numbers.tolist(), times.values(), strict=True):
                    counts[n] += c
            order = np.argsort(numbers)
            gaps = np.diff(numbers[order], prepend=0)
            docs.append((doc_id, held, int(often.sum()), _pack(gaps), _pack(often[order])))
            size += len(raw) + 64
            if size >= chunk_bytes:
                yield chunk()
                known, counts, docs, size, made = {}, [], [], 0, made + 1
        if docs:
            yield chunk()

    return map_rows(docs.select("doc_id", "text"), CHUNKS, rows, 1)


class Lattice:
    """Unigram scores of pieces, and the marginal log10 probability of a word over all segmentations.

    Single characters that are no piece are spelled in byte pieces, so every word has a segmentation.
    """

    def __init__(self, scores: dict[str, float], byte_scores: list[float]):
        self.scores, self.byte_scores = scores, byte_scores
        self.longest = max(map(len, scores), default=1)
        self.prefixes = {p[:k] for p in scores for k in range(1, len(p) + 1)}

    def log10(self, word: str) -> float:
        text, scores, prefixes = SPACE + word, self.scores, self.prefixes
        n, exp, log = len(text), math.exp, math.log
        arriving: list[list[float]] = [[] for _ in range(n + 1)]
        arriving[0].append(0.0)
        total = 0.0
        for i in range(n + 1):
            here = arriving[i]
            top = max(here)
            total = top if len(here) == 1 else top + log(sum([exp(x - top) for x in here]))
            arriving[i] = here = []
            if i == n:
                break
            if text[i] not in scores:
                spelled = sum(self.byte_scores[b] for b in text[i].encode("utf-8", "surrogatepass"))
                arriving[i + 1].append(total + spelled)
            for j in range(i + 1, min(n, i + self.longest) + 1):
                piece = text[i:j]
                if piece in scores:
                    arriving[j].append(total + scores[piece])
                elif piece not in prefixes:
                    break
        return total / log(10)


def _vocabulary(path: str):
    import sentencepiece

    return kept_by_worker(("pieces", path), lambda: sentencepiece.SentencePieceProcessor(model_file=path))


def piece_scores(words: DataFrame, model_path: str) -> tuple[Lattice, float]:
    """The lattice of the vocabulary at ``model_path``, and the log10 probability of the end symbol.

    A piece's score is its smoothed share among the pieces of all training words, each split by the
    vocabulary itself; one count for each piece reaches the driver.
    """

    def count(taken: Iterable[tuple]) -> Iterator[tuple]:
        model, found = _vocabulary(model_path), Counter()
        batch: list[tuple[str, int]] = []

        def add() -> None:
            split = model.encode([w for w, _ in batch], num_threads=1)
            for (_, c), pieces in zip(batch, split, strict=True):
                for p in pieces:
                    found[p] += c
            batch.clear()

        for word, c in taken:
            batch.append((word, c))
            if len(batch) == 5000:
                add()
        add()
        yield from found.items()

    trained = words.where((F.col("c") > 0) & (F.col("word") != END)).select("word", "c")
    sums = map_rows(trained, "piece int, c long", count).groupBy("piece").agg(F.sum("c").alias("c"))
    counted = {r["piece"]: r["c"] for r in sums.collect()}
    texts = words.where(F.col("word") == END).agg(F.sum("c")).first()[0] or 0
    model = _vocabulary(model_path)
    kept = [p for p in range(model.get_piece_size()) if not model.is_control(p) and not model.is_unknown(p)]
    total = math.log(sum(counted.get(p, 0) for p in kept) + texts + 0.5 * (len(kept) + 1))
    score = {p: math.log(counted.get(p, 0) + 0.5) - total for p in kept}
    by_byte = [score[model.piece_to_id(f"<0x{b:02X}>")] for b in range(256)]
    pieces = {model.id_to_piece(p): s for p, s in score.items() if not model.is_byte(p)}
    return Lattice(pieces, by_byte), (math.log(texts + 0.5) - total) / math.log(10)


def score(docs: DataFrame, model_path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Scores of every row, learned from the rows that are not held out.

    ``base_score`` sums log10 of smoothed word shares, ``score`` log10 of lattice probabilities. Null and
    empty texts are the end token alone; repeated rows count each time; an empty table gives no
    rows; without training rows every count is zero.
    """
    spark = docs.sparkSession
    cut = stage(chunks(docs, chunk_bytes), "chunks")
    listed = cut.select("chunk", F.posexplode(F.arrays_zip("words", "counts")).alias("n", "w"))
    words = stage(
        listed.groupBy(F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("c")), "words"
    )
    tokens, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    lattice, end = piece_scores(words, model_path)
    sent = shared_object(spark, lattice)

    def marginal(taken: Iterable[tuple]) -> Iterator[tuple]:
        log10 = sent().log10
        for word, c in taken:
            yield word, c, end if word == END else log10(word)

    scored = stage(map_rows(words, "word string, c long, lattice double", marginal, 20_000), "scored")
    wanted = cut.select("chunk", F.posexplode("words").alias("n", "of"))
    back = wanted.join(scored, F.col("of") == F.col("word")).select(F.col("chunk").alias("of_chunk"), "n", "c", "lattice")
    spread = math.log10(tokens + 0.5 * (distinct + 1))

    def finish(looked_up: pa.Table, chunk: pa.Table) -> pa.Table:
        n = looked_up.column("n").to_numpy()
        count, marginals = np.zeros(len(n), np.int64), np.zeros(len(n))
        count[n] = looked_up.column("c").to_numpy()
        marginals[n] = looked_up.column("lattice").to_numpy()
        shares = np.log10(count + 0.5) - spread
        (c,) = chunk.to_pylist()
        known, base, model = [], [], []
        for gaps, often in zip(c["numbers"], c["times"], strict=True):
            numbers, t = np.cumsum(_unpack(gaps).astype(np.int64)), _unpack(often).astype(np.int64)
            known.append(int(t[count[numbers] > 0].sum()))
            base.append(float(t @ shares[numbers]))
            model.append(float(t @ marginals[numbers]))
        size = len(known)
        fields = {
            "doc_id": pa.array(c["doc_ids"], pa.int64()),
            "held_out": pa.array(c["held"], pa.bool_()),
            "n_tokens": pa.array(c["lengths"], pa.int64()),
            "n_known": pa.array(known, pa.int64()),
            "train_tokens": pa.array([tokens] * size, pa.int64()),
            "base_score": pa.array(base, pa.float64()),
            "score": pa.array(model, pa.float64()),
        }
        return pa.table(fields)

    bodies = cut.select("chunk", "doc_ids", "held", "lengths", "numbers", "times")
    return back.groupBy("of_chunk").cogroup(bodies.groupBy("chunk")).applyInArrow(finish, RESULT)
