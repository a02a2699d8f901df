"""Quality classifier by co-training: one classifier reads the text, another the metadata.

Each is a logistic regression. Over some rounds each marks the unlabelled texts it is surest of, and the other
learns from those marks. Both are then calibrated on labelled rows they did not learn from, and
their log odds are added. A document is good if it is labelled of quality and not toxic.

Learning sees at most ``MAX_LABELLED`` labelled documents, by least hash of the id. Every round each view
reads all other documents in the cluster, and the ``PER_ROUND`` surest of all of each class are marked; only
features of labelled and marked ones reach the driver. Models are of fixed size.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructType

from keepsake.llm.common import READ_ROWS, map_arrow, map_rows, shared_object
from keepsake.llm.decontaminate import words_of
from keepsake.sources.staging import stage

MAX_LABELLED = 6000
ROUNDS = 3
SURE = 0.98
PER_ROUND = 150
TELLING = 4.0
THRESHOLD = 0.25  # documents that are probably bad go, those in doubt stay
TEXT_SLOTS = 1 << 15
META_SLOTS = 1 << 11
SHAPES = 9
_SYMBOLS = str.maketrans("", "", "#*$%&|<>")


def text_slots(text: str | None) -> list[int]:
    """The slots of the distinct words."""
    return sorted({zlib.crc32(w) % TEXT_SLOTS for w in set(words_of(text))})


def shapes(text: str | None) -> list[float]:
    """How the text looks: length, symbols, capitals, shouting, repeated lines and words, digits."""
    text = text or ""
    words = text.split()
    n, chars = max(1, len(words)), max(1, len(text))
    lines = [x for x in text.split("\n") if x.strip()]
    capitals = sum(map(str.isupper, words)) / n
    follow = sum(a == b for a, b in zip(words, words[1:], strict=False)) / n
    return [
        math.log1p(len(words)) / 5,
        min(2.0, (len(text) - len(text.translate(_SYMBOLS))) / n) * 2,
        capitals * 4,
        min(1.0, text.count("!!") / n) * 4,
        (len(lines) - len(set(lines))) / max(1, len(lines)) * 4,
        follow * 4,
        len(set(words)) / n,
        abs(len(text) / n - 6) / 6,
        min(1.0, 10 * sum(map(text.count, "0123456789")) / chars),
    ]


def meta_slots(lang: str | None, source: str | None, n_chars: int | None) -> list[int]:
    size = "none" if n_chars is None else str(int(2 * math.log2(max(1, n_chars))))
    facts = (f"lang {lang}", f"source {source}", f"size {size}", f"lang {lang} size {size}")
    return sorted({zlib.crc32(f.encode("utf-8", "surrogatepass")) % META_SLOTS for f in facts})


@dataclass
class View:
    """Weights of slots and of dense features; ``slope`` and ``shift`` calibrate the log odds."""

    slots: np.ndarray
    dense: np.ndarray
    bias: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, slots: list[int], dense: list[float]) -> float:
        return self.bias + float(self.slots[slots].sum()) + float(self.dense @ np.array(dense))

    def log_odds(self, slots: list[int], dense: list[float]) -> float:
        return self.slope * self.raw(slots, dense) + self.shift


@dataclass
class Rows:
    slots: list[list[int]]
    dense: list[list[float]]
    good: list[float]


def telling(slots: list[list[int]], y: np.ndarray, size: int) -> np.ndarray:
    """Which slots occur at rates that differ between the classes by ``TELLING`` standard errors."""
    rates, spread = [], 0.0
    for mark in (0.0, 1.0):
        rows = [s for s, g in zip(slots, y, strict=True) if g == mark]
        seen = np.bincount(np.fromiter((k for s in rows for k in s), np.int64), minlength=size)
        rate = (seen + 0.5) / (len(rows) + 1)
        rates.append(rate)
        spread = spread + rate * (1 - np.minimum(rate, 1 - 1e-9)) / (len(rows) + 1)
    return np.abs(rates[1] - rates[0]) > TELLING * np.sqrt(spread)


def fit(rows: Rows, size: int, dense_size: int, steps: int = 300, decay: float = 0.5) -> View:
    """Logistic regression by Adam over all rows at once, on slots that tell the classes apart."""
    y = np.array(rows.good)
    if not len(y) or y.min() == y.max():
        return View(np.zeros(size), np.zeros(dense_size), 6.0 if len(y) and y.max() > 0 else 0.0)
    chosen = np.flatnonzero(telling(rows.slots, y, size))
    number = np.full(size, -1)
    number[chosen] = np.arange(len(chosen))
    # Only the slots that a row has are held, as (row, slot) pairs.
    at = [number[slots] for slots in rows.slots]
    col = np.concatenate([a[a >= 0] for a in at])
    row = np.repeat(np.arange(len(y)), [int((a >= 0).sum()) for a in at])
    dense = np.column_stack([np.array(rows.dense).reshape(len(y), dense_size), np.ones(len(y))])
    n = len(chosen)
    params = np.zeros(n + dense_size + 1)
    first, second = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        odds = np.bincount(row, params[col], len(y)) + dense @ params[n:]
        miss = 1 / (1 + np.exp(-np.clip(odds, -30, 30))) - y
        grad = np.concatenate([np.bincount(col, miss[row], n), dense.T @ miss])
        grad[:-1] += decay * params[:-1]
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad * grad
        params -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
    weights = np.zeros(size)
    weights[chosen] = params[:n]
    return View(weights, params[n:-1], float(params[-1]))


def calibrate(view: View, rows: Rows, steps: int = 300) -> View:
    """Slope and shift that fit the log odds to ``rows``, held back from learning."""
    y = np.array(rows.good)
    if len(y) < 20 or y.min() == y.max():
        return view
    z = np.array([view.raw(s, d) for s, d in zip(rows.slots, rows.dense, strict=True)])
    centre, spread = z.mean(), max(z.std(), 1e-6)
    u = (z - centre) / spread
    a, b = 1.0, 0.0
    for _ in range(steps):
        miss = 1 / (1 + np.exp(-np.clip(a * u + b, -30, 30))) - y
        a, b = a - 2.0 * ((miss * u).mean() + 1e-4 * a), b - 2.0 * miss.mean()
    a = max(a, 0.0)
    view.slope, view.shift = a / spread, b - a * centre / spread
    return view


@dataclass
class Model:
    text: View
    meta: View
    prior: float

    def good(self, text: str | None, lang: str | None, source: str | None, n_chars: int | None) -> float:
        """The probability that the document is good."""
        odds = self.text.log_odds(text_slots(text), shapes(text))
        odds += self.meta.log_odds(meta_slots(lang, source, n_chars), []) - self.prior
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))


def _features(docs: DataFrame) -> DataFrame:
    def rows(taken: Iterable[tuple]) -> Iterator[tuple]:
        for doc_id, mark, text, lang, source, n_chars in taken:
            yield doc_id, mark, text_slots(text), shapes(text), meta_slots(lang, source, n_chars)

    inputs = ["text", "lang", "source", F.col("n_chars").cast("long").alias("n_chars")]
    picked = docs.where("doc_id is not null").select("doc_id", *inputs)
    marked = picked.select("doc_id", F.xxhash64("text", "lang", "source", "n_chars").alias("mark"), *picked.columns[1:])
    return map_rows(marked, "doc_id long, mark long, slots array<int>, shapes array<double>, meta array<int>", rows, 200)


def _picked(features: DataFrame, ids: Iterable[int]) -> list[tuple]:
    """(doc_id, slots, shapes, meta) by id. Copies of one id are one row, whichever has the smallest mark."""
    wanted = features.sparkSession.createDataFrame([(d,) for d in ids], "doc_id long")
    one = (
        features.join(F.broadcast(wanted), "doc_id", "left_semi")
        .groupBy("doc_id")
        .agg(F.min_by(F.struct("slots", "shapes", "meta"), "mark").alias("d"))
        .select("doc_id", "d.*")
    )
    return sorted(map(tuple, one.collect()))


def _odds(features: DataFrame, views: dict[str, View]) -> DataFrame:
    """(doc_id, text, meta): the log odds of both views, one row an id."""
    sent = shared_object(features.sparkSession, views)

    def flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        ends = lists.offsets.to_numpy()
        return np.diff(ends), lists.values.to_numpy()[ends[0] : ends[-1]]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sent()
        for b in batches:
            out = [b.column("doc_id"), b.column("mark")]
            for name, source in (("text", "slots"), ("meta", "meta")):
                view = held[name]
                sizes, slots = flat(b.column(source))
                row = np.repeat(np.arange(b.num_rows), sizes)
                raw = view.bias + np.bincount(row, view.slots[slots], b.num_rows)
                if len(view.dense):
                    raw += (flat(b.column("shapes"))[1].reshape(b.num_rows, -1) * view.dense).sum(1)
                out.append(pa.array(view.slope * raw + view.shift))
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "mark", "text", "meta"])

    odds = map_arrow(features, run, "doc_id long, mark long, text double, meta double")
    return odds.groupBy("doc_id").agg(F.min_by(F.struct("text", "meta"), "mark").alias("o")).select("doc_id", "o.*")


def surest(features: DataFrame, views: dict[str, View], used: set[int]) -> list[tuple[str, float, list[int]]]:
    """(teacher, mark, ids): of all documents but the ``used`` those each view is surest of, surest first."""
    gone = features.sparkSession.createDataFrame([(d,) for d in used], "doc_id long")
    sure = math.log(SURE / (1 - SURE))
    rest = _odds(features, views).join(F.broadcast(gone), "doc_id", "left_anti")
    rest = stage(rest.where((F.abs("text") >= sure) | (F.abs("meta") >= sure)), "odds")
    out = []
    for teacher in ("text", "meta"):
        for mark, odds in ((1.0, F.col(teacher)), (0.0, -F.col(teacher))):
            first = rest.where(odds >= sure).orderBy(odds.desc(), "doc_id").limit(PER_ROUND)
            out.append((teacher, mark, [r["doc_id"] for r in first.select("doc_id").collect()]))
    return out


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    """Co-trained, calibrated views. Labels without an id or a quality are left out; of copies of a
    label the worst counts. Without labels of both kinds everything is good.
    """
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    marked = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.min(((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("int")).alias("good"))
        .orderBy(*by_hash)
        .limit(max_labelled)
    )
    good = {r["doc_id"]: float(r["good"]) for r in marked.collect()}
    # A round needs odds of all documents; words are cut once.
    features = stage(_features(docs), "features")
    learn, check = [], []
    for row in _picked(features, good):
        (check if zlib.crc32(b"%d" % row[0]) % 4 == 0 else learn).append(row)

    def rows_of(picked: list[tuple], view: str) -> Rows:
        if view == "text":
            return Rows([r[1] for r in picked], [r[2] for r in picked], [good[r[0]] for r in picked])
        return Rows([r[3] for r in picked], [[] for _ in picked], [good[r[0]] for r in picked])

    sets = {v: rows_of(learn, v) for v in ("text", "meta")}
    tests = {v: rows_of(check, v) for v in ("text", "meta")}
    sizes = {"text": (TEXT_SLOTS, SHAPES), "meta": (META_SLOTS, 0)}
    views = {v: calibrate(fit(sets[v], *sizes[v]), tests[v]) for v in sets}
    used = set(good)
    for _ in range(ROUNDS):
        marked_now = surest(features, views, used)
        taken = {d for _, _, ids in marked_now for d in ids}
        if not taken:
            break
        rows = {r[0]: r for r in _picked(features, taken)}
        for teacher, mark, ids in marked_now:
            pupil = "meta" if teacher == "text" else "text"
            for r in map(rows.get, ids):
                sets[pupil].slots.append(r[1] if pupil == "text" else r[3])
                sets[pupil].dense.append(r[2] if pupil == "text" else [])
                sets[pupil].good.append(mark)
        used |= taken
        views = {v: calibrate(fit(sets[v], *sizes[v]), tests[v]) for v in sets}
    share = (sum(good.values()) + 1) / (len(good) + 2)
    return Model(views["text"], views["meta"], math.log(share / (1 - share)))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD, score_as: str = "score", keep_as: str = "kept") -> DataFrame:
    """``docs`` with the probability of being good and whether it reaches ``threshold``.

    Null texts and metadata have features of their own and are scored like others; repeated rows
    score alike; of clashing columns the new ones stay.
    """
    sent = shared_object(docs.sparkSession, model)
    columns = [c for c in docs.columns if c not in (score_as, keep_as)]
    inputs = ["text", "lang", "source", "n_chars"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good = sent().good
        for b in batches:
            scores: list[float] = []
            for at in range(0, b.num_rows, READ_ROWS):
                part = b.slice(at, READ_ROWS)
                scores += map(good, *(part.column(c).to_pylist() for c in inputs))
            new = [pa.array(scores, pa.float64()), pa.array([s >= threshold for s in scores], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in columns), *new], names=[*columns, score_as, keep_as])

    schema = StructType([docs.schema[c] for c in columns]).add(score_as, DoubleType()).add(keep_as, BooleanType())
    return map_arrow(docs.select([F.col(f"`{c}`") for c in columns]), run, schema)
