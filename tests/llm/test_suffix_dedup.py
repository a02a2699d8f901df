import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from keepsake.llm import suffix_dedup


def repeated(texts, length):
    """Masks of the removed bytes, by brute force."""
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        mask = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                mask[i : i + length] = True
        out.append(mask)
    return out


def mixture(rng):
    def some(n):
        return "".join(rng.choice("abcdefgh ") for _ in range(n))

    shared = [some(rng.randint(150, 500)) for _ in range(6)]
    texts = []
    for _ in range(50):
        parts = []
        for _ in range(rng.randint(1, 5)):
            kind = rng.random()
            if kind < 0.5:
                p = rng.choice(shared)
                a, b = (rng.randint(0, 120) if rng.random() < 0.6 else 0 for _ in range(2))
                parts.append(p[a : len(p) - b])
            elif kind < 0.6:
                parts.append(rng.choice("ab") * rng.randint(100, 600))
            elif kind < 0.7:
                parts.append(some(rng.randint(3, 40)) * rng.randint(5, 40))
            else:
                parts.append(some(rng.randint(1, 300)))
        texts.append("".join(parts))
    return [*texts, texts[0], texts[1][:250], "", None, "é" * 150, "é" * 90]


def check(spark, texts, **options):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.digest(rows, 200, **options).collect()}
    data = [(t or "").encode() for t in texts]
    for n, (d, mask) in enumerate(zip(data, repeated(data, 200), strict=True)):
        left = bytes(np.frombuffer(d, np.uint8)[~mask]) if d else b""
        runs = int((np.diff(np.concatenate(([0], mask.astype(int), [0]))) == 1).sum())
        assert got[n] == (len(d), int(mask.sum()), runs, hashlib.sha256(left).hexdigest()), n


@pytest.mark.parametrize("seed,options", [(0, {}), (1, {"segments": 4, "heavy": 0.5}), (2, {"segments": 7, "heavy": 0.1})])
def test_against_brute_force(spark, seed, options):
    check(spark, mixture(random.Random(seed)), **options)


def test_long_texts_are_read_in_parts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 64)
    check(spark, mixture(random.Random(3)))


def test_merge_reads_no_known_prefix(monkeypatch):
    rng = random.Random(1)
    keys = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 60))) for _ in range(300)]
    suffixes = [(k, b"", 0, 0, n) for n, k in enumerate(keys)]
    runs = [sorted(suffixes[n::7]) for n in range(7)] + [[]]
    known = []

    def counted(a, b, at=0, real=suffix_dedup.shared):
        known.append(at)
        assert a[:at] == b[:at]
        return real(a, b, at)

    coded = [iter(list(suffix_dedup.decode_run(suffix_dedup.encode_run(r)))) for r in runs]
    monkeypatch.setattr(suffix_dedup, "shared", counted)
    out = list(suffix_dedup.merge(coded))
    assert [s[0] for _, s in out] == sorted(keys) and sum(known) > 0
    for (_, a), (lcp, b) in zip(out, out[1:], strict=False):
        same = next((i for i, (x, y) in enumerate(zip(a[0], b[0], strict=False)) if x != y), min(len(a[0]), len(b[0])))
        assert lcp == same


def test_corpus_rows_and_columns(docs, corpus, as_rows):
    data = [(t or "").encode() for _, t in corpus]
    masks = repeated(data, 200)
    got = as_rows(suffix_dedup.digest(docs, 200), "doc_id", "n_bytes", "n_removed")
    assert got == sorted(((d, len(b), int(m.sum())) for (d, _), b, m in zip(corpus, data, masks, strict=True)), key=repr)
    cut = suffix_dedup.deduplicated(docs, 200)
    assert cut.schema == docs.schema
    wanted = []
    for (d, t), b, m in zip(corpus, data, masks, strict=True):
        left = bytes(np.frombuffer(b, np.uint8)[~m]).decode("utf-8", "ignore") if b else ""
        wanted.append((d, None if t is None else left, None if t is None else len(left)))
    assert as_rows(cut, "doc_id", "text", "n_chars") == sorted(wanted, key=repr)


def test_nothing(no_docs):
    assert suffix_dedup.digest(no_docs, 200).count() == 0
    assert suffix_dedup.deduplicated(no_docs, 200).count() == 0
