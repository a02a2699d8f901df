import math
from collections import Counter

import pytest

from keepsake.llm import lattice_lm

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("piece_bpe_32k.model")


def all_segmentations(lattice, text):
    if not text:
        return 1.0
    total = 0.0
    for k in range(1, len(text) + 1):
        piece = text[:k]
        if piece in lattice.scores:
            total += math.exp(lattice.scores[piece]) * all_segmentations(lattice, text[k:])
        elif k == 1:
            p = math.exp(sum(lattice.byte_scores[b] for b in piece.encode()))
            total += p * all_segmentations(lattice, text[1:])
    return total


def test_marginal_is_the_sum_over_segmentations():
    pieces = {"▁": -2.0, "▁a": -1.5, "a": -2.5, "b": -2.0, "ab": -1.0, "ba": -1.7, "aba": -4.0, "▁ab": -3.0}
    lattice = lattice_lm.Lattice(pieces, [-6.0] * 256)
    for word in ("a", "ab", "abab", "bé", "aabbaba", "漢b"):
        want = math.log10(all_segmentations(lattice, "▁" + word))
        assert abs(lattice.log10(word) - want) < 1e-9
    assert math.isfinite(lattice.log10("ab" * 20_000))


@pytest.mark.parametrize("chunk_bytes", [24 << 20, 2000])
def test_scores(spark, docs, corpus, chunk_bytes):
    out = lattice_lm.score(docs, PATH, chunk_bytes).collect()
    count = Counter()
    tokens = [(d, [*(t or "").encode().lower().split(), b"\n"]) for d, t in corpus]
    for d, words in tokens:
        if not lattice_lm.held_out(d):
            count.update(words)
    total, distinct = sum(count.values()), len(count)
    table = spark.createDataFrame([(w.decode(), c) for w, c in count.items()], "word string, c long")
    lattice, end = lattice_lm.piece_scores(table, PATH)
    want = []
    for d, words in tokens:
        base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in words)
        model = sum(end if w == b"\n" else lattice.log10(w.decode()) for w in words)
        known = sum(count[w] > 0 for w in words)
        want.append((d, lattice_lm.held_out(d), len(words), known, total, round(base, 6), round(model, 6)))
    got = [(*tuple(r)[:5], round(r["base_score"], 6), round(r["score"], 6)) for r in out]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    mass = sum(map(math.exp, lattice.scores.values())) + sum(map(math.exp, lattice.byte_scores)) + 10**end
    assert abs(mass - 1) < 1e-6


def test_nothing(no_docs):
    assert lattice_lm.score(no_docs, PATH).count() == 0
