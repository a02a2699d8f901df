import random

import numpy as np

from keepsake.llm import similar_texts
from tests.llm.conftest import words


def shingle_sets(text, size=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def groups(rows, similarity=0.8):
    """All pairs compared: smallest known id reachable, of each row."""
    texts = sorted({(t or "").lower() for _, t in rows})
    sets = [shingle_sets(t) for t in texts]
    parent = list(range(len(texts)))

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for n in range(len(texts)):
        for m in range(n):
            if jaccard(sets[n], sets[m]) >= similarity:
                parent[find(n)] = find(m)
    of = {t: find(n) for n, t in enumerate(texts)}
    least = {}
    for d, t in rows:
        g = of[(t or "").lower()]
        if d is not None:
            least[g] = min(d, least.get(g, d))
    return [(d, least.get(of[(t or "").lower()])) for d, t in rows]


def edited(rng, text, times):
    w = text.split(" ")
    for _ in range(times):
        w[rng.randrange(len(w))] = words(rng, 1)
    return " ".join(w)


def near_pairs(seed, n, edits):
    """Texts and copies with so many words replaced."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        text = words(rng, 200)
        rows += [(2 * k, text), (2 * k + 1, edited(rng, text, edits))]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_recall_of_pairs_at_the_threshold(spark):
    """Four replaced words of 200 leave a similarity of about 0.82, hard cases for the fingerprint."""
    rows = near_pairs(1, 150, 4)
    sets = {d: shingle_sets(t) for d, t in rows}
    hard = {d for d, _ in rows[::2] if 0.8 <= jaccard(sets[d], sets[d + 1])}
    assert len(hard) > 100
    got = dict(tuple(r) for r in similar_texts.near_copies(frame(spark, rows)).collect())
    found = {d for d in hard if got[d + 1] == d}
    assert len(found) >= 0.95 * len(hard)
    # Nothing else is linked.
    assert all(got[d] in (d, d - 1) for d in got)
    assert all(got[d + 1] == d + 1 for d, _ in rows[::2] if d not in hard)


def test_against_brute_force(spark, docs, corpus, as_rows):
    assert as_rows(similar_texts.near_copies(docs), "doc_id", "component_id") == sorted(groups(corpus), key=repr)


def test_one_of_each_group_stays(docs, corpus, as_rows):
    kept = similar_texts.deduplicated(docs)
    assert kept.schema == docs.schema
    wanted = sorted({c for _, c in groups(corpus)}, key=repr)
    assert [r[0] for r in as_rows(kept, "doc_id")] == wanted


def test_a_large_group_of_near_copies(spark, monkeypatch):
    """As many comparisons as texts, about; none of the pairs within the group."""
    rng = random.Random(2)
    base = words(rng, 300)
    rows = [(n, edited(rng, base, 2)) for n in range(400)] + [(1000 + n, words(rng, 300)) for n in range(50)]
    seen = []
    real = similar_texts.stage
    monkeypatch.setattr(similar_texts, "stage", lambda df, label: seen.append((label, out := real(df, label))) or out)
    got = dict(tuple(r) for r in similar_texts.near_copies(frame(spark, rows)).collect())
    assert all(got[n] == 0 for n in range(400)) and all(got[n] == n for n in range(1000, 1050))
    compared = sum(df.count() for label, df in seen if label == "pairs")
    assert compared < 3 * 400


def test_copies_that_are_alike_only_through_their_source(spark, monkeypatch):
    """Each is near its source but not near the others: the source leads, and pairs of copies are not compared."""
    rng = random.Random(4)
    base = words(rng, 300)
    rows = [(900, base)] + [(n, edited(rng, base, 6)) for n in range(200)]
    sets = [shingle_sets(t) for _, t in rows]
    near = {d for (d, _), s in zip(rows, sets, strict=True) if jaccard(s, sets[0]) >= 0.8}
    assert len(near) > 180 and sum(jaccard(sets[k], sets[k + 1]) >= 0.8 for k in range(1, 200)) < 20
    seen = []
    real = similar_texts.stage
    monkeypatch.setattr(similar_texts, "stage", lambda df, label: seen.append((label, out := real(df, label))) or out)
    got = dict(tuple(r) for r in similar_texts.near_copies(frame(spark, rows)).collect())
    assert sum(got[d] == min(near) for d in near) >= 0.95 * len(near)
    assert sum(df.count() for label, df in seen if label == "pairs") < 5 * 200


def test_copies_too_far_from_their_source_are_not_paired(spark, monkeypatch):
    """Each lies at about 0.7 from its source and at half from the others: no link, and hardly a pair to compare."""
    rng = random.Random(5)
    base = words(rng, 300)
    rows = [(900, base)] + [(n, edited(rng, base, 11)) for n in range(200)]
    seen = []
    real = similar_texts.stage
    monkeypatch.setattr(similar_texts, "stage", lambda df, label: seen.append((label, out := real(df, label))) or out)
    got = [tuple(r) for r in similar_texts.near_copies(frame(spark, rows)).collect()]
    assert sorted(got) == sorted(groups(rows))
    assert sum(df.count() for label, df in seen if label == "pairs") < 5 * 200


def test_majority(spark):
    rows = [(1, 0b111, -1), (1, 0b101, 0), (1, 0b001, -1), (2, -(1 << 63), 5), (2, 0, 5), (2, -(1 << 63), 4)]
    df = spark.createDataFrame(rows, "key long, f1 long, f2 long")
    assert sorted(map(tuple, similar_texts._majority(df).collect())) == [(1, 0b101, -1), (2, -(1 << 63), 5)]


def test_anchors_cover():
    home, near = similar_texts._byte_anchors()
    byte = np.arange(256)
    assert np.bitwise_count(home ^ byte).max() <= 1 and len(np.unique(home)) == 32
    for b in range(256):
        for k in range(8):
            assert home[b ^ (1 << k)] in near[b]


def test_nothing(no_docs):
    assert similar_texts.near_copies(no_docs).count() == 0
    assert similar_texts.deduplicated(no_docs).count() == 0
