import random

import numpy as np
import xxhash

from keepsake.llm import simhash


def fingerprint(text, size=3):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, seed=42) for p in parts]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def groups(marks):
    """Smallest known id reachable over links of two bits, of each row."""
    values = sorted(set(m for _, m in marks))
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for n, a in enumerate(values):
        for b in values[n + 1 :]:
            if bin(a ^ b).count("1") <= 2:
                parent[find(a)] = find(b)
    least = {}
    for d, m in marks:
        if d is not None:
            least[find(m)] = min(d, least.get(find(m), d))
    return [(d, m, least.get(find(m))) for d, m in marks]


def test_against_brute_force(docs, corpus, as_rows):
    marks = [(d, fingerprint(t)) for d, t in corpus]
    got = [(d, m & (2**64 - 1), c) for d, m, c in as_rows(simhash.near_duplicates(docs), "doc_id", "fp", "component_id")]
    assert sorted(got, key=repr) == sorted(groups(marks), key=repr)


def test_links_and_chains(spark):
    rng = random.Random(4)
    marks = set()
    for _ in range(30):
        m = rng.getrandbits(64)
        for _ in range(25):
            marks.add(m - (1 << 64) if m >> 63 else m)
            for _ in range(rng.randint(0, 3)):
                m ^= 1 << rng.randrange(64)
    marks = sorted(marks)
    got = {tuple(r) for r in simhash.links(spark.createDataFrame([(m,) for m in marks], "fp long")).collect()}
    want = {
        (a, b) for n, a in enumerate(marks) for b in marks[n + 1 :] if bin((a ^ b) & (2**64 - 1)).count("1") <= 2
    }
    assert got == want and len(want) > 100


def test_crowds_connect_without_all_pairs(spark):
    """All words over ten bits, a few of them joined to others only through a word that is no home of a crowd."""
    rng = random.Random(6)
    bits, base = rng.sample(range(64), 10), rng.getrandbits(64)
    dense = {base ^ sum(1 << b for n, b in enumerate(bits) if w >> n & 1) for w in range(1 << 10)}
    far = [b for b in range(64) if b not in bits]
    arms = set()
    for _ in range(6):
        m = rng.choice(sorted(dense))
        for _ in range(5):
            m ^= sum(1 << b for b in rng.sample(far, 2))
            arms.add(m)
    marks = sorted(m - (1 << 64) if m >> 63 else m for m in dense | arms | {rng.getrandbits(64) for _ in range(50)})
    table = spark.createDataFrame([(m,) for m in marks], "fp long")
    every = {tuple(r) for r in simhash.links(table).collect()}
    bonds = {tuple(r) for r in simhash.bonds(table, crowd=4).collect()}
    assert bonds <= every and len(bonds) < 2 * len(every) / 3 and len(every) > 20000

    def classes(pairs):
        parent = {m: m for m in marks}

        def find(m):
            while parent[m] != m:
                m = parent[m]
            return m

        for a, b in sorted(pairs):
            parent[find(b)] = find(a)
        return {frozenset(m for m in marks if find(m) == r) for r in {find(m) for m in marks}}

    assert classes(bonds) == classes(every)
    assert {tuple(r) for r in simhash.bonds(table, crowd=1 << 20).collect()} == every


def test_anchors_cover():
    rng = np.random.default_rng(0)
    half = rng.integers(0, 1 << 32, 200, dtype=np.uint32)
    own = simhash.home(half)
    assert np.bitwise_count(own ^ half).max() <= 1
    near = [set() for _ in half]
    for rows, anchors in simhash.anchors_near(half):
        for r, a in zip(rows.tolist(), anchors.tolist(), strict=True):
            assert a not in near[r]
            near[r].add(a)
    for n, h in enumerate(half):
        for k in range(32):
            assert int(simhash.home(np.array([h ^ np.uint32(1 << k)], np.uint32))[0]) in near[n]


def test_one_of_each_group_stays(docs, corpus, as_rows):
    kept = simhash.deduplicated(docs)
    assert kept.schema == docs.schema
    rows = groups([(d, fingerprint(t)) for d, t in corpus])
    assert [r[0] for r in as_rows(kept, "doc_id")] == sorted({c for _, _, c in rows}, key=repr)


def test_nothing(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.deduplicated(no_docs).count() == 0
