import hashlib
import random
import zlib

import pytest

from keepsake.llm import prefix_trie

NAMES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
SCHEMA = "conv_id long, turn long, role string, text string, depth int, id string, last string"


def brute_force(rows):
    """The trie of the rebuilt conversations, walked node by node."""
    known = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            known.setdefault(c, []).append(((turn is not None, turn or 0), role, mark, text))
    turns = {c: [(r, t) for _, r, _, t in sorted(v, key=lambda x: x[:3])] for c, v in known.items()}
    members, ends = {}, {}
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        path = tuple(turns.get(base, [])[:h] + mine[h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
        ends.setdefault(path, []).append(c)
    children = {p: [] for p in members}
    for p in members:
        if p:
            children[p[:-1]].append(p)
    totals = {}
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        leaves = sum(totals[k][0] for k in children[p]) if children[p] else 1
        totals[p] = (leaves, own + sum(totals[k][1] for k in children[p]))
    return sorted(
        (
            (
                min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children[p]), *totals[p],
                hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest(),
            )
            for p in members
        ),
        key=repr,
    )


def made(seed, n, longest, words):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(3 * n), n):
        for turn in range(rng.randint(1, longest)):
            rows.append((c, turn, "user" if turn % 2 == 0 else "assistant", rng.choice(words)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "i", "x") for r in rows], SCHEMA).repartition(5)


def test_against_brute_force(spark, as_rows):
    rows = made(0, 60, 7, ["a", "bé", "ccc"])
    common = [(c, t, "user", "same") for c in range(1000, 1060) for t in range(3)]
    odd = [
        (None, 0, "user", "a"), (70_000, None, None, None), (70_000, 3, None, "x"), (70_000, 3, "user", None), (70_000, 3, "user", "y"),
        (70_000, 3, "user", "y"), (-7, 1, "user", "a"), (-5, 1, "user", "a"), (-5, 2, "b", "c"), (71_001, -4, "", ""), (71_004, 9, "z", "🙂" * 3000),
    ]
    rows = rows + common + odd
    assert as_rows(prefix_trie.trie(frame(spark, rows)), *NAMES) == brute_force(rows)


def test_a_long_conversation(spark, as_rows):
    """A chain of 150 turns spans many tasks, and rounds grow with its logarithm."""
    rows = [(5, t, "user", f"t{t % 40}") for t in range(150)] + [(7, t, "user", f"t{t % 40}") for t in range(140)] + made(1, 8, 4, ["t0", "t1"])
    assert as_rows(prefix_trie.trie(frame(spark, rows)), *NAMES) == brute_force(rows)


@pytest.mark.parametrize("shape", ["chain", "random", "caterpillar"])
def test_subtree_totals(spark, shape, monkeypatch):
    rng = random.Random(9)
    n = 120
    parent = {
        "chain": lambda k: k - 1,
        "random": lambda k: rng.randrange(k),
        "caterpillar": lambda k: k - 1 if k % 2 else max(0, k - 2),
    }[shape]
    up = [None] + [parent(k) for k in range(1, n)]
    depth = [0] * n
    for k in range(1, n):
        depth[k] = depth[up[k]] + 1
    weight = [rng.randint(0, 9) for _ in range(n)]
    total = weight[:]
    for k in range(n - 1, 0, -1):
        total[up[k]] += total[k]
    rounds = []
    real = prefix_trie.stage
    monkeypatch.setattr(prefix_trie, "stage", lambda df, label: rounds.append(label) or real(df, label))
    tree = spark.createDataFrame([(k, up[k], depth[k], weight[k]) for k in range(n)], "id long, parent long, depth long, w long")
    got = {r["id"]: r["w"] for r in prefix_trie.subtree_totals(tree, ["w"]).collect()}
    assert got == dict(enumerate(total))
    assert rounds.count("seen") <= 12


def test_running_spans_tasks(spark, as_rows):
    rows = [(1, k, k % 3) for k in range(400)] + [(2, 0, 5)] + [(3, k, 1) for k in range(30)]
    df = spark.createDataFrame(rows, "key long, at long, w long").repartition(3)
    got = as_rows(prefix_trie.running(df, "key", ["at"], ("w",)), "key", "at", "rank", "sum_w")
    want, held = [], {}
    for key, at, w in sorted(rows):
        held[key] = held.get(key, 0) + w
        want.append((key, at, at + 1, held[key]))
    assert sorted(got) == want


def test_nothing(spark):
    assert prefix_trie.trie(frame(spark, []).limit(0)).count() == 0
    assert prefix_trie.trie(frame(spark, [(None, 1, "a", "b")])).count() == 0
