import random
import zlib
from collections import Counter, defaultdict

import pytest

from keepsake.llm import sharding


def collected(df):
    shards = defaultdict(list)
    for r in df.collect():
        shards[r["shard"]].append(r)
    for rows in shards.values():
        assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
    return shards


def test_groups_stay_whole_and_bytes_are_even(docs, corpus, as_rows):
    out = sharding.shard(docs, 4).cache()
    wanted = [(d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in corpus]
    assert as_rows(out, "doc_id", "size", "text_crc32") == sorted(wanted, key=repr)
    shards = collected(out)
    homes = defaultdict(set)
    for k, rows in shards.items():
        for r in rows:
            homes[r["text_crc32"], r["size"]].add(k)
    sizes = [sum(r["size"] for r in rows) for rows in shards.values()]
    longest = max(w[1] for w in wanted)
    # One text is over half of all bytes; the others share what is left.
    assert max(sizes) == longest and all(len(h) == 1 for h in homes.values()) and set(shards) <= set(range(4))


def test_even_shards_without_a_dominant_text(spark):
    rng = random.Random(2)
    rows = [(n, "x" * rng.randint(0, 300) + str(n % 700)) for n in range(2000)]
    shards = collected(sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), 16))
    sizes = [sum(r["size"] for r in rows) for rows in shards.values()]
    assert len(sizes) == 16 and max(sizes) <= 1.002 * min(sizes)


def test_a_group_larger_than_a_shard_is_cut(spark):
    rows = [(n, "copy " * 40) for n in range(1500)] + [(5000 + n, f"other {n} " * 20) for n in range(1500)]
    shards = collected(sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), 16))
    sizes = [sum(r["size"] for r in rows) for rows in shards.values()]
    assert len(sizes) == 16 and max(sizes) <= 1.02 * min(sizes)


def test_fixed_capacity(spark):
    rows = [(n, "x" * (20 + n % 90)) for n in range(400)]
    shards = collected(sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), capacity=4000))
    sizes = [sum(r["size"] for r in rows) for rows in shards.values()]
    assert max(sizes) <= 4000 and len(sizes) <= sum(sizes) / 4000 * 1.25 + 1


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_decreasing(seed):
    rng = random.Random(seed)
    sizes = [rng.randint(1, 100) for _ in range(300)]
    runs, bins = sharding.best_fit_decreasing(Counter(sizes), 100)
    rooms, want = [], [0] * len(sizes)
    for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        fits = [(r, b) for b, r in enumerate(rooms) if r >= sizes[k]]
        b = min(fits)[1] if fits else len(rooms)
        if not fits:
            rooms.append(100)
        rooms[b] -= sizes[k]
        want[k] = b
    assert bins == len(rooms)
    for size in set(sizes):
        got = [b for first, n, b in sorted(runs[size]) for _ in range(n)]
        assert sorted(got) == sorted(w for w, x in zip(want, sizes, strict=True) if x == size)


def test_copies_of_one_row_are_levelled(spark):
    """Rows that nothing tells apart, four times a shard, and small texts."""
    rows = [(7, "c" * 1000)] * 400 + [(100 + n, f"small {n} " * 3) for n in range(100)]
    shards = collected(sharding.shard(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 16))
    sizes = [sum(r["size"] for r in rows) for rows in shards.values()]
    assert len(sizes) == 16 and max(sizes) - min(sizes) <= 2100


def test_a_row_larger_than_a_shard_has_one_to_itself(spark):
    rows = [(0, "x" * 50_000)] + [(n, f"{n} " * 40) for n in range(1, 400)]
    shards = collected(sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), 8))
    sizes = sorted(sum(r["size"] for r in rows) for rows in shards.values())
    assert len(sizes) == 8 and sizes[-1] == 50_001 and sizes[-2] <= 1.05 * sizes[0]


def test_many_groups_are_packed_as_groups(spark):
    """Sizes of over four digits count in classes; no two groups are tied together."""
    rng = random.Random(8)
    rows = [(n, "x" * rng.randint(10_000, 14_000) + str(n)) for n in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    shards = collected(sharding.shard(df, 16))
    sizes = [sum(r["size"] for r in rows) for rows in shards.values()]
    bound = sum(sizes) / 16
    assert len(sizes) == 16 and max(sizes) <= bound + 14_000
    fixed = collected(sharding.shard(df, capacity=14_005))
    assert len(fixed) == 300 and all(len(r) == 1 for r in fixed.values())


def test_nothing(no_docs):
    assert sharding.shard(no_docs, 16).count() == 0
