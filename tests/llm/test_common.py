import random

from pyspark.sql import functions as F

from keepsake.llm import common


def test_batches_hold_few_bytes_however_long_the_texts(spark, monkeypatch):
    before = spark.conf.get(common.BATCH_CONF, None)
    monkeypatch.setattr(common, "READ_ROWS", 1 << 20)  # a list is a whole batch
    docs = spark.range(0, 1000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 4000).alias("text"))
    got = common.append_column(docs, "text", "rows", "long", lambda texts: [len(texts)] * len(texts)).select("rows")
    assert got.count() == 1000 and got.agg(F.max("rows")).first()[0] <= 110
    if before is None:
        spark.conf.unset(common.BATCH_CONF)


def test_a_bound_that_the_session_asks_for_holds(spark):
    before = spark.conf.get(common.BATCH_CONF, None)
    spark.conf.set(common.BATCH_CONF, "1000000")
    assert common.map_rows(spark.range(5), "id long", lambda rows: rows).count() == 5
    assert spark.conf.get(common.BATCH_CONF) == "1000000"
    spark.conf.unset(common.BATCH_CONF) if before is None else spark.conf.set(common.BATCH_CONF, before)


def smallest(links):
    """The smallest node reachable from each."""
    parent = {n: n for link in links for n in link}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {(n, find(n)) for n in parent}


def test_components_of_any_shape(spark):
    rng = random.Random(2)
    links = [(n, n // 2) for n in range(2, 40)] + [(100, n) for n in range(90, 130)] + [(-5, 7), (7, -5), (200, 200)]
    links += [(rng.randrange(300, 360), rng.randrange(300, 360)) for _ in range(40)]
    got = common.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len(got) == len({r[0] for r in got}) and {tuple(r) for r in got} == smallest(links)
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_rounds_do_not_grow_with_the_length_of_a_chain(spark, monkeypatch):
    nodes = list(range(100))
    random.Random(3).shuffle(nodes)
    links = [(min(x), max(x)) for x in zip(nodes, nodes[1:], strict=False)]
    staged = []
    stage = common.stage

    def counted(df, label="stage"):
        staged.append(label)
        assert len(staged) < 24, "a round for every few links of a chain"
        return stage(df, label)

    monkeypatch.setattr(common, "stage", counted)
    found = common.components(spark.createDataFrame(links, "a long, b long"))
    assert {tuple(r) for r in found.collect()} == {(n, 0) for n in nodes}
