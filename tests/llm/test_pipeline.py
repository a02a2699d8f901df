"""The stages on the smallest data folder, each against what it should do with its own input."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from keepsake.llm import cotraining
from keepsake.llm.catalog import ORACLE_SQL, QUERIES
from tests.llm.test_decontaminate import brute_force
from tests.llm.test_similar_texts import groups
from tests.llm.test_suffix_dedup import repeated
from tools.check_oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the given test data")


def test_names():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{n}" for n in range(1, len(QUERIES) + 1)}
    assert "pipeline" in entry.queries() and set(QUERIES) <= set(entry.queries())
    assert set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql_counterparts(spark, name):
    assert compare(spark, connect(FOLDER), name, FOLDER).startswith("ok")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    out = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for n, (_, apply) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(n))
        apply(spark, out[-1], FOLDER).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def texts(df):
    return sorted((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())


def test_columns(stages):
    assert all(df.columns == stages[0].columns for df in stages[1:-1])


def test_quality(spark, stages):
    model = cotraining.train(stages[0], spark.read.parquet(f"{FOLDER}/labels.parquet"))
    kept = {r["doc_id"]: r["kept"] for r in cotraining.score(stages[0], model).collect()}
    assert texts(stages[1]) == [(d, t) for d, t in texts(stages[0]) if kept[d]]
    assert len(texts(stages[1])) > 0.6 * len(texts(stages[0]))


def test_near_duplicates(stages):
    """Against all pairs by exact Jaccard over five-word shingles, given near copies included."""
    rows = groups(texts(stages[1]))
    assert [d for d, _ in texts(stages[2])] == sorted({c for _, c in rows})
    copies = {d for d, c in rows if c != d}
    exact = {d for d, _ in texts(stages[1])} - {min(d for d, _ in g) for g in by_words(texts(stages[1]))}
    assert len(copies - exact) >= 2


def by_words(rows):
    groups_of = {}
    for d, t in rows:
        groups_of.setdefault(tuple((t or "").lower().split()), []).append((d, t))
    return groups_of.values()


def test_repeated_passages(stages):
    before, after = texts(stages[2]), dict(texts(stages[3]))
    masks = repeated([t.encode() for _, t in before], 200)
    for (d, t), mask in zip(before, masks, strict=True):
        left = bytes(b for b, gone in zip(t.encode(), mask, strict=True) if not gone)
        assert after[d] == left.decode("utf-8", "ignore")


def test_benchmark_leaks(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    hit = {r[0] for r in brute_force(texts(stages[3]), items) if r[5]}
    assert texts(stages[4]) == [(d, t) for d, t in texts(stages[3]) if d not in hit]


def test_packed(stages):
    assert sorted({r["doc_id"] for r in stages[5].select("doc_id").collect()}) == [d for d, _ in texts(stages[4])]
    per = stages[5].groupBy("sequence_id").agg({"length": "sum"}).collect()
    total = sum(r[1] for r in per)
    assert len(per) <= -(-total // 2048) * 1.05 + 1 and max(r[1] for r in per) <= 2048
