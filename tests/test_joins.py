import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from keepsake.operators import joins as J
from keepsake.operators import timeline as TL
from keepsake.operators.flags import collapse, flag_pivot


@pytest.fixture(scope="module")
def facts(spark):
    rng = random.Random(3)
    data = [(rng.choice([1, 1, 1, 2, 3, 4]), i) for i in range(3000)]
    return spark.createDataFrame(data, "k long, id int").repartition(6)


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (9, "z")], "k long, name string")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("heavy", [0, 500, 10**9])
def test_salted_join_equals_plain(facts, dim, same, how, heavy):
    want = facts.join(dim, "k", how)
    same(want, J.salted_join(facts, dim, ["k"], how, salts=7, heavy_rows=heavy))


def test_salted_join_refuses_outer(facts, dim):
    with pytest.raises(ValueError):
        J.salted_join(facts, dim, ["k"], "full")


def test_heavy_key_is_split(facts):
    heavy = J.heavy_keys(facts, ["k"], 1000).collect()
    assert [r["k"] for r in heavy] == [1]


def test_rows_without_key_survive_a_salted_left_join(spark, dim, same):
    facts = spark.range(50).selectExpr("IF(id % 2 = 0, NULL, id % 3) AS k", "id")
    for how in ("left", "left_anti"):
        same(facts.join(dim, "k", how), J.salted_join(facts, dim, ["k"], how, heavy_rows=5))


def test_dimension_join_leaves_sizes_to_the_run(facts, dim, same):
    spark = facts.sparkSession
    salted = J.dimension_join(facts, dim, ["k"], heavy_rows=1000)
    plain = J.dimension_join(facts, dim, ["k"])
    same(plain, salted)
    # A frame that explodes far beyond its planned size is not broadcast on that plan's word.
    wide = spark.range(4).selectExpr("id AS k", "explode(sequence(1, 200000)) AS name")
    plan = J.dimension_join(facts, wide, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan and "__salt" in salted._jdf.queryExecution().optimizedPlan().toString()


def test_one_per_key_takes_first_and_all_keys(spark, rows):
    t = lambda m: dt.datetime(2024, 1, 1, 0, m)
    df = spark.createDataFrame(
        [("a", t(2), "x"), ("a", t(1), "z"), ("a", t(1), "y"), (None, t(3), "n"), (None, t(4), "o")],
        "id string, ts timestamp, v string",
    )
    assert rows(J.one_per_key(df, ["id"], ["ts"]), "id", "v") == [(None, "n"), ("a", "y")]


def test_flags_on_days_equals_range_join(spark, rows):
    day = lambda n: dt.date(2024, 1, n)
    base = spark.createDataFrame([(1, day(10)), (1, day(2)), (2, day(10))], "c long, d date")
    cases = spark.createDataFrame(
        [(1, day(17), 0), (1, day(18), 1), (1, day(9), 1), (2, day(10), 1)], "c long, on date, s int"
    )
    got = J.flags_on_days(base, ["c"], "d", cases, "on", 7, {"hit": F.lit(1), "saved": F.col("s")})
    want = (
        base.join(cases.withColumnRenamed("c", "k"), F.expr("k = c AND on BETWEEN d AND date_add(d, 7)"), "left")
        .groupBy("c", "d")
        .agg(F.max(F.when(F.col("k").isNotNull(), 1)).alias("hit"), F.max("s").alias("saved"))
    )
    assert rows(got, "c", "d", "hit", "saved") == rows(want)


def test_exists_after_ignores_copies(spark, rows):
    day = lambda s: dt.date.fromisoformat(s)
    base = spark.createDataFrame([(1, day("2024-01-01")), (2, day("2024-01-01"))], "c long, d date")
    status = spark.createDataFrame(
        [(1, day("2024-02-01")), (1, day("2024-02-01")), (2, day("2024-04-02"))], "c long, day date"
    )
    got = J.exists_after(base, ["c"], "d", status, "day", {"r31": 31, "r92": 92})
    assert rows(got, "c", "r31", "r92") == [(1, 1, 0), (2, 0, 1)]


def test_facts_outside_of_the_span_are_left_out(spark, rows):
    day = lambda n: dt.date(2024, 3, n)
    base = spark.createDataFrame([(1, day(5)), (2, day(9))], "c int, d date")
    facts = spark.createDataFrame([(1, day(4)), (1, day(6)), (2, day(12)), (1, day(30))], "c int, on date")
    span = J.day_span(base, "d")
    assert span == (day(5), day(9)) and J.day_span(base.limit(0), "d") is None
    got = J.flags_on_days(base, ["c"], "d", facts, "on", 2, {"seen": F.lit(1)}, span)
    assert rows(got, "c", "seen") == [(1, 1), (2, None)]
    assert "2024-03-11" in got._jdf.queryExecution().optimizedPlan().toString()


def test_defaults(facts, dim):
    filled = J.left_with_defaults(facts, dim.filter("k = 1"), ["k"], {"name": "none"})
    assert filled.filter("name IS NULL").count() == 0 and filled.count() == facts.count()


def test_flags(spark, rows):
    df = spark.createDataFrame(
        [(1, "A", 1, 0), (1, "B", 0, None), (2, "A", 0, 1)], "k int, kind string, v int, c int"
    )
    got = flag_pivot(df, ["k"], "kind", {"a": "A", "b": "B"}, {"v_{}": "v", "c_{}": "c"})
    assert rows(got, "k", "v_a", "v_b", "c_a", "c_b") == [(1, 1, 0, 0, 0), (2, 0, 0, 1, 0)]
    assert rows(collapse(df, ["k"], ["kind"]), "k", "kind") == [(1, "B"), (2, "A")]


def test_snapshot_partitions_are_pruned(spark, tmp_path):
    status = spark.sql(
        "SELECT 1L AS c, explode(sequence(DATE '2024-01-01', DATE '2024-12-31')) AS day"
    )
    status.repartition(1).write.partitionBy("day").parquet(str(tmp_path / "s"))
    stored = spark.read.schema("c long, day date").parquet(str(tmp_path / "s"))
    base = spark.sql("SELECT 1L AS c, DATE '2024-02-01' AS d")
    found = J.exists_after(base, ["c"], "d", stored, "day", {"r": 31})
    assert [r["r"] for r in found.collect()] == [1]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "day" in plan and "2024-03-03" in plan


def test_snapshots_are_never_gathered_in_the_driver(spark, tmp_path):
    # A small file that holds many days: the planner takes what is exploded from it for as small.
    spark.range(20).coalesce(1).write.parquet(str(tmp_path / "c"))
    status = spark.read.parquet(str(tmp_path / "c")).selectExpr(
        "id AS c", "explode(sequence(DATE '2024-01-01', DATE '2024-12-31')) AS day"
    )
    base = spark.range(20).selectExpr("id AS c", "DATE '2024-02-01' AS d")
    found = J.exists_after(base, ["c"], "d", status, "day", {"r31": 31, "r360": 360})
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not any("Join" in line and "Broadcast" in line and "__on" in line for line in plan.splitlines())
    assert [tuple(r) for r in found.select("r31", "r360").distinct().collect()] == [(1, 0)]


def test_lookups_by_row_are_never_gathered_in_the_driver(spark):
    # Small to the planner; in larger tables as many rows as the left side.
    left = spark.range(20).selectExpr("id AS c", "DATE '2024-02-01' AS d", "TIMESTAMP '2024-02-01 10:00:00' AS t")
    facts = left.selectExpr("c", "d AS on", "1 AS n")
    flagged = J.flags_on_days(left, ["c"], "d", facts, "on", 2, {"found": F.col("n")})
    filled = J.left_with_defaults(left, facts.select("c", "n"), ["c"], {"n": 0})
    ahead = J.exists_after(left, ["c"], "d", facts, "on", {"r0": 0})
    for df in (
        flagged, filled, ahead,
        TL.along(left, ["c"], ["t"], rank="rank"),
        TL.next_times(left, ["c"], "t", {"next": F.lit(True)}),
        TL.trailing_count(left, ["c"], "t", 60, "n"),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        wide = [x for x in plan.splitlines() if "BroadcastHashJoin" in x and "LeftSemi" not in x]
        assert "SortMergeJoin" in plan and not wide
        assert df.count() == 20
