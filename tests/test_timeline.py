"""Slotted operators against plain windows and joins, with one key holding most rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from keepsake.operators import timeline as T

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(7)
    data = [
        (
            rng.choice(["a", "b", "hot", "hot", "hot"]),
            i,
            START + dt.timedelta(seconds=rng.randrange(3 * 86400) // rng.choice([1, 600]) * 1),
            rng.random() < 0.2,
            rng.choice([1, 2, None]),
        )
        for i in range(2000)
    ]
    return spark.createDataFrame(data, "k string, id int, ts timestamp, hit boolean, v int").repartition(8)


@pytest.mark.parametrize("slot", [60, 3600, 86400 * 30])
def test_along_equals_windows(events, same, slot):
    w = W.partitionBy("k").orderBy("ts", "id")
    want = events.select(
        "*",
        F.row_number().over(w).alias("r"),
        F.sum("v").over(w.rowsBetween(W.unboundedPreceding, 0)).alias("s"),
        F.lag("v").over(w).alias("p"),
        F.lead("id").over(w).alias("n"),
    )
    got = T.along(
        events, ["k"], ["ts", "id"], T.time_slot("ts", slot),
        rank="r", running={"s": F.col("v")}, previous={"p": "v"}, following={"n": "id"},
    )
    same(want, got)


def test_along_without_keys(events, same):
    w = W.orderBy("ts", "id")
    want = events.select("*", F.row_number().over(w).alias("r"), F.lead("ts").over(w).alias("n"))
    same(want, T.along(events, [], ["ts", "id"], rank="r", following={"n": "ts"}))


def test_next_times_equals_forward_frame(events, same):
    w = W.partitionBy("k").orderBy("ts").rangeBetween(W.currentRow, W.unboundedFollowing)
    want = events.select("*", F.min(F.when(F.col("hit"), F.col("ts"))).over(w).alias("h"))
    same(want, T.next_times(events, ["k"], "ts", {"h": F.col("hit")}))


@pytest.mark.parametrize("seconds", [0, 1800, 86400])
def test_trailing_count_equals_range_frame(events, same, seconds):
    w = W.partitionBy("k").orderBy(F.unix_seconds("ts")).rangeBetween(-seconds, 0)
    want = events.select("*", F.count("id").over(w).alias("c"))
    same(want, T.trailing_count(events, ["k"], "ts", seconds, "c"))


def test_assign_to_windows_equals_range_join(events, same):
    starts = events.filter("hit").withColumn("lane", (F.col("id") % 3).cast("string"))
    starts = starts.dropDuplicates(["k", "lane", "ts"])
    windows = T.along(starts, ["k", "lane"], ["ts"], rank="no", following={"e": "ts"})
    windows = windows.select(
        "k", "lane", F.col("ts").alias("s"), F.coalesce("e", F.expr("ts + INTERVAL 1 HOUR")).alias("e"), "no"
    )
    plain = events.select("k", "id", F.col("ts").alias("t"))
    want = windows.join(plain, "k").filter("t >= s AND t < e").select("k", "lane", "s", "e", "no", "id", "t")
    got = T.assign_to_windows(plain, windows, ["k"], "lane", "t", "s", "e", ["no"])
    assert want.count() > 100
    same(want, got)


def test_big_side_is_shuffled_once(spark, events, tmp_path):
    """The window's partitioning serves the join that brings the carried values back."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = T.along(events, ["k"], ["ts", "id"], rank="r")
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    left = plan[plan.index("SortMergeJoin") : plan.index("Window")]
    assert "Exchange" not in left
