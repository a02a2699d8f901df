import datetime as dt

import pytest
from pyspark.sql import functions as F

from keepsake.quality import checks as Q
from keepsake.quality.contract import validate_contract
from keepsake.schemas import Contract, FieldRule


@pytest.fixture
def df(spark):
    return spark.createDataFrame(
        [(1, "Y", 0, 0), (2, "N", 0, 1), (2, "MAYBE", 1, 1), (None, None, 2, None)],
        "id int, flag string, baked int, kept int",
    )


def results(report):
    return {(r["check"], r["column"]): (r["total"], r["failed"], r["passed"]) for r in report.collect()}


def test_every_check(df):
    report = Q.run_checks(
        df,
        [
            Q.row_count(1, 3, "CRITICAL"),
            Q.not_null("id"),
            Q.in_set("flag", ["Y", "N"]),
            Q.between("baked", 0, 1),
            Q.implies("baked=0 -> kept=0", F.col("baked") == 0, F.col("kept") == 0),
            Q.unique("id"),
            Q.unique_ratio("id", at_least=0.9),
        ],
        "t",
    )
    assert results(report) == {
        ("row_count", "*"): (4, 4, False),
        ("not_null", "id"): (4, 1, False),
        ("in_set", "flag"): (4, 1, False),
        ("between", "baked"): (4, 1, False),
        ("implies", "baked=0 -> kept=0"): (4, 1, False),
        ("unique", "id"): (4, 2, False),
        ("unique_ratio", "id"): (4, 4, False),
    }
    summary = {r["severity"]: r["alert"] for r in Q.summarize(report).collect()}
    assert summary == {"CRITICAL": "P1", "MAJOR": "P3", "MINOR": "P3"}


def test_empty_table(df):
    report = Q.run_checks(df.filter("id > 99"), [Q.row_count(0), Q.not_null("id"), Q.unique("id")], "t")
    assert all(r["passed"] and r["pass_rate"] == 1.0 for r in report.collect())


def test_row_checks_share_one_pass(df):
    report = Q.run_checks(df, [Q.not_null("id"), Q.between("baked", 0), Q.in_set("flag", ["Y"])], "t")
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_parity(df):
    assert Q.row_parity(df, df).first()["passed"]
    assert Q.row_parity(df, df.limit(3), 0.25).first()["passed"]


def test_volume_and_freshness(spark):
    days = [("s", dt.date(2024, 1, d), 100 if d < 9 else 130) for d in range(1, 10)]
    daily = spark.createDataFrame(days, "s string, d date, n int")
    odd = Q.volume_anomaly(daily, "s", "d", "n").filter("is_anomaly").collect()
    assert [r["d"].day for r in odd] == [9]
    rows = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0),)], "t timestamp")
    for hour, state in ((5, "ok"), (7, "warn"), (11, "error")):
        as_of = F.lit(f"2024-01-01 {hour:02d}:00:00").cast("timestamp")
        assert Q.freshness(rows, "t", as_of).first()["state"] == state


def test_absent_days_count_zero(spark, rows):
    day = lambda n: dt.date(2024, 1, n)
    data = [("s", day(n), 100) for n in range(1, 21) if n not in (9, 10)] + [("gone", day(n), 10) for n in range(1, 9)]
    daily = spark.createDataFrame([*data, ("one", day(20), 3)], "s string, d date, n int")
    out = Q.volume_anomaly(daily, "s", "d", "n")
    assert rows(out.groupBy("s").count()) == [("gone", 20), ("one", 1), ("s", 20)]
    odd = out.filter("is_anomaly")
    got = {(r["s"], r["d"].day, r["n"]) for r in odd.collect()}
    assert {("s", 9, 0), ("s", 10, 0), ("gone", 9, 0), ("gone", 12, 0)} <= got
    # Seven days means seven days: on the 18th the gap is out of sight.
    assert not any(k == ("s", n, 100) for k in got for n in (18, 19, 20))
    text = daily.withColumn("d", F.col("d").cast("string"))
    assert Q.volume_anomaly(text, "s", "d", "n").filter("d = '2024-01-09' AND n = 0").count() == 2


def test_contract(df):
    contract = Contract(
        "t", ("flag",), ("id",),
        {
            "id": FieldRule("bigint", nullable=False),
            "mark": FieldRule("string", values=("Y", "N"), aliases=("flag",)),
            "gone": FieldRule("int"),
        },
    )
    got = results(validate_contract(df, contract))
    assert got[("type bigint", "id")][2] is False
    assert got[("present", "mark")][2] is True and got[("present", "gone")][2] is False
    assert got[("in_set", "flag")][1] == 1 and got[("unique", "id")][1] == 2
