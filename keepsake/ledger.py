"""Run ledger: what each step wrote and how long it took."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LEDGER_SCHEMA = (
    "step string, table_name string, rows bigint, started timestamp, seconds double, status string"
)

# Usual run time of each step in seconds.
STEP_BASELINES = {
    "step0a_raw_events": 470,
    "step0b_ixp_assignments": 180,
    "step1_cancel_initiations": 587,
    "step2_ipd_engagement": 1397,
    "step3_save_attribution": 319,
    "step4_final_metrics": 1355,
}


def record_run(
    spark: SparkSession,
    path: str,
    step: str,
    table_name: str,
    rows: int,
    started: dt.datetime,
    seconds: float,
    status: str = "ok",
) -> None:
    """Append one run."""
    row = [(step, table_name, rows, started, float(seconds), status)]
    spark.createDataFrame(row, LEDGER_SCHEMA).write.mode("append").parquet(path)


def recent_runs(ledger: DataFrame, n: int) -> DataFrame:
    """The ``n`` latest runs: a report of fixed length, taken as a top-k without a full sort."""
    return ledger.orderBy(F.col("started").desc(), "step").limit(n)


def usual_seconds(ledger: DataFrame, runs: int = 20, least: int = 3) -> DataFrame:
    """Each run with ``baseline_seconds``: the median of the ``runs`` successful runs of its step before it.

    Null until ``least`` of them are known. A step has few runs, one a day or so.
    """
    before = Window.partitionBy("step").orderBy("started").rowsBetween(-runs, -1)
    timed = F.when(F.col("status") == "ok", F.col("seconds"))
    median = F.percentile(timed, F.lit(0.5)).over(before)
    return ledger.withColumn("baseline_seconds", F.when(F.count(timed).over(before) >= least, median))


def slow_steps(
    ledger: DataFrame, baselines: dict[str, float] | None = None, factor: float = 2.0, failed: bool = False
) -> DataFrame:
    """Successful runs that took longer than ``factor`` times their usual time; with ``failed`` the failed ones too.

    The usual time comes from the step's own history; ``baselines`` (``STEP_BASELINES``, say) stand in where it is short.
    """
    rated = usual_seconds(ledger)
    if not failed:
        rated = rated.filter(F.col("status") == "ok")
    if baselines:
        lookup = F.create_map(*[F.lit(v) for kv in baselines.items() for v in (kv[0], float(kv[1]))])
        rated = rated.withColumn("baseline_seconds", F.coalesce("baseline_seconds", lookup[F.col("step")]))
    return rated.filter(F.col("seconds") > F.col("baseline_seconds") * factor).withColumn(
        "ratio", F.round(F.try_divide(F.col("seconds"), F.col("baseline_seconds")), 4)
    )
