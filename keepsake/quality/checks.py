"""Checks over a table.

All row-level checks of a table share one aggregation pass; each uniqueness check adds one
grouping. The report has one row per check: table, check, column, severity, total, failed,
pass_rate, passed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..schemas import BILLING_FREQUENCIES, OFFER_TYPES, OUTCOMES, PRODUCTS, YES_NO


@dataclass(frozen=True)
class Check:
    """``failures`` counts failing rows; ``group`` makes it a check over groups instead."""

    name: str
    column: str
    failures: Column | None = None
    severity: str = "MAJOR"
    group: tuple[str, ...] = ()
    at_least: float | None = None


def row_count(least: int | None = None, most: int | None = None, severity: str = "MAJOR") -> Check:
    n = F.count(F.lit(1))
    tests = [n < least] if least is not None else []
    tests += [n > most] if most is not None else []
    outside = reduce(lambda a, b: a | b, tests) if tests else F.lit(False)
    return Check("row_count", "*", F.when(outside, n).otherwise(0), severity)


def not_null(column: str, severity: str = "MAJOR") -> Check:
    return Check("not_null", column, F.count_if(F.col(column).isNull()), severity)


def in_set(column: str, values: Sequence, severity: str = "MAJOR") -> Check:
    """NULL passes."""
    return Check("in_set", column, F.count_if(~F.col(column).isin(*values)), severity)


def between(column: str, low=None, high=None, severity: str = "MAJOR") -> Check:
    """NULL passes; either bound may be open."""
    outside = F.lit(False)
    if low is not None:
        outside = outside | (F.col(column) < low)
    if high is not None:
        outside = outside | (F.col(column) > high)
    return Check("between", column, F.count_if(outside), severity)


def implies(name: str, when: Column, then: Column, severity: str = "MAJOR") -> Check:
    """Rows with ``when`` true must have ``then`` true."""
    return Check("implies", name, F.count_if(when & ~F.coalesce(then, F.lit(False))), severity)


def unique(*columns: str, severity: str = "MAJOR") -> Check:
    return Check("unique", ",".join(columns), severity=severity, group=columns)


def unique_ratio(*columns: str, at_least: float, severity: str = "MINOR") -> Check:
    """Distinct values over rows, the lone NULL group left out."""
    return Check("unique_ratio", ",".join(columns), severity=severity, group=columns, at_least=at_least)


def run_checks(df: DataFrame, checks: Sequence[Check], table: str) -> DataFrame:
    """The report of ``checks`` on ``df``."""
    parts = []
    by_row = [c for c in checks if not c.group]
    if by_row:
        entries = [
            F.struct(
                F.lit(c.name).alias("check"),
                F.lit(c.column).alias("column"),
                F.lit(c.severity).alias("severity"),
                F.col(f"f{i}").cast("bigint").alias("failed"),
            )
            for i, c in enumerate(by_row)
        ]
        one = df.agg(
            F.count(F.lit(1)).alias("total"), *[c.failures.alias(f"f{i}") for i, c in enumerate(by_row)]
        )
        parts.append(one.select("total", F.inline(F.array(*entries))))
    for c in checks:
        if c.group:
            sizes = df.groupBy(*c.group).agg(F.count(F.lit(1)).alias("n"))
            filled = reduce(lambda a, b: a & b, [F.col(g).isNotNull() for g in c.group])
            failed = (
                F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0))
                if c.at_least is None
                else F.when(F.count_if(filled) < F.lit(c.at_least) * F.sum("n"), F.sum("n")).otherwise(0)
            )
            parts.append(
                sizes.agg(
                    F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
                    F.lit(c.name).alias("check"),
                    F.lit(c.column).alias("column"),
                    F.lit(c.severity).alias("severity"),
                    F.coalesce(failed, F.lit(0)).cast("bigint").alias("failed"),
                )
            )
    report = reduce(lambda a, b: a.unionByName(b), parts)
    share = F.when(F.col("total") > 0, 1 - F.col("failed") / F.col("total")).otherwise(
        F.when(F.col("failed") > 0, 0.0).otherwise(1.0)
    )
    return report.select(
        F.lit(table).alias("table_name"),
        "check",
        "column",
        "severity",
        "total",
        "failed",
        F.round(share, 6).alias("pass_rate"),
        (F.col("failed") == 0).alias("passed"),
    )


def summarize(report: DataFrame) -> DataFrame:
    """Share of passed checks per table and severity, with the alert each one raises."""
    rate = F.avg(F.col("passed").cast("double"))
    alert = (
        F.when((F.col("severity") == "CRITICAL") & (F.col("pass_rate") < 0.95), "P1")
        .when((F.col("severity") != "CRITICAL") & (F.col("pass_rate") < 0.99), "P3")
        .otherwise("none")
    )
    return (
        report.groupBy("table_name", "severity")
        .agg(
            F.count(F.lit(1)).alias("checks"),
            F.count_if("passed").alias("passed_checks"),
            F.round(rate, 6).alias("pass_rate"),
        )
        .withColumn("alert", alert)
    )


# ---- suites -------------------------------------------------------------------------------


def metrics_suite(min_rows: int = 1_000_000) -> list[Check]:
    """Checks of the wide table."""
    return [
        row_count(min_rows, severity="CRITICAL"),
        *[
            not_null(c, "CRITICAL")
            for c in ("company_id", "cancel_flow_start_timestamp", "initiation_rank", "dwh_create_date")
        ],
        unique("company_id", "initiation_rank", "cancel_flow_start_timestamp", severity="CRITICAL"),
        in_set("cancel_confirmed", YES_NO),
        in_set("save_attribution", OUTCOMES),
        in_set("saved_by_customer_support", YES_NO),
        *[between(c, 0, 1) for c in ("retained_31d", "retained_92d", "baked_31d")],
        in_set("product", PRODUCTS, "MINOR"),
        in_set("billing_frequency", BILLING_FREQUENCIES, "MINOR"),
        unique_ratio("company_id", at_least=0.01),
    ]


def engagement_suite() -> list[Check]:
    """Checks of the offer-grain table."""
    key = (
        "company_id", "initiation_rank", "initiation_timestamp",
        "properties_ui_access_point", "offer_id",
    )
    return [
        row_count(0),
        *[
            not_null(c, "CRITICAL")
            for c in (*key, "viewed_dic_component", "number_of_data_points_shown")
        ],
        unique(*key, severity="CRITICAL"),
        in_set("ipd_type", OFFER_TYPES),
        between("viewed_ipd", 0, 1),
        between("clicked_ipd", 0, 1),
    ]


def retention_consistency() -> list[Check]:
    """An episode that is not baked yet should not count as retained."""
    return [
        implies(f"baked_{n}d=0 -> retained_{n}d=0", F.col(f"baked_{n}d") == 0, F.col(f"retained_{n}d") == 0)
        for n in (31, 92)
    ]


# ---- table-level checks -------------------------------------------------------------------


def row_parity(
    a: DataFrame, b: DataFrame, tolerance: float = 0.0, labels: tuple[str, str] = ("a", "b")
) -> DataFrame:
    """Both row counts, their relative deviation and whether it is tolerated."""
    tagged = a.select(F.lit(True).alias("of_a")).unionByName(b.select(F.lit(False).alias("of_a")))
    counts = tagged.agg(
        F.count_if("of_a").alias("rows_a"), F.count_if(~F.col("of_a")).alias("rows_b")
    )
    most = F.greatest("rows_a", "rows_b")
    gap = C.safe_divide(F.abs(F.col("rows_a") - F.col("rows_b")), most)
    return counts.select(
        F.lit(labels[0]).alias("table_a"),
        F.lit(labels[1]).alias("table_b"),
        "rows_a",
        "rows_b",
        F.round(gap, 6).alias("deviation"),
        (gap <= tolerance).alias("passed"),
    )


def calendar(daily: DataFrame, series: str, day: str, rows: str) -> DataFrame:
    """A row for every series and calendar day, from the series' first day to the last day of any; absent days count 0.

    Days are made within each series, whose number of rows they exceed only where days are absent.
    """
    typed = daily.select(series, F.col(day).cast("date").alias("__day"), rows)
    last = typed.agg(F.max("__day")).scalar()
    spans = typed.groupBy(series).agg(F.min("__day").alias("__first"))
    spine = spans.select(F.col(series).alias("__series"), F.explode(F.sequence("__first", last)).alias("__d"))
    return spine.join(
        typed, F.col("__series").eqNullSafe(F.col(series)) & (F.col("__d") == F.col("__day")), "left"
    ).select(
        F.col("__series").alias(series),
        F.col("__d").cast(daily.schema[day].dataType).alias(day),
        F.coalesce(rows, F.lit(0)).alias(rows),
    )


def volume_anomaly(
    daily: DataFrame, series: str, day: str, rows: str, share: float = 0.2, days: int = 7
) -> DataFrame:
    """Days whose count deviates from the mean of the ``days`` calendar days before by more than ``share``.

    ``daily`` holds at most one row per series and day; days without one count 0, so a feed that stops is an
    anomaly. A day with rows after a week without any deviates from a mean of zero, and is one too.
    """
    trailing = Window.partitionBy(series).orderBy(day).rowsBetween(-days, -1)
    mean = F.avg(rows).over(trailing)
    out = calendar(daily, series, day, rows).withColumn("trailing_mean", F.round(mean, 4))
    gap = F.abs(F.col(rows) - mean)
    return out.withColumn("deviation", F.round(F.try_divide(gap, mean), 6)).withColumn(
        "is_anomaly", F.coalesce(gap > share * mean, F.lit(False))
    )


def freshness(
    df: DataFrame, ts: str, as_of: Column, warn_hours: float = 6, error_hours: float = 10
) -> DataFrame:
    """Lag of the newest row and its state: ok, warn or error."""
    newest = df.agg(F.max(F.col(ts).cast("timestamp")).alias("newest"))
    lag = (F.unix_seconds(as_of.cast("timestamp")) - F.unix_seconds("newest")) / 3600.0
    state = (
        F.when(lag.isNull() | (lag > error_hours), "error").when(lag > warn_hours, "warn").otherwise("ok")
    )
    return newest.select("newest", F.round(lag, 4).alias("lag_hours"), state.alias("state"))
