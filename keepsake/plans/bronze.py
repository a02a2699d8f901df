"""Raw clickstream and experiment assignments, cleaned."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators.joins import one_per_key


def bronze_events(raw: DataFrame, start: str, end: str) -> DataFrame:
    """Events of the days ``[start, end]``: resolved company and product, one row per event and day.

    The partition filter reaches the scan. The day then comes from the parsed time, and the few
    rows that were filed under a wrong day are dropped, so that no partition outside the run is
    ever written. That check follows the deduplication: before it, the optimizer would parse every
    time once more for each comparison.
    """
    at = F.col("event_timestamp").try_cast("timestamp")
    typed = raw.filter(F.col("event_date").between(start, end)).withColumns(
        {
            "event_timestamp": at,
            "event_date": F.date_format(at, "yyyy-MM-dd"),
            "company_id": C.resolve_company_id(),
            "product": C.resolve_product(),
            "event": C.normalize_event("event"),
        }
    )
    unique = one_per_key(typed, ["event_id", "event_date"], ["event_timestamp"])
    first = F.lit(start).cast("timestamp")
    after = F.lit(end).cast("timestamp") + F.expr("INTERVAL 1 DAY")
    return unique.filter((F.col("event_timestamp") >= first) & (F.col("event_timestamp") < after))


def single_treatment(assignments: DataFrame, start: str, end: str) -> DataFrame:
    """Assignments of companies that saw exactly one treatment of an experiment.

    One treatment means the smallest name equals the greatest, which needs no distinct count. The
    window runs over one row per company, experiment and day.
    """
    valid = assignments.filter(F.col("version") >= 1).withColumn(
        "first_assignment_date", F.to_date("first_timestamp")
    )
    daily = (
        valid.filter(F.col("first_assignment_date").between(start, end))
        .groupBy("company_id", "experiment_id", "first_assignment_date")
        .agg(F.min("treatment_name").alias("least"), F.max("treatment_name").alias("greatest"))
    )
    group = Window.partitionBy("company_id", "experiment_id")
    return (
        daily.withColumn("lowest", F.min("least").over(group))
        .withColumn("highest", F.max("greatest").over(group))
        .filter(F.col("lowest") == F.col("highest"))
        .select(
            C.numeric_id("company_id").alias("company_id"),
            "experiment_id",
            F.col("least").alias("treatment_name"),
            "first_assignment_date",
        )
    )
