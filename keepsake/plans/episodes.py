"""Cancellation episodes: one row per company and initiation time."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import taxonomy as X
from ..operators.flags import collapse
from ..operators.joins import dimension_join, one_per_key
from ..operators.timeline import along, next_times
from ..operators.upsert import merge_upsert
from ..schemas import TABLE_PARTITIONS
from ..sources.staging import stage
from ..sources.tables import write_partitions

ATTRIBUTES = (
    "product",
    "sku",
    "billing_frequency",
    "subscription_type",
    "properties_url_host_name",
    "ua_parser_device_type",
    "context_page_path",
)
MILESTONES = ("initiation", "confirmation", "upgrade", "downgrade")


def flow_moments(events: DataFrame, kinds: Sequence[str] = MILESTONES) -> DataFrame:
    """One row per company, time and kind of cancel-flow event; one scan, combined map-side."""
    tagged = (
        events.filter(X.is_flow_event())
        .withColumn("kind", X.milestone())
        .filter(F.col("kind").isin(*kinds) & F.col("company_id").isNotNull())
        .withColumn("at", F.col("event_timestamp").try_cast("timestamp"))
        .filter("at IS NOT NULL")
    )
    return collapse(
        tagged,
        ["company_id", "at", "kind"],
        ATTRIBUTES,
        accountant_id_starting_cancellation=C.non_blank("accountant_realm_id"),
    )


def company_dimension(companies: DataFrame) -> DataFrame:
    """One row per company (the earliest sign-up) with a text id for the event side."""
    typed = companies.select(
        C.numeric_id("company_id").alias("company_key"),
        F.col("signup_date").try_cast("date").alias("signup_date"),
        "country",
        "is_suspicious",
    )
    unique = one_per_key(typed.filter("company_key IS NOT NULL"), ["company_key"], [F.col("signup_date").asc_nulls_last()])
    return unique.withColumn("company_id", F.col("company_key").cast("string"))


# Lane of episodes without a SKU.
NO_SKU = "\u0000"


def lane(sku: str = "sku"):
    """The SKU as a key, which must not be NULL."""
    return F.coalesce(sku, F.lit(NO_SKU))


def with_windows(
    starts: DataFrame, default: str = "1 hour", cap: str | None = None, slot=None
) -> DataFrame:
    """Rank and observation window per company and SKU.

    The window ends at the next initiation, or ``default`` after the last one; ``cap`` bounds it.
    """
    ranked = along(
        starts.withColumn("__lane", lane()),
        ["company_id", "__lane"],
        ["initiation_timestamp"],
        slot,
        rank="initiation_rank",
        following={"next_start": "initiation_timestamp"},
    )
    start = F.col("initiation_timestamp")
    end = F.coalesce("next_start", start + F.expr(f"INTERVAL {default}"))
    if cap:
        end = F.least(end, start + F.expr(f"INTERVAL {cap}"))
    return ranked.withColumn("window_end_timestamp", end).drop("next_start", "__lane")


def first_after(
    moments: DataFrame,
    match_on: Sequence[str] = ("company_id",),
    kinds: Sequence[str] = ("confirmation", "upgrade", "downgrade"),
    slot=None,
) -> DataFrame:
    """Per initiation (company and time) the first moment of each kind at or after it.

    ``match_on`` may add the SKU, so that an event only counts for episodes of its own SKU.
    """
    keyed = moments.withColumn("__lane", lane())
    keys = ["__lane" if k == "sku" else k for k in match_on]
    narrow = keyed.filter(F.col("kind").isin("initiation", *kinds)).select(
        *dict.fromkeys(["company_id", *keys]), "at", "kind"
    )
    targets = {f"next_{kind}": F.col("kind") == kind for kind in kinds}
    swept = next_times(narrow, keys, "at", targets, slot).filter("kind = 'initiation'")
    return swept.select("company_id", F.col("at").alias("initiation_timestamp"), *targets)


def within(found: str, start: str, end, closed: bool = False):
    """The found time when it lies in ``[start, end)``, or ``[start, end]`` if ``closed``."""
    t = F.col(found)
    return F.when((t <= end) if closed else (t < end), t)


def initiations(
    events: DataFrame,
    companies: DataFrame,
    start: str | None = None,
    end: str | None = None,
    match_on: Sequence[str] = ("company_id",),
    cap: str | None = None,
    cut: Callable[[DataFrame, str], DataFrame] = stage,
) -> DataFrame:
    """Episodes with their first confirmation, upgrade and downgrade.

    ``events`` should reach back before ``start`` and one day past ``end``, so that ranks and late
    confirmations are right at the edges; only episodes of ``[start, end]`` are returned. ``cut``
    materialises the few cancel-flow rows once, since several branches read them.
    """
    return episodes_of(cut(flow_moments(events), "moments"), companies, start, end, match_on, cap)


def episodes_of(
    moments: DataFrame,
    companies: DataFrame,
    start: str | None = None,
    end: str | None = None,
    match_on: Sequence[str] = ("company_id",),
    cap: str | None = None,
) -> DataFrame:
    """Episodes of the companies in ``moments``, which must hold their whole history."""
    starts = (
        moments.filter(F.col("kind") == "initiation")
        .withColumnRenamed("at", "initiation_timestamp")
        .drop("kind")
    )
    # The two sweeps read the few moments independently and meet on their unique key; the company
    # comes last, so that it is looked up once. All are merged: the planner would gather them in the driver by the
    # size of the compressed files they come from.
    swept = with_windows(starts, cap=cap).join(
        first_after(moments, match_on).hint("merge"), ["company_id", "initiation_timestamp"]
    )
    known = company_dimension(companies).filter(F.col("is_suspicious") == 0).drop("is_suspicious")
    swept = dimension_join(swept, known.hint("merge"), ["company_id"])

    began = F.col("initiation_timestamp")
    day_after = began + F.expr("INTERVAL 1 DAY")
    day = F.to_date(began)
    accountant = C.accountant_flag("accountant_id_starting_cancellation")
    timed = (
        swept.withColumn(
            "confirmation_timestamp", within("next_confirmation", began, F.col("window_end_timestamp"))
        )
        .withColumn("upgrade_timestamp", within("next_upgrade", began, day_after, closed=True))
        .withColumn("downgrade_timestamp", within("next_downgrade", began, day_after, closed=True))
        .withColumn("initiation_date", day)
        .withColumn("is_accountant_starting_cancellation", accountant)
        .filter(C.eligible("country", "is_accountant_starting_cancellation", F.lit(0)))
    )
    if start and end:
        timed = timed.filter(F.col("initiation_date").between(start, end))
    happened = lambda c: C.flag(F.col(c).isNotNull())
    return timed.select(
        F.col("company_key").alias("company_id"),
        "signup_date",
        F.datediff("initiation_date", "signup_date").alias("tenure_at_cancel_initiation"),
        "sku",
        "billing_frequency",
        "subscription_type",
        "properties_url_host_name",
        "ua_parser_device_type",
        "context_page_path",
        "accountant_id_starting_cancellation",
        "is_accountant_starting_cancellation",
        "initiation_date",
        "initiation_timestamp",
        "initiation_rank",
        "window_end_timestamp",
        happened("confirmation_timestamp").alias("cancel_confirmed"),
        "confirmation_timestamp",
        happened("upgrade_timestamp").alias("upgraded"),
        "upgrade_timestamp",
        happened("downgrade_timestamp").alias("downgraded"),
        "downgrade_timestamp",
        "product",
        C.partition_year("initiation_date").alias("initiation_year"),
        C.partition_month("initiation_date").alias("initiation_month"),
    )


def initiations_of_slice(
    spark: SparkSession,
    events: DataFrame,
    companies: DataFrame,
    label: str,
    moments_path: str,
    table_path: str,
    **options,
) -> int:
    """Bring the stored table of episodes up to date with one more slice of events; returns rows written.

    ``events`` are those of the slice (a day) only. Their few cancel-flow moments are stored under ``label``,
    and a slice can be run again. History is carried by that small table: the episodes of the
    companies that occur in the slice are made anew from all their moments, so ranks go on, the window of an
    earlier episode ends where the next one starts and a late confirmation reaches its episode; then they are
    merged into the table by company and time.
    """
    fresh = flow_moments(events).withColumn("slice", F.lit(label))
    if write_partitions(fresh, moments_path, ["slice"]) == 0:
        return 0
    stored = spark.read.schema(fresh.schema).parquet(moments_path)
    touched = stored.filter(F.col("slice") == label).select("company_id").distinct()
    history = stored.join(touched, "company_id", "left_semi").drop("slice")
    # A time that two slices hold is one moment.
    history = stage(one_per_key(history, ["company_id", "at", "kind"]), "history")
    made = episodes_of(history, companies, **options)
    return merge_upsert(spark, table_path, made, ["company_id", "initiation_timestamp"], TABLE_PARTITIONS)
