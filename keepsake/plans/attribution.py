"""What became of each episode."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators.joins import day_span, flags_on_days
from ..schemas import EPISODE_KEY

# Support programs whose cases count as saves, and the days they have.
CS_PROGRAMS = ("SaaS Core", "SaaS Plus", "SaaS Advanced")
CS_DAYS = 7
DISCOUNT_DAYS = 1


def support_contacts(episodes: DataFrame, reactive_saves: DataFrame) -> DataFrame:
    """Adds ``contacted_by_cs`` and ``saved_by_cs`` from cases on the day or the 7 days after."""
    cases = reactive_saves.filter(F.col("program").isin(*CS_PROGRAMS)).select(
        C.numeric_id("report_company_id").alias("company_id"),
        F.col("report_dt").try_cast("date").alias("report_day"),
        "cc_id",
        "saved_cases",
    )
    flagged = flags_on_days(
        episodes,
        ["company_id"],
        "initiation_date",
        cases.filter("report_day IS NOT NULL AND company_id IS NOT NULL"),
        "report_day",
        CS_DAYS,
        {
            "contacted_by_cs": C.flag(F.col("cc_id").isNotNull()),
            "saved_by_cs": C.flag(F.col("saved_cases") == 1),
        },
        day_span(episodes, "initiation_date"),
    )
    return flagged.fillna(0, ["contacted_by_cs", "saved_by_cs"])


def discount_shown(engagement: DataFrame) -> DataFrame:
    """Discount offers seen in each episode, with clean offer ids."""
    return (
        engagement.filter((F.col("ipd_type") == "Discount IPD") & F.col("obill_offer_id").isNotNull())
        .select(*EPISODE_KEY, C.clean_offer_id("obill_offer_id").alias("obill_offer_id"))
        .distinct()
    )


def discount_taken(engagement: DataFrame, offer_history: DataFrame) -> DataFrame:
    """Episodes whose shown discount was bought on the day or the day after."""
    shown = discount_shown(engagement).withColumn("day", F.to_date("initiation_timestamp"))
    purchases = offer_history.select(
        C.numeric_id("company_id").alias("company_id"),
        F.col("offer_id").cast("string").alias("obill_offer_id"),
        F.col("purchase_datetime").try_cast("timestamp").alias("bought"),
    ).withColumn("bought_day", F.to_date("bought"))
    matched = flags_on_days(
        shown,
        ["company_id", "obill_offer_id"],
        "day",
        purchases.filter("bought IS NOT NULL AND company_id IS NOT NULL"),
        "bought_day",
        DISCOUNT_DAYS,
        {"first_bought": F.col("bought")},
        day_span(engagement, F.to_date("initiation_timestamp")),
    )
    return (
        matched.filter("first_bought IS NOT NULL")
        .groupBy(*EPISODE_KEY)
        .agg(F.lit(1).alias("took_discount"), F.min("first_bought").alias("discount_take_timestamp"))
    )


def save_attribution(
    initiations: DataFrame,
    engagement: DataFrame,
    reactive_saves: DataFrame,
    offer_history: DataFrame,
) -> DataFrame:
    """Exactly one row per episode: save flags, the winning outcome, the passive-save flag."""
    helped = support_contacts(initiations, reactive_saves)
    full = helped.join(discount_taken(engagement, offer_history), [*EPISODE_KEY], "left").fillna(
        0, ["took_discount"]
    )
    signals = ("saved_by_cs", "cancel_confirmed", "upgraded", "downgraded", "took_discount")
    return full.select(
        *EPISODE_KEY,
        "initiation_date",
        "cancel_confirmed",
        "confirmation_timestamp",
        "contacted_by_cs",
        "saved_by_cs",
        "upgraded",
        "upgrade_timestamp",
        "downgraded",
        "downgrade_timestamp",
        "took_discount",
        "discount_take_timestamp",
        C.attribution(*signals).alias("save_attribution"),
        C.abandoned_without_help(*signals).alias("saved_by_abandoning"),
        "accountant_id_starting_cancellation",
        "is_accountant_starting_cancellation",
        "product",
        "initiation_year",
        "initiation_month",
    )
