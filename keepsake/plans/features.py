"""Churn features: one row per episode."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators.timeline import DAY, along, assign_to_windows, time_slot, trailing_count
from .engagement import observation_windows

ORDER = ("cancel_flow_start_timestamp", "sku", "initiation_rank")

# Tier of each SKU.
SKU_TIERS = {
    "CORE_MONTHLY": 1,
    "CORE_ANNUAL": 1,
    "PLUS_MONTHLY": 2,
    "PLUS_ANNUAL": 2,
    "ADV_MONTHLY": 3,
    "ADV_ANNUAL": 3,
    "PAYROLL_CORE_MONTHLY": 4,
    "PAYROLL_CORE_ANNUAL": 4,
    "LIVE_MONTHLY": 5,
}

# Columns of the feature table, in order.
KEY_COLUMNS = (
    "company_id", "initiation_rank", "cancel_flow_start_timestamp", "initiation_date",
    "product", "initiation_year", "initiation_month",
)
LABEL_COLUMNS = ("churned_31d", "churned_92d", "baked_31d", "baked_92d")
BEHAVIOURAL = (
    "cancel_frequency_90d", "days_since_last_cancel", "initiation_hour_utc",
    "initiation_day_of_week", "is_weekend_initiation", "cancel_flow_screen_oiam_flag",
    "cancel_flow_screen_mobile_flag",
)
PRODUCT = (
    "tenure_days", "billing_frequency_annual_flag", "sku_tier_encoded",
    "subscription_type_direct_flag", "is_accountant_initiated", "tenure_bucket_encoded",
)
ENGAGEMENT = (
    "viewed_cs_ipd", "clicked_cs_ipd", "cs_click_through_rate", "viewed_discount_ipd",
    "clicked_discount_ipd", "discount_click_through_rate", "viewed_upgrade_ipd",
    "clicked_upgrade_ipd", "viewed_downgrade_ipd", "viewed_keep_plan_ipd", "clicked_keep_plan_ipd",
    "total_ipds_shown", "total_ipd_clicks", "overall_click_through_rate", "viewed_dic",
    "dic_max_data_points",
)
TEMPORAL = ("cohort_month_sin", "cohort_month_cos", "is_q4_initiation", "days_since_signup")
SAVE_HISTORY = (
    "lifetime_cs_saves", "lifetime_discount_saves", "lifetime_upgrade_saves",
    "lifetime_abandoned_count", "save_rate_lifetime",
)
MODEL_FEATURES = (*BEHAVIOURAL, *PRODUCT, *ENGAGEMENT, *TEMPORAL, *SAVE_HISTORY)
EXTENDED = (
    "avg_session_duration_s", "page_path_entropy", "n_previous_upgrades",
    "n_previous_downgrades", "n_previous_discounts_taken", "days_until_renewal",
)


def company_history(gold: DataFrame) -> DataFrame:
    """Running outcomes and the previous date per company, in one ordered pass."""
    return along(
        gold,
        ["company_id"],
        ORDER,
        rank="__position",
        running={
            "lifetime_cs_saves": C.flag(F.col("saved_by_cs") == 1),
            "lifetime_discount_saves": C.flag(F.col("took_discount") == 1),
            "lifetime_upgrade_saves": C.flag(F.col("upgraded") == 1),
            "lifetime_abandoned_count": C.flag(F.col("saved_by_abandoning_cancel_flow") == "Y"),
            "__confirmed": C.flag(F.col("cancel_confirmed") == "Y"),
        },
        previous={"__last_day": "initiation_date"},
    )


def behavioural(history: DataFrame) -> DataFrame:
    """Frequency, recency, time of day and screen."""
    counted = trailing_count(
        history, ["company_id"], "cancel_flow_start_timestamp", 90 * DAY, "cancel_frequency_90d"
    )
    start = F.col("cancel_flow_start_timestamp")
    weekday = F.dayofweek(start)
    return counted.withColumns(
        {
            "days_since_last_cancel": F.datediff("initiation_date", "__last_day"),
            "initiation_hour_utc": F.hour(start),
            "initiation_day_of_week": weekday,
            "is_weekend_initiation": C.flag(weekday.isin(1, 7)),
            "cancel_flow_screen_oiam_flag": C.flag(F.col("cancel_flow_screen") == "Account Portal"),
            "cancel_flow_screen_mobile_flag": C.flag(
                F.col("cancel_flow_screen") == "SaaS Mobile App"
            ),
        }
    )


def product(df: DataFrame) -> DataFrame:
    """Tenure, plan and who started it."""
    tiers = F.create_map(*[F.lit(v) for kv in SKU_TIERS.items() for v in kv])
    tenure = F.col("tenure_at_cancel_initiation")
    return df.withColumns(
        {
            "tenure_days": tenure,
            "billing_frequency_annual_flag": C.flag(F.col("billing_frequency") == "annual"),
            "sku_tier_encoded": F.coalesce(tiers[F.col("sku")], F.lit(0)),
            "subscription_type_direct_flag": C.flag(F.col("subscription_type") == "direct"),
            "is_accountant_initiated": C.flag(F.col("is_accountant_starting_cancellation") == "Y"),
            "tenure_bucket_encoded": C.tenure_bucket(tenure),
        }
    )


def engagement(df: DataFrame) -> DataFrame:
    """Offers shown and clicked, and click-through rates."""
    stems = ("cs", "discount", "upgrade", "downgrade", "keep_plan")
    total = lambda action: sum((F.col(f"{action}_{s}_ipd") for s in stems[1:]), F.col(f"{action}_cs_ipd"))
    shown, clicks = total("viewed"), total("clicked")
    rate = lambda stem: C.safe_divide(f"clicked_{stem}_ipd", f"viewed_{stem}_ipd")
    return df.withColumns(
        {
            "total_ipds_shown": shown,
            "total_ipd_clicks": clicks,
            "overall_click_through_rate": C.safe_divide(clicks, shown),
            "cs_click_through_rate": rate("cs"),
            "discount_click_through_rate": rate("discount"),
        }
    )


def temporal(df: DataFrame) -> DataFrame:
    """Season and age of the subscription."""
    month = F.month("initiation_date")
    angle = month * (2 * math.pi / 12)
    return df.withColumns(
        {
            "cohort_month_sin": F.sin(angle),
            "cohort_month_cos": F.cos(angle),
            "is_q4_initiation": C.flag(month >= 10),
            "days_since_signup": F.datediff("initiation_date", "signup_date"),
        }
    )


def save_history(history: DataFrame) -> DataFrame:
    """Save rates per company, and the labels, which stay NULL until baked.

    ``save_rate_lifetime`` counts the current episode among the confirmed ones and divides by the
    rank less one; ``save_rate_prior`` is the share of earlier episodes that were not confirmed.
    """
    rank, earlier = F.col("initiation_rank"), F.col("__position") - 1
    confirmed_before = F.col("__confirmed") - C.flag(F.col("cancel_confirmed") == "Y")
    label = lambda n: F.when(F.col(f"baked_{n}d") == 1, 1 - F.col(f"retained_{n}d"))
    return history.withColumns(
        {
            "save_rate_lifetime": F.when(rank > 1, (rank - F.col("__confirmed")) / (rank - 1)),
            "save_rate_prior": F.when(earlier > 0, (earlier - confirmed_before) / earlier),
            "churned_31d": label(31),
            "churned_92d": label(92),
        }
    )


def features(gold: DataFrame) -> DataFrame:
    """The feature table: keys, labels and the model's columns."""
    full = temporal(engagement(product(save_history(behavioural(company_history(gold))))))
    return full.select(
        *KEY_COLUMNS, *LABEL_COLUMNS, *BEHAVIOURAL, *PRODUCT, *ENGAGEMENT, *TEMPORAL, *SAVE_HISTORY
    )


# ---- features that need the event stream ----------------------------------------------------


def sessions(events: DataFrame, gap_minutes: int = 30) -> DataFrame:
    """Sessions per company in batch: a pause longer than the gap starts a new one."""
    at = events.select(
        C.numeric_id("company_id").alias("company_id"),
        F.col("event_timestamp").try_cast("timestamp").alias("at"),
    )
    moments = at.dropna().distinct()
    spaced = along(moments, ["company_id"], ["at"], previous={"__before": "at"})
    pause = F.unix_micros("at") - F.unix_micros("__before")
    opens = F.when(F.col("__before").isNull() | (pause > gap_minutes * 60_000_000), 1).otherwise(0)
    numbered = along(
        spaced.withColumn("__opens", opens), ["company_id"], ["at"], running={"session": F.col("__opens")}
    )
    return numbered.groupBy("company_id", "session").agg(
        F.min("at").alias("session_start"),
        F.max("at").alias("session_end"),
        ((F.unix_micros(F.max("at")) - F.unix_micros(F.min("at"))) / 1e6).alias("duration_s"),
    )


def prior_session_seconds(gold: DataFrame, found: DataFrame) -> DataFrame:
    """Adds the mean duration of the company's sessions that ended before the episode."""
    rows = gold.withColumn("__at", F.col("cancel_flow_start_timestamp")).withColumn("__last", F.lit(0))
    past = found.select(
        "company_id", F.col("session_end").alias("__at"), F.lit(1).alias("__last"), "duration_s"
    )
    both = rows.unionByName(past, allowMissingColumns=True)
    swept = along(
        both,
        ["company_id"],
        ["__at", "__last", *[c for c in ORDER if c != "cancel_flow_start_timestamp"]],
        time_slot("__at"),
        running={"__seconds": F.coalesce("duration_s", F.lit(0.0)), "__sessions": F.col("__last")},
    ).filter("__last = 0")
    return swept.withColumn(
        "avg_session_duration_s", C.safe_divide("__seconds", "__sessions")
    ).drop("__at", "__last", "duration_s", "__seconds", "__sessions")


def path_entropy(initiations: DataFrame, events: DataFrame) -> DataFrame:
    """Shannon entropy in bits of the page paths seen inside each episode."""
    pages = events.select(
        C.numeric_id("company_id").alias("company_id"),
        F.col("event_timestamp").try_cast("timestamp").alias("at"),
        "event_id",
        F.col("context_page_path").alias("path"),
    ).dropna()
    inside = assign_to_windows(
        pages,
        observation_windows(initiations),
        ["company_id"],
        "lane",
        "at",
        "initiation_timestamp",
        "window_end_timestamp",
        ["initiation_rank"],
    )
    episode = ["company_id", "initiation_rank", "initiation_timestamp"]
    per_path = inside.groupBy(*episode, "path").agg(F.count(F.lit(1)).alias("n"))
    # H = log2(N) - sum(n log2 n) / N
    n_log = F.sum(F.col("n") * F.log2("n"))
    return per_path.groupBy(*episode).agg(
        F.round(F.log2(F.sum("n")) - n_log / F.sum("n"), 6).alias("page_path_entropy")
    )


# Days in a billing period.
BILLING_DAYS = {"monthly": 30, "annual": 365}


def extended(gold: DataFrame, initiations: DataFrame, events: DataFrame) -> DataFrame:
    """Earlier outcomes, days to renewal, mean session length so far and path entropy."""
    gold = gold.select(
        "company_id", "initiation_rank", "cancel_flow_start_timestamp", "sku", "initiation_date",
        "signup_date", "billing_frequency", "upgraded", "downgraded", "took_discount",
    )
    signals = {"upgrades": "upgraded", "downgrades": "downgraded", "discounts_taken": "took_discount"}
    swept = along(
        gold, ["company_id"], ORDER, running={f"__{n}": F.col(c) for n, c in signals.items()}
    )
    period = F.when(F.col("billing_frequency") == "annual", BILLING_DAYS["annual"]).otherwise(
        BILLING_DAYS["monthly"]
    )
    age = F.datediff("initiation_date", "signup_date")
    prior = swept.withColumns(
        {
            **{f"n_previous_{n}": F.col(f"__{n}") - F.col(c) for n, c in signals.items()},
            "days_until_renewal": period - F.pmod(age, period),
        }
    )
    timed = prior_session_seconds(prior, sessions(events))
    entropy = path_entropy(initiations, events).withColumnRenamed(
        "initiation_timestamp", "cancel_flow_start_timestamp"
    )
    keys = ["company_id", "initiation_rank", "cancel_flow_start_timestamp"]
    return (
        timed.join(entropy.hint("merge"), keys, "left")
        .fillna(0.0, ["page_path_entropy"])
        .select(*keys, *EXTENDED)
    )
