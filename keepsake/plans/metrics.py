"""The wide reporting table: one row per episode."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators.flags import flag_pivot
from ..operators.joins import exists_after, left_with_defaults
from ..schemas import EPISODE_KEY
from ..sources.staging import stage
from .attribution import save_attribution
from .engagement import offer_engagement
from .episodes import initiations

# Column stem per offer class.
OFFER_COLUMNS = {
    "cs": "CS IPD",
    "discount": "Discount IPD",
    "upgrade": "Upgrade IPD",
    "downgrade": "Downgrade IPD",
    "keep_plan": "Keep my Plan IPD",
}
RETENTION_DAYS = (31, 92)


def engagement_flags(engagement: DataFrame) -> DataFrame:
    """Views and clicks per offer class and the usage widget, one row per episode."""
    return flag_pivot(
        engagement,
        EPISODE_KEY,
        "ipd_type",
        OFFER_COLUMNS,
        {"viewed_{}_ipd": "viewed_ipd", "clicked_{}_ipd": "clicked_ipd"},
        viewed_dic=F.max(F.coalesce("viewed_dic_component", F.lit(0))),
        dic_max_data_points=F.max(F.coalesce("number_of_data_points_shown", F.lit(0))),
    )


def retention(
    episodes: DataFrame,
    status: DataFrame,
    as_of: Column,
    days: tuple[int, ...] = RETENTION_DAYS,
    days_of: DataFrame | None = None,
) -> DataFrame:
    """Adds ``baked_Nd`` and ``retained_Nd`` for each horizon; see ``exists_after`` for ``days_of``."""
    active = status.filter(F.col("open_subscriber") == 1).select(
        C.numeric_id("company_id").alias("company_id"), "date_of"
    )
    offsets = {f"retained_{n}d": n for n in days}
    looked_up = exists_after(
        episodes, ["company_id"], "initiation_date", active, "date_of", offsets, days_of
    )
    return looked_up.withColumns(
        {f"baked_{n}d": C.baked("initiation_date", n, as_of) for n in days}
    )


def final_metrics(
    episodes: DataFrame,
    attributed: DataFrame,
    engagement: DataFrame,
    status: DataFrame,
    as_of: Column | None = None,
    now: Column | None = None,
) -> DataFrame:
    """Episodes with outcome, engagement and retention flags, 55 columns."""
    as_of = F.current_date() if as_of is None else as_of
    outcome = attributed.select(
        *EPISODE_KEY,
        "contacted_by_cs",
        "saved_by_cs",
        "took_discount",
        "discount_take_timestamp",
        "save_attribution",
        "saved_by_abandoning",
    )
    flags = engagement_flags(engagement)
    helped = dict.fromkeys(("contacted_by_cs", "saved_by_cs", "took_discount"), 0)
    shown = dict.fromkeys((c for c in flags.columns if c not in EPISODE_KEY), 0)
    wide = left_with_defaults(episodes, outcome, EPISODE_KEY, helped)
    wide = left_with_defaults(wide, flags, EPISODE_KEY, shown)
    wide = retention(wide, status, as_of, days_of=episodes)
    stems = list(OFFER_COLUMNS)
    selected = wide.select(
        "company_id",
        F.col("company_id").cast("string").alias("realm_id"),
        "signup_date",
        "tenure_at_cancel_initiation",
        "sku",
        "billing_frequency",
        "subscription_type",
        "initiation_date",
        F.col("initiation_timestamp").alias("cancel_flow_start_timestamp"),
        "initiation_rank",
        C.flag_to_yes_no("cancel_confirmed").alias("cancel_confirmed"),
        F.col("confirmation_timestamp").alias("cancel_confirmation_timestamp"),
        C.flag_to_yes_no("saved_by_cs").alias("saved_by_customer_support"),
        C.flag_to_yes_no("upgraded").alias("saved_by_upgrading"),
        C.flag_to_yes_no("downgraded").alias("saved_by_downgrading"),
        C.flag_to_yes_no("took_discount").alias("saved_by_taking_discount"),
        "discount_take_timestamp",
        F.coalesce("saved_by_abandoning", F.lit("N")).alias("saved_by_abandoning_cancel_flow"),
        "is_accountant_starting_cancellation",
        "accountant_id_starting_cancellation",
        C.classify_screen(
            "properties_url_host_name", "ua_parser_device_type", "context_page_path"
        ).alias("cancel_flow_screen"),
        "properties_url_host_name",
        "ua_parser_device_type",
        "context_page_path",
        "save_attribution",
        "contacted_by_cs",
        "saved_by_cs",
        "upgraded",
        "upgrade_timestamp",
        "downgraded",
        "downgrade_timestamp",
        "took_discount",
        *[f"{action}_{stem}_ipd" for stem in stems for action in ("viewed", "clicked")],
        "viewed_dic",
        "dic_max_data_points",
        *[f"{name}_{n}d" for n in RETENTION_DAYS for name in ("baked", "retained")],
        # Kept for readers of older versions of the table, always NULL.
        F.lit(None).cast("string").alias("treatment_name"),
        F.lit(None).cast("date").alias("first_assignment_date"),
        "product",
        "initiation_year",
        "initiation_month",
    )
    return C.with_audit(selected, now)


def build_tables(
    events: DataFrame,
    companies: DataFrame,
    catalog: DataFrame,
    reactive_saves: DataFrame,
    offer_history: DataFrame,
    status: DataFrame,
    as_of: Column | None = None,
    start: str | None = None,
    end: str | None = None,
    cut: Callable[[DataFrame, str], DataFrame] = stage,
) -> dict[str, DataFrame]:
    """All steps in one session; every step that later steps share is written once."""
    episodes = cut(initiations(events, companies, start, end, cut=cut), "initiations")
    engaged = cut(offer_engagement(episodes, events, catalog), "engagement")
    attributed = cut(
        save_attribution(episodes, engaged, reactive_saves, offer_history), "attribution"
    )
    gold = cut(final_metrics(episodes, attributed, engaged, status, as_of), "metrics")
    return {
        "initiations": episodes,
        "engagement": engaged,
        "attribution": attributed,
        "final_metrics": gold,
    }
