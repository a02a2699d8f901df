"""Offer and usage-widget engagement per episode."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import taxonomy as X
from ..operators.joins import dimension_join, one_per_key
from ..operators.timeline import HOUR, assign_to_windows
from ..schemas import EPISODE_KEY
from .episodes import lane

EPISODE = [*EPISODE_KEY, "window_end_timestamp", "product", "initiation_year", "initiation_month"]


def describe_offers(catalog: DataFrame) -> DataFrame:
    """Catalog with the JSON description parsed once per offer, one row per offer id."""
    copy = "copy_data"
    unique = one_per_key(
        catalog.select("offer_id", "offer_name", copy).filter("offer_id IS NOT NULL"),
        ["offer_id"],
        ["offer_name"],
    )
    return unique.select(
        "offer_id",
        "offer_name",
        F.coalesce(C.json_text(copy, "ctaText"), C.json_text(copy, "primaryCtaText")).alias(
            "primaryCtaText"
        ),
        C.json_text(copy, "obillOfferId").alias("obill_offer_id"),
        C.classify_offer_copy(copy).alias("ipd_type"),
    )


def observation_windows(initiations: DataFrame) -> DataFrame:
    """Episodes that end at their confirmation, or at the end of their window."""
    end = F.coalesce("confirmation_timestamp", "window_end_timestamp")
    others = [c for c in EPISODE if c != "window_end_timestamp"]
    return initiations.select(*others, lane().alias("lane"), end.alias("window_end_timestamp"))


def interactions(events: DataFrame) -> DataFrame:
    """Offer views and clicks in the cancel flow, and usage-widget views."""
    kind = F.coalesce(
        F.when(X.OFFER_VIEWED.match(), F.lit("viewed")),
        F.when(X.OFFER_CLICKED.match(), F.lit("clicked")),
        F.when(X.USAGE_WIDGET_VIEWED.match(), F.lit("widget")),
    )
    is_offer = F.col("kind") != "widget"
    return (
        events.filter(X.is_flow_event())
        .withColumn("kind", kind)
        .filter("kind IS NOT NULL")
        .select(
            C.numeric_id("company_id").alias("company_id"),
            F.col("event_timestamp").try_cast("timestamp").alias("at"),
            "kind",
            F.when(is_offer, F.col(X.ACCESS_POINT)).alias(X.ACCESS_POINT),
            F.when(is_offer, F.col("properties_custom_fp_offer_id")).alias("offer_id"),
            F.when(~is_offer, F.col(X.DETAIL)).alias("payload"),
        )
        .filter("company_id IS NOT NULL AND at IS NOT NULL")
    )


def in_episodes(initiations: DataFrame, events: DataFrame, slot_seconds: int = HOUR) -> DataFrame:
    """Interactions with the episodes they fall into: one per SKU lane of the company at most."""
    windows = observation_windows(initiations)
    # Equal rows count once in every measure, so copies are combined before anything is shuffled.
    return assign_to_windows(
        interactions(events).distinct(),
        windows,
        ["company_id"],
        "lane",
        "at",
        "initiation_timestamp",
        "window_end_timestamp",
        ["initiation_rank", "product", "initiation_year", "initiation_month"],
        slot_seconds,
    )


def _widget_measures() -> list:
    widget = F.col("kind") == "widget"
    shown = C.json_text("payload", "data_object_display_count").try_cast("int")
    latest = F.when(widget & F.col("payload").isNotNull(), F.struct("at", "payload"))
    return [
        F.max(F.when(widget, 1)).alias("viewed_dic_component"),
        F.max(F.when(widget, shown)).alias("number_of_data_points"),
        F.max(latest).alias("__latest"),
        F.min(F.when(widget, F.col("at"))).alias("dic_impression_timestamp"),
    ]


def widget_summary(assigned: DataFrame) -> DataFrame:
    """Usage-widget impressions per episode."""
    summary = assigned.filter("kind = 'widget'").groupBy(*EPISODE).agg(*_widget_measures())
    return summary.withColumn("dic_component_detail", F.col("__latest.payload")).drop("__latest")


def offer_engagement(
    initiations: DataFrame, events: DataFrame, catalog: DataFrame, how: str = "inner"
) -> DataFrame:
    """One row per episode, access point and offer.

    ``how="left"`` keeps offers that the catalog does not know. Interactions are reduced to one row
    per episode, access point and offer before the widget values spread over the episode and
    before the catalog is joined.
    """
    if how not in {"inner", "left"}:
        raise ValueError("the catalog is joined 'inner' or 'left'")
    assigned = in_episodes(initiations, events)
    touch = lambda kind: C.flag(F.col("kind") == kind)
    per_offer = assigned.groupBy(*EPISODE, X.ACCESS_POINT, "offer_id").agg(
        F.min(F.when(F.col("kind") == "viewed", F.col("at"))).alias("ipd_view_timestamp"),
        F.max(touch("viewed")).alias("viewed_ipd"),
        F.max(touch("clicked")).alias("clicked_ipd"),
        *_widget_measures(),
    )
    episode = Window.partitionBy(*EPISODE_KEY)
    spread = per_offer.withColumns(
        {
            "viewed_dic_component": F.coalesce(F.max("viewed_dic_component").over(episode), F.lit(0)),
            "number_of_data_points_shown": F.coalesce(
                F.max("number_of_data_points").over(episode), F.lit(0)
            ),
            "dic_component_detail": F.max("__latest").over(episode)["payload"],
            "dic_impression_timestamp": F.min("dic_impression_timestamp").over(episode),
        }
    ).filter((F.col("viewed_ipd") == 1) | (F.col("clicked_ipd") == 1))
    offers = dimension_join(spread, describe_offers(catalog).hint("merge"), ["offer_id"], how)
    return offers.select(
        *EPISODE_KEY,
        "window_end_timestamp",
        X.ACCESS_POINT,
        "offer_id",
        "offer_name",
        "primaryCtaText",
        "obill_offer_id",
        F.coalesce("ipd_type", F.lit("Unknown")).alias("ipd_type"),
        "ipd_view_timestamp",
        "viewed_ipd",
        "clicked_ipd",
        "viewed_dic_component",
        "number_of_data_points_shown",
        "dic_component_detail",
        "dic_impression_timestamp",
        "product",
        "initiation_year",
        "initiation_month",
    )
