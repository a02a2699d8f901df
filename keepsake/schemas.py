"""Schemas, value domains and table contracts."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


# Fields of a clickstream event. Batch and stream share them.
EVENT_FIELDS = (
    "event_id", "company_id", "accountant_realm_id", "session_id", "event",
    "properties_object_detail", "properties_ui_object_detail", "properties_ui_access_point",
    "properties_url_host_name", "properties_custom_fp_offer_id", "product", "sku",
    "billing_frequency", "subscription_type", "ua_parser_device_type", "context_page_path",
    "event_timestamp", "event_date", "properties_screen", "workflow_state", "widget_state",
)
EVENT_SCHEMA = T.StructType(
    [
        T.StructField(name, T.TimestampType() if name == "event_timestamp" else T.StringType())
        for name in EVENT_FIELDS
    ]
)

REQUIRED_EVENT_FIELDS = ("event_id", "company_id", "event_timestamp")

# Closed value domains.
YES_NO = ("Y", "N")
OUTCOMES = (
    "CS Save",
    "Cancelled",
    "Upgrade Save",
    "Downgrade Save",
    "Discount Save",
    "Abandoned",
)
PRODUCTS = ("SAAS_CORE", "SAAS_PLUS", "SAAS_ADVANCED", "SAAS_PAYROLL", "SAAS_LIVE")
BILLING_FREQUENCIES = ("monthly", "annual")
OFFER_TYPES = (
    "CS IPD",
    "Discount IPD",
    "Upgrade IPD",
    "Downgrade IPD",
    "Keep my Plan IPD",
    "Unknown",
)
SCREENS = ("Account Portal", "SaaS Mobile App", "SaaS Web App", "Unknown")

EPISODE_KEY = ("company_id", "initiation_rank", "initiation_timestamp")
TABLE_PARTITIONS = ("product", "initiation_year", "initiation_month")


@dataclass(frozen=True)
class FieldRule:
    type: str
    nullable: bool = True
    values: tuple = ()
    pii: bool = False
    aliases: tuple[str, ...] = ()


@dataclass(frozen=True)
class Contract:
    entity: str
    partition_keys: tuple[str, ...]
    primary_key: tuple[str, ...]
    fields: dict[str, FieldRule] = field(default_factory=dict)


FLAG = (0, 1)

FINAL_METRICS_CONTRACT = Contract(
    entity="rpt_cancel_flow_final_metrics",
    partition_keys=TABLE_PARTITIONS,
    primary_key=("company_id", "initiation_rank", "cancel_flow_start_timestamp"),
    fields={
        "company_id": FieldRule("bigint", nullable=False),
        "realm_id": FieldRule("string"),
        "product": FieldRule("string", values=PRODUCTS),
        "cancel_flow_start_timestamp": FieldRule("timestamp", nullable=False),
        "initiation_rank": FieldRule("int", nullable=False),
        "cancel_confirmed": FieldRule("string", values=YES_NO),
        "save_attribution": FieldRule("string", values=OUTCOMES),
        "baked_31d": FieldRule("int", values=FLAG),
        "retained_31d": FieldRule("int", values=FLAG),
        "viewed_dic": FieldRule("int", values=FLAG),
        "dwh_create_date": FieldRule("timestamp", nullable=False),
    },
)

ENGAGEMENT_CONTRACT = Contract(
    entity="rpt_ipd_detailed_engagement",
    partition_keys=TABLE_PARTITIONS,
    primary_key=(
        "company_id",
        "initiation_rank",
        "initiation_timestamp",
        "properties_ui_access_point",
        "properties_custom_fp_offer_id",
    ),
    fields={
        "company_id": FieldRule("bigint", nullable=False),
        "initiation_rank": FieldRule("int", nullable=False),
        "initiation_timestamp": FieldRule("timestamp", nullable=False),
        "properties_ui_access_point": FieldRule("string"),
        "properties_custom_fp_offer_id": FieldRule("string", aliases=("offer_id",)),
        "ipd_type": FieldRule("string", values=OFFER_TYPES),
        "viewed_ipd": FieldRule("int", values=FLAG),
        "clicked_ipd": FieldRule("int", values=FLAG),
        "viewed_dic_component": FieldRule("int", nullable=False, values=FLAG),
        "number_of_data_points_shown": FieldRule("int", nullable=False),
    },
)
