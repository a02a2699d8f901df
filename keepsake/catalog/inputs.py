"""The given generic tables seen as clickstream, dimensions and facts.

Each input column is one expression that Spark SQL and ANSI SQL read alike, so the same text serves
the DataFrame side and the SQL side. Only the base projections differ in JSON syntax.

``e`` event id, ``u`` user id, ``et`` event type, ``k`` the number in ``props``, ``t`` event time.
Half of the events lie 70 days later than given, so that trailing windows and retention horizons
cut through the data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C

AS_OF = "2024-05-01"
FIRST_DAY, LAST_DAY = "2024-01-01", "2024-04-30"


# How Spark reads the CASE expressions below.
_LOOKUPS: dict[str, str] = {}


def pick(selector: str, *values: str | None) -> str:
    """CASE over the values 0, 1, 2, ... of ``selector``."""
    arms = " ".join(
        f"WHEN {i} THEN {'NULL' if v is None else v}" for i, v in enumerate(values)
    )
    case = f"CASE {selector} {arms} END"
    if all(v is None or (v.startswith("'") and "||" not in v) for v in values):
        texts = ", ".join(v or "NULL" for v in values)
        _LOOKUPS[case] = f"get(array({texts}), CAST({selector} AS INT))"
    return case


def q(*texts: str) -> list[str]:
    return [f"'{t}'" for t in texts]


EVENT_TIME = "ts + CASE WHEN {k} >= 50 THEN INTERVAL '70' DAY ELSE INTERVAL '0' DAY END"

USER = "CAST(u AS STRING)"
EVENT_NUMBER = "CAST(e AS STRING)"
# SKUs in tier order.
SKUS = (
    "CORE_MONTHLY", "CORE_ANNUAL", "PLUS_MONTHLY", "PLUS_ANNUAL", "ADV_MONTHLY", "ADV_ANNUAL",
    "PAYROLL_CORE_MONTHLY", "PAYROLL_CORE_ANNUAL", "LIVE_MONTHLY",
)
SKU_NUMBER = "(u * 2 + k % 3) % 9"
PRODUCT = pick(
    SKU_NUMBER, *q("SAAS_CORE", "SAAS_CORE", "SAAS_PLUS", "SAAS_PLUS", "SAAS_ADVANCED",
                   "SAAS_ADVANCED", "SAAS_PAYROLL", "SAAS_PAYROLL", "SAAS_LIVE")
)


def document(user: str) -> str:
    return f"'{{\"client_realm_id\": \"' || {user} || '\", \"product\": \"' || {PRODUCT} || '\"}}'"


RAW_EVENTS = {
    "event_id": f"'e' || {EVENT_NUMBER}",
    "session_id": f"'s' || {USER} || '-' || CAST(k % 10 AS STRING)",
    "company_id": f"CASE WHEN e % 97 = 2 THEN 'x' || {USER} WHEN e % 3 = 2 THEN {USER} END",
    "accountant_realm_id": (
        f"CASE WHEN u % 9 = 0 AND k % 4 <> 0 THEN 'ACCT_' || {USER} WHEN u % 9 = 1 THEN '  ' END"
    ),
    "workflow_state": (
        f"CASE WHEN e % 3 = 0 THEN {document(USER)} "
        "WHEN e % 9 = 1 THEN '{\"client_realm_id\": \"  \"}' WHEN e % 9 = 2 THEN 'not json' END"
    ),
    "widget_state": (
        f"CASE WHEN e % 3 = 1 THEN {document(USER)} "
        "WHEN e % 6 = 0 THEN '{\"client_realm_id\": \"999999999\", \"product\": \"SAAS_LIVE\"}' END"
    ),
    "product": f"CASE WHEN e % 3 = 2 THEN {PRODUCT} END",
    "sku": f"CASE WHEN k % 37 = 0 THEN NULL ELSE {pick(SKU_NUMBER, *q(*SKUS))} END",
    "billing_frequency": f"CASE WHEN ({SKU_NUMBER}) % 2 = 1 THEN 'annual' ELSE 'monthly' END",
    "subscription_type": "CASE WHEN u % 2 = 0 THEN 'direct' ELSE 'partner' END",
    "properties_url_host_name": pick(
        "u % 5", *q("Accounts.saas.com", "app.saas.com", "mobile.saas.com",
                    "dashboard.example.com", "unknown-host.com")
    ),
    "ua_parser_device_type": pick("k % 4", *q("desktop", "mobile", "Tablet", "desktop")),
    "context_page_path": pick(
        "k % 7", *q("/AccountManager/billing", "/accounts.settings", "/home", "/home", "/plans",
                    "/billing"), None
    ),
    "event": (
        "CASE WHEN et = 'signup' AND e % 13 = 0 THEN ' workflow:   started ' "
        "WHEN et = 'signup' AND k % 2 = 1 THEN 'workflow:started' "
        "WHEN et = 'signup' THEN 'workflow: started' "
        "WHEN et = 'purchase' AND k % 4 = 3 THEN 'cancelation flow: viewed' "
        "WHEN et = 'purchase' AND k % 4 = 2 THEN 'workflow:completed' "
        "WHEN et = 'purchase' THEN 'workflow: completed' "
        "WHEN et = 'error' AND k % 10 = 0 THEN 'workflow: engaged' "
        "WHEN et = 'error' AND k % 5 = 0 THEN 'widget:engaged' "
        "WHEN et = 'error' THEN 'page: error' "
        "WHEN et = 'click' AND k % 2 = 1 THEN 'offer:clicked' "
        "WHEN et = 'click' THEN 'offer: viewed' "
        "ELSE 'content: viewed' END"
    ),
    "properties_object_detail": (
        "CASE WHEN et = 'signup' AND k % 10 = 9 THEN 'registration' "
        "WHEN et = 'signup' AND k % 2 = 1 THEN 'cancellation_workflow' "
        "WHEN et = 'signup' THEN 'cancel' "
        "WHEN et = 'purchase' AND k % 4 = 0 THEN 'cancel' "
        "WHEN et = 'purchase' AND k % 4 = 1 THEN 'upgrade' "
        "WHEN et = 'purchase' AND k % 4 = 2 THEN 'downgrade' "
        "WHEN et = 'purchase' AND k % 8 = 7 THEN 'canceled' "
        "WHEN et = 'error' THEN 'cancellation_workflow' "
        "WHEN et = 'view' AND k % 10 = 7 THEN 'other-widget' "
        "WHEN et = 'view' THEN 'usage-highlights-widget' END"
    ),
    "properties_ui_object_detail": (
        "CASE WHEN et = 'signup' AND k % 2 = 1 THEN 'cancel' "
        "WHEN et = 'signup' THEN 'cancel_subscription' "
        "WHEN et = 'purchase' AND k % 4 = 0 THEN 'cancel_success' "
        "WHEN et = 'purchase' AND k % 4 IN (1, 2) THEN 'get_started' "
        "WHEN et = 'error' AND k % 5 = 0 THEN 'yes_cancel' "
        "WHEN et = 'view' AND k % 10 = 3 THEN 'oops' "
        "WHEN et = 'view' THEN '{\"data_object_display_count\": ' || CAST(k % 6 AS STRING) || '}' END"
    ),
    "properties_ui_access_point": (
        "CASE WHEN et = 'purchase' AND k % 4 = 3 AND k % 12 <> 11 THEN 'cancel success' "
        "WHEN et = 'click' THEN "
        + pick(
            "e % 8", *q("CancelFlowBillingCancel", "CancelFlowTalkToExpert",
                        "AccountSettingsCancel", "MobileAppBillingCancel",
                        "CancelFlowBillingPage", "MobileAppCancelSupport", "HomePage"), None
        )
        + " END"
    ),
    "properties_screen": "CASE WHEN et = 'purchase' AND k % 8 = 3 THEN 'cancel complete' END",
    "properties_custom_fp_offer_id": (
        "CASE WHEN et = 'click' THEN 'OFF-' || CAST(k % 40 AS STRING) END"
    ),
}

OFFERS = {
    "offer_id": "'OFF-' || CAST(p_partkey AS STRING)",
    "offer_name": "p_name || CASE WHEN copy = 1 THEN ' (again)' ELSE '' END",
    "copy_data": "CASE WHEN p_partkey % 25 = 7 THEN 'not json' ELSE "
    + pick(
        "p_partkey % 6",
        "'{\"ctaAction\": \"contact-us-widget\", \"ctaText\": \"Talk to us\"}'",
        "'{\"primaryCtaAction\": \"external\", \"primaryCtaText\": \"Save now\", "
        "\"primaryCtaUrl\": \"https://x/obillupgrade\", \"obillOfferId\": \"' || chr(39) "
        "|| 'OB-' || CAST(p_partkey AS STRING) || chr(39) || ' \"}'",
        "'{\"primaryCtaAction\": \"external\", \"primaryCtaUrl\": \"https://x/obillupgrade/1\"}'",
        "'{\"primaryCtaAction\": \"external\", \"primaryCtaUrl\": \"https://x/changeplan/1\"}'",
        "'{\"primaryCtaAction\": \"callbackOnly\", \"primaryCtaText\": \"Keep\"}'",
        "'{\"ctaAction\": \"other\"}'",
    )
    + " END",
}
OFFERS_WHERE = "p_size % 8 <> 0 AND (copy = 0 OR p_partkey % 20 = 3)"

OFFER_HISTORY = {
    "company_id": "u",
    "offer_id": "'OB-' || CAST(k % 40 AS STRING)",
    "purchase_datetime": (
        "t + " + pick("k % 3", *[f"INTERVAL '{h}' HOUR" for h in (1, 20, 40)])
    ),
}
OFFER_HISTORY_WHERE = "et = 'click' AND k % 2 = 1 AND (k % 40) % 6 = 1"

REACTIVE_SAVES = {
    "report_company_id": "u",
    "report_dt": "CAST(t AS DATE)",
    "program": pick("k % 4", *q("SaaS Core", "SaaS Plus", "SaaS Advanced", "Field Sales")),
    "cc_id": f"CASE WHEN k % 5 <> 0 THEN 'cc' || {EVENT_NUMBER} END",
    "saved_cases": "CASE WHEN k % 14 = 0 THEN 1 ELSE 0 END",
}
REACTIVE_SAVES_WHERE = "et = 'error' AND k % 7 = 0"

COMPANIES = {
    "company_id": "c_custkey",
    "realm_id": "CAST(c_custkey AS STRING)",
    "country": "CASE WHEN n_nationkey % 2 = 0 THEN 'United States' ELSE n_name END",
    "is_suspicious": "CASE WHEN c_custkey % 20 = 0 THEN 1 ELSE 0 END",
    "signup_date": "DATE '2023-01-01' + CAST(c_custkey * 13 % 360 + copy * 5 AS INTEGER)",
}
COMPANIES_WHERE = "copy = 0 OR c_custkey % 50 = 7"

STATUS = {
    "company_id": "c_custkey",
    "date_of": "d",
    "open_subscriber": (
        "CASE WHEN (c_custkey * 7 + CAST(day_number AS BIGINT)) % 10 < 3 THEN 0 ELSE 1 END"
    ),
}
STATUS_DAYS = ("2024-02-01", "2024-07-15")

ASSIGNMENTS = {
    "company_id": "c_custkey",
    "experiment_id": "x",
    "treatment_name": "CASE WHEN (c_custkey + x + copy * (CASE WHEN c_custkey % 5 = 0 THEN 1 "
    "WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END)) % 2 = 0 THEN 'control' ELSE 'variant' END",
    "first_timestamp": "CAST(DATE '2024-01-01' + CAST((c_custkey * 3 + x + copy) % 45 AS INTEGER) "
    "AS TIMESTAMP) + INTERVAL '9' HOUR",
    "version": "CASE WHEN copy = 1 AND c_custkey % 7 = 0 AND c_custkey % 5 <> 0 THEN 0 ELSE 1 END",
}
ASSIGNMENTS_WHERE = "copy = 0 OR c_custkey % 3 = 0 OR c_custkey % 5 = 0 OR c_custkey % 7 = 0"


def looked_up(expr: str) -> str:
    """The same expression with each ``pick`` of plain texts as a lookup in a constant array.

    A CASE repeats its selector in every arm. With a dozen of them the generated method grows beyond what the JVM
    compiles, and every row is interpreted.
    """
    return reduce(lambda text, case: text.replace(case, _LOOKUPS[case]), _LOOKUPS, expr)


def project(columns: dict[str, str]) -> list[str]:
    return [f"{expr} AS {name}" for name, expr in columns.items()]


def spark_columns(columns: dict[str, str]) -> list[str]:
    """``project`` for Spark, with lookups."""
    return project({name: looked_up(expr) for name, expr in columns.items()})


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def base_events(spark: SparkSession, folder: str) -> DataFrame:
    k = "CAST(get_json_object(props, '$.k') AS INT)"
    return table(spark, folder, "events").selectExpr(
        "event_id AS e", "user_id AS u", "event_type AS et", f"{k} AS k",
        f"{EVENT_TIME.format(k=k)} AS t",
    )


def raw_events(spark: SparkSession, folder: str, delivery: bool = False) -> DataFrame:
    """Clickstream deliveries: some events arrive twice, some with a broken time or company.

    ``delivery`` adds 1 for a first and 2 for a repeated delivery.
    """
    # What an event's type decides is made before the event is repeated, the rest after: two generated methods, each of
    # a size that the JVM compiles.
    typed = {name: expr for name, expr in RAW_EVENTS.items() if "et = " in expr}
    rest = dict(zip(RAW_EVENTS, spark_columns({name: name if name in typed else expr for name, expr in RAW_EVENTS.items()})))
    described = base_events(spark, folder).selectExpr("e", "u", "k", "t", *spark_columns(typed))
    delivered = described.selectExpr(
        "*", "explode(CASE WHEN k % 11 = 0 THEN array(0, 2) ELSE array(0) END) AS late"
    )
    return delivered.selectExpr(
        *rest.values(),
        "CASE WHEN e % 211 = 5 THEN 'bad' ELSE date_format(t + make_dt_interval(0, 0, 0, late), "
        "'yyyy-MM-dd\\'T\\'HH:mm:ss.SSSSSS') END AS event_timestamp",
        "date_format(t, 'yyyy-MM-dd') AS event_date",
        *(["IF(late = 0, 1, 2) AS delivery"] if delivery else []),
    )


def feed(spark: SparkSession, folder: str) -> DataFrame:
    """The deliveries as one JSON document each, some of them broken or without a company."""
    raw = raw_events(spark, folder, delivery=True).withColumns(
        {
            "company_id": F.when(F.col("event_id").endswith("59"), None).otherwise(
                C.resolve_company_id()
            ),
            "product": C.resolve_product(),
        }
    )
    body = F.to_json(F.struct(*[c for c in raw.columns if c != "delivery"]))
    broken = F.col("event_id").endswith("77")
    return raw.select(
        F.when(broken, F.lit('{"event_id": ')).otherwise(body).alias("raw_json"), "delivery",
        F.col("event_timestamp").try_cast("timestamp").alias("at"),
    )


def offers(spark: SparkSession, folder: str) -> DataFrame:
    twice = table(spark, folder, "part").selectExpr("*", "explode(array(0, 1)) AS copy")
    return twice.filter(OFFERS_WHERE).selectExpr(*spark_columns(OFFERS))


def offer_history(spark: SparkSession, folder: str) -> DataFrame:
    rows = base_events(spark, folder).filter(OFFER_HISTORY_WHERE)
    typed = {**OFFER_HISTORY, "purchase_datetime": f"CAST({OFFER_HISTORY['purchase_datetime']} AS TIMESTAMP)"}
    return rows.selectExpr(*spark_columns(typed))


def reactive_saves(spark: SparkSession, folder: str) -> DataFrame:
    rows = base_events(spark, folder).filter(REACTIVE_SAVES_WHERE)
    return rows.selectExpr(*spark_columns(REACTIVE_SAVES))


def companies(spark: SparkSession, folder: str) -> DataFrame:
    joined = table(spark, folder, "customer").join(
        table(spark, folder, "nation").withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey"
    )
    twice = joined.selectExpr("*", "c_nationkey AS n_nationkey", "explode(array(0, 1)) AS copy")
    return twice.filter(COMPANIES_WHERE).selectExpr(*project(COMPANIES))


def subscriber_status(spark: SparkSession, folder: str) -> DataFrame:
    first, last = STATUS_DAYS
    days = table(spark, folder, "customer").selectExpr(
        "c_custkey",
        f"explode(sequence(DATE '{first}', DATE '{last}')) AS d",
        "CASE WHEN c_custkey % 40 = 0 THEN 2 ELSE 1 END AS n",
    )
    copies = days.selectExpr("*", "explode(sequence(1, n)) AS copy", "dayofyear(d) AS day_number")
    return copies.selectExpr(*project(STATUS))


def assignments(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "customer").selectExpr(
        "c_custkey", "explode(array(101, 102)) AS x"
    ).selectExpr("*", "explode(array(0, 1)) AS copy")
    return rows.filter(ASSIGNMENTS_WHERE).selectExpr(*project(ASSIGNMENTS))
