"""SQL views of the same inputs and tables, written as plain joins over whole windows.

They state the semantics a second time, independently of the DataFrame operators: range joins
instead of ordered sweeps, unions instead of one scan, windows instead of aggregates.
"""

from __future__ import annotations

import re

from ..functions import taxonomy as X
from . import inputs as I


def texts(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def events(*names: str) -> str:
    return texts(X.spellings(*names))


def js(document: str, field: str) -> str:
    return f"CASE WHEN json_valid({document}) THEN json_extract_string({document}, '$.{field}') END"


def proj(columns: dict[str, str]) -> str:
    return ", ".join(I.project(columns))


_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
_ATTRS = (
    "product", "sku", "billing_frequency", "subscription_type", "properties_url_host_name",
    "ua_parser_device_type", "context_page_path",
)
_YM = "strftime({0}, '%Y') AS initiation_year, strftime({0}, '%m') AS initiation_month"
_RESOLVED = (
    f"coalesce(CASE WHEN trim({js('workflow_state', 'client_realm_id')}) <> '' "
    f"THEN {js('workflow_state', 'client_realm_id')} END, "
    f"CASE WHEN trim({js('widget_state', 'client_realm_id')}) <> '' "
    f"THEN {js('widget_state', 'client_realm_id')} END, company_id)"
)
_RESOLVED_PRODUCT = (
    f"coalesce(product, {js('workflow_state', 'product')}, {js('widget_state', 'product')})"
)

IS_INITIATION = (
    f"event IN {events('workflow: started')} "
    "AND properties_object_detail IN ('cancel', 'cancellation_workflow') "
    "AND properties_ui_object_detail IN ('cancel_subscription', 'cancel')"
)
IS_GEN3 = (
    f"event IN {events('workflow: completed')} AND properties_object_detail = 'cancel' "
    "AND properties_ui_object_detail = 'cancel_success'"
)
IS_GEN2 = (
    f"event IN {events('workflow: engaged', 'widget: engaged')} "
    "AND properties_object_detail IN ('cancellation_workflow', 'cancel') "
    "AND properties_ui_object_detail = 'yes_cancel'"
)
IS_GEN1 = (
    f"event IN {events('cancelation flow: viewed')} "
    "AND properties_ui_access_point = 'cancel success' AND (properties_screen = 'cancel complete' "
    "OR properties_object_detail IN ('canceled', 'cancel trowser'))"
)


def is_change(kind: str) -> str:
    return (
        f"event IN {events('workflow: completed')} AND properties_object_detail = '{kind}' "
        "AND properties_ui_object_detail = 'get_started'"
    )


IN_FLOW = f"properties_ui_access_point IN {texts(X.CANCEL_FLOW_ACCESS_POINTS)}"
IS_VIEW = f"event IN {events('offer: viewed')} AND {IN_FLOW}"
IS_CLICK = f"event IN {events('offer: clicked')} AND {IN_FLOW}"
IS_WIDGET = (
    f"event IN {events('content: viewed')} AND properties_object_detail = 'usage-highlights-widget'"
)
SCREEN = """CASE
  WHEN contains(lower(coalesce(properties_url_host_name, '')), 'accounts.')
    OR contains(lower(coalesce(context_page_path, '')), 'accountmanager') THEN 'Account Portal'
  WHEN lower(coalesce(ua_parser_device_type, '')) IN ('mobile', 'tablet', 'smartphone', 'phone')
    OR contains(lower(coalesce(properties_url_host_name, '')), 'mobile') THEN 'SaaS Mobile App'
  WHEN contains(lower(coalesce(properties_url_host_name, '')), 'app.')
    OR contains(lower(coalesce(properties_url_host_name, '')), 'saas.') THEN 'SaaS Web App'
  ELSE 'Unknown' END"""
OFFER_CLASS = f"""CASE
  WHEN coalesce({js('copy_data', 'ctaAction')}, {js('copy_data', 'primaryCtaAction')})
    = 'contact-us-widget' THEN 'CS IPD'
  WHEN {js('copy_data', 'obillOfferId')} IS NOT NULL THEN 'Discount IPD'
  WHEN {js('copy_data', 'primaryCtaAction')} = 'external'
    AND {js('copy_data', 'primaryCtaUrl')} LIKE '%/obillupgrade%' THEN 'Upgrade IPD'
  WHEN {js('copy_data', 'primaryCtaAction')} = 'external'
    AND {js('copy_data', 'primaryCtaUrl')} LIKE '%/changeplan%' THEN 'Downgrade IPD'
  WHEN {js('copy_data', 'primaryCtaAction')} = 'callbackOnly' THEN 'Keep my Plan IPD'
  ELSE 'Unknown' END"""


def first_in(name: str, condition: str, upper: str) -> str:
    """First matching event from the start of each episode up to a bound."""
    return f"""SELECT w.company_id, w.st, min(b.event_timestamp) AS {name}
      FROM windows w JOIN bronze b ON b.company_id = w.company_id AND b.event_timestamp >= w.st
        AND b.event_timestamp {upper}
      WHERE {condition} GROUP BY 1, 2"""


_ENGAGEMENT_COLUMNS = """p.company_id, p.initiation_rank, p.initiation_timestamp,
  p.window_end_timestamp, p.properties_ui_access_point, p.offer_id, o.offer_name, o."primaryCtaText",
  o.obill_offer_id, coalesce(o.ipd_type, 'Unknown') AS ipd_type, p.ipd_view_timestamp, p.viewed_ipd,
  p.clicked_ipd, coalesce(d.viewed_dic_component, 0) AS viewed_dic_component,
  coalesce(d.number_of_data_points, 0) AS number_of_data_points_shown, d.dic_component_detail,
  d.dic_impression_timestamp, p.product, p.initiation_year, p.initiation_month"""
_EPISODE = """company_id, initiation_rank, initiation_timestamp, window_end_timestamp, product,
  initiation_year, initiation_month"""


def engagement(how: str) -> str:
    return f"""SELECT {_ENGAGEMENT_COLUMNS} FROM per_offer p
      {how} JOIN offer_info o USING (offer_id)
      LEFT JOIN dic d ON d.company_id = p.company_id
        AND d.initiation_timestamp = p.initiation_timestamp"""


def _flags() -> str:
    kinds = {
        "cs": "CS IPD", "discount": "Discount IPD", "upgrade": "Upgrade IPD",
        "downgrade": "Downgrade IPD", "keep_plan": "Keep my Plan IPD",
    }
    return ", ".join(
        f"max(CASE WHEN ipd_type = '{v}' THEN {a}_ipd ELSE 0 END) AS {a}_{k}_ipd"
        for k, v in kinds.items()
        for a in ("viewed", "clicked")
    )


FLAG_NAMES = [
    f"{a}_{k}_ipd"
    for k in ("cs", "discount", "upgrade", "downgrade", "keep_plan")
    for a in ("viewed", "clicked")
]
YN = "CASE WHEN {} = 1 THEN 'Y' ELSE 'N' END"
AS_OF = f"DATE '{I.AS_OF}'"


def _running(condition: str) -> str:
    return f"CAST(sum(CASE WHEN {condition} THEN 1 ELSE 0 END) OVER upto AS BIGINT)"


def _ctr(clicks: str, views: str) -> str:
    return f"CASE WHEN {views} > 0 THEN CAST({clicks} AS DOUBLE) / {views} ELSE 0.0 END"


_SHOWN = " + ".join(n for n in FLAG_NAMES if n.startswith("viewed"))
_CLICKED = " + ".join(n for n in FLAG_NAMES if n.startswith("clicked"))

CTES = {
    "base_events": f"""SELECT event_id AS e, user_id AS u, event_type AS et, {_K} AS k,
      {I.EVENT_TIME.format(k=_K)} AS t FROM events""",
    "deliveries": """SELECT *, unnest(CASE WHEN k % 11 = 0 THEN [0, 2] ELSE [0] END) AS late
      FROM base_events""",
    "raw_events": f"""SELECT {proj(I.RAW_EVENTS)},
      CASE WHEN e % 211 = 5 THEN 'bad'
        ELSE strftime(t + to_seconds(late), '%Y-%m-%dT%H:%M:%S.%f') END AS event_timestamp,
      strftime(t, '%Y-%m-%d') AS event_date, CASE WHEN late = 0 THEN 1 ELSE 2 END AS delivery
      FROM deliveries""",
    "typed_events": f"""SELECT event_id, session_id, {_RESOLVED} AS company_id, accountant_realm_id,
      workflow_state, widget_state, {_RESOLVED_PRODUCT} AS product, sku, billing_frequency,
      subscription_type, properties_url_host_name, ua_parser_device_type, context_page_path,
      trim(regexp_replace(event, '\\s+', ' ', 'g')) AS event, properties_object_detail,
      properties_ui_object_detail, properties_ui_access_point, properties_screen,
      properties_custom_fp_offer_id, TRY_CAST(event_timestamp AS TIMESTAMP) AS event_timestamp
      FROM raw_events WHERE event_date BETWEEN '{I.FIRST_DAY}' AND '{I.LAST_DAY}'""",
    "bronze": f"""SELECT * FROM (
      SELECT *, strftime(event_timestamp, '%Y-%m-%d') AS event_date FROM typed_events)
      WHERE event_date BETWEEN '{I.FIRST_DAY}' AND '{I.LAST_DAY}'
      QUALIFY row_number() OVER (PARTITION BY event_id, event_date ORDER BY event_timestamp) = 1""",
    "feed": f"""SELECT event_id, event,
      CASE WHEN event_id LIKE '%59' THEN NULL ELSE {_RESOLVED} END AS company_id,
      TRY_CAST(event_timestamp AS TIMESTAMP) AS tm, event_id LIKE '%77' AS broken, delivery,
      properties_object_detail, properties_ui_object_detail, properties_ui_access_point,
      properties_screen FROM raw_events""",
    "valid_feed": """SELECT * FROM feed
      WHERE NOT broken AND company_id IS NOT NULL AND tm IS NOT NULL""",
    "offers": f"""SELECT {proj(I.OFFERS)} FROM (SELECT *, unnest([0, 1]) AS copy FROM part)
      WHERE {I.OFFERS_WHERE}""",
    "offer_history": f"""SELECT {proj(I.OFFER_HISTORY)} FROM base_events
      WHERE {I.OFFER_HISTORY_WHERE}""",
    "reactive_saves": f"""SELECT {proj(I.REACTIVE_SAVES)} FROM base_events
      WHERE {I.REACTIVE_SAVES_WHERE}""",
    "companies": f"""SELECT {proj(I.COMPANIES)} FROM (
      SELECT c.*, n.n_nationkey, n.n_name, unnest([0, 1]) AS copy
      FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey) WHERE {I.COMPANIES_WHERE}""",
    "subscriber_status": f"""SELECT {proj(I.STATUS)} FROM (
      SELECT c_custkey, d, dayofyear(d) AS day_number,
        unnest(CASE WHEN c_custkey % 40 = 0 THEN [1, 2] ELSE [1] END) AS copy
      FROM (SELECT c_custkey, CAST(unnest(generate_series(DATE '{I.STATUS_DAYS[0]}',
        DATE '{I.STATUS_DAYS[1]}', INTERVAL 1 DAY)) AS DATE) AS d FROM customer))""",
    "assignments": f"""SELECT {proj(I.ASSIGNMENTS)} FROM (
      SELECT c_custkey, x, unnest([0, 1]) AS copy
      FROM (SELECT c_custkey, unnest([101, 102]) AS x FROM customer)) WHERE {I.ASSIGNMENTS_WHERE}""",
    "company_dim": """SELECT company_id, min(signup_date) AS signup_date,
      arg_min(country, signup_date) AS country, arg_min(is_suspicious, signup_date) AS is_suspicious
      FROM companies GROUP BY company_id""",
    "starts": f"""SELECT company_id, event_timestamp AS st,
      {", ".join(f"max({c}) AS {c}" for c in _ATTRS)},
      max(CASE WHEN trim(accountant_realm_id) <> '' THEN accountant_realm_id END) AS accountant
      FROM bronze WHERE {IS_INITIATION} GROUP BY 1, 2""",
    "windows": """SELECT *, CAST(row_number() OVER w AS INTEGER) AS rk,
      coalesce(lead(st) OVER w, st + INTERVAL 1 HOUR) AS we
      FROM starts WINDOW w AS (PARTITION BY company_id, sku ORDER BY st)""",
    "confirmed": f"""SELECT w.company_id, w.st, min(c.ts) AS ts FROM windows w JOIN (
        SELECT company_id, event_timestamp AS ts FROM bronze WHERE {IS_GEN3}
        UNION ALL SELECT company_id, event_timestamp FROM bronze WHERE {IS_GEN2}
        UNION ALL SELECT company_id, event_timestamp FROM bronze WHERE {IS_GEN1}) c
      ON c.company_id = w.company_id AND c.ts >= w.st AND c.ts < w.we GROUP BY 1, 2""",
    "upgrades": first_in("ts", is_change("upgrade"), "<= w.st + INTERVAL 1 DAY"),
    "downgrades": first_in("ts", is_change("downgrade"), "<= w.st + INTERVAL 1 DAY"),
    "initiations": f"""SELECT co.company_id, co.signup_date,
      CAST(CAST(w.st AS DATE) - co.signup_date AS INTEGER) AS tenure_at_cancel_initiation,
      w.sku, w.billing_frequency, w.subscription_type, w.properties_url_host_name,
      w.ua_parser_device_type, w.context_page_path,
      w.accountant AS accountant_id_starting_cancellation,
      CASE WHEN w.accountant IS NULL THEN 'N' ELSE 'Y' END AS is_accountant_starting_cancellation,
      CAST(w.st AS DATE) AS initiation_date, w.st AS initiation_timestamp, w.rk AS initiation_rank,
      w.we AS window_end_timestamp,
      CASE WHEN c.ts IS NULL THEN 0 ELSE 1 END AS cancel_confirmed, c.ts AS confirmation_timestamp,
      CASE WHEN u.ts IS NULL THEN 0 ELSE 1 END AS upgraded, u.ts AS upgrade_timestamp,
      CASE WHEN d.ts IS NULL THEN 0 ELSE 1 END AS downgraded, d.ts AS downgrade_timestamp,
      w.product, {_YM.format("w.st")}
      FROM windows w JOIN company_dim co ON w.company_id = CAST(co.company_id AS VARCHAR)
      LEFT JOIN confirmed c ON c.company_id = w.company_id AND c.st = w.st
      LEFT JOIN upgrades u ON u.company_id = w.company_id AND u.st = w.st
      LEFT JOIN downgrades d ON d.company_id = w.company_id AND d.st = w.st
      WHERE (co.country = 'United States' OR w.accountant IS NOT NULL) AND co.is_suspicious = 0""",
    "observed": """SELECT company_id, initiation_rank, initiation_timestamp,
      coalesce(confirmation_timestamp, window_end_timestamp) AS window_end_timestamp, product,
      initiation_year, initiation_month FROM initiations""",
    "inside": """SELECT o.*, b.event_id, b.event, b.event_timestamp, b.properties_object_detail,
      b.properties_ui_object_detail, b.properties_ui_access_point, b.context_page_path,
      b.properties_custom_fp_offer_id
      FROM observed o JOIN bronze b ON TRY_CAST(b.company_id AS BIGINT) = o.company_id
        AND b.event_timestamp >= o.initiation_timestamp
        AND b.event_timestamp < o.window_end_timestamp""",
    "per_offer": f"""SELECT {_EPISODE}, properties_ui_access_point,
      properties_custom_fp_offer_id AS offer_id,
      min(CASE WHEN {IS_VIEW} THEN event_timestamp END) AS ipd_view_timestamp,
      max(CASE WHEN {IS_VIEW} THEN 1 ELSE 0 END) AS viewed_ipd,
      max(CASE WHEN {IS_CLICK} THEN 1 ELSE 0 END) AS clicked_ipd
      FROM inside WHERE ({IS_VIEW}) OR ({IS_CLICK}) GROUP BY ALL""",
    "dic": f"""SELECT {_EPISODE}, 1 AS viewed_dic_component,
      max(TRY_CAST({js('properties_ui_object_detail', 'data_object_display_count')} AS INTEGER))
        AS number_of_data_points,
      arg_max(properties_ui_object_detail, event_timestamp) AS dic_component_detail,
      min(event_timestamp) AS dic_impression_timestamp
      FROM inside WHERE {IS_WIDGET} GROUP BY ALL""",
    "offer_info": f"""SELECT offer_id, offer_name,
      coalesce({js('copy_data', 'ctaText')}, {js('copy_data', 'primaryCtaText')})
        AS "primaryCtaText",
      {js('copy_data', 'obillOfferId')} AS obill_offer_id, {OFFER_CLASS} AS ipd_type
      FROM offers QUALIFY row_number() OVER (PARTITION BY offer_id ORDER BY offer_name) = 1""",
    "engagement": engagement("INNER"),
    "engagement_left": engagement("LEFT"),
    "cs_save": """SELECT i.company_id, i.initiation_timestamp,
      max(CASE WHEN s.cc_id IS NOT NULL THEN 1 ELSE 0 END) AS contacted_by_cs,
      max(CASE WHEN s.saved_cases = 1 THEN 1 ELSE 0 END) AS saved_by_cs
      FROM initiations i LEFT JOIN reactive_saves s ON s.report_company_id = i.company_id
        AND s.report_dt BETWEEN i.initiation_date AND i.initiation_date + 7
        AND s.program IN ('SaaS Core', 'SaaS Plus', 'SaaS Advanced') GROUP BY 1, 2""",
    "shown": """SELECT DISTINCT company_id, initiation_rank, initiation_timestamp,
      trim(regexp_replace(obill_offer_id, '["'']', '', 'g')) AS obill_offer_id
      FROM engagement WHERE ipd_type = 'Discount IPD' AND obill_offer_id IS NOT NULL""",
    "taken": """SELECT s.company_id, s.initiation_rank, s.initiation_timestamp, 1 AS took_discount,
      min(CAST(h.purchase_datetime AS TIMESTAMP)) AS discount_take_timestamp
      FROM shown s JOIN offer_history h ON h.company_id = s.company_id
        AND h.offer_id = s.obill_offer_id
        AND CAST(h.purchase_datetime AS DATE) BETWEEN CAST(s.initiation_timestamp AS DATE)
          AND CAST(s.initiation_timestamp AS DATE) + 1
      GROUP BY 1, 2, 3""",
    "attribution": """SELECT i.company_id, i.initiation_rank, i.initiation_timestamp,
      i.initiation_date, i.cancel_confirmed, i.confirmation_timestamp, c.contacted_by_cs,
      c.saved_by_cs, i.upgraded, i.upgrade_timestamp, i.downgraded, i.downgrade_timestamp,
      coalesce(t.took_discount, 0) AS took_discount, t.discount_take_timestamp,
      CASE WHEN c.saved_by_cs = 1 THEN 'CS Save' WHEN i.cancel_confirmed = 1 THEN 'Cancelled'
        WHEN i.upgraded = 1 THEN 'Upgrade Save' WHEN i.downgraded = 1 THEN 'Downgrade Save'
        WHEN t.took_discount = 1 THEN 'Discount Save' ELSE 'Abandoned' END AS save_attribution,
      CASE WHEN c.saved_by_cs = 0 AND i.cancel_confirmed = 0 AND i.upgraded = 0
        AND i.downgraded = 0 AND coalesce(t.took_discount, 0) = 0 THEN 'Y' ELSE 'N' END
        AS saved_by_abandoning,
      i.accountant_id_starting_cancellation, i.is_accountant_starting_cancellation, i.product,
      i.initiation_year, i.initiation_month
      FROM initiations i JOIN cs_save c USING (company_id, initiation_timestamp)
      LEFT JOIN taken t USING (company_id, initiation_timestamp)""",
    "engagement_flags": f"""SELECT company_id, initiation_rank, initiation_timestamp, {_flags()},
      max(viewed_dic_component) AS viewed_dic,
      max(number_of_data_points_shown) AS dic_max_data_points FROM engagement GROUP BY 1, 2, 3""",
    "active": """SELECT DISTINCT company_id, date_of FROM subscriber_status
      WHERE open_subscriber = 1""",
    "retention": f"""SELECT i.company_id, i.initiation_rank, i.initiation_timestamp,
      i.initiation_date,
      CASE WHEN i.initiation_date + 31 < {AS_OF} THEN 1 ELSE 0 END AS baked_31d,
      CASE WHEN a.company_id IS NULL THEN 0 ELSE 1 END AS retained_31d,
      CASE WHEN i.initiation_date + 92 < {AS_OF} THEN 1 ELSE 0 END AS baked_92d,
      CASE WHEN b.company_id IS NULL THEN 0 ELSE 1 END AS retained_92d
      FROM initiations i
      LEFT JOIN active a ON a.company_id = i.company_id AND a.date_of = i.initiation_date + 31
      LEFT JOIN active b ON b.company_id = i.company_id AND b.date_of = i.initiation_date + 92""",
    "gold": f"""SELECT i.company_id, CAST(i.company_id AS VARCHAR) AS realm_id, i.signup_date,
      i.tenure_at_cancel_initiation, i.sku, i.billing_frequency, i.subscription_type,
      i.initiation_date, i.initiation_timestamp AS cancel_flow_start_timestamp, i.initiation_rank,
      {YN.format("i.cancel_confirmed")} AS cancel_confirmed,
      i.confirmation_timestamp AS cancel_confirmation_timestamp,
      {YN.format("a.saved_by_cs")} AS saved_by_customer_support,
      {YN.format("i.upgraded")} AS saved_by_upgrading,
      {YN.format("i.downgraded")} AS saved_by_downgrading,
      {YN.format("a.took_discount")} AS saved_by_taking_discount, a.discount_take_timestamp,
      a.saved_by_abandoning AS saved_by_abandoning_cancel_flow,
      i.is_accountant_starting_cancellation, i.accountant_id_starting_cancellation,
      {SCREEN} AS cancel_flow_screen, i.properties_url_host_name, i.ua_parser_device_type,
      i.context_page_path, a.save_attribution, a.contacted_by_cs, a.saved_by_cs, i.upgraded,
      i.upgrade_timestamp, i.downgraded, i.downgrade_timestamp, a.took_discount,
      {", ".join(f"coalesce(f.{c}, 0) AS {c}" for c in FLAG_NAMES)},
      coalesce(f.viewed_dic, 0) AS viewed_dic,
      coalesce(f.dic_max_data_points, 0) AS dic_max_data_points,
      r.baked_31d, r.retained_31d, r.baked_92d, r.retained_92d,
      CAST(NULL AS VARCHAR) AS treatment_name, CAST(NULL AS DATE) AS first_assignment_date,
      i.product, i.initiation_year, i.initiation_month
      FROM initiations i JOIN attribution a USING (company_id, initiation_timestamp)
      LEFT JOIN engagement_flags f USING (company_id, initiation_timestamp)
      JOIN retention r USING (company_id, initiation_timestamp)""",
    "clean_assignments": f"""SELECT company_id, experiment_id, min(treatment_name) AS treatment_name,
      CAST(first_timestamp AS DATE) AS first_assignment_date
      FROM assignments a WHERE version >= 1
        AND CAST(first_timestamp AS DATE) BETWEEN '{I.FIRST_DAY}' AND '{I.LAST_DAY}'
        AND (company_id, experiment_id) IN (
          SELECT (company_id, experiment_id) FROM assignments WHERE version >= 1
            AND CAST(first_timestamp AS DATE) BETWEEN '{I.FIRST_DAY}' AND '{I.LAST_DAY}'
          GROUP BY company_id, experiment_id HAVING count(DISTINCT treatment_name) = 1)
      GROUP BY company_id, experiment_id, CAST(first_timestamp AS DATE)""",
    "all_features": f"""SELECT *, 
      CAST(count(*) OVER (PARTITION BY company_id
        ORDER BY epoch_us(cancel_flow_start_timestamp) // 1000000
        RANGE BETWEEN 7776000 PRECEDING AND CURRENT ROW) AS BIGINT) AS cancel_frequency_90d,
      CAST(initiation_date - lag(initiation_date) OVER w AS INTEGER) AS days_since_last_cancel,
      CAST(hour(cancel_flow_start_timestamp) AS INTEGER) AS initiation_hour_utc,
      CAST(dayofweek(cancel_flow_start_timestamp) + 1 AS INTEGER) AS initiation_day_of_week,
      CASE WHEN dayofweek(cancel_flow_start_timestamp) IN (0, 6) THEN 1 ELSE 0 END
        AS is_weekend_initiation,
      CASE WHEN cancel_flow_screen = 'Account Portal' THEN 1 ELSE 0 END
        AS cancel_flow_screen_oiam_flag,
      CASE WHEN cancel_flow_screen = 'SaaS Mobile App' THEN 1 ELSE 0 END
        AS cancel_flow_screen_mobile_flag,
      tenure_at_cancel_initiation AS tenure_days,
      CASE WHEN billing_frequency = 'annual' THEN 1 ELSE 0 END AS billing_frequency_annual_flag,
      CASE WHEN sku LIKE 'CORE%' THEN 1 WHEN sku LIKE 'PLUS%' THEN 2 WHEN sku LIKE 'ADV%' THEN 3
        WHEN sku LIKE 'PAYROLL%' THEN 4 WHEN sku LIKE 'LIVE%' THEN 5 ELSE 0 END
        AS sku_tier_encoded,
      CASE WHEN subscription_type = 'direct' THEN 1 ELSE 0 END AS subscription_type_direct_flag,
      CASE WHEN is_accountant_starting_cancellation = 'Y' THEN 1 ELSE 0 END
        AS is_accountant_initiated,
      CASE WHEN tenure_at_cancel_initiation < 90 THEN 1
        WHEN tenure_at_cancel_initiation < 365 THEN 2 ELSE 3 END AS tenure_bucket_encoded,
      {_SHOWN} AS total_ipds_shown, {_CLICKED} AS total_ipd_clicks,
      {_ctr(f"({_CLICKED})", f"({_SHOWN})")} AS overall_click_through_rate,
      {_ctr("clicked_cs_ipd", "viewed_cs_ipd")} AS cs_click_through_rate,
      {_ctr("clicked_discount_ipd", "viewed_discount_ipd")} AS discount_click_through_rate,
      sin(month(initiation_date) * 2 * pi() / 12) AS cohort_month_sin,
      cos(month(initiation_date) * 2 * pi() / 12) AS cohort_month_cos,
      CASE WHEN month(initiation_date) IN (10, 11, 12) THEN 1 ELSE 0 END AS is_q4_initiation,
      CAST(initiation_date - signup_date AS INTEGER) AS days_since_signup,
      {_running("saved_by_cs = 1")} AS lifetime_cs_saves,
      {_running("took_discount = 1")} AS lifetime_discount_saves,
      {_running("upgraded = 1")} AS lifetime_upgrade_saves,
      {_running("saved_by_abandoning_cancel_flow = 'Y'")} AS lifetime_abandoned_count,
      CASE WHEN initiation_rank > 1 THEN CAST(initiation_rank
        - {_running("cancel_confirmed = 'Y'")} AS DOUBLE) / (initiation_rank - 1) END
        AS save_rate_lifetime,
      avg(CASE WHEN cancel_confirmed = 'Y' THEN 0.0 ELSE 1.0 END) OVER (PARTITION BY company_id
        ORDER BY cancel_flow_start_timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        AS save_rate_prior,
      CASE WHEN baked_31d = 1 THEN 1 - retained_31d END AS churned_31d,
      CASE WHEN baked_92d = 1 THEN 1 - retained_92d END AS churned_92d
      FROM gold WINDOW w AS (PARTITION BY company_id ORDER BY cancel_flow_start_timestamp),
        upto AS (PARTITION BY company_id ORDER BY cancel_flow_start_timestamp
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
}


def with_ctes(sql: str) -> str:
    """Prefix ``sql`` with the views it needs, in order of dependence."""
    wanted: set[str] = set()

    def visit(text: str) -> None:
        for name, body in CTES.items():
            if name not in wanted and re.search(rf"(?<![.\w']){name}(?![\w(])", text):
                wanted.add(name)
                visit(body)

    visit(sql)
    kept = {"bronze", "windows", "initiations", "inside", "engagement", "attribution", "retention", "gold"}
    views = ",\n".join(
        f"{n} AS {'MATERIALIZED ' if n in kept else ''}({body})" for n, body in CTES.items() if n in wanted
    )
    return f"WITH {views}\n{sql}" if views else sql
