"""SQL counterpart of each query, where SQL can say it."""

from __future__ import annotations

from ..functions import taxonomy as X
from ..plans import features as FT
from ..plans.reports import CHI_SQUARE_1_IN_1000, POISSON_1, Z_95
from ..schemas import (
    BILLING_FREQUENCIES,
    ENGAGEMENT_CONTRACT,
    FINAL_METRICS_CONTRACT,
    OFFER_TYPES,
    OUTCOMES,
    PRODUCTS,
    YES_NO,
)
from . import inputs as I
from .ctes import (
    AS_OF,
    FLAG_NAMES,
    IS_CLICK,
    IS_GEN1,
    IS_GEN2,
    IS_GEN3,
    IS_INITIATION,
    IS_VIEW,
    IS_WIDGET,
    SCREEN,
    events,
    first_in,
    is_change,
    js,
    texts,
    with_ctes,
    _RESOLVED,
    _RESOLVED_PRODUCT,
)

GOLD_KEY = "company_id, initiation_rank, cancel_flow_start_timestamp"
EPISODE = "company_id, initiation_rank, initiation_timestamp"
ORDERS = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  strftime(o_orderdate, '%Y') AS order_year FROM orders"""
EXTENDED_SCREEN = SCREEN.replace(
    "'accountmanager') THEN",
    "'accountmanager') OR contains(lower(coalesce(context_page_path, '')), 'accounts.') THEN",
).replace(
    "'saas.') THEN",
    "'saas.') OR contains(lower(coalesce(properties_url_host_name, '')), 'dashboard') THEN",
)


def rnd(columns, digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)


def cut_rates(columns) -> str:
    """Feature columns, rates and waves rounded."""
    return ", ".join(
        f"round({c}, 6) AS {c}" if "_rate" in c or "cohort_month" in c else c for c in columns
    )


# ---- quality ----------------------------------------------------------------------------------


def _daily_counts(condition: str) -> str:
    """Events per type and calendar day, absent days too, with the mean of the seven days before."""
    kept = f"(SELECT event, event_date FROM bronze WHERE {condition})"
    days = f"""generate_series(CAST(min(event_date) AS DATE), (SELECT max(CAST(event_date AS DATE)) FROM {kept}),
        INTERVAL 1 DAY)"""
    return f"""SELECT *, avg(n) OVER (PARTITION BY event ORDER BY event_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS m
      FROM (SELECT s.event, s.event_date, coalesce(d.n, 0) AS n
        FROM (SELECT event, strftime(unnest({days}), '%Y-%m-%d') AS event_date FROM {kept} GROUP BY event) s
        LEFT JOIN (SELECT event, event_date, count(*) AS n FROM {kept} GROUP BY 1, 2) d
          ON d.event = s.event AND d.event_date = s.event_date)"""


def _check(table, view, name, column, severity, failed):
    return f"""SELECT '{table}' AS table_name, '{name}' AS "check", '{column}' AS "column",
      '{severity}' AS severity, count(*) AS total, CAST({failed} AS BIGINT) AS failed FROM {view}"""


def _count(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


def _unique(table, view, columns, severity, label=None):
    key = ", ".join(columns)
    failed = f"""(SELECT coalesce(sum(n), 0) FROM (
      SELECT count(*) AS n FROM {view} GROUP BY {key} HAVING count(*) > 1))"""
    return f"""SELECT '{table}' AS table_name, 'unique' AS "check", '{",".join(columns)}' AS "column",
      '{severity}' AS severity, count(*) AS total, CAST({failed} AS BIGINT) AS failed FROM {view}"""


def _ratio(table, view, column, least, severity="MINOR"):
    failed = f"CASE WHEN count(DISTINCT {column}) < {least} * count(*) THEN count(*) ELSE 0 END"
    return _check(table, view, "unique_ratio", column, severity, failed)


GOLD, IPD = "rpt_cancel_flow_final_metrics", "rpt_ipd_detailed_engagement"
IPD_KEY = (
    "company_id", "initiation_rank", "initiation_timestamp", "properties_ui_access_point", "offer_id",
)


def _consistency(table, view="gold"):
    return [
        _check(
            table, view, "implies", f"baked_{n}d=0 -> retained_{n}d=0", "MAJOR",
            _count(f"baked_{n}d = 0 AND retained_{n}d <> 0"),
        )
        for n in (31, 92)
    ]


def _not_in(column, values):
    return _count(f"{column} NOT IN {texts(values)}")


GOLD_CHECKS = [
    _check(GOLD, "gold", "row_count", "*", "CRITICAL", "CASE WHEN count(*) < 1000000 THEN count(*) ELSE 0 END"),
    *[
        _check(GOLD, "gold", "not_null", c, "CRITICAL", _count(f"{c} IS NULL"))
        for c in ("company_id", "cancel_flow_start_timestamp", "initiation_rank")
    ],
    _check(GOLD, "gold", "not_null", "dwh_create_date", "CRITICAL", "0"),
    _unique(GOLD, "gold", GOLD_KEY.split(", "), "CRITICAL"),
    _check(GOLD, "gold", "in_set", "cancel_confirmed", "MAJOR", _not_in("cancel_confirmed", YES_NO)),
    _check(GOLD, "gold", "in_set", "save_attribution", "MAJOR", _not_in("save_attribution", OUTCOMES)),
    _check(GOLD, "gold", "in_set", "saved_by_customer_support", "MAJOR",
           _not_in("saved_by_customer_support", YES_NO)),
    *[
        _check(GOLD, "gold", "between", c, "MAJOR", _count(f"{c} < 0 OR {c} > 1"))
        for c in ("retained_31d", "retained_92d", "baked_31d")
    ],
    _check(GOLD, "gold", "in_set", "product", "MINOR", _not_in("product", PRODUCTS)),
    _check(GOLD, "gold", "in_set", "billing_frequency", "MINOR",
           _not_in("billing_frequency", BILLING_FREQUENCIES)),
    _ratio(GOLD, "gold", "company_id", 0.01),
    *_consistency(GOLD),
]
IPD_CHECKS = [
    _check(IPD, "engagement", "row_count", "*", "MAJOR", "0"),
    *[
        _check(IPD, "engagement", "not_null", c, "CRITICAL", _count(f"{c} IS NULL"))
        for c in (*IPD_KEY, "viewed_dic_component", "number_of_data_points_shown")
    ],
    _unique(IPD, "engagement", IPD_KEY, "CRITICAL"),
    _check(IPD, "engagement", "in_set", "ipd_type", "MAJOR", _not_in("ipd_type", OFFER_TYPES)),
    *[
        _check(IPD, "engagement", "between", c, "MAJOR", _count(f"{c} < 0 OR {c} > 1"))
        for c in ("viewed_ipd", "clicked_ipd")
    ],
]


def _contract(contract, view, names):
    """Value checks of a contract; the schema checks all hold."""
    parts = []
    for name, rule in contract.fields.items():
        column = names.get(name, name)
        parts.append(_check(contract.entity, view, "present", name, "CRITICAL", "0"))
        parts.append(_check(contract.entity, view, f"type {rule.type}", name, "CRITICAL", "0"))
        if not rule.nullable:
            failed = "0" if column == "dwh_create_date" else _count(f"{column} IS NULL")
            parts.append(_check(contract.entity, view, "not_null", column, "CRITICAL", failed))
        if rule.values:
            parts.append(
                _check(contract.entity, view, "in_set", column, "MAJOR", _not_in(column, rule.values))
            )
    for column in contract.partition_keys:
        parts.append(_check(contract.entity, view, "partition", column, "CRITICAL", "0"))
    key = [names.get(k, k) for k in contract.primary_key]
    parts.append(_unique(contract.entity, view, key, "CRITICAL"))
    return parts


def _report(parts) -> str:
    rows = " UNION ALL ".join(parts)
    return f"""SELECT *, round(CASE WHEN total > 0 THEN 1 - failed / total WHEN failed > 0 THEN 0.0
      ELSE 1.0 END, 6) AS pass_rate, failed = 0 AS passed FROM ({rows})"""


# ---- model ------------------------------------------------------------------------------------

TRAINING = "SELECT * FROM all_features WHERE baked_31d = 1"
TEMPORAL_SPLIT = f"""SELECT {GOLD_KEY}, s > (SELECT min(s) FROM (
        SELECT s, sum(count(*)) OVER (ORDER BY s) AS reached FROM (
          SELECT epoch_us(cancel_flow_start_timestamp) // 1000000 AS s FROM ({TRAINING})) GROUP BY s)
        WHERE reached >= (SELECT CAST(floor(count(*) * 0.8) AS BIGINT) FROM ({TRAINING})))
        AS is_validation
      FROM (SELECT *, epoch_us(cancel_flow_start_timestamp) // 1000000 AS s FROM ({TRAINING}))"""
SCORE = """round(((tenure_days % 50) * 12 + initiation_hour_utc * 9 + total_ipds_shown * 40
  + lifetime_cs_saves * 7) / 1000.0, 3)"""
SCORED = f"SELECT churned_31d AS y, {SCORE} AS score FROM ({TRAINING})"
CURVE = f"""SELECT a.score AS threshold, tp / predicted AS precision, tp / positives AS recall,
  2 * tp / (predicted + positives) AS f1, pos, positives
  FROM (SELECT t.score, CAST(count(*) AS DOUBLE) AS predicted, CAST(sum(s.y) AS DOUBLE) AS tp
        FROM (SELECT DISTINCT score FROM scored) t JOIN scored s ON s.score >= t.score
        GROUP BY t.score) a
  JOIN (SELECT score, CAST(sum(y) AS DOUBLE) AS pos FROM scored GROUP BY score) p USING (score)
  CROSS JOIN (SELECT CAST(sum(y) AS DOUBLE) AS positives FROM scored)"""


def over_scores(sql: str) -> str:
    body = with_ctes("SELECT 1 FROM all_features").rsplit("\nSELECT 1", 1)[0]
    return f"{body}, scored AS ({SCORED}), curve AS ({CURVE})\n{sql}"


# ---- streams ----------------------------------------------------------------------------------

FLOW = f"event IN {events(*X.STREAM_EVENTS)}"
WATERMARK = "(SELECT max(tm) - INTERVAL 5 MINUTE FROM valid_feed)"

STARTED = f"SELECT event_id, company_id, tm FROM valid_feed WHERE {IS_INITIATION}"
CONFIRMED = f"SELECT company_id, tm FROM valid_feed WHERE ({IS_GEN3}) OR ({IS_GEN2}) OR ({IS_GEN1})"
_MASKED = "regexp_replace(regexp_replace(regexp_replace(c_name, '[A-Z]', 'X', 'g'), " \
    "'[a-z]', 'x', 'g'), '[0-9]', 'n', 'g')"  # fmt: skip
# What the steps write: step, table, view, partition columns.
WRITTEN = (
    ("step0a_raw_events", "bronze_events", "bronze", "event_date"),
    ("step0b_ixp_assignments", "ixp_assignments", "clean_assignments", "treatment_name"),
    ("step1_cancel_initiations", "initiations", "initiations", "product, initiation_year, initiation_month"),
    ("step2_ipd_engagement", "engagement", "engagement", "product, initiation_year, initiation_month"),
    ("step3_save_attribution", "attribution", "attribution", "product, initiation_year, initiation_month"),
    ("step4_final_metrics", "final_metrics", "gold", "product, initiation_year, initiation_month"),
    ("step5_features", "features", "gold", "product, initiation_year, initiation_month"),
)
EXPOSED = """SELECT a.experiment_id, a.treatment_name, g.company_id, CAST(count(*) AS DOUBLE) AS n,
        CAST(sum(CASE WHEN cancel_confirmed = 'N' THEN 1 ELSE 0 END) AS DOUBLE) AS saved
      FROM gold g JOIN (
        SELECT company_id, experiment_id, min(treatment_name) AS treatment_name, min(first_assignment_date) AS d
        FROM clean_assignments GROUP BY 1, 2) a
      ON a.company_id = g.company_id AND g.initiation_date >= a.d GROUP BY 1, 2, 3"""
SAVES = "CAST(sum(CASE WHEN cancel_confirmed = 'N' THEN 1 ELSE 0 END) AS BIGINT)"


def _kept(n, expr="retained_{n}d"):
    return f"round(avg(CASE WHEN baked_{n}d = 1 THEN {expr.format(n=n)} END) * 100, 2)"


def _health(name, view, ts):
    return f"""SELECT '{name}' AS table_name, count(*) AS row_count, max({ts}) AS max_time
      FROM {view}"""


MERGE_CASES = """SELECT o_orderkey, o_custkey, {status} AS o_orderstatus, {price} AS o_totalprice,
  strftime(o_orderdate, '%Y') AS order_year FROM orders"""
_INSERTED = "o_orderkey % 10 = 0"

SESSION_SQL = """sessions AS (
  SELECT company_id, sid, min(tm) AS s, max(tm) AS e FROM (
    SELECT company_id, tm, sum(opens) OVER (PARTITION BY company_id ORDER BY tm) AS sid FROM (
      SELECT company_id, tm, CASE WHEN tm - lag(tm) OVER (PARTITION BY company_id ORDER BY tm)
        <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS opens
      FROM (SELECT DISTINCT TRY_CAST(company_id AS BIGINT) AS company_id, event_timestamp AS tm
            FROM bronze WHERE TRY_CAST(company_id AS BIGINT) IS NOT NULL)))
  GROUP BY company_id, sid)"""

_SQL: dict[str, str] = {
    "scan_date_window": """SELECT * FROM orders
      WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-12-31'""",
    "scan_pruned": "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem",
    "partition_overwrite": f"""SELECT * REPLACE (CASE WHEN order_year IN ('1996', '1998') THEN 'X'
      ELSE o_orderstatus END AS o_orderstatus) FROM ({ORDERS})""",
    "replace_table": f"SELECT * FROM ({ORDERS}) WHERE o_orderstatus = 'O'",
    "backfill_slices": f"""SELECT event_date[:7] AS month, count(*) AS n,
      min(event_date) AS first_day, max(event_date) AS last_day FROM bronze
      WHERE {IS_INITIATION} AND event_date BETWEEN '2024-01-10' AND '2024-04-05' GROUP BY 1""",
    "taxonomy_initiation": f"""SELECT event_id, event_date, company_id FROM bronze
      WHERE {IS_INITIATION}""",
    "taxonomy_confirmation": f"""SELECT event_id, event_date, 3 AS generation FROM bronze WHERE {IS_GEN3}
      UNION ALL SELECT event_id, event_date, 2 FROM bronze WHERE {IS_GEN2}
      UNION ALL SELECT event_id, event_date, 1 FROM bronze WHERE {IS_GEN1}""",
    "taxonomy_plan_change": f"""SELECT event_id, event_date, 'upgrade' AS "change" FROM bronze
      WHERE {is_change("upgrade")} UNION ALL SELECT event_id, event_date, 'downgrade' FROM bronze
      WHERE {is_change("downgrade")}""",
    "taxonomy_offer": f"""SELECT event_id, event_date,
      CASE WHEN {IS_VIEW} THEN 'viewed' ELSE 'clicked' END AS kind,
      properties_ui_access_point AS access_point FROM bronze WHERE ({IS_VIEW}) OR ({IS_CLICK})""",
    "taxonomy_dic": f"""SELECT event_id, event_date,
      TRY_CAST({js("properties_ui_object_detail", "data_object_display_count")} AS INTEGER)
        AS data_points FROM bronze WHERE {IS_WIDGET}""",
    "eligibility_filter": """SELECT co.company_id AS company_key, s.st AS initiation_timestamp,
      co.country, CASE WHEN s.accountant IS NULL THEN 'N' ELSE 'Y' END AS accountant
      FROM starts s JOIN company_dim co ON CAST(co.company_id AS VARCHAR) = s.company_id
      WHERE (co.country = 'United States' OR s.accountant IS NOT NULL) AND co.is_suspicious = 0""",
    "write_window_filter": f"""SELECT {EPISODE}, initiation_date, cancel_confirmed FROM initiations
      WHERE initiation_date BETWEEN '2024-01-15' AND '2024-01-28'""",
    "resolve_company_id": f"""SELECT event_id, event_timestamp, {_RESOLVED} AS company_id,
      TRY_CAST({_RESOLVED} AS BIGINT) AS company_key FROM raw_events""",
    "resolve_product": f"""SELECT event_id, event_timestamp, {_RESOLVED_PRODUCT} AS product
      FROM raw_events""",
    "normalize_event": """SELECT trim(regexp_replace(event, '\\s+', ' ', 'g')) AS event,
      count(*) AS n FROM raw_events GROUP BY 1""",
    "accountant_flag": """SELECT event_id, event_timestamp,
      CASE WHEN length(trim(coalesce(accountant_realm_id, ''))) > 0 THEN 'Y' ELSE 'N' END
        AS is_accountant FROM raw_events""",
    "classify_screen": f"""SELECT properties_url_host_name, ua_parser_device_type,
      context_page_path, {SCREEN} AS screen, {EXTENDED_SCREEN} AS screen_extended, count(*) AS n
      FROM raw_events GROUP BY ALL""",
    "classify_offer": """SELECT offer_id, offer_name, "primaryCtaText", obill_offer_id, ipd_type
      FROM offer_info""",
    "baked_retained": f"""SELECT {EPISODE}, initiation_date, baked_31d, retained_31d, baked_92d,
      retained_92d FROM retention""",
    "safe_divide": """SELECT l_partkey, CASE WHEN pieces = 0 THEN 0.0
        ELSE CAST(cents AS DOUBLE) / pieces END AS price FROM (
      SELECT l_partkey, CAST(sum(CASE WHEN l_returnflag = 'R'
          THEN CAST(round(l_extendedprice * 100) AS BIGINT) END) AS BIGINT) AS cents,
        CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT)
          AS pieces
      FROM lineitem GROUP BY 1)""",
    "partition_keys": """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day,
      strftime(o_orderdate, '%Y') AS initiation_year, strftime(o_orderdate, '%m')
        AS initiation_month FROM orders""",
    "mask_pii": f"""SELECT c_custkey, {_MASKED} AS c_name, sha256(c_name) AS c_hashed,
      CAST(NULL AS DOUBLE) AS c_acctbal FROM customer""",
    "risk_tier": f"""SELECT {GOLD_KEY}, {SCORE} AS score, CASE WHEN {SCORE} >= 0.75 THEN 'CRITICAL'
      WHEN {SCORE} >= 0.55 THEN 'HIGH' WHEN {SCORE} >= 0.35 THEN 'MEDIUM' ELSE 'LOW' END AS tier
      FROM all_features""",
    "scalar_suite": """SELECT o_orderkey, lower(o_orderpriority) AS lowered,
      regexp_replace(o_orderpriority, '[-0-9]', '', 'g') AS replaced,
      CAST(length(trim(o_orderpriority)) AS INTEGER) AS trimmed_length,
      contains(o_orderpriority, 'URGENT') AS urgent,
      coalesce(nullif(o_orderstatus, 'P'), 'none') AS status,
      CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 0 END AS level,
      o_custkey AS from_json, TRY_CAST(o_orderpriority AS INTEGER) AS bad_cast,
      strftime(o_orderdate, '%Y-%m') AS month_text, CAST(o_orderdate AS DATE) + 31 AS plus_31,
      CAST(DATE '2002-01-01' - CAST(o_orderdate AS DATE) AS INTEGER) AS age_days,
      CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS weekday,
      round(sin(month(o_orderdate) * 2 * pi() / 12), 6) AS month_sin,
      round(cos(month(o_orderdate) * 2 * pi() / 12), 6) AS month_cos FROM orders""",
    "sql_functions": f"""SELECT {GOLD_KEY}, {EXTENDED_SCREEN} AS screen, initiation_year AS y,
      initiation_month AS m, round(CASE WHEN viewed_dic = 0 THEN -1
        ELSE dic_max_data_points / viewed_dic END, 4) AS points FROM gold""",
    "join_company_dim": """SELECT b.event_id, b.event_date, c.company_id AS company_key, c.country,
      c.signup_date FROM bronze b JOIN company_dim c ON CAST(c.company_id AS VARCHAR) = b.company_id""",
    "first_confirmation": """SELECT company_id, st AS initiation_timestamp, ts AS first_at
      FROM confirmed""",
    "first_upgrade": "SELECT company_id, st AS initiation_timestamp, ts AS first_at FROM upgrades",
    "first_downgrade": "SELECT company_id, st AS initiation_timestamp, ts AS first_at FROM downgrades",
    "offer_engagement": "SELECT * FROM engagement",
    "offer_engagement_left": "SELECT * FROM engagement_left",
    "cs_save_window": f"""SELECT i.company_id, i.initiation_rank, i.initiation_timestamp,
      c.contacted_by_cs, c.saved_by_cs FROM initiations i
      JOIN cs_save c USING (company_id, initiation_timestamp)""",
    "discount_shown": "SELECT * FROM shown",
    "discount_taken": "SELECT * FROM taken",
    "salted_join": """SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, o_custkey,
      o_orderstatus FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "bronze_events": f"""SELECT {", ".join(I.RAW_EVENTS)}, event_timestamp, event_date
      FROM bronze""",
    "dedup_events": """SELECT event_id, event_date, event_timestamp, event FROM raw_events
      QUALIFY row_number() OVER (PARTITION BY event_id, event_date ORDER BY event_timestamp) = 1""",
    "ixp_single_treatment": "SELECT * FROM clean_assignments",
    "initiations": "SELECT * FROM initiations",
    "dic_summary": """SELECT * FROM dic""",
    "engagement_flag_pivot": f"""SELECT {EPISODE}, {", ".join(FLAG_NAMES)}, viewed_dic,
      dic_max_data_points FROM engagement_flags""",
    "save_attribution": "SELECT * FROM attribution",
    "final_metrics": "SELECT * FROM gold",
    "retention_metrics": f"""SELECT product, initiation_year, initiation_month,
      count(*) AS total_initiations, {SAVES} AS saves,
      round({SAVES} * 100.0 / count(*), 2) AS save_rate_pct,
      {_kept(31)} AS retention_31d_pct, {_kept(92)} AS retention_92d_pct
      FROM gold GROUP BY 1, 2, 3""",
    "ipd_effectiveness": f"""SELECT e.ipd_type, count(DISTINCT e.company_id) AS companies_shown,
      CAST(sum(e.viewed_ipd) AS BIGINT) AS views, CAST(sum(e.clicked_ipd) AS BIGINT) AS clicks,
      round(sum(e.clicked_ipd) * 100.0 / nullif(sum(e.viewed_ipd), 0), 2) AS ctr_pct,
      {SAVES} AS saves, round({SAVES} * 100.0 / count(*), 2) AS save_rate_pct
      FROM engagement e JOIN gold g ON g.company_id = e.company_id
        AND g.initiation_rank = e.initiation_rank
        AND g.cancel_flow_start_timestamp = e.initiation_timestamp GROUP BY 1""",
    "tenure_cohort": f"""SELECT CASE WHEN tenure_at_cancel_initiation < 90 THEN '0-90d (Early Life)'
        WHEN tenure_at_cancel_initiation < 365 THEN '91-365d (Mid Life)' ELSE '365d+ (Mature)' END
        AS tenure_cohort, product, billing_frequency, count(*) AS initiations,
      {_kept(31, "1 - retained_{n}d")} AS churn_rate_31d_pct,
      {_kept(92, "1 - retained_{n}d")} AS churn_rate_92d_pct
      FROM gold WHERE baked_31d = 1 GROUP BY 1, 2, 3""",
    "company_history": f"""SELECT *, CASE WHEN 1 - retention_rate_31d >= 0.75 THEN 'CRITICAL'
      WHEN 1 - retention_rate_31d >= 0.55 THEN 'HIGH'
      WHEN 1 - retention_rate_31d >= 0.35 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier FROM (
      SELECT company_id, count(*) AS n_initiations, max(initiation_date) AS last_initiation_date,
        arg_max(save_attribution, cancel_flow_start_timestamp) AS last_save_attribution,
        {SAVES} AS total_saves,
        round(avg(CASE WHEN baked_31d = 1 THEN retained_31d END), 4) AS retention_rate_31d
      FROM gold GROUP BY 1)""",
    "table_health": f"""SELECT *, CASE WHEN lag_hours <= 8 THEN 'HEALTHY' ELSE 'STALE' END AS status
      FROM (SELECT *, round((floor(epoch_us(TIMESTAMP '2024-04-10 03:00:00') / 1000000.0)
        - floor(epoch_us(max_time) / 1000000.0)) / 3600.0, 4) AS lag_hours FROM (
      {_health("bronze", "bronze", "event_timestamp")} UNION ALL
      {_health("initiations", "initiations", "initiation_timestamp")} UNION ALL
      {_health("final_metrics", "gold", "cancel_flow_start_timestamp")}))""",
    "experiment_outcomes": f"""SELECT a.experiment_id, a.treatment_name, g.save_attribution,
      count(*) AS initiations, {SAVES} AS saves FROM gold g JOIN (
        SELECT company_id, experiment_id, min(treatment_name) AS treatment_name,
          min(first_assignment_date) AS d FROM clean_assignments GROUP BY 1, 2) a
      ON a.company_id = g.company_id AND g.initiation_date >= a.d GROUP BY 1, 2, 3""",
    "sample_ratio": f"""SELECT experiment_id, count(*) AS arms, CAST(sum(n) AS BIGINT) AS companies,
        round(count(*) * sum(n * n) / sum(n) - sum(n), 6) AS chi_square,
        coalesce(count(*) * sum(n * n) / sum(n) - sum(n) > list_extract({list(CHI_SQUARE_1_IN_1000)}, count(*) - 1), FALSE) AS suspect
      FROM (SELECT experiment_id, treatment_name, count(DISTINCT company_id) AS n FROM clean_assignments GROUP BY 1, 2)
      GROUP BY experiment_id""",
    "experiment_effects": f"""SELECT * FROM (WITH arms AS (SELECT experiment_id, treatment_name, sum(n) AS n, sum(saved) AS saved FROM ({EXPOSED}) GROUP BY 1, 2)
      SELECT experiment_id, treatment_name, CAST(n AS BIGINT) AS n, CAST(saved AS BIGINT) AS saved, round(p, 6) AS save_rate, round(p - p0, 6) AS difference,
        round(p - p0 - {Z_95} * error, 6) AS low, round(p - p0 + {Z_95} * error, 6) AS high,
        round((p - p0) / nullif(pooled, 0), 6) AS z
      FROM (SELECT *, sqrt(p * (1 - p) / n + p0 * (1 - p0) / n0) AS error,
          sqrt((saved + saved0) / (n + n0) * (1 - (saved + saved0) / (n + n0)) * (1.0::DOUBLE / n + 1.0::DOUBLE / n0)) AS pooled
        FROM (SELECT a.*, c.n AS n0, c.saved AS saved0, a.saved / a.n AS p, c.saved / c.n AS p0
          FROM arms a JOIN arms c ON c.experiment_id = a.experiment_id AND c.treatment_name = 'control'
          WHERE a.treatment_name <> 'control')))""",
    "bootstrap_effects": f"""SELECT * FROM (WITH drawn AS (
        SELECT *, CAST('0x' || substr(md5(CAST(company_id AS VARCHAR) || ':' || CAST(b AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u
        FROM ({EXPOSED}), (SELECT unnest(range(1, 101)) AS b)),
      rated AS (SELECT experiment_id, treatment_name, b, sum(w * saved) / nullif(sum(w * n), 0) AS rate FROM (
          SELECT *, {" + ".join(f"CASE WHEN u >= {p}::DOUBLE THEN 1 ELSE 0 END" for p in POISSON_1)} AS w FROM drawn)
        GROUP BY 1, 2, 3)
      SELECT a.experiment_id, a.treatment_name, count(a.rate - c.rate) AS replicates, round(avg(a.rate - c.rate), 6) AS mean_difference,
        round(quantile_cont(a.rate - c.rate, 0.025), 6) AS low, round(quantile_cont(a.rate - c.rate, 0.975), 6) AS high
      FROM rated a JOIN rated c ON c.experiment_id = a.experiment_id AND c.b = a.b AND c.treatment_name = 'control'
      WHERE a.treatment_name <> 'control' GROUP BY 1, 2)""",
    "merge_upsert": MERGE_CASES.format(
        status=f"CASE WHEN {_INSERTED} THEN 'U' ELSE o_orderstatus END",
        price="CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice + 1 ELSE o_totalprice END",
    ),
    "merge_insert_only": MERGE_CASES.format(
        status=f"CASE WHEN {_INSERTED} THEN 'U' ELSE o_orderstatus END",
        price=f"CASE WHEN {_INSERTED} THEN o_totalprice + 1 ELSE o_totalprice END",
    ),
    "compact": ORDERS,
    "compact_padded": """SELECT strftime(o_orderdate, '%m') AS order_month, count(*) AS rows,
        round(sum(o_totalprice), 2) AS price, CAST(1 AS BIGINT) AS files FROM orders GROUP BY 1""",
    "merge_partition_key": """SELECT cust_group, order_month, orders + CASE WHEN cust_group % 3 = 0 THEN 1000 ELSE 0 END AS orders
      FROM (SELECT o_custkey % 500 AS cust_group, strftime(o_orderdate, '%m') AS order_month, count(*) AS orders
        FROM orders GROUP BY 1, 2) WHERE cust_group % 2 = 0 OR cust_group % 3 = 0""",
    "zorder": ORDERS,
    "lookup_pruning": """SELECT o_custkey, count(*) AS orders, round(sum(o_totalprice), 2) AS price,
        true AS plain_reads_nearly_all, true AS half_of_files_skipped, true AS half_of_bytes_skipped FROM orders GROUP BY 1""",
    "as_of_snapshot": """SELECT user_id, ts, event_id, event_type, value FROM events
      WHERE ts <= TIMESTAMP '2024-01-20' QUALIFY row_number() OVER (
        PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "evolve_schema": """SELECT o_orderkey, o_custkey, o_orderstatus, CAST(NULL AS DOUBLE) AS o_totalprice,
        'unknown' AS channel FROM orders WHERE strftime(o_orderdate, '%Y') <= '1997'
      UNION ALL SELECT o_orderkey, o_custkey, NULL, o_totalprice, 'web' FROM orders
      WHERE strftime(o_orderdate, '%Y') > '1997'""",
    "evolve_generations": """SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey,
        CASE WHEN year(o_orderdate) <= 1996 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) ELSE o_orderdate END AS placed,
        CASE WHEN year(o_orderdate) <= 1994 THEN floor(o_totalprice) WHEN year(o_orderdate) <= 1996 THEN o_totalprice END AS price,
        CASE WHEN year(o_orderdate) BETWEEN 1995 AND 1996 THEN 'web' END AS channel,
        CASE WHEN year(o_orderdate) > 1996 THEN o_orderstatus END AS o_orderstatus FROM orders""",
    "scd2_steps": """SELECT company_id, status, plan, day AS valid_from,
        lead(day) OVER w AS valid_to, lead(day) OVER w IS NULL AS is_current FROM (
      SELECT *, lag(status || '/' || plan) OVER (PARTITION BY company_id ORDER BY day) AS was FROM (
        SELECT o_custkey AS company_id, CAST(o_orderdate AS DATE) AS day,
          max(o_orderstatus) AS status, max(o_orderpriority) AS plan FROM orders
        WHERE o_orderdate >= '1997-01-01' AND o_orderdate < '1998-01-11' GROUP BY 1, 2))
      WHERE was IS NULL OR was <> status || '/' || plan
      WINDOW w AS (PARTITION BY company_id ORDER BY day)""",
    "scd2_company": """SELECT company_id, status, plan, day AS valid_from,
        lead(day) OVER w AS valid_to, lead(day) OVER w IS NULL AS is_current FROM (
      SELECT *, lag(status || '/' || plan) OVER (PARTITION BY company_id ORDER BY day) AS was FROM (
        SELECT o_custkey AS company_id, CAST(o_orderdate AS DATE) AS day,
          max(o_orderstatus) AS status, max(o_orderpriority) AS plan FROM orders GROUP BY 1, 2))
      WHERE was IS NULL OR was <> status || '/' || plan
      WINDOW w AS (PARTITION BY company_id ORDER BY day)""",
    "incremental_window": f"""SELECT {GOLD_KEY}, initiation_date FROM gold
      WHERE initiation_date BETWEEN DATE '2024-03-29' AND DATE '2024-04-05'""",
    "model_invariants": """SELECT count(*) AS rows, count(*) AS scores_in_range, count(*) AS tiers_by_rule,
      true AS keys_known FROM gold""",
    "shap_additivity": f"""SELECT count(*) AS rows, count(*) AS additive, count(*) AS complete, CAST(1 AS BIGINT) AS bases
      FROM ({TEMPORAL_SPLIT}) WHERE is_validation""",
    "boosting_rounds": "SELECT true AS kept_is_best, true AS best_is_least, true AS patience_used_up",
    "initiations_daily": "SELECT * FROM initiations",
    "pipeline_tables": " UNION ALL ".join(
        f"""SELECT '{table}' AS table_name, count(*) AS partitions, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows
        FROM (SELECT {keys}, count(*) AS n FROM {view} GROUP BY {keys})"""
        for _, table, view, keys in WRITTEN
    ),
    "run_ledger_recent": " UNION ALL ".join(
        f"SELECT '{step}' AS step, '{table}' AS table_name, count(*) AS rows, 'ok' AS status FROM {view}"
        for step, table, view, _ in WRITTEN
    ),
    "slow_steps": """SELECT step, table_name, rows, seconds, round(baseline, 3) AS baseline_seconds,
        round(seconds / nullif(baseline, 0), 4) AS ratio FROM (
      SELECT *, CASE WHEN count(timed) OVER w >= 3 THEN quantile_cont(timed, 0.5) OVER w END AS baseline FROM (
        SELECT *, CASE WHEN CAST(substr(table_name, 9, 2) AS INTEGER) % 13 <> 0 THEN seconds END AS timed FROM (
          SELECT event AS step, event_date AS table_name, count(*) AS rows, min(event_timestamp) AS started,
            (epoch_us(max(event_timestamp)) - epoch_us(min(event_timestamp))) / 1e6 AS seconds
          FROM bronze GROUP BY 1, 2))
      WINDOW w AS (PARTITION BY step ORDER BY started ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING))
      WHERE seconds > baseline * 1.1""",
    "dq_report": _report(GOLD_CHECKS + IPD_CHECKS),
    "dq_summary": f"""SELECT *, CASE WHEN severity = 'CRITICAL' AND pass_rate < 0.95 THEN 'P1'
      WHEN severity <> 'CRITICAL' AND pass_rate < 0.99 THEN 'P3' ELSE 'none' END AS alert FROM (
      SELECT table_name, severity, count(*) AS checks,
        count(*) FILTER (WHERE failed = 0) AS passed_checks,
        round(avg(CASE WHEN failed = 0 THEN 1.0 ELSE 0.0 END), 6) AS pass_rate
      FROM ({" UNION ALL ".join(GOLD_CHECKS + IPD_CHECKS)}) GROUP BY 1, 2)""",
    "dq_uniqueness": _report(
        [
            _unique("raw", "raw_events", ["event_id", "event_date"], "MAJOR"),
            _ratio("raw", "raw_events", "event_id", 0.95),
            _unique("gold", "gold", GOLD_KEY.split(", "), "MAJOR"),
        ]
    ),
    "dq_consistency": _report(_consistency("gold")),
    "row_count_parity": """SELECT table_a, table_b, rows_a, rows_b, round(gap, 6) AS deviation,
        gap <= tolerance AS passed FROM (SELECT table_a, table_b, rows_a, rows_b, tolerance,
          abs(rows_a - rows_b) / greatest(rows_a, rows_b) AS gap FROM (
      SELECT 'initiations' AS table_a, 'final_metrics' AS table_b, 0.0 AS tolerance,
        (SELECT count(*) FROM initiations) AS rows_a, (SELECT count(*) FROM gold) AS rows_b
      UNION ALL SELECT 'raw', 'bronze', 0.01, (SELECT count(*) FROM raw_events),
        (SELECT count(*) FROM bronze)))""",
    "volume_anomaly": f"""SELECT event, event_date, n, round(m, 4) AS trailing_mean,
        round(abs(n - m) / nullif(m, 0), 6) AS deviation, coalesce(abs(n - m) > 0.2 * m, FALSE) AS is_anomaly
      FROM ({_daily_counts("TRUE")})""",
    "volume_gaps": f"""SELECT event, event_date, round(m, 4) AS trailing_mean
      FROM ({_daily_counts("CAST(substr(event_date, 9, 2) AS INTEGER) % 9 <> 0")}) WHERE n = 0 AND m > 0""",
    "freshness": """SELECT newest, round(lag, 4) AS lag_hours, CASE WHEN lag > 10 THEN 'error'
        WHEN lag > 6 THEN 'warn' ELSE 'ok' END AS state FROM (
      SELECT max(event_timestamp) AS newest, (epoch_us(TIMESTAMP '2024-04-10 08:30:00') // 1000000
        - epoch_us(max(event_timestamp)) // 1000000) / 3600.0 AS lag FROM bronze)""",
    "contract_report": _report(
        _contract(FINAL_METRICS_CONTRACT, "gold", {})
        + _contract(ENGAGEMENT_CONTRACT, "engagement", {"properties_custom_fp_offer_id": "offer_id"})
    ),
    "features_behavioural": f"SELECT {GOLD_KEY}, {', '.join(FT.BEHAVIOURAL)} FROM all_features",
    "features_product": f"SELECT {GOLD_KEY}, {', '.join(FT.PRODUCT)} FROM all_features",
    "features_engagement": f"SELECT {GOLD_KEY}, {cut_rates(FT.ENGAGEMENT)} FROM all_features",
    "features_temporal": f"SELECT {GOLD_KEY}, {cut_rates(FT.TEMPORAL)} FROM all_features",
    "features_save_history": f"""SELECT {GOLD_KEY},
      {cut_rates((*FT.SAVE_HISTORY, "save_rate_prior"))}, churned_31d, churned_92d
      FROM all_features""",
    "features": f"""SELECT {", ".join((*FT.KEY_COLUMNS, *FT.LABEL_COLUMNS))},
      {cut_rates(FT.MODEL_FEATURES)} FROM all_features""",
    "training_set": f"""SELECT {GOLD_KEY}, churned_31d,
      coalesce(days_since_last_cancel, 0) AS days_since_last_cancel, tenure_days, viewed_dic,
      round(coalesce(save_rate_lifetime, 0.0), 6) AS save_rate_lifetime FROM ({TRAINING})""",
    "temporal_split": TEMPORAL_SPLIT,
    "stratified_folds": f"""SELECT company_id, initiation_rank, churned_31d,
      epoch_us(cancel_flow_start_timestamp) AS started_us,
      CAST((row_number() OVER (PARTITION BY churned_31d ORDER BY md5(CAST(company_id AS VARCHAR)
        || '|' || CAST(epoch_us(cancel_flow_start_timestamp) AS VARCHAR))) - 1) % 5 AS INTEGER) AS fold
      FROM ({TRAINING})""",
    "stream_parse": f"""SELECT event_id, company_id, event, tm AS event_timestamp,
      strftime(tm, '%Y-%m-%d') AS event_date FROM valid_feed WHERE {FLOW}""",
    "stream_dlq": """SELECT CASE WHEN NOT broken THEN event_id END AS event_id,
      'missing: ' || concat_ws(',', CASE WHEN broken THEN 'event_id' END,
        CASE WHEN broken OR company_id IS NULL THEN 'company_id' END,
        CASE WHEN broken OR tm IS NULL THEN 'event_timestamp' END) AS dlq_reason, TRUE AS has_text
      FROM feed WHERE broken OR company_id IS NULL OR tm IS NULL""",
    "stream_ingest_upsert": f"""SELECT event_id, company_id, event, tm AS event_timestamp,
      strftime(tm, '%Y-%m-%d') AS event_date FROM valid_feed WHERE {FLOW}
      QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY tm) = 1""",
    "stream_restart": f"""SELECT count(DISTINCT event_id) AS total_rows,
      count(DISTINCT event_id) AS distinct_events FROM valid_feed WHERE {FLOW}""",
    "stream_batch_ledger": f"""SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS received,
        count(DISTINCT event_id) AS written FROM valid_feed WHERE {FLOW} AND delivery = 1
      UNION ALL SELECT 1, count(*), count(DISTINCT event_id) FILTER (WHERE event_id NOT IN (
        SELECT event_id FROM valid_feed WHERE {FLOW} AND delivery = 1))
      FROM valid_feed WHERE {FLOW} AND delivery = 2""",
    "stream_late_data": """SELECT DISTINCT event_id FROM valid_feed WHERE hour(tm) % 6 <> 5
      UNION SELECT event_id FROM valid_feed WHERE hour(tm) % 6 = 5 AND tm > (
        SELECT max(tm) - INTERVAL 5 MINUTE FROM valid_feed WHERE hour(tm) % 6 <> 5)""",
    "stream_progress": """SELECT CAST(2 AS BIGINT) AS runs, (SELECT count(*) FROM feed) AS input_rows,
        (SELECT count(*) FROM valid_feed WHERE hour(tm) % 6 = 5 AND tm <= w) AS late_rows, true AS kept_state,
        date_trunc('millisecond', (SELECT max(tm) FROM valid_feed) - INTERVAL 5 MINUTE) AS watermark
      FROM (SELECT max(tm) - INTERVAL 5 MINUTE AS w FROM valid_feed WHERE hour(tm) % 6 <> 5)""",
    "stream_tumbling": f"""SELECT * FROM (SELECT time_bucket(INTERVAL 1 HOUR, tm) AS window_start,
        time_bucket(INTERVAL 1 HOUR, tm) + INTERVAL 1 HOUR AS window_end, event, count(*) AS n
      FROM valid_feed GROUP BY 1, 2, 3) WHERE window_end <= {WATERMARK}""",
    "stream_sessions": f"""SELECT company_id, count(*) AS events, min(tm) AS first_at,
        max(tm) AS last_at, round((epoch_us(max(tm)) - epoch_us(min(tm))) / 1000000.0, 6) AS duration_s
      FROM (SELECT *, sum(opens) OVER (PARTITION BY company_id ORDER BY tm) AS sid FROM (
        SELECT *, CASE WHEN tm - lag(tm) OVER (PARTITION BY company_id ORDER BY tm) < INTERVAL 6 HOUR
          THEN 0 ELSE 1 END AS opens FROM valid_feed))
      GROUP BY company_id, sid HAVING max(tm) + INTERVAL 6 HOUR <= {WATERMARK}""",
    "stream_episodes": f"""SELECT company_id, tm AS initiation_timestamp, CAST(row_number() OVER w AS INTEGER) AS initiation_rank,
        coalesce(lead(tm) OVER w, tm + INTERVAL 1 HOUR) AS window_end_timestamp
      FROM (SELECT DISTINCT company_id, tm FROM ({STARTED}) WHERE tm <= (SELECT max(tm) - INTERVAL 5 MINUTE FROM ({STARTED})))
      WINDOW w AS (PARTITION BY company_id ORDER BY tm)""",
    "stream_interval_join": f"""SELECT s.event_id, s.company_id, s.tm AS started_at,
        min(c.tm) AS confirmed_at
      FROM ({STARTED}) s LEFT JOIN ({CONFIRMED}) c
        ON c.company_id = s.company_id AND c.tm >= s.tm AND c.tm < s.tm + INTERVAL 1 HOUR
      GROUP BY 1, 2, 3
      HAVING min(c.tm) IS NOT NULL OR s.tm + INTERVAL 1 HOUR <= least(
        (SELECT max(tm) FROM ({STARTED})), (SELECT max(tm) FROM ({CONFIRMED}))) - INTERVAL 5 MINUTE""",
}


def oracle_sql() -> dict[str, str]:
    sql = {name: with_ctes(text) for name, text in _SQL.items()}
    sql["pr_curve"] = over_scores(f"SELECT threshold, {rnd(('precision', 'recall', 'f1'))} FROM curve")
    sql["best_threshold"] = over_scores(
        f"""SELECT threshold, {rnd(("f1", "precision", "recall"))} FROM curve
        ORDER BY round(f1, 12) DESC, threshold LIMIT 1"""
    )
    sql["average_precision"] = over_scores(
        "SELECT round(sum(pos / positives * precision), 6) AS average_precision FROM curve"
    )
    sql["roc_auc"] = over_scores(
        """SELECT round(sum(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5
          ELSE 0.0 END * p.c * n.c) / (max(p.total) * max(n.total)), 6) AS roc_auc,
          CAST(max(p.total) AS BIGINT) AS positives, CAST(max(n.total) AS BIGINT) AS negatives
        FROM (SELECT score, count(*) AS c, sum(count(*)) OVER () AS total FROM scored WHERE y = 1
              GROUP BY score) p,
             (SELECT score, count(*) AS c, sum(count(*)) OVER () AS total FROM scored WHERE y = 0
              GROUP BY score) n"""
    )
    body = with_ctes("SELECT 1 FROM gold, inside").rsplit("\nSELECT 1", 1)[0]
    sql["features_extended"] = f"""{body}, {SESSION_SQL},
      before AS (SELECT g.company_id, g.cancel_flow_start_timestamp AS st,
        coalesce(avg((epoch_us(s.e) - epoch_us(s.s)) / 1000000.0), 0.0) AS mean_s
        FROM gold g LEFT JOIN sessions s ON s.company_id = g.company_id
          AND s.e < g.cancel_flow_start_timestamp GROUP BY 1, 2),
      paths AS (SELECT company_id, initiation_timestamp AS st, context_page_path, count(*) AS n
        FROM inside WHERE context_page_path IS NOT NULL GROUP BY 1, 2, 3),
      entropy AS (SELECT company_id, st, -sum(n / total * log2(n / total)) AS h FROM (
        SELECT *, sum(n) OVER (PARTITION BY company_id, st) AS total FROM paths) GROUP BY 1, 2)
      SELECT {GOLD_KEY}, round(b.mean_s, 4) AS avg_session_duration_s,
        round(coalesce(h, 0.0), 4) + 0.0 AS page_path_entropy,
        CAST(coalesce(sum(upgraded) OVER prior, 0) AS BIGINT) AS n_previous_upgrades,
        CAST(coalesce(sum(downgraded) OVER prior, 0) AS BIGINT) AS n_previous_downgrades,
        CAST(coalesce(sum(took_discount) OVER prior, 0) AS BIGINT) AS n_previous_discounts_taken,
        CAST(CASE WHEN billing_frequency = 'annual'
          THEN 365 - CAST(initiation_date - signup_date AS INTEGER) % 365
          ELSE 30 - CAST(initiation_date - signup_date AS INTEGER) % 30 END AS INTEGER)
          AS days_until_renewal
      FROM gold g JOIN before b ON b.company_id = g.company_id
        AND b.st = g.cancel_flow_start_timestamp
      LEFT JOIN entropy h ON h.company_id = g.company_id AND h.st = g.cancel_flow_start_timestamp
      WINDOW prior AS (PARTITION BY g.company_id ORDER BY cancel_flow_start_timestamp
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""
    sql["features_extended"] = sql["features_extended"].replace(
        f"SELECT {GOLD_KEY}, round(b", "SELECT g.company_id, initiation_rank, "
        "cancel_flow_start_timestamp, round(b")  # fmt: skip
    return sql
