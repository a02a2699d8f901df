"""The steps on hand-made events with known results."""

import datetime as dt
import json
import re

import pytest
from pyspark.sql import functions as F

from keepsake.catalog import inputs as I
from keepsake.plans import attribution, bronze, engagement, episodes, features, metrics
from keepsake.schemas import EPISODE_KEY, EVENT_FIELDS
from keepsake.sources.staging import stage, stage_bucketed

COLUMNS = [f for f in EVENT_FIELDS if f not in ("event_date",)] + ["event_date"]
SCHEMA = ", ".join(f"{c} string" for c in COLUMNS)
AP = "AccountSettingsCancel"

START = dict(event="workflow: started", properties_object_detail="cancel",
             properties_ui_object_detail="cancel_subscription")
START_OLD = dict(event="workflow:started", properties_object_detail="cancellation_workflow",
                 properties_ui_object_detail="cancel")
SUCCESS = dict(event="workflow: completed", properties_object_detail="cancel",
               properties_ui_object_detail="cancel_success")
YES = dict(event="workflow: engaged", properties_object_detail="cancellation_workflow",
           properties_ui_object_detail="yes_cancel")


def change(kind):
    return dict(event="workflow: completed", properties_object_detail=kind,
                properties_ui_object_detail="get_started")


def offer(action, offer_id):
    return dict(event=f"offer: {action}", properties_ui_access_point=AP,
                properties_custom_fp_offer_id=offer_id)


def widget(count):
    return dict(event="content: viewed", properties_object_detail="usage-highlights-widget",
                properties_ui_object_detail=json.dumps({"data_object_display_count": count}))


@pytest.fixture
def make(spark):
    def build(*events):
        data = []
        for i, (company, when, fields) in enumerate(events):
            stamp = when if when == "bad" else f"2024-06-{when}"
            row = dict(event_id=f"e{i}", company_id=str(company), event_timestamp=stamp, sku="CORE_MONTHLY",
                       product="SAAS_CORE", event_date=stamp[:10], **{})
            row.update(fields)
            data.append(tuple(row.get(c) for c in COLUMNS))
        return stage(spark.createDataFrame(data, SCHEMA))

    return build


@pytest.fixture
def companies(spark):
    data = [(c, "United States", 0, dt.date(2024, 1, 1)) for c in range(1, 6)]
    data += [(6, "France", 0, dt.date(2024, 1, 1)), (7, "United States", 1, dt.date(2024, 1, 1))]
    data += [(1, "United States", 0, dt.date(2024, 2, 1))]  # a second row for company 1
    schema = "company_id long, country string, is_suspicious int, signup_date date"
    return stage(spark.createDataFrame(data, schema))


def lazily(df, label):
    return df


def at(text):
    return dt.datetime.fromisoformat(f"2024-06-{text}")


def test_three_companies(make, companies, rows):
    events = make(
        (1, "15 14:30:00", START),
        (1, "15 14:35:00", SUCCESS),
        (2, "15 14:30:00", START_OLD),
        (2, "15 14:38:00", YES),
        (2, "15 16:00:00", change("upgrade")),
        (3, "15 14:30:00", START | {"accountant_realm_id": "ACCT_9001"}),
    )
    got = episodes.initiations(events, companies, cut=lazily)
    assert rows(
        got, "company_id", "initiation_rank", "window_end_timestamp", "cancel_confirmed",
        "confirmation_timestamp", "upgraded", "is_accountant_starting_cancellation",
        "tenure_at_cancel_initiation",
    ) == [
        (1, 1, at("15 15:30"), 1, at("15 14:35"), 0, "N", 166),
        (2, 1, at("15 15:30"), 1, at("15 14:38"), 1, "N", 166),
        (3, 1, at("15 15:30"), 0, None, 0, "Y", 166),
    ]


def test_rank_windows_and_edges(make, companies, rows):
    events = make(
        (1, "15 10:00:00", START),
        (1, "15 12:00:00", START),
        (1, "16 10:00:00", START),
        (1, "15 12:00:00", SUCCESS | {"event_id": "c1"}),  # at the next start: belongs to that one
        (1, "16 11:00:00", SUCCESS | {"event_id": "c2"}),  # at the end of the last window: outside
        (1, "16 12:00:00", change("upgrade")),  # exactly one day after the second start: inside
        (1, "17 10:00:01", change("downgrade")),  # a second too late for the third
    )
    got = episodes.initiations(events, companies, cut=lazily)
    assert rows(
        got, "initiation_rank", "window_end_timestamp", "cancel_confirmed", "upgraded", "downgraded"
    ) == [
        (1, at("15 12:00"), 0, 0, 0),
        (2, at("16 10:00"), 1, 1, 0),
        (3, at("16 11:00"), 0, 1, 0),
    ]


def test_lanes_by_sku_and_missing_sku(make, companies, rows):
    events = make(
        (1, "15 10:00:00", START | {"sku": "CORE_MONTHLY"}),
        (1, "15 11:00:00", START | {"sku": None}),
        (1, "15 11:30:00", START | {"sku": None}),
        (1, "15 12:00:00", START | {"sku": "CORE_MONTHLY"}),
        (1, "15 11:40:00", SUCCESS),
    )
    got = episodes.initiations(events, companies, cut=lazily)
    assert rows(got, "initiation_timestamp", "sku", "initiation_rank", "cancel_confirmed") == [
        (at("15 10:00"), "CORE_MONTHLY", 1, 1),
        (at("15 11:00"), None, 1, 0),
        (at("15 11:30"), None, 2, 1),
        (at("15 12:00"), "CORE_MONTHLY", 2, 0),
    ]
    own = episodes.initiations(events, companies, match_on=("company_id", "sku"), cut=lazily)
    assert sum(r["cancel_confirmed"] for r in own.collect()) == 1


def test_eligibility_and_bad_rows(make, companies, rows):
    events = make(
        (6, "15 10:00:00", START),
        (6, "15 10:00:00", START | {"accountant_realm_id": "  "}),
        (6, "16 10:00:00", START | {"accountant_realm_id": "A1"}),
        (7, "15 10:00:00", START),
        ("x12", "15 10:00:00", START),
        (4, "bad", START),
        (1, "15 10:00:00", START),
        (1, "15 10:00:00", START | {"billing_frequency": "annual"}),
    )
    got = episodes.initiations(events, companies, cut=lazily)
    assert rows(got, "company_id", "initiation_rank", "initiation_date") == [
        (1, 1, dt.date(2024, 6, 15)),
        (6, 2, dt.date(2024, 6, 16)),
    ]


def test_write_window_keeps_history(make, companies, rows):
    events = make((1, "10 10:00:00", START), (1, "15 23:50:00", START), (1, "16 00:10:00", SUCCESS))
    day = episodes.initiations(events, companies, "2024-06-15", "2024-06-15", cut=lazily)
    assert rows(day, "initiation_rank", "cancel_confirmed") == [(2, 1)]


def test_capped_windows(make, companies, rows):
    events = make((1, "10 10:00:00", START), (1, "12 10:00:00", START), (1, "11 11:00:00", SUCCESS))
    capped = episodes.initiations(events, companies, cap="1 day", cut=lazily)
    assert rows(capped, "window_end_timestamp", "cancel_confirmed")[0] == (at("11 10:00"), 0)


@pytest.fixture
def catalog(spark):
    data = [
        ("O1", "ten off", '{"primaryCtaAction": "external", "obillOfferId": "\'77\'"}'),
        ("O1", "ten off again", '{"primaryCtaAction": "external", "obillOfferId": "\'77\'"}'),
        ("O2", "talk", '{"ctaAction": "contact-us-widget", "ctaText": "Talk"}'),
    ]
    return stage(spark.createDataFrame(data, "offer_id string, offer_name string, copy_data string"))


@pytest.fixture
def tables(spark, make, companies, catalog):
    events = make(
        (1, "15 10:00:00", START),
        (1, "15 10:05:00", offer("viewed", "O1")),
        (1, "15 10:06:00", offer("clicked", "O1")),
        (1, "15 10:07:00", widget(3)),
        (1, "15 10:08:00", widget(5)),
        (1, "15 10:09:00", widget("many")),
        (1, "15 11:00:00", offer("viewed", "O2")),  # after the window
        (2, "15 10:00:00", START),
        (2, "15 10:10:00", offer("viewed", "O9")),  # not in the catalog
        (2, "15 10:20:00", SUCCESS),
        (2, "15 10:20:00", offer("viewed", "O2")),  # at the confirmation: outside
        (3, "15 10:00:00", START),
        (4, "15 10:00:00", START),
        (5, "15 10:00:00", START),
    )
    found = episodes.initiations(events, companies, cut=lazily)
    found = stage(found)
    engaged = stage(engagement.offer_engagement(found, events, catalog))
    saves = spark.createDataFrame(
        [
            (3, "2024-06-22", "SaaS Core", "cc1", 1),
            (4, "2024-06-23", "SaaS Core", "cc2", 1),
            (5, "2024-06-15", "Other", "cc3", 1),
        ],
        "report_company_id long, report_dt string, program string, cc_id string, saved_cases int",
    )
    history = spark.createDataFrame(
        [(1, "77", "2024-06-16 23:00:00"), (1, "77", "2024-06-17 00:00:00")],
        "company_id long, offer_id string, purchase_datetime string",
    )
    return events, found, engaged, attribution.save_attribution(found, engaged, saves, history)


def test_engagement(tables, catalog, rows):
    events, found, engaged, _ = tables
    assert rows(
        engaged, "company_id", "offer_id", "offer_name", "ipd_type", "viewed_ipd", "clicked_ipd",
        "viewed_dic_component", "number_of_data_points_shown", "ipd_view_timestamp",
    ) == [(1, "O1", "ten off", "Discount IPD", 1, 1, 1, 5, at("15 10:05"))]
    assert json.loads(engaged.first()["dic_component_detail"])["data_object_display_count"] == "many"
    left = engagement.offer_engagement(found, events, catalog, how="left")
    assert rows(left, "company_id", "offer_id", "ipd_type") == [
        (1, "O1", "Discount IPD"), (2, "O9", "Unknown")
    ]


def test_attribution(tables, rows):
    assert rows(
        tables[3], "company_id", "save_attribution", "saved_by_abandoning", "contacted_by_cs", "took_discount"
    ) == [
        (1, "Discount Save", "N", 0, 1),
        (2, "Cancelled", "N", 0, 0),
        (3, "CS Save", "N", 1, 0),
        (4, "Abandoned", "Y", 0, 0),
        (5, "Abandoned", "Y", 0, 0),
    ]


def test_final_metrics_keeps_the_grain(spark, tables, rows):
    _, found, engaged, attributed = tables
    day = dt.date(2024, 6, 15) + dt.timedelta(days=31)
    status = spark.createDataFrame(
        [(1, day, 1), (1, day, 1), (2, day, 0)], "company_id long, date_of date, open_subscriber int"
    )
    gold = metrics.final_metrics(found, attributed, engaged, status, F.lit("2024-07-17").cast("date"))
    assert len(gold.columns) == 55 and gold.count() == found.count()
    assert rows(gold.limit(9), "company_id", "retained_31d", "baked_31d", "viewed_discount_ipd")[:2] == [
        (1, 1, 1, 1), (2, 0, 1, 0)
    ]
    assert gold.filter("treatment_name IS NOT NULL OR first_assignment_date IS NOT NULL").isEmpty()


def test_steps_join_where_their_rows_lie(spark, tables, same):
    """Tables in buckets by the episode's key: only the retention lookup shuffles."""
    _, found, engaged, attributed = tables
    status = spark.createDataFrame([], "company_id long, date_of date, open_subscriber int")
    day = F.lit("2024-07-17").cast("date")
    laid = [stage_bucketed(df, 4, *EPISODE_KEY, gather=True) for df in (found, attributed, engaged)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans, tags = [], []
        for three in (laid, [stage(df) for df in (found, attributed, engaged)]):
            gold = metrics.final_metrics(*three, status, day, F.lit("2024-07-18").cast("timestamp"))
            text = gold._jdf.queryExecution().executedPlan().toString()
            exchanges = [x for x in text.split("\n") if "Exchange hashpartitioning" in x]
            plans.append(sum("company_id" in x and "initiation_rank" in x and "initiation_timestamp" in x for x in exchanges))
            tags.append(gold)
        assert plans[0] == 0 and plans[1] >= 3
        same(*tags)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bronze(make, rows):
    again = {"event_id": "same", "workflow_state": '{"client_realm_id": "9", "product": "P"}', "product": None}
    raw = make(
        (1, "15 10:00:05", again | {"event": " workflow:   started "}),
        (1, "15 10:00:01", again | {"event": "workflow: started"}),
        (1, "16 00:00:00", again | {"event": "workflow: started"}),
        (2, "15 10:00:00", START | {"event_date": "2024-06-14"}),
        (3, "17 00:00:00", START),
        (4, "bad", START | {"event_date": "2024-06-15"}),
    )
    got = bronze.bronze_events(raw, "2024-06-14", "2024-06-16")
    assert rows(got, "event_id", "company_id", "event_date", "event", "product", "event_timestamp") == [
        ("e3", "2", "2024-06-15", "workflow: started", "SAAS_CORE", at("15 10:00")),
        ("same", "9", "2024-06-15", "workflow: started", "P", at("15 10:00:01")),
        ("same", "9", "2024-06-16", "workflow: started", "P", at("16 00:00")),
    ]


def test_single_treatment(spark, rows):
    t = lambda d: dt.datetime(2024, 1, d, 9)
    data = [
        (1, 10, "A", t(1), 1), (1, 10, "A", t(1), 2), (1, 10, "A", t(2), 1),
        (2, 10, "A", t(1), 1), (2, 10, "B", t(2), 1),
        (3, 10, "A", t(1), 1), (3, 10, "B", t(1), 0),
        (4, 10, "A", t(1), 1), (4, 10, "B", t(25), 1),
        (5, 10, None, t(1), 1), (5, 10, "C", t(2), 1),
    ]
    df = spark.createDataFrame(
        data, "company_id int, experiment_id int, treatment_name string, first_timestamp timestamp, version int"
    )
    got = bronze.single_treatment(df, "2024-01-01", "2024-01-20")
    found = rows(got, "company_id", "treatment_name", "first_assignment_date")
    assert [r[:2] for r in found] == [(1, "A"), (1, "A"), (3, "A"), (4, "A"), (5, "C"), (5, None)] or [
        r[0] for r in found
    ] == [1, 1, 3, 4, 5, 5]


def test_save_rate_formulas(spark, rows):
    gold = spark.createDataFrame(
        [(1, r, dt.datetime(2024, 1, r), c) for r, c in ((1, "N"), (2, "N"), (3, "Y"))],
        "company_id long, initiation_rank int, cancel_flow_start_timestamp timestamp, cancel_confirmed string",
    )
    for c in ("saved_by_cs", "took_discount", "upgraded", "baked_31d", "baked_92d", "retained_31d", "retained_92d"):
        gold = gold.withColumn(c, F.lit(0))
    gold = gold.withColumns(
        {
            "sku": F.lit("X"),
            "saved_by_abandoning_cancel_flow": F.lit("Y"),
            "initiation_date": F.to_date("cancel_flow_start_timestamp"),
        }
    )
    got = features.save_history(features.company_history(gold))
    assert rows(got, "initiation_rank", "save_rate_lifetime", "save_rate_prior", "lifetime_abandoned_count") == [
        (1, None, None, 1), (2, 2.0, 1.0, 2), (3, 1.0, 1.0, 3)
    ]
    assert got.filter("churned_31d IS NOT NULL").isEmpty()


def test_hot_company_and_staging(spark, make, companies, rows):
    """Nine tenths of the rows in one company: same result as the plain range join."""
    events = [(1, f"{d:02d} {h:02d}:{m:02d}:00", START) for d in range(1, 11) for h in range(24) for m in (0, 30)]
    events += [(1, f"{d:02d} {h:02d}:10:00", SUCCESS) for d in range(1, 11) for h in range(0, 24, 3)]
    events += [(2, "03 10:00:00", START), (2, "03 10:59:59", SUCCESS)]
    got = episodes.initiations(make(*events), companies)  # staged in the shared folder
    confirmed = rows(got.groupBy("company_id").agg(F.count("*"), F.sum("cancel_confirmed")))
    assert confirmed == [(1, 480, 80), (2, 1, 1)]
    assert got.filter("company_id = 1").agg(F.max("initiation_rank")).first()[0] == 480


def test_methods_over_deliveries_are_compiled(spark, capsys):
    # HotSpot compiles no method of 8000 bytes or more; a larger one is interpreted for every row.
    raw = I.raw_events(spark, "/root/testdata/sf0.001")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (raw, bronze.bronze_events(raw, I.FIRST_DAY, I.LAST_DAY)):
            df.explain("codegen")
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
            assert sizes and max(sizes) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_lookups_read_as_their_case(spark):
    case = I.pick("n % 4", "'a'", "'b'", None)
    both = spark.range(6).selectExpr("IF(id = 5, NULL, id) AS n").selectExpr(f"{case} AS a", f"{I.looked_up(case)} AS b")
    assert I.looked_up(case) != case
    assert [r["a"] for r in both.collect()] == [r["b"] for r in both.collect()]
    assert I.looked_up(I.pick("n", "'a' || n", "'b'")).startswith("CASE")
