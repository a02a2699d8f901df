"""Column rules against truth tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from keepsake.functions import columns as C
from keepsake.functions import taxonomy as X
from keepsake.functions.sql import register_sql_functions

OUTCOME_CASES = [
    ((1, 1, 1, 1, 1), "CS Save", "N"),
    ((0, 1, 0, 0, 0), "Cancelled", "N"),
    ((0, 1, 1, 0, 0), "Cancelled", "N"),
    ((0, 0, 1, 0, 0), "Upgrade Save", "N"),
    ((0, 0, 0, 1, 0), "Downgrade Save", "N"),
    ((0, 0, 1, 1, 0), "Upgrade Save", "N"),
    ((0, 0, 0, 0, 1), "Discount Save", "N"),
    ((0, 0, 0, 0, 0), "Abandoned", "Y"),
    ((None, 0, None, None, None), "Abandoned", "Y"),
]


def test_attribution(spark):
    df = spark.createDataFrame(
        [(*flags, outcome, passive) for flags, outcome, passive in OUTCOME_CASES],
        "cs int, co int, up int, down int, disc int, outcome string, passive string",
    )
    signals = ("cs", "co", "up", "down", "disc")
    got = df.select(
        "outcome", C.attribution(*signals), "passive", C.abandoned_without_help(*signals)
    ).collect()
    assert [(r[0], r[2]) for r in got] == [(r[1], r[3]) for r in got]


OFFER_CASES = [
    ('{"ctaAction": "contact-us-widget"}', "CS IPD"),
    ('{"primaryCtaAction": "contact-us-widget", "obillOfferId": "1"}', "CS IPD"),
    ('{"primaryCtaAction": "external", "obillOfferId": "1", "primaryCtaUrl": "/obillupgrade"}', "Discount IPD"),
    ('{"primaryCtaAction": "external", "primaryCtaUrl": "https://x/obillupgrade/1"}', "Upgrade IPD"),
    ('{"primaryCtaAction": "external", "primaryCtaUrl": "https://x/changeplan/1"}', "Downgrade IPD"),
    ('{"primaryCtaAction": "callbackOnly"}', "Keep my Plan IPD"),
    ('{"primaryCtaAction": "external", "primaryCtaUrl": "https://x/other"}', "Unknown"),
    ("not json", "Unknown"),
    (None, "Unknown"),
]


def test_offer_classes(spark):
    df = spark.createDataFrame(OFFER_CASES, "copy string, want string")
    assert all(a == b for a, b in df.select("want", C.classify_offer_copy("copy")).collect())


SCREEN_CASES = [
    ("accounts.saas.com", "desktop", "/x", "Account Portal"),
    ("app.saas.com", "desktop", "/AccountManager/billing", "Account Portal"),
    ("app.saas.com", "mobile", "/x", "SaaS Mobile App"),
    ("mobile.saas.com", "desktop", "/x", "SaaS Mobile App"),
    ("APP.saas.com", "desktop", None, "SaaS Web App"),
    ("unknown-host.com", "desktop", "/other", "Unknown"),
    ("accounts.saas.com", "mobile", "/app", "Account Portal"),
    (None, None, None, "Unknown"),
    (None, "Tablet", None, "SaaS Mobile App"),
]


def test_screens(spark):
    df = spark.createDataFrame(SCREEN_CASES, "h string, d string, p string, want string")
    got = df.select("want", C.classify_screen("h", "d", "p"))
    assert all(a == b for a, b in got.collect())


def test_extended_screens_equal_the_sql_function(spark):
    register_sql_functions(spark)
    extra = [("dashboard.x.com", "desktop", "/", ""), ("x.com", "desktop", "/accounts.settings", "")]
    df = spark.createDataFrame(SCREEN_CASES + extra, "h string, d string, p string, want string")
    got = df.select(C.classify_screen("h", "d", "p", extended=True), F.expr("flow_screen(h, d, p)"))
    assert all(a == b for a, b in got.collect())
    assert {r[0] for r in got.collect()[-2:]} == {"SaaS Web App", "Account Portal"}


@pytest.mark.parametrize(
    "day, want",
    [("2020-01-01", 1), ("2024-05-31", 0), ("2024-04-30", 0), ("2024-04-29", 1), ("2099-01-01", 0)],
)
def test_baked_is_strict(spark, day, want):
    as_of = F.lit("2024-05-31").cast("date")
    df = spark.range(1).select(C.baked(F.lit(day).cast("date"), 31, as_of))
    assert df.first()[0] == want


def test_null_tolerant_helpers(spark):
    df = spark.createDataFrame([("  ",), ("",), (None,), ("A1",)], "a string")
    assert [r[0] for r in df.select(C.accountant_flag("a")).collect()] == ["N", "N", "N", "Y"]
    got = spark.createDataFrame([(1, 2), (1, 0), (1, None)], "n int, d int").select(
        C.safe_divide("n", "d"), C.safe_divide("n", "d", -1)
    )
    assert [tuple(r) for r in got.collect()] == [(0.5, 0.5), (0.0, -1.0), (0.0, -1.0)]
    bad = spark.createDataFrame([("x12",), ("12",)], "a string").select(C.numeric_id("a"))
    assert [r[0] for r in bad.collect()] == [None, 12]


def test_company_id_priority(spark):
    docs = [
        ('{"client_realm_id": "1"}', '{"client_realm_id": "2"}', "3", "1"),
        ('{"client_realm_id": " "}', '{"client_realm_id": "2"}', "3", "2"),
        ("oops", None, "3", "3"),
        (None, '{"other": 1}', None, None),
    ]
    df = spark.createDataFrame(
        docs, "workflow_state string, widget_state string, company_id string, want string"
    )
    assert all(a == b for a, b in df.select("want", C.resolve_company_id()).collect())


def test_normalize_and_clean(spark):
    got = spark.range(1).select(
        C.normalize_event(F.lit("  workflow: \t started ")), C.clean_offer_id(F.lit(" \"'OB-1'\" "))
    )
    assert tuple(got.first()) == ("workflow: started", "OB-1")


def test_masking(spark):
    df = spark.createDataFrame([("Ann7", "a@b.c", 3)], "name string, mail string, n int")
    got = C.mask_pii(df, {"name": "mask", "mail": "hash", "n": "drop"}).first()
    assert got["name"] == "Xxxn" and len(got["mail"]) == 64 and got["n"] is None
    with pytest.raises(ValueError):
        C.mask_pii(df, {"name": "blur"})


def test_tiers_and_buckets(spark):
    df = spark.createDataFrame([(0.75, 89), (0.55, 90), (0.35, 364), (0.3, 365)], "s double, d int")
    got = df.select(C.risk_tier("s"), C.tenure_bucket("d")).collect()
    assert [tuple(r) for r in got] == [("CRITICAL", 1), ("HIGH", 2), ("MEDIUM", 2), ("LOW", 3)]


EVENT = "event string, {0} string, {1} string, {2} string, {3} string".format(
    X.OBJECT, X.DETAIL, X.ACCESS_POINT, X.SCREEN
)
MILESTONE_CASES = [
    (("workflow: started", "cancel", "cancel_subscription", None, None), "initiation"),
    (("workflow:started", "cancellation_workflow", "cancel", None, None), "initiation"),
    (("workflow: started", "signup", "cancel", None, None), None),
    (("workflow: completed", "cancel", "cancel_success", None, None), "confirmation"),
    (("widget:engaged", "cancel", "yes_cancel", None, None), "confirmation"),
    (("cancelation flow:viewed", "canceled", None, "cancel success", None), "confirmation"),
    (("cancelation flow: viewed", None, None, "cancel success", "cancel complete"), "confirmation"),
    (("cancelation flow: viewed", "canceled", None, "elsewhere", "cancel complete"), None),
    (("workflow:completed", "upgrade", "get_started", None, None), "upgrade"),
    (("workflow: completed", "downgrade", "get_started", None, None), "downgrade"),
    (("offer: viewed", None, None, "AccountSettingsCancel", None), "offer_viewed"),
    (("offer:clicked", None, None, "CancelFlowBillingPage", None), "offer_clicked"),
    (("offer: viewed", None, None, "HomePage", None), None),
    (("content: viewed", "usage-highlights-widget", None, None, None), "widget_viewed"),
]


def test_milestones(spark):
    df = spark.createDataFrame([e for e, _ in MILESTONE_CASES], EVENT)
    got = [r[0] for r in df.select(X.milestone()).collect()]
    assert got == [want for _, want in MILESTONE_CASES]
    flow = [r[0] for r in df.select(X.is_flow_event()).collect()]
    assert all(flow)


def test_confirmation_generations(spark):
    df = spark.createDataFrame([e for e, kind in MILESTONE_CASES if kind == "confirmation"], EVENT)
    assert [r[0] for r in df.select(X.confirmation_generation()).collect()] == [3, 2, 1, 1]


def test_rules_reach_the_scan(spark, tmp_path):
    spark.createDataFrame([e for e, _ in MILESTONE_CASES], EVENT).write.parquet(str(tmp_path / "e"))
    plan = spark.read.parquet(str(tmp_path / "e")).filter(X.INITIATION.match())
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(event" in text.replace("IsNotNull(event), ", "") or "In(event" in text


def test_partition_keys_keep_leading_zero(spark):
    df = spark.createDataFrame([(dt.date(2024, 6, 5),)], "d date")
    got = C.with_partition_keys(df, "d").first()
    assert (got["initiation_year"], got["initiation_month"]) == ("2024", "06")


def test_malformed_ids_and_days_do_not_stop_a_job(spark):
    from keepsake.plans import attribution, episodes, metrics

    companies = spark.createDataFrame(
        [("7", "2024-01-02", "US", 0), ("x12", "2024-01-02", "US", 0), ("8", "no day", "US", 0), (None, None, "US", 0)],
        "company_id string, signup_date string, country string, is_suspicious int",
    )
    known = {r["company_key"]: r["signup_date"] for r in episodes.company_dimension(companies).collect()}
    assert set(known) == {7, 8} and known[8] is None

    base = spark.sql("SELECT 7L AS company_id, DATE '2024-02-01' AS initiation_date")
    cases = spark.createDataFrame(
        [("7", "2024-02-03", "SaaS Core", 1, 1), ("x12", "2024-02-03", "SaaS Core", 2, 1), ("7", "2024-99-03", "SaaS Core", 3, 1)],
        "report_company_id string, report_dt string, program string, cc_id int, saved_cases int",
    )
    assert [r["saved_by_cs"] for r in attribution.support_contacts(base, cases).collect()] == [1]

    status = spark.createDataFrame(
        [("7", "2024-03-03", 1), ("x12", "2024-03-03", 1), ("7", "bad", 1)],
        "company_id string, date_of string, open_subscriber int",
    )
    kept = metrics.retention(base, status, F.lit("2024-12-31").cast("date")).first()
    assert kept["retained_31d"] == 1 and kept["retained_92d"] == 0


def test_an_empty_frame_splits(spark):
    from keepsake.ml import split

    empty = spark.createDataFrame([], "ts timestamp, y int")
    assert split.temporal_split(empty, "ts").count() == 0
