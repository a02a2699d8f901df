"""Every query: a function of (spark, folder) returning a DataFrame, by name."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import ledger as L
from ..functions import columns as C
from ..functions import taxonomy as X
from ..functions.sql import register_sql_functions
from ..ml import metrics as M
from ..ml import model as ML
from ..ml import shap as SH
from ..ml import split as S
from ..operators import joins, layout, timeline, upsert, versions
from ..plans import attribution, bronze, engagement, episodes, features, metrics, reports
from ..plans.steps import Step, run_steps
from ..quality import checks as Q
from ..quality.contract import validate_contract
from ..schemas import ENGAGEMENT_CONTRACT, EPISODE_KEY, FINAL_METRICS_CONTRACT, TABLE_PARTITIONS
from ..sources import streams
from ..sources import tables as io
from ..sources.staging import fresh_path, stage
from ..streaming import episodes as SE
from ..streaming import ingest, progress
from ..streaming import windows as SW
from . import inputs as I
from .tables import plain, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain(fn(spark, folder))

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# ---- scans and sinks ------------------------------------------------------------------------


@query
def scan_date_window(spark, folder):
    """Date-window scan: the filter reaches the Parquet reader."""
    window = io.scan(
        spark, f"{folder}/orders.parquet", "o_orderdate",
        F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1996-12-31").cast("timestamp_ntz"),
    )
    return window


@query
def scan_pruned(spark, folder):
    """Three columns of a wide table."""
    return io.scan(
        spark, f"{folder}/lineitem.parquet", columns=["l_orderkey", "l_partkey", "l_quantity"]
    )


def _orders(spark, folder) -> DataFrame:
    return I.table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        C.partition_year("o_orderdate").alias("order_year"),
    )


def _read(spark, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


@query
def partition_overwrite(spark, folder):
    """Rewrite the partitions of two years; the others stay."""
    orders, path = _orders(spark, folder), fresh_path(spark, "orders")
    io.write_partitions(orders, path, ["order_year"])
    corrected = orders.filter(F.col("order_year").isin("1996", "1998")).withColumn(
        "o_orderstatus", F.lit("X")
    )
    io.write_partitions(corrected, path, ["order_year"])
    return _read(spark, path, orders)


@query
def replace_table(spark, folder):
    """Replace the whole table with the open orders."""
    orders, path = _orders(spark, folder), fresh_path(spark, "orders")
    io.replace_table(orders, path, ["order_year"])
    open_orders = orders.filter(F.col("o_orderstatus") == "O")
    io.replace_table(open_orders, path, ["order_year"])
    return _read(spark, path, orders)


@query
def backfill_slices(spark, folder):
    """Month-by-month backfill of the initiation events, then some days again; rows per month."""
    starts = (
        tables(spark, folder)
        .events.filter(X.INITIATION.match())
        .select("event_id", "company_id", "event_date", F.substring("event_date", 1, 7).alias("month"))
    )
    path = fresh_path(spark, "backfill")
    step = lambda a, b: starts.filter(F.col("event_date").between(a, b))
    for first, last in (("2024-01-10", "2024-04-05"), ("2024-02-10", "2024-03-05")):
        io.backfill(step, first, last, path, ["month"], date_col="event_date")
    written = _read(spark, path, starts)
    return written.groupBy("month").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("event_date").alias("first_day"),
        F.max("event_date").alias("last_day"),
    )


# ---- projections and predicates ---------------------------------------------------------------


def _tagged(spark, folder, **flags) -> DataFrame:
    events = tables(spark, folder).events
    return events.select("event_id", "event_date", *[e.alias(n) for n, e in flags.items()])


@query
def taxonomy_initiation(spark, folder):
    events = tables(spark, folder).events
    return events.filter(X.INITIATION.match()).select("event_id", "event_date", "company_id")


@query
def taxonomy_confirmation(spark, folder):
    tagged = _tagged(spark, folder, generation=X.confirmation_generation())
    return tagged.filter("generation IS NOT NULL")


@query
def taxonomy_plan_change(spark, folder):
    events = tables(spark, folder).events
    kind = F.when(X.UPGRADE.match(), "upgrade").when(X.DOWNGRADE.match(), "downgrade")
    return (
        events.select("event_id", "event_date", kind.alias("change")).filter("change IS NOT NULL")
    )


@query
def taxonomy_offer(spark, folder):
    kind = F.when(X.OFFER_VIEWED.match(), "viewed").when(X.OFFER_CLICKED.match(), "clicked")
    return _tagged(
        spark, folder, kind=kind, access_point=F.col(X.ACCESS_POINT)
    ).filter("kind IS NOT NULL")


@query
def taxonomy_dic(spark, folder):
    events = tables(spark, folder).events
    points = C.json_text(X.DETAIL, "data_object_display_count").try_cast("int")
    return events.filter(X.USAGE_WIDGET_VIEWED.match()).select(
        "event_id", "event_date", points.alias("data_points")
    )


@query
def eligibility_filter(spark, folder):
    """Initiations with their company, by the country and accountant rule."""
    t = tables(spark, folder)
    starts = t.moments.filter(F.col("kind") == "initiation").withColumn(
        "accountant", C.accountant_flag("accountant_id_starting_cancellation")
    )
    dim = episodes.company_dimension(t.input("companies"))
    joined = joins.dimension_join(starts, dim, ["company_id"])
    return joined.filter(C.eligible("country", "accountant", "is_suspicious")).select(
        "company_key", F.col("at").alias("initiation_timestamp"), "country", "accountant"
    )


@query
def write_window_filter(spark, folder):
    """Episodes of a two-week run; ranks still count the earlier ones."""
    t = tables(spark, folder)
    found = episodes.initiations(
        t.events, t.input("companies"), "2024-01-15", "2024-01-28", cut=lambda df, label: t.moments
    )
    return found.select(*EPISODE_KEY, "initiation_date", "cancel_confirmed")


@query
def resolve_company_id(spark, folder):
    return tables(spark, folder).raw().select(
        "event_id", "event_timestamp", C.resolve_company_id().alias("company_id"),
        C.numeric_id(C.resolve_company_id()).alias("company_key"),
    )


@query
def resolve_product(spark, folder):
    raw = tables(spark, folder).raw()
    return raw.select("event_id", "event_timestamp", C.resolve_product().alias("product"))


@query
def normalize_event(spark, folder):
    raw = tables(spark, folder).raw()
    return raw.groupBy(C.normalize_event("event").alias("event")).agg(F.count(F.lit(1)).alias("n"))


@query
def accountant_flag(spark, folder):
    raw = tables(spark, folder).raw()
    return raw.select(
        "event_id", "event_timestamp", C.accountant_flag("accountant_realm_id").alias("is_accountant")
    )


@query
def classify_screen(spark, folder):
    """Screen class of every event, by the plain and the extended rules."""
    columns = ("properties_url_host_name", "ua_parser_device_type", "context_page_path")
    raw = tables(spark, folder).raw()
    return raw.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).select(
        *columns,
        C.classify_screen(*columns).alias("screen"),
        C.classify_screen(*columns, extended=True).alias("screen_extended"),
        "n",
    )


@query
def classify_offer(spark, folder):
    return engagement.describe_offers(tables(spark, folder).input("offers"))


@query
def baked_retained(spark, folder):
    t = tables(spark, folder)
    rows = t.initiations.select(*EPISODE_KEY, "initiation_date")
    return metrics.retention(rows, t.input("subscriber_status"), t.as_of)


@query
def safe_divide(spark, folder):
    """Average price in cents of the returned pieces per part, 0 for parts without returns."""
    lines = I.table(spark, folder, "lineitem")
    returned = F.col("l_returnflag") == "R"
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    per_part = lines.groupBy("l_partkey").agg(
        F.sum(F.when(returned, cents)).alias("cents"),
        F.sum(F.when(returned, F.col("l_quantity").cast("bigint")).otherwise(0)).alias("pieces"),
    )
    return per_part.select("l_partkey", C.safe_divide("cents", "pieces").alias("price"))


@query
def partition_keys(spark, folder):
    orders = I.table(spark, folder, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return C.with_partition_keys(orders, "day")


@query
def mask_pii(spark, folder):
    people = I.table(spark, folder, "customer").select(
        "c_custkey", "c_name", F.col("c_name").alias("c_hashed"), "c_acctbal"
    )
    return C.mask_pii(people, {"c_hashed": "hash", "c_name": "mask", "c_acctbal": "drop"})


@query
def risk_tier(spark, folder):
    scored = tables(spark, folder).features.select(
        "company_id", "initiation_rank", "cancel_flow_start_timestamp", _stand_in_score().alias("score")
    )
    return scored.withColumn("tier", C.risk_tier("score"))


@query
def scalar_suite(spark, folder):
    """One expression of each scalar family over all orders."""
    orders = I.table(spark, folder, "orders")
    day = F.to_date("o_orderdate")
    angle = F.month(day) * 2 * F.pi() / 12
    doc = F.to_json(F.struct(F.col("o_orderpriority").alias("p"), F.col("o_custkey").alias("c")))
    level = F.create_map(F.lit("O"), F.lit(1), F.lit("F"), F.lit(2))[F.col("o_orderstatus")]
    return orders.select(
        "o_orderkey",
        F.lower("o_orderpriority").alias("lowered"),
        F.regexp_replace("o_orderpriority", "[-0-9]", "").alias("replaced"),
        F.length(F.trim("o_orderpriority")).alias("trimmed_length"),
        F.col("o_orderpriority").contains("URGENT").alias("urgent"),
        F.coalesce(F.nullif(F.col("o_orderstatus"), F.lit("P")), F.lit("none")).alias("status"),
        F.coalesce(level, F.lit(0)).alias("level"),
        F.get_json_object(doc, "$.c").try_cast("bigint").alias("from_json"),
        F.col("o_orderpriority").try_cast("int").alias("bad_cast"),
        F.date_format(day, "yyyy-MM").alias("month_text"),
        F.date_add(day, 31).alias("plus_31"),
        F.datediff(F.lit("2002-01-01").cast("date"), day).alias("age_days"),
        F.dayofweek(day).alias("weekday"),
        F.round(F.sin(angle), 6).alias("month_sin"),
        F.round(F.cos(angle), 6).alias("month_cos"),
    )


@query
def sql_functions(spark, folder):
    """The rules called from SQL text."""
    register_sql_functions(spark)
    tables(spark, folder).gold.createOrReplaceTempView("keepsake_gold")
    return spark.sql(
        """SELECT company_id, initiation_rank, cancel_flow_start_timestamp,
             flow_screen(properties_url_host_name, ua_parser_device_type, context_page_path)
               AS screen,
             partition_year(initiation_date) AS y, partition_month(initiation_date) AS m,
             round(safe_divide(dic_max_data_points, viewed_dic, -1), 4) AS points
           FROM keepsake_gold"""
    )


# ---- joins ------------------------------------------------------------------------------------


@query
def join_company_dim(spark, folder):
    """Text ids of the events against numeric ids of the dimension, duplicates removed."""
    t = tables(spark, folder)
    dim = episodes.company_dimension(t.input("companies"))
    return joins.dimension_join(t.events, dim, ["company_id"]).select(
        "event_id", "event_date", "company_key", "country", "signup_date"
    )


def _first(spark, folder, kind: str) -> DataFrame:
    """Episodes of all companies with the first event of a kind inside their window."""
    t = tables(spark, folder)
    starts = (
        t.moments.filter(F.col("kind") == "initiation")
        .select("company_id", "sku", F.col("at").alias("initiation_timestamp"))
    )
    found = episodes.with_windows(starts).join(
        episodes.first_after(t.moments, kinds=[kind]), ["company_id", "initiation_timestamp"]
    )
    end = F.col("window_end_timestamp")
    if kind != "confirmation":
        end = F.col("initiation_timestamp") + F.expr("INTERVAL 1 DAY")
    at = episodes.within(f"next_{kind}", "initiation_timestamp", end, closed=kind != "confirmation")
    return found.select("company_id", "initiation_timestamp", at.alias("first_at")).filter(
        "first_at IS NOT NULL"
    )


@query
def first_confirmation(spark, folder):
    return _first(spark, folder, "confirmation")


@query
def first_upgrade(spark, folder):
    return _first(spark, folder, "upgrade")


@query
def first_downgrade(spark, folder):
    return _first(spark, folder, "downgrade")


@query
def offer_engagement(spark, folder):
    return tables(spark, folder).engagement


@query
def offer_engagement_left(spark, folder):
    t = tables(spark, folder)
    return engagement.offer_engagement(t.initiations, t.events, t.input("offers"), how="left")


@query
def cs_save_window(spark, folder):
    t = tables(spark, folder)
    rows = t.initiations.select(*EPISODE_KEY, "initiation_date")
    return attribution.support_contacts(rows, t.input("reactive_saves")).drop("initiation_date")


@query
def discount_shown(spark, folder):
    return attribution.discount_shown(tables(spark, folder).engagement)


@query
def discount_taken(spark, folder):
    t = tables(spark, folder)
    return attribution.discount_taken(t.engagement, t.input("offer_history"))


@query
def salted_join(spark, folder):
    """Line items with their order, heavy orders split over salts."""
    lines = I.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"
    )
    orders = I.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return joins.salted_join(lines, orders, ["o_orderkey"], salts=8, heavy_rows=4)


# ---- tables -----------------------------------------------------------------------------------


@query
def bronze_events(spark, folder):
    kept = [c for c in I.RAW_EVENTS] + ["event_timestamp", "event_date"]
    return bronze.bronze_events(tables(spark, folder).raw(), I.FIRST_DAY, I.LAST_DAY).select(*kept)


@query
def dedup_events(spark, folder):
    """First delivery per event and day."""
    raw = tables(spark, folder).raw().select("event_id", "event_date", "event_timestamp", "event")
    return joins.one_per_key(raw, ["event_id", "event_date"], ["event_timestamp"])


@query
def ixp_single_treatment(spark, folder):
    rows = tables(spark, folder).input("assignments")
    return bronze.single_treatment(rows, I.FIRST_DAY, I.LAST_DAY)


@query
def initiations(spark, folder):
    t = tables(spark, folder)
    return episodes.initiations(
        t.events, t.input("companies"), cut=lambda df, label: t.moments
    )


@query
def dic_summary(spark, folder):
    t = tables(spark, folder)
    assigned = engagement.in_episodes(t.initiations, t.events)
    return engagement.widget_summary(assigned)


@query
def engagement_flag_pivot(spark, folder):
    return metrics.engagement_flags(tables(spark, folder).engagement)


@query
def save_attribution(spark, folder):
    t = tables(spark, folder)
    return attribution.save_attribution(
        t.initiations, t.engagement, t.input("reactive_saves"), t.input("offer_history")
    )


AUDIT = ("dwh_create_date", "dwh_update_date")


@query
def final_metrics(spark, folder):
    return tables(spark, folder).gold.drop(*AUDIT)


# ---- reports ----------------------------------------------------------------------------------


@query
def retention_metrics(spark, folder):
    return reports.retention_metrics(tables(spark, folder).gold)


@query
def ipd_effectiveness(spark, folder):
    t = tables(spark, folder)
    return reports.ipd_effectiveness(t.engagement, t.gold)


@query
def tenure_cohort(spark, folder):
    return reports.tenure_churn(tables(spark, folder).gold)


@query
def company_history(spark, folder):
    return reports.company_history(tables(spark, folder).gold)


@query
def table_health(spark, folder):
    t = tables(spark, folder)
    return reports.table_health(
        {
            "bronze": (t.events, "event_timestamp"),
            "initiations": (t.initiations, "initiation_timestamp"),
            "final_metrics": (t.gold, "cancel_flow_start_timestamp"),
        },
        F.lit("2024-04-10 03:00:00").cast("timestamp"),
    )


@query
def experiment_outcomes(spark, folder):
    t = tables(spark, folder)
    clean = bronze.single_treatment(t.input("assignments"), I.FIRST_DAY, I.LAST_DAY)
    return reports.experiment_outcomes(t.gold, clean)


def _assignments(spark, folder) -> DataFrame:
    return bronze.single_treatment(tables(spark, folder).input("assignments"), I.FIRST_DAY, I.LAST_DAY)


@query
def sample_ratio(spark, folder):
    return reports.sample_ratio(_assignments(spark, folder))


@query
def experiment_effects(spark, folder):
    return reports.experiment_effects(tables(spark, folder).gold, _assignments(spark, folder))


@query
def bootstrap_effects(spark, folder):
    return reports.bootstrap_effects(tables(spark, folder).gold, _assignments(spark, folder))


# ---- upsert, layout, versions -----------------------------------------------------------------


def _merge_inputs(spark, folder):
    orders = _orders(spark, folder)
    old = orders.filter(F.col("o_orderkey") % 10 != 0)
    new = orders.filter(F.col("o_orderkey") % 5 == 0).withColumns(
        {"o_totalprice": F.col("o_totalprice") + 1, "o_orderstatus": F.lit("U")}
    )
    path = fresh_path(spark, "merge")
    io.write_partitions(old, path, ["order_year"])
    return orders, new, path


@query
def merge_upsert(spark, folder):
    """Update the price of known orders and insert new ones, twice over with the same result."""
    orders, new, path = _merge_inputs(spark, folder)
    for _ in range(2):
        upsert.merge_upsert(spark, path, new, ["o_orderkey"], ["order_year"], ["o_totalprice"])
    return _read(spark, path, orders)


@query
def merge_insert_only(spark, folder):
    orders, new, path = _merge_inputs(spark, folder)
    upsert.merge_upsert(spark, path, new, ["o_orderkey"], ["order_year"], insert_only=True)
    return _read(spark, path, orders)


@query
def compact(spark, folder):
    """Two partitions rewritten into fewer files, all rows unchanged."""
    orders, path = _orders(spark, folder), fresh_path(spark, "compact")
    orders.write.partitionBy("order_year").parquet(path)
    layout.compact(spark, path, ["order_year"], F.col("order_year").isin("1996", "1997"))
    return _read(spark, path, orders)


def _padded_orders(spark, folder) -> DataFrame:
    """Orders with the month as two digits, as the tables' partitions have it."""
    return I.table(spark, folder, "orders").withColumn("order_month", F.date_format("o_orderdate", "MM"))


@query
def compact_padded(spark, folder):
    """Folders 01 to 09 compacted under their own names, by a table that keeps no schema."""
    orders, path = _padded_orders(spark, folder), fresh_path(spark, "padded")
    orders.repartition(4).write.partitionBy("order_month").parquet(path)
    layout.compact(spark, path, ["order_month"])
    stored = _read(spark, path, orders)
    sizes = stored.groupBy("order_month").agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("o_totalprice"), 2).alias("price"))
    paths = stored.select("order_month", F.col("_metadata.file_path").alias("file")).distinct()
    return sizes.join(paths.groupBy("order_month").agg(F.count(F.lit(1)).alias("files")), "order_month")


@query
def merge_partition_key(spark, folder):
    """A merge whose key holds the partition, a month of two digits; half of the keys are new there."""
    monthly = (
        _padded_orders(spark, folder)
        .groupBy((F.col("o_custkey") % 500).alias("cust_group"), "order_month")
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    path = fresh_path(spark, "monthly")
    io.replace_table(monthly.filter("cust_group % 2 = 0"), path, ["order_month"])
    upsert.merge_upsert(
        spark, path, monthly.filter("cust_group % 3 = 0").withColumn("orders", F.col("orders") + 1000),
        ["cust_group", "order_month"], ["order_month"],
    )
    return _read(spark, path, monthly)


@query
def zorder(spark, folder):
    """Orders clustered on customer, price and status, all rows unchanged."""
    orders, path = _orders(spark, folder), fresh_path(spark, "zorder")
    clustered = layout.zorder(orders, ["o_custkey", "o_totalprice", "o_orderstatus"], files=8)
    clustered.write.parquet(path)
    return _read(spark, path, orders)


@query
def lookup_pruning(spark, folder):
    """Lookups of every customer in orders as given and as written for lookups: same rows, far fewer files and bytes."""
    orders = I.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    plain_path, path = fresh_path(spark, "plain"), fresh_path(spark, "lookups")
    orders.repartition(16).write.parquet(plain_path)
    layout.write_for_lookups(orders, path, ["o_custkey", "o_orderdate"], files=16)
    before, after = (layout.lookup_pruning(spark, p, "o_custkey").first() for p in (plain_path, path))
    found = spark.read.parquet(path).groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("price")
    )
    return found.select(
        "*",
        F.lit(before["files_read"] > 0.9 * before["files"]).alias("plain_reads_nearly_all"),
        F.lit(1 <= after["least_files"] and 2 * after["files_read"] <= after["files"]).alias("half_of_files_skipped"),
        F.lit(2 * after["bytes_read"] <= after["bytes"]).alias("half_of_bytes_skipped"),
    )


@query
def as_of_snapshot(spark, folder):
    """State of every user at a point in time, from the append-only events."""
    rows = I.table(spark, folder, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return versions.as_of_snapshot(
        rows, ["user_id"], "ts", F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    )


@query
def evolve_schema(spark, folder):
    """Old and new shape of a table under one schema."""
    orders = _orders(spark, folder)
    old = orders.filter(F.col("order_year") <= "1997").select("o_orderkey", "o_custkey", "o_orderstatus")
    new = orders.filter(F.col("order_year") > "1997").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.lit("web").alias("channel")
    )
    return versions.append_evolved(old, new, {"channel": "unknown"})


@query
def evolve_generations(spark, folder):
    """Three generations of a table's files, with wider types and more columns each time, read under one schema."""
    path = fresh_path(spark, "generations")
    orders = I.table(spark, folder, "orders").withColumn("year", F.year("o_orderdate"))
    day, price = F.col("o_orderdate").cast("date"), F.col("o_totalprice")
    key = F.col("o_orderkey").cast("int").alias("o_orderkey")
    io.append_merged(orders.filter("year <= 1994").select(key, day.alias("placed"), F.floor(price).cast("int").alias("price")), path)
    io.append_merged(
        orders.filter("year BETWEEN 1995 AND 1996").select(
            F.col("o_orderkey").cast("bigint").alias("o_orderkey"), day.alias("placed"), price.alias("price"), F.lit("web").alias("channel")
        ),
        path,
    )
    io.append_merged(
        orders.filter("year > 1996").select(key, F.col("o_orderdate").cast("timestamp_ntz").alias("placed"), "o_orderstatus"), path
    )
    return io.read_table(spark, path)


@query
def scd2_company(spark, folder):
    """Order status and priority of each customer as a type-2 history."""
    orders = I.table(spark, folder, "orders")
    daily = orders.groupBy(F.col("o_custkey").alias("company_id"), F.to_date("o_orderdate").alias("day")).agg(
        F.max("o_orderstatus").alias("status"), F.max("o_orderpriority").alias("plan")
    )
    return versions.scd2(daily, ["company_id"], ["status", "plan"], "day")


@query
def scd2_steps(spark, folder):
    """The history of 1997, brought forward day by day with what changed, over ten days more."""
    orders = I.table(spark, folder, "orders")
    daily = orders.groupBy(F.col("o_custkey").alias("company_id"), F.to_date("o_orderdate").alias("day")).agg(
        F.max("o_orderstatus").alias("status"), F.max("o_orderpriority").alias("plan")
    )
    daily = stage(daily.filter("year(day) >= 1997"), "daily")
    history = versions.scd2(daily.filter("year(day) = 1997"), ["company_id"], ["status", "plan"], "day")
    for n in range(1, 11):
        day = f"1998-01-{n:02d}"
        changed = daily.filter(F.col("day") == F.lit(day).cast("date")).drop("day")
        history = versions.scd2_apply(stage(history, "history"), changed, ["company_id"], ["status", "plan"], day)
    return history


@query
def incremental_window(spark, folder):
    rows = tables(spark, folder).gold.select(*FINAL_METRICS_CONTRACT.primary_key, "initiation_date")
    return upsert.incremental_window(rows, "initiation_date", "2024-04-05")


def _written(spark, folder) -> tuple[str, str]:
    """Root folder and ledger of a run of all steps, made once per folder and application."""
    t = tables(spark, folder)
    if not hasattr(t, "written"):
        root, ledger = fresh_path(spark, "tables"), fresh_path(spark, "ledger")
        steps = [
            Step("step0a_raw_events", "bronze_events", lambda: t.events, ("event_date",)),
            Step("step0b_ixp_assignments", "ixp_assignments",
                 lambda: ixp_single_treatment(spark, folder), ("treatment_name",)),
            Step("step1_cancel_initiations", "initiations", lambda: t.initiations),
            Step("step2_ipd_engagement", "engagement", lambda: t.engagement),
            Step("step3_save_attribution", "attribution", lambda: t.attribution,
                 same_rows_as="step1_cancel_initiations"),
            Step("step4_final_metrics", "final_metrics", lambda: t.gold,
                 same_rows_as="step1_cancel_initiations"),
            Step("step5_features", "features", lambda: t.features, same_rows_as="step4_final_metrics"),
        ]
        run_steps(spark, steps, root, ledger)
        t.written = (root, ledger)
    return t.written


@query
def initiations_daily(spark, folder):
    """The table of episodes, grown slice by slice with the events of each slice only."""
    t = tables(spark, folder)
    moments, path = fresh_path(spark, "moments"), fresh_path(spark, "episodes")
    for first, last in io.month_slices(I.FIRST_DAY, I.LAST_DAY):
        part = t.events.filter(F.col("event_date").between(first, last))
        episodes.initiations_of_slice(spark, part, t.input("companies"), first, moments, path)
    return _read(spark, path, t.initiations)


@query
def pipeline_tables(spark, folder):
    """Partitions and rows of every table that the steps wrote, read back from the files."""
    root, _ = _written(spark, folder)
    parts = {"bronze_events": ["event_date"], "ixp_assignments": ["treatment_name"]}
    counted = []
    for name in ("bronze_events", "ixp_assignments", "initiations", "engagement", "attribution",
                 "final_metrics", "features"):
        stored = io.read_table(spark, f"{root}/{name}")
        keys = parts.get(name, list(TABLE_PARTITIONS))
        sizes = stored.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        counted.append(
            sizes.agg(
                F.lit(name).alias("table_name"),
                F.count(F.lit(1)).alias("partitions"),
                F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            )
        )
    return reduce(lambda a, b: a.unionByName(b), counted)


@query
def run_ledger_recent(spark, folder):
    """The latest runs that were recorded, without their times, which differ from run to run."""
    ledger = spark.read.parquet(_written(spark, folder)[1])
    return L.recent_runs(ledger, 20).select("step", "table_name", "rows", "status")


@query
def slow_steps(spark, folder):
    """Days on which an event type kept its feed busy far longer than usual, by the ledger's own comparison.

    The ledger is made from the events: a run for each type and day, from its first event to its last.
    """
    events = tables(spark, folder).events
    seconds = (F.unix_micros(F.max("event_timestamp")) - F.unix_micros(F.min("event_timestamp"))) / 1e6
    runs = events.groupBy(F.col("event").alias("step"), F.col("event_date").alias("table_name")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("event_timestamp").alias("started"), seconds.alias("seconds")
    )
    failed = F.substring("table_name", 9, 2).cast("int") % 13 == 0
    slow = L.slow_steps(runs.withColumn("status", F.when(failed, "failed").otherwise("ok")), factor=1.1, failed=True)
    return slow.select("step", "table_name", "rows", "seconds", F.round("baseline_seconds", 3).alias("baseline_seconds"), "ratio")


# ---- data quality -----------------------------------------------------------------------------


def _reports(spark, folder) -> DataFrame:
    t = tables(spark, folder)
    gold = Q.run_checks(
        t.gold, Q.metrics_suite() + Q.retention_consistency(), "rpt_cancel_flow_final_metrics"
    )
    return gold.unionByName(
        Q.run_checks(t.engagement, Q.engagement_suite(), "rpt_ipd_detailed_engagement")
    )


@query
def dq_report(spark, folder):
    return _reports(spark, folder)


@query
def dq_summary(spark, folder):
    return Q.summarize(_reports(spark, folder))


@query
def dq_uniqueness(spark, folder):
    """Key checks on raw deliveries, which do contain copies, and on the wide table."""
    t = tables(spark, folder)
    raw = Q.run_checks(
        t.raw(), [Q.unique("event_id", "event_date"), Q.unique_ratio("event_id", at_least=0.95)], "raw"
    )
    gold = Q.run_checks(t.gold, [Q.unique(*FINAL_METRICS_CONTRACT.primary_key)], "gold")
    return raw.unionByName(gold)


@query
def dq_consistency(spark, folder):
    return Q.run_checks(tables(spark, folder).gold, Q.retention_consistency(), "gold")


@query
def row_count_parity(spark, folder):
    t = tables(spark, folder)
    return Q.row_parity(t.initiations, t.gold, labels=("initiations", "final_metrics")).unionByName(
        Q.row_parity(t.raw(), t.events, 0.01, ("raw", "bronze"))
    )


@query
def volume_anomaly(spark, folder):
    daily = tables(spark, folder).events.groupBy("event", "event_date").agg(F.count(F.lit(1)).alias("n"))
    return Q.volume_anomaly(daily, "event", "event_date", "n")


@query
def volume_gaps(spark, folder):
    """Every ninth day of the month is taken out of the events: all such days come back, as anomalies of 0 rows."""
    events = tables(spark, folder).events.filter(F.substring("event_date", 9, 2).cast("int") % 9 != 0)
    daily = events.groupBy("event", "event_date").agg(F.count(F.lit(1)).alias("n"))
    found = Q.volume_anomaly(daily, "event", "event_date", "n")
    return found.filter("n = 0 AND is_anomaly").select("event", "event_date", "trailing_mean")


@query
def freshness(spark, folder):
    as_of = F.lit("2024-04-10 08:30:00").cast("timestamp")
    return Q.freshness(tables(spark, folder).events, "event_timestamp", as_of)


@query
def contract_report(spark, folder):
    t = tables(spark, folder)
    return validate_contract(t.gold, FINAL_METRICS_CONTRACT).unionByName(
        validate_contract(t.engagement, ENGAGEMENT_CONTRACT)
    )


# ---- features and model -----------------------------------------------------------------------

KEYS = list(features.KEY_COLUMNS[:3])


@query
def features_behavioural(spark, folder):
    history = features.company_history(tables(spark, folder).gold)
    return features.behavioural(history).select(*KEYS, *features.BEHAVIOURAL)


@query
def features_product(spark, folder):
    return features.product(tables(spark, folder).gold).select(*KEYS, *features.PRODUCT)


@query
def features_engagement(spark, folder):
    made = features.engagement(tables(spark, folder).gold).select(*KEYS, *features.ENGAGEMENT)
    return rounded(made, *[c for c in features.ENGAGEMENT if c.endswith("_rate")])


@query
def features_temporal(spark, folder):
    made = features.temporal(tables(spark, folder).gold).select(*KEYS, *features.TEMPORAL)
    return rounded(made, "cohort_month_sin", "cohort_month_cos")


@query
def features_save_history(spark, folder):
    made = features.save_history(features.company_history(tables(spark, folder).gold))
    picked = made.select(
        *KEYS, *features.SAVE_HISTORY, "save_rate_prior", "churned_31d", "churned_92d"
    )
    return rounded(picked, "save_rate_lifetime", "save_rate_prior")


@query
def features_extended(spark, folder):
    t = tables(spark, folder)
    made = features.extended(t.gold, t.initiations, t.events)
    return rounded(made, "avg_session_duration_s", "page_path_entropy", digits=4)


@query
def all_features_table(spark, folder):
    made = features.features(tables(spark, folder).gold)
    rates = [c for c in features.MODEL_FEATURES if "_rate" in c] + ["cohort_month_sin", "cohort_month_cos"]
    return rounded(made, *rates)


QUERIES["features"] = QUERIES.pop("all_features_table")


def _stand_in_score():
    """A fixed formula in [0, 1] over feature columns, for metrics that need some score."""
    raw = (
        F.pmod(F.col("tenure_days"), F.lit(50)) * 12
        + F.col("initiation_hour_utc") * 9
        + F.col("total_ipds_shown") * 40
        + F.col("lifetime_cs_saves") * 7
    )
    return F.round(raw / 1000.0, 3)


def _scored(spark, folder) -> DataFrame:
    rows = S.training_set(tables(spark, folder).features)
    return rows.select(S.TARGET, _stand_in_score().alias("score"))


@query
def training_set(spark, folder):
    made = S.training_set(tables(spark, folder).features)
    return made.select(*KEYS, S.TARGET, "days_since_last_cancel", "tenure_days", "viewed_dic",
                       F.round("save_rate_lifetime", 6).alias("save_rate_lifetime"))


@query
def temporal_split(spark, folder):
    rows = S.training_set(tables(spark, folder).features).select(*KEYS)
    return S.temporal_split(rows, "cancel_flow_start_timestamp")


@query
def stratified_folds(spark, folder):
    rows = S.training_set(tables(spark, folder).features).select("company_id", "initiation_rank", S.TARGET,
        F.unix_micros("cancel_flow_start_timestamp").alias("started_us"))
    return S.stratified_folds(rows, S.TARGET, ["company_id", "started_us"]).withColumn(
        "fold", F.col("fold").cast("int")
    )


@query
def pr_curve(spark, folder):
    curve = M.pr_curve(_scored(spark, folder), S.TARGET, "score")
    return rounded(curve.select("threshold", "precision", "recall", "f1"), "precision", "recall", "f1")


@query
def best_threshold(spark, folder):
    best = M.best_threshold(M.pr_curve(_scored(spark, folder), S.TARGET, "score"))
    return rounded(best, "f1", "precision", "recall")


@query
def roc_auc(spark, folder):
    return rounded(M.roc_auc(_scored(spark, folder), S.TARGET, "score"), "roc_auc")


@query
def average_precision(spark, folder):
    curve = M.pr_curve(_scored(spark, folder), S.TARGET, "score")
    return rounded(M.average_precision(curve), "average_precision")


def _model_columns(rows: DataFrame) -> list[str]:
    return [c for c in features.MODEL_FEATURES if c in rows.columns]


def _fitted(spark, folder):
    """Model, rows, columns and loss curve: fitted once per folder and application, as the daily scores use it."""
    t = tables(spark, folder)
    if not hasattr(t, "fitted"):
        rows = S.temporal_split(S.training_set(t.features), KEYS[2])
        columns = _model_columns(rows)
        model, losses = ML.train_with_curve(rows, columns, validation="is_validation")
        t.fitted = (model, rows, columns, losses)
    return t.fitted


@query
def churn_scores(spark, folder):
    model = _fitted(spark, folder)[0]
    t = tables(spark, folder)
    current = t.features.fillna(0)
    return ML.score(model, current, t.as_of).select(*KEYS, "score", "risk_tier", "as_of_date")


@query
def model_report(spark, folder):
    """Train, score the held-out part, and rate the scores."""
    model, rows, *_ = _fitted(spark, folder)
    made = ML.report(model, rows.filter("is_validation"))
    return rounded(made, "roc_auc", "average_precision", "f1", "precision", "recall")


@query
def model_invariants(spark, folder):
    """What holds for any fitted model: one score in [0, 1] for each episode, tiers by the rule."""
    scored = QUERIES["churn_scores"](spark, folder)
    keys = tables(spark, folder).gold.select("company_id", "initiation_rank")
    right = scored.join(keys, ["company_id", "initiation_rank"], "left_semi").count() == scored.count()
    return scored.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("score").between(0, 1)).alias("scores_in_range"),
        F.count_if(F.col("risk_tier") == C.risk_tier(F.col("score"))).alias("tiers_by_rule"),
        F.lit(right).alias("keys_known"),
    )


@query
def cv_auc(spark, folder):
    rows = S.training_set(tables(spark, folder).features)
    rated = ML.cross_validate(rows, _model_columns(rows), KEYS)
    return rated.agg(F.avg("roc_auc").alias("mean_auc"), F.stddev_pop("roc_auc").alias("std_auc"))


@query
def feature_importance(spark, folder):
    model, rows, columns, _ = _fitted(spark, folder)
    held_out = rows.filter("is_validation")
    return ML.top_features(ML.permutation_importance(model, held_out, columns, KEYS))


@query
def shap_importance(spark, folder):
    """The features with the largest mean attribution over all held-out episodes."""
    model, rows, columns, _ = _fitted(spark, folder)
    explained = SH.attributions(model, rows.filter("is_validation"), KEYS)
    return ML.top_features(SH.importance(explained, columns))


@query
def shap_additivity(spark, folder):
    """Attributions of every held-out episode add up to its margin, from one base for all."""
    model, rows, columns, _ = _fitted(spark, folder)
    explained = SH.attributions(model, rows.filter("is_validation"), KEYS)
    total = F.col("base") + F.aggregate("shap", F.lit(0.0), lambda a, x: a + x)
    return explained.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.abs(total - F.col("margin")) < 1e-9).alias("additive"),
        F.count_if(F.size("shap") == len(columns)).alias("complete"),
        F.countDistinct("base").alias("bases"),
    )


@query
def boosting_rounds(spark, folder):
    """The model ends at the round of least validation loss, and boosting went on for the whole patience."""
    model, _, _, losses = _fitted(spark, folder)
    kept = model.stages[1].getNumTrees
    config = ML.ChurnConfig()
    best, stopped = ML.kept_round(losses, config.patience)
    seen = losses[: best + config.patience + 1] if stopped else losses
    row = (kept == best + 1, losses[kept - 1] == min(seen), stopped or len(losses) == config.trees)
    return spark.createDataFrame([row], "kept_is_best boolean, best_is_least boolean, patience_used_up boolean")


# ---- streams ----------------------------------------------------------------------------------


class Feed:
    """The clickstream as files that a stream reads, in two deliveries."""

    def __init__(self, spark, folder, second: str = "delivery = 2"):
        self.spark, self.path = spark, fresh_path(spark, "feed")
        self.checkpoint = fresh_path(spark, "checkpoint")
        self.rows, self.second = I.feed(spark, folder), F.expr(f"coalesce({second}, false)")
        self.ended: list = []

    def deliver(self, number: int | None = None) -> None:
        rows = self.rows
        if number:
            rows = rows.filter(self.second if number == 2 else ~self.second)
        rows.select("raw_json").write.mode("append").text(self.path)

    def source(self) -> DataFrame:
        return streams.stream_source(self.spark, "files", {"path": self.path})

    def valid(self) -> DataFrame:
        return ingest.split_valid(ingest.parse_events(self.source()))[0]

    def drain(self, df: DataFrame, label: str, partition_cols=()) -> DataFrame:
        """Everything delivered so far, through the stream into files, read back."""
        path = f"{self.checkpoint}-{label}"
        sink = streams.stream_sink(
            df, path, f"{self.checkpoint}/{label}", partition_cols, trigger={"availableNow": True}
        )
        started = sink.start()
        started.awaitTermination()
        self.ended.append(started)
        return self.spark.read.schema(df.schema).parquet(path)


@query
def stream_parse(spark, folder):
    f = Feed(spark, folder)
    f.deliver()
    return f.drain(ingest.flow_events(f.valid()), "events").select(
        "event_id", "company_id", "event", "event_timestamp", "event_date"
    )


@query
def stream_dlq(spark, folder):
    f = Feed(spark, folder)
    f.deliver()
    dead = ingest.split_valid(ingest.parse_events(f.source()))[1]
    return f.drain(dead, "dlq", ("received_date",)).select(
        "event_id", "dlq_reason", F.length("raw_json").cast("bigint").alias("chars") > 5
    ).toDF("event_id", "dlq_reason", "has_text")


def _ingest_twice(spark, folder):
    """Two deliveries through the whole ingest, the query restarted in between."""
    f = Feed(spark, folder)
    out, ledger = fresh_path(spark, "stream-table"), fresh_path(spark, "stream-ledger")
    for number in (1, 2):
        f.deliver(number)
        queries = ingest.start_ingest(
            spark, "files", {"path": f.path}, out, f.checkpoint, {"availableNow": True}, ledger
        )
        for q in queries:
            q.awaitTermination()
    return io.read_table(spark, out), io.read_table(spark, ledger)


@query
def stream_ingest_upsert(spark, folder):
    table, _ = _ingest_twice(spark, folder)
    return table.select(
        "event_id", "company_id", "event", "event_timestamp", F.col("event_date").cast("string")
    )


@query
def stream_restart(spark, folder):
    """Rows and distinct events after a restart: equal, as nothing is inserted twice."""
    table, _ = _ingest_twice(spark, folder)
    per_event = table.groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))
    return per_event.agg(F.sum("n").alias("total_rows"), F.count(F.lit(1)).alias("distinct_events"))


@query
def stream_batch_ledger(spark, folder):
    _, ledger = _ingest_twice(spark, folder)
    return ledger.select(F.col("batch_id").cast("bigint"), "received", "written")


@query
def stream_late_data(spark, folder):
    """Some hours arrive after the others; what lies behind the watermark is dropped."""
    f = Feed(spark, folder, second="hour(at) % 6 = 5")
    for number in (1, 2):
        f.deliver(number)
        kept = SW.drop_late_duplicates(f.valid(), ["event_id"], "event_timestamp")
        result = f.drain(kept, "kept")
    return result.select("event_id")


@query
def stream_progress(spark, folder):
    """What the queries over late data reported: rows read, and rows dropped behind the watermark."""
    f = Feed(spark, folder, second="hour(at) % 6 = 5")
    path = fresh_path(spark, "progress")
    listener = progress.ProgressLedger(spark, path)
    spark.streams.addListener(listener)
    try:
        for number in (1, 2):
            f.deliver(number)
            kept = SW.drop_late_duplicates(f.valid(), ["event_id"], "event_timestamp")
            f.drain(kept, "watched")
            listener.wait(f.ended)
    finally:
        spark.streams.removeListener(listener)
    reports = spark.read.schema(progress.PROGRESS_SCHEMA).parquet(path)
    return reports.agg(
        F.countDistinct("run").alias("runs"),
        F.sum("input_rows").alias("input_rows"),
        F.sum("late_rows").alias("late_rows"),
        F.max(F.col("state_rows") > 0).alias("kept_state"),
        F.max(F.to_timestamp("watermark", "yyyy-MM-dd'T'HH:mm:ss.SSSX")).alias("watermark"),
    )


@query
def stream_tumbling(spark, folder):
    f = Feed(spark, folder)
    f.deliver()
    counts = SW.tumbling_counts(f.valid(), "event_timestamp", ["event"])
    return f.drain(counts, "hourly")


@query
def stream_sessions(spark, folder):
    f = Feed(spark, folder)
    f.deliver()
    sessions = SW.sessionize(f.valid(), "company_id", "event_timestamp", "6 hours")
    return f.drain(sessions, "sessions")


@query
def stream_episodes(spark, folder):
    """Rank and window of episodes, detected as events arrive in two deliveries; what the batch says up to the watermark."""
    f = Feed(spark, folder, second="at >= TIMESTAMP '2024-03-15 00:00:00'")
    for number in (1, 2):
        f.deliver(number)
        starts = f.valid().filter(X.INITIATION.match()).select("company_id", "event_timestamp")
        found = SE.detect_episodes(starts, ["company_id"], "event_timestamp")
        emitted = f.drain(found, "episodes")
    return SE.latest_episodes(emitted, ["company_id"])


@query
def stream_interval_join(spark, folder):
    """First confirmation within the hour per initiation, from two streams."""
    f = Feed(spark, folder)
    f.deliver()
    starts = f.valid().filter(X.INITIATION.match()).select(
        "event_id", "company_id", F.col("event_timestamp").alias("started_at")
    )
    confirmations = f.valid().filter(X.is_confirmation()).select(
        F.col("company_id"), F.col("event_timestamp").alias("confirmed_at")
    )
    pairs = f.drain(
        SW.matched_within(starts, confirmations, "company_id", "started_at", "confirmed_at"), "pairs"
    )
    return pairs.groupBy("event_id", "company_id", "started_at").agg(
        F.min("confirmed_at").alias("confirmed_at")
    )
