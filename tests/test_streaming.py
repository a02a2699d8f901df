import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from keepsake.sources import streams
from keepsake.streaming import episodes as SE
from keepsake.streaming import ingest, progress
from keepsake.streaming import windows as SW

T0 = dt.datetime(2024, 1, 1, 10)


def event(i, minutes=0, company="1", name="workflow: started"):
    return json.dumps(
        {"event_id": i, "company_id": company, "event": name,
         "event_timestamp": (T0 + dt.timedelta(minutes=minutes)).isoformat()}
    )


@pytest.fixture
def feed(spark, tmp_path):
    """Append lines as one delivery; the stream reads the folder."""
    folder = str(tmp_path / "feed")

    def deliver(*lines):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(folder)

    deliver.path = folder
    return deliver


def run(spark, feed, tmp_path, ledger=None):
    queries = ingest.start_ingest(
        spark, "files", {"path": feed.path}, str(tmp_path / "out"), str(tmp_path / "ckpt"),
        {"availableNow": True}, ledger,
    )
    for q in queries:
        q.awaitTermination()


def test_source_options():
    fmt, options, payload = streams.source_options("kafka", {"bootstrap_servers": "h:1", "topic": "t"})
    assert (fmt, payload) == ("kafka", "value")
    assert options["startingOffsets"] == "latest" and options["maxOffsetsPerTrigger"] == "100000"
    fmt, options, payload = streams.source_options("kinesis", {"stream_name": "s"})
    assert (fmt, payload) == ("kinesis", "data") and options["region"] == "us-east-1"
    with pytest.raises(ValueError, match="unsupported"):
        streams.source_options("carrier-pigeon", {})


def test_ingest_inserts_once_and_keeps_dead_letters(spark, feed, tmp_path, rows):
    feed(event("a"), event("a", 1), event("b"), event("n", name="page: viewed"), "{oops", event(None), event("c", company=None))
    run(spark, feed, tmp_path, str(tmp_path / "ledger"))
    feed(event("a", 2), event("d", 3))
    run(spark, feed, tmp_path, str(tmp_path / "ledger"))
    run(spark, feed, tmp_path, str(tmp_path / "ledger"))  # nothing new
    table = spark.read.parquet(str(tmp_path / "out"))
    assert rows(table, "event_id", "event_timestamp") == [
        ("a", T0), ("b", T0), ("d", T0 + dt.timedelta(minutes=3))
    ]
    dead = spark.read.parquet(str(tmp_path / "out_dlq"))
    assert sorted(r["dlq_reason"] for r in dead.collect()) == [
        "missing: company_id",
        "missing: event_id",
        "missing: event_id,company_id,event_timestamp",
    ]
    assert "{oops" in {r["raw_json"] for r in dead.collect()}
    assert rows(spark.read.parquet(str(tmp_path / "ledger")), "received", "written", F.col("batch_id").cast("int")) == [
        (2, 1, 1), (3, 2, 0)
    ]


def test_a_copy_after_midnight_is_no_other_event(spark, feed, tmp_path, rows):
    midnight = 14 * 60  # minutes after T0
    feed(event("a", midnight - 1), event("b", midnight - 1), event("b", midnight + 1))
    run(spark, feed, tmp_path, str(tmp_path / "ledger"))
    feed(event("a", midnight + 1), event("c", midnight + 2))
    run(spark, feed, tmp_path, str(tmp_path / "ledger"))
    table = spark.read.parquet(str(tmp_path / "out"))
    assert rows(table, "event_id", F.col("event_date").cast("string")) == [
        ("a", "2024-01-01"), ("b", "2024-01-01"), ("c", "2024-01-02")
    ]
    assert rows(spark.read.parquet(str(tmp_path / "ledger")), "received", "written") == [(2, 1), (3, 2)]


def test_replayed_batch_replaces_itself(spark, tmp_path, rows):
    batch = spark.createDataFrame(
        [("a", T0, "2024-01-01"), ("a", T0, "2024-01-01"), ("b", T0, "2024-01-01")],
        "event_id string, event_timestamp timestamp, event_date string",
    )
    write = ingest.insert_once(str(tmp_path / "t"))
    write(batch, 0)
    write(batch, 0)
    write(batch.withColumn("event_id", F.lit("b")), 1)
    write(batch.limit(0), 2)
    assert rows(spark.read.parquet(str(tmp_path / "t")), "event_id", F.col("batch_id").cast("int")) == [("a", 0), ("b", 0)]


def test_insert_once_with_the_day_in_the_key(spark, tmp_path, rows):
    batch = spark.createDataFrame(
        [("a", T0, "2024-01-01"), ("b", T0, "2024-01-02")],
        "event_id string, event_timestamp timestamp, event_date string",
    )
    write = ingest.insert_once(str(tmp_path / "t"), keys=("event_id", "event_date"))
    write(batch, 0)
    write(batch.union(batch.withColumn("event_date", F.lit("2024-01-03"))), 1)
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert rows(stored, "event_id", F.col("event_date").cast("string"), F.col("batch_id").cast("int")) == [
        ("a", "2024-01-01", 0), ("a", "2024-01-03", 1), ("b", "2024-01-02", 0), ("b", "2024-01-03", 1)
    ]


def test_compacted_days_take_further_batches(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    batch = lambda *ids: spark.createDataFrame(
        [(i, T0, "2024-01-01") for i in ids], "event_id string, event_timestamp timestamp, event_date string"
    )
    write = ingest.insert_once(path)
    for n, ids in enumerate((("a",), ("b", "a"), ("c",))):
        write(batch(*ids), n)
    for _ in range(2):
        assert ingest.compact_batches(spark, path, ["2024-01-01"]) == 3
    write(batch("c"), 2)  # a replay of a batch that was joined
    write(batch("c", "d"), 3)
    stored = spark.read.parquet(path)
    assert rows(stored, "event_id", F.col("batch_id").cast("int")) == [("a", -1), ("b", -1), ("c", -1), ("d", 3)]
    assert ingest.compact_batches(spark, path, ["2024-01-01"]) == 4


def test_the_anti_join_reads_only_the_days_of_the_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "event_id string, event_timestamp timestamp, event_date string"
    write = ingest.insert_once(path)
    write(spark.createDataFrame([("a", T0, "2024-01-01"), ("b", T0, "2024-01-02")], schema), 0)
    plans = []
    real = ingest.write_partitions
    ingest.write_partitions = lambda df, *a: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df, *a)
    try:
        write(spark.createDataFrame([("a", T0, "2024-01-02")], schema), 1)
    finally:
        ingest.write_partitions = real
    assert "PartitionFilters" in plans[0] and "event_date" in plans[0].split("PartitionFilters")[1][:200]


def drain(spark, df, tmp_path, name):
    out = str(tmp_path / name)
    sink = streams.stream_sink(df, out, str(tmp_path / f"ckpt-{name}"), trigger={"availableNow": True})
    sink.start().awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


def valid(spark, feed):
    source = streams.stream_source(spark, "files", {"path": feed.path})
    return ingest.split_valid(ingest.parse_events(source))[0]


def test_late_rows_are_dropped(spark, feed, tmp_path):
    kept = lambda: SW.drop_late_duplicates(valid(spark, feed), ["event_id"], "event_timestamp")
    feed(event("a"), event("a"), event("b", 60))
    drain(spark, kept(), tmp_path, "kept")
    feed(event("late", 10), event("near", 56), event("b", 61))
    got = drain(spark, kept(), tmp_path, "kept")
    assert sorted(r["event_id"] for r in got.collect()) == ["a", "b", "near"]


def test_windows_and_sessions(spark, feed, tmp_path, rows):
    feed(*[event(str(m), m) for m in (0, 10, 50, 70, 200)])
    hourly = drain(spark, SW.tumbling_counts(valid(spark, feed), "event_timestamp", ["event"]), tmp_path, "w")
    assert rows(hourly, "window_start", "n") == [(T0, 3), (T0 + dt.timedelta(hours=1), 1)]
    found = drain(spark, SW.sessionize(valid(spark, feed), "company_id", "event_timestamp"), tmp_path, "s")
    assert rows(found, "events", "duration_s") == [(2, 1200.0), (2, 600.0)]


def test_stream_join_emits_matched_and_unmatched(spark, feed, tmp_path, rows):
    feed(event("s1"), event("c1", 59, name="done"), event("s2", 100), event("c2", 160, name="done"),
         event("s3", 500), event("c3", 500, name="done"))
    v = valid(spark, feed)
    starts = v.filter("event LIKE 'workflow%'").select("event_id", "company_id", F.col("event_timestamp").alias("s"))
    ends = valid(spark, feed).filter("event = 'done'").select("company_id", F.col("event_timestamp").alias("c"))
    pairs = drain(spark, SW.matched_within(starts, ends, "company_id", "s", "c"), tmp_path, "j")
    got = {r["event_id"]: r["c"] for r in pairs.collect()}
    assert got["s1"] == T0 + dt.timedelta(minutes=59) and got["s2"] is None
    assert got["s3"] == T0 + dt.timedelta(minutes=500)


def test_episodes_are_detected_as_events_arrive(spark, feed, tmp_path, rows):
    """Out of order within the lateness, over several batches: the last word on each episode is the batch's."""
    arrivals = [
        [("1", 0), ("1", 3), ("2", 1)], [("1", 2), ("1", 3), ("2", 90)], [("1", 200), ("2", 88), ("3", 150)], [("1", 400), ("9", 1)],
    ]
    sunk = str(tmp_path / "sunk")
    for n, batch in enumerate(arrivals):
        feed(*[event(f"{n}-{k}", minutes, company) for k, (company, minutes) in enumerate(batch)])
        starts = ingest.split_valid(ingest.parse_events(streams.stream_source(spark, "files", {"path": feed.path})))[0]
        found = SE.detect_episodes(starts.select("company_id", "event_timestamp"), ["company_id"], "event_timestamp")
        streams.stream_sink(found, sunk, str(tmp_path / "ep"), trigger={"availableNow": True}).start().awaitTermination()
    emitted = spark.read.schema(found.schema).parquet(sunk)
    at = lambda m: T0 + dt.timedelta(minutes=m)
    # The watermark stands at minute 395; ("9", 1) came far behind it.
    assert rows(SE.latest_episodes(emitted, ["company_id"])) == [
        ("1", at(0), 1, at(2)), ("1", at(2), 2, at(3)), ("1", at(3), 3, at(200)), ("1", at(200), 4, at(260)),
        ("2", at(1), 1, at(88)), ("2", at(88), 2, at(90)), ("2", at(90), 3, at(150)), ("3", at(150), 1, at(210)),
    ]
    assert emitted.filter("NOT closed").count() == 8


def test_keys_of_episodes_share_rows_of_state(spark, feed, tmp_path, rows):
    feed(*[event(f"{c}-{m}", m, str(c)) for c in range(40) for m in (0, 10)], event("late", 500, "40"))
    starts = ingest.split_valid(ingest.parse_events(streams.stream_source(spark, "files", {"path": feed.path})))[0]
    found = SE.detect_episodes(starts.select("company_id", "event_timestamp"), ["company_id"], "event_timestamp", buckets=4)
    q = streams.stream_sink(found, str(tmp_path / "sunk"), str(tmp_path / "ep"), trigger={"availableNow": True}).start()
    q.awaitTermination()
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress) <= 4
    got = SE.latest_episodes(spark.read.schema(found.schema).parquet(str(tmp_path / "sunk")), ["company_id"])
    assert rows(got, "company_id", "initiation_rank") == sorted((str(c), n) for c in range(40) for n in (1, 2))


def test_progress_is_recorded(spark, feed, tmp_path):
    path = str(tmp_path / "progress")
    listener = progress.ProgressLedger(spark, path, every=1)
    spark.streams.addListener(listener)
    try:
        for lines in ([event("a", 60), event("b", 61)], [event("c", 1), event("d", 62), event("d", 62)]):
            feed(*lines)
            valid = ingest.split_valid(ingest.parse_events(streams.stream_source(spark, "files", {"path": feed.path})))[0]
            kept = SW.drop_late_duplicates(valid.select("event_id", "event_timestamp"), ["event_id"], "event_timestamp")
            q = streams.stream_sink(kept, str(tmp_path / "kept"), str(tmp_path / "ck"), trigger={"availableNow": True}).start()
            q.awaitTermination()
            listener.wait([q])
    finally:
        spark.streams.removeListener(listener)
    reports = spark.read.parquet(path)
    total = reports.agg(F.sum("input_rows"), F.sum("late_rows"), F.countDistinct("run"), F.max("watermark")).first()
    assert tuple(total) == (5, 1, 2, "2024-01-01T10:57:00.000Z")
