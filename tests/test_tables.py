import datetime as dt

import pytest
from pyspark.sql import functions as F

from keepsake import ledger as L
from keepsake.operators import layout, upsert, versions
from keepsake.sources import staging
from keepsake.session import DEFAULTS
from keepsake.sources import tables as io


@pytest.fixture(params=["own session", "bare session"])
def spark(request, spark):
    """The library's session, and one with Spark's defaults, as in a foreign notebook."""
    if request.param == "own session":
        return spark
    bare = spark.newSession()
    for name in DEFAULTS:
        bare.conf.unset(name)
    assert bare.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled") == "true"
    return bare


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "t")


@pytest.fixture
def base(spark):
    return spark.createDataFrame(
        [(1, "a", "01"), (2, "b", "01"), (3, "c", "02")], "id int, v string, part string"
    )


def read(spark, path):
    return spark.read.schema("id int, v string, part string").parquet(path)


def test_partition_overwrite_leaves_others(spark, path, base, rows):
    assert io.write_partitions(base, path, ["part"]) == 3
    assert io.write_partitions(base.filter("id = 1").withColumn("v", F.lit("z")), path, ["part"]) == 1
    assert rows(read(spark, path)) == [(1, "z", "01"), (3, "c", "02")]
    assert io.replace_table(base.filter("id = 2"), path, ["part"]) == 1
    assert rows(read(spark, path)) == [(2, "b", "01")]


def test_empty_write_counts_zero(spark, path, base):
    io.write_partitions(base, path, ["part"])
    assert io.write_partitions(base.filter("id > 9"), path, ["part"]) == 0
    assert read(spark, path).count() == 3


def test_scan_and_load(spark, path, base):
    io.write_partitions(base, path, ["part"])
    got = io.scan(spark, path, "part", "02", "02", columns=["id"], schema=base.schema)
    assert [r["id"] for r in got.collect()] == [3]
    assert "PartitionFilters: [isnotnull(part" in got._jdf.queryExecution().executedPlan().toString()
    base.createOrReplaceTempView("named")
    assert io.load(spark, table="named").count() == io.load(spark, path).count() == 3
    with pytest.raises(ValueError):
        io.load(spark)
    with pytest.raises(ValueError):
        io.read_version(spark, path, version=1, fmt="parquet")
    assert io.table_exists(spark, path) and not io.table_exists(spark, path + "-none")


def test_month_slices_and_backfill(spark, path, base):
    assert io.month_slices("2024-01-15", "2024-03-02") == [
        ("2024-01-15", "2024-01-31"), ("2024-02-01", "2024-02-29"), ("2024-03-01", "2024-03-02")
    ]
    assert io.month_slices("2024-02-02", "2024-02-01") == []
    step = lambda a, b: base.withColumn("part", F.lit(a[5:7]))
    for _ in range(2):
        counts = io.backfill(step, "2024-01-10", "2024-02-10", path, ["part"])
    assert list(counts.values()) == [3, 3] and read(spark, path).count() == 6


@pytest.mark.parametrize("date_col", [None, "day"])
def test_a_clipped_slice_keeps_the_rest_of_its_partitions(spark, path, date_col):
    days = spark.sql("SELECT explode(sequence(DATE '2024-01-01', DATE '2024-02-29')) AS day")
    days = days.withColumn("month", F.date_format("day", "yyyy-MM"))
    step = lambda a, b: days.filter(F.col("day").between(F.lit(a).cast("date"), F.lit(b).cast("date")))
    io.backfill(step, "2024-01-01", "2024-02-29", path, ["month"], date_col=date_col)
    for _ in range(2):
        io.backfill(step, "2024-01-10", "2024-02-05", path, ["month"], date_col=date_col)
    stored = spark.read.schema(days.schema).parquet(path)
    assert stored.count() == stored.distinct().count() == 60


def test_leftovers_of_an_aborted_write_are_no_table(spark, path, base):
    location = spark._jvm.org.apache.hadoop.fs.Path(path + "/_temporary/0")
    location.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(location)
    assert not io.table_exists(spark, path)
    upsert.merge_upsert(spark, path, base, ["id"], ["part"])
    assert io.table_exists(spark, path) and io.partition_columns(spark, path) == ["part"]


def test_merge_refuses_null_keys(spark, path, base):
    with pytest.raises(ValueError, match="lacks a key"):
        upsert.merge_upsert(spark, path, base.withColumn("id", F.lit(None).cast("int")), ["id"], ["part"])


def test_merge(spark, path, base, rows):
    new = spark.createDataFrame([(2, "B", "01"), (9, "n", "02")], base.schema)
    upsert.merge_upsert(spark, path, base, ["id"], ["part"])  # creates the table
    for _ in range(2):
        upsert.merge_upsert(spark, path, new, ["id"], ["part"])
    assert rows(read(spark, path)) == [(1, "a", "01"), (2, "B", "01"), (3, "c", "02"), (9, "n", "02")]
    upsert.merge_upsert(spark, path, new.withColumn("v", F.lit("k")), ["id"], ["part"], insert_only=True)
    assert rows(read(spark, path))[1] == (2, "B", "01")
    upsert.merge_upsert(spark, path, new.withColumn("v", F.lit("k")), ["id"], ["part"], update_cols=[])
    assert rows(read(spark, path))[1] == (2, "B", "01")


def test_merge_refuses_ambiguity(spark, path, base):
    upsert.merge_upsert(spark, path, base, ["id"], ["part"])
    with pytest.raises(ValueError, match="share one key"):
        upsert.merge_upsert(spark, path, base.union(base), ["id"], ["part"])
    with pytest.raises(ValueError, match="another partition"):
        upsert.merge_upsert(spark, path, base.withColumn("part", F.lit("09")), ["id"], ["part"])


def test_merge_reads_only_touched_partitions(spark, path, base, rows):
    io.write_partitions(base, path, ["part"])
    found = upsert.in_partitions_of(io.scan(spark, path, schema=base.schema), base.filter("id = 3"), ["part"])
    assert rows(found) == [(3, "c", "02")]
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((part" in text and "= 02)" in text


@pytest.mark.parametrize("kept", [True, False])
def test_partition_values_stay_as_written(spark, path, rows, kept):
    """Merge with the partition in the key and compaction, on folders that look like numbers."""
    df = spark.createDataFrame(
        [(n % 5, f"{n // 5:02d}", float(n)) for n in range(30)], "id int, part string, v double"
    )
    if kept:
        io.write_partitions(df.repartition(6), path, ["part"])
    else:
        df.repartition(6).write.partitionBy("part").parquet(path)
    new = spark.createDataFrame([(3, "01", -1.0)], df.schema)
    assert upsert.merge_upsert(spark, path, new, ["id", "part"], ["part"]) == 5
    want = sorted((n % 5, f"{n // 5:02d}", -1.0 if n == 8 else float(n)) for n in range(30))
    assert rows(io.read_table(spark, path), "id", "part", "v") == want
    df.withColumn("id", F.col("id") + 10).write.mode("append").partitionBy("part").parquet(path)
    assert layout.compact(spark, path, ["part"]) == 60
    assert io.read_table(spark, path).count() == 60
    location, files = io._location(spark, path)
    folders = {f.getPath().getName() for f in files.listStatus(location) if f.isDirectory()}
    assert folders == {f"part={n:02d}" for n in range(6)}
    assert layout.compact(spark, path, ["part"]) == 0


def test_partition_types_must_agree(spark, path, base):
    io.write_partitions(base, path, ["part"])
    numbered = base.withColumn("part", F.col("part").cast("int"))
    for write in (
        lambda: io.write_partitions(numbered, path, ["part"]),
        lambda: upsert.merge_upsert(spark, path, numbered, ["id"], ["part"]),
    ):
        with pytest.raises(ValueError, match="is string, not int"):
            write()
    assert io.read_table(spark, path).schema["part"].dataType.simpleString() == "string"
    io.replace_table(numbered, path, ["part"])
    assert io.read_table(spark, path).schema["part"].dataType.simpleString() == "int"


def test_a_kept_schema_grows_by_new_fields(spark, path, base, rows):
    io.write_partitions(base, path, ["part"])
    io.write_partitions(base.filter("id = 3").withColumn("more", F.lit(7)), path, ["part"])
    assert rows(io.read_table(spark, path), "id", "more", "part") == [(1, None, "01"), (2, None, "01"), (3, 7, "02")]
    assert io.kept_schema(spark, path).fieldNames() == ["id", "v", "part", "more"]


def test_incremental_window(spark):
    df = spark.sql("SELECT explode(sequence(DATE '2024-01-01', DATE '2024-01-31')) AS d")
    assert upsert.incremental_window(df, "d", "2024-01-31").count() == 8
    assert upsert.incremental_window(df, "d", "2024-01-31", "2024-01-01", "2024-01-03").count() == 3


def test_compact_and_zorder(spark, path, same):
    df = spark.range(4000).selectExpr(
        "id", "id * 7919 % 4000 AS a", "id * 104729 % 4000 AS b", "CAST(id % 2 AS STRING) AS part"
    )
    df.repartition(16).write.partitionBy("part").parquet(path)
    files = lambda: len(spark.read.parquet(path).inputFiles())
    before = files()
    assert layout.compact(spark, path, ["part"], F.col("part") == "0") == 2000
    assert files() < before
    assert layout.compact(spark, path, ["part"], F.col("part") == "0") == 0  # compact already
    with pytest.raises(ValueError, match="partitioned by"):
        layout.compact(spark, path, ["part", "other"])
    read_back = spark.read.schema("id long, a long, b long, part string").parquet(path)
    same(df, read_back)

    clustered = path + "-z"
    layout.zorder(df, ["a", "b", "part"], files=16).write.parquet(clustered)
    back = spark.read.parquet(clustered)
    same(df, back)
    spans = back.groupBy(F.input_file_name()).agg(*[f(c).alias(f"{n}_{c}") for c in "ab" for n, f in (("lo", F.min), ("hi", F.max))])
    for c in "ab":
        assert spans.filter(f"lo_{c} <= 1234 AND hi_{c} >= 1234").count() < spans.count()


def test_snapshots(spark, rows):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 3, "c"), (2, 3, "x")], "k int, ver int, v string")
    assert rows(versions.as_of_snapshot(df, ["k"], "ver", 2)) == [(1, 2, "b")]


def test_evolution(spark, rows):
    old = spark.createDataFrame([(1, "a")], "id int, v string")
    new = spark.createDataFrame([(2, 5)], "id int, n int")
    assert rows(versions.append_evolved(old, new, {"n": 0})) == [(1, "a", 0), (2, None, 5)]


def test_generations_of_files_under_one_schema(spark, path, rows):
    first = spark.sql("SELECT 1 AS id, DATE '2024-01-01' AS at, CAST(1.5 AS FLOAT) AS v")
    second = spark.sql("SELECT 5000000000 AS id, TIMESTAMP_NTZ '2024-01-02 03:04:05' AS at, 'x' AS more")
    for df in (first, second, first.withColumn("v", F.lit(2.5))):
        io.append_merged(df, path)
    assert rows(io.read_table(spark, path).select("id", "at", "v", "more")) == [
        (1, dt.datetime(2024, 1, 1), 1.5, None), (1, dt.datetime(2024, 1, 1), 2.5, None),
        (5_000_000_000, dt.datetime(2024, 1, 2, 3, 4, 5), None, "x"),
    ]
    with pytest.raises(ValueError, match="id is bigint in old files and string in new ones"):
        io.append_merged(first.withColumn("id", F.lit("a")), path)
    assert io.read_table(spark, path).count() == 3


def test_scd2_steps_equal_full_history(spark, rows):
    day = lambda n: dt.date(2024, 1, n)
    shots = [
        (1, "US", day(1)), (1, "US", day(2)), (1, "FR", day(3)), (1, "US", day(5)),
        (2, None, day(2)), (2, None, day(3)), (2, "US", day(5)),
    ]
    df = spark.createDataFrame(shots, "id int, country string, on date")
    full = versions.scd2(df, ["id"], ["country"], "on")
    assert rows(full, "id", "country", "valid_from", "valid_to", "is_current")[0] == (
        1, "FR", day(3), day(5), False
    )
    history = versions.scd2(df.filter("on = DATE '2024-01-01'"), ["id"], ["country"], "on")
    for n in (2, 3, 5):
        shot = df.filter(F.col("on") == F.lit(day(n))).drop("on")
        history = versions.scd2_apply(history, shot, ["id"], ["country"], day(n))
    assert rows(history) == rows(full.select(*history.columns))


def test_ledger(spark, path):
    for i, seconds in enumerate((100.0, 2000.0)):
        L.record_run(spark, path, "step1_cancel_initiations", "t", 5, dt.datetime(2024, 1, 1 + i), seconds)
    runs = spark.read.parquet(path)
    assert L.recent_runs(runs, 1).first()["seconds"] == 2000.0
    slow = L.slow_steps(runs, L.STEP_BASELINES).collect()
    assert len(slow) == 1 and slow[0]["baseline_seconds"] == 587.0
    assert L.slow_steps(runs).isEmpty()  # too short a history
    for i, (seconds, status) in enumerate([(120.0, "ok"), (9000.0, "failed"), (110.0, "ok"), (290.0, "ok"), (100.0, "ok")]):
        L.record_run(spark, path, "step1_cancel_initiations", "t", 5, dt.datetime(2024, 2, 1 + i), seconds, status)
    # The median of 100, 2000, 120 and 110; the failed run is no measure.
    slow = L.slow_steps(spark.read.parquet(path)).orderBy("started").collect()
    assert [(r["seconds"], r["baseline_seconds"]) for r in slow] == [(290.0, 115.0)]


def test_staging_uses_the_folder_of_the_session(spark, tmp_path, base, same, monkeypatch):
    monkeypatch.setattr(staging, "CHECKPOINT_CONF", "spark.keepsake.test.folder")
    assert staging.shared_dir(spark) == staging.shared_dir(spark)
    assert staging.shared_dir(spark).startswith("/tmp/run-")
    spark.conf.set("spark.keepsake.test.folder", str(tmp_path / "shared"))
    same(base, staging.stage(base, "x"))
    assert any((tmp_path / "shared").iterdir())
    spark.conf.unset("spark.keepsake.test.folder")


def test_lookups_counted_per_file(spark, path, rows):
    df = spark.range(2000).selectExpr("id * 7919 % 500 AS k", "id * 104729 % 2000 AS n", "id AS v")
    layout.write_for_lookups(df, path, ["k", "n"], files=8)
    got = layout.lookup_pruning(spark, path, "k").first()
    ranges = layout.file_ranges(spark, path, "k").collect()
    touched = [[r for r in ranges if r["least"] <= k <= r["greatest"]] for k in range(500)]
    counts = [len(t) for t in touched]
    assert (got["lookups"], got["files"], got["rows"]) == (500, len(ranges), 2000)
    assert got["files_read"] == pytest.approx(sum(counts) / 500) and got["most_files"] == max(counts) and got["least_files"] == min(counts)
    assert got["bytes_read"] == pytest.approx(sum(r["bytes"] for t in touched for r in t) / 500)
    assert got["files_read"] < 0.7 * got["files"] and spark.read.parquet(path).count() == 2000


def test_zorder_sees_whole_texts(spark, path):
    df = spark.range(4000).selectExpr("concat('CancelFlow-', lpad(id * 7919 % 4000, 6, '0')) AS t", "id * 104729 % 4000 AS n")
    layout.zorder(df, ["t", "n"], files=16).write.parquet(path)
    back = spark.read.parquet(path)
    spans = back.groupBy(F.input_file_name()).agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
    touched = spans.filter(F.lit("CancelFlow-002000").between(F.col("lo"), F.col("hi"))).count()
    assert spans.count() >= 12 and touched <= 6
    cuts = layout.cut_points(df, "n", 8)
    assert len(cuts) == 7 and abs(cuts[3] - 2000) < 200
