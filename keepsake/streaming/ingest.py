"""Clickstream ingest: parse, validate, route dead letters, insert each event once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructType

from ..functions import taxonomy as X
from ..operators.joins import one_per_key
from ..operators.upsert import in_partitions_of
from ..schemas import EVENT_SCHEMA, REQUIRED_EVENT_FIELDS
from ..sources.streams import stream_sink, stream_source
from ..sources.tables import read_table, rewrite_partitions, table_exists, write_partitions


COMPACTED = -1  # the batch that holds the joined rows of compacted days


def parse_events(stream: DataFrame, schema: StructType = EVENT_SCHEMA) -> DataFrame:
    """JSON text to typed fields; the text stays, so that nothing is lost when it is malformed."""
    return stream.select("raw_json", F.from_json("raw_json", schema).alias("evt")).select(
        "raw_json", "evt.*"
    )


def missing_fields(required: Sequence[str] = REQUIRED_EVENT_FIELDS):
    """Names of the required fields that are NULL, joined by commas; empty when all are there."""
    return F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in required])


def split_valid(
    parsed: DataFrame, required: Sequence[str] = REQUIRED_EVENT_FIELDS
) -> tuple[DataFrame, DataFrame]:
    """Valid events, and dead letters with the reason and the time of receipt."""
    judged = parsed.withColumn("__missing", missing_fields(required))
    valid = judged.filter("__missing = ''").drop("__missing", "raw_json")
    dead = (
        judged.filter("__missing <> ''")
        .withColumn("dlq_reason", F.concat(F.lit("missing: "), F.col("__missing")))
        .withColumn("received_at", F.current_timestamp())
        .withColumn("received_date", F.date_format("received_at", "yyyy-MM-dd"))
        .drop("__missing")
    )
    return valid, dead


def flow_events(valid: DataFrame, lateness: str = "5 minutes") -> DataFrame:
    """Cancel-flow events with watermark and derived day."""
    return (
        valid.withWatermark("event_timestamp", lateness)
        .withColumn("event_date", F.date_format("event_timestamp", "yyyy-MM-dd"))
        .withColumn("processed_timestamp", F.current_timestamp())
        .filter(X.is_stream_event())
    )


def insert_once(
    path: str,
    keys: Sequence[str] = ("event_id", "event_date"),
    partition_cols: Sequence[str] = ("event_date",),
    order: Sequence[str] = ("event_timestamp",),
    ledger: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer: insert-only merge by ``keys``, exact under replays.

    Copies inside the batch are combined map-side; rows already in the table are left out by an
    anti join. Every batch owns its files (a ``batch_id`` partition below the others), so a replay
    after a failure overwrites its own rows only, and no earlier file is ever rewritten. The day is
    among the keys, so the anti join reads only the days of the batch; a copy that carries another
    day is then another event. Without the day in ``keys`` the anti join reads the keys of all stored days.
    ``compact_batches`` joins the batches of old days.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        received = Observation()
        counted = batch.observe(received, F.count(F.lit(1)).alias("rows"))
        fresh = one_per_key(counted, list(keys), list(order))
        if table_exists(spark, path):
            stored = spark.read.schema(_stored_schema(batch)).parquet(path).filter(F.col("batch_id") != batch_id)
            known = stored.select(
                *[F.col(c).cast(batch.schema[c].dataType).alias(c) for c in keys]
            )
            shared = [c for c in partition_cols if c in keys]
            if shared:
                known = in_partitions_of(known, batch, shared)
            fresh = fresh.join(known, list(keys), "left_anti")
        written = write_partitions(
            fresh.withColumn("batch_id", F.lit(batch_id).cast("long")), path, [*partition_cols, "batch_id"]
        )
        if ledger:
            row = [(int(received.get["rows"]), written, batch_id)]
            entry = spark.createDataFrame(row, "received bigint, written bigint, batch_id bigint")
            write_partitions(entry, ledger, ["batch_id"])

    return write


def _stored_schema(batch: DataFrame) -> StructType:
    """Fields as the batch has them, not as folder names suggest."""
    return StructType([f for f in batch.schema if f.name != "batch_id"]).add("batch_id", LongType())


def compact_batches(
    spark: SparkSession,
    path: str,
    days: Sequence[str],
    keys: Sequence[str] = ("event_id", "event_date"),
    order: Sequence[str] = ("event_timestamp",),
    day_col: str = "event_date",
) -> int:
    """Join all batches of some days into the reserved batch ``COMPACTED``; returns its rows.

    Run it for days that no batch is being written to. The joined rows replace the reserved batch first, then the
    batches they came from are removed. After a failure between the two some rows are stored twice; running
    it again takes one row per key and ends clean. Later batches and replays find the joined rows as
    they found the batches.
    """
    stored = read_table(spark, path).filter(F.col(day_col).cast("string").isin(*days))
    batches = sorted({r[0] for r in stored.select(F.col("batch_id").cast("long")).distinct().collect()})
    rows = one_per_key(stored.drop("batch_id"), list(keys), list(order))
    joined = rows.withColumn("batch_id", F.lit(COMPACTED).cast("long"))
    written = rewrite_partitions(joined, path, [day_col, "batch_id"])
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for day in days:
        for batch in batches:
            if batch != COMPACTED:
                files.delete(hadoop.Path(f"{path}/{day_col}={day}/batch_id={batch}"), True)
    return written


def start_ingest(
    spark: SparkSession,
    kind: str,
    cfg: dict,
    output: str,
    checkpoint: str,
    trigger: dict | None = None,
    ledger: str | None = None,
    keys: Sequence[str] = ("event_id",),
) -> tuple[StreamingQuery, StreamingQuery]:
    """Start the main query and the dead-letter query, each with its own checkpoint.

    An event is known by its id, as a copy sent again after midnight carries the next day. Where copies keep the time
    of their event, ``keys`` may add ``event_date``, which spares reading the ids of other days (``insert_once``).
    Await both with ``spark.streams.awaitAnyTermination()``: either one may fail.
    """
    trigger = trigger or {"processingTime": "30 seconds"}
    valid, dead = split_valid(parse_events(stream_source(spark, kind, cfg)))
    letters = stream_sink(
        dead, f"{output}_dlq", f"{checkpoint}/dlq", ("received_date",), trigger=trigger
    ).start()
    main = (
        flow_events(valid)
        .writeStream.foreachBatch(insert_once(output, keys, ledger=ledger))
        .option("checkpointLocation", f"{checkpoint}/main")
        .trigger(**trigger)
        .start()
    )
    return main, letters
