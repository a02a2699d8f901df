"""What streaming queries report about themselves, kept as a table: rates, watermark, state and late rows."""

from __future__ import annotations

import threading

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS_SCHEMA = (
    "query string, run string, batch_id bigint, at string, input_rows bigint, input_rows_per_second double, "
    "processed_rows_per_second double, watermark string, state_rows bigint, late_rows bigint, milliseconds bigint"
)


def progress_row(progress) -> tuple:
    """One report as a row; rows that came behind the watermark are summed over the stateful operators."""
    return (
        progress.name,
        str(progress.runId),
        progress.batchId,
        progress.timestamp,
        progress.numInputRows,
        float(progress.inputRowsPerSecond),
        float(progress.processedRowsPerSecond),
        (progress.eventTime or {}).get("watermark"),
        sum(s.numRowsTotal for s in progress.stateOperators),
        sum(s.numRowsDroppedByWatermark for s in progress.stateOperators),
        progress.batchDuration,
    )


class ProgressLedger(StreamingQueryListener):
    """Appends the reports of all queries of the session to a table, some at a time.

    Add it with ``spark.streams.addListener``. Reports are written when ``every`` of them have come and when a
    query ends; ``wait`` returns once all of ``queries`` have ended and are recorded.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 50):
        self.spark, self.path, self.every = spark, path, every
        self.held: list[tuple] = []
        self.ended: set[str] = set()
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.held.append(progress_row(event.progress))
        if len(self.held) >= self.every:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def flush(self) -> None:
        rows, self.held = self.held, []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS_SCHEMA).write.mode("append").parquet(self.path)

    def wait(self, queries, seconds: float = 60) -> None:
        runs = {str(q.runId) for q in queries}
        with self.changed:
            if not self.changed.wait_for(lambda: runs <= self.ended, seconds):
                raise TimeoutError("reports of the queries did not come")
