"""The daily run: every step writes its partitioned table, is counted, compared and recorded."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..ledger import record_run
from ..schemas import TABLE_PARTITIONS
from ..sources.tables import write_partitions


@dataclass(frozen=True)
class Step:
    """``build`` makes the table's rows; ``same_rows_as`` names a step that must have as many."""

    name: str
    table: str
    build: Callable[[], DataFrame]
    partition_cols: tuple[str, ...] = TABLE_PARTITIONS
    same_rows_as: str | None = None


def run_steps(spark: SparkSession, steps: Sequence[Step], root: str, ledger: str) -> dict[str, int]:
    """Write ``root/<table>`` step by step; returns the rows of each step.

    Only partitions that occur are overwritten, so a step can be run again. Every run is recorded, a
    failed one too, with the rows it wrote; a step whose count differs from the step it must agree
    with stops the run.
    """
    written: dict[str, int] = {}
    for step in steps:
        started, began = dt.datetime.now(), time.perf_counter()
        rows, status = 0, "failed"
        try:
            rows = write_partitions(step.build(), f"{root}/{step.table}", step.partition_cols)
            expected = written.get(step.same_rows_as, rows) if step.same_rows_as else rows
            if rows != expected:
                raise AssertionError(f"{step.name} wrote {rows} rows, {step.same_rows_as} {expected}")
            status = "ok"
        finally:
            seconds = time.perf_counter() - began
            record_run(spark, ledger, step.name, step.table, rows, started, seconds, status)
        written[step.name] = rows
    return written
