"""Cancellation episodes as their events arrive: rank and observation window with state and timers."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

# Executors need not have this package: what runs there travels by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE = "rank array<int>, last_us array<long>, pending array<array<long>>"


def detect_episodes(
    starts: DataFrame,
    keys: Sequence[str],
    ts: str,
    default_seconds: int = 3600,
    lateness: str = "5 minutes",
    forget_days: int = 400,
    buckets: int = 4096,
) -> DataFrame:
    """(keys, initiation_timestamp, initiation_rank, window_end_timestamp, closed) from a stream of initiations.

    Starts of a key are held until the watermark has passed them, so that ranks follow event time whatever the order of
    arrival; copies of one time are one start. A start is then emitted with the default end of its window, and again,
    ``closed``, when the next one ends it earlier or later: ``latest_episodes`` keeps the last word, which is what the
    batch plan says of the same events. State holds each key, with the starts of the lateness; a key that has
    been quiet for ``forget_days`` is forgotten, and its ranks start anew. Take the SKU into the keys, as the batch plan
    does, and a busy company is spread over its lanes.

    Keys are dealt over ``buckets`` by hash, and a bucket is one row of state: a call of Python costs far more than a key
    does. Take as many that a bucket holds some hundred keys; their number cannot change under a checkpoint.
    """
    names = [f"key_{i}" for i in range(len(keys))]
    texts = StructType([StructField(n, StringType()) for n in names])
    made = StructType.fromDDL("start_us long, initiation_rank int, end_us long, closed boolean")
    out = StructType([*texts.fields, *made.fields])
    held = StructType([*[StructField(n, ArrayType(StringType())) for n in names], *StructType.fromDDL(STATE).fields])
    columns = out.fieldNames()
    default_us, forget_ms = default_seconds * 1_000_000, forget_days * 86_400_000

    def advance(_: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known: dict[tuple, tuple] = {}
        if state.exists:
            *stored, ranks, lasts, pendings = state.get
            known = dict(zip(zip(*stored), zip(ranks, lasts, pendings)))
        passed = state.getCurrentWatermarkMs()
        fresh: dict[tuple, set[int]] = {}
        for part in parts:
            for *key, us in zip(*[part[c].tolist() for c in (*names, "start_us")]):
                fresh.setdefault(tuple(key), set()).add(us)
        rows, kept, wakes = [], [], []
        for key in {**known, **fresh}:
            rank, last, pending = known.get(key, (0, None, ()))
            arrived, emitted = fresh.get(key, ()), len(rows)
            waiting = sorted({*pending, *(us for us in arrived if last is None or us > last)})
            due = 0
            for start in waiting:
                if start // 1000 > passed:
                    break
                if last is not None:
                    rows.append((*key, last, rank, start, True))
                rank, last, due = rank + 1, start, due + 1
                rows.append((*key, start, rank, start + default_us, False))
            waiting = waiting[due:]
            wake = waiting[0] // 1000 if waiting else last // 1000 + forget_ms
            if waiting or arrived or len(rows) > emitted or wake >= passed:
                kept.append((*key, rank, last, waiting))
                wakes.append(wake)
        if kept:
            state.update(tuple(map(list, zip(*kept))))
            state.setTimeoutTimestamp(max(min(wakes), passed + 1))
        else:
            state.remove()
        if rows:
            yield pd.DataFrame(rows, columns=columns)

    timed = starts.withWatermark(ts, lateness).select(
        ts,
        F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket"),
        *[F.col(k).cast("string").alias(n) for k, n in zip(keys, names)],
        F.unix_micros(F.col(ts).cast("timestamp")).alias("start_us"),
    )
    found = timed.groupBy("bucket").applyInPandasWithState(
        advance, out, held, "append", GroupStateTimeout.EventTimeTimeout
    )
    typed = [F.col(n).cast(starts.schema[k].dataType).alias(k) for k, n in zip(keys, names)]
    return found.select(
        *typed,
        F.timestamp_micros("start_us").alias("initiation_timestamp"),
        "initiation_rank",
        F.timestamp_micros("end_us").alias("window_end_timestamp"),
        "closed",
    )


def latest_episodes(emitted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for each episode from all that were emitted: the closed one where there is one."""
    rest = F.struct("closed", "initiation_rank", "window_end_timestamp")
    return (
        emitted.groupBy(*keys, "initiation_timestamp")
        .agg(F.max(rest).alias("e"))
        .select(*keys, "initiation_timestamp", "e.initiation_rank", "e.window_end_timestamp")
    )
