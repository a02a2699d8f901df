"""Ordered computations per key that stay parallel when one key holds a large part of the rows.

A plain window puts a whole key into one task. Here every key's timeline is cut into slots (an
hour by default). Windows run inside (key, slot), which is what the rows are shuffled by; one
summary row per (key, slot) is built with a map-side combine, carried across the slots of a key,
and joined back. Only the summary, at most one row per slot, ever meets in one task.

Slots must be monotone in the order: a later row never has a smaller slot. Keys must not be NULL
(give such rows a key of their own first): the carried values are joined back by plain equality, so
that the rows stay partitioned and sorted as the windows left them and are shuffled only once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOUR = 3600
DAY = 86400

SLOT = "__slot"


def time_slot(ts: str | Column, seconds: int = HOUR) -> Column:
    """Slot number of a timestamp."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_seconds(ts) / F.lit(seconds))


def _rejoin(rows: DataFrame, carried: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach the per-slot values to the rows.

    There may be nearly as many slots as rows, however small the planner takes them for: they are merged, never
    gathered in the driver for a broadcast.
    """
    return rows.join(carried.hint("merge"), [*keys, SLOT], "left")


def _end(column: str, order: Sequence[str], last: bool) -> Column:
    """Value of ``column`` in the first or last row; the order column itself needs no lookup."""
    if [column] == list(order):
        return F.max(column) if last else F.min(column)
    return (F.max_by if last else F.min_by)(F.col(column), F.struct(*order))


def along(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slot: Column | None = None,
    rank: str | None = None,
    running: dict[str, Column] | None = None,
    previous: dict[str, str] | None = None,
    following: dict[str, str] | None = None,
) -> DataFrame:
    """Row number, running sums, previous and next values per key, in one pass.

    ``order`` must be a total order within a key. ``rank`` names a 1-based position; ``running``
    maps new columns to expressions summed up to and including the row; ``previous`` and
    ``following`` map new columns to the column looked up one row back or ahead.
    """
    running, previous, following = running or {}, previous or {}, following or {}
    slot = time_slot(order[0]) if slot is None else slot
    rows = df.withColumn(SLOT, slot)
    inside = Window.partitionBy(*keys, SLOT).orderBy(*order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    position = F.row_number().over(inside)
    local = {"__a_pos": position}
    local |= {f"__a_sum_{n}": F.sum(e).over(so_far) for n, e in running.items()}
    local |= {f"__a_lag_{n}": F.lag(c).over(inside) for n, c in previous.items()}
    local |= {f"__a_lead_{n}": F.lead(c).over(inside) for n, c in following.items()}
    if following:
        local["__a_last"] = F.lead(F.lit(True)).over(inside).isNull()
    rows = rows.select("*", *[e.alias(n) for n, e in local.items()])

    summary = (
        df.withColumn(SLOT, slot)
        .groupBy(*keys, SLOT)
        .agg(
            F.count(F.lit(1)).alias("__a_n"),
            *[F.sum(e).alias(f"__a_n_{n}") for n, e in running.items()],
            *[_end(c, order, True).alias(f"__a_end_{n}") for n, c in previous.items()],
            *[_end(c, order, False).alias(f"__a_begin_{n}") for n, c in following.items()],
        )
    )
    across = Window.partitionBy(*keys).orderBy(SLOT)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(
        *keys,
        SLOT,
        F.coalesce(F.sum("__a_n").over(before), F.lit(0)).alias("__a_before"),
        *[F.sum(f"__a_n_{n}").over(before).alias(f"__a_before_{n}") for n in running],
        *[F.lag(f"__a_end_{n}").over(across).alias(f"__a_prev_{n}") for n in previous],
        *[F.lead(f"__a_begin_{n}").over(across).alias(f"__a_next_{n}") for n in following],
    )

    joined = _rejoin(rows, carried, keys)
    out = {}
    if rank:
        out[rank] = (F.col("__a_pos") + F.col("__a_before")).cast("int")
    for n in running:
        parts = [F.col(f"__a_sum_{n}"), F.col(f"__a_before_{n}")]
        total = sum(F.coalesce(p, F.lit(0)) for p in parts)
        out[n] = F.when(F.coalesce(*parts).isNotNull(), total)
    for n in previous:
        out[n] = F.when(F.col("__a_pos") == 1, F.col(f"__a_prev_{n}")).otherwise(F.col(f"__a_lag_{n}"))
    for n in following:
        out[n] = F.when(F.col("__a_last"), F.col(f"__a_next_{n}")).otherwise(F.col(f"__a_lead_{n}"))
    kept = [c for c in df.columns if c not in out]
    return joined.select(*kept, *[e.alias(n) for n, e in out.items()])


def next_times(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    targets: dict[str, Column],
    slot: Column | None = None,
) -> DataFrame:
    """For every row the time of the first row at or after it that meets each target condition.

    Forward as-of over a union of rows: linear in the rows, whatever the number of matches. The
    windows run backwards in time, because a frame that starts at the current row and ends at the
    last one is recomputed for every row.
    """
    slot = time_slot(ts) if slot is None else slot
    hits = {n: F.when(c, F.col(ts)) for n, c in targets.items()}
    backwards = (
        Window.partitionBy(*keys, SLOT)
        .orderBy(F.col(ts).desc())
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = df.withColumn(SLOT, slot)
    rows = rows.select("*", *[F.min(h).over(backwards).alias(f"__in_{n}") for n, h in hits.items()])
    later = (
        Window.partitionBy(*keys)
        .orderBy(F.col(SLOT).desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        df.withColumn(SLOT, slot)
        .groupBy(*keys, SLOT)
        .agg(*[F.min(h).alias(f"__first_{n}") for n, h in hits.items()])
        .select(*keys, SLOT, *[F.min(f"__first_{n}").over(later).alias(f"__later_{n}") for n in hits])
    )
    joined = _rejoin(rows, carried, keys)
    return joined.select(
        *df.columns,
        *[F.coalesce(f"__in_{n}", f"__later_{n}").alias(n) for n in hits],
    )


def trailing_count(
    df: DataFrame, keys: Sequence[str], ts: str, seconds: int, name: str, slot_seconds: int = DAY
) -> DataFrame:
    """Rows of the same key in ``[ts - seconds, ts]`` at second resolution, equal times included.

    A sweep: each row adds one at its second and takes it away just after its horizon, so that the
    running sum is the frame's count. No frame is ever held in memory.
    """
    second = F.unix_seconds(ts)
    step = F.explode(
        F.array(
            F.struct(second.alias("at"), F.lit(1).alias("d")),
            F.struct((second + seconds + 1).alias("at"), F.lit(-1).alias("d")),
        )
    )
    steps = (
        df.select(*keys, step.alias("s"))
        .groupBy(*keys, F.col("s.at").alias("__at"))
        .agg(F.sum("s.d").alias("__d"))
    )
    slot = F.floor(F.col("__at") / slot_seconds)
    levels = along(steps, keys, ["__at"], slot, running={name: F.col("__d")}).drop("__d")
    return df.withColumn("__at", second).join(levels.hint("merge"), [*keys, "__at"], "left").drop("__at")


def assign_to_windows(
    events: DataFrame,
    windows: DataFrame,
    keys: Sequence[str],
    lane: str,
    ts: str,
    start: str,
    end: str,
    carry: Sequence[str] = (),
    slot_seconds: int = HOUR,
) -> DataFrame:
    """Pair every event with the windows ``[start, end)`` of its key that contain it.

    Windows of one (key, lane) must not overlap, so an event has at most one window per lane and
    the result is no larger than events x lanes. Each event is looked up backwards in time in each
    lane of its key whose first start and last end it lies between, and goes no further in others;
    pairs of a key are never enumerated. Returns the event columns with ``start``,
    ``end``, ``lane`` and ``carry`` of the window.
    """
    from .joins import dimension_join

    window_cols = [start, end, *carry]
    payload = [c for c in events.columns if c not in {*keys, *window_cols, lane}]
    lanes = windows.groupBy(*keys, lane).agg(F.min(start).alias("__lo"), F.max(end).alias("__hi"))
    slot = time_slot(F.col("__t"), slot_seconds)

    spread = dimension_join(events, lanes, list(keys)).filter(
        (F.col(ts) >= F.col("__lo")) & (F.col(ts) < F.col("__hi"))
    )
    as_events = spread.select(
        *keys,
        lane,
        F.col(ts).alias("__t"),
        F.lit(None).cast(windows.select(F.struct(*window_cols)).schema[0].dataType).alias("__w"),
        F.struct(*payload).alias("__e"),
    )
    as_windows = windows.select(
        *keys,
        lane,
        F.col(start).alias("__t"),
        F.struct(*window_cols).alias("__w"),
        F.lit(None).cast(as_events.schema["__e"].dataType).alias("__e"),
    )
    rows = as_events.unionByName(as_windows).withColumn(SLOT, slot)
    here = (
        Window.partitionBy(*keys, lane, SLOT)
        .orderBy("__t")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = rows.withColumn("__open", F.max("__w").over(here)).filter("__e IS NOT NULL")

    # Last window before each slot that holds events; a key has no more rows here than slots.
    active = events.select(*keys, time_slot(F.col(ts), slot_seconds).alias(SLOT)).distinct()
    in_span = F.col(SLOT).between(
        time_slot(F.col("__lo"), slot_seconds), time_slot(F.col("__hi"), slot_seconds)
    )
    event_slots = active.join(lanes, list(keys)).filter(in_span).select(
        *keys, lane, SLOT, F.lit(None).cast(as_windows.schema["__w"].dataType).alias("__w")
    )
    window_slots = (
        as_windows.withColumn(SLOT, slot).groupBy(*keys, lane, SLOT).agg(F.max("__w").alias("__w"))
    )
    earlier = (
        Window.partitionBy(*keys, lane)
        .orderBy(SLOT)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        event_slots.unionByName(window_slots)
        .groupBy(*keys, lane, SLOT)
        .agg(F.max("__w").alias("__w"))
        .select(*keys, lane, SLOT, F.max("__w").over(earlier).alias("__carried"))
    )
    found = _rejoin(rows, carried, [*keys, lane]).withColumn(
        "__w", F.coalesce("__open", "__carried")
    )
    return found.filter(F.col("__t") < F.col(f"__w.{end}")).select(
        *keys, lane, *[f"__w.{c}" for c in window_cols], *[f"__e.{c}" for c in payload]
    )
