"""Event-time windows over epoch-millisecond columns, and the batch replay of late-record drops.

Bounds are epoch milliseconds. A tumbling window ends at start + size (exclusive), a session
at its last event, a sliding window at start + span (inclusive).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from eventloom.functions.eventtime import bucket
from eventloom.operators.running import hot_ranges, not_null, running
from eventloom.session import written


def tumbling(
    df: DataFrame, keys: Sequence[str], ts: str, size_ms: int, *aggs: Column
) -> DataFrame:
    """Aggregate per key and tumbling window; rows combine on the map side first.

    ``ts`` is epoch milliseconds, or a TIMESTAMP: on a stream the watermarked one, which also
    decides which rows are late.
    """
    aggs = aggs or (F.count(F.lit(1)).alias("counter"),)
    time = F.col(ts)
    if not isinstance(df.schema[ts].dataType, T.TimestampType):
        time = F.timestamp_millis(time)
    grouped = (
        df.where(not_null([*keys, ts]))
        .groupBy(*keys, F.window(time, f"{size_ms} milliseconds"))
        .agg(*aggs)
    )
    return grouped.select(
        *keys,
        F.unix_millis("window.start").alias("window_start"),
        F.unix_millis("window.end").alias("window_end"),
        *[c for c in grouped.columns if c not in (*keys, "window")],
    )


def tumbling_updates(
    df: DataFrame, keys: Sequence[str], ts: str, size_ms: int, order: Sequence[str], **split
) -> DataFrame:
    """Every intermediate count of a tumbling window, one row per input row, as a table with
    caching off emits it."""
    start = F.col(ts) - F.pmod(F.col(ts), F.lit(size_ms))
    placed = df.where(not_null([*keys, ts])).select(
        *keys, *order, start.alias("window_start"), (start + size_ms).alias("window_end")
    )
    return running(
        placed, [*keys, "window_start"], order, {"counter": ("sum", F.lit(1))}, **split
    )


# Cells of a session aggregate that are put in order at a time.
CELLS = 1_000_000
# How partial results of a session aggregate are merged.
_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
_START = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}


def session(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    gap_ms: int,
    aggs: dict[str, tuple[str, Column]] | None = None,
) -> DataFrame:
    """Sessions closed by more than ``gap_ms`` without an event; ``window_end`` is the last event.

    Rows no further apart than the gap are one session for sure, so each key is first
    aggregated into time cells as wide as the gap, with map-side combine, and the cells into
    the sessions of a stretch of ``CELLS`` cells. Only the first and the last session of a
    stretch can go on in another one; they are put in order per key, two rows for each stretch.
    So no task orders more than ``CELLS`` cells, or two rows per stretch, of a key.
    ``aggs`` maps a name to (count | sum | min | max, column).
    """
    aggs = aggs or {"counter": ("count", F.lit(1))}
    merged = [
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
        *[_MERGE[kind](name).alias(name) for name, (kind, _) in aggs.items()],
    ]
    cells = (
        df.where(not_null([*keys, ts]))
        .withColumn("_cell", bucket(F.col(ts), max(gap_ms, 1)))
        .groupBy(*keys, "_cell")
        .agg(
            F.min(ts).alias("_first"),
            F.max(ts).alias("_last"),
            *[_START[kind](col).alias(name) for name, (kind, col) in aggs.items()],
        )
    )

    def merge(rows: DataFrame, by: list[str]) -> DataFrame:
        in_order = W.partitionBy(*by).orderBy("_first")
        opens = F.col("_first") - F.lag("_last").over(in_order) > gap_ms
        numbered = rows.withColumn("_new", F.coalesce(opens, F.lit(True)).cast("int")).withColumn(
            "_session", F.sum("_new").over(in_order.rowsBetween(W.unboundedPreceding, 0))
        )
        return numbered.groupBy(*by, "_session").agg(*merged)

    stretch = [*keys, "_stretch"]
    within = merge(cells.withColumn("_stretch", bucket(F.col("_cell"), CELLS)), stretch)
    number = F.col("_session")
    edge = (number == 1) | (number == F.max(number).over(W.partitionBy(*stretch)))
    # An inner session stays alone with the others of its stretch, which it cannot touch.
    within = within.withColumn("_edge", edge)
    placed = within.withColumn("_stretch", F.when(~F.col("_edge"), F.col("_stretch"))).drop("_session")
    return merge(placed, stretch).select(
        *keys, F.col("_first").alias("window_start"), F.col("_last").alias("window_end"), *aggs
    )


def sliding(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    span_ms: int,
    closed: Column | None = None,
    **split,
) -> DataFrame:
    """Record-aligned sliding windows: every [t-d, t] and, if not empty, [t+1, t+1+d], with counts.

    ``closed`` is the time up to which windows had ended for good when the row came: it counts in
    those windows alone that end after it, and makes no other ones. So a late row may be too late
    for its own window and still count in one that another row made.

    An event at t is inside all windows ending in [t, t+d]: it adds one at t and takes it
    away at t+d+1. The running sum of these changes at x is the count of [x-d, x], and the
    change points are exactly the window ends asked for. So one running sum gives all
    windows, without a range frame that would be re-read for every row.
    """
    events = df.where(not_null([*keys, ts]))
    if "hot" not in split:
        split["hot"] = hot_ranges(events, keys, ts)
    at, one = F.col(ts), F.lit(1).cast("bigint")
    starts, own = at, F.lit(True)
    if closed is not None:
        events = events.where(at + span_ms + 1 > closed)
        # A change where no window ends: the first end that the row still counts for.
        starts, own = F.greatest(at, closed + 1), at > closed
    changes = events.select(
        *keys,
        F.inline(
            F.array(
                F.struct(starts.alias("_x"), one.alias("_d"), own.alias("_end")),
                F.struct((at + span_ms + 1).alias("_x"), (-one).alias("_d"), F.lit(True).alias("_end")),
            )
        ),
    )
    points = changes.groupBy(*keys, "_x").agg(F.sum("_d").alias("_d"), F.max("_end").alias("_end"))
    counted = running(points, keys, ["_x"], {"counter": ("sum", F.col("_d"))}, **split)
    return counted.where(F.col("_end") & (F.col("counter") > 0)).select(
        *keys,
        (F.col("_x") - span_ms).alias("window_start"),
        F.col("_x").alias("window_end"),
        "counter",
    )


def with_stream_time(
    df: DataFrame, partition: str, order: Sequence[str], ts: str, name: str = "stream_time", **split
) -> DataFrame:
    """``df`` with the largest ``ts`` that its source partition had seen when each row came, itself included.

    Source partitions are few and large, so all of them are cut into chunks of arrival.
    """
    if "hot" not in split:
        split["hot"] = hot_ranges(df, [partition], order[0], few_keys=True)
    return running(df, [partition], order, {name: ("max", F.col(ts))}, **split)


def drop_late(
    df: DataFrame,
    partition: str,
    order: Sequence[str],
    ts: str,
    window_end: Column,
    grace_ms: int = 0,
    **split,
) -> DataFrame:
    """Replay of arrival order: drop rows whose window closed before they came.

    A row is late when its window end <= stream time - grace. ``window_end`` is ``tumbling_end``,
    ``session_end`` or ``sliding_end``: a row is judged by its own time alone. ``drop_late_for_sessions``
    also keeps a row that an open session takes in, and ``sliding`` judges each of a row's windows.
    """
    timed = with_stream_time(df, partition, order, ts, "_stream_time", **split)
    return timed.where(window_end > F.col("_stream_time") - grace_ms).drop("_stream_time")


def drop_late_for_sessions(
    df: DataFrame,
    partition: str,
    keys: Sequence[str],
    order: Sequence[str],
    ts: str,
    gap_ms: int,
    grace_ms: int = 0,
    **split,
) -> DataFrame:
    """Replay of arrival order for sessions: a row is merged with the sessions of its key that it
    touches, and dropped if even the merged one had closed: its end + gap < stream time - grace.

    A row in time by its own time is kept at once. A late one is kept if rows that were kept and came
    before it lead from its time, in steps of at most the gap, to the closing time. In cells as
    wide as the gap all rows touch, so a step needs the smallest and the largest time that each cell
    held when the late row came; both are running values per key and cell, so a hot key is spread
    over its cells, and a hot cell over chunks of arrival. A late row looks into as many cells as it is gaps late.
    Late rows that are kept may save later ones: those near them are asked again, until none is kept.
    ``order`` tells the rows of a key apart. Late rows without a key belong to no session.
    """
    if "hot" not in split:
        ranges = hot_ranges(df, [partition], order[0], few_keys=True)
        split["hot"] = written(ranges, "ranges")
    timed = with_stream_time(df, partition, order, ts, "_stream_time", **split)
    timed = timed.withColumn("_closed", F.col("_stream_time") - grace_ms - gap_ms)
    in_time = F.col(ts) >= F.col("_closed")
    kept = timed.where(in_time)
    late = written(timed.where(not_null(keys) & ~in_time), "late")
    if late.isEmpty():
        return kept.select(df.columns)

    group = list(dict.fromkeys([partition, *keys]))
    row = list(dict.fromkeys([*group, *order]))
    width = max(gap_ms, 1)

    def cell(at: Column) -> Column:
        return bucket(at, width)

    cells = F.sequence(cell(F.col(ts)), cell(F.col("_closed")) + 1)
    asks = written(
        late.select(*row, F.col(ts).alias("_from"), "_closed", F.explode(cells).alias("_cell")), "asks"
    )
    asked_cells = asks.select(*group, "_cell").distinct()

    def placed(rows: DataFrame) -> DataFrame:
        return rows.select(*row, F.col(ts).alias("_at"), cell(F.col(ts)).alias("_cell"))

    members = written(placed(kept).join(asked_cells, [*group, "_cell"], "left_semi"), "members")
    saved: list[DataFrame] = []
    open_asks = asks
    while True:
        both = members.unionByName(open_asks, allowMissingColumns=True)
        held = {"_low": ("min", F.col("_at")), "_high": ("max", F.col("_at"))}
        seen = running(both, [*group, "_cell"], order, held, inclusive=False)
        steps = F.array_sort(F.collect_list(F.struct("_cell", "_low", "_high")))
        paths = seen.where("_from IS NOT NULL").groupBy(*row, "_from", "_closed").agg(steps.alias("_steps"))
        reached = paths.where(_session_end(F.col("_from"), gap_ms, cell) >= F.col("_closed")).select(*row)
        new = written(late.join(reached, row, "left_semi"), "saved")
        if new.isEmpty():
            break
        saved.append(new)
        members = members.unionByName(placed(new))
        asks = asks.join(new.select(*row), row, "left_anti")
        near = placed(new).select(*group, "_cell").distinct()
        again = asks.join(near, [*group, "_cell"], "left_semi").select(*row).distinct()
        open_asks = written(asks.join(again, row, "left_semi"), "asks")
    every = [kept, *saved]
    return reduce(DataFrame.unionByName, [rows.select(df.columns) for rows in every])


def _session_end(start: Column, gap_ms: int, cell: Callable[[Column], Column]) -> Column:
    """The last time reached from ``start`` over ``_steps``, the (cell, low, high) in order of cells."""

    def step(so_far: Column, s: Column) -> Column:
        own = s["_cell"] == cell(start)
        goes_on = so_far["on"] & s["_low"].isNotNull() & (s["_low"] - so_far["end"] <= gap_ms)
        end = F.when(own | goes_on, F.greatest(so_far["end"], s["_high"])).otherwise(so_far["end"])
        return F.struct(end.alias("end"), F.coalesce(own | goes_on, F.lit(False)).alias("on"))

    first = F.struct(start.alias("end"), F.lit(True).alias("on"))
    return F.aggregate("_steps", first, step, lambda path: path["end"])


def tumbling_end(ts: str, size_ms: int) -> Column:
    return F.col(ts) - F.pmod(F.col(ts), F.lit(size_ms)) + size_ms


def session_end(ts: str, gap_ms: int) -> Column:
    """From when on no event can prolong a session that ends with this row."""
    return F.col(ts) + gap_ms + 1


def sliding_end(ts: str, span_ms: int) -> Column:
    """End of the last sliding window that holds this row."""
    return F.col(ts) + span_ms + 1
