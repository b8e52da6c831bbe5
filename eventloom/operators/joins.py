"""Interval joins, as-of joins against a changing table, lookups and running-max correction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.eventtime import bucket
from eventloom.operators.running import hot_keys, hot_ranges, not_null, running


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    within_ms: int,
    left_ts: str,
    right_ts: str,
    cell_ms: int | None = None,
) -> DataFrame:
    """Pairs of rows with equal keys and times at most ``within_ms`` apart, both ends included.

    The time columns are TIMESTAMPs; apart from the keys the two sides have no column name in
    common. Time cells are part of the join key: a left row is in its own cell, a right row in
    every cell it can reach (two on average at the default cell width). So a hot key is spread
    over its cells, each pair meets exactly once, and the exact condition stays. Works on
    streams as it is; there the watermarks and the time condition bound the state.
    """
    cell_ms = cell_ms or 2 * max(within_ms, 1)
    reach = F.expr(f"INTERVAL '{within_ms / 1000:.3f}' SECOND")
    left_cell = bucket(F.unix_millis(left_ts), cell_ms)
    right_ms = F.unix_millis(right_ts)
    right_cells = F.sequence(
        bucket(right_ms - within_ms, cell_ms), bucket(right_ms + within_ms, cell_ms)
    )
    near = left.where(not_null([*keys, left_ts])).withColumn("_cell", left_cell)
    far = right.where(not_null([*keys, right_ts])).select(
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        *[c for c in right.columns if c not in keys],
        F.explode(right_cells).alias("_r_cell"),
    )
    same = F.col("_cell") == F.col("_r_cell")
    for k in keys:
        same = same & (F.col(k) == F.col(f"_r_{k}"))
    close = (F.col(right_ts) >= F.col(left_ts) - reach) & (F.col(right_ts) <= F.col(left_ts) + reach)
    return near.join(far, same & close).drop("_cell", "_r_cell", *[f"_r_{k}" for k in keys])


def asof_join(
    stream: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    order: str,
    values: Sequence[str],
    how: str = "inner",
    tombstone: str | None = None,
    see_equal: bool = False,
    **split,
) -> DataFrame:
    """Each ``stream`` row with the ``table`` row of its key as it was when the row arrived.

    ``order`` is the arrival order both sides share. A table row whose ``tombstone`` column is
    NULL deletes the key. ``see_equal`` makes a table row visible to a stream row with the
    same arrival. One exchange of the union of both sides; no range join.
    """
    updates = table.where(not_null(keys)).select(
        *keys,
        order,
        F.struct(
            *values,
            (F.col(tombstone).isNull() if tombstone else F.lit(False)).alias("_deleted"),
        ).alias("_update"),
        F.lit(0 if see_equal else 2).alias("_side"),
    )
    arriving = stream.where(not_null(keys)).withColumn("_side", F.lit(1))
    both = arriving.unionByName(updates, allowMissingColumns=True)
    if "hot" not in split:
        narrow = stream.select(*keys, order).unionAll(table.select(*keys, order))
        split["hot"] = hot_ranges(narrow, keys, order)
    met = running(both, keys, [order, "_side"], {"_seen": ("last", F.col("_update"))}, **split)
    live = F.col("_seen").isNotNull() & ~F.coalesce(F.col("_seen._deleted"), F.lit(False))
    out = met.where(F.col("_side") == 1).select(
        *stream.columns,
        *[F.when(live, F.col(f"_seen.{v}")).alias(v) for v in values],
        live.alias("_live"),
    )
    if how == "inner":
        out = out.where("_live")
    elif how != "left":
        raise ValueError(f"as-of join is inner or left, not {how!r}")
    return out.drop("_live")


def join_keyed_table(
    stream: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    hot: DataFrame | None = None,
) -> DataFrame:
    """Inner or left join with a table that has one row per key and is too large to replicate.

    Hot keys of the stream, at most ``HOT_KEYS``, meet a replica of their own table rows, one
    per key and so just as few; only the other keys are shuffled. Rows without a key are not
    shuffled at all.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"join with a keyed table is inner or left, not {how!r}")
    keys = list(keys)
    hot = F.broadcast(hot_keys(stream, keys) if hot is None else hot)
    hot_rows = F.broadcast(table.join(hot, keys, "left_semi"))
    keyed = stream.where(not_null(keys))
    split = keyed.join(hot, keys, "left_semi").join(hot_rows, keys, how)
    joined = split.unionByName(keyed.join(hot, keys, "left_anti").join(table, keys, how))
    if how == "left":
        joined = joined.unionByName(stream.where(~not_null(keys)), allowMissingColumns=True)
    return joined


def lookup(stream: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Per-record lookup in a keyed table.

    No hint: the planner replicates the table when its size is below
    ``spark.sql.autoBroadcastJoinThreshold`` (checked on the plan and again at run time) and
    shuffles it otherwise, with adaptive splitting of skewed partitions. For a table known to
    be large, ``join_keyed_table`` keeps hot keys out of the shuffle.
    """
    return stream.join(table, list(keys), how)


def raise_to_running_max(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], ts: str, **split
) -> DataFrame:
    """Lift ``ts`` to the largest value its key has had so far."""
    top = running(df, keys, order, {"_top": ("max", F.col(ts))}, **split)
    return top.withColumn(ts, F.greatest(F.col(ts), F.col("_top"))).drop("_top")
