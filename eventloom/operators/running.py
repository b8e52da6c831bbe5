"""Running values per key that survive a key holding a large share of all rows.

A plain window over ``PARTITION BY key ORDER BY arrival`` puts every row of a key in one
task. Here the hot keys, found by a count with map-side combine, are cut into chunks of the
order column at its quantiles, so that chunks have about as many rows each whatever the unit
of the column, bursts or outliers. One row per chunk carries the value reached before it, so
that each (key, chunk) is computed on its own. All other keys keep the plain window, in the
same exchange.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# A key is worth splitting from this many rows on, into chunks of about as many.
HOT_ROWS = 1_000_000
# Bound of the broadcast list of hot keys. A key beyond it has under 1/HOT_KEYS of all rows, no more
# than a task has anyway, and is computed unsplit.
HOT_KEYS = 10_000
# Quantiles kept of the order column of a hot key; chunks are interpolated between them.
SLICES = 128

_CHUNK = "_chunk"
_CARRY = "_carry"


def not_null(names: Sequence[str]) -> Column:
    return reduce(and_, [F.col(name).isNotNull() for name in names])


def hot_keys(
    df: DataFrame, keys: Sequence[str], min_rows: int | None = None, max_keys: int | None = None
) -> DataFrame:
    """The largest keys of ``df`` with at least ``min_rows`` (``HOT_ROWS``) rows, never more than
    ``max_keys`` (``HOT_KEYS``)."""
    counts = df.where(not_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    large = counts.where(F.col("_rows") >= (min_rows or HOT_ROWS))
    bound = HOT_KEYS if max_keys is None else max_keys
    return large.orderBy(F.desc("_rows"), *keys).limit(bound).select(*keys)


def hot_ranges(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    min_rows: int | None = None,
    max_keys: int | None = None,
    few_keys: bool = False,
) -> DataFrame:
    """Hot keys with quantiles of ``order`` and the number of their chunks: one for each
    ``min_rows`` rows.

    Quantiles are taken of hot keys only; keys of one chunk are left out. ``few_keys`` skips the
    search where all keys are known to be few.
    """
    rows = df.where(not_null(keys)).select(*keys, order)
    if not few_keys:
        rows = rows.join(F.broadcast(hot_keys(df, keys, min_rows, max_keys)), list(keys), "left_semi")
    # One parsed expression: a list would cost a call to the JVM for each share.
    shares = F.expr(f"array({', '.join(f'{i / SLICES}D' for i in range(SLICES + 1))})")
    ranges = rows.groupBy(*keys).agg(
        F.percentile_approx(order, shares).alias("_cuts"),
        F.ceil(F.count(F.lit(1)) / F.lit(min_rows or HOT_ROWS)).alias("_chunks"),
    )
    return ranges.where("_chunks > 1")


def _cut(rows: DataFrame, order: str) -> DataFrame:
    """``rows``, joined to hot ranges, with the number of their chunk, NULL for other keys.

    It is the share of the key's rows up to ``order`` by the quantiles, linear between two of them,
    times the number of chunks: it never falls as ``order`` rises, and equal rows stay together.
    """
    at, cuts = F.col(order), F.col("_cuts")
    steps = F.expr(f"array({', '.join(str(1 << i) for i in reversed(range(SLICES.bit_length())))})")

    def forward(place: Column, step: Column) -> Column:
        return F.when(F.get(cuts, place + step - 1) <= at, place + step).otherwise(place)

    below = F.when(cuts.isNotNull(), F.aggregate(steps, F.lit(0), forward))
    low, high = (F.get(cuts, F.col("_below") + i).cast("double") for i in (-1, 0))
    between = F.coalesce(F.try_divide(at.cast("double") - low, high - low), F.lit(0.0))
    number = F.floor((F.col("_below") + between) / SLICES * F.col("_chunks"))
    placed = rows.withColumn("_below", below).withColumn(_CHUNK, number)
    return placed.drop("_cuts", "_chunks", "_below")


def partial_value(kind: str, col: Column, order: Column) -> Column:
    if kind == "sum":
        return F.sum(col)
    if kind == "max":
        return F.max(col)
    if kind == "min":
        return F.min(col)
    if kind == "last":
        return F.max_by(col, F.when(col.isNotNull(), order))
    raise ValueError(f"unknown running value {kind!r}")


def _fold(kind: str, col: Column) -> Column:
    if kind == "last":
        return F.last(col, ignorenulls=True)
    return {"sum": F.sum, "max": F.max, "min": F.min}[kind](col)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    outputs: dict[str, tuple[str, Column]],
    *,
    hot: DataFrame | None = None,
    inclusive: bool = True,
) -> DataFrame:
    """``df`` plus one running column per entry of ``outputs``.

    ``outputs`` maps a name to (``sum`` | ``max`` | ``min`` | ``last`` non-null, column). ``order`` is a
    BIGINT column followed by tie-breaks. ``inclusive=False`` leaves the current row out.
    ``hot`` takes the result of ``hot_ranges`` where it is better had from a cheaper frame.
    Rows with a NULL key are dropped.
    """
    keyed = df.where(not_null(keys)).select(
        "*", *[col.alias(f"_in_{name}") for name, (_, col) in outputs.items()]
    )
    hot = F.broadcast(hot_ranges(df, keys, order[0]) if hot is None else hot)
    split = _cut(keyed.join(hot, list(keys)), order[0])
    marked = _cut(keyed.join(hot, list(keys), "left"), order[0])

    position = F.struct(*[F.col(c) for c in order])
    partial = split.groupBy(*keys, _CHUNK).agg(
        *[partial_value(kind, F.col(f"_in_{n}"), position).alias(f"_in_{n}") for n, (kind, _) in outputs.items()]
    )
    before = W.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(W.unboundedPreceding, -1)
    carry = partial.select(
        *keys,
        _CHUNK,
        *[_fold(kind, F.col(f"_in_{n}")).over(before).alias(f"_in_{n}") for n, (kind, _) in outputs.items()],
        F.lit(True).alias(_CARRY),
    )
    both = marked.withColumn(_CARRY, F.lit(False)).unionByName(carry, allowMissingColumns=True)
    end = W.currentRow if inclusive else -1
    so_far = (
        W.partitionBy(*keys, _CHUNK)
        .orderBy(F.desc(_CARRY), *order)
        .rowsBetween(W.unboundedPreceding, end)
    )
    return (
        both.select(
            *df.columns,
            _CARRY,
            *[_fold(kind, F.col(f"_in_{n}")).over(so_far).alias(n) for n, (kind, _) in outputs.items()],
        )
        .where(~F.col(_CARRY))
        .drop(_CARRY)
    )
