"""Keyed aggregates in two forms: final (one row per key) and updates (one row per input row).

Final forms combine on the map side, so a key with a large share of the rows reaches the
reducer as one row per map task. Update forms go through ``running``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from eventloom.operators.running import not_null, running


def position(order: Sequence[str]) -> Column:
    """Arrival position as one comparable value."""
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def count_by_key(df: DataFrame, keys: Sequence[str], min_count: int = 1) -> DataFrame:
    counts = df.where(not_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= min_count)


def count_updates(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], min_count: int = 1, **split
) -> DataFrame:
    """Every intermediate count ``n``, as a table with caching off emits it."""
    counted = running(df, keys, order, {"n": ("sum", F.lit(1))}, **split)
    return counted.where(F.col("n") >= min_count)


def _pick(df: DataFrame, keys: Sequence[str], at: Sequence[Column]) -> DataFrame:
    """The first row per key; Spark cuts to one row per key and map task before the exchange."""
    number = F.row_number().over(W.partitionBy(*keys).orderBy(*at))
    return df.where(not_null(keys)).withColumn("_n", number).where("_n = 1").drop("_n")


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _pick(df, keys, [F.desc(c) for c in order])


def first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _pick(df, keys, [F.asc_nulls_last(c) for c in order])


def keyed_table(
    changes: DataFrame, keys: Sequence[str], order: Sequence[str], value: str
) -> DataFrame:
    """Upsert by key: the latest row per key, gone if its ``value`` is NULL."""
    return latest_by_key(changes, keys, order).where(F.col(value).isNotNull())


def table_filter(changes: DataFrame, value: str, pred: Column) -> DataFrame:
    """Filter on a changelog: a row failing ``pred`` becomes a delete (NULL value), not a gap."""
    return changes.withColumn(value, F.when(F.coalesce(pred, F.lit(False)), F.col(value)))


def max_by_key(df: DataFrame, keys: Sequence[str], col: str, floor: int = 0) -> DataFrame:
    """Largest ``col`` per key, at least ``floor``."""
    top = F.greatest(F.max(col), F.lit(floor).cast("bigint"))
    return df.where(not_null(keys)).groupBy(*keys).agg(top.alias(col))


def merge_fields(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    texts: Sequence[str] = (),
    times: Sequence[str] = (),
    counters: Sequence[str] = (),
    oldest: Sequence[str] = (),
) -> DataFrame:
    """Fold partial records of a key into one.

    The later non-null text and the later positive time win, counters add up, and ``oldest``
    keeps the smallest value.
    """

    def last_set(name: str, is_set: Column) -> Column:
        return F.max_by(F.col(name), F.when(is_set, position(order))).alias(name)

    return df.where(not_null(keys)).groupBy(*keys).agg(
        *[last_set(c, F.col(c).isNotNull()) for c in texts],
        *[last_set(c, F.col(c) > 0) for c in times],
        *[F.sum(c).alias(c) for c in counters],
        *[F.min(c).alias(c) for c in oldest],
    )


def merge_updates(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    texts: Sequence[str] = (),
    times: Sequence[str] = (),
    counters: Sequence[str] = (),
    oldest: Sequence[str] = (),
    **split,
) -> DataFrame:
    """The updates form of ``merge_fields``: the folded record as each input record left it."""
    outputs = {
        **{c: ("last", F.col(c)) for c in texts},
        **{c: ("last", F.when(F.col(c) > 0, F.col(c))) for c in times},
        **{c: ("sum", F.col(c)) for c in counters},
        **{c: ("min", F.col(c)) for c in oldest},
    }
    merged = running(df, keys, order, {f"_{c}": out for c, out in outputs.items()}, **split)
    return merged.select(*keys, *order, *[F.col(f"_{c}").alias(c) for c in outputs])


def seen_once(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Final form of "count is 1": the rows whose key occurs exactly once."""
    values = [c for c in df.columns if c not in keys]
    grouped = df.where(not_null(keys)).groupBy(*keys).agg(
        F.max_by(F.struct(*values), position(order)).alias("_row"), F.count(F.lit(1)).alias("_n")
    )
    return grouped.where(F.col("_n") == 1).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}") for c in df.columns]
    )
