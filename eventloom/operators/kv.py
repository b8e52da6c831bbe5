"""Record-wise operators with null handling of their own; the rest is plain select and where."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from eventloom.operators.changelog import latest_by_key
from eventloom.operators.running import not_null


def holds(pred: Column) -> Column:
    """``pred`` with unknown as false."""
    return F.coalesce(pred, F.lit(False))


def keep_if(df: DataFrame, pred: Column, value: str) -> DataFrame:
    """Rows with a value that satisfy ``pred``."""
    return df.where(holds(pred) & F.col(value).isNotNull())


def keep_unless(df: DataFrame, pred: Column) -> DataFrame:
    """Rows that do not satisfy ``pred``; unknown counts as not satisfied."""
    return df.where(~holds(pred))


def flat_map(df: DataFrame, items: Column, out: str) -> DataFrame:
    """One row per non-null item of an array column; null and empty arrays give none."""
    return df.withColumn(out, F.explode(items)).where(F.col(out).isNotNull())


def branch(df: DataFrame, preds: Sequence[Column]) -> list[DataFrame]:
    """Split by the first predicate that holds; rows that satisfy none are dropped."""
    label = F.lit(None).cast("int")
    for i, pred in reversed(list(enumerate(preds))):
        label = F.when(holds(pred), F.lit(i)).otherwise(label)
    return [df.where(label == i) for i in range(len(preds))]


def peek(df: DataFrame, **metrics: Column) -> tuple[DataFrame, Observation]:
    """``df`` unchanged, and the metrics of the rows that pass, to be read after it has run."""
    seen = Observation()
    return df.observe(seen, *[col.alias(name) for name, col in metrics.items()]), seen


def partition_by_prefix(
    df: DataFrame, partitions: int, prefix: Sequence[str], full_key: Sequence[str], spread: int = 1
) -> DataFrame:
    """Hash partitions by a prefix of the key; rows without a key are spread over all of them.

    Each prefix lies in at most ``spread`` partitions, by its full key, whatever its size: equal full
    keys lie together, so grouping by the full key loses nothing. Choose more than 1 where a
    prefix may hold a large share of the rows.
    """
    part = F.when(not_null(prefix), F.pmod(F.xxhash64(*full_key), F.lit(spread)))
    spread_out = F.pmod(F.xxhash64(*df.columns), F.lit(partitions))
    marked = df.withColumn("_part", F.coalesce(part, spread_out))
    return marked.repartition(partitions, *prefix, "_part").select(*df.columns)


def collect_maps(
    df: DataFrame, group: Sequence[str], key: str, value: str, order: Sequence[str], shards: int = 1
) -> DataFrame:
    """Map of key to last value per group, null values allowed.

    A group gives up to ``shards`` rows, numbered by ``shard``, whose maps are disjoint and together
    complete. Choose more than 1 where the keys of a group do not fit into a row.
    """
    entries = latest_by_key(df.select(*group, key, value, *order), [*group, key], order)
    sharded = entries.withColumn("shard", F.pmod(F.xxhash64(key), F.lit(shards)).cast("int"))
    return sharded.groupBy(*group, "shard").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(key), F.col(value)))).alias("entries")
    )
