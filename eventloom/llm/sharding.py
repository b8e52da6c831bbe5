"""Records to shards by weighted rendezvous hashing.

Each shard draws a score for the key of a record, and the highest score wins. The draw depends
on key and shard alone: one more shard takes records only into itself, and one less
deals out only its own. A shard of weight w gets w times the records of one of weight 1.

A null key is a key like any other. Rows with equal keys go to one shard; equal rows are
counted before they are dealt out. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

# Parts of a shard that number their rows on their own.
BUCKETS = 256
# Copies of one row written at a time.
COPIES = 65_536


def _score(keys: Sequence[Column], shard: int, weight: float) -> Column:
    """-weight / ln(u), with u in (0, 1) from the upper 52 bits of a hash."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(shard), *keys), 12)
    return -F.lit(float(weight)) / F.log((bits + F.lit(0.5)) / F.lit(float(1 << 52)))


def _best(keys: Sequence[Column], weights: Sequence[float]) -> Column:
    """Struct of the highest score and the shard that has it; the later shard wins a tie."""
    draws = [F.struct(_score(keys, i, w).alias("score"), F.lit(i).alias("shard")) for i, w in enumerate(weights)]
    return F.greatest(*draws) if len(draws) > 1 else draws[0]


def rendezvous(keys: Sequence[Column], weights: Sequence[float]) -> Column:
    """The shard, from 0, of a record with these keys."""
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a positive weight")
    return _best(keys, weights).getField("shard")


def assign_shards(rows: DataFrame, keys: Sequence[str], weights: Sequence[float], added: float | None = None) -> DataFrame:
    """(all columns, ``shard``, ``slot``, ``grown_shard``); clashing columns of ``rows`` are replaced.

    ``slot`` numbers the rows of a shard from 0 without gaps. ``grown_shard`` is the shard if one more of
    weight ``added`` (1 by default) is put behind the others. Equal rows are summed before the first
    shuffle; each shard is numbered in ``BUCKETS`` parts, whose sizes, at most
    shards x ``BUCKETS`` rows, give where each part begins.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a positive weight")
    own = [c for c in rows.columns if c.lower() not in ("shard", "slot", "grown_shard")]
    key = [F.col(f"`{k}`") for k in keys]
    best = _best(key, weights)
    extra = _score(key, len(weights), 1.0 if added is None else added)
    row = F.struct(*[F.col(f"`{c}`") for c in own]).alias("row")
    counted = rows.select(row, best.alias("best"), extra.alias("extra")).select(
        "row",
        F.col("best.shard").alias("shard"),
        F.when(F.col("extra") > F.col("best.score"), F.lit(len(weights))).otherwise(F.col("best.shard")).alias("grown_shard"),
        F.pmod(F.xxhash64(F.lit("slot"), "row"), F.lit(BUCKETS)).cast("int").alias("bucket"),
    )
    counted = counted.groupBy("row", "shard", "grown_shard", "bucket").agg(F.count(F.lit(1)).alias("copies"))
    sizes = counted.groupBy("shard", "bucket").agg(F.sum("copies").alias("size"))
    earlier = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("shard", "bucket", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("begin"))
    order = Window.partitionBy("shard", "bucket").orderBy(F.xxhash64("row"), "row")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    numbered = counted.withColumn("at", F.coalesce(F.sum("copies").over(before), F.lit(0)))
    # At most shards x BUCKETS rows of three numbers.
    placed = numbered.join(F.broadcast(begins), ["shard", "bucket"])
    blocks = F.sequence(F.lit(0), F.expr(f"(copies - 1) div {COPIES}"))
    ends = F.least(F.col("copies"), (F.col("block") + 1) * COPIES)
    single = placed.withColumn("block", F.explode(blocks)).withColumn(
        "copy", F.explode(F.sequence(F.col("block") * COPIES, ends - 1))
    )
    return single.select("row.*", "shard", (F.col("begin") + F.col("at") + F.col("copy")).alias("slot"), "grown_shard")
