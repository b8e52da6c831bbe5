"""Running values and as-of joins on a stream that split hot keys: tables in place of keyed state.

A keyed state brings all that a key has in a micro-batch into one task, with all that waits for it. Here a micro-batch
is a table for the operators of batch, which cut hot keys into chunks, and what the next one needs
is a table too: the rows that wait for earlier ones, spread as they came, and a carry row for each key.
A micro-batch overwrites its own folders alone and reads those of the one before, so it may be repeated.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.operators.running import hot_ranges, not_null, partial_value, running
from eventloom.sources.feeds import exists
from eventloom.sources.sinks import read_log


@dataclass(frozen=True)
class InOrder:
    """Batch action that gives ``act`` the rows of a feed in disorder in order of the whole number ``order``.

    No row comes after one whose ``order`` is larger by more than ``disorder``. A row is settled, and goes to
    ``act``, once no smaller one can come; others wait. Rows that come later than that, or without a position, are
    late: they are kept aside, see ``late``. Each micro-batch writes its rows and those that waited once.
    """

    root: str
    order: str
    disorder: int
    act: Callable[[DataFrame, int], None]

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        spark, before, every = rows.sparkSession, None, rows
        if batch_id > 0:
            before = spark.read.parquet(f"{self.root}/reached/batch={batch_id - 1}").first().reached
            every = rows.unionByName(self._fate(spark, batch_id - 1, "waiting", rows.schema))
        top = rows.agg(F.max(self.order)).first()[0]
        tops = [x for x in (before, None if top is None else top - self.disorder) if x is not None]
        reached = max(tops, default=None)
        at = F.col(self.order)
        late = at.isNull() if before is None else at.isNull() | (at < before)
        settled = F.lit(False) if reached is None else at < reached
        fate = F.when(late, "late").when(settled, "settled").otherwise("waiting")
        split = every.withColumn("fate", fate).write.mode("overwrite").partitionBy("fate")
        split.parquet(f"{self.root}/rows/batch={batch_id}")
        mark = spark.createDataFrame([(reached,)], "reached BIGINT")
        mark.write.mode("overwrite").parquet(f"{self.root}/reached/batch={batch_id}")
        self.act(self._fate(spark, batch_id, "settled", rows.schema), batch_id)

    def _fate(self, spark: SparkSession, batch_id: int | None, fate: str, schema: T.StructType) -> DataFrame:
        folder = f"{self.root}/rows" if batch_id is None else f"{self.root}/rows/batch={batch_id}"
        marked = T.StructType([*schema.fields, T.StructField("fate", T.StringType())])
        return spark.read.schema(marked).parquet(folder).where(F.col("fate") == fate).select(schema.names)

    def late(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """The late rows of all micro-batches."""
        return self._fate(spark, None, "late", schema)

    def close(self, spark: SparkSession, schema: T.StructType) -> None:
        """At the end of a feed: give ``act`` the rows that still wait, as one more batch."""
        if exists(spark, f"{self.root}/reached"):
            last = spark.read.parquet(f"{self.root}/reached").agg(F.max("batch")).first()[0]
            self.act(self._fate(spark, last, "waiting", schema), last + 1)


def running_batches(
    root: str,
    keys: Sequence[str],
    order: Sequence[str],
    outputs: dict[str, tuple[str, Column]],
    snapshot_every: int = 50,
) -> Callable[[DataFrame, int], None]:
    """Batch action: ``running`` over a feed in order, carried from micro-batch to micro-batch.

    Each batch starts from what its keys had reached and logs what they reach. Every
    ``snapshot_every``-th logs all keys, so reading goes back to the last such log only. ``order``
    is a BIGINT column followed by tie-breaks. Rows with a NULL key are dropped.
    """
    kinds = {name: kind for name, (kind, _) in outputs.items()}

    def reached(fed: DataFrame) -> DataFrame:
        at = F.struct(*order)
        return fed.groupBy(*keys).agg(*[partial_value(kind, F.col(f"_add_{n}"), at).alias(f"_add_{n}") for n, kind in kinds.items()])

    def act(rows: DataFrame, batch_id: int) -> None:
        keyed = rows.where(not_null(keys)).select(
            "*", *[col.alias(f"_add_{n}") for n, (_, col) in outputs.items()], F.lit(False).alias("_held")
        )
        # Sums are wider than what they add up; the carry keeps their type.
        layout, log, fed, known = reached(keyed).schema, f"{root}/carry", keyed, None
        if batch_id > 0:
            since = (batch_id - 1) // snapshot_every * snapshot_every
            known = read_log(rows.sparkSession, log, layout, keys, [], range(since, batch_id)).select(layout.names)
            needed = known.join(keyed.select(*keys).distinct(), list(keys), "left_semi")
            first = F.lit(-(1 << 63)).cast("long").alias(order[0])
            fed = keyed.unionByName(needed.select("*", first, F.lit(True).alias("_held")), allowMissingColumns=True)
        after = reached(fed).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in layout])
        if known is not None and batch_id % snapshot_every == 0:
            after = after.unionByName(known.join(keyed.select(*keys).distinct(), list(keys), "left_anti"))
        after.write.mode("overwrite").parquet(f"{log}/batch={batch_id}")
        values = {n: (kind, F.col(f"_add_{n}")) for n, kind in kinds.items()}
        met = running(fed, keys, order, values, hot=hot_ranges(keyed, keys, order[0]))
        met.where("NOT _held").select(*rows.columns, *outputs).write.mode("overwrite").parquet(f"{root}/out/batch={batch_id}")

    return act
