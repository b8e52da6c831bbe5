"""Stream forms of the operators: sessions, de-duplication, state machines, as-of joins.

Tumbling windows and interval joins are the batch operators on a watermarked stream.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from eventloom.functions.eventtime import field_time, with_event_time
from eventloom.operators.changelog import latest_by_key
from eventloom.operators.joins import asof_join, lookup, raise_to_running_max
from eventloom.operators.running import not_null
from eventloom.sources.feeds import exists, file_feed
from eventloom.sources.sinks import read_log, write_files
from eventloom.streaming import processors as P

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(P)


def session_stream(
    stream: DataFrame, keys: Sequence[str], gap_ms: int, *aggs: Column
) -> DataFrame:
    """Sessions over the watermarked ``ts``, sent when closed; the end is the last event."""
    aggs = aggs or (F.count(F.lit(1)).alias("counter"),)
    grouped = (
        stream.where(not_null(keys))
        .groupBy(*keys, F.session_window("ts", f"{gap_ms} milliseconds").alias("_window"))
        .agg(F.max("ts").alias("_last"), *aggs)
    )
    return grouped.select(
        *keys,
        F.unix_millis("_window.start").alias("window_start"),
        F.unix_millis("_last").alias("window_end"),
        *[c for c in grouped.columns if c not in (*keys, "_window", "_last")],
    )


def first_occurrence_stream(stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, once for good: the keys seen are kept, in the RocksDB store."""
    return stream.where(not_null(keys)).dropDuplicates(list(keys))


def first_occurrence_within(stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key and stretch of event time: a key is forgotten when the watermark has passed its row by the
    lateness, so the state holds the keys of that span alone. A key that comes again later is sent again."""
    return stream.where(not_null(keys)).dropDuplicatesWithinWatermark(list(keys))


def running_max_batches(
    root: str, checkpoint: str, keys: Sequence[str], order: Sequence[str], ts: str
) -> Callable[[DataFrame, int], None]:
    """Batch action: ``ts`` of each record lifted to the largest value of its key, read from the state of another query.

    That query keeps ``max(ts)`` per key over the same feed, cut into the same micro-batches, with its
    ``checkpoint``; it must be a batch behind at most. Its state as of the batch before is what the
    records of a batch start from, so the result is that of one query over the feed in order. Hot keys are split.
    """

    def act(rows: DataFrame, batch_id: int) -> None:
        fed = rows.withColumn("_held", F.lit(False))
        if batch_id > 0:
            state = stored_state(rows.sparkSession, checkpoint, batchId=str(batch_id - 1))
            held = state.select("key.*", F.col("value.max").alias(ts))
            needed = held.join(rows.select(*keys).distinct(), list(keys), "left_semi")
            first = {c: F.lit(-(1 << 62)).cast(rows.schema[c].dataType) for c in order}
            fed = fed.unionByName(needed.withColumns({**first, "_held": F.lit(True)}), allowMissingColumns=True)
        lifted = raise_to_running_max(fed, keys, order, ts).where("NOT _held").drop("_held")
        lifted.write.mode("overwrite").parquet(f"{root}/out/batch={batch_id}")

    return act


def monitor_stream(
    rows: DataFrame, alert_after_ms: int = 120_000, clock: str = "eventTime", buckets: int = 4096
) -> DataFrame:
    """Outcomes of messages; ``rows`` is the union of the three feeds.

    ``clock`` is ``eventTime``, with ``rows`` watermarked on ``ts``, or ``processingTime``. Messages are kept in
    ``buckets`` by a hash of their id; a bucket must fit into memory, and the state is started with their number.
    """
    machine = P.DeliveryMonitor(alert_after_ms, clock == "processingTime")
    keyed = rows.where(not_null(["id"])).withColumns(
        {"bucket": F.pmod(F.xxhash64("id"), F.lit(buckets)), "time": F.coalesce("time", F.lit(P.NO_TIME))}
    )
    return keyed.groupBy("bucket").transformWithStateInPandas(machine, P.MONITOR_OUTPUT, "append", clock)


def reassembly_stream(
    parts: DataFrame, expire_after_ms: int = 60_000, clock: str = "eventTime"
) -> DataFrame:
    """Ready messages, and the parts of expired ones; ``clock`` as for ``monitor_stream``."""
    machine = P.Reassembly(expire_after_ms, clock == "processingTime")
    keyed = parts.where(not_null(["key"]))
    return keyed.groupBy("key").transformWithState(machine, P.REASSEMBLY_OUTPUT, "append", clock)


def sliding_stream(stream: DataFrame, span_ms: int) -> DataFrame:
    """Record-aligned sliding counts; ``stream`` has key, ts_ms and the watermarked ``ts``."""
    return stream.where(not_null(["key"])).groupBy("key").transformWithStateInPandas(
        P.SlidingCounts(span_ms), P.SLIDING_OUTPUT, "append", "eventTime"
    )


def asof_stream(
    both: DataFrame,
    key: str,
    order: str,
    values: Sequence[str],
    how: str = "inner",
    tombstone: str | None = None,
) -> DataFrame:
    """The as-of join of a feed of events and table updates (``is_update``) in one stream.

    ``both`` is watermarked on ``order`` taken as milliseconds, see ``in_order``. Rows wait until the
    watermark has passed them, so the result does not depend on how they fall into
    micro-batches. ``asof_batches`` waits for nothing and splits hot keys, for feeds in order.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"as-of join is inner or left, not {how!r}")
    timed = both.where(not_null([key]))
    types = {f.name: f.dataType.simpleString() for f in both.schema.fields}

    def layout(names: Sequence[str]) -> str:
        return ", ".join(f"`{name}` {types[name]}" for name in names)

    columns = [c for c in both.columns if c not in (key, "ts")]
    events = [c for c in columns if c not in ("is_update", *values)]
    machine = P.AsOf(
        columns, layout(columns), list(values), layout(values), order, events, key, how, tombstone
    )
    output = layout([key, *events, *values])
    return timed.groupBy(key).transformWithState(machine, output, "append", "eventTime")


def in_order(stream: DataFrame, order: str, disorder: int) -> DataFrame:
    """Watermark a stream on a whole-number position: no row comes after one whose ``order`` is
    larger by more than ``disorder``."""
    return with_event_time(stream, field_time(F.col(order)), f"{disorder} milliseconds")


@dataclass(frozen=True)
class Replay:
    """A finite feed as a stream whose results do not depend on how its files fall into batches.

    Files of a table come in no order of time, so the watermark of ``stream`` stays behind all rows
    until the feed is over; ``close`` then adds a record that moves it to the largest time. A live
    feed has a lateness of its own instead, as large as its real disorder.
    """

    stream: DataFrame
    work: str
    closing: DataFrame | None

    def close(self) -> None:
        if self.closing is not None:
            self.closing.write.mode("append").parquet(f"{self.work}/closing")

    def run(self, start: Callable[[], StreamingQuery]) -> None:
        """Run the query that ``start`` starts to the end of the feed, and once more to close it."""
        start().awaitTermination()
        self.close()
        start().awaitTermination()


def replay(
    stream: DataFrame, feed: DataFrame, time: str, work: str, /, **closing: object
) -> Replay:
    """``stream`` for a replay; ``feed`` has the same rows as a table. ``time`` is the event time in
    milliseconds, or another whole number to go by. ``closing`` gives the values of the closing
    record, at least the keys; it lies behind all others and so in no result."""
    first, last = feed.agg(F.min(time), F.max(time)).first()
    lateness = 0 if first is None else last - first + 1
    values = {**closing, time: None if first is None else last + lateness}
    record = stream.sparkSession.range(1).select(
        *[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in stream.schema.fields]
    )
    record.limit(0).write.mode("append").parquet(f"{work}/closing")
    more = file_feed(stream.sparkSession, f"{work}/closing", stream.schema, streaming=True)
    both = in_order(stream.unionByName(more), time, lateness)
    return Replay(both, work, None if first is None else record)


def replay_to_files(spark: SparkSession, feed: Replay, stream: DataFrame) -> DataFrame:
    """Run ``stream``, made of a replay, to its end and read back what it wrote."""
    out, checkpoint = f"{feed.work}/out", f"{feed.work}/checkpoint"
    feed.run(lambda: write_files(stream, out, checkpoint))
    return spark.read.schema(stream.schema).parquet(out)


def asof_batches(
    root: str,
    keys: Sequence[str],
    order: str,
    values: Sequence[str],
    snapshot_every: int = 50,
    **how,
) -> Callable[[DataFrame, int], None]:
    """Batch action for a feed of events and table updates (``is_update``) in one stream.

    Each micro-batch is an as-of join of its events with its own updates and the table as the
    batches before left it, so hot keys are split as in batch. The table is a change log: each
    batch adds the latest update per key, every ``snapshot_every``-th the whole table, so
    reading goes back to the last snapshot only. Output and log of a batch are overwritten
    when it is repeated.
    """

    def act(rows: DataFrame, batch_id: int) -> None:
        columns = [*keys, order, *values]
        updates = rows.where("is_update").select(*columns)
        events = rows.where("NOT is_update").drop("is_update", *values)
        log, changes = f"{root}/table", latest_by_key(updates, keys, [order])
        known = None
        if batch_id > 0:
            since = (batch_id - 1) // snapshot_every * snapshot_every
            known = read_log(
                rows.sparkSession, log, updates.schema, keys, [order], range(since, batch_id)
            ).select(*columns)
            if batch_id % snapshot_every == 0:
                changes = latest_by_key(changes.unionByName(known), keys, [order])
        changes.write.mode("overwrite").parquet(f"{log}/batch={batch_id}")
        if known is not None:
            needed = known.join(events.select(*keys).distinct(), list(keys), "left_semi")
            updates = updates.unionByName(needed)
        met = asof_join(events, updates, keys, order, values, **how)
        met.write.mode("overwrite").parquet(f"{root}/out/batch={batch_id}")

    return act


def with_store(
    stream: DataFrame,
    keys: Sequence[str],
    fold: Callable[[tuple, Iterator, Any], Iterator],
    output: str,
    layout: str,
    kind: str = "value",
    map_layout: str | None = None,
    ttl_ms: int | None = None,
) -> DataFrame:
    """A user function per key and micro-batch with a store of its own that lasts.

    ``fold(key, frames, store)`` takes pandas frames and gives frames of the layout ``output``; it may not
    rely on an order of rows. ``store`` is a state of ``kind`` value or list, of rows of ``layout``, or
    map, from rows of ``layout`` to rows of ``map_layout``. ``ttl_ms``, on the wall clock, bounds how long entries last.
    """
    if kind not in ("value", "list", "map") or (kind == "map") != (map_layout is not None):
        raise ValueError("a store is a value, a list, or a map with a layout of its values")
    machine = P.StoreFold(fold, kind, layout, map_layout, ttl_ms)
    clock = "none" if ttl_ms is None else "processingTime"
    keyed = stream.where(not_null(keys)).groupBy(*keys)
    return keyed.transformWithStateInPandas(machine, output, "append", clock)


def last_seen_stream(stream: DataFrame) -> DataFrame:
    """Per key and micro-batch: the count and latest record its store holds after it."""
    return with_store(stream, ["key"], P.last_seen, P.STORE_OUTPUT, P.STORE_STATE)


def seen_types_stream(stream: DataFrame) -> DataFrame:
    """Per key and micro-batch: how often each of its types came so far, and when first."""
    return with_store(
        stream, ["key"], P.seen_types, P.TYPES_OUTPUT, "type STRING", "map", "n BIGINT, first_arrival BIGINT"
    )


def stream_time_stream(
    stream: DataFrame, partition: str, order: Sequence[str], ts: str, name: str = "stream_time"
) -> DataFrame:
    """``with_stream_time`` on a feed whose micro-batches come in order: the largest ``ts`` that the source
    partition had seen when a row came. Unlike a watermark it is one for each partition and moves with
    every row, so a filter on it drops the same rows however they fall into micro-batches."""
    machine = P.StreamTime(list(order), ts, name, [*stream.columns, name])
    layout = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema.fields)
    return stream.where(not_null([partition])).groupBy(partition).transformWithStateInPandas(
        machine, f"{layout}, `{name}` BIGINT", "append", "none"
    )


def lookup_batches(
    root: str, log: str, layout: str, keys: Sequence[str], order: Sequence[str], values: Sequence[str], how: str = "left"
) -> Callable[[DataFrame, int], None]:
    """Batch action: records with the row of their key in a table that changes while the stream runs.

    The table is a change log (``log_changes``) that something else writes, rows of ``layout``. A micro-batch sees
    the changes that were there when it first ran, and the same ones when it is repeated: which ones
    is written down ahead of its output. The lookup replicates the table while that is small.
    """

    def act(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        noted = f"{root}/versions/batch={batch_id}"
        if not exists(spark, noted):
            changes = spark.read.schema(f"{layout}, batch BIGINT").parquet(log) if exists(spark, log) else None
            last = changes.agg(F.max("batch")).first()[0] if changes is not None else None
            spark.createDataFrame([(-1 if last is None else last,)], "version BIGINT").write.mode("overwrite").parquet(noted)
        version = spark.read.parquet(noted).first().version
        known = spark.createDataFrame([], layout)
        if version >= 0:
            known = read_log(spark, log, known.schema, keys, order, range(version + 1))
        met = lookup(rows, known.select(*keys, *values), keys, how)
        met.write.mode("overwrite").parquet(f"{root}/out/batch={batch_id}")

    return act


def run_to_files(spark: SparkSession, stream: DataFrame, work: str) -> DataFrame:
    """Run a stream over all that is available and read back what it wrote."""
    schema = stream.schema
    write_files(stream, f"{work}/out", f"{work}/checkpoint").awaitTermination()
    return spark.read.schema(schema).parquet(f"{work}/out")


def stored_state(spark: SparkSession, checkpoint: str, **options) -> DataFrame:
    """The state of a stream as a table: key and value structs as of its last commit.

    Options are those of the state source, as ``batchId``; a state machine also needs a ``stateVarName``.
    """
    return spark.read.format("statestore").options(**options).load(checkpoint)


def stored_list(spark: SparkSession, checkpoint: str, name: str, **options) -> DataFrame:
    """A row for each entry of a list that a state machine holds, with its key's columns."""
    held = stored_state(spark, checkpoint, stateVarName=name, **options)
    return held.select("key.*", "list_element.*")


def stored_timers(spark: SparkSession, checkpoint: str, name: str = "due", **options) -> DataFrame:
    """The timers that a state machine waits for, with their key's columns."""
    held = stored_state(spark, checkpoint, readRegisteredTimers="true", **options)
    return held.select("key.*", F.col("expiration_timestamp_ms").alias(name))


def monitor_records(spark: SparkSession, checkpoint: str, **options) -> DataFrame:
    """A row for each record that a monitor holds: its bucket, id, ``due``, until when its message waits, and content."""
    blocks = stored_list(spark, checkpoint, "records", **options)
    return blocks.select("bucket", F.inline(F.arrays_zip(*P.RECORD_FIELDS)))


def state_changes(spark: SparkSession, checkpoint: str, since: int = 0, **options) -> DataFrame:
    """What each micro-batch from ``since`` on wrote to the state: batch_id, change_type (update or delete), key, value."""
    return stored_state(spark, checkpoint, readChangeFeed="true", changeStartBatchId=str(since), **options)
