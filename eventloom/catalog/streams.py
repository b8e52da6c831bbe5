"""Queries that run a stream over the tables to its end and return what it wrote.

A table is replayed whatever the order of its files (``replay``). At the end the watermark is at
the largest event time, so windows and timers up to it are closed; the SQL says so.
"""

from pyspark.sql import functions as F

from eventloom.catalog import bindings as B
from eventloom.catalog.aggregates import COUNTS
from eventloom.catalog.bindings import EVENTS, HOUR_MS, PARTS, RECEIVED, SENT, SLOW_PARTS, STATUS
from eventloom.catalog.jobs import STATE, expired_sql, ready_in_time_sql
from eventloom.catalog.joins import ACTIVE, JOINED_OBJECTS, joined_objects
from eventloom.catalog.registry import SQL, query
from eventloom.catalog.sources import ENCODED, order_changes
from eventloom.catalog.windows import GAP, ORDER, SESSIONS, SIZE, in_disorder, sliding_sql
from eventloom.operators.changelog import latest_by_key
from eventloom.operators.windows import tumbling, tumbling_end
from eventloom.schemas import TABLES
from eventloom.session import work_dir
from eventloom.sources.feeds import file_feed, write_in_stages
from eventloom.sources.sinks import (
    for_each_batch,
    log_changes,
    read_child,
    read_log,
    split_sink,
    topic_rows,
    write_files,
)
from eventloom.streaming.flows import (
    asof_batches,
    asof_stream,
    first_occurrence_stream,
    in_order,
    last_seen_stream,
    lookup_batches,
    monitor_records,
    monitor_stream,
    reassembly_stream,
    replay,
    replay_to_files,
    run_to_files,
    running_max_batches,
    seen_types_stream,
    session_stream,
    sliding_stream,
    state_changes,
    stored_state,
    stored_timers,
    stream_time_stream,
)
from eventloom.streaming.held import InOrder, running_batches

FILES_PER_BATCH = 1000
MAX_TS = f"(SELECT MAX(ts_ms) FROM {EVENTS})"


def _stream(spark, sf_dir, name):
    path = f"{sf_dir}/{name}.parquet"
    return file_feed(spark, path, TABLES[name], streaming=True, max_files_per_batch=FILES_PER_BATCH)


def _replay_events(spark, sf_dir, label):
    stream = B.shape_events(_stream(spark, sf_dir, "events"))
    return replay(stream, B.events(spark, sf_dir), "ts_ms", work_dir(spark, label), key=-1)


@query("src_earliest", "SELECT event_id, user_id, event_type FROM events")
def src_earliest(spark, sf_dir):
    stream = _stream(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return run_to_files(spark, stream, work_dir(spark, "src_earliest"))


@query("sink_topic", f"SELECT user_id::VARCHAR AS key, {ENCODED} AS value FROM events")
def sink_topic(spark, sf_dir):
    rows = _stream(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", F.lit(None).cast("string").alias("note")
    )
    return run_to_files(spark, topic_rows(rows, "user_id"), work_dir(spark, "sink_topic"))


@query("sink_foreach", "SELECT event_id, event_type FROM events WHERE value > 10")
def sink_foreach(spark, sf_dir):
    work = work_dir(spark, "sink_foreach")
    rows = _stream(spark, sf_dir, "events").where(F.col("value") > 10).select("event_id", "event_type")
    for_each_batch(rows, log_changes(f"{work}/out"), f"{work}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{work}/out").drop("batch")


def _monitor_rows(orders):
    """The three delivery feeds in one layout."""
    messages = B.shape_messages(orders)
    received = B.received_rows(messages).select(
        "id",
        F.lit("received").alias("feed"),
        F.lit(None).cast("string").alias("provider_id"),
        F.lit(None).cast("string").alias("ext_message_id"),
        F.lit(None).cast("string").alias("status"),
        F.col("received_time").alias("time"),
    )

    def later(feed, name, time):
        return feed.select(
            "id", F.lit(name).alias("feed"), "provider_id", "ext_message_id", "status",
            F.col(time).alias("time"),
        )

    return received.unionByName(later(B.sent_rows(messages), "sent", "sent_time")).unionByName(
        later(B.status_rows(messages), "status", "status_time")
    )


def outcomes(spark, sf_dir, label):
    """Run the monitor once, alerts and completed messages to tables of their own."""
    work = work_dir(spark, label)
    stream = _monitor_rows(_stream(spark, sf_dir, "orders"))
    table = _monitor_rows(B.table(spark, sf_dir, "orders"))
    feed = replay(stream, table, "time", work, id="closing", feed="received")
    children = {name: F.col("outcome") == name for name in ("complete", "alert")}
    found = monitor_stream(feed.stream)
    sink = split_sink(children, f"{work}/out")
    feed.run(lambda: for_each_batch(found, sink, f"{work}/checkpoint"))
    return {name: read_child(spark, f"{work}/out", name, found.schema) for name in children}


_OUTCOMES = f"""(SELECT CASE WHEN counter >= 2 THEN 'complete' ELSE 'alert' END AS outcome, s.*
  FROM {STATE} s, (SELECT greatest((SELECT MAX(arrival) FROM {RECEIVED}),
    (SELECT MAX(arrival) FROM {SENT}), (SELECT MAX(arrival) FROM {STATUS})) AS reached)
  WHERE CASE WHEN counter >= 2 THEN greatest(sent_status_time, dr_status_time)
    ELSE seen + 120000 END < reached)"""


@query("sink_processor", f"SELECT id, outcome FROM {_OUTCOMES}")
def sink_processor(spark, sf_dir):
    child = outcomes(spark, sf_dir, "sink_processor")
    return child["complete"].unionByName(child["alert"]).select("id", "outcome")


@query("stateful_processor", f"SELECT * FROM {_OUTCOMES} WHERE outcome='complete'")
def stateful_processor(spark, sf_dir):
    return outcomes(spark, sf_dir, "stateful_processor")["complete"]


@query("timers", f"SELECT * FROM {_OUTCOMES} WHERE outcome='alert'")
def timers(spark, sf_dir):
    return outcomes(spark, sf_dir, "timers")["alert"]


@query(
    "lookup_state_store",
    f"""SELECT key, COUNT(*) AS n, MAX(arrival) AS last_arrival, arg_max(type, arrival) AS last_type
    FROM {EVENTS} GROUP BY key""",
)
def lookup_state_store(spark, sf_dir):
    """Each micro-batch sends what the store holds after it; the last of each key is its end."""
    stream = B.shape_events(_stream(spark, sf_dir, "events")).select("key", "arrival", "type")
    stored = run_to_files(spark, last_seen_stream(stream), work_dir(spark, "lookup_state_store"))
    return latest_by_key(stored, ["key"], ["n"])


@query(
    "lookup_state_store_map",
    f"SELECT key, type, COUNT(*) AS n, MIN(arrival) AS first_arrival FROM {EVENTS} GROUP BY key, type",
)
def lookup_state_store_map(spark, sf_dir):
    """A map store of which each micro-batch reads and writes only the entries of its rows."""
    stream = B.shape_events(_stream(spark, sf_dir, "events")).select("key", "arrival", "type")
    stored = run_to_files(spark, seen_types_stream(stream), work_dir(spark, "lookup_state_store_map"))
    return latest_by_key(stored, ["key", "type"], ["n"])


STAGES = 4
# Views and errors change the table of a stage before its other events come.
_STAGED = f"(SELECT *, arrival * {STAGES} // (SELECT MAX(arrival) + 1 FROM {EVENTS}) AS stage FROM {EVENTS})"


@query(
    "lookup_global_stream",
    f"""SELECT e.key, e.arrival, e.type, arg_max(v.ts_ms, v.arrival) AS view_ms
    FROM (SELECT * FROM {_STAGED} WHERE type NOT IN ('view','error')) e
    LEFT JOIN (SELECT key, arrival, ts_ms, stage FROM {_STAGED} WHERE type = 'view') v
      ON v.key = e.key AND v.stage <= e.stage GROUP BY ALL""",
)
def lookup_global_stream(spark, sf_dir):
    """A global table that gets changes between micro-batches; a batch sees those that came before it."""
    work = work_dir(spark, "lookup_global_stream")
    e = B.events(spark, sf_dir).select("key", "ts_ms", "arrival", "type")
    last = e.agg(F.max("arrival")).first()[0] or 0
    layout = "key BIGINT, arrival BIGINT, view_ms BIGINT"
    change = log_changes(f"{work}/log")
    look_up = lookup_batches(work, f"{work}/log", layout, ["key"], ["arrival"], ["view_ms"])
    others = e.where(~F.col("type").isin("view", "error")).select("key", "arrival", "type")
    stream = file_feed(spark, f"{work}/feed", others.schema, streaming=True, max_files_per_batch=1)
    for stage in range(STAGES):
        own = F.expr(f"arrival * {STAGES} div {last + 1} = {stage}")
        change(e.where(own & (F.col("type") == "view")).select("key", "arrival", F.col("ts_ms").alias("view_ms")), stage)
        others.where(own).coalesce(1).write.mode("append").parquet(f"{work}/feed")
        for_each_batch(stream, look_up, f"{work}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{work}/out").drop("batch")


@query("lookup_running_max_stream", SQL["lookup_running_max"])
def lookup_running_max_stream(spark, sf_dir):
    """One query keeps the largest time of each key, another reads its state."""
    work = work_dir(spark, "lookup_running_max_stream")
    rows = B.shuffled(B.events(spark, sf_dir)).select("key", "arrival", "late_arrival", "ts_ms")
    write_in_stages(rows, "late_arrival", STAGES, f"{work}/feed")
    stream = file_feed(spark, f"{work}/feed", rows.schema, streaming=True, max_files_per_batch=1)
    tops = stream.groupBy("key").agg(F.max("ts_ms").alias("max"))
    for_each_batch(tops, log_changes(f"{work}/tops"), f"{work}/one", "update").awaitTermination()
    lift = running_max_batches(work, f"{work}/one", ["key"], ORDER, "ts_ms")
    for_each_batch(stream, lift, f"{work}/two").awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{work}/out").select(rows.columns)


@query("late_drop_stream", SQL["late_drop"])
def late_drop_stream(spark, sf_dir):
    """Stream time per source partition, carried from micro-batch to micro-batch, in six of them."""
    work = work_dir(spark, "late_drop_stream")
    rows = in_disorder(spark, sf_dir)
    write_in_stages(rows, "late_arrival", 6, f"{work}/feed")
    stream = file_feed(spark, f"{work}/feed", rows.schema, streaming=True, max_files_per_batch=1)
    timed = stream_time_stream(stream, "source", ORDER, "ts_ms")
    kept = timed.where(tumbling_end("ts_ms", SIZE) > F.col("stream_time")).drop("stream_time")
    return run_to_files(spark, kept, work)


@query("state_read", f"SELECT key, COUNT(*) AS n FROM {EVENTS} GROUP BY key")
def state_read(spark, sf_dir):
    work = work_dir(spark, "state_read")
    counts = B.shape_events(_stream(spark, sf_dir, "events")).groupBy("key").count()
    for_each_batch(counts, log_changes(f"{work}/log"), f"{work}/checkpoint", "update").awaitTermination()
    state = stored_state(spark, f"{work}/checkpoint")
    return state.select(F.col("key.key").alias("key"), F.col("value.count").alias("n"))


@query(
    "state_timers",
    f"""SELECT id, received_time, CASE WHEN counter >= 2 THEN greatest(sent_status_time, dr_status_time)
      ELSE seen + 120000 END + 1 AS due FROM {STATE}""",
)
def state_timers(spark, sf_dir):
    """Messages that the monitor still waits for before its feed is closed, and until when."""
    work = work_dir(spark, "state_timers")
    stream = _monitor_rows(_stream(spark, sf_dir, "orders"))
    feed = replay(stream, _monitor_rows(B.table(spark, sf_dir, "orders")), "time", work, id="closing", feed="received")
    write_files(monitor_stream(feed.stream), f"{work}/out", f"{work}/checkpoint").awaitTermination()
    records = monitor_records(spark, f"{work}/checkpoint").where("feed = 'received'")
    first = records.groupBy("bucket", "id").agg(F.min("time").alias("received_time"), F.min("due").alias("due"))
    # The timer of a bucket is that of its next message.
    timers = stored_timers(spark, f"{work}/checkpoint", "next")
    return first.join(timers, "bucket").where("due >= next").select("id", "received_time", "due")


@query("state_changes", f"SELECT key, COUNT(*) AS n FROM {EVENTS} GROUP BY key")
def state_changes_query(spark, sf_dir):
    """Counts as the last change of each key in the change feed of a stream's state."""
    work = work_dir(spark, "state_changes")
    rows = B.events(spark, sf_dir).select("key", "arrival")
    write_in_stages(rows, "arrival", 3, f"{work}/feed")
    stream = file_feed(spark, f"{work}/feed", rows.schema, streaming=True, max_files_per_batch=1)
    counts = stream.groupBy("key").count()
    for_each_batch(counts, log_changes(f"{work}/log"), f"{work}/checkpoint", "update").awaitTermination()
    changes = state_changes(spark, f"{work}/checkpoint").where("change_type = 'update'")
    last = changes.groupBy(F.col("key.key").alias("key")).agg(F.max_by("value.count", "batch_id").alias("n"))
    return last


@query("count_by_key_stream", f"SELECT key, COUNT(*) AS n FROM {EVENTS} GROUP BY key HAVING COUNT(*) > 1")
def count_by_key_stream(spark, sf_dir):
    """Update mode: each micro-batch logs its new counts, the table is the latest of each key."""
    work = work_dir(spark, "count_by_key_stream")
    counts = (
        B.shape_events(_stream(spark, sf_dir, "events"))
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )
    for_each_batch(counts, log_changes(f"{work}/log"), f"{work}/checkpoint", "update").awaitTermination()
    return read_log(spark, f"{work}/log", counts.schema, ["key"], [])


@query("cdc_materialize_stream", SQL["cdc_materialize"])
def cdc_materialize_stream(spark, sf_dir):
    work = work_dir(spark, "cdc_materialize_stream")
    changes = order_changes(_stream(spark, sf_dir, "orders"))
    append = log_changes(f"{work}/log")

    def write(rows, batch):
        append(latest_by_key(rows, ["key"], ["arrival"]), batch)

    for_each_batch(changes, write, f"{work}/checkpoint").awaitTermination()
    kept = read_log(spark, f"{work}/log", changes.schema, ["key"], ["arrival"])
    return kept.where(F.col("row").isNotNull()).select("key", "arrival", "row.*")


@query(
    "win_tumbling_stream",
    f"SELECT * FROM ({SQL['win_tumbling']}) WHERE window_end <= {MAX_TS}",
)
def win_tumbling_stream(spark, sf_dir):
    feed = _replay_events(spark, sf_dir, "win_tumbling_stream")
    return replay_to_files(spark, feed, tumbling(feed.stream, ["key"], "ts", SIZE))


# One event of eleven is held up by half the feed; micro-batches are stretches of what is left.
DELAYED_STAGES = 6
DAY_MS = 24 * HOUR_MS
DELAYED = f"""(SELECT *, delayed * {DELAYED_STAGES} // (MAX(delayed) OVER () + 1) AS stage FROM (
  SELECT *, arrival + CASE WHEN arrival % 11 = 0 THEN (SELECT MAX(arrival) + 1 FROM {EVENTS}) // 2 ELSE 0 END AS delayed
  FROM {EVENTS}))"""


def _watermark_sql(top, back):
    """The watermark, a day behind, that micro-batch ``stage`` has, or had ``back`` batches before; NULL if none yet."""
    return f"""(SELECT CASE WHEN {top} > {DAY_MS} THEN {top} - {DAY_MS} END FROM {DELAYED} w WHERE w.stage < d.stage - {back})"""


def _delayed(spark, sf_dir, work):
    """The feed with held-up events as a stream with a watermark a day behind, a micro-batch for each stage."""
    e = B.events(spark, sf_dir).select("key", "ts_ms", "arrival", "type")
    half = ((e.agg(F.max("arrival")).first()[0] or 0) + 1) // 2
    feed = e.withColumn("delayed", F.col("arrival") + F.when(F.col("arrival") % 11 == 0, half).otherwise(0))
    write_in_stages(feed, "delayed", DELAYED_STAGES, f"{work}/feed")
    stream = file_feed(spark, f"{work}/feed", feed.schema, streaming=True, max_files_per_batch=1)
    return in_order(stream, "ts_ms", DAY_MS)


_END = f"(ts_ms - ts_ms % {SIZE} + {SIZE})"


@query(
    "win_tumbling_late_stream",
    f"""SELECT key, {_END} - {SIZE} AS window_start, {_END} AS window_end, COUNT(*) AS counter FROM {DELAYED} d
    WHERE COALESCE({_END} > {_watermark_sql("MAX(w.ts_ms)", 1)}, true) AND {_END} <= {MAX_TS} - {DAY_MS} GROUP BY ALL""",
)
def win_tumbling_late_stream(spark, sf_dir):
    """Windows as they are closed by the watermark; an event whose window the batch before has closed is dropped."""
    work = work_dir(spark, "win_tumbling_late_stream")
    return run_to_files(spark, tumbling(_delayed(spark, sf_dir, work), ["key"], "ts", SIZE), work)


# Each side of the join has a watermark of its own, and the lower one holds.
_SIDES = "least(MAX(w.ts_ms) FILTER (w.type = 'click'), MAX(w.ts_ms) FILTER (w.type = 'purchase'))"
_IN_TIME = f"(SELECT * FROM {DELAYED} d WHERE COALESCE(ts_ms > {_watermark_sql(_SIDES, 1)}, true))"


@query("join_interval_late_stream", JOINED_OBJECTS.replace(EVENTS, _IN_TIME))
def join_interval_late_stream(spark, sf_dir):
    """Pairs of what comes in time; an event behind the watermark of the batch before meets nothing."""
    work = work_dir(spark, "join_interval_late_stream")
    return run_to_files(spark, joined_objects(_delayed(spark, sf_dir, work)), work)


def _late_sessions_sql(gap):
    """Sessions as each micro-batch merges its events with the open ones, those closed by the watermark of the batch gone."""

    def mark(stage):
        return f"COALESCE((SELECT MAX(ts_ms) - {DAY_MS} FROM delayed WHERE stage < {stage}), 0)"

    def merged(parts):
        return f"""(SELECT key, MIN(a) AS a, MAX(b) AS b, SUM(n)::BIGINT AS n FROM (
          SELECT *, SUM(fresh) OVER (PARTITION BY key ORDER BY a, b) AS island FROM (SELECT *, CASE WHEN a < MAX(b) OVER (
            PARTITION BY key ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + {gap} THEN 0 ELSE 1 END AS fresh
          FROM ({parts}))) GROUP BY key, island)"""

    steps, sent = [f"delayed AS MATERIALIZED (SELECT * FROM {DELAYED})"], []
    for i in range(DELAYED_STAGES):
        parts = f"""SELECT key, ts_ms AS a, ts_ms AS b, 1 AS n FROM delayed
          WHERE stage = {i} AND ts_ms + {gap} > {mark(i - 1)}"""
        if i:
            parts += f" UNION ALL SELECT * FROM s{i - 1} WHERE b + {gap} > {mark(i - 1)}"
        steps.append(f"s{i} AS MATERIALIZED {merged(parts)}")
        sent.append(f"SELECT * FROM s{i} WHERE b + {gap} <= {mark(i)}")
    sent.append(f"SELECT * FROM s{i} WHERE b + {gap} > {mark(i)} AND b + {gap} <= {mark(i + 1)}")
    return f"""WITH {", ".join(steps)}
      SELECT key, a AS window_start, b AS window_end, n AS counter FROM ({" UNION ALL ".join(sent)})"""


@query("win_session_late_stream", _late_sessions_sql(3 * GAP))
def win_session_late_stream(spark, sf_dir):
    """Sessions as they are closed by the watermark; what one that is gone would have joined starts another."""
    work = work_dir(spark, "win_session_late_stream")
    return run_to_files(spark, session_stream(_delayed(spark, sf_dir, work), ["key"], 3 * GAP), work)


@query(
    "win_session_stream",
    f"SELECT * FROM {SESSIONS} WHERE window_end + {GAP} <= {MAX_TS}",
)
def win_session_stream(spark, sf_dir):
    feed = _replay_events(spark, sf_dir, "win_session_stream")
    return replay_to_files(spark, feed, session_stream(feed.stream, ["key"], GAP))


@query("win_sliding_stream", f"SELECT * FROM ({sliding_sql(EVENTS)}) WHERE window_end < {MAX_TS}")
def win_sliding_stream(spark, sf_dir):
    feed = _replay_events(spark, sf_dir, "win_sliding_stream")
    stream = feed.stream.select("key", "ts_ms", "ts")
    return replay_to_files(spark, feed, sliding_stream(stream, SIZE))


@query("join_interval_stream", JOINED_OBJECTS)
def join_interval_stream(spark, sf_dir):
    feed = _replay_events(spark, sf_dir, "join_interval_stream")
    return replay_to_files(spark, feed, joined_objects(feed.stream))


def _events_and_updates(feed):
    """Events, and page views as updates of a table, in one feed."""
    e, views = B.events_and_views(feed)
    return e.withColumn("is_update", F.lit(False)).unionByName(
        views.withColumn("is_update", F.lit(True)), allowMissingColumns=True
    )


@query(
    "join_stream_table_stream",
    f"SELECT * FROM ({ACTIVE}) WHERE arrival < (SELECT MAX(arrival) FROM {EVENTS})",
)
def join_stream_table_stream(spark, sf_dir):
    work = work_dir(spark, "join_stream_table_stream")
    stream = _events_and_updates(B.shape_events(_stream(spark, sf_dir, "events")))
    rows = _events_and_updates(B.events(spark, sf_dir))
    feed = replay(stream, rows, "arrival", work, key=-1, is_update=True)
    met = asof_stream(feed.stream, "key", "arrival", ["view_ms"], tombstone="view_ms")
    return replay_to_files(spark, feed, met.where(F.col("ts_ms") > F.col("view_ms")))


# ``late_arrival`` is at most so much later than ``arrival``.
DISORDER = 49


def _in_order(spark, feed, work, act):
    """Run ``act`` over a table in order of ``arrival``, as a stream that comes in order of ``late_arrival``."""
    write_in_stages(feed, "late_arrival", STAGES, f"{work}/feed")
    stream = file_feed(spark, f"{work}/feed", feed.schema, streaming=True, max_files_per_batch=1)
    ordered = InOrder(f"{work}/held", "arrival", DISORDER, act)
    for_each_batch(stream, ordered, f"{work}/checkpoint").awaitTermination()
    ordered.close(spark, feed.schema)


@query("count_updates_stream", COUNTS)
def count_updates_stream(spark, sf_dir):
    """Counts in order of arrival of a feed in disorder, carried in tables, so that hot keys are split."""
    work = work_dir(spark, "count_updates_stream")
    feed = B.shuffled(B.events(spark, sf_dir)).select("key", "arrival", "late_arrival")
    _in_order(spark, feed, work, running_batches(work, ["key"], ["arrival"], {"n": ("sum", F.lit(1))}))
    counted = spark.read.schema("key BIGINT, arrival BIGINT, n BIGINT").parquet(f"{work}/out")
    return counted.drop("batch").where(F.col("n") > 1)


@query("join_stream_table_split_stream", ACTIVE)
def join_stream_table_split_stream(spark, sf_dir):
    """The as-of join of a feed in disorder with its table in a change log, so that hot keys are split."""
    work = work_dir(spark, "join_stream_table_split_stream")
    feed = _events_and_updates(B.events(spark, sf_dir))
    feed = feed.withColumn("late_arrival", F.col("arrival") + F.col("arrival") * 7919 % 50)
    _in_order(spark, feed, work, asof_batches(work, ["key"], "arrival", ["view_ms"], tombstone="view_ms"))
    layout = "key BIGINT, ts_ms BIGINT, arrival BIGINT, type STRING, view_ms BIGINT"
    return spark.read.schema(layout).parquet(f"{work}/out").drop("batch").where(F.col("ts_ms") > F.col("view_ms"))


@query("first_occurrence_stream", f"SELECT DISTINCT key, type FROM {EVENTS}")
def first_seen_stream(spark, sf_dir):
    stream = B.shape_events(_stream(spark, sf_dir, "events")).select("key", "type")
    seen = first_occurrence_stream(stream, ["key", "type"])
    return run_to_files(spark, seen, work_dir(spark, "first_occurrence_stream"))


def _expiry_sql(feed):
    """What a stream has sent when its closing record, at the last time of the feed, has passed."""
    last = f"(SELECT MAX(sent_time) FROM {feed})"
    return f"""SELECT key, NULL::SMALLINT AS ind, id, provider_id, text, full_message, sent_time
      FROM ({ready_in_time_sql(feed)}) WHERE completed_at < {last}
    UNION ALL SELECT key, ind, id, provider_id, text, full_message, sent_time FROM ({expired_sql(feed, last)})"""


@query("udhi_expire_stream", _expiry_sql(PARTS))
def udhi_expire_stream(spark, sf_dir):
    sizes = B.message_sizes(B.table(spark, sf_dir, "conversations"))
    stream = B.shape_parts(_stream(spark, sf_dir, "conversations"), sizes)
    work = work_dir(spark, "udhi_expire_stream")
    feed = replay(stream, B.parts(spark, sf_dir), "sent_time", work, key="closing")
    return replay_to_files(spark, feed, reassembly_stream(feed.stream))


@query("udhi_expire_restart_stream", _expiry_sql(SLOW_PARTS))
def udhi_expire_restart_stream(spark, sf_dir):
    sizes = B.message_sizes(B.table(spark, sf_dir, "conversations"))
    stream = B.slow_parts(B.shape_parts(_stream(spark, sf_dir, "conversations"), sizes))
    work = work_dir(spark, "udhi_expire_restart_stream")
    feed = replay(stream, B.slow_parts(B.parts(spark, sf_dir)), "sent_time", work, key="closing")
    return replay_to_files(spark, feed, reassembly_stream(feed.stream))
