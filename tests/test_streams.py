"""Streams over several micro-batches: late rows, timers, repeated batches, and parity with batch."""

import os
import random
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.catalog import load, streams
from eventloom.functions.eventtime import field_time, with_event_time
from eventloom.operators import running
from eventloom.operators.joins import asof_join, interval_join
from eventloom.operators.windows import drop_late, session, sliding, tumbling, tumbling_end
from eventloom.plans import monitoring
from eventloom.schemas import TOPIC_RECORD
from eventloom.sources.feeds import feeds_by_pattern, file_feed, file_feeds_by_pattern, kafka_options, write_in_stages
from eventloom.sources.sinks import compact_log, for_each_batch, log_changes, read_child, read_log, split_sink, write_files
from eventloom.streaming import flows, held
from oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"

EVENT = "key BIGINT, ts_ms BIGINT, arrival BIGINT"


def write_batches(spark, path, schema, *batches):
    """One file per micro-batch, taken in the order of their times."""
    for i, data in enumerate(batches):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").json(path, ignoreNullFields=False)
        for name in os.listdir(path):
            full = os.path.join(path, name)
            if name.endswith(".json") and os.path.getmtime(full) > 2e8:
                os.utime(full, (1e8 + i, 1e8 + i))


def stream(spark, path, schema, ts="ts_ms", lateness="0 seconds"):
    layout = schema if isinstance(schema, T.StructType) else spark.createDataFrame([], schema).schema
    feed = file_feed(spark, path, layout, "json", streaming=True, max_files_per_batch=1)
    return with_event_time(feed, field_time(F.col(ts)), lateness) if ts else feed


def test_tumbling_late(spark, work, rows):
    """A row behind the watermark of the batch before is dropped; one inside the lateness is counted."""
    write_batches(
        spark, work + "/in", EVENT,
        [(1, 500, 1), (1, 4500, 2)], [(1, 4550, 3)], [(1, 700, 4), (1, 4600, 5)], [(1, 20_000, 6)],
    )
    strict = tumbling(stream(spark, work + "/in", EVENT), ["key"], "ts", 1000)
    got = flows.run_to_files(spark, strict, work + "/a")
    assert rows(got) == [(1, 0, 1000, 1), (1, 4000, 5000, 3)]
    loose = tumbling(stream(spark, work + "/in", EVENT, lateness="5 seconds"), ["key"], "ts", 1000)
    got = flows.run_to_files(spark, loose, work + "/b")
    assert rows(got) == [(1, 0, 1000, 2), (1, 4000, 5000, 3)]


def test_session_merge(spark, work, rows):
    """A row that bridges two open sessions leaves one."""
    write_batches(spark, work + "/in", EVENT, [(1, 0, 1), (1, 200_000, 2)], [(1, 100_000, 3)], [(2, 2_000_000, 4)])
    found = flows.session_stream(stream(spark, work + "/in", EVENT, lateness="240 seconds"), ["key"], 120_000)
    assert rows(flows.run_to_files(spark, found, work + "/a")) == [(1, 0, 200_000, 3)]


def test_sliding_parity(spark, work, rows):
    data = [(i % 3, 1000 + 1000 * i + 37 * (i * i % 11), i) for i in range(90)]
    write_batches(spark, work + "/in", EVENT, data[:30], data[30:31], data[31:60], data[60:], [(9, 10**6, 99)])
    got = flows.run_to_files(spark, flows.sliding_stream(stream(spark, work + "/in", EVENT, lateness="2 seconds"), 7000), work + "/a")
    want = sliding(spark.createDataFrame(data, EVENT), ["key"], "ts_ms", 7000)
    assert rows(got) == rows(want)


def test_window_parity(spark, work, rows):
    data = [(i % 3, 1000 + 1000 * i + 37 * (i * i % 11), i) for i in range(90)]
    write_batches(spark, work + "/in", EVENT, data[:40], data[40:], [(9, 10**7, 99)])
    batch = spark.createDataFrame(data, EVENT)
    s = stream(spark, work + "/in", EVENT, lateness="2 seconds")
    got = flows.run_to_files(spark, tumbling(s, ["key"], "ts", 5000), work + "/a")
    assert rows(got) == rows(tumbling(batch, ["key"], "ts_ms", 5000))
    got = flows.run_to_files(spark, flows.session_stream(s, ["key"], 3000), work + "/b")
    assert rows(got) == rows(session(batch, ["key"], "ts_ms", 3000))


def test_interval_join_parity(spark, work, rows):
    def sides(feed):
        left = feed.where("arrival % 2 = 0").select("key", F.col("arrival").alias("l"), F.col("ts").alias("l_ts"))
        right = feed.where("arrival % 2 = 1").select("key", F.col("arrival").alias("r"), F.col("ts").alias("r_ts"))
        return interval_join(left, right, ["key"], 4000, "l_ts", "r_ts").select("key", "l", "r")

    data = [(i % 3, 1000 + 1000 * i + 37 * (i * i % 11), i) for i in range(60)]
    write_batches(spark, work + "/in", EVENT, data[:20], data[20:45], data[45:])
    got = flows.run_to_files(spark, sides(stream(spark, work + "/in", EVENT, lateness="5 seconds")), work + "/a")
    want = sides(with_event_time(spark.createDataFrame(data, EVENT), field_time(F.col("ts_ms"))))
    assert rows(got) == rows(want) and want.count() > 50


def test_dedup(spark, work, rows):
    write_batches(spark, work + "/in", EVENT, [(1, 100, 1), (1, 200, 2)], [(1, 300, 3), (2, 300, 4)])
    seen = flows.first_occurrence_stream(stream(spark, work + "/in", EVENT, lateness="10 seconds"), ["key"])
    assert rows(flows.run_to_files(spark, seen.select("key"), work + "/a")) == [(1,), (2,)]


FEED = "id STRING, feed STRING, provider_id STRING, ext_message_id STRING, status STRING, time BIGINT"


def test_monitor(spark, work, rows):
    write_batches(
        spark, work + "/in", FEED,
        [("a", "received", None, None, None, 1000), ("b", "received", None, None, None, 1000),
         ("c", "received", None, None, None, 2000), ("x", "sent", "p", "e", "SENT", 1500)],
        [("a", "sent", "p", "e1", "SENT", 1500), ("b", "sent", "p", "e2", "SENT", 1600),
         ("x", "received", None, None, None, 1700)],
        [("a", "status", "p", "e1", "DELIVERED", 2500), ("c", "sent", "q", "e3", "SENT", 2600),
         ("c", "sent", "r", "e3", "SENT", 2700)],
        [("z", "received", None, None, None, 121_001)],
        [("z", "sent", "p", "e", "SENT", 121_701)],
    )
    monitored = flows.monitor_stream(stream(spark, work + "/in", FEED, "time", "10 seconds"))
    children = {n: F.col("outcome") == n for n in ("complete", "alert")}
    for_each_batch(monitored, split_sink(children, work + "/out"), work + "/c").awaitTermination()
    done = read_child(spark, work + "/out", "complete", monitored.schema)
    assert rows(done, "id", "counter", "provider_id", "dr_status", "received_time") == [
        ("a", 2, "p", "DELIVERED", 1000), ("c", 2, "r", None, 2000),
    ]
    # watermark 111,701: nothing is 120 s old yet
    assert read_child(spark, work + "/out", "alert", monitored.schema).count() == 0
    write_batches(spark, work + "/in", FEED, [("y", "received", None, None, None, 131_700)])
    for_each_batch(monitored, split_sink(children, work + "/out"), work + "/c").awaitTermination()
    # watermark 121,700: b (due 121,000) is alerted, x (due 121,700) not yet, nor z and y
    alerts = read_child(spark, work + "/out", "alert", monitored.schema)
    assert rows(alerts, "id", "counter", "sent_status") == [("b", 1, "SENT")]


PART = "key STRING, id SMALLINT, size SMALLINT, ind SMALLINT, provider_id INT, text STRING, sent_time BIGINT"


def test_reassembly(spark, work, rows):
    def part(key, size, ind, text, time):
        return (key, 1, size, ind, 9, text, time)

    write_batches(
        spark, work + "/in", PART,
        [part("a", 2, 1, "lo", 1000), part("b", 3, 0, "x", 2000), part("b", 3, 0, "x", 2000)],
        [part("a", 2, 0, "hel", 1500), part("c", 1, 0, "one", 3000)],
        [part("b", 3, 2, "z", 9000)],
        [part("d", 2, 0, "late", 70_000)],
    )
    out = flows.reassembly_stream(stream(spark, work + "/in", PART, "sent_time", "8 seconds"))
    got = flows.run_to_files(spark, out, work + "/a")
    # watermark 62,000: b (due 62,000) is not over yet
    assert rows(got, "key", "text", "full_message") == [("a", "hello", True), ("c", "one", True)]
    write_batches(spark, work + "/in", PART, [part("d", 2, 1, "r", 70_001)], [part("e", 2, 0, "f", 90_000)])
    got = flows.run_to_files(spark, out, work + "/a")
    assert rows(got, "key", "ind", "text", "full_message") == [
        ("a", None, "hello", True), ("b", 0, "x", False), ("b", 2, "z", False),
        ("c", None, "one", True), ("d", None, "later", True),
    ]


@pytest.mark.parametrize("cuts", [[], [3], [1, 2, 3, 4, 5, 6]])
def test_monitor_rules(spark, work, rows, cuts):
    """Third, late and early records do not count, in whatever batches they come; like batch."""
    data = [
        ("a", "status", "p", "e", "DELIVERED", 1030), ("a", "sent", "p", "e", "SENT", 1010),
        ("b", "sent", "q", "e", "SENT", 990), ("a", "sent", "r", "e", "AGAIN", 1040),
        ("b", "sent", "p", "e", "SENT", 1020), ("b", "status", "p", "e", "LATE", 121_001),
        ("a", "received", None, None, None, 1000), ("b", "received", None, None, None, 1000),
        ("c", "received", None, None, None, 1000), ("c", "sent", "p", "e", "SENT", 2000),
        ("c", "status", "p", "e", "DELIVERED", 121_000), (None, "received", None, None, None, 1000),
        ("a", "received", None, None, None, 1005), ("z", "received", None, None, None, 121_500),
    ]
    bounds = [0, *cuts, len(data)]
    write_batches(spark, work + "/in", FEED, *[data[i:j] for i, j in zip(bounds, bounds[1:])])
    layout = spark.createDataFrame([], FEED).schema
    feed = file_feed(spark, work + "/in", layout, "json", streaming=True, max_files_per_batch=1)
    table = spark.createDataFrame(data, FEED)
    closed = flows.replay(feed, table, "time", work, id="closing", feed="received")
    got = flows.replay_to_files(spark, closed, flows.monitor_stream(closed.stream))
    fields = ["id", "provider_id", "sent_status", "dr_status", "sent_status_time", "counter"]
    assert rows(got, "outcome", *fields) == [
        ("alert", "b", "p", "SENT", None, 1020, 1),
        ("complete", "a", "p", "SENT", "DELIVERED", 1010, 2),
        ("complete", "c", "p", "SENT", "DELIVERED", 2000, 2),
    ]

    def of(name, time):
        named = table.where(F.col("feed") == name).withColumn("arrival", F.col("time"))
        return named.withColumnRenamed("time", time)

    state = monitoring.monitor_state(of("received", "received_time"), of("sent", "sent_time"), of("status", "status_time"))
    assert rows(monitoring.completed(state), *fields) == rows(got.where("outcome = 'complete'"), *fields)
    assert rows(monitoring.alerts(state, 121_500), *fields) == rows(got.where("outcome = 'alert'"), *fields)
    assert rows(monitoring.alerts(state, 121_000), "id") == []


@pytest.mark.parametrize("batches", [[0, 1, 2, 3, 4, 5], [5, 3, 1, 4, 2, 0]])
def test_reassembly_rules(spark, work, rows, batches):
    """A message is sent as it first became complete; a part after the deadline starts a new group."""
    data = [
        ("a", 1, 2, 0, 9, "x", 1000), ("a", 1, 2, 1, 9, "y", 1001), ("a", 1, 2, 1, 9, "Y", 1002),
        ("b", 1, 2, 0, 9, "p", 1000), ("b", 1, 2, 1, 9, "q", 61_001), ("c", 1, 1, 0, 9, "last", 130_000),
    ]
    write_batches(spark, work + "/in", PART, *[[data[i]] for i in batches])
    layout = spark.createDataFrame([], PART).schema
    feed = file_feed(spark, work + "/in", layout, "json", streaming=True, max_files_per_batch=1)
    closed = flows.replay(feed, spark.createDataFrame(data, PART), "sent_time", work, key="closing")
    got = flows.replay_to_files(spark, closed, flows.reassembly_stream(closed.stream))
    assert rows(got, "key", "text", "full_message") == [
        ("a", "xy", True), ("b", "p", False), ("b", "q", False),
    ]


def test_asof_stream(spark, work, rows):
    layout = "key BIGINT, arrival BIGINT, view_ms BIGINT, is_update BOOLEAN"
    data = [
        (1, 2, None, False), (1, 1, 5, True), (2, 3, None, False), (1, 4, None, False), (1, 5, None, True),
        (1, 6, None, False), (1, 7, 9, True), (1, 8, None, False), (3, 9, None, False), (None, 4, None, False),
    ]
    write_batches(spark, work + "/in", layout, *[[data[i]] for i in (7, 3, 0, 1, 9, 4, 8, 2, 6, 5)])
    table = spark.createDataFrame(data, layout)
    feed = file_feed(spark, work + "/in", table.schema, "json", streaming=True, max_files_per_batch=1)
    for how, want in (("left", [(1, 2, 5), (1, 4, 5), (1, 6, None), (1, 8, 9), (2, 3, None)]), ("inner", [(1, 2, 5), (1, 4, 5), (1, 8, 9)])):
        closed = flows.replay(feed, table, "arrival", f"{work}/{how}", key=-1, is_update=True)
        met = flows.asof_stream(closed.stream, "key", "arrival", ["view_ms"], how, tombstone="view_ms")
        assert rows(flows.replay_to_files(spark, closed, met), "key", "arrival", "view_ms") == want


REPLAYED = sorted(name for name in load()[0] if name.endswith("_stream") or name in (
    "lookup_state_store", "sink_foreach", "sink_processor", "stateful_processor", "timers"))


@pytest.mark.parametrize("files", [6])
@pytest.mark.parametrize("name", REPLAYED)
def test_batches_do_not_matter(spark, work, monkeypatch, name, files):
    """Each stream query with its table split at random, one file per micro-batch."""
    monkeypatch.setattr(streams, "FILES_PER_BATCH", 1)
    for table in ("events", "orders", "conversations"):
        rows = spark.read.parquet(f"{SF_DIR}/{table}.parquet")
        rows.repartition(files, F.rand(7)).write.parquet(f"{work}/{table}.parquet")
    assert compare(load()[0][name](spark, work), connect(SF_DIR), load()[1][name]) == []


def test_wall_clock(spark, work, rows):
    """Age counts from when a record is processed, whatever its event time."""
    write_batches(spark, work + "/p", PART, [("a", 1, 2, 0, 9, "x", 5), ("b", 1, 1, 0, 9, "y", 5)])
    write_batches(spark, work + "/m", FEED, [("a", "received", None, None, None, 10**13)])
    parts = flows.reassembly_stream(stream(spark, work + "/p", PART, None), 1500, "processingTime")
    feed = flows.monitor_stream(stream(spark, work + "/m", FEED, None), 1500, "processingTime")
    queries = [
        write_files(parts, work + "/a", work + "/ca", every="500 milliseconds"),
        write_files(feed, work + "/b", work + "/cb", every="500 milliseconds"),
    ]
    try:
        deadline = time.time() + 60
        while time.time() < deadline:
            time.sleep(2)
            assert all(q.exception() is None for q in queries)
            got = spark.read.schema(parts.schema).parquet(work + "/a")
            alerts = spark.read.schema(feed.schema).parquet(work + "/b")
            if got.count() == 2 and alerts.count() == 1:
                break
    finally:
        for q in queries:
            q.stop()
    assert rows(got, "key", "text", "full_message") == [("a", "x", False), ("b", "y", True)]
    assert rows(alerts, "id", "outcome") == [("a", "alert")]


@pytest.mark.parametrize("snapshot_every", [1, 2, 50])
def test_asof_and_store(spark, work, rows, snapshot_every):
    layout = "key BIGINT, arrival BIGINT, ts_ms BIGINT, type STRING, view_ms BIGINT"
    write_batches(
        spark, work + "/in", layout,
        [(1, 2, 20, "click", None), (1, 1, None, "view", 5), (2, 3, 30, "click", None)],
        [(1, 4, 40, "click", None), (1, 5, None, "view", None), (1, 6, 60, "click", None)],
        [(1, 7, 70, "click", None), (1, 8, None, "view", 9), (1, 9, 90, "click", None)],
    )
    feed = stream(spark, work + "/in", layout, None)
    action = flows.asof_batches(work + "/a", ["key"], "arrival", ["view_ms"], how="left", tombstone="view_ms", snapshot_every=snapshot_every)

    def twice(df, batch):
        action(df, batch)
        action(df, batch)

    both = feed.withColumn("is_update", F.col("type") == "view")
    for_each_batch(both, twice, work + "/c").awaitTermination()
    got = spark.read.parquet(work + "/a/out")
    assert rows(got, "key", "arrival", "view_ms") == [
        (1, 2, 5), (1, 4, 5), (1, 6, None), (1, 7, None), (1, 9, 9), (2, 3, None),
    ]
    store = flows.run_to_files(spark, flows.last_seen_stream(feed.select("key", "arrival", "type")), work + "/b")
    assert rows(store.where("key = 1"), "n", "last_arrival") == [(2, 2), (5, 6), (8, 9)]


def test_change_log(spark, work, rows):
    """Later batches win; a repeated batch and compaction change nothing; state can be read."""
    layout = "key BIGINT, ts_ms BIGINT, arrival BIGINT"
    write_batches(spark, work + "/in", layout, [(1, 10, 1), (2, 20, 2)], [(1, 30, 3)], [(3, 40, 4)])
    counts = stream(spark, work + "/in", layout, None).groupBy("key").count()
    action = log_changes(work + "/log")

    def twice(df, batch):
        action(df, batch)
        action(df, batch)

    for_each_batch(counts, twice, work + "/c", "update").awaitTermination()
    want = [(1, 2), (2, 1), (3, 1)]
    table = read_log(spark, work + "/log", counts.schema, ["key"], [])
    assert rows(table, "key", "count") == want
    compact_log(spark, work + "/log", work + "/log2", counts.schema, ["key"], [])
    assert rows(read_log(spark, work + "/log2", counts.schema, ["key"], []), "key", "count") == want
    state = flows.stored_state(spark, work + "/c")
    assert rows(state.select("key.key", "value.count")) == want


def test_feeds(spark, work, rows):
    options = kafka_options("host:1", pattern=".*-messages", headers=True, max_records_per_batch=5)
    assert options["subscribePattern"] == ".*-messages" and options["startingOffsets"] == "earliest"
    assert options["includeHeaders"] == "true" and options["maxOffsetsPerTrigger"] == "5"
    assert kafka_options("host:1", topics="a")["subscribe"] == "a"
    with pytest.raises(ValueError):
        kafka_options("host:1")
    data = [(None, None, t, 0, 0, None, None) for t in ("a-messages", "b-messages-old", "c-messages")]
    records = spark.createDataFrame(data, TOPIC_RECORD)
    assert rows(feeds_by_pattern(records, ".*-messages"), "topic") == [("a-messages",), ("c-messages",)]
    for name in ("sent-messages", "status-messages", "other"):
        spark.createDataFrame([(name,)], "v STRING").write.json(f"{work}/{name}")
    layout = spark.createDataFrame([], "v STRING").schema
    found = file_feeds_by_pattern(spark, work + "/*", "/(sent|status)-messages/", layout, "json")
    assert rows(found, "v") == [("sent-messages",), ("status-messages",)]


@pytest.mark.parametrize("files", [1, 3, 6])
def test_stream_time_per_source(spark, work, rows, files):
    """The same rows are late however the feed is cut into micro-batches; a null time moves nothing."""
    rng = random.Random(9)
    data = [(i % 2, i, None if i == 3 else max(0, i * 20 + rng.randrange(-900, 300)), rng.choice("ab")) for i in range(200)]
    df = spark.createDataFrame(data, "source INT, arrival BIGINT, ts_ms BIGINT, kind STRING")
    write_in_stages(df, "arrival", files, work + "/in")
    feed = file_feed(spark, work + "/in", df.schema, streaming=True, max_files_per_batch=1)
    timed = flows.stream_time_stream(feed, "source", ["arrival"], "ts_ms")
    kept = timed.where(tumbling_end("ts_ms", 500) > F.col("stream_time")).drop("stream_time")
    want = drop_late(df, "source", ["arrival"], "ts_ms", tumbling_end("ts_ms", 500))
    got = flows.run_to_files(spark, kept, work)
    assert rows(got) == rows(want) and 0 < want.count() < len(data) - 1


def test_store_of_a_user_function(spark, work, rows):
    """A list store: each micro-batch sends its records that the key has not had, by value."""

    def new_only(key, frames, store):
        import pandas as pd

        held = {r[0] for r in store.get()} if store.exists() else set()
        new = {v for frame in frames for v in frame["arrival"].tolist()} - held
        store.appendList([(v,) for v in sorted(new)])
        yield pd.DataFrame({"key": [key[0]] * len(new), "arrival": sorted(new)})

    write_batches(spark, work + "/in", EVENT, [(1, 0, 5), (1, 0, 6), (2, 0, 5)], [(1, 0, 6), (1, 0, 7), (None, 0, 1)])
    feed = stream(spark, work + "/in", EVENT, ts=None)
    stored = flows.with_store(feed, ["key"], new_only, "key BIGINT, arrival BIGINT", "arrival BIGINT", "list")
    assert rows(flows.run_to_files(spark, stored, work + "/a")) == [(1, 5), (1, 6), (1, 7), (2, 5)]
    with pytest.raises(ValueError):
        flows.with_store(feed, ["key"], new_only, "key BIGINT", "arrival BIGINT", "map")
    with pytest.raises(ValueError):
        flows.with_store(feed, ["key"], new_only, "key BIGINT", "arrival BIGINT", "list", "n BIGINT")


def test_global_table_changes_between_batches(spark, work, rows):
    """A batch sees the changes before it; repeated, it sees the same ones again."""
    layout = "key BIGINT, at BIGINT, name STRING"
    change = log_changes(work + "/log")
    act = flows.lookup_batches(work, work + "/log", layout, ["key"], ["at"], ["name"])
    records = spark.createDataFrame([(1, 10), (2, 20)], "key BIGINT, n BIGINT")
    act(records, 0)
    change(spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], layout), 0)
    act(records, 1)
    change(spark.createDataFrame([(1, 2, "A"), (2, 3, None)], layout), 1)
    act(records, 1)
    act(records, 2)
    got = spark.read.parquet(work + "/out")
    assert rows(got, "batch", "key", "name") == sorted(
        [(0, 1, None), (0, 2, None), (1, 1, "a"), (1, 2, "b"), (2, 1, "A"), (2, 2, None)], key=repr
    )


def test_forgetting_duplicates(spark, work, rows):
    """A repeat within the lateness is dropped, a later one sent again; keys long gone are no state any more."""
    batches = [[(k, 1000 + 1000 * b, b) for k in range(50 * b, 50 * b + 60)] for b in range(6)]
    write_batches(spark, work + "/in", EVENT, *batches, [(10_000, 90_000, 9)], [(0, 90_500, 10)])
    feed = stream(spark, work + "/in", EVENT, lateness="2 seconds")
    query = write_files(flows.first_occurrence_within(feed, ["key"]), work + "/out", work + "/checkpoint")
    query.awaitTermination()
    got = rows(file_feed(spark, work + "/out", feed.schema), "key")
    assert got == sorted([*((k,) for k in range(310)), (10_000,), (0,)], key=repr)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert max(held) < 310 and held[-1] <= 2


def hot_feed(n=1200):
    """Nine tenths of the rows have one key; ``arrival`` is out of order by at most 40."""
    rng = random.Random(11)
    rows = [(1 if rng.random() < 0.9 else rng.randrange(2, 9), i, rng.randrange(1000)) for i in range(n)]
    return sorted(rows, key=lambda r: r[1] + rng.randrange(40))


def test_hot_keys_of_a_stream(spark, work, rows, monkeypatch):
    """Running values and as-of joins over a feed in disorder, each micro-batch twice, one key cut into chunks."""
    monkeypatch.setattr(running, "HOT_ROWS", 50)
    cut, chunks = running._cut, []

    def watched(frame, order):
        chunks.append(cut(frame, order))
        return chunks[-1]

    monkeypatch.setattr(running, "_cut", watched)
    layout = "key BIGINT, arrival BIGINT, amount BIGINT, view_ms BIGINT, is_update BOOLEAN"
    # A view without a time takes back the one before.
    data = [(k, a, v, v if v % 3 else None, a % 5 == 0) for k, a, v in hot_feed()]
    write_batches(spark, work + "/in", layout, *[data[i : i + 300] for i in range(0, 1200, 300)])
    feed, table = stream(spark, work + "/in", layout, None), spark.createDataFrame(data, layout)
    outputs = {
        "n": ("sum", F.lit(1)), "total": ("sum", F.col("amount")), "top": ("max", F.col("amount")),
        "least": ("min", F.col("amount")), "seen": ("last", F.col("view_ms")),
    }

    def run(name, act):
        ordered = held.InOrder(f"{work}/{name}/held", "arrival", 40, act)

        def twice(df, batch):
            ordered(df, batch)
            ordered(df, batch)

        for_each_batch(feed, twice, f"{work}/{name}/c").awaitTermination()
        ordered.close(spark, table.schema)
        assert ordered.late(spark, table.schema).count() == 0
        return spark.read.parquet(f"{work}/{name}/out").drop("batch")

    got = run("sums", held.running_batches(f"{work}/sums", ["key"], ["arrival"], outputs, snapshot_every=2))
    # The rows and carries of the last micro-batch; each call cuts twice, and closing is one more.
    sizes = [r["count"] for r in chunks[-3].where("key = 1").groupBy("_chunk").count().collect()]
    assert len(sizes) > 3 and max(sizes) <= 2 * sum(sizes) / len(sizes)
    columns = ["key", "arrival", *outputs]
    assert rows(got, *columns) == rows(running.running(table, ["key"], ["arrival"], outputs), *columns)

    values = {"how": "left", "tombstone": "view_ms"}
    act = flows.asof_batches(f"{work}/asof", ["key"], "arrival", ["view_ms"], 2, **values)
    columns = ["key", "arrival", "amount", "view_ms"]
    events = table.where("NOT is_update").drop("view_ms", "is_update")
    want = asof_join(events, table.where("is_update"), ["key"], "arrival", ["view_ms"], **values)
    assert rows(run("asof", act), *columns) == rows(want, *columns)


def test_rows_in_order(spark, work, rows):
    """Rows wait until no smaller one can come; later ones and those without a position are kept aside."""
    layout = "key BIGINT, arrival BIGINT, n BIGINT"
    write_batches(
        spark, work + "/in", layout,
        [(1, 10, 0), (1, 3, 1), (None, 4, 2)], [(1, 5, 3), (1, 4, 4), (1, None, 5), (2, 30, 6)], [(2, 24, 7), (2, 25, 8), (1, 9, 9)],
    )
    given = []
    ordered = held.InOrder(f"{work}/held", "arrival", 5, lambda df, batch: given.append((batch, rows(df, "arrival", "n"))))
    table = spark.createDataFrame([], layout)
    for_each_batch(stream(spark, work + "/in", layout, None), ordered, work + "/c").awaitTermination()
    ordered.close(spark, table.schema)
    assert given == [(0, [(3, 1), (4, 2)]), (1, [(10, 0), (5, 3)]), (2, []), (3, [(25, 8), (30, 6)])]
    assert rows(ordered.late(spark, table.schema), "n") == [(4,), (5,), (7,), (9,)]


def test_running_batches_of_decimals_and_nulls(spark, work, rows):
    """The carry keeps its type; a key without a value yet has none; rows without a key are dropped."""
    layout = "key BIGINT, arrival BIGINT, amount DECIMAL(10,2)"
    act = held.running_batches(f"{work}/a", ["key"], ["arrival"], {"total": ("sum", F.col("amount")), "last": ("last", F.col("amount"))}, 2)
    for batch, row in enumerate([(1, 1, None), (1, 2, 5), (None, 3, 6), (1, 4, 7), (1, 5, None)]):
        act(spark.createDataFrame([row], "key BIGINT, arrival BIGINT, amount INT").select("key", "arrival", F.col("amount").cast("decimal(10,2)").alias("amount")), batch)
    act(spark.createDataFrame([], layout), 5)
    got = spark.read.parquet(f"{work}/a/out").selectExpr("key", "arrival", "CAST(total AS INT) AS total", "CAST(last AS INT) AS last")
    assert rows(got) == [(1, 1, None, None), (1, 2, 5, 5), (1, 4, 12, 7), (1, 5, 12, 7)]


def test_joined_rows_leave_the_state(spark, work):
    """The interval join lets go of rows that no later one can meet."""
    from eventloom.catalog.joins import joined_objects

    layout = "key BIGINT, ts_ms BIGINT, arrival BIGINT, type STRING"
    hour = 3_600_000
    write_batches(spark, work + "/in", layout, *[[(1, (i + 1) * 3 * hour, i, "click"), (1, (i + 1) * 3 * hour + 9, i, "purchase")] for i in range(8)])
    query = write_files(joined_objects(stream(spark, work + "/in", layout)), work + "/out", work + "/c")
    query.awaitTermination()
    assert spark.read.parquet(work + "/out").count() == 8
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 6
