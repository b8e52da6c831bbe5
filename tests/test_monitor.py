"""The delivery monitor keeps messages in buckets: few calls to the state, and outcomes as if each had a key of its own."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from eventloom.catalog import load, streams
from eventloom.functions.eventtime import field_time, with_event_time
from eventloom.sources.feeds import file_feed
from eventloom.sources.sinks import write_files
from eventloom.streaming import flows
from eventloom.streaming.processors import MONITOR_OUTPUT, NO_TIME, DeliveryMonitor
from oracle import compare, connect

COLUMNS = ["id", "feed", "provider_id", "ext_message_id", "status", "time"]
OUTPUT = [part.split()[0] for part in MONITOR_OUTPUT.split(", ")]


class State:
    """Lists and timers of all keys, with a count of the calls."""

    def __init__(self):
        self.lists, self.timers, self.key, self.calls = {}, set(), None, 0

    def getListState(self, name, layout):
        return self

    def exists(self):
        self.calls += 1
        return self.key in self.lists

    def get(self):
        self.calls += 1
        return iter(self.lists[self.key])

    def put(self, values):
        self.calls += 1
        self.lists[self.key] = list(values)

    def appendValue(self, value):
        self.calls += 1
        self.lists[self.key].append(value)

    def clear(self):
        self.calls += 1
        self.lists.pop(self.key, None)

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add((self.key, at))

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.discard((self.key, at))


class Clock:
    def __init__(self, now):
        self.getCurrentWatermarkInMs = self.getCurrentProcessingTimeInMs = lambda: now


def run(batches, bucket, wall_clock=False, alert_after_ms=50):
    """Outcomes with the batch that sent them and the state left, of (rows, watermark or time) as Spark would run them."""
    state, sent = State(), []
    machine = DeliveryMonitor(alert_after_ms, wall_clock)
    machine.init(state)
    for n, (rows, now) in enumerate(batches):
        keyed = {}
        for row in rows:
            keyed.setdefault((bucket(row[0]),), []).append(row)
        frames = []
        for key, own in keyed.items():
            state.key = key
            chunks = [pd.DataFrame(own[i : i + 1000], columns=COLUMNS) for i in range(0, len(own), 1000)]
            frames += machine.handleInputRows(key, iter(chunks), Clock(now))
        for key, at in sorted(t for t in state.timers if t[1] <= now):
            state.key = key
            frames += machine.handleExpiredTimer(key, Clock(now), None)
            state.timers.discard((key, at))
        for frame in frames:
            plain = frame[OUTPUT].astype(object).where(frame[OUTPUT].notna(), None)
            sent += [(n, *row) for row in plain.itertuples(index=False, name=None)]
    return sorted(sent, key=repr), state


def due_times(state):
    return sorted({(i, due) for blocks in state.lists.values() for block in blocks for i, due in zip(block[0], block[1])})


def messages(n):
    times = [(i, 1000 + 7 * i) for i in range(n)]
    return [(f"m{i}", "received", None, None, None, t) for i, t in times] + [
        (f"m{i}", feed, "p", "e", "ok", t + late) for i, t in times for feed, late in (("sent", 2), ("status", 9)) if i % 3 or late < 9
    ]


def test_calls_do_not_grow_with_the_messages():
    few, many = (run([(messages(n), 0), ([], 10**9)], lambda _: 0) for n in (3, 3000))
    assert many[1].calls == few[1].calls < 20
    assert [len([x for x in many[0] if x[2] == kind]) for kind in ("complete", "alert")] == [2000, 1000]
    assert many[1].lists == {} and many[1].timers == set()


def test_one_timer_for_each_bucket():
    """It waits for the earliest message of its bucket; those that are not due stay as they are."""
    feed = messages(30)
    _, state = run([(feed, 0)], lambda i: int(i[1:]) % 4)
    firsts = [min(due for i, due in due_times(state) if int(i[1:]) % 4 == b) for b in range(4)]
    assert state.timers == {((b,), due) for b, due in enumerate(firsts)}
    sent, state = run([(feed, 0), ([], 1100)], lambda i: int(i[1:]) % 4)
    assert {row[1] for row in sent} == {f"m{i}" for i in range(30) if 1000 + 7 * i + (9 if i % 3 else 50) < 1100}
    assert {i for i, _ in due_times(state)} == {f"m{i}" for i in range(30)} - {row[1] for row in sent}


@pytest.mark.parametrize("wall_clock", [False, True])
def test_buckets_do_not_matter(wall_clock, monkeypatch):
    """Ties, nulls, records before, after and between, in any batches: as with a bucket for each message."""
    monkeypatch.setattr("eventloom.streaming.processors.BLOCK", 3)
    rng, outcomes = random.Random(4), set()
    for _ in range(40):
        batches = []
        for now in sorted(rng.randrange(300) for _ in range(5)):
            batches.append(([
                (f"m{rng.randrange(7)}", rng.choice(["received", "sent", "status", None]),
                 *[rng.choice([None, "a", "b"]) for _ in range(3)], rng.choice([rng.randrange(200), 60]))
                for _ in range(rng.randrange(12))
            ], now))
        batches.append(([], batches[-1][1] + 51))
        if wall_clock:
            batches[0][0].append(("m1", "sent", None, None, None, NO_TIME))
        alone, own = run(batches, lambda i: i, wall_clock)
        for bucket in (lambda i: 0, lambda i: int(i[1:]) % 3):
            sent, state = run(batches, bucket, wall_clock)
            assert sent == alone and due_times(state) == due_times(own)
        outcomes |= {row[2] for row in alone}
    assert outcomes == {"complete", "alert"}


def test_last_known_fields():
    """A later record overrides what it has; a tie in time goes by feed and content, nulls first."""
    feed = [
        ("a", "received", None, None, None, 10), ("a", "sent", "p", "e", "one", 12), ("a", "sent", None, "f", None, 13),
        ("b", "received", None, None, None, 10), ("b", "status", "q", None, "late", 12), ("b", "sent", "p", None, "x", 12),
        ("b", "sent", None, None, "y", 12), ("c", "received", None, None, None, 10), ("c", "sent", "p", "e", "x", 10),
    ]
    sent, _ = run([(feed, 0), ([], 1000)], lambda _: 0)
    assert sent == [
        (1, "a", "complete", 10, "p", "f", "one", 13, None, None, 2, 10),
        (1, "b", "complete", 10, "p", None, "x", 12, None, None, 2, 10),
        (1, "c", "alert", 10, None, None, None, None, None, None, 0, 10),
    ]


def test_state_of_a_stream(spark, work, rows):
    """Two micro-batches in four buckets: each record with the due time of its message, and a timer for each bucket."""
    feed = messages(40)
    layout = ", ".join(f"{c} {'BIGINT' if c == 'time' else 'STRING'}" for c in COLUMNS)
    for part in (feed[:60], feed[60:]):
        spark.createDataFrame(part, layout).coalesce(1).write.mode("append").parquet(f"{work}/in")
    fed = file_feed(spark, f"{work}/in", spark.createDataFrame([], layout).schema, streaming=True, max_files_per_batch=1)
    timed = with_event_time(fed, field_time(F.col("time")), "1 day")
    write_files(flows.monitor_stream(timed, buckets=4), f"{work}/out", f"{work}/checkpoint").awaitTermination()
    records = flows.monitor_records(spark, f"{work}/checkpoint")
    due = {f"m{i}": 1001 + 7 * i + (9 if i % 3 else 120_000) for i in range(40)}
    assert rows(records, "id", "due", "feed", "time") == sorted(((r[0], due[r[0]], r[1], r[5]) for r in feed), key=repr)
    firsts = records.groupBy("bucket").agg(F.min("due"))
    assert rows(flows.stored_timers(spark, f"{work}/checkpoint")) == rows(firsts) and firsts.count() == 4


def test_state_timers_in_batches(spark, work, monkeypatch):
    monkeypatch.setattr(streams, "FILES_PER_BATCH", 1)
    sf_dir = "/root/testdata/sf0.001"
    spark.read.parquet(f"{sf_dir}/orders.parquet").repartition(3, F.rand(7)).write.parquet(f"{work}/orders.parquet")
    assert compare(load()[0]["state_timers"](spark, work), connect(sf_dir), load()[1]["state_timers"]) == []
