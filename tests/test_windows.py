"""Windows against their definitions, boundaries and late rows."""

import random

import pytest
from pyspark.sql import functions as F

from eventloom.catalog.windows import ROUNDS, SESSION_GRACE, kept_for_sessions_sql
from eventloom.operators import running, windows
from eventloom.operators.running import hot_ranges
from eventloom.operators.windows import (
    drop_late,
    drop_late_for_sessions,
    session,
    session_end,
    sliding,
    sliding_end,
    tumbling,
    tumbling_end,
    with_stream_time,
)
from oracle import connect


def feed(spark, events):
    data = [(k, t, i) for i, (k, t) in enumerate(events)]
    return spark.createDataFrame(data, "key STRING, ts_ms BIGINT, arrival BIGINT")


def random_events(seed, n=400, top=4000):
    rng = random.Random(seed)
    return [(rng.choice(["a", "a", "b", "c", None]), rng.randrange(top)) for _ in range(n)]


def test_tumbling(spark, rows):
    df = feed(spark, [("a", 0), ("a", 119_999), ("a", 120_000), ("b", 5), (None, 5)])
    assert rows(tumbling(df, ["key"], "ts_ms", 120_000)) == [
        ("a", 0, 120_000, 2), ("a", 120_000, 240_000, 1), ("b", 0, 120_000, 1),
    ]


def brute_sessions(events, gap):
    out = []
    for key in {k for k, _ in events if k}:
        times = sorted(t for k, t in events if k == key)
        start, last, n = times[0], times[0], 0
        for t in times:
            if t - last > gap:
                out.append((key, start, last, n))
                start, n = t, 0
            last, n = t, n + 1
        out.append((key, start, last, n))
    return sorted(out, key=repr)


@pytest.mark.parametrize("cells", [1, 3, windows.CELLS])
@pytest.mark.parametrize("gap", [0, 1, 7, 20, 500])
def test_sessions(spark, rows, monkeypatch, gap, cells):
    monkeypatch.setattr(windows, "CELLS", cells)
    events = random_events(gap)
    assert rows(session(feed(spark, events), ["key"], "ts_ms", gap)) == brute_sessions(events, gap)


def test_session_bounds(spark, rows):
    df = feed(spark, [("a", 0), ("a", 120_000), ("a", 240_001), ("b", 0), ("b", 120_001)])
    assert rows(session(df, ["key"], "ts_ms", 120_000)) == [
        ("a", 0, 120_000, 2), ("a", 240_001, 240_001, 1), ("b", 0, 0, 1), ("b", 120_001, 120_001, 1),
    ]
    bridged = feed(spark, [("a", 0), ("a", 200_000), ("a", 100_000)])
    assert rows(session(bridged, ["key"], "ts_ms", 120_000)) == [("a", 0, 200_000, 3)]


def test_session_aggregates(spark, rows):
    df = feed(spark, [("a", 0), ("a", 3), ("a", 50)]).withColumn("v", F.col("ts_ms") * 2)
    aggs = {"s": ("sum", F.col("v")), "n": ("count", F.lit(1)), "lo": ("min", F.col("v")), "hi": ("max", F.col("v"))}
    assert rows(session(df, ["key"], "ts_ms", 5, aggs)) == [("a", 0, 3, 6, 2, 0, 6), ("a", 50, 50, 100, 1, 100, 100)]


def test_counter_bursts(spark, rows):
    """A burst s1,s2,s1,s3,s1 three times, 7 s apart: with a 5 s gap three sessions of s1 with 3."""
    events = [(k, b * 7000 + i) for b in range(3) for i, k in enumerate(["s1", "s2", "s1", "s3", "s1"])]
    found = session(feed(spark, events), ["key"], "ts_ms", 5000).where("counter > 1")
    assert rows(found, "key", "counter") == [("s1", 3)] * 3


def brute_sliding(events, d):
    out = set()
    for key in {k for k, _ in events if k}:
        times = [t for k, t in events if k == key]
        for t in set(times):
            for start in (t - d, t + 1):
                n = sum(start <= u <= start + d for u in times)
                if n:
                    out.add((key, start, start + d, n))
    return sorted(out, key=repr)


@pytest.mark.parametrize("split", [False, True])
@pytest.mark.parametrize("d", [0, 1, 40, 1000])
def test_sliding(spark, rows, d, split):
    events = random_events(d + 1)
    df = feed(spark, events)
    hot = {"hot": hot_ranges(df, ["key"], "ts_ms", 9)} if split else {}
    assert rows(sliding(df, ["key"], "ts_ms", d, **hot)) == brute_sliding(events, d)


@pytest.mark.parametrize("split", [False, True])
@pytest.mark.parametrize("grace", [0, 300])
def test_drop_late(spark, rows, grace, split):
    rng = random.Random(5)
    data = [(i % 2, i, max(0, i * 20 + rng.randrange(-900, 300))) for i in range(200)]
    df = spark.createDataFrame(data, "p INT, arrival BIGINT, ts_ms BIGINT")
    want, top = [], {}
    for p, arrival, ts in data:
        top[p] = max(top.get(p, 0), ts)
        if ts // 500 * 500 + 500 > top[p] - grace:
            want.append((p, arrival, ts))
    hot = {"hot": hot_ranges(df, ["p"], "arrival", 3)} if split else {}
    got = drop_late(df, "p", ["arrival"], "ts_ms", tumbling_end("ts_ms", 500), grace, **hot)
    assert rows(got) == sorted(want, key=repr)
    assert 0 < len(want) < len(data)


@pytest.mark.parametrize("end", [session_end, sliding_end])
def test_late_bounds(spark, rows, end):
    """A row 100 ms behind is in time for a gap or span of 100 ms, one ms more is not."""
    df = spark.createDataFrame([(0, 0, 300), (0, 1, 200), (0, 2, 199)], "p INT, arrival BIGINT, ts_ms BIGINT")
    assert rows(drop_late(df, "p", ["arrival"], "ts_ms", end("ts_ms", 100)), "ts_ms") == [(200,), (300,)]
    assert drop_late(df, "p", ["arrival"], "ts_ms", end("ts_ms", 100), 1).count() == 3


def test_late_row_bridges(spark, rows):
    """Two sessions become one by a row that is late but within the grace; a later one is dropped."""
    data = [(0, i, t) for i, t in enumerate([100, 300, 200, 900, 880, 50])]
    df = spark.createDataFrame(data, "p INT, arrival BIGINT, ts_ms BIGINT").withColumn("key", F.lit("a"))
    kept = drop_late(df, "p", ["arrival"], "ts_ms", session_end("ts_ms", 100), 400)
    assert rows(session(kept, ["key"], "ts_ms", 100)) == [("a", 100, 300, 3), ("a", 880, 900, 2)]


def simulated_sessions(data, gap, grace):
    """Row by row: a row is merged with the sessions it touches, and refused if even then it had closed."""
    kept, sessions, top = [], {}, {}
    for source, key, arrival, ts in data:
        top[source] = max(top.get(source, ts), ts)
        held = sessions.setdefault((source, key), [])
        touched = [s for s in held if s[0] - gap <= ts <= s[1] + gap]
        merged = (min([ts, *(s[0] for s in touched)]), max([ts, *(s[1] for s in touched)]))
        if merged[1] < top[source] - grace - gap:
            continue
        sessions[source, key] = [s for s in held if s not in touched] + [merged]
        kept.append((source, key, arrival, ts))
    return sorted(kept), sorted((k, *s) for (_, k), held in sessions.items() for s in held)


@pytest.mark.parametrize(
    ("gap", "grace", "spread", "hot"),
    [(0, 0, 30, None), (1, 5, 40, None), (20, 0, 60, 3), (20, 30, 300, None), (90, 10, 600, None), (90, 10, 600, 3)],
)
def test_late_rows_join_open_sessions(spark, rows, monkeypatch, gap, grace, spread, hot):
    if hot:
        monkeypatch.setattr(running, "HOT_ROWS", hot)
    rng = random.Random(gap + spread)
    data = [(i % 2, 2 * rng.randrange(3) + i % 2, i, max(0, 6 * i - rng.randrange(spread) * rng.randrange(2))) for i in range(300)]
    df = spark.createDataFrame(data, "source INT, key INT, arrival BIGINT, ts_ms BIGINT").repartition(3)
    got = drop_late_for_sessions(df, "source", ["key"], ["arrival"], "ts_ms", gap, grace)
    kept, sessions = simulated_sessions(data, gap, grace)
    assert rows(got) == sorted(kept, key=repr)
    found = session(got, ["source", "key"], "ts_ms", gap).select("key", "window_start", "window_end")
    assert rows(found) == sorted(sessions, key=repr)


def test_late_rows_save_one_another(spark, rows):
    """Each late row is held by the one before it alone; one without a bridge is dropped."""
    times = [1000, 905, 810, 715, 620, 525, 300, 1400, 520]
    data = [(0, i, t) for i, t in enumerate(times)]
    df = spark.createDataFrame(data, "source INT, arrival BIGINT, ts_ms BIGINT").withColumn("key", F.lit("a"))
    got = drop_late_for_sessions(df, "source", ["key"], ["arrival"], "ts_ms", 100)
    # 300 touches nothing; after 1400 the whole session has closed.
    assert rows(got, "ts_ms") == sorted([(t,) for t in (1000, 905, 810, 715, 620, 525, 1400)], key=repr)


def test_null_keys_and_no_late_rows(spark, rows):
    data = [(0, "a", 0, 10), (0, None, 1, 500), (0, None, 2, 20), (0, "a", 3, 25), (0, "b", 4, None)]
    df = spark.createDataFrame(data, "source INT, key STRING, arrival BIGINT, ts_ms BIGINT")
    assert rows(drop_late_for_sessions(df, "source", ["key"], ["arrival"], "ts_ms", 30), "arrival") == [(0,), (1,)]
    assert rows(drop_late_for_sessions(df, "source", ["key"], ["arrival"], "ts_ms", 900), "arrival") == [(0,), (1,), (2,), (3,)]


def simulated_sliding(data, d, grace):
    """Each row counts in the windows that end after stream time - grace when it comes."""
    top, closed = {}, []
    for source, key, _, ts in data:
        top[source] = max(top.get(source, ts), ts)
        closed.append(top[source] - grace)
    ends = {(k, t) for (_, k, _, t), c in zip(data, closed) if t > c} | {(k, t + d + 1) for (_, k, _, t), c in zip(data, closed) if t + d + 1 > c}
    out = []
    for key, end in ends:
        n = sum(k == key and end - d <= t <= end and end > c for (_, k, _, t), c in zip(data, closed))
        if n:
            out.append((key, end - d, end, n))
    return sorted(out, key=repr)


@pytest.mark.parametrize("split", [False, True])
@pytest.mark.parametrize(("d", "grace"), [(0, 0), (20, 0), (60, 25), (400, 7)])
def test_sliding_windows_close_one_by_one(spark, rows, d, grace, split):
    rng = random.Random(d)
    data = [(i % 2, i % 2 + 2 * rng.randrange(2), i, max(0, 4 * i - rng.randrange(150) * rng.randrange(2))) for i in range(250)]
    df = spark.createDataFrame(data, "source INT, key INT, arrival BIGINT, ts_ms BIGINT")
    hot = {"hot": hot_ranges(df, ["key"], "ts_ms", 9)} if split else {}
    timed = with_stream_time(df, "source", ["arrival"], "ts_ms")
    got = sliding(timed, ["key"], "ts_ms", d, F.col("stream_time") - grace, **hot)
    assert rows(got) == simulated_sliding(data, d, grace)
    whole = sliding(timed, ["key"], "ts_ms", d, **hot)
    assert whole.exceptAll(got).count() > 0


def test_sql_rounds_are_enough(spark):
    """Another round of the SQL of sessions keeps nothing more, and the first one keeps something."""
    con = connect("/root/testdata/sf0.01")
    n = [con.execute(f"SELECT COUNT(*) FROM {kept_for_sessions_sql(SESSION_GRACE, rounds=r)}").fetchone()[0] for r in (0, 1, ROUNDS - 1, ROUNDS)]
    assert n[0] < n[1] <= n[2] == n[3]
