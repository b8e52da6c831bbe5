"""Reassembly, monitoring and section jobs on small records."""

import random

import pytest
from pyspark.sql import functions as F

from eventloom.operators import running
from eventloom.plans import monitoring as M
from eventloom.plans import reassembly as R
from eventloom.plans import sections as S

PART = "key STRING, id SMALLINT, size SMALLINT, ind SMALLINT, provider_id INT, text STRING, sent_time BIGINT"


def parts(spark, *data):
    """(key, size, ind, text, sent_time)"""
    return spark.createDataFrame([(k, 1, n, i, 9, t, s) for k, n, i, t, s in data], PART)


@pytest.mark.parametrize("large", [0, 2, R.LARGE_PARTS])
def test_reassemble(spark, rows, monkeypatch, large):
    monkeypatch.setattr(R, "LARGE_PARTS", large)
    df = parts(
        spark,
        ("a", 2, 1, "lo", 10), ("a", 2, 0, "hel", 20), ("a", 2, 0, "hel", 20),  # repeated part
        ("b", 3, 0, "x", 1), ("b", 3, 1, "y", 2),  # incomplete
        ("c", 2, 0, "p", 1), ("c", 2, 1, "q", 2), ("c", 2, 1, "Q", 3),  # one too many
        ("d", 1, 0, "one", 5), (None, 1, 0, "no", 5),
        ("e", 0, 0, "m", 1), ("e", 2, 1, "n", 2),  # size set by the second part
    )
    got = R.reassemble(df, ["key"])
    assert rows(got, "key", "text", "sent_time", "full_message") == [
        ("a", "hello", 10, True), ("d", "one", 5, True), ("e", "mn", 1, True),
    ]


def test_reassemble_when_complete(spark, rows):
    """A group that got too many parts was complete before."""
    df = parts(
        spark,
        ("a", 2, 1, "lo", 30), ("a", 2, 0, "hel", 20), ("a", 2, 0, "hel", 40), ("a", 2, 1, "LO", 50),
        ("b", 3, 0, "x", 1), ("b", 3, 1, "y", 2),
        ("c", 0, 0, "m", 1), ("c", 2, 1, "n", 2), ("c", 2, 2, "o", 3),
        ("d", 0, 0, "m", 1), ("d", 0, 1, "n", 2), ("d", 2, 2, "o", 3),  # size known too late
    )
    got = R.reassemble_when_complete(df, ["key"])
    assert rows(got, "key", "text", "completed_at") == [("a", "hello", 30), ("c", "mn", 2)]
    assert rows(R.reassemble(df, ["key"]), "key") == []


def test_windowed(spark, rows):
    df = parts(
        spark, ("a", 2, 0, "x", 599_999), ("a", 2, 1, "y", 600_000), ("b", 2, 0, "x", 600_000), ("b", 2, 1, "y", 1_199_999)
    )
    assert rows(R.reassemble_windowed(df, ["key"]), "key", "text") == [("b", "xy")]
    single = parts(spark, ("s", 1, 0, "one", 5), ("z", 0, 0, "zero", 5))
    got = R.full_flow(df.unionByName(single), ["key"])
    assert rows(got, "key", "text", "sent_time") == [("b", "xy", 600_000), ("s", "one", None), ("z", "zero", None)]


def test_expire(spark, rows):
    df = parts(
        spark, ("a", 3, 2, "z", 1000), ("a", 3, 0, "x", 2000), ("b", 1, 0, "ok", 1000), ("c", 2, 0, "new", 50_000)
    )
    assert rows(R.expire(df, ["key"], 61_000)) == []
    got = R.expire(df, ["key"], 61_001)
    assert rows(got, "key", "ind", "text", "full_message") == [("a", 0, "x", False), ("a", 2, "z", False)]


def simulated_periods(data, after):
    """(ready, expired): part by part in order of time, a group being cleared at its deadline."""
    ready, expired = [], []
    for key in {d[0] for d in data if d[0]}:
        parts = sorted({d for d in data if d[0] == key}, key=lambda d: (d[4], d[2], d[3], d[1]))
        while parts:
            opened = parts[0][4]
            own, parts = [d for d in parts if d[4] <= opened + after], [d for d in parts if d[4] > opened + after]
            size, known = next(((d[1], d[4]) for d in own if d[1]), (0, None))
            done = own[:size]
            if size and len(done) == size and done[-1][4] >= known:
                text = "".join(d[3] for d in sorted(done, key=lambda d: (d[2], d[3])))
                ready.append((key, opened, text, done[-1][4]))
            else:
                expired += [(key, opened, d[2], d[3], d[4]) for d in own]
    return sorted(ready), sorted(expired)


@pytest.mark.parametrize(("after", "hot"), [(0, None), (30, 3), (200, None)])
def test_periods(spark, rows, monkeypatch, after, hot):
    """Groups that expire and open again, complete late, or get more parts than announced."""
    if hot:
        monkeypatch.setattr(running, "HOT_ROWS", hot)
    rng = random.Random(after)
    data = [
        (rng.choice(["a", "b", "c", "d", None]), 3 if rng.random() < 0.8 else 0, rng.randrange(4), rng.choice("xyz"), rng.randrange(60) * 12)
        for _ in range(160)
    ]
    data += [("once", 2, 0, "p", 5), ("once", 2, 1, "q", 5 + after), ("late", 2, 0, "p", 5), ("late", 2, 1, "q", 6 + after)]
    df = parts(spark, *data).repartition(3)
    ready, expired = simulated_periods(data, after)
    found = R.reassemble_in_time(df, ["key"], after_ms=after).select("key", "opened_at", "text", "completed_at")
    assert rows(found) == sorted(ready, key=repr)
    now = 400
    left = R.expire(df, ["key"], now, after_ms=after).select("key", "opened_at", "ind", "text", "sent_time")
    assert rows(left) == sorted([e for e in expired if now - e[1] > after], key=repr)


@pytest.mark.parametrize("hot_list", [0, R.HOT_KEYS])
def test_oversized_group(spark, rows, monkeypatch, hot_list):
    """A group grown past any announced size is counted, listed and left out; also when it is
    not among the hot keys."""
    monkeypatch.setattr(R, "HOT_KEYS", hot_list)
    n = 40_000
    big = spark.range(n).select(
        F.lit("big").alias("key"), F.lit(1).cast("smallint").alias("id"), F.lit(3).cast("smallint").alias("size"),
        (F.col("id") % 5).cast("smallint").alias("ind"), F.lit(9).alias("provider_id"),
        F.concat(F.lit("t"), F.col("id")).alias("text"), F.col("id").alias("sent_time"),
    )
    df = big.unionByName(parts(spark, ("a", 2, 0, "x", 1), ("a", 2, 1, "y", 2)))
    assert rows(R.reassemble(df, ["key"]), "key", "text") == [("a", "xy")]
    listed = rows(R.index_list(df, ["key"]))
    assert listed == [("a", 0, 1), ("a", 1, 1), *(("big", i, 8000) for i in range(5))]
    # Three of the parts made it complete.
    assert R.expire(df, ["key"], 10**9).count() == 0
    never = df.withColumn("size", F.lit(0).cast("smallint"))
    assert R.expire(never, ["key"], 10**9).count() == n + 2
    summary = R.group_parts(R.grouped(df, ["key"]))
    assert rows(summary, "key", "n_parts", "complete") == [("a", 2, True), ("big", n, False)]


def test_scans_of_reassembly(spark, work):
    """The feed is read once per use of its distinct parts, which share an exchange when run."""
    parts(spark, ("a", 2, 0, "x", 1)).write.parquet(work)
    df = spark.read.parquet(work)

    def scans(found):
        return found._jdf.queryExecution().executedPlan().toString().count("FileScan")

    assert scans(R.reassemble(df, ["key"])) == 3
    assert scans(R.group_parts(R.grouped(df, ["key"]))) == 1


def test_index_list(spark, rows):
    df = parts(spark, ("a", 3, 2, "z", 1), ("a", 3, 0, "x", 2), ("a", 3, 2, "Z", 3), ("a", 3, 2, "Z", 3))
    assert rows(R.index_list(df, ["key"])) == [("a", 0, 1), ("a", 2, 2)]


@pytest.mark.parametrize("hot", [None, 2])
def test_index_text(spark, rows, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(running, "HOT_ROWS", hot)
    data = [("a", 3, i % 5, f"t{i % 9}", i) for i in range(40)] + [("b", 1, 12, "x", 1), ("b", 1, 3, "x", 1), ("b", 1, 3, "x", 1), (None, 1, 1, "x", 1)]
    got = R.index_text(parts(spark, *data), ["key"], per_shard=7)
    index = sorted(i % 5 for i in range(40))
    want = [("a", n, ",".join(map(str, index[low : low + 7]))) for n, low in enumerate(range(0, 40, 7))]
    assert rows(got) == sorted([*want, ("b", 0, "3,12")], key=repr)


def feeds(spark, n=10):
    """The delivery funnel: order 0, 4, 8 never sent, 6 sent without status."""
    orders = [i for i in range(n)]
    received = spark.createDataFrame([(str(i), i * 1000, i * 1000) for i in orders], "id STRING, received_time BIGINT, arrival BIGINT")
    layout = 'id STRING, provider_id STRING, ext_message_id STRING, `from` STRING, `to` STRING, status STRING'
    sent = spark.createDataFrame(
        [(str(i), "p", f"e{i}", None, f"t{i}", "SENT", i * 1000 + 10) for i in orders if i % 4],
        layout + ", sent_time BIGINT",
    )
    status = spark.createDataFrame(
        [(f"s{i}", "p", f"e{i}", None, f"t{i}", "DELIVERED", i * 1000 + 30) for i in orders if i % 4 and i % 6],
        layout + ", status_time BIGINT",
    )
    sent = sent.withColumns({"arrival": F.col("sent_time"), "ts": F.timestamp_millis("sent_time")})
    status = status.withColumns({"arrival": F.col("status_time"), "ts": F.timestamp_millis("status_time")})
    return received, sent, status


def test_final_status(spark, rows):
    _, sent, status = feeds(spark)
    got = M.final_status(sent, status)
    assert rows(got, "id", "status", "out_of_order") == [(str(i), "DELIVERED", False) for i in (1, 2, 3, 5, 7, 9)]
    early = status.withColumn("status_time", F.col("status_time") - 25).withColumn("ts", F.timestamp_millis("status_time"))
    assert M.final_status(sent, early).where("out_of_order").count() == 6


def test_monitor(spark, rows):
    received, sent, status = feeds(spark)
    status = status.withColumn("id", F.expr("substring(id, 2)"))
    state = M.monitor_state(received, sent, status)
    assert rows(state, "id", "counter") == [
        (str(i), 0 if i % 4 == 0 else 1 if i % 6 == 0 else 2) for i in range(10)
    ]
    assert rows(M.completed(state), "id") == [(str(i),) for i in (1, 2, 3, 5, 7, 9)]
    # first seen more than two minutes before now: strictly
    assert rows(M.alerts(state, 124_001), "id") == [("0",), ("4",)]
    assert rows(M.alerts(state, 124_000), "id") == [("0",)]


def test_monitor_modes(spark, rows):
    received, sent, status = feeds(spark)
    twice = sent.where("id = '6'").withColumn("arrival", F.col("arrival") + 5)
    early = sent.where("id = '1'").withColumn("arrival", F.col("arrival") - 100)
    stray = sent.where("id = '2'").withColumn("id", F.lit("never received"))
    none = status.where("false")
    state = M.monitor_state(received, twice.unionByName(sent.where("id = '6'")).unionByName(early).unionByName(stray), none)
    assert rows(M.completed(state), "id") == [("6",)]
    assert rows(M.completed(state, "flags"), "id") == []
    assert rows(state.where("id = '1'"), "id", "counter", "provider_id") == [("1", 0, None)]
    assert state.where("id = 'never received'").count() == 0
    with pytest.raises(ValueError):
        M.completed(state, "other")


def test_sections(spark, rows):
    views = spark.createDataFrame([("s", 10, 100), ("s", 30, None)], "key STRING, arrival BIGINT, view_ms BIGINT")
    data = [("s", 5, 50), ("s", 11, 100), ("s", 12, 101), ("s", 13, 2100), ("s", 31, 5000), ("t", 1, 1)]
    events = spark.createDataFrame(data, "key STRING, arrival BIGINT, ts_ms BIGINT")
    assert rows(S.active_events(events, views), "key", "arrival") == [("s", 12), ("s", 13)]
    assert rows(S.settled_events(events, views), "key", "arrival") == [("s", 13), ("s", 31), ("s", 5), ("t", 1)]
    typed = spark.createDataFrame([("s", "pageView"), ("s", "click"), ("s", None)], "key STRING, type STRING")
    assert rows(S.not_page_views(typed), "type") == [("click",)]
