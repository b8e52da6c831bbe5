"""Keyed operators: literal cases, ties and nulls, and split keys against the plain result."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from eventloom.operators import running as running_module
from eventloom.operators.changelog import (
    count_by_key,
    count_updates,
    first_by_key,
    keyed_table,
    latest_by_key,
    max_by_key,
    merge_fields,
    merge_updates,
    seen_once,
    table_filter,
)
from eventloom.operators.joins import (
    asof_join,
    interval_join,
    join_keyed_table,
    raise_to_running_max,
)
from eventloom.operators.kv import branch, collect_maps, flat_map, keep_if, keep_unless, partition_by_prefix, peek
from eventloom.operators.running import hot_keys, hot_ranges, running
from eventloom.operators.udaf import fold_by_key


@pytest.fixture(scope="module")
def skewed(spark):
    """One key with a third of 6,000 rows, many small ones, null keys; arrival is unique."""
    rng = random.Random(7)
    data = []
    for arrival in range(6000):
        key = "hot" if arrival % 3 == 0 else None if arrival % 50 == 1 else f"k{rng.randrange(400)}"
        value = rng.randrange(1000) if rng.random() < 0.7 else None
        data.append((key, arrival, rng.randrange(10**6), value))
    return spark.createDataFrame(data, "key STRING, arrival BIGINT, ts_ms BIGINT, v BIGINT").repartition(7)


def hot_of(df, min_rows=100):
    return hot_keys(df, ["key"], min_rows)


def test_hot_keys(skewed, rows):
    assert rows(hot_of(skewed)) == [("hot",)]
    assert rows(hot_keys(skewed, ["key"])) == []
    assert hot_keys(skewed, ["key"], 2, max_keys=5).count() == 5


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("how", ["hot", "few", "plain"])
def test_running_split(skewed, rows, how, inclusive):
    end = 0 if inclusive else -1
    w = W.partitionBy("key").orderBy("arrival").rowsBetween(W.unboundedPreceding, end)
    want = skewed.where("key IS NOT NULL").select(
        "*",
        F.sum("v").over(w).alias("s"),
        F.max("ts_ms").over(w).alias("m"),
        F.last("v", ignorenulls=True).over(w).alias("l"),
    )
    ranges = hot_ranges(skewed, ["key"], "arrival", min_rows=100)
    outputs = {"s": ("sum", F.col("v")), "m": ("max", F.col("ts_ms")), "l": ("last", F.col("v"))}
    few = hot_ranges(skewed, ["key"], "arrival", min_rows=97, few_keys=True)
    split = {"hot": {"hot": ranges}, "few": {"hot": few}, "plain": {}}[how]
    got = running(skewed, ["key"], ["arrival"], outputs, inclusive=inclusive, **split)
    assert got.columns == want.columns
    assert rows(got) == rows(want)


def test_count_forms(spark, rows):
    df = spark.createDataFrame(
        [("s1", 1), ("s2", 2), ("s1", 3), ("s3", 4), ("s1", 5), (None, 6), (None, 7)],
        "key STRING, arrival BIGINT",
    )
    assert rows(count_by_key(df, ["key"], 2)) == [("s1", 3)]
    assert rows(count_updates(df, ["key"], ["arrival"], 2), "key", "n") == [("s1", 2), ("s1", 3)]


def test_first_latest(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, 10), ("a", 2, None), ("b", 1, 5), ("b", 3, 7), (None, 9, 1)],
        "key STRING, arrival BIGINT, v BIGINT",
    )
    assert rows(latest_by_key(df, ["key"], ["arrival"])) == [("a", 2, None), ("b", 3, 7)]
    assert rows(first_by_key(df, ["key"], ["arrival"])) == [("a", 1, 10), ("b", 1, 5)]
    assert rows(keyed_table(df, ["key"], ["arrival"], "v")) == [("b", 3, 7)]
    assert rows(seen_once(df.where("arrival < 3"), ["key"], ["arrival"])) == [("b", 1, 5)]
    assert rows(max_by_key(df.withColumn("v", -F.col("v")), ["key"], "v")) == [("a", 0), ("b", 0)]
    assert rows(table_filter(df, "v", F.col("v") > 6), "key", "arrival", "v") == [
        ("a", 1, 10), ("a", 2, None), ("b", 1, None), ("b", 3, 7), (None, 9, None),
    ]


def test_merge_fields(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, "x", 0, 0), ("a", 2, None, 7, 1), ("a", 3, "y", 0, 1), ("b", 1, None, 0, 0)],
        "key STRING, arrival BIGINT, t STRING, time BIGINT, n BIGINT",
    )
    got = merge_fields(df, ["key"], ["arrival"], ["t"], ["time"], ["n"], ["arrival"])
    assert rows(got) == [("a", "y", 7, 2, 1), ("b", None, None, 0, 1)]
    for hot in (None, hot_ranges(df, ["key"], "arrival", 2)):
        updates = merge_updates(df, ["key"], ["arrival"], ["t"], ["time"], ["n"], hot=hot)
        assert rows(updates) == [
            ("a", 1, "x", None, 0), ("a", 2, "x", 7, 1), ("a", 3, "y", 7, 2), ("b", 1, None, None, 0),
        ]


def brute_asof(events, table, see_equal):
    out = []
    for key, arrival in events:
        seen = [t for t in table if t[0] == key and (t[1] < arrival or see_equal and t[1] == arrival)]
        out.append((key, arrival, max(seen, key=lambda t: t[1])[2] if seen else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("see_equal", [False, True])
@pytest.mark.parametrize("min_rows", [20, 10**6])
def test_asof(spark, rows, see_equal, min_rows):
    rng = random.Random(3)
    keys = ["hot"] * 5 + list("abcdefg")
    events = [(rng.choice(keys), rng.randrange(200)) for _ in range(150)]
    slots = {(rng.choice(keys), rng.randrange(200)) for _ in range(80)}
    table = [(k, a, rng.randrange(50) if rng.random() < 0.8 else None) for k, a in slots]
    e = spark.createDataFrame(events, "key STRING, arrival BIGINT")
    t = spark.createDataFrame(table, "key STRING, arrival BIGINT, v BIGINT")
    split = dict(hot=hot_ranges(e.unionAll(t.select("key", "arrival")), ["key"], "arrival", min_rows))
    want = brute_asof(events, table, see_equal)
    got = asof_join(e, t, ["key"], "arrival", ["v"], "left", "v", see_equal, **split)
    assert rows(got) == want
    inner = asof_join(e, t, ["key"], "arrival", ["v"], "inner", "v", see_equal, **split)
    assert rows(inner) == [r for r in want if r[2] is not None]


@pytest.mark.parametrize("cell_ms", [None, 1, 7, 1000])
def test_interval_join(spark, rows, cell_ms):
    rng = random.Random(11)
    left = [(rng.choice("aab"), rng.randrange(-300, 300)) for _ in range(80)] + [("z", 0), (None, 0)]
    right = [(rng.choice("aab"), rng.randrange(-300, 300)) for _ in range(80)]
    right += [("z", 60), ("z", -60), ("z", 61), ("z", -61), (None, 0)]
    l = spark.createDataFrame(left, "key STRING, l BIGINT").withColumn("l_ts", F.timestamp_millis("l"))
    r = spark.createDataFrame(right, "key STRING, r BIGINT").withColumn("r_ts", F.timestamp_millis("r"))
    got = interval_join(l, r, ["key"], 60, "l_ts", "r_ts", cell_ms)
    want = sorted((k, a, b) for k, a in left for j, b in right if k == j and k and abs(a - b) <= 60)
    assert rows(got, "key", "l", "r") == sorted(want, key=repr)
    assert ("z", 0, 60) in want and ("z", 0, -60) in want and ("z", 0, 61) not in want


def test_keyed_table_join(skewed, rows):
    table = skewed.where("key IS NOT NULL").groupBy("key").agg(F.max("ts_ms").alias("top"))
    table = table.where(F.col("key") != "k7")
    want = skewed.join(table, "key")
    assert rows(join_keyed_table(skewed, table, ["key"], hot=hot_of(skewed))) == rows(want)
    assert rows(join_keyed_table(skewed, table, ["key"])) == rows(want)
    outer = skewed.join(table, "key", "left")
    without_hot = table.where("key <> 'hot'")
    for t, want in ((table, outer), (without_hot, skewed.join(without_hot, "key", "left"))):
        assert rows(join_keyed_table(skewed, t, ["key"], "left", hot_of(skewed))) == rows(want)


ORDERS = {
    "even": "id",
    "nanoseconds": "1700000000000000000 + id * 1000000000",
    "outliers": "CASE id WHEN 0 THEN 0 WHEN 1 THEN 4611686018427387904 ELSE 1700000000000 + id END",
    "burst": "CASE WHEN id % 10 = 0 THEN id * 1000000 ELSE 500000000 + id END",
}


@pytest.mark.parametrize("aim", [60, 100, 1000, 7000])
@pytest.mark.parametrize("order", ORDERS)
def test_chunks_by_rows(spark, order, aim):
    """Whatever the unit of the order column, no chunk has over twice the rows asked for, and chunks
    follow the order."""
    df = spark.range(10_000).select(F.lit("hot").alias("key"), F.expr(ORDERS[order]).cast("bigint").alias("at"))
    found = hot_ranges(df, ["key"], "at", aim)
    placed = running_module._cut(df.join(found, "key"), "at").select("at", "_chunk").collect()
    sizes = Counter(r._chunk for r in placed)
    # A burst narrower than a quantile stays in one chunk.
    assert max(sizes.values()) <= 2 * aim + 10_000 / running_module.SLICES * (order == "burst")
    in_order = [r._chunk for r in sorted(placed)]
    assert in_order == sorted(in_order)


def test_running_max(spark, rows):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 3), ("a", 3, 9), ("b", 1, 1)], "key STRING, arrival BIGINT, ts BIGINT")
    assert rows(raise_to_running_max(df, ["key"], ["arrival"], "ts")) == [
        ("a", 1, 5), ("a", 2, 5), ("a", 3, 9), ("b", 1, 1),
    ]


def test_record_operators(spark, rows):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 50), (4, 500)], "k INT, v INT")
    assert rows(keep_if(df, F.col("v") > 10, "v")) == [(3, 50), (4, 500)]
    assert rows(keep_unless(df, F.col("v") > 10)) == [(1, 5), (2, None)]
    first, second = branch(df, [F.col("v") > 100, F.col("v") > 10])
    assert rows(first) == [(4, 500)] and rows(second) == [(3, 50)]
    lists = spark.createDataFrame([(1, ["a", None]), (2, []), (3, None)], "k INT, xs ARRAY<STRING>")
    assert rows(flat_map(lists, F.col("xs"), "x"), "k", "x") == [(1, "a")]


@pytest.mark.parametrize("shards", [1, 7])
def test_collect_maps(spark, rows, shards):
    data = [("g", f"k{i % 40}", i, None if i % 7 == 0 else i) for i in range(100)] + [("h", "k", 1, 5)]
    df = spark.createDataFrame(data, "g STRING, k STRING, arrival BIGINT, v BIGINT")
    want = {}
    for g, k, _, v in data:
        want[(g, k)] = v
    got = {}
    for row in collect_maps(df, ["g"], "k", "v", ["arrival"], shards).collect():
        for k, v in row.entries.items():
            assert (row.g, k) not in got
            got[(row.g, k)] = v
    assert got == want


def test_partition_by_prefix(skewed, spark):
    df = skewed.select("key", "arrival", F.lit(1).alias("x"))
    placed = partition_by_prefix(df, 16, ["key"], ["key", "arrival"], spread=6)
    parts = placed.withColumn("part", F.spark_partition_id()).groupBy("key").agg(
        F.count("*").alias("n"), F.count_distinct("part").alias("p")
    )
    by_key = {r.key: (r.n, r.p) for r in parts.collect()}
    assert sum(n for n, _ in by_key.values()) == 6000
    assert by_key["hot"][1] > 3 and by_key[None][1] > 4
    assert all(p <= 6 for k, (_, p) in by_key.items() if k is not None)


def test_peek(skewed):
    seen, metrics = peek(skewed, rows=F.count(F.lit(1)), last=F.max("ts_ms"))
    want = skewed.agg(F.count(F.lit(1)), F.max("ts_ms")).first()
    assert sorted(map(tuple, seen.collect()), key=repr) == sorted(map(tuple, skewed.collect()), key=repr)
    assert (metrics.get["rows"], metrics.get["last"]) == tuple(want)


def test_fold(skewed, rows):
    from pyspark.sql import types as T

    def merge(states):
        return states.groupby("key", as_index=False).agg({"n": "sum", "top": "max"})

    state = T.StructType([T.StructField("n", T.LongType()), T.StructField("top", T.LongType())])
    got = fold_by_key(
        skewed, "key", lambda r: merge(r.assign(n=1, top=r["ts_ms"])), merge, state, max_states=50
    )
    want = skewed.where("key IS NOT NULL").groupBy("key").agg(F.count("*"), F.max("ts_ms"))
    assert rows(got) == rows(want)


def test_pick_without_order(spark, rows):
    """A row with a NULL order is picked only where its key has no other."""
    df = spark.createDataFrame([("a", None, 1), ("a", 5, 2), ("b", None, 3), (None, 1, 4)], "key STRING, at BIGINT, v INT")
    for pick in (first_by_key, latest_by_key):
        assert rows(pick(df, ["key"], ["at"])) == [("a", 5, 2), ("b", None, 3)]


def test_pick_cuts_before_the_exchange(spark):
    df = spark.range(10).selectExpr("id % 3 AS key", "id AS at")
    plan = latest_by_key(df, ["key"], ["at"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan.split("Exchange")[-1]
