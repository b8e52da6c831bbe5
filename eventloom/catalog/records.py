"""Projections, filters and key operators."""

from pyspark.sql import functions as F

from eventloom.catalog.bindings import EVENTS, HOUR_MS, RECEIVED, SENT, events, received, sent, table
from eventloom.catalog.registry import query
from eventloom.functions.eventtime import display_time
from eventloom.functions.keys import section_key, window_key
from eventloom.operators.changelog import count_updates, first_by_key, table_filter
from eventloom.operators.kv import (
    branch,
    collect_maps,
    flat_map,
    holds,
    keep_if,
    keep_unless,
    partition_by_prefix,
)
from eventloom.operators.kv import peek as look_at
from eventloom.operators.windows import tumbling
from eventloom.plans.monitoring import delivery_key


def _with_gaps(spark, sf_dir):
    """Events whose value is missing for errors."""
    e = events(spark, sf_dir)
    return e.withColumn("value", F.when(F.col("type") != "error", F.col("value")))


WITH_GAPS = f"""(SELECT key, ts_ms, arrival, type, CASE WHEN type<>'error' THEN value END AS value
  FROM {EVENTS})"""


@query("filter_pred", f"SELECT key, arrival, value FROM {EVENTS} WHERE type='click'")
def filter_pred(spark, sf_dir):
    return events(spark, sf_dir).where(F.col("type") == "click").select("key", "arrival", "value")


@query("filter_not_null", f"SELECT key, arrival, value FROM {WITH_GAPS} WHERE value IS NOT NULL")
def filter_not_null(spark, sf_dir):
    return _with_gaps(spark, sf_dir).where(F.col("value").isNotNull()).select("key", "arrival", "value")


@query("filter_by_value", f"SELECT key, arrival, value FROM {WITH_GAPS} WHERE value > 10")
def filter_by_value(spark, sf_dir):
    return keep_if(_with_gaps(spark, sf_dir), F.col("value") > 10, "value").select(
        "key", "arrival", "value"
    )


@query(
    "table_filter",
    f"""SELECT key, arrival, CASE WHEN n%2=1 THEN n END AS n FROM (
      SELECT key, arrival, ROW_NUMBER() OVER (PARTITION BY key ORDER BY arrival) AS n FROM {EVENTS})""",
)
def table_filter_updates(spark, sf_dir):
    counts = count_updates(events(spark, sf_dir).select("key", "arrival"), ["key"], ["arrival"])
    return table_filter(counts, "n", F.col("n") % 2 == 1)


@query("map_values", f"SELECT key, arrival, upper(type) AS label, ts_ms//1000 AS second FROM {EVENTS}")
def map_values(spark, sf_dir):
    return events(spark, sf_dir).select(
        "key", "arrival", F.upper("type").alias("label"), F.floor(F.col("ts_ms") / 1000).alias("second")
    )


@query(
    "map_values_filter_nulls",
    f"SELECT key, arrival, upper(type) AS label FROM {EVENTS} WHERE type<>'error'",
)
def map_values_filter_nulls(spark, sf_dir):
    label = F.when(F.col("type") != "error", F.upper("type"))
    return (
        events(spark, sf_dir)
        .select("key", "arrival", label.alias("label"))
        .where(F.col("label").isNotNull())
    )


@query(
    "table_map_values",
    f"SELECT id, MIN(received_time) AS received_time, 0::BIGINT AS counter FROM {RECEIVED} GROUP BY id",
)
def table_map_values(spark, sf_dir):
    return first_by_key(received(spark, sf_dir), ["id"], ["arrival"]).select(
        "id", "received_time", F.lit(0).cast("bigint").alias("counter")
    )


@query(
    "flat_map_values",
    """SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
    WHERE line<>''""",
)
def flat_map_values(spark, sf_dir):
    lines = F.transform(F.split("text", "\n", -1), lambda s: F.nullif(s, F.lit("")))
    return flat_map(table(spark, sf_dir, "documents").select("doc_id", "text"), lines, "line").drop("text")


def _six_hours(spark, sf_dir):
    return tumbling(events(spark, sf_dir), ["key"], "ts_ms", 6 * HOUR_MS)


SIX_HOURS = f"""(SELECT key, ts_ms - ts_ms%{6 * HOUR_MS} AS window_start,
  ts_ms - ts_ms%{6 * HOUR_MS} + {6 * HOUR_MS} AS window_end, COUNT(*) AS counter
  FROM {EVENTS} GROUP BY ALL)"""


@query(
    "rekey_window",
    f"""SELECT window_start::VARCHAR || '_' || window_end::VARCHAR || '_' || key::VARCHAR AS window_key,
      counter FROM {SIX_HOURS}""",
)
def rekey_window(spark, sf_dir):
    return _six_hours(spark, sf_dir).select(
        window_key("window_start", "window_end", "key").alias("window_key"), "counter"
    )


@query("window_key_only", f"SELECT key, counter FROM {SIX_HOURS}")
def window_key_only(spark, sf_dir):
    return _six_hours(spark, sf_dir).select("key", "counter")


@query(
    "select_key",
    f"""SELECT id, sent_time, provider_id || ext_message_id || COALESCE("from", 'null') || "to" AS delivery_key
    FROM {SENT}""",
)
def select_key(spark, sf_dir):
    return sent(spark, sf_dir).select("id", "sent_time", delivery_key().alias("delivery_key"))


def _sections(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("section_id"),
        F.col("l_partkey").alias("dyid"),
        F.when(F.col("l_linenumber") != 7, F.col("l_orderkey")).alias("rri"),
    )


SECTIONS = """(SELECT l_suppkey AS section_id, l_partkey AS dyid,
  CASE WHEN l_linenumber<>7 THEN l_orderkey END AS rri FROM lineitem)"""


@query(
    "composite_key",
    f"""SELECT section_id::VARCHAR || '|' || dyid::VARCHAR || '|' || COALESCE(rri::VARCHAR, 'null') AS section_key,
      COUNT(*) AS n FROM {SECTIONS} GROUP BY ALL""",
)
def composite_key(spark, sf_dir):
    keyed = _sections(spark, sf_dir).select(section_key("section_id", "dyid", "rri").alias("section_key"))
    return keyed.groupBy("section_key").agg(F.count(F.lit(1)).alias("n"))


@query(
    "partition_by_prefix",
    f"""SELECT section_id, dyid, COUNT(*) AS n, TRUE AS within_spread FROM {SECTIONS} GROUP BY ALL""",
)
def by_prefix(spark, sf_dir):
    placed = partition_by_prefix(
        _sections(spark, sf_dir), 16, ["section_id", "dyid"], ["section_id", "dyid", "rri"], spread=4
    )
    return (
        placed.withColumn("part", F.spark_partition_id())
        .groupBy("section_id", "dyid")
        .agg(F.count(F.lit(1)).alias("n"), (F.count_distinct("part") <= 4).alias("within_spread"))
    )


@query(
    "branch",
    f"""SELECT arrival, CASE WHEN type='click' THEN 'clicks' ELSE 'large' END AS branch FROM {EVENTS}
    WHERE type='click' OR value > 50""",
)
def branches(spark, sf_dir):
    e = events(spark, sf_dir).select("arrival", "type", "value")
    clicks, large = branch(e, [F.col("type") == "click", F.col("value") > 50])
    return clicks.select("arrival", F.lit("clicks").alias("branch")).unionByName(
        large.select("arrival", F.lit("large").alias("branch"))
    )


@query("peek", f"SELECT key, arrival, ts_ms FROM {EVENTS}")
def peek(spark, sf_dir):
    e = events(spark, sf_dir).select("key", "arrival", "ts_ms")
    return look_at(e, rows=F.count(F.lit(1)), first=F.min("ts_ms"), last=F.max("ts_ms"))[0]


@query(
    "kv_filters",
    f"""SELECT key, value, arrival FROM {WITH_GAPS}
    WHERE key%2=0 AND NOT COALESCE(value > 50, FALSE) AND NOT (key=4 AND type='view')""",
)
def kv_filters(spark, sf_dir):
    pairs = _with_gaps(spark, sf_dir).where(holds(F.col("key") % 2 == 0))
    small = keep_unless(pairs, F.col("value") > 50)
    return keep_unless(small, (F.col("key") == 4) & (F.col("type") == "view")).select(
        "key", "value", "arrival"
    )


@query(
    "kv_map",
    f"SELECT type AS key, key AS value, arrival + 1 AS next FROM {EVENTS}",
)
def kv_map(spark, sf_dir):
    return events(spark, sf_dir).select(
        F.col("type").alias("key"), F.col("key").alias("value"), (F.col("arrival") + 1).alias("next")
    )


@query(
    "kv_collect_map",
    f"""SELECT key, string_agg(type || '=' || COALESCE(last::VARCHAR, 'null'), ',' ORDER BY type) AS entries
    FROM (SELECT key, type, arg_max(CASE WHEN arrival%7<>0 THEN arrival ELSE -1 END, arrival) AS l,
        CASE WHEN l<>-1 THEN l END AS last FROM {EVENTS} GROUP BY key, type) GROUP BY key""",
)
def kv_collect_map(spark, sf_dir):
    e = events(spark, sf_dir).select(
        "key", "type", "arrival", F.when(F.col("arrival") % 7 != 0, F.col("arrival")).alias("last")
    )
    maps = collect_maps(e, ["key"], "type", "last", ["arrival"])
    shown = F.transform(
        F.array_sort(F.map_entries("entries")),
        lambda p: F.concat(p["key"], F.lit("="), F.coalesce(p["value"].cast("string"), F.lit("null"))),
    )
    return maps.select("key", F.array_join(shown, ",").alias("entries"))


@query(
    "event_time_display",
    """SELECT event_id AS arrival, strftime(make_timestamp((epoch_us(ts)//1000)*1000), '%Y-%m-%d %H:%M:%S.%g') AS shown
    FROM events""",
)
def event_time_display(spark, sf_dir):
    return events(spark, sf_dir).select("arrival", display_time(F.col("ts_ms")).alias("shown"))
