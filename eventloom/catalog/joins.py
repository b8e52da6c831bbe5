"""Joins."""

from pyspark.sql import functions as F

from eventloom.catalog.bindings import (
    EVENTS,
    HOUR_MS,
    NOT_VIEWS,
    RECEIVED,
    SENT,
    SHUFFLED,
    STATUS,
    VIEWS,
)
from eventloom.catalog.bindings import events, events_and_views, received, sent, shuffled, status, table
from eventloom.catalog.registry import query
from eventloom.operators.joins import asof_join, interval_join, lookup, raise_to_running_max
from eventloom.plans.monitoring import final_status, sent_rows, status_rows
from eventloom.plans.sections import active_events, not_page_views, settled_events


def _timed(feed, kind, prefix):
    """Events of a kind; on a stream their time is the watermarked ``ts``, so that state is let go."""
    rows = feed.where(F.col("type") == kind)
    time = F.col("ts") if "ts" in feed.columns else F.timestamp_millis("ts_ms")
    return rows.select(
        "key",
        F.col("arrival").alias(f"{prefix}_arrival"),
        F.col("type").alias(f"{prefix}_value"),
        time.alias(f"{prefix}_ts"),
    )


def joined_objects(feed, within_ms=HOUR_MS):
    """Clicks with the purchases of the same key near in time, values and keys joined by a comma."""
    pairs = interval_join(
        _timed(feed, "click", "l"), _timed(feed, "purchase", "r"), ["key"], within_ms, "l_ts", "r_ts"
    )
    return pairs.select(
        F.concat_ws(",", "key", "key").alias("key"),
        F.concat_ws(",", "l_value", "r_value").alias("value"),
        F.unix_millis(F.greatest("l_ts", "r_ts")).alias("timestamp"),
        "l_arrival",
        "r_arrival",
    )


JOINED_OBJECTS = f"""SELECT l.key::VARCHAR || ',' || r.key::VARCHAR AS key, l.type || ',' || r.type AS value,
  greatest(l.ts_ms, r.ts_ms) AS "timestamp", l.arrival AS l_arrival, r.arrival AS r_arrival
FROM {EVENTS} l JOIN {EVENTS} r ON l.key=r.key AND l.type='click' AND r.type='purchase'
  AND r.ts_ms BETWEEN l.ts_ms-{HOUR_MS} AND l.ts_ms+{HOUR_MS}"""


@query("join_interval", JOINED_OBJECTS)
def join_interval(spark, sf_dir):
    return joined_objects(events(spark, sf_dir))


FINAL_STATUS = f"""SELECT s.id, d.provider_id, d."from", d."to", d.ext_message_id, d.status, d.status_time,
  s.sent_time > d.status_time AS out_of_order
FROM {SENT} s JOIN {STATUS} d ON s.provider_id || s.ext_message_id || COALESCE(s."from", 'null') || s."to"
    = d.provider_id || d.ext_message_id || COALESCE(d."from", 'null') || d."to"
  AND abs(s.sent_time - d.status_time) <= 60000"""


@query("join_interval_rekeyed", FINAL_STATUS)
def join_interval_rekeyed(spark, sf_dir):
    return final_status(sent(spark, sf_dir), status(spark, sf_dir))


ACTIVE = f"""SELECT e.key, e.ts_ms, e.arrival, e.type, v.view_ms FROM {NOT_VIEWS} e
  ASOF JOIN {VIEWS} v ON e.key=v.key AND e.arrival > v.arrival
  WHERE v.view_ms IS NOT NULL AND e.ts_ms > v.view_ms"""
SETTLED = f"""SELECT e.key, e.ts_ms, e.arrival, e.type, v.view_ms FROM {NOT_VIEWS} e
  ASOF LEFT JOIN {VIEWS} v ON e.key=v.key AND e.arrival > v.arrival
  WHERE v.view_ms IS NULL OR e.ts_ms >= v.view_ms + 2000"""


@query("join_stream_table", ACTIVE)
def join_stream_table(spark, sf_dir):
    return active_events(*events_and_views(events(spark, sf_dir)))


@query("join_stream_table_left", SETTLED)
def join_stream_table_left(spark, sf_dir):
    return settled_events(*events_and_views(events(spark, sf_dir)))


@query(
    "join_stream_table_left_self",
    f"SELECT key, ts_ms, arrival, type FROM {EVENTS} WHERE type<>'view'",
)
def join_stream_table_left_self(spark, sf_dir):
    e = events(spark, sf_dir).select("key", "ts_ms", "arrival", "type")
    return not_page_views(e, "view")


_FIRST_RECEIVED = f"(SELECT id, MIN(received_time) AS received_time, MIN(arrival) AS arrival FROM {RECEIVED} GROUP BY id)"


@query(
    "join_table_enrich_sent",
    f"""SELECT s.id, s.provider_id, s.ext_message_id, s.status AS sent_status, s.sent_time AS sent_status_time,
      r.received_time, 1::BIGINT AS counter
    FROM {SENT} s JOIN {_FIRST_RECEIVED} r ON s.id=r.id AND s.arrival > r.arrival""",
)
def join_table_enrich_sent(spark, sf_dir):
    return sent_rows(sent(spark, sf_dir), received(spark, sf_dir)).select(
        "id", "provider_id", "ext_message_id", "sent_status", "sent_status_time", "received_time", "counter"
    )


@query(
    "join_table_enrich_status",
    f"""SELECT s.id, s.provider_id, s.ext_message_id, s.status AS dr_status, s.status_time AS dr_status_time,
      r.received_time, 1::BIGINT AS counter
    FROM {STATUS} s JOIN {_FIRST_RECEIVED} r ON s.id=r.id AND s.arrival > r.arrival""",
)
def join_table_enrich_status(spark, sf_dir):
    return status_rows(status(spark, sf_dir), received(spark, sf_dir)).select(
        "id", "provider_id", "ext_message_id", "dr_status", "dr_status_time", "received_time", "counter"
    )


@query(
    "lookup_global",
    """SELECT c_custkey, c_name, n_name FROM customer
    LEFT JOIN nation ON c_nationkey=n_nationkey AND n_regionkey<>2""",
)
def lookup_global(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").where(F.col("n_regionkey") != 2)
    dim = nations.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return lookup(table(spark, sf_dir, "customer"), dim, ["c_nationkey"]).select(
        "c_custkey", "c_name", "n_name"
    )


@query(
    "lookup_running_max",
    f"""SELECT key, arrival, late_arrival, MAX(ts_ms) OVER (PARTITION BY key ORDER BY late_arrival, arrival
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ts_ms FROM {SHUFFLED}""",
)
def lookup_running_max(spark, sf_dir):
    e = shuffled(events(spark, sf_dir)).select("key", "arrival", "late_arrival", "ts_ms")
    return raise_to_running_max(e, ["key"], ["late_arrival", "arrival"], "ts_ms")
