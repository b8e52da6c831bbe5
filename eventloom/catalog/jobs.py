"""Whole jobs: reassembly, monitoring, active sections."""

from pyspark.sql import functions as F

from eventloom.catalog.bindings import MONITOR_NOW, PARTS, PARTS_NOW, PARTS_START, RECEIVED, SENT, SLOW_PARTS, STATUS
from eventloom.catalog.bindings import events, events_and_views, parts, received, sent, slow_parts, status
from eventloom.catalog.joins import ACTIVE, FINAL_STATUS, SETTLED
from eventloom.catalog.registry import query
from eventloom.plans import monitoring, reassembly, sections

KEY = ["key"]
_DISTINCT = f"(SELECT DISTINCT * FROM {PARTS})"


def _assembled(source, group="key"):
    return f"""(SELECT {group}, arg_min(id, (sent_time, ind))::SMALLINT AS id,
      arg_min(provider_id, (sent_time, ind))::INTEGER AS provider_id,
      string_agg(text, '' ORDER BY ind, text) AS text, TRUE AS full_message, MIN(sent_time) AS sent_time
    FROM (SELECT * FROM {source}) GROUP BY {group} HAVING COUNT(*) = arg_min(size, sent_time))"""


@query(
    "sort_in_group",
    f"""SELECT key, string_agg(text, '' ORDER BY ind, text) AS text FROM {_DISTINCT} GROUP BY key
    HAVING COUNT(*) = arg_min(size, sent_time)""",
)
def sort_in_group(spark, sf_dir):
    return reassembly.reassemble(parts(spark, sf_dir), KEY).select("key", "text")


@query(
    "min_by_in_group",
    f"""SELECT key, id, provider_id, sent_time FROM {_assembled(_DISTINCT)}""",
)
def min_by_in_group(spark, sf_dir):
    return reassembly.reassemble(parts(spark, sf_dir), KEY).select("key", "id", "provider_id", "sent_time")


@query(
    "union_feeds",
    f"""SELECT id, arrival, 'received' AS feed FROM {RECEIVED} UNION ALL SELECT id, arrival, 'sent' FROM {SENT}
    UNION ALL SELECT id, arrival, 'status' FROM {STATUS}""",
)
def union_feeds(spark, sf_dir):
    def tagged(feed, name):
        return feed.select("id", "arrival", F.lit(name).alias("feed"))

    return (
        tagged(received(spark, sf_dir), "received")
        .unionByName(tagged(sent(spark, sf_dir), "sent"))
        .unionByName(tagged(status(spark, sf_dir), "status"))
    )


@query(
    "index_list",
    f"SELECT key, ind::SMALLINT AS ind, COUNT(*) AS n FROM {_DISTINCT} GROUP BY key, ind",
)
def index_list(spark, sf_dir):
    return reassembly.index_list(parts(spark, sf_dir), KEY)


# Small enough that long messages have several texts.
INDEXES = 5


@query(
    "index_text",
    f"""SELECT key, shard, string_agg(ind::VARCHAR, ',' ORDER BY ind) AS indexes FROM (
      SELECT key, ind, (ROW_NUMBER() OVER (PARTITION BY key ORDER BY ind) - 1) // {INDEXES} AS shard FROM {_DISTINCT})
    GROUP BY key, shard""",
)
def index_text(spark, sf_dir):
    return reassembly.index_text(parts(spark, sf_dir), KEY, INDEXES)


@query(
    "udhi_passthrough",
    f"""SELECT key, id::SMALLINT AS id, provider_id::INTEGER AS provider_id, text, TRUE AS full_message,
      NULL::BIGINT AS sent_time FROM {PARTS} WHERE size <= 1""",
)
def udhi_passthrough(spark, sf_dir):
    return reassembly.pass_through(parts(spark, sf_dir).where(~reassembly.is_multipart()))


@query("udhi_reassemble", f"SELECT * FROM {_assembled(_DISTINCT)}")
def udhi_reassemble(spark, sf_dir):
    return reassembly.reassemble(parts(spark, sf_dir), KEY)


_EARLY = f"""(SELECT * FROM (SELECT *,
    ROW_NUMBER() OVER (PARTITION BY key ORDER BY sent_time, ind, text) AS n,
    FIRST_VALUE(size) OVER (PARTITION BY key ORDER BY sent_time, ind, text) AS wanted FROM {_DISTINCT})
  WHERE n <= wanted)"""


@query(
    "udhi_reassemble_updates",
    f"""SELECT key, arg_min(id, (sent_time, ind))::SMALLINT AS id,
      arg_min(provider_id, (sent_time, ind))::INTEGER AS provider_id,
      string_agg(text, '' ORDER BY ind, text) AS text, TRUE AS full_message,
      MIN(sent_time) AS sent_time, MAX(sent_time) AS completed_at
    FROM {_EARLY} GROUP BY key HAVING COUNT(*) = MAX(wanted)""",
)
def udhi_reassemble_updates(spark, sf_dir):
    return reassembly.reassemble_when_complete(parts(spark, sf_dir), KEY)


_WINDOWED = f"(SELECT *, sent_time - sent_time%600000 AS window_start FROM {_DISTINCT})"


@query("udhi_reassemble_windowed", f"SELECT * FROM {_assembled(_WINDOWED, 'key, window_start')}")
def udhi_reassemble_windowed(spark, sf_dir):
    return reassembly.reassemble_windowed(parts(spark, sf_dir), KEY)


@query(
    "udhi_full",
    f"""SELECT key, id::SMALLINT AS id, provider_id::INTEGER AS provider_id, text, TRUE AS full_message,
      NULL::BIGINT AS sent_time FROM {PARTS} WHERE size <= 1
    UNION ALL SELECT key, id, provider_id, text, full_message, sent_time
    FROM {_assembled(f"{_WINDOWED} WHERE size > 1", 'key, window_start')}""",
)
def udhi_full(spark, sf_dir):
    return reassembly.full_flow(parts(spark, sf_dir), KEY)


def periods_sql(feed):
    """Parts with the time their group was opened: the first part, and the first one past each deadline."""
    return f"""(WITH RECURSIVE p AS MATERIALIZED (SELECT DISTINCT * FROM {feed}),
      o AS (SELECT key, MIN(sent_time) AS opened_at FROM p GROUP BY key
        UNION ALL SELECT o.key, MIN(p.sent_time) FROM o JOIN p ON p.key=o.key AND p.sent_time > o.opened_at + 60000
          GROUP BY o.key)
      SELECT p.*, o.opened_at FROM p JOIN o ON o.key=p.key AND p.sent_time BETWEEN o.opened_at AND o.opened_at + 60000)"""


def _judged_sql(feed):
    """Parts numbered in their group, with its size; complete groups have a part of that number."""
    return f"""(SELECT *, MAX(n) OVER (PARTITION BY key, opened_at) >= wanted AS complete FROM (SELECT *,
      ROW_NUMBER() OVER (PARTITION BY key, opened_at ORDER BY sent_time, ind, text) AS n,
      FIRST_VALUE(size) OVER (PARTITION BY key, opened_at ORDER BY sent_time, ind, text) AS wanted FROM {periods_sql(feed)}))"""


def ready_in_time_sql(feed):
    return f"""SELECT key, arg_min(id, (sent_time, ind))::SMALLINT AS id,
      arg_min(provider_id, (sent_time, ind))::INTEGER AS provider_id, string_agg(text, '' ORDER BY ind, text) AS text,
      TRUE AS full_message, MIN(sent_time) AS sent_time, MAX(sent_time) AS completed_at, opened_at
    FROM {_judged_sql(feed)} WHERE complete AND n <= wanted GROUP BY key, opened_at"""


def expired_sql(feed, now):
    return f"""SELECT key, opened_at, ind::SMALLINT AS ind, id::SMALLINT AS id, provider_id::INTEGER AS provider_id, text,
      FALSE AS full_message, sent_time FROM {_judged_sql(feed)} WHERE NOT complete AND {now} - opened_at > 60000"""


@query("udhi_expire", expired_sql(PARTS, PARTS_NOW))
def udhi_expire(spark, sf_dir):
    return reassembly.expire(parts(spark, sf_dir), KEY, PARTS_NOW)


# When all but the last groups of the slow feed are past their deadline.
SLOW_NOW = PARTS_START + 170_000


@query("udhi_expire_restart", expired_sql(SLOW_PARTS, SLOW_NOW))
def udhi_expire_restart(spark, sf_dir):
    """Groups that expire and are opened again by later parts, some of which complete."""
    return reassembly.expire(slow_parts(parts(spark, sf_dir)), KEY, SLOW_NOW)


@query("udhi_reassemble_in_time", ready_in_time_sql(SLOW_PARTS))
def udhi_reassemble_in_time(spark, sf_dir):
    return reassembly.reassemble_in_time(slow_parts(parts(spark, sf_dir)), KEY)


@query(
    "monitor_received",
    f"SELECT id, MIN(received_time) AS received_time, MIN(arrival) AS seen, 0::BIGINT AS counter FROM {RECEIVED} GROUP BY id",
)
def monitor_received(spark, sf_dir):
    return monitoring.received_rows(received(spark, sf_dir)).select(
        "id", "received_time", "seen", "counter"
    )


# The rows of each message that count: those after it, up to two minutes, until it is complete.
_UNTIL_COMPLETE = {
    "count": "ROW_NUMBER() OVER (PARTITION BY id ORDER BY arrival) <= 2",
    "flags": """arrival <= CASE
      WHEN COUNT(sent_status_time) OVER (PARTITION BY id) > 0 AND COUNT(dr_status_time) OVER (PARTITION BY id) > 0
      THEN greatest(MIN(arrival) FILTER (sent_status_time IS NOT NULL) OVER (PARTITION BY id),
        MIN(arrival) FILTER (dr_status_time IS NOT NULL) OVER (PARTITION BY id)) ELSE arrival END""",
}


def _rows_sql(mode="count"):
    first = f"(SELECT id, MIN(received_time) AS received_time, MIN(arrival) AS arrival FROM {RECEIVED} GROUP BY id)"
    in_time = "s.id=r.id AND s.arrival > r.arrival AND s.arrival <= r.arrival + 120000"
    return f"""(SELECT id, NULL AS provider_id, NULL AS ext_message_id, NULL AS sent_status, NULL AS dr_status,
        received_time, NULL AS sent_status_time, NULL AS dr_status_time, 0 AS counter, arrival FROM {first}
      UNION ALL SELECT * FROM (
        SELECT s.id, provider_id, ext_message_id, status AS sent_status, NULL AS dr_status, r.received_time,
            sent_time AS sent_status_time, NULL AS dr_status_time, 1 AS counter, s.arrival
          FROM {SENT} s JOIN {first} r ON {in_time}
        UNION ALL SELECT s.id, provider_id, ext_message_id, NULL, status, r.received_time, NULL, status_time, 1, s.arrival
          FROM {STATUS} s JOIN {first} r ON {in_time}) QUALIFY {_UNTIL_COMPLETE[mode]})"""


def state_sql(mode="count"):
    return f"""(SELECT id, arg_max(provider_id, arrival) FILTER (provider_id IS NOT NULL) AS provider_id,
    arg_max(ext_message_id, arrival) FILTER (ext_message_id IS NOT NULL) AS ext_message_id,
    arg_max(sent_status, arrival) FILTER (sent_status IS NOT NULL) AS sent_status,
    arg_max(dr_status, arrival) FILTER (dr_status IS NOT NULL) AS dr_status,
    arg_max(received_time, arrival) FILTER (received_time > 0) AS received_time,
    arg_max(sent_status_time, arrival) FILTER (sent_status_time > 0) AS sent_status_time,
    arg_max(dr_status_time, arrival) FILTER (dr_status_time > 0) AS dr_status_time,
    SUM(counter)::BIGINT AS counter, MIN(arrival) AS seen
  FROM {_rows_sql(mode)} GROUP BY id)"""


STATE = state_sql()


def _state(spark, sf_dir, mode="count"):
    return monitoring.monitor_state(
        received(spark, sf_dir), sent(spark, sf_dir), status(spark, sf_dir), mode
    )


@query("monitor_state", f"SELECT * FROM {STATE}")
def monitor_state(spark, sf_dir):
    return _state(spark, sf_dir)


def _latest(column):
    return f"LAST_VALUE({column} IGNORE NULLS) OVER w AS {column}"


@query(
    "monitor_state_updates",
    f"""SELECT id, arrival, {", ".join(_latest(c) for c in (*monitoring.TEXTS, *monitoring.TIMES))},
      SUM(counter) OVER w::BIGINT AS counter, MIN(arrival) OVER w AS seen FROM {_rows_sql()}
    WINDOW w AS (PARTITION BY id ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def monitor_state_updates(spark, sf_dir):
    return monitoring.monitor_updates(
        received(spark, sf_dir), sent(spark, sf_dir), status(spark, sf_dir)
    )


@query("monitor_complete", f"SELECT * FROM {STATE} WHERE counter >= 2")
def monitor_complete(spark, sf_dir):
    return monitoring.completed(_state(spark, sf_dir))


@query(
    "monitor_complete_flags",
    f"SELECT * FROM {state_sql('flags')} WHERE sent_status_time IS NOT NULL AND dr_status_time IS NOT NULL",
)
def monitor_complete_flags(spark, sf_dir):
    return monitoring.completed(_state(spark, sf_dir, "flags"), mode="flags")


@query(
    "monitor_alerts",
    f"SELECT * FROM {STATE} WHERE counter < 2 AND seen + 120000 < {MONITOR_NOW}",
)
def monitor_alerts(spark, sf_dir):
    return monitoring.alerts(_state(spark, sf_dir), MONITOR_NOW)


@query("delivery_final_status", f"SELECT id, status, status_time FROM ({FINAL_STATUS})")
def delivery_final_status(spark, sf_dir):
    return monitoring.final_status(sent(spark, sf_dir), status(spark, sf_dir)).select(
        "id", "status", "status_time"
    )


@query(
    "active_section_events",
    f"""SELECT key, arrival, type, 'active' AS rule FROM ({ACTIVE})
    UNION ALL SELECT key, arrival, type, 'settled' FROM ({SETTLED})""",
)
def active_section_events(spark, sf_dir):
    e, views = events_and_views(events(spark, sf_dir))
    columns = ["key", "arrival", "type"]
    active = sections.active_events(e, views).select(*columns, F.lit("active").alias("rule"))
    settled = sections.settled_events(e, views).select(*columns, F.lit("settled").alias("rule"))
    return active.unionByName(settled)
