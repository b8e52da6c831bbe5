"""Event-time windows and late records."""

from pyspark.sql import functions as F

from eventloom.catalog.bindings import EVENTS, HOUR_MS, SHUFFLED, events, shuffled
from eventloom.catalog.registry import query
from eventloom.functions.keys import window_key
from eventloom.operators.running import hot_ranges, running
from eventloom.operators.windows import (
    drop_late,
    drop_late_for_sessions,
    session,
    sliding,
    tumbling,
    tumbling_end,
    tumbling_updates,
    with_stream_time,
)

SIZE = 6 * HOUR_MS
GAP = 2 * HOUR_MS
SLIDING_GRACE = 600_000


@query(
    "win_tumbling",
    f"""SELECT key, ts_ms - ts_ms%{SIZE} AS window_start, ts_ms - ts_ms%{SIZE} + {SIZE} AS window_end,
      COUNT(*) AS counter FROM {EVENTS} GROUP BY ALL""",
)
def win_tumbling(spark, sf_dir):
    return tumbling(events(spark, sf_dir), ["key"], "ts_ms", SIZE)


@query(
    "win_tumbling_updates",
    f"""SELECT key, arrival, ts_ms - ts_ms%{SIZE} AS window_start, ts_ms - ts_ms%{SIZE} + {SIZE} AS window_end,
      ROW_NUMBER() OVER (PARTITION BY key, ts_ms - ts_ms%{SIZE} ORDER BY arrival) AS counter FROM {EVENTS}""",
)
def win_tumbling_updates(spark, sf_dir):
    return tumbling_updates(events(spark, sf_dir), ["key"], "ts_ms", SIZE, ["arrival"])


ORDER = ["late_arrival", "arrival"]


def in_disorder(spark, sf_dir):
    return shuffled(events(spark, sf_dir)).select("source", "key", "ts_ms", "arrival", "late_arrival")


TIMED = f"""(SELECT source, key, ts_ms, arrival, late_arrival, MAX(ts_ms) OVER (
      PARTITION BY source ORDER BY late_arrival, arrival
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stream_time FROM {SHUFFLED})"""


def _kept(spark, sf_dir, window_end, grace_ms=0):
    """The feed in disorder without its late rows."""
    return drop_late(in_disorder(spark, sf_dir), "source", ORDER, "ts_ms", window_end, grace_ms)


def _kept_sql(window_end, grace_ms=0):
    return f"""(SELECT source, key, ts_ms, arrival, late_arrival FROM {TIMED}
    WHERE {window_end} > stream_time - {grace_ms})"""


# Rounds of the SQL below; a test shows that the last ones keep nothing more.
ROUNDS = 5


def kept_for_sessions_sql(grace_ms=0, gap_ms=None, rounds=ROUNDS):
    """Rows in time; then, round by round, late ones from which the rows kept so far that came before lead to
    the closing time, no two of them further apart than the gap."""
    gap = GAP if gap_ms is None else gap_ms
    steps = [f"""timed AS MATERIALIZED (SELECT *, stream_time - {grace_ms} - {gap} AS closed FROM {TIMED}),
      kept0 AS MATERIALIZED (SELECT * FROM timed WHERE ts_ms >= closed)"""]
    for i in range(rounds):
        steps.append(f"""kept{i + 1} AS MATERIALIZED (SELECT * FROM kept{i} UNION ALL SELECT * FROM timed t
        WHERE (source, late_arrival, arrival) IN (SELECT (source, late_arrival, arrival) FROM (
          SELECT source, late_arrival, arrival, closed, ts, MAX(ts - before) OVER (
            PARTITION BY source, late_arrival, arrival ORDER BY ts) AS widest FROM (
            SELECT l.source, l.late_arrival, l.arrival, l.closed, k.ts_ms AS ts, LAG(k.ts_ms, 1, l.ts_ms) OVER (
              PARTITION BY l.source, l.late_arrival, l.arrival ORDER BY k.ts_ms) AS before
            FROM (SELECT * FROM timed WHERE ts_ms < closed) l JOIN kept{i} k ON k.source = l.source AND k.key = l.key
              AND (k.late_arrival, k.arrival) < (l.late_arrival, l.arrival) AND k.ts_ms >= l.ts_ms))
          WHERE widest <= {gap} AND ts >= closed)
        AND (source, late_arrival, arrival) NOT IN (SELECT (source, late_arrival, arrival) FROM kept{i}))""")
    return f"(WITH {', '.join(steps)} SELECT source, key, ts_ms, arrival, late_arrival FROM kept{rounds})"


def _kept_for_sessions(spark, sf_dir, grace_ms=0):
    return drop_late_for_sessions(in_disorder(spark, sf_dir), "source", ["key"], ORDER, "ts_ms", GAP, grace_ms)


TUMBLING_END = f"ts_ms - ts_ms%{SIZE} + {SIZE}"
SESSION_GRACE = GAP // 4


@query(
    "win_tumbling_grace",
    f"""SELECT key, ts_ms - ts_ms%{SIZE} AS window_start, ts_ms - ts_ms%{SIZE} + {SIZE} AS window_end,
      COUNT(*) AS counter FROM {_kept_sql(TUMBLING_END, 600_000)} GROUP BY ALL""",
)
def win_tumbling_grace(spark, sf_dir):
    return tumbling(_kept(spark, sf_dir, tumbling_end("ts_ms", SIZE), 600_000), ["key"], "ts_ms", SIZE)


def sessions_sql(feed, more="", columns=""):
    return f"""(SELECT key, MIN(ts_ms) AS window_start, MAX(ts_ms) AS window_end, COUNT(*) AS counter{more} FROM (
  SELECT key, ts_ms{columns}, SUM(new) OVER (PARTITION BY key ORDER BY ts_ms, arrival) AS s FROM (
    SELECT key, ts_ms, arrival{columns}, CASE WHEN ts_ms - LAG(ts_ms) OVER (PARTITION BY key ORDER BY ts_ms, arrival)
      <= {GAP} THEN 0 ELSE 1 END AS new FROM {feed})) GROUP BY key, s)"""


SESSIONS = sessions_sql(EVENTS)


@query(
    "win_session",
    f"""SELECT window_start::VARCHAR || '_' || window_end::VARCHAR || '_' || key::VARCHAR AS window_key,
      counter FROM {sessions_sql(kept_for_sessions_sql(SESSION_GRACE))}""",
)
def win_session(spark, sf_dir):
    kept = _kept_for_sessions(spark, sf_dir, SESSION_GRACE)
    found = session(kept, ["key"], "ts_ms", GAP)
    return found.select(window_key("window_start", "window_end", "key").alias("window_key"), "counter")


@query(
    "win_session_count",
    f"""SELECT key, counter FROM {sessions_sql(kept_for_sessions_sql())} WHERE counter > 1""",
)
def win_session_count(spark, sf_dir):
    found = session(_kept_for_sessions(spark, sf_dir), ["key"], "ts_ms", GAP)
    return found.where(F.col("counter") > 1).select("key", "counter")


def sliding_sql(feed):
    return f"""WITH e AS (SELECT * FROM {feed}),
    starts AS (SELECT DISTINCT key, ts_ms - {SIZE} AS st FROM e UNION SELECT DISTINCT key, ts_ms + 1 FROM e)
    SELECT s.key, s.st AS window_start, s.st + {SIZE} AS window_end, COUNT(*) AS counter
    FROM starts s JOIN e ON e.key=s.key AND e.ts_ms BETWEEN s.st AND s.st + {SIZE} GROUP BY ALL"""


def sliding_open_sql(feed):
    """Windows made by rows they were open for, with the rows that came before they closed."""
    return f"""WITH e AS (SELECT *, stream_time - {SLIDING_GRACE} AS closed FROM {feed}),
    starts AS (SELECT DISTINCT key, ts_ms - {SIZE} AS st FROM e WHERE ts_ms > closed
      UNION SELECT DISTINCT key, ts_ms + 1 FROM e WHERE ts_ms + 1 + {SIZE} > closed)
    SELECT s.key, s.st AS window_start, s.st + {SIZE} AS window_end, COUNT(*) AS counter
    FROM starts s JOIN e ON e.key=s.key AND e.ts_ms BETWEEN s.st AND s.st + {SIZE} AND s.st + {SIZE} > e.closed
    GROUP BY ALL"""


@query("win_sliding", sliding_open_sql(TIMED))
def win_sliding(spark, sf_dir):
    # The few late rows hardly move the quantiles of a hot key.
    hot = hot_ranges(events(spark, sf_dir), ["key"], "ts_ms")
    timed = with_stream_time(in_disorder(spark, sf_dir), "source", ORDER, "ts_ms")
    return sliding(timed, ["key"], "ts_ms", SIZE, F.col("stream_time") - SLIDING_GRACE, hot=hot)


@query("late_drop", f"SELECT * FROM {_kept_sql(TUMBLING_END)}")
def late_drop(spark, sf_dir):
    return _kept(spark, sf_dir, tumbling_end("ts_ms", SIZE))


MARKED = f"""(SELECT *, CASE WHEN ts_ms < MAX(ts_ms) OVER (PARTITION BY key ORDER BY late_arrival, arrival
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS behind
  FROM {kept_for_sessions_sql(SESSION_GRACE)})"""


@query(
    "session_merge",
    f"SELECT * FROM {sessions_sql(MARKED, ', SUM(behind)::BIGINT AS behind', ', behind')}",
)
def session_merge(spark, sf_dir):
    """Sessions of rows in disorder, with how many came behind a later row of their key: such rows
    prolong a session at its start, fill it, or make one of two."""
    kept = _kept_for_sessions(spark, sf_dir, SESSION_GRACE)
    met = running(kept, ["key"], ORDER, {"top": ("max", F.col("ts_ms"))}, inclusive=False)
    behind = F.coalesce(F.col("ts_ms") < F.col("top"), F.lit(False)).cast("bigint")
    aggs = {"counter": ("count", F.lit(1)), "behind": ("sum", behind)}
    return session(met, ["key"], "ts_ms", GAP, aggs)
