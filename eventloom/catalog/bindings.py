"""Feeds on the given tables, each with the SQL subquery that states the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.codecs import encode_json, encode_long
from eventloom.functions.eventtime import wall_clock_millis
from eventloom.schemas import TABLES
from eventloom.sources.feeds import file_feed

HOUR_MS = 3_600_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return file_feed(spark, f"{sf_dir}/{name}.parquet", TABLES[name])


# -- keyed event feed ---------------------------------------------------------------------


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_events(table(spark, sf_dir, "events"))


def shape_events(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("user_id").alias("key"),
        wall_clock_millis(F.col("ts")).alias("ts_ms"),
        F.col("event_id").alias("arrival"),
        F.col("event_type").alias("type"),
        "value",
        "props",
    )


EVENTS = """(SELECT user_id AS key, epoch_us(ts)//1000 AS ts_ms, event_id AS arrival,
  event_type AS type, value, props FROM events)"""


def shuffled(feed: DataFrame) -> DataFrame:
    """The event feed with arrival out of time order, on 8 source partitions."""
    return feed.withColumns(
        {
            "source": F.col("key") % 8,
            "late_arrival": F.col("arrival") + F.col("arrival") * 7919 % 50,
        }
    )


SHUFFLED = f"""(SELECT *, key % 8 AS source, arrival + arrival * 7919 % 50 AS late_arrival
  FROM {EVENTS})"""


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event feed as topic records: JSON values, an event-time header on nine of ten."""
    e = events(spark, sf_dir)
    value = encode_json(
        F.col("arrival").cast("string").alias("id"),
        F.col("ts_ms").alias("timestamp"),
        F.col("type"),
        F.col("props").alias("data"),
    )
    stale = F.struct(F.lit("event-time").alias("key"), encode_long(F.col("ts_ms") - 5).alias("value"))
    current = F.struct(F.lit("event-time").alias("key"), encode_long(F.col("ts_ms")).alias("value"))
    other = F.struct(F.lit("trace").alias("key"), encode_long(F.col("arrival")).alias("value"))
    headers = F.when(F.col("arrival") % 10 == 0, F.array(other)).otherwise(
        F.array(stale, current, other)
    )
    return e.select(
        F.col("key").cast("string").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit("events-stream").alias("topic"),
        (F.col("key") % 8).cast("int").alias("partition"),
        F.col("arrival").alias("offset"),
        F.timestamp_millis(F.col("ts_ms") + 250).alias("timestamp"),
        headers.alias("headers"),
    )


def events_and_views(e: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Views play page views; an error retracts the view time of its key.

    The view time is put half an hour ahead, so that the comparison of times bites.
    """
    e = e.select("key", "ts_ms", "arrival", "type")
    others = e.where(~F.col("type").isin("view", "error"))
    views = e.where(F.col("type").isin("view", "error")).select(
        "key", "arrival", F.when(F.col("type") == "view", F.col("ts_ms") + 1_800_000).alias("view_ms")
    )
    return others, views


VIEWS = f"""(SELECT key, arrival, CASE WHEN type='view' THEN ts_ms + 1800000 END AS view_ms
  FROM {EVENTS} WHERE type IN ('view','error'))"""
NOT_VIEWS = f"(SELECT key, ts_ms, arrival, type FROM {EVENTS} WHERE type NOT IN ('view','error'))"

# -- multipart messages -------------------------------------------------------------------

# Start of the feed, a multiple of the ten-minute window; and the time expiry looks from.
PARTS_START = 1_200_000_000_000
PARTS_NOW = PARTS_START + 3_000_000


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as multipart messages.

    The announced size is the number of turns. Every fifth conversation has lost its first
    turn, every seventh repeats a part, every eleventh has a second version of a part, every
    thirteenth is sent as single messages, and every tenth straddles a window bound.
    """
    rows = table(spark, sf_dir, "conversations")
    return shape_parts(rows, message_sizes(rows))


def message_sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))


def shape_parts(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    conv, turn = F.col("conv_id"), F.col("turn")
    single = conv % 13 == 0
    base = rows.join(sizes, "conv_id").where(~((turn == 0) & (conv % 5 == 0)))
    provider, ident = F.floor(conv / 10000), conv % 10000
    return base.select(
        F.concat_ws("_", provider, ident, F.when(single, turn)).alias("key"),
        ident.cast("smallint").alias("id"),
        F.when(single, F.lit(1)).otherwise(F.col("n")).cast("smallint").alias("size"),
        turn.cast("smallint").alias("ind"),
        provider.cast("int").alias("provider_id"),
        F.explode(
            F.filter(
                F.array(
                    F.col("text"),
                    F.when((turn == 1) & (conv % 7 == 0), F.col("text")),
                    F.when((turn == 1) & (conv % 11 == 0), F.concat("text", F.lit("!"))),
                ),
                lambda t: t.isNotNull(),
            )
        ).alias("text"),
        (F.lit(PARTS_START) + conv * 60_000 + turn * 1_000 - 3_000).alias("sent_time"),
    )


PARTS = f"""(WITH sized AS (
    SELECT conv_id, turn, text, COUNT(*) OVER (PARTITION BY conv_id) AS n FROM conversations),
  base AS (
    SELECT (conv_id//10000)::VARCHAR || '_' || (conv_id%10000)::VARCHAR
        || CASE WHEN conv_id%13=0 THEN '_' || turn::VARCHAR ELSE '' END AS key,
      conv_id%10000 AS id, CASE WHEN conv_id%13=0 THEN 1 ELSE n END AS size, turn AS ind,
      conv_id//10000 AS provider_id, text,
      {PARTS_START} + conv_id*60000 + turn*1000 - 3000 AS sent_time, conv_id
    FROM sized WHERE NOT (turn=0 AND conv_id%5=0))
  SELECT key, id, size, ind, provider_id, text, sent_time FROM base
  UNION ALL SELECT key, id, size, ind, provider_id, text, sent_time FROM base
    WHERE ind=1 AND conv_id%7=0
  UNION ALL SELECT key, id, size, ind, provider_id, text || '!', sent_time FROM base
    WHERE ind=1 AND conv_id%11=0)"""

# Parts of the slow feed are this far apart, so that several periods of a minute pass in a long message.
SLOW_MS = 23_000


def slow_parts(feed: DataFrame) -> DataFrame:
    """The same parts sent slowly: groups that expire and open again, complete late or after a pause."""
    pause = F.when(F.col("ind") % 3 == 2, 2 * SLOW_MS).otherwise(0)
    sent = F.lit(PARTS_START) + F.col("ind") * SLOW_MS + pause + F.col("id") % 7 * 1_000
    return feed.withColumn("sent_time", F.when(F.col("id") % 4 == 1, F.col("sent_time")).otherwise(sent))


SLOW_PARTS = f"""(SELECT key, id, size, ind, provider_id, text, CASE WHEN id%4=1 THEN sent_time
    ELSE {PARTS_START} + ind*{SLOW_MS} + CASE WHEN ind%3=2 THEN 2*{SLOW_MS} ELSE 0 END + id%7*1000 END AS sent_time FROM {PARTS})"""

# -- message delivery ---------------------------------------------------------------------

# Splits the orders into old and recent ones.
MONITOR_NOW = 900_000_000_000


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_messages(table(spark, sf_dir, "orders"))


def shape_messages(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("n"),
        F.col("o_orderkey").cast("string").alias("id"),
        wall_clock_millis(F.col("o_orderdate")).alias("t"),
        (F.col("o_custkey") % 97).cast("string").alias("provider_id"),
        F.concat(F.lit("x"), F.col("o_orderkey")).alias("ext_message_id"),
        F.when(F.col("o_orderkey") % 8 != 1, F.concat(F.lit("31"), F.col("o_custkey") % 10)).alias("from"),
        F.concat(F.lit("44"), F.col("o_custkey") % 10).alias("to"),
    )


_MESSAGES = """(SELECT o_orderkey AS n, o_orderkey::VARCHAR AS id, epoch_us(o_orderdate)//1000 AS t,
  (o_custkey%97)::VARCHAR AS provider_id, 'x' || o_orderkey::VARCHAR AS ext_message_id,
  CASE WHEN o_orderkey%8<>1 THEN '31' || (o_custkey%10)::VARCHAR END AS "from",
  '44' || (o_custkey%10)::VARCHAR AS "to" FROM orders)"""


def received(spark: SparkSession, sf_dir: str) -> DataFrame:
    return received_rows(_messages(spark, sf_dir))


def received_rows(messages: DataFrame) -> DataFrame:
    """Every message, every ninth received twice."""
    times = F.filter(
        F.array(F.col("t"), F.when(F.col("n") % 9 == 0, F.col("t") + 5)), lambda t: t.isNotNull()
    )
    rows = messages.select("id", F.explode(times).alias("received_time"))
    return rows.withColumn("arrival", F.col("received_time"))


RECEIVED = f"""(SELECT id, t AS received_time, t AS arrival FROM {_MESSAGES}
  UNION ALL SELECT id, t+5, t+5 FROM {_MESSAGES} WHERE n%9=0)"""


def sent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sent_rows(_messages(spark, sf_dir))


def sent_rows(messages: DataFrame) -> DataFrame:
    """Four of five messages 12 ms later; some are sent twice, with or without a status to come,
    some come before their message was received."""
    n, t = F.col("n"), F.col("t")
    times = F.filter(
        F.array(
            F.when(n % 25 == 1, t - 9).otherwise(t + 12),
            F.when(((n % 7 == 4) & (n % 10 == 6)) | (n % 10 == 4), t + 21),
        ),
        lambda x: x.isNotNull(),
    )
    rows = messages.where(n % 5 != 3).select(
        "id", "provider_id", "ext_message_id", "from", "to",
        F.lit("SENT").alias("status"), F.explode(times).alias("sent_time"),
    )
    return rows.withColumns(
        {"arrival": F.col("sent_time"), "ts": F.timestamp_millis(F.col("sent_time"))}
    )


SENT = f"""(SELECT id, provider_id, ext_message_id, "from", "to", 'SENT' AS status,
    CASE WHEN n%25=1 THEN t-9 ELSE t+12 END AS sent_time,
    CASE WHEN n%25=1 THEN t-9 ELSE t+12 END AS arrival FROM {_MESSAGES} WHERE n%5<>3
  UNION ALL SELECT id, provider_id, ext_message_id, "from", "to", 'SENT', t+21, t+21
    FROM {_MESSAGES} WHERE n%5<>3 AND (n%7=4 AND n%10=6 OR n%10=4))"""


def status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status_rows(_messages(spark, sf_dir))


def status_rows(messages: DataFrame) -> DataFrame:
    """Delivery status 40 ms after the message; every seventh before the sent record, every
    eleventh a minute too late for the match, some after the alert."""
    n, t = F.col("n"), F.col("t")
    delay = F.when(n % 7 == 0, 2).when(n % 11 == 0, 60_013).when(n % 11 == 1, 60_012)
    delay = delay.when(n % 11 == 2, 120_001).when(n % 11 == 3, 120_000).otherwise(40)
    rows = messages.where((n % 5 != 3) & (n % 7 != 4)).select(
        "id", "provider_id", "ext_message_id", "from", "to",
        F.lit("DELIVERED").alias("status"), (t + delay).alias("status_time"),
    )
    return rows.withColumns(
        {"arrival": F.col("status_time"), "ts": F.timestamp_millis(F.col("status_time"))}
    )


STATUS = f"""(SELECT id, provider_id, ext_message_id, "from", "to", 'DELIVERED' AS status,
    t + d AS status_time, t + d AS arrival
  FROM (SELECT *, CASE WHEN n%7=0 THEN 2 WHEN n%11=0 THEN 60013 WHEN n%11=1 THEN 60012
      WHEN n%11=2 THEN 120001 WHEN n%11=3 THEN 120000 ELSE 40 END AS d
    FROM {_MESSAGES} WHERE n%5<>3 AND n%7<>4))"""
