"""Sources, codecs, change capture and event time."""

from pyspark.sql import functions as F

from eventloom.catalog.bindings import EVENTS, RECEIVED, SENT, STATUS, event_records, events
from eventloom.catalog.bindings import received, sent, status, table
from eventloom.catalog.registry import query
from eventloom.functions.cdc import unwrap_key, unwrap_value
from eventloom.functions.codecs import (
    CORRUPT,
    decode_int,
    decode_json,
    decode_long,
    encode_int,
    encode_json,
    encode_long,
    split_bad_records,
)
from eventloom.functions.eventtime import field_time, header_time
from eventloom.operators.changelog import keyed_table
from eventloom.operators.joins import lookup
from eventloom.schemas import CUSTOMER, EVENT
from eventloom.sources.feeds import feeds_by_pattern, json_feed
from eventloom.sources.sinks import topic_rows


@query(
    "src_json",
    """SELECT user_id::VARCHAR AS record_key, event_id::VARCHAR AS id,
      epoch_us(ts)//1000 AS "timestamp", event_type AS type, props AS data, event_id AS "offset"
    FROM events""",
)
def src_json(spark, sf_dir):
    return json_feed(event_records(spark, sf_dir), EVENT, "offset")


@query(
    "src_primitive",
    """SELECT user_id::VARCHAR AS key, event_id AS arrival, epoch_us(ts)//1000 - 1704200000000 AS long_value,
      (event_id % 1000000 - 500)::INTEGER AS int_value, event_type AS text_value FROM events""",
)
def src_primitive(spark, sf_dir):
    raw = events(spark, sf_dir).select(
        F.col("key").cast("string").cast("binary").alias("key"),
        "arrival",
        encode_long(F.col("ts_ms") - 1_704_200_000_000).alias("l"),
        encode_int(F.col("arrival") % 1_000_000 - 500).alias("i"),
        F.col("type").cast("binary").alias("t"),
    )
    return raw.select(
        F.col("key").cast("string").alias("key"),
        "arrival",
        decode_long(F.col("l")).alias("long_value"),
        decode_int(F.col("i")).alias("int_value"),
        F.col("t").cast("string").alias("text_value"),
    )


def _value_changes(spark, sf_dir):
    e = events(spark, sf_dir)
    return e.select("key", "arrival", F.when(F.col("type") != "error", F.col("value")).alias("value"))


@query(
    "src_table_latest",
    f"""SELECT key, arrival, value FROM (
      SELECT key, arrival, CASE WHEN type<>'error' THEN value END AS value,
        ROW_NUMBER() OVER (PARTITION BY key ORDER BY arrival DESC) AS rn FROM {EVENTS})
    WHERE rn=1 AND value IS NOT NULL""",
)
def src_table_latest(spark, sf_dir):
    return keyed_table(_value_changes(spark, sf_dir), ["key"], ["arrival"], "value")


@query(
    "src_global_table",
    """SELECT s_suppkey, s_name, n_name FROM supplier LEFT JOIN nation ON s_nationkey=n_nationkey""",
)
def src_global_table(spark, sf_dir):
    changes = table(spark, sf_dir, "nation").withColumn("s_nationkey", F.col("n_nationkey"))
    nations = keyed_table(changes, ["s_nationkey"], ["n_nationkey"], "n_name")
    return lookup(table(spark, sf_dir, "supplier"), nations, ["s_nationkey"]).select(
        "s_suppkey", "s_name", "n_name"
    )


@query(
    "src_pattern",
    f"""SELECT topic, COUNT(*) AS n, MIN("offset") AS first_offset, MAX("offset") AS last_offset FROM (
      SELECT 'received-messages' AS topic, arrival AS "offset" FROM {RECEIVED}
      UNION ALL SELECT 'sent-messages', arrival FROM {SENT}
      UNION ALL SELECT 'status-reports', arrival FROM {STATUS})
    WHERE regexp_matches(topic, '^.*-messages$') GROUP BY topic""",
)
def src_pattern(spark, sf_dir):
    feeds = {
        "received-messages": received(spark, sf_dir),
        "sent-messages": sent(spark, sf_dir),
        "status-reports": status(spark, sf_dir),
    }
    records = None
    for topic, feed in feeds.items():
        rows = feed.select(F.lit(topic).alias("topic"), F.col("arrival").alias("offset"))
        records = rows if records is None else records.unionByName(rows)
    return (
        feeds_by_pattern(records, ".*-messages")
        .groupBy("topic")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("offset").alias("first_offset"),
            F.max("offset").alias("last_offset"),
        )
    )


@query("json_decode", "SELECT event_id, json_extract(props, '$.k')::INTEGER AS k FROM events")
def json_decode(spark, sf_dir):
    decoded = decode_json(F.col("props"), "k INT")
    return table(spark, sf_dir, "events").select("event_id", decoded["k"].alias("k"))


ENCODED = """'{"event_id":' || event_id::VARCHAR || ',"user_id":' || user_id::VARCHAR
  || ',"event_type":"' || event_type || '","note":null}'"""


@query(
    "json_encode",
    f"SELECT user_id::VARCHAR AS key, {ENCODED} AS value FROM events",
)
def json_encode(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", F.lit(None).cast("string").alias("note")
    )
    return topic_rows(e, "user_id")


def _some_broken(spark, sf_dir):
    broken = F.when(F.col("event_id") % 10 == 0, F.substring("props", 1, 3))
    return table(spark, sf_dir, "events").select(
        "event_id", broken.otherwise(F.col("props")).alias("raw")
    )


@query(
    "bad_record_skip",
    "SELECT event_id, json_extract(props, '$.k')::INTEGER AS k FROM events WHERE event_id%10<>0",
)
def bad_record_skip(spark, sf_dir):
    good, _ = split_bad_records(_some_broken(spark, sf_dir), "raw", _k_schema())
    return good.select("event_id", "k")


@query(
    "bad_record_quarantine",
    "SELECT event_id, substr(props, 1, 3) AS raw FROM events WHERE event_id%10=0",
)
def bad_record_quarantine(spark, sf_dir):
    _, bad = split_bad_records(_some_broken(spark, sf_dir), "raw", _k_schema())
    return bad.select("event_id", F.col(CORRUPT).alias("raw"))


def _k_schema():
    from pyspark.sql import types as T

    return T.StructType([T.StructField("k", T.IntegerType())])


def _customer_changes(spark, sf_dir):
    """Change envelopes of customers: create, update, delete; wrapped or bare; id as number or text."""
    n = F.col("c_custkey")
    names = [
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.concat("c_name", F.lit("@example.com")).alias("email"),
    ]

    def envelope(ident):
        op = F.when(n % 3 == 0, "c").when(n % 3 == 1, "u").otherwise("d").alias("op")
        row = F.struct(ident.alias("id"), *names)
        before = F.when(n % 3 != 0, row).alias("before")
        after = F.when(n % 3 != 2, row).alias("after")
        bare = encode_json(before, after, op, F.lit(1).alias("ts_ms"))
        wrapped = encode_json(
            F.struct(F.lit("struct").alias("type")).alias("schema"),
            F.struct(before, after, op).alias("payload"),
        )
        return F.when(n % 2 == 0, wrapped).otherwise(bare)

    value = F.when(n % 5 == 0, envelope(n.cast("string"))).otherwise(envelope(n))
    return table(spark, sf_dir, "customer").select("c_custkey", value.alias("value"))


@query(
    "cdc_unwrap_value",
    """SELECT c_custkey, c_custkey%3=2 AS deleted,
      CASE WHEN c_custkey%3<>2 THEN c_custkey END AS id,
      CASE WHEN c_custkey%3<>2 THEN c_name END AS first_name,
      CASE WHEN c_custkey%3<>2 THEN c_mktsegment END AS last_name,
      CASE WHEN c_custkey%3<>2 THEN c_name || '@example.com' END AS email FROM customer""",
)
def cdc_unwrap_value(spark, sf_dir):
    rows = unwrap_value(_customer_changes(spark, sf_dir), "value", CUSTOMER, "row")
    return rows.select("c_custkey", F.col("row").isNull().alias("deleted"), "row.*")


@query(
    "cdc_unwrap_key",
    """SELECT c_custkey, CASE WHEN c_custkey%5=4 THEN '{"a":' || c_custkey::VARCHAR || ',"b":"' || c_mktsegment || '"}'
      WHEN c_custkey%5=3 THEN c_mktsegment ELSE c_custkey::VARCHAR END AS key FROM customer""",
)
def cdc_unwrap_key(spark, sf_dir):
    n = F.col("c_custkey")
    key = (
        F.when(n % 5 == 0, encode_json(F.lit(None).cast("int").alias("schema"), F.struct(n.alias("id")).alias("payload")))
        .when(n % 5 == 1, encode_json(n.alias("id")))
        .when(n % 5 == 2, n.cast("string"))
        .when(n % 5 == 3, F.concat(F.lit('"'), F.col("c_mktsegment"), F.lit('"')))
        .otherwise(encode_json(n.alias("a"), F.col("c_mktsegment").alias("b")))
    )
    rows = table(spark, sf_dir, "customer").select("c_custkey", key.alias("raw"))
    return unwrap_key(rows, "raw", "key").drop("raw")


@query(
    "cdc_materialize",
    """SELECT o_custkey AS key, o_orderkey AS arrival, o_custkey AS id,
      o_orderpriority AS first_name, o_orderstatus AS last_name, o_orderkey::VARCHAR AS email
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders)
    WHERE rn=1 AND o_orderstatus<>'P'""",
)
def cdc_materialize(spark, sf_dir):
    changes = order_changes(table(spark, sf_dir, "orders"))
    return keyed_table(changes, ["key"], ["arrival"], "row").select("key", "arrival", "row.*")


def order_changes(orders):
    """Orders as changes of their customer, through the JSON envelope and back."""
    deleted = F.col("o_orderstatus") == "P"
    row = F.struct(
        F.col("o_custkey").alias("id"),
        F.col("o_orderpriority").alias("first_name"),
        F.col("o_orderstatus").alias("last_name"),
        F.col("o_orderkey").cast("string").alias("email"),
    )
    raw = orders.select(
        F.col("o_orderkey").alias("arrival"),
        encode_json(F.col("o_custkey").alias("id")).alias("key"),
        encode_json(
            F.when(deleted, "d").otherwise("u").alias("op"), F.when(~deleted, row).alias("after")
        ).alias("value"),
    )
    return unwrap_value(unwrap_key(raw, "key", "id"), "value", CUSTOMER, "row").select(
        F.col("id").cast("bigint").alias("key"), "arrival", "row"
    )


@query("ts_from_field", "SELECT event_id AS arrival, epoch_us(ts)//1000 AS ts_ms FROM events")
def ts_from_field(spark, sf_dir):
    feed = json_feed(event_records(spark, sf_dir), EVENT, "offset")
    ts = field_time(F.col("timestamp"))
    return feed.select(F.col("offset").alias("arrival"), F.unix_millis(ts).alias("ts_ms"))


@query(
    "ts_from_header",
    """SELECT event_id AS arrival, CASE WHEN event_id%10<>0 THEN epoch_us(ts)//1000 END AS ts_ms
    FROM events""",
)
def ts_from_header(spark, sf_dir):
    ts = header_time(F.col("headers"), "event-time")
    return event_records(spark, sf_dir).select(
        F.col("offset").alias("arrival"), F.unix_millis(ts).alias("ts_ms")
    )


@query("ts_from_record", "SELECT event_id AS arrival, epoch_us(ts)//1000 + 250 AS ts_ms FROM events")
def ts_from_record(spark, sf_dir):
    return event_records(spark, sf_dir).select(
        F.col("offset").alias("arrival"), F.unix_millis("timestamp").alias("ts_ms")
    )
