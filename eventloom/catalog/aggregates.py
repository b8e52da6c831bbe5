"""Un-windowed aggregates, final and updates forms."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.catalog.bindings import EVENTS, PARTS, RECEIVED, SENT, events, parts, received, sent, table
from eventloom.catalog.registry import query
from eventloom.operators.changelog import (
    count_by_key,
    count_updates,
    first_by_key,
    latest_by_key,
    max_by_key,
    merge_fields,
    seen_once,
)
from eventloom.operators.udaf import fold_by_key
from eventloom.plans.reassembly import group_parts, grouped


@query("count_by_key", f"SELECT key, COUNT(*) AS n FROM {EVENTS} GROUP BY key HAVING COUNT(*) > 1")
def count_final(spark, sf_dir):
    return count_by_key(events(spark, sf_dir), ["key"], min_count=2)


COUNTS = f"""SELECT key, arrival, n FROM (SELECT key, arrival,
  ROW_NUMBER() OVER (PARTITION BY key ORDER BY arrival) AS n FROM {EVENTS}) WHERE n > 1"""


@query("count_by_key_updates", COUNTS)
def count_all(spark, sf_dir):
    e = events(spark, sf_dir).select("key", "arrival")
    return count_updates(e, ["key"], ["arrival"], min_count=2)


@query(
    "reduce_last",
    f"""SELECT key, arrival, type, value FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY key ORDER BY arrival DESC) AS rn
      FROM {EVENTS}) WHERE rn=1""",
)
def reduce_last(spark, sf_dir):
    return latest_by_key(events(spark, sf_dir).select("key", "arrival", "type", "value"), ["key"], ["arrival"])


@query(
    "reduce_first",
    f"""SELECT key, arrival, type, value FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY key ORDER BY arrival) AS rn
      FROM {EVENTS}) WHERE rn=1""",
)
def reduce_first(spark, sf_dir):
    return first_by_key(events(spark, sf_dir).select("key", "arrival", "type", "value"), ["key"], ["arrival"])


@query("agg_max", f"SELECT key, greatest(MAX(ts_ms), 0) AS ts_ms FROM {EVENTS} GROUP BY key")
def agg_max(spark, sf_dir):
    return max_by_key(events(spark, sf_dir), ["key"], "ts_ms")


@query(
    "agg_merge_fields",
    f"""SELECT id, arg_max(provider_id, arrival) FILTER (provider_id IS NOT NULL) AS provider_id,
      arg_max(sent_time, arrival) FILTER (sent_time > 0) AS sent_time, SUM(counter)::BIGINT AS counter,
      MIN(arrival) AS seen
    FROM (SELECT id, NULL AS provider_id, 0 AS sent_time, 0 AS counter, arrival FROM {RECEIVED}
      UNION ALL SELECT id, provider_id, sent_time, 1, arrival FROM {SENT}) GROUP BY id""",
)
def agg_merge_fields(spark, sf_dir):
    rows = received(spark, sf_dir).select(
        "id",
        F.lit(None).cast("string").alias("provider_id"),
        F.lit(0).cast("bigint").alias("sent_time"),
        F.lit(0).cast("bigint").alias("counter"),
        "arrival",
    )
    more = sent(spark, sf_dir).select(
        "id", "provider_id", "sent_time", F.lit(1).cast("bigint").alias("counter"), "arrival"
    )
    both = rows.unionByName(more).withColumn("seen", F.col("arrival"))
    return merge_fields(
        both, ["id"], ["arrival"], ["provider_id"], ["sent_time"], ["counter"], ["seen"]
    )


def _section_rows(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("section_id"),
        F.col("l_partkey").alias("dyid"),
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line"),
        F.col("l_extendedprice").alias("price"),
        "l_quantity",
    )


_SECTION_ROWS = """(SELECT l_suppkey AS section_id, l_partkey AS dyid, l_orderkey AS order_key,
  l_linenumber AS line, l_extendedprice AS price, l_quantity FROM lineitem)"""
_ORDER = ["order_key", "line", "price", "l_quantity"]


@query(
    "first_occurrence",
    f"""SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY section_id, dyid
      ORDER BY order_key, line, price, l_quantity) AS rn FROM {_SECTION_ROWS}) WHERE rn=1""",
)
def first_occurrence(spark, sf_dir):
    return first_by_key(_section_rows(spark, sf_dir), ["section_id", "dyid"], _ORDER)


@query(
    "first_occurrence_final",
    f"""SELECT * EXCLUDE (n) FROM (SELECT *, COUNT(*) OVER (PARTITION BY section_id, dyid) AS n
      FROM {_SECTION_ROWS}) WHERE n=1""",
)
def first_occurrence_final(spark, sf_dir):
    return seen_once(_section_rows(spark, sf_dir), ["section_id", "dyid"], _ORDER)


@query(
    "group_parts",
    f"""SELECT key, arg_min(size, sent_time)::SMALLINT AS group_size, COUNT(*) AS n_parts,
      MIN(sent_time) AS first_seen, COUNT(*) = arg_min(size, sent_time) AS complete
    FROM (SELECT DISTINCT * FROM {PARTS}) GROUP BY key""",
)
def grouped_parts(spark, sf_dir):
    return group_parts(grouped(parts(spark, sf_dir), ["key"]))


@query(
    "udaf",
    f"SELECT key, COUNT(*) FILTER (value > 10) AS counter, MAX(ts_ms) AS last FROM {EVENTS} GROUP BY key",
)
def udaf(spark, sf_dir):
    def add(rows):
        large = rows.assign(counter=(rows["value"] > 10).astype("int64"), last=rows["ts_ms"])
        return merge(large)

    def merge(states):
        return states.groupby("key", as_index=False).agg({"counter": "sum", "last": "max"})

    state = T.StructType([T.StructField("counter", T.LongType()), T.StructField("last", T.LongType())])
    return fold_by_key(
        events(spark, sf_dir).select("key", "ts_ms", "value"), "key", add, merge, state
    )
