"""Record layouts of the feeds. Times are epoch milliseconds."""

from pyspark.sql import types as T


_TYPES = {
    "BINARY": T.BinaryType(),
    "BIGINT": T.LongType(),
    "BOOLEAN": T.BooleanType(),
    "DOUBLE": T.DoubleType(),
    "INT": T.IntegerType(),
    "SMALLINT": T.ShortType(),
    "STRING": T.StringType(),
    "TIMESTAMP": T.TimestampType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
}


def _struct(fields: str) -> T.StructType:
    """A struct from "name TYPE, ..."; unlike the DDL parser this needs no session."""
    pairs = [field.split() for field in fields.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


_HEADERS = T.ArrayType(_struct("key STRING, value BINARY"))

# Layout of a record as the Kafka source delivers it.
TOPIC_RECORD = T.StructType(
    [
        *_struct(
            "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, "
            "timestamp TIMESTAMP"
        ),
        T.StructField("headers", _HEADERS),
    ]
)

EVENT = _struct("id STRING, timestamp BIGINT, type STRING, data STRING")
COUNTER_JSON = _struct("counter INT")
CUSTOMER = _struct("id BIGINT, first_name STRING, last_name STRING, email STRING")

# Tables the queries run on; with a fixed layout no file is opened to find it.
TABLES = {
    "customer": _struct(
        "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    ),
    "conversations": _struct("conv_id BIGINT, turn BIGINT, role STRING, text STRING"),
    "documents": _struct(
        "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
    ),
    "events": _struct(
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
        "props STRING"
    ),
    "lineitem": _struct(
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
        "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
        "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"
    ),
    "nation": _struct("n_nationkey INT, n_name STRING, n_regionkey INT"),
    "orders": _struct(
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "supplier": _struct("s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE"),
}
