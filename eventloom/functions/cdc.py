"""Change-data-capture envelopes: value and key unwrapping.

Both work in steps over columns of their own, so that each record is parsed once. The result
comes out of a generator: a filter on it cannot be moved below, where it would parse again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the envelope format.
PAYLOAD = "payload"
AFTER = "after"
OP = "op"
DELETE = "d"


FAILFAST = {"mode": "FAILFAST"}


def _filled(col: Column) -> Column:
    """The text, NULL if it is blank."""
    text = col.cast("string")
    return F.when(F.trim(text) != "", text)


def _once(col: Column, out: str) -> Column:
    return F.inline(F.array(F.struct(col.alias(out))))


def unwrap_value(df: DataFrame, value: str, row: T.StructType, out: str) -> DataFrame:
    """Add ``out``, the row after the change; NULL for a delete, a NULL and an empty record.

    Malformed JSON fails the job: taken for a NULL it would delete the row. Use
    ``codecs.split_bad_records`` beforehand to split it off.

    Both layouts are read: ``{schema, payload: {...}}`` and the bare envelope. Row fields
    are read as text and cast, so a number arriving as text (or the other way round) is
    taken over whatever the embedded schema says; what cannot be cast becomes NULL. A
    record without ``op`` gives its row.
    """
    text_row = T.StructType([T.StructField(f.name, T.StringType()) for f in row.fields])
    envelope = T.StructType([T.StructField(OP, T.StringType()), T.StructField(AFTER, text_row)])
    either = T.StructType(envelope.fields + [T.StructField(PAYLOAD, envelope)])
    parsed = df.withColumn("_cdc", F.from_json(_filled(F.col(value)), either, FAILFAST))
    wrapped = F.col(f"_cdc.{PAYLOAD}").isNotNull()
    bare = F.struct(F.col(f"_cdc.{OP}").alias(OP), F.col(f"_cdc.{AFTER}").alias(AFTER))
    change = F.when(wrapped, F.col(f"_cdc.{PAYLOAD}")).otherwise(bare)
    picked = parsed.withColumn("_change", change)
    after = F.col(f"_change.{AFTER}")
    typed = F.struct(*[after[f.name].try_cast(f.dataType).alias(f.name) for f in row.fields])
    gone = after.isNull() | (F.coalesce(F.col(f"_change.{OP}"), F.lit("")) == DELETE)
    return picked.select(*df.columns, _once(F.when(~gone, typed), out))


def unwrap_key(df: DataFrame, key: str, out: str) -> DataFrame:
    """Add ``out``, the key as text: a bare scalar or the value of a one-field object, also
    below ``payload``; larger objects stay JSON. Malformed JSON fails the job."""
    text = _filled(F.col(key))
    members = "map<string,string>"
    is_object = F.ltrim(text).startswith("{")
    outer = df.withColumn("_outer", F.from_json(F.when(is_object, text), members, FAILFAST))
    has_payload = F.map_contains_key("_outer", F.lit(PAYLOAD))
    body = outer.withColumn(
        "_body", F.when(has_payload, F.try_element_at("_outer", F.lit(PAYLOAD))).otherwise(text)
    )
    inner = body.withColumn(
        "_inner", F.when(has_payload & F.ltrim("_body").startswith("{"), F.from_json("_body", members, FAILFAST)).otherwise(F.col("_outer"))
    )
    single = F.when(F.size("_inner") == 1, F.element_at(F.map_values("_inner"), 1))
    scalar = F.get_json_object(text, "$")
    bad = F.raise_error(F.concat(F.lit("malformed key: "), text))
    unwrapped = (
        F.when(text.isNull() | (F.trim(text) == "null"), None)
        .when(~is_object, F.coalesce(scalar, bad))
        .when(F.size("_inner") == 1, single)
        .otherwise(F.col("_body"))
    )
    return inner.select(*df.columns, _once(unwrapped, out))
