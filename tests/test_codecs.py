"""Codecs, envelopes, keys and event time on literal records."""

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from eventloom.functions.cdc import unwrap_key, unwrap_value
from eventloom.functions.codecs import (
    decode_int,
    decode_json,
    decode_long,
    decode_or_flag,
    encode_int,
    encode_json,
    encode_long,
    split_bad_records,
)
from eventloom.functions.eventtime import field_time, header_time
from eventloom.functions.keys import joined_key, section_key, window_key
from eventloom.schemas import COUNTER_JSON, CUSTOMER, EVENT


def values(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, v STRING")


SCHEMA = '"schema":{"type":"struct","fields":[{"type":"int32","optional":false,"field":"id"}]}'
ROW = '{"id":1006,"first_name":"%s","last_name":"Jones","email":"a@example.com"}'


def test_cdc_key(spark):
    df = values(
        spark,
        '{%s,"payload":{"id":1002}}' % SCHEMA,
        '{%s,"payload":{"id":"abc"}}' % SCHEMA,
        None,
        "",
        '{"id":7}',
        "1002",
        '"abc"',
        '{"a":1,"b":"x"}',
        '{%s,"payload":{"a":1,"b":"x"}}' % SCHEMA,
    )
    got = [r.k for r in unwrap_key(df, "v", "k").orderBy("i").collect()]
    assert got == ["1002", "abc", None, None, "7", "1002", "abc", '{"a":1,"b":"x"}', '{"a":1,"b":"x"}']


def test_cdc_value(spark):
    ann, anne = ROW % "Ann", ROW % "Anne"
    df = values(
        spark,
        '{%s,"payload":{"before":%s,"after":null,"op":"d","ts_ms":1}}' % (SCHEMA, ann),
        '{%s,"payload":{"before":%s,"after":%s,"op":"u","ts_ms":1}}' % (SCHEMA, ann, anne),
        '{%s,"payload":{"before":null,"after":%s,"op":"c","ts_ms":1}}' % (SCHEMA, ann),
        None,
        "",
        '{"before":null,"after":%s,"op":"c"}' % ann,
        '{"after":%s}' % ann,
        '{"after":%s,"op":"d"}' % ann,
        '{"after":{"id":"12","email":5,"extra":true},"op":"x"}',
    )
    got = [r.row and tuple(r.row) for r in unwrap_value(df, "v", CUSTOMER, "row").orderBy("i").collect()]
    one, other = (1006, "Ann", "Jones", "a@example.com"), (1006, "Anne", "Jones", "a@example.com")
    assert got == [None, other, one, None, None, one, one, None, (12, None, None, "5")]


def test_cdc_malformed(spark):
    """Neither a delete nor a key: it fails. Ids go beyond an INT."""
    for bad in ("not json", '{"op":"u","after":{"id":1', '{"id":'):
        df = values(spark, bad)
        with pytest.raises((PySparkException, Py4JJavaError)):
            unwrap_value(df, "v", CUSTOMER, "row").collect()
        with pytest.raises((PySparkException, Py4JJavaError)):
            unwrap_key(df, "v", "k").collect()
    big = values(spark, '{"op":"c","after":{"id":2147483649}}')
    assert unwrap_value(big, "v", CUSTOMER, "row").select("row.id").first()[0] == 2147483649


def test_json(spark):
    good = values(spark, '{"id":"a","timestamp":5,"type":"t","data":null}', None)
    got = [r[0] for r in good.orderBy("i").select(decode_json(F.col("v"), EVENT)).collect()]
    assert tuple(got[0]) == ("a", 5, "t", None) and got[1] is None
    with pytest.raises((PySparkException, Py4JJavaError)):
        values(spark, '{"id":').select(decode_json(F.col("v"), EVENT)).collect()
    text = values(spark, None).select(encode_json("i", "v")).first()[0]
    assert text == '{"i":0,"v":null}'


def test_bad_records(spark, rows):
    df = values(spark, '{"counter":1}', "{", '{"counter":"x"}', None, '{"counter":2,"more":1}')
    good, bad = split_bad_records(df, "v", COUNTER_JSON)
    assert rows(good, "i", "counter") == [(0, 1), (3, None), (4, 2)]
    assert rows(bad, "i") == [(1,), (2,)]
    strict = decode_or_flag(df, "v", COUNTER_JSON, known_fields_only=True)
    assert rows(strict.where("_corrupt_record IS NOT NULL"), "i") == [(1,), (2,), (4,)]


def test_numbers(spark):
    longs = [0, 1, -1, 2**63 - 1, -(2**63), 1559893509888]
    df = spark.createDataFrame([(n,) for n in longs], "n BIGINT")
    assert [r[0] for r in df.select(decode_long(encode_long(F.col("n")))).collect()] == longs
    ints = [0, 1, -1, 2**31 - 1, -(2**31)]
    df = spark.createDataFrame([(n,) for n in ints], "n INT")
    assert [r[0] for r in df.select(decode_int(encode_int(F.col("n")))).collect()] == ints
    packed = df.select(encode_int(F.col("n")).alias("b")).collect()
    assert [bytes(r.b) for r in packed] == [n.to_bytes(4, "big", signed=True) for n in ints]


def test_keys(spark):
    df = spark.createDataFrame([(1, None, "x")], "a INT, b STRING, c STRING")
    got = df.select(joined_key("a", "b", "c"), section_key("a", "b", "c"), window_key("a", "a", "c")).first()
    assert tuple(got) == ("1nullx", "1|null|x", "1_1_x")


def test_event_time(spark):
    df = spark.createDataFrame([(1559893509888,), (None,)], "t BIGINT")
    kept = df.select(F.unix_millis(field_time(F.col("t"), required=False)).alias("t"))
    assert [r.t for r in kept.collect()] == [1559893509888, None]
    with pytest.raises((PySparkException, Py4JJavaError)):
        df.select(field_time(F.col("t"))).collect()
    records = spark.createDataFrame(
        [
            ([("t", (5).to_bytes(8, "big")), ("x", b""), ("t", (9).to_bytes(8, "big"))],),
            ([("x", b"")],),
            (None,),
        ],
        "headers ARRAY<STRUCT<key: STRING, value: BINARY>>",
    )
    got = records.select(F.unix_millis(header_time(F.col("headers"), "t")).alias("t")).collect()
    assert [r.t for r in got] == [9, None, None]
