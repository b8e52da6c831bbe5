"""JSON and big-endian number codecs as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def decode_json(value: Column, schema: T.StructType) -> Column:
    """JSON text to a struct. NULL stays NULL, undecodable text fails the job."""
    return F.from_json(value, schema, {"mode": "FAILFAST"})


def encode_json(*cols: Column | str) -> Column:
    """A struct of ``cols`` as JSON text, null fields written out."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def decode_or_flag(
    df: DataFrame, value: str, schema: T.StructType, known_fields_only: bool = False
) -> DataFrame:
    """Add the decoded ``value`` fields plus the raw text of undecodable records in ``_corrupt_record``.

    Spark gives a struct of NULLs for bad JSON, so the corrupt column is what tells a bad
    record from an empty one. With ``known_fields_only`` a record with a field outside the
    schema counts as bad as well.
    """
    wide = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(
        F.col(value), wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    corrupt = F.col(f"_parsed.{CORRUPT}")
    if known_fields_only:
        fields = F.array(*[F.lit(f.name) for f in schema.fields])
        extra = F.size(F.array_except(F.json_object_keys(F.col(value)), fields)) > 0
        corrupt = F.when(extra, F.col(value)).otherwise(corrupt)
    return df.withColumn("_parsed", parsed).select(
        *[F.col(c) for c in df.columns],
        *[F.col(f"_parsed.{f.name}").alias(f.name) for f in schema.fields],
        corrupt.alias(CORRUPT),
    )


def split_bad_records(
    df: DataFrame, value: str, schema: T.StructType, known_fields_only: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(decoded records, undecodable records with their raw text): skip and go on."""
    flagged = decode_or_flag(df, value, schema, known_fields_only)
    good = flagged.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = flagged.where(F.col(CORRUPT).isNotNull()).drop(*[f.name for f in schema.fields])
    return good, bad


def decode_long(value: Column) -> Column:
    """8 big-endian bytes to BIGINT."""
    return F.conv(F.hex(value), 16, -10).cast("bigint")


def encode_long(value: Column) -> Column:
    """BIGINT to 8 big-endian bytes."""
    return F.unhex(F.lpad(F.hex(value.cast("bigint")), 16, "0"))


def decode_int(value: Column) -> Column:
    """4 big-endian bytes to INT."""
    unsigned = F.conv(F.hex(value), 16, 10).cast("bigint")
    return F.when(unsigned >= 1 << 31, unsigned - (1 << 32)).otherwise(unsigned).cast("int")


def encode_int(value: Column) -> Column:
    """INT to 4 big-endian bytes. A number beyond an INT fails the job."""
    whole = value.cast("bigint")
    fits = whole.between(-(1 << 31), (1 << 31) - 1)
    checked = F.when(fits | whole.isNull(), whole).otherwise(F.raise_error(F.lit("not an INT")))
    return F.unhex(F.right(F.lpad(F.hex(checked.cast("bigint")), 16, "0"), F.lit(8)))
