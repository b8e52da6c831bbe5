"""Event time from a value field, a record header or the record itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.codecs import decode_long


def wall_clock_millis(ts: Column) -> Column:
    """Epoch milliseconds (floored) of a zone-less UTC timestamp, in any session time zone."""
    instant = F.convert_timezone(F.lit("UTC"), F.current_timezone(), ts).cast("timestamp")
    return F.unix_millis(instant)


def bucket(col: Column, width: int) -> Column:
    """Number of the interval of ``width`` a whole number lies in, also below zero, in integers."""
    return F.call_function("div", col - F.pmod(col, F.lit(width)), F.lit(width))


def field_time(millis: Column, required: bool = True) -> Column:
    """Event time from an epoch-millisecond field. A missing time fails the job unless allowed."""
    if required:
        missing = F.raise_error(F.lit("record without event time")).cast("bigint")
        millis = F.when(millis.isNull(), missing).otherwise(millis)
    return F.timestamp_millis(millis)


def header_time(headers: Column, name: str) -> Column:
    """Event time from the last header called ``name``, 8 big-endian bytes; NULL without one."""
    named = F.filter(headers, lambda h: h["key"] == name)
    return F.timestamp_millis(decode_long(F.try_element_at(named, F.lit(-1))["value"]))


def with_event_time(df: DataFrame, ts: Column, lateness: str | None = None) -> DataFrame:
    """Add ``ts``; with ``lateness`` also the watermark that bounds state on a stream."""
    timed = df.withColumn("ts", ts)
    return timed.withWatermark("ts", lateness) if lateness else timed


def display_time(millis: Column, pattern: str = "yyyy-MM-dd HH:mm:ss.SSS") -> Column:
    """Epoch milliseconds as text in the session time zone."""
    return F.date_format(F.timestamp_millis(millis), pattern)
