"""Composite and window keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_or_null_word(col: Column | str) -> Column:
    """Text of ``col``, a NULL spelled ``null``."""
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(col.cast("string"), F.lit("null"))


def joined_key(*cols: Column | str, sep: str = "") -> Column:
    """Members joined into one text key; a NULL member is spelled ``null`` rather than skipped.

    Without a separator different members can give the same key (``ab|c``, ``a|bc``);
    pass ``sep`` where that matters.
    """
    return F.concat_ws(sep, *[text_or_null_word(c) for c in cols])


def section_key(section_id: Column | str, dyid: Column | str, rri: Column | str) -> Column:
    return joined_key(section_id, dyid, rri, sep="|")


def window_key(start_ms: Column | str, end_ms: Column | str, key: Column | str) -> Column:
    """``start_end_key`` with epoch-millisecond bounds."""
    return joined_key(start_ms, end_ms, key, sep="_")
