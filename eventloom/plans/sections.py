"""Events of active sections: events against the time of their section's last page view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.operators.joins import asof_join

SETTLE_MS = 2_000


def active_events(events: DataFrame, views: DataFrame, **split) -> DataFrame:
    """Events later than the page view time their section has on arrival.

    ``events`` has key, ts_ms, arrival; ``views`` has key, view_ms, arrival.
    """
    met = asof_join(
        events, views, ["key"], "arrival", ["view_ms"], tombstone="view_ms", **split
    )
    return met.where(F.col("ts_ms") > F.col("view_ms"))


def settled_events(
    events: DataFrame, views: DataFrame, settle_ms: int = SETTLE_MS, **split
) -> DataFrame:
    """Events without a page view so far, or at least ``settle_ms`` after it."""
    met = asof_join(
        events, views, ["key"], "arrival", ["view_ms"], how="left", tombstone="view_ms", **split
    )
    return met.where(
        F.col("view_ms").isNull() | (F.col("ts_ms") >= F.col("view_ms") + settle_ms)
    )


def not_page_views(events: DataFrame, view_type: str = "pageView") -> DataFrame:
    """What is left when the page view table is fed by the same events just before the join:
    a page view meets its own time and goes, any other event has just deleted its section's
    row and stays."""
    return events.where(F.col("type") != view_type)
