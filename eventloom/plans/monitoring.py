"""Message delivery: received, sent and status feeds matched, monitored and alerted on.

Feeds are keyed by message ``id`` and share one arrival order. A record counts if it comes after its
message was received and within the time of an alert, which ends the state of a message. So does
its second record: a third one changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from eventloom.functions.keys import joined_key
from eventloom.operators.changelog import first_by_key, merge_fields, merge_updates
from eventloom.operators.joins import interval_join, join_keyed_table

JOIN_WITHIN_MS = 60_000
ALERT_AFTER_MS = 120_000

TEXTS = ["provider_id", "ext_message_id", "sent_status", "dr_status"]
TIMES = ["received_time", "sent_status_time", "dr_status_time"]
# Arrival, then content, so that records with equal arrival have one order.
ORDER = ["arrival", "tie"]


def _monitor_row(df: DataFrame, feed: str, **fields: Column) -> DataFrame:
    """The common layout, unset fields NULL."""
    empty = {
        **{c: F.lit(None).cast("string") for c in TEXTS},
        **{c: F.lit(None).cast("bigint") for c in TIMES},
    }
    columns = {**empty, **fields}
    return df.select(
        "id",
        *[columns[c].alias(c) for c in (*TEXTS, *TIMES)],
        columns["seen"].alias("seen"),
        columns["counter"].cast("bigint").alias("counter"),
        "arrival",
        F.to_json(F.struct(F.lit(feed).alias("feed"), *[columns[c].alias(c) for c in TEXTS])).alias("tie"),
    )


def received_rows(received: DataFrame) -> DataFrame:
    """First received record per id as a monitor row with counter 0."""
    return _monitor_row(
        first_by_key(received, ["id"], ["arrival"]),
        "received",
        received_time=F.col("received_time"),
        seen=F.col("arrival"),
        counter=F.lit(0),
    )


def _after_received(
    rows: DataFrame, received: DataFrame, after_ms: int | None = None
) -> DataFrame:
    """Monitor rows that come after their message was received, with ``after_ms`` at most so
    much later, with its received time.

    The received table never changes its first row, so meeting it as of arrival is a join on
    the key and ``arrival``.
    """
    first = first_by_key(received.select("id", "received_time", "arrival"), ["id"], ["arrival"])
    table = first.select("id", F.struct("received_time", "arrival").alias("_first"))
    since = F.col("arrival") - F.col("_first.arrival")
    counts = since > 0 if after_ms is None else (since > 0) & (since <= after_ms)
    met = join_keyed_table(rows, table, ["id"]).where(counts)
    return met.withColumn("received_time", F.col("_first.received_time")).select(*rows.columns)


def _until_complete(rows: DataFrame, mode: str) -> DataFrame:
    """The rows of each message up to the one that completes it."""
    if mode == "count":
        # Spark cuts to two rows per message before the exchange.
        nth = F.row_number().over(W.partitionBy("id").orderBy(*ORDER))
        return rows.withColumn("_nth", nth).where("_nth <= 2").drop("_nth")
    both = F.struct(
        F.min(F.when(F.col("sent_status_time").isNotNull(), F.struct(*ORDER))).alias("sent"),
        F.min(F.when(F.col("dr_status_time").isNotNull(), F.struct(*ORDER))).alias("status"),
    )
    ends = rows.groupBy("id").agg(both.alias("_end"))
    open_ = F.col("_end.sent").isNull() | F.col("_end.status").isNull()
    until = F.struct(*ORDER) <= F.greatest("_end.sent", "_end.status")
    return join_keyed_table(rows, ends, ["id"]).where(open_ | until).drop("_end")


def _sent_layout(sent: DataFrame) -> DataFrame:
    return _monitor_row(
        sent,
        "sent",
        provider_id=F.col("provider_id"),
        ext_message_id=F.col("ext_message_id"),
        sent_status=F.col("status"),
        sent_status_time=F.col("sent_time"),
        seen=F.col("arrival"),
        counter=F.lit(1),
    )


def _status_layout(status: DataFrame) -> DataFrame:
    return _monitor_row(
        status,
        "status",
        provider_id=F.col("provider_id"),
        ext_message_id=F.col("ext_message_id"),
        dr_status=F.col("status"),
        dr_status_time=F.col("status_time"),
        seen=F.col("arrival"),
        counter=F.lit(1),
    )


def sent_rows(sent: DataFrame, received: DataFrame) -> DataFrame:
    return _after_received(_sent_layout(sent), received).drop("tie")


def status_rows(status: DataFrame, received: DataFrame) -> DataFrame:
    return _after_received(_status_layout(status), received).drop("tie")


def monitor_rows(
    received: DataFrame,
    sent: DataFrame,
    status: DataFrame,
    mode: str = "count",
    after_ms: int = ALERT_AFTER_MS,
) -> DataFrame:
    """The monitoring feed: all three sources in one layout, those rows that count for ``mode``
    (see ``is_complete``). The later two are joined at once."""
    is_complete(mode)
    later = _after_received(_sent_layout(sent).unionByName(_status_layout(status)), received, after_ms)
    return received_rows(received).unionByName(_until_complete(later, mode))


_MERGE = {"texts": TEXTS, "times": TIMES, "counters": ["counter"], "oldest": ["seen"]}


def monitor_state(
    received: DataFrame, sent: DataFrame, status: DataFrame, mode: str = "count", **rule
) -> DataFrame:
    """One row per message: all known fields, the number of sent and status records, first seen,
    as its completion or the time of an alert left it."""
    return merge_fields(monitor_rows(received, sent, status, mode, **rule), ["id"], ORDER, **_MERGE)


def monitor_updates(
    received: DataFrame, sent: DataFrame, status: DataFrame, mode: str = "count", **split
) -> DataFrame:
    """The state of a message after each of its records, as the monitoring feed sends it on."""
    rows = monitor_rows(received, sent, status, mode)
    return merge_updates(rows, ["id"], ORDER, **_MERGE, **split).drop("tie")


def is_complete(mode: str = "count") -> Column:
    """``count``: two records of whatever kind; ``flags``: at least one sent and one status."""
    if mode == "count":
        return F.col("counter") >= 2
    if mode == "flags":
        return F.col("sent_status_time").isNotNull() & F.col("dr_status_time").isNotNull()
    raise ValueError(f"mode is count or flags, not {mode!r}")


def completed(state: DataFrame, mode: str = "count") -> DataFrame:
    return state.where(is_complete(mode))


def alerts(
    state: DataFrame, now_ms: int, after_ms: int = ALERT_AFTER_MS, mode: str = "count"
) -> DataFrame:
    """Messages that were not complete ``after_ms`` after they were first seen, if that is before
    ``now_ms``; ``state`` takes no record that came later, so nothing after ``now_ms`` counts."""
    return state.where(~is_complete(mode) & (F.col("seen") + after_ms < now_ms))


def delivery_key() -> Column:
    """Key that matches a sent record with its delivery status."""
    return joined_key("provider_id", "ext_message_id", "from", "to")


def final_status(
    sent: DataFrame, status: DataFrame, within_ms: int = JOIN_WITHIN_MS
) -> DataFrame:
    """Status rows matched to a sent record near in time, with the id of the sent record.

    Both feeds have a TIMESTAMP ``ts``. ``out_of_order`` marks a status older than its sent
    record.
    """
    s = sent.select(
        delivery_key().alias("delivery_key"),
        F.col("id").alias("sent_id"),
        F.col("sent_time"),
        F.col("ts").alias("sent_ts"),
    )
    d = status.select(
        delivery_key().alias("delivery_key"),
        "provider_id",
        "from",
        "to",
        "ext_message_id",
        "status",
        "status_time",
        F.col("ts").alias("status_ts"),
    )
    joined = interval_join(s, d, ["delivery_key"], within_ms, "sent_ts", "status_ts")
    return joined.select(
        F.col("sent_id").alias("id"),
        "provider_id",
        "from",
        "to",
        "ext_message_id",
        "status",
        "status_time",
        (F.col("sent_time") > F.col("status_time")).alias("out_of_order"),
    )
