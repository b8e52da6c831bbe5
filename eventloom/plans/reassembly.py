"""Multipart messages: grouping, completion, windows and expiry.

A message is complete when the number of distinct parts equals its announced size, a
SMALLINT. Copies are collapsed where they lie and the parts counted; only complete groups are
brought together, so at most 32,767 parts each, whatever the size of the others.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.operators.joins import asof_join, join_keyed_table
from eventloom.operators.kv import branch
from eventloom.operators.running import HOT_KEYS, not_null, running
from eventloom.operators.windows import session
from eventloom.session import written

# An incomplete group with more parts is kept out of the exchange that brings groups together.
LARGE_PARTS = 32_767
WINDOW_MS = 600_000
EXPIRY_MS = 60_000

PART = ["id", "size", "ind", "provider_id", "text", "sent_time"]
READY = ["id", "provider_id", "text", "full_message", "sent_time"]


def is_multipart() -> Column:
    return F.col("size") > 1


@dataclass(frozen=True)
class Groups:
    """``parts``: the distinct parts with their first ``_arrival``. ``summary``: a row per group with
    group_size, n_parts, first_seen, complete."""

    keys: list[str]
    parts: DataFrame
    summary: DataFrame


def _first_size(arrival: str) -> Column:
    """Size announced by the first part; zero is "not set yet"."""
    first = F.min_by("size", F.when(F.col("size") != 0, F.struct(arrival, "ind", "size")))
    return F.coalesce(first, F.lit(0).cast("smallint")).alias("group_size")


def grouped(parts: DataFrame, keys: Sequence[str], arrival: str = "sent_time") -> Groups:
    """Group parts by key. Whole records are compared: the same index with another text is
    another part. Both frames of the result read the same exchange."""
    keys = list(keys)
    rows = parts.where(not_null(keys)).select(*keys, *PART, F.col(arrival).alias("_arrival"))
    distinct = rows.groupBy(*keys, *PART).agg(F.min("_arrival").alias("_arrival"))
    summary = distinct.groupBy(*keys).agg(
        _first_size("_arrival"),
        F.count(F.lit(1)).alias("n_parts"),
        F.min("_arrival").alias("first_seen"),
    )
    complete = F.col("n_parts") == F.col("group_size")
    return Groups(keys, distinct, summary.withColumn("complete", complete))


def group_parts(groups: Groups) -> DataFrame:
    """Per group: announced size, number of parts, first arrival, completeness."""
    return groups.summary.select(*groups.keys, "group_size", "n_parts", "first_seen", "complete")


def assemble(groups: Groups) -> DataFrame:
    """Ready messages of the complete groups: texts in index order; id, provider and time of
    the earliest part.

    Large incomplete groups leave before the exchange by key. Their list is bounded; one that is
    not listed holds under 1/``HOT_KEYS`` of all parts, and is dropped after the exchange.
    """
    keys = groups.keys
    large = groups.summary.where(~F.col("complete") & (F.col("n_parts") > LARGE_PARTS))
    listed = large.orderBy(F.desc("n_parts"), *keys).limit(HOT_KEYS).select(*keys)
    complete = (
        groups.parts.join(F.broadcast(listed), keys, "left_anti")
        .join(groups.summary.where("complete").select(*keys), keys)
        .groupBy(*keys)
        .agg(F.collect_list(F.struct(*PART)).alias("parts"))
    )
    return _ready(complete, keys)


def _ready(complete: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Messages from arrays of their ``parts``."""
    by_index = F.array_sort(
        F.transform("parts", lambda p: F.struct(p["ind"].alias("ind"), p["text"].alias("text")))
    )
    earliest = F.array_min(
        F.transform(
            "parts",
            lambda p: F.struct(
                p["sent_time"].alias("sent_time"),
                p["ind"].alias("ind"),
                p["id"].alias("id"),
                p["provider_id"].alias("provider_id"),
            ),
        )
    )
    ready = complete.select(*keys, by_index.alias("_by_index"), earliest.alias("_first"))
    return ready.select(
        *keys,
        F.col("_first.id").alias("id"),
        F.col("_first.provider_id").alias("provider_id"),
        F.array_join("_by_index.text", "").alias("text"),
        F.lit(True).alias("full_message"),
        F.col("_first.sent_time").alias("sent_time"),
    )


def reassemble(parts: DataFrame, keys: Sequence[str], arrival: str = "sent_time") -> DataFrame:
    """Ready messages, no window: whatever the time between the parts."""
    return assemble(grouped(parts, keys, arrival))


def reassemble_when_complete(
    parts: DataFrame, keys: Sequence[str], arrival: str = "sent_time", **split
) -> DataFrame:
    """Ready messages as they were when they first became complete, also of groups that got
    more parts afterwards; ``completed_at`` is the arrival of the part that completed them.

    Distinct parts are numbered by arrival and those up to the announced size kept, so no more
    than that is brought together, whatever the size of the group.
    """
    complete = _early_parts(parts, keys, arrival, **split).groupBy(*keys, "group_size", "_sized_at").agg(
        F.collect_list(F.struct(*PART)).alias("parts"), F.max("_arrival").alias("completed_at")
    )
    done = complete.where((F.size("parts") == F.col("group_size")) & _size_was_known())
    return _ready(done, [*keys, "completed_at"])


def _size_was_known() -> Column:
    """A group is not complete by a part that came before its size was announced."""
    return F.col("completed_at") >= F.col("_sized_at")


def _early_parts(parts: DataFrame, keys: Sequence[str], arrival: str, **split) -> DataFrame:
    """The first distinct parts of each group by arrival, as many as the announced ``group_size``."""
    keys = list(keys)
    rows = parts.where(not_null(keys)).select(*keys, *PART, F.col(arrival).alias("_arrival"))
    distinct = rows.groupBy(*keys, *PART).agg(F.min("_arrival").alias("_arrival"))
    sized_at = F.min(F.when(F.col("size") != 0, F.col("_arrival"))).alias("_sized_at")
    sizes = rows.groupBy(*keys).agg(_first_size("_arrival"), sized_at)
    numbered = running(
        distinct, keys, ["_arrival", "ind", "text", "size", "sent_time", "id", "provider_id"],
        {"_n": ("sum", F.lit(1))}, **split,
    )
    return join_keyed_table(numbered, sizes, keys).where(F.col("_n") <= F.col("group_size"))


def reassemble_windowed(
    parts: DataFrame,
    keys: Sequence[str],
    arrival: str = "sent_time",
    size_ms: int = WINDOW_MS,
) -> DataFrame:
    """Ready messages of tumbling windows: parts in different windows never meet."""
    start = F.col("sent_time") - F.pmod("sent_time", F.lit(size_ms))
    windowed = parts.withColumn("window_start", start)
    return reassemble(windowed, [*keys, "window_start"], arrival)


def pass_through(parts: DataFrame) -> DataFrame:
    """Single-part messages as ready messages, without a sent time."""
    return parts.select(
        *[c for c in parts.columns if c not in PART],
        "id",
        "provider_id",
        "text",
        F.lit(True).alias("full_message"),
        F.lit(None).cast("bigint").alias("sent_time"),
    )


def full_flow(parts: DataFrame, keys: Sequence[str], arrival: str = "sent_time") -> DataFrame:
    """Single parts passed through, multipart messages assembled per window."""
    single, multi = branch(parts, [~is_multipart(), is_multipart()])
    columns = [*keys, *READY]
    assembled = reassemble_windowed(multi, keys, arrival)
    return pass_through(single).select(*columns).unionByName(assembled.select(*columns))


def waiting_periods(
    parts: DataFrame, keys: Sequence[str], arrival: str = "sent_time", after_ms: int = EXPIRY_MS
) -> DataFrame:
    """(keys, opened_at): when each group was opened, and opened again by its first part after a deadline.

    A part more than ``after_ms`` behind the one before it opens a group whatever came earlier, so
    groups fall into runs without such a pause. A run no longer than the deadline is one period. In a
    longer one each time points to the first one past its deadline, and the periods are the chain
    of pointers from its start, found by doubling: joins by key and time, so that no group
    is brought together, in as many rounds as the binary logarithm of the periods of a run.
    """
    keys = list(keys)
    times = parts.where(not_null([*keys, arrival])).select(*keys, F.col(arrival).alias("_at"))
    runs = session(times, keys, "_at", after_ms).select(*keys, F.col("window_start").alias("_run"), "window_end")
    runs = written(runs, "runs")
    long = runs.where(F.col("window_end") - F.col("_run") > after_ms)
    opened = runs.select(*keys, F.col("_run").alias("opened_at"))
    if long.isEmpty():
        return opened
    run = [*keys, "_run"]
    spans = runs.select(*keys, F.col("_run").alias("_at"), "_run", "window_end")
    points = written(times.join(long.select(*keys).distinct(), keys, "left_semi").distinct(), "points")
    met = asof_join(points, spans, keys, "_at", ["_run", "window_end"], see_equal=True)
    in_long = (F.col("_at") <= F.col("window_end")) & (F.col("window_end") - F.col("_run") > after_ms)
    inside = written(met.where(in_long).select(*run, "_at"), "inside")
    # Backwards in time; a deadline comes before the times equal to it, which are not past it.
    looks = inside.select(
        *run,
        "_at",
        F.inline(
            F.array(
                F.struct((-F.col("_at")).alias("_back"), F.lit(1).alias("_side"), F.col("_at").alias("_time")),
                F.struct(
                    (-F.col("_at") - after_ms).alias("_back"), F.lit(0).alias("_side"), F.lit(None).cast("bigint").alias("_time")
                ),
            )
        ),
    )
    past = running(looks, run, ["_back", "_side"], {"_next": ("last", F.col("_time"))})
    jumps = written(past.where("_side = 0 AND _next IS NOT NULL").select(*run, "_at", "_next"), "jumps")
    found = written(long.select(*run, F.col("_run").alias("_at")), "periods")
    while True:
        further = found.join(jumps, [*run, "_at"]).select(*run, F.col("_next").alias("_at"))
        further = written(further, "periods")
        if further.isEmpty():
            break
        found = found.unionByName(further)
        onward = jumps.select(*run, F.col("_at").alias("_next"), F.col("_next").alias("_end"))
        doubled = jumps.join(onward, [*run, "_next"]).select(*run, "_at", F.col("_end").alias("_next"))
        jumps = written(doubled, "jumps")
    later = found.where(F.col("_at") > F.col("_run"))
    return opened.unionByName(later.select(*keys, F.col("_at").alias("opened_at")))


def in_periods(
    parts: DataFrame, keys: Sequence[str], arrival: str = "sent_time", after_ms: int = EXPIRY_MS
) -> DataFrame:
    """``parts`` with the ``opened_at`` of the group they fall into, as a table in the work folder: what follows
    reads it several times."""
    periods = waiting_periods(parts, keys, arrival, after_ms).withColumn(arrival, F.col("opened_at"))
    return written(asof_join(parts, periods, keys, arrival, ["opened_at"], see_equal=True), "in-periods")


def reassemble_in_time(
    parts: DataFrame, keys: Sequence[str], arrival: str = "sent_time", after_ms: int = EXPIRY_MS
) -> DataFrame:
    """Ready messages completed before their deadline, ``after_ms`` after their first part; parts past it open
    a new group. A group completed is only cleared at its deadline: what it gets until then is dropped."""
    return reassemble_when_complete(in_periods(parts, keys, arrival, after_ms), [*keys, "opened_at"], arrival)


def expire(
    parts: DataFrame,
    keys: Sequence[str],
    now_ms: int,
    arrival: str = "sent_time",
    after_ms: int = EXPIRY_MS,
) -> DataFrame:
    """Parts of the groups that were not complete ``after_ms`` after their first part, each as a message of its own.

    A part past the deadline opens a new group, as on a stream; ``opened_at`` tells the groups of a key apart.
    ``ind`` is kept: it is the order in which the parts of a group are sent on. A large group is
    never brought together: the join is the last step, so Spark may split its partition.
    """
    group = [*keys, "opened_at"]
    placed = in_periods(parts, keys, arrival, after_ms).where(F.lit(now_ms) - F.col("opened_at") > after_ms)
    distinct = placed.groupBy(*group, *PART).agg(F.min(arrival).alias("_arrival"))
    sized_at = F.min(F.when(F.col("size") != 0, F.col("_arrival")))
    summary = distinct.groupBy(*group).agg(_first_size("_arrival"), F.count(F.lit(1)).alias("n"), sized_at.alias("_sized_at"))
    # A group whose first part told its size was complete as soon as it had as many parts.
    large = summary.where((F.col("group_size") > 0) & (F.col("n") >= F.col("group_size")))
    large = written(large.select(*group, (F.col("_sized_at") == F.col("opened_at")).alias("sure")), "large")
    complete, unclear = large.where("sure").select(*group), large.where("NOT sure").select(*group)
    if not unclear.isEmpty():
        early = _early_parts(placed.join(unclear, group, "left_semi"), group, arrival)
        counted = early.groupBy(*group, "group_size", "_sized_at").agg(
            F.count(F.lit(1)).alias("n"), F.max("_arrival").alias("completed_at")
        )
        done = counted.where((F.col("n") == F.col("group_size")) & _size_was_known())
        complete = complete.unionByName(done.select(*group))
    return distinct.join(complete, group, "left_anti").select(
        *group, "ind", "id", "provider_id", "text", F.lit(False).alias("full_message"), "sent_time"
    )


def index_list(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, ind, n): the distinct parts of each group by index, a row for each index."""
    distinct = parts.where(not_null(keys)).select(*keys, *PART).distinct()
    return distinct.groupBy(*keys, "ind").agg(F.count(F.lit(1)).alias("n"))


# Indexes in one text of ``index_text``.
SHARD_PARTS = 10_000


def index_text(parts: DataFrame, keys: Sequence[str], per_shard: int = SHARD_PARTS, **split) -> DataFrame:
    """(keys, shard, indexes): the indexes of the distinct parts of each group in order, joined by commas; an index that
    has several parts comes as often.

    A group has a text for each ``per_shard`` parts, so none grows with its group. Parts are counted by index
    before anything is brought together.
    """
    counts = index_list(parts, keys).withColumn("_at", F.col("ind").cast("bigint"))
    placed = running(counts, keys, ["_at"], {"_end": ("sum", F.col("n"))}, **split)
    first = F.col("_end") - F.col("n")
    shards = F.sequence(F.expr(f"(_end - n) div {per_shard}"), F.expr(f"(_end - 1) div {per_shard}"))
    each = placed.withColumn("shard", F.explode(shards))
    end, start = (F.col("shard") + 1) * per_shard, F.col("shard") * per_shard
    own = (F.least(F.col("_end"), end) - F.greatest(first, start)).cast("int")
    listed = each.groupBy(*keys, "shard").agg(F.array_sort(F.collect_list(F.struct("ind", own.alias("times")))).alias("_parts"))
    repeated = F.flatten(F.transform("_parts", lambda p: F.array_repeat(p["ind"].cast("string"), p["times"])))
    return listed.select(*keys, "shard", F.array_join(repeated, ",").alias("indexes"))
