"""State machines for ``transformWithState``: per-key state with event-time timers.

Rows of one key in one micro-batch come in no fixed order, so each machine folds them in a
way that does not depend on it, and most never hold more than one frame of them; ``DeliveryMonitor`` holds
those of a bucket of messages. The module is shipped to the executors by value and uses nothing of this package.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Row
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

MONITOR_STATE = (
    "received_time BIGINT, provider_id STRING, ext_message_id STRING, sent_status STRING, "
    "sent_status_time BIGINT, dr_status STRING, dr_status_time BIGINT, counter BIGINT, seen BIGINT"
)
MONITOR_OUTPUT = f"id STRING, outcome STRING, {MONITOR_STATE}"


# A timer fires when the watermark reaches it; what is due strictly after a time waits one more.
PAST = 1


RECORD_TEXTS = ["feed", "provider_id", "ext_message_id", "status"]
RECORD_FIELDS = ["id", "due", "at", "time", *RECORD_TEXTS]
RECORD_STATE = (
    "id ARRAY<STRING>, due ARRAY<BIGINT>, at ARRAY<BIGINT>, time ARRAY<BIGINT>, feed ARRAY<STRING>, "
    "provider_id ARRAY<STRING>, ext_message_id ARRAY<STRING>, status ARRAY<STRING>"
)
# Records in one entry of the state, and the time of one that has none; it is the first in order.
BLOCK = 10_000
NO_TIME = -(1 << 63)


def _in_order(who: np.ndarray, records: dict[str, np.ndarray]) -> np.ndarray:
    """Places by message, then arrival, then whole content, so that equal times have one order; nulls first."""
    order = np.lexsort((records["time"], records["at"], who))
    sorted_ = [v[order] for v in (who, records["at"], records["time"])]
    same = np.logical_and.reduce([v[1:] == v[:-1] for v in sorted_])
    bounds = np.flatnonzero(np.concatenate([[True], ~same, [True]]))
    for run in np.flatnonzero(np.diff(bounds) > 1):
        tied = slice(bounds[run], bounds[run + 1])
        order[tied] = sorted(order[tied], key=lambda i: [(records[f][i] is not None, records[f][i]) for f in RECORD_TEXTS])
    return order


def _last_known(values: np.ndarray, *picks: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of ``picks``, pairs of places and whether they count, the last value that is set; and which have none."""
    found, unset = values[picks[0][0]], np.ones(len(picks[0][0]), bool)
    for place, use in picks:
        taken = values[place]
        use = use & ~(pd.isna(taken) if taken.dtype == object else taken == NO_TIME)
        found[use] = taken[use]
        unset &= ~use
    return found, unset


def _text(values: np.ndarray, *picks: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    found, unset = _last_known(values, *picks)
    found[unset] = None
    return found


def _number(values: np.ndarray, *picks: tuple[np.ndarray, np.ndarray]) -> pd.api.extensions.ExtensionArray:
    return pd.arrays.IntegerArray(*_last_known(values, *picks))


class DeliveryMonitor(StatefulProcessor):
    """Follow messages from received to sent to status; ``complete`` on the second record after
    received, ``alert`` when that has not come ``alert_after_ms`` after the message was first seen.

    Input frames: id, feed (received | sent | status), provider_id, ext_message_id, status, time.
    Records that come before their message, after the second one, or after the deadline do not
    count. On event time the records of a message wait until the watermark has passed them and
    are taken in order of ``time``, so the outcome does not depend on how they fall into
    micro-batches. With ``wall_clock`` they are taken as they are processed, in order of ``time``
    within a micro-batch, and a message is first seen when it is processed.
    A message received again after its outcome starts anew.

    A key is a bucket of messages. They are settled together, so that the calls to the state do not grow with
    their number: the state is blocks of records, each with the time its message waits for (``due``), and one
    timer per bucket waits for the earliest. A micro-batch reads and writes the waiting messages of its buckets.
    """

    def __init__(self, alert_after_ms: int, wall_clock: bool) -> None:
        self.alert_after_ms = alert_after_ms
        self.wall_clock = wall_clock

    def init(self, handle) -> None:
        self.handle = handle
        self.records = handle.getListState("records", RECORD_STATE)

    def _load(self) -> dict[str, np.ndarray]:
        blocks = list(self.records.get()) if self.records.exists() else []
        kinds = {"due": np.int64, "at": np.int64, "time": np.int64}
        return {
            f: np.concatenate([np.empty(0, kinds.get(f, object)), *(np.array(block[i], kinds.get(f, object)) for block in blocks)])
            for i, f in enumerate(RECORD_FIELDS)
        }

    def _settle(self, held: dict, records: dict, reached: int, clock: int, timer: int | None) -> Iterator[pd.DataFrame]:
        """Send the outcomes that are settled: complete by records before ``reached``, before which
        none can still come, or past the time of an alert on ``clock``. Keep the records of the other
        messages and wait; ``held`` is what the state has, ``timer`` the one still open."""
        if not len(records["id"]):
            return
        who, ids = pd.factorize(records["id"])
        order = _in_order(who, records)
        who, records = who[order], {f: v[order] for f, v in records.items()}
        at, time, place = records["at"], records["time"], np.arange(len(who))
        start = np.flatnonzero(np.diff(who, prepend=-1))
        received = records["feed"] == "received"
        first = np.minimum.reduceat(np.where(received, place, len(who)), start)
        known = first < len(who)
        head = np.where(known, first, start)
        deadline = at[head] + self.alert_after_ms
        after = (at > at[head][who]) | ((at == at[head][who]) & (time > time[head][who]))
        others = known[who] & ~received
        later = others & after & (at <= deadline[who])
        nth = np.cumsum(later)
        nth -= (nth - later)[start][who]
        later &= nth <= 2
        one, two = np.full(len(ids), -1), np.full(len(ids), -1)
        for n, nth_place in ((1, one), (2, two)):
            found = np.flatnonzero(later & (nth == n))
            nth_place[who[found]] = found

        complete = (two >= 0) & (at[two] < reached)
        settled = complete | (known & (deadline < clock))
        due = np.where(two >= 0, at[two], deadline) + PAST
        waits = known & ~settled
        keep = later | (place == first[who])
        if not self.wall_clock:
            # An earlier received record may still make those before this one count.
            keep |= others & ~after
            last = at[np.append(start[1:], len(who)) - 1]
            due = np.where(known, due, last + PAST)
            keep |= ~known[who]
            waits |= ~known & (due > reached)
        keep &= waits[who]
        self._wait(held, {f: v[keep] for f, v in (records | {"due": due[who]}).items()}, timer)

        gone = np.flatnonzero(settled)
        if len(gone):
            yield self._outcomes(ids[gone], complete[gone], records, head[gone], one[gone], two[gone])

    def _wait(self, held: dict, kept: dict, timer: int | None) -> None:
        due = int(kept["due"].min()) if len(kept["due"]) else None
        if timer is not None and timer != due:
            self.handle.deleteTimer(timer)
        blocks = [
            tuple(kept[f][i : i + BLOCK].tolist() for f in RECORD_FIELDS) for i in range(0, len(kept["due"]), BLOCK)
        ]
        if blocks:
            self.records.put(blocks[:1])
            for block in blocks[1:]:
                self.records.appendValue(block)
            if due != timer:
                self.handle.registerTimer(due)
        elif len(held["due"]):
            self.records.clear()

    def _outcomes(
        self, ids: np.ndarray, complete: np.ndarray, records: dict, first: np.ndarray, one: np.ndarray, two: np.ndarray
    ) -> pd.DataFrame:
        both = [(one, one >= 0), (two, two >= 0)]
        sent = [(place, found & (records["feed"][place] == "sent")) for place, found in both]
        status = [(place, found & (records["feed"][place] != "sent")) for place, found in both]
        message = {
            "received_time": _number(records["time"], (first, np.ones(len(first), bool))),
            "provider_id": _text(records["provider_id"], *both),
            "ext_message_id": _text(records["ext_message_id"], *both),
            "sent_status": _text(records["status"], *sent),
            "sent_status_time": _number(records["time"], *sent),
            "dr_status": _text(records["status"], *status),
            "dr_status_time": _number(records["time"], *status),
            "counter": (one >= 0).astype(np.int64) + (two >= 0),
            "seen": records["at"][first],
        }
        return pd.DataFrame({"id": ids, "outcome": np.where(complete, "complete", "alert").astype(object), **message})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs() if self.wall_clock else None
        held, come = self._load(), pd.concat(list(rows), ignore_index=True)
        time = come["time"].to_numpy(np.int64)
        new = {f: come[f].to_numpy(object) for f in ("id", *RECORD_TEXTS)}
        new = {f: np.where(pd.isna(v), None, v) for f, v in new.items()}
        new |= {"time": time, "due": time, "at": time if now is None else np.full(len(time), now)}
        records = {f: np.concatenate([held[f], new[f]]) for f in RECORD_FIELDS}
        timer = int(held["due"].min()) if len(held["due"]) else None
        # On the wall clock all that has come is in order; alerts are left to the timer.
        reached = timerValues.getCurrentWatermarkInMs() if now is None else now + PAST
        yield from self._settle(held, records, reached, reached if now is None else 0, timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.wall_clock:
            now = timerValues.getCurrentProcessingTimeInMs()
        else:
            now = timerValues.getCurrentWatermarkInMs()
        held = self._load()
        yield from self._settle(held, held, now, now, None)

    def close(self) -> None:
        pass


PART_FIELDS = ["ind", "id", "size", "provider_id", "text", "sent_time"]
PART_STATE = (
    "ind SMALLINT, id SMALLINT, size SMALLINT, provider_id INT, text STRING, sent_time BIGINT"
)
REASSEMBLY_OUTPUT = (
    "key STRING, ind SMALLINT, id SMALLINT, provider_id INT, text STRING, full_message BOOLEAN, "
    "sent_time BIGINT"
)


def _by_arrival(part: dict) -> tuple:
    order = ("sent_time", "ind", "text", "size", "id", "provider_id")
    return tuple((part[f] is not None, part[f]) for f in order)


# Parts of a micro-batch that are looked up together.
READ_PARTS = 10_000


class Reassembly(StatefulProcessor):
    """Collect the distinct parts of a message; send it as it was when it first became complete,
    send its parts one by one when that has not been ``expire_after_ms`` after its first part.

    On event time parts are taken in order of ``sent_time`` once the watermark has passed them, so
    the result does not depend on how they fall into micro-batches; parts after the deadline
    start a new group. With ``wall_clock`` they are taken as they are processed, in order of
    ``sent_time`` within a micro-batch, and the age counts from when the first one was.

    Parts lie in a map state, keyed by the whole part, and are read together only when there are
    as many as the announced size, a SMALLINT, or the group expires, or when a micro-batch brings as many as
    are held: one read then tells which are new, instead of a call for each.
    """

    def __init__(self, expire_after_ms: int, wall_clock: bool) -> None:
        self.expire_after_ms = expire_after_ms
        self.wall_clock = wall_clock

    def init(self, handle) -> None:
        self.handle = handle
        self.parts = handle.getMapState("parts", PART_STATE, "held BOOLEAN")
        self.group = handle.getValueState(
            "group",
            "size SMALLINT, size_time BIGINT, size_ind SMALLINT, n BIGINT, first_seen BIGINT, sent BOOLEAN",
        )

    def _held(self) -> list[dict]:
        return sorted((dict(zip(PART_FIELDS, p)) for p in self.parts.keys()), key=_by_arrival)

    def _told_apart(self, rows, n: int) -> Iterator[tuple]:
        """Each part, its values, and the set of the parts held: of all of them, or of those that come."""
        rows = iter(rows)
        while chunk := [(part, tuple(part[f] for f in PART_FIELDS)) for part in islice(rows, READ_PARTS)]:
            coming = {values for _, values in chunk}
            if n <= len(coming):
                known = {tuple(p) for p in self.parts.keys()} if self.parts.exists() else set()
            else:
                known = {values for values in coming if self.parts.containsKey(values)}
            before = len(known)
            for part, values in chunk:
                yield part, values, known
            n += len(known) - before

    def _add(self, key, rows, now: int | None, reached: int) -> Iterator[Row]:
        size, size_time, size_ind, n, first_seen, sent = (
            self.group.get() if self.group.exists() else (0, None, None, 0, now, False)
        )
        for part, values, known in self._told_apart(rows, n):
            if values not in known:
                self.parts.updateValue(values, (True,))
                known.add(values)
                n += 1
            position = (part["sent_time"], part["ind"])
            if part["size"] and (not size or (now is None and position < (size_time, size_ind))):
                size, size_time, size_ind = part["size"], *position
            if now is None:
                first_seen = min(first_seen, part["sent_time"]) if first_seen is not None else part["sent_time"]
            elif not sent and n == size:
                sent = True
                yield self._ready(key, self._held())
        self.group.update((size, size_time, size_ind, n, first_seen, sent))
        yield from self._settle(key, reached)

    def _settle(self, key, reached: int) -> Iterator[Row]:
        size, size_time, size_ind, n, first_seen, sent = self.group.get()
        deadline = first_seen + self.expire_after_ms
        due = deadline + PAST
        if not self.wall_clock and not sent and 0 < size <= n:
            complete = self._held()[:size]
            completed_at = complete[-1]["sent_time"]
            if size_time <= completed_at <= deadline:
                if completed_at < reached:
                    self.group.update((size, size_time, size_ind, n, first_seen, True))
                    yield self._ready(key, complete)
                else:
                    due = completed_at + PAST
        timers = list(self.handle.listTimers())
        for timer in timers:
            if timer != due:
                self.handle.deleteTimer(timer)
        if due not in timers:
            self.handle.registerTimer(due)

    def _ready(self, key, parts: list[dict]) -> Row:
        by_index = sorted(parts, key=lambda p: (p["ind"], p["text"] or ""))
        first = min(parts, key=lambda p: (p["sent_time"], p["ind"], p["id"]))
        return Row(
            key=key[0],
            ind=None,
            id=first["id"],
            provider_id=first["provider_id"],
            text="".join(p["text"] for p in by_index if p["text"] is not None),
            full_message=True,
            sent_time=first["sent_time"],
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if self.wall_clock:
            now = timerValues.getCurrentProcessingTimeInMs()
            parts = sorted((r.asDict() for r in rows), key=_by_arrival)
            yield from self._add(key, parts, now, now)
        else:
            yield from self._add(key, rows, None, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.wall_clock:
            now = timerValues.getCurrentProcessingTimeInMs()
        else:
            now = timerValues.getCurrentWatermarkInMs()
        yield from self._expire(key, now)

    def _expire(self, key, now: int) -> Iterator[Row]:
        *_, first_seen, sent = self.group.get()
        deadline = first_seen + self.expire_after_ms
        if now <= deadline:
            yield from self._settle(key, now)
            return
        if not sent and not self.wall_clock:
            for row in self._settle(key, now):
                sent = True
                yield row
        held = self._held()
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.parts.clear()
        self.group.clear()
        in_time = [p for p in held if self.wall_clock or p["sent_time"] <= deadline]
        if not sent:
            for p in in_time:
                yield Row(
                    key=key[0],
                    ind=p["ind"],
                    id=p["id"],
                    provider_id=p["provider_id"],
                    text=p["text"],
                    full_message=False,
                    sent_time=p["sent_time"],
                )
        if len(in_time) < len(held):
            yield from self._add(key, held[len(in_time):], None, now)
            yield from self._expire(key, now)

    def close(self) -> None:
        pass


SLIDING_STATE = "times ARRAY<BIGINT>, counts ARRAY<BIGINT>, closed BIGINT"
SLIDING_OUTPUT = "key BIGINT, window_start BIGINT, window_end BIGINT, counter BIGINT"


class SlidingCounts(StatefulProcessor):
    """Record-aligned sliding windows, each sent once when the watermark has passed its end.

    Input frames need ``ts_ms``. The state is the distinct event times of the last span with
    their counts, so it is bounded by the span, not by the number of events; one timer per key
    waits for the next window end.
    """

    def __init__(self, span_ms: int) -> None:
        self.span_ms = span_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("events", SLIDING_STATE)

    def _load(self) -> tuple[np.ndarray, np.ndarray, int]:
        if not self.state.exists():
            return np.empty(0, np.int64), np.empty(0, np.int64), -(1 << 62)
        times, counts, closed = self.state.get()
        return np.array(times, np.int64), np.array(counts, np.int64), closed

    def _close(self, key, times, counts, closed, watermark) -> Iterator[pd.DataFrame]:
        """Send the windows with ``closed`` <= end < ``watermark``, keep what later ones need."""
        d = self.span_ms
        ends = np.unique(np.concatenate([times, times + d + 1]))
        due = ends[(ends >= closed) & (ends < watermark)]
        total = np.concatenate([[0], np.cumsum(counts)])
        n = total[np.searchsorted(times, due, "right")] - total[np.searchsorted(times, due - d, "left")]
        due, n = due[n > 0], n[n > 0]
        closed = max(closed, watermark)
        keep = times >= closed - d - 1
        waiting = ends[ends >= closed]
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if len(waiting):
            self.state.update((times[keep].tolist(), counts[keep].tolist(), int(closed)))
            self.handle.registerTimer(int(waiting[0]) + PAST)
        else:
            self.state.clear()
        yield pd.DataFrame(
            {"key": [key[0]] * len(due), "window_start": due - d, "window_end": due, "counter": n}
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        times, counts, closed = self._load()
        seen = pd.Series(counts, index=times)
        for frame in rows:
            seen = seen.add(frame["ts_ms"].value_counts(), fill_value=0)
        seen = seen.sort_index()
        yield from self._close(
            key,
            seen.index.to_numpy(np.int64),
            seen.to_numpy().astype(np.int64),
            closed,
            timerValues.getCurrentWatermarkInMs(),
        )

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        times, counts, closed = self._load()
        yield from self._close(key, times, counts, closed, timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


class AsOf(StatefulProcessor):
    """Events of a key with the values of its latest update before them, in order of a position.

    Input rows: the key, ``order``, ``is_update``, the event columns and the ``values``. All rows of a
    key wait until the watermark has passed them. An update whose ``tombstone`` value is NULL
    deletes the key; ``inner`` leaves out events without a live update.
    """

    def __init__(
        self, columns: list[str], layout: str, values: list[str], value_layout: str, order: str,
        events: list[str], key: str, how: str, tombstone: str | None,
    ) -> None:
        self.columns, self.layout = columns, layout
        self.values, self.value_layout = values, value_layout
        self.order, self.events, self.key = order, events, key
        self.how, self.tombstone = how, tombstone

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.layout)
        self.known = handle.getValueState("known", self.value_layout)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        added = [tuple(row[c] for c in self.columns) for row in rows]
        self.waiting.appendList(added)
        place = self.columns.index(self.order)
        due = min(row[place] for row in added) + PAST
        timers = list(self.handle.listTimers())
        if not timers or due < min(timers):
            for timer in timers:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(due)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.waiting.exists():
            return
        reached = timerValues.getCurrentWatermarkInMs()
        rows = [dict(zip(self.columns, row)) for row in self.waiting.get()]
        later = [row for row in rows if row[self.order] >= reached]
        settled = [row for row in rows if row[self.order] < reached]
        settled.sort(key=lambda row: (row[self.order], row["is_update"]))
        known = dict(zip(self.values, self.known.get())) if self.known.exists() else None
        for row in settled:
            if row["is_update"]:
                gone = self.tombstone is not None and row[self.tombstone] is None
                known = None if gone else {v: row[v] for v in self.values}
            elif known is not None or self.how == "left":
                held = known or dict.fromkeys(self.values)
                yield Row(**{self.key: key[0]}, **{c: row[c] for c in self.events}, **held)
        if known is None:
            self.known.clear()
        else:
            self.known.update(tuple(known[v] for v in self.values))
        if later:
            self.waiting.put([tuple(row[c] for c in self.columns) for row in later])
            self.handle.registerTimer(min(row[self.order] for row in later) + PAST)
        else:
            self.waiting.clear()

    def close(self) -> None:
        pass


class StoreFold(StatefulProcessor):
    """A user function with a keyed store that it reads and writes.

    ``fold(key, frames, store)`` gets the rows of a key in a micro-batch as frames and gives frames;
    ``store`` is the value, list or map state of ``kind``. ``ttl_ms`` forgets what was not written for so long.
    """

    def __init__(self, fold, kind: str, layout: str, map_layout: str | None, ttl_ms: int | None) -> None:
        self.fold, self.kind = fold, kind
        self.layout, self.map_layout, self.ttl_ms = layout, map_layout, ttl_ms

    def init(self, handle) -> None:
        if self.kind == "value":
            self.store = handle.getValueState("store", self.layout, self.ttl_ms)
        elif self.kind == "list":
            self.store = handle.getListState("store", self.layout, self.ttl_ms)
        else:
            self.store = handle.getMapState("store", self.layout, self.map_layout, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield from self.fold(key, rows, self.store)

    def close(self) -> None:
        pass


class StreamTime(StatefulProcessor):
    """Rows of a source partition with the largest ``ts`` that it had seen when each came, in ``order``.

    The state is one number. The rows that a source partition has in a micro-batch are put in order together.
    """

    def __init__(self, order: list[str], ts: str, name: str, columns: list[str]) -> None:
        self.order, self.ts, self.name, self.columns = order, ts, name, columns

    def init(self, handle) -> None:
        self.state = handle.getValueState("top", "top BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows)).sort_values(self.order, ignore_index=True)
        top = self.state.get()[0] if self.state.exists() else None
        times = frame[self.ts].astype("Int64").cummax().ffill()
        if top is not None:
            times = times.fillna(top).clip(lower=top)
        if len(times) and not pd.isna(times.iloc[-1]):
            self.state.update((int(times.iloc[-1]),))
        frame[self.name] = times
        yield frame[self.columns]

    def close(self) -> None:
        pass


STORE_OUTPUT = "key BIGINT, n BIGINT, last_arrival BIGINT, last_type STRING"
STORE_STATE = "n BIGINT, last_arrival BIGINT, last_type STRING"


def last_seen(key, frames, store) -> Iterator[pd.DataFrame]:
    """How many records of a key there were, and the latest one."""
    n, arrival, kind = store.get() if store.exists() else (0, -1, None)
    for frame in frames:
        n += len(frame)
        top = frame.loc[frame["arrival"].idxmax()]
        if top["arrival"] > arrival:
            arrival, kind = int(top["arrival"]), top["type"]
    store.update((n, arrival, kind))
    yield pd.DataFrame({"key": [key[0]], "n": [n], "last_arrival": [arrival], "last_type": [kind]})


TYPES_OUTPUT = "key BIGINT, type STRING, n BIGINT, first_arrival BIGINT"


def seen_types(key, frames, store) -> Iterator[pd.DataFrame]:
    """How often each type of record came for a key, and when first; only the types of these rows are read and written."""
    counts: dict[str, int] = {}
    first: dict[str, int] = {}
    for frame in frames:
        for kind, group in frame.groupby("type")["arrival"]:
            counts[kind] = counts.get(kind, 0) + len(group)
            first[kind] = min(first.get(kind, group.min()), group.min())
    rows = []
    for kind, n in counts.items():
        held, since = store.getValue((kind,)) if store.containsKey((kind,)) else (0, first[kind])
        row = held + n, int(min(since, first[kind]))
        store.updateValue((kind,), row)
        rows.append((key[0], kind, *row))
    yield pd.DataFrame(rows, columns=["key", "type", "n", "first_arrival"])
