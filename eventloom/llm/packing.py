"""Documents as token sequences of bounded length, packed by swap-based local search.

Each document's ids are followed by an end mark. Only a longer document is cut, into pieces of exactly
``capacity`` tokens and a shorter first one. Full pieces are sequences of their own. The others
are dealt out evenly to tasks; a task starts from a best fit of its pieces in falling length and then
moves pieces, swaps one for one and two for one between underfull sequences. Every
step raises the sum of squared fills, so the fullest fill up and the emptiest are dissolved.

A null text is an empty one and gives a piece with the end mark alone. Repeated rows are packed as
often as they occur. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.tables import extended, written
from eventloom.llm.words import text_column

CAPACITY = 1024
END_ID = 2
# Pieces that one call of the packer works on.
TASK_PIECES = 50_000
# Texts with a longer run without white space go to the tokenizer that is linear in it.
LONG_RUN = 2_000


@cache
def _encoders(model: str, ranks: str | None):
    """The tokenizer of ``model``, and a faster one with the same vocabulary and splits if ``ranks`` are given."""
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(model)
    if ranks is None:
        return exact, None, ()
    import base64
    import json

    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    with open(model, encoding="utf-8") as file:
        special = [t["content"] for t in json.load(file).get("added_tokens", [])]
    # Byte-level pre-tokenization of the model file, as a pattern.
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    return exact, fast, tuple(special)


def encode(text: str, model: str, ranks: str | None) -> array:
    """Ids of a text as unsigned 32-bit numbers, without special tokens added."""
    exact, fast, special = _encoders(model, ranks)
    if fast is None or any(s in text for s in special) or _longest_run(text) > LONG_RUN:
        return array("I", exact.encode(text, add_special_tokens=False).ids)
    return array("I", fast.encode_ordinary(text))


def _longest_run(text: str) -> int:
    return len(text) if len(text) <= LONG_RUN else max(map(len, text.split()), default=0)


def token_pieces(
    docs: DataFrame, model: str, ranks: str | None = None, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """(key, piece, start, length, ids_crc32[, ids]) per piece of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, rows = [], []
            for i, body in enumerate(text_column(batch.column(1))):
                ids = encode(body.as_py(), model, ranks)
                ids.append(end_id)
                start, length = 0, len(ids) % capacity or min(len(ids), capacity)
                piece = 0
                while start < len(ids):
                    part = ids[start : start + length]
                    raw = np.array(part, "<u4").tobytes()
                    owner.append(i)
                    rows.append((piece, start, len(part), zlib.crc32(raw), part.tolist() if with_ids else None))
                    start, length, piece = start + length, capacity, piece + 1
            cols = list(zip(*rows)) or [[]] * 5
            out = [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(cols[0], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[1:4])]
            names = [key, "piece", "start", "length", "ids_crc32"]
            if with_ids:
                out.append(pa.array(cols[4], pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names=names)

    picked = docs.select(key, text)
    ids = {"ids": "array<bigint>"} if with_ids else {}
    schema = extended(picked.select(key).schema, piece="int", start="long", length="long", ids_crc32="long", **ids)
    return picked.mapInArrow(run, schema)


class _Bins:
    """Bins of one task, as lists of lengths, with an index of those that have room."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.items: list[list[int]] = []
        self.free: list[int] = []

    def best_fit(self, lengths: Sequence[int]) -> None:
        """Longest first, each into the fullest bin that has room."""
        by_room: dict[int, list[int]] = defaultdict(list)
        rooms = 0  # bit r is set if a bin has r free
        for length in sorted(lengths, reverse=True):
            fitting = rooms >> length
            if fitting:
                room = length + (fitting & -fitting).bit_length() - 1
                bin_ = by_room[room].pop()
                if not by_room[room]:
                    rooms &= ~(1 << room)
            else:
                bin_, room = len(self.items), self.capacity
                self.items.append([])
                self.free.append(0)
            self.items[bin_].append(length)
            room -= length
            self.free[bin_] = room
            by_room[room].append(bin_)
            rooms |= 1 << room

    def improve(self) -> None:
        """Steps from the emptiest bins into others, until none raises the squared fill or the number
        of bins has reached a bound from below."""
        large = sum(2 * length > self.capacity for items in self.items for length in items)
        least = max(large, -(-sum(self.capacity - f for f in self.free) // self.capacity))
        used = len(self.items)
        self.by_room: dict[int, set[int]] = defaultdict(set)
        self.holds: dict[int, dict[int, set[int]]] = defaultdict(lambda: defaultdict(set))
        for b, room in enumerate(self.free):
            self._index(b)
        changed = True
        while changed and used > least:
            changed = False
            for a in sorted((b for b, f in enumerate(self.free) if 0 < f < self.capacity), key=lambda b: -self.free[b]):
                while used > least and 0 < self.free[a] < self.capacity and self._step(a):
                    changed = True
                    used -= not self.items[a]

    def _index(self, b: int) -> None:
        if self.items[b] and self.free[b]:
            self.by_room[self.free[b]].add(b)
            for length in set(self.items[b]):
                self.holds[length][self.free[b]].add(b)

    def _drop(self, index: dict[int, set[int]], room: int, b: int) -> None:
        index[room].discard(b)
        if not index[room]:
            del index[room]

    def _exchange(self, a: int, given: Sequence[int], b: int, taken: Sequence[int]) -> None:
        for bin_, out, into in ((a, given, taken), (b, taken, given)):
            if self.free[bin_]:
                self._drop(self.by_room, self.free[bin_], bin_)
                for length in set(self.items[bin_]):
                    self._drop(self.holds[length], self.free[bin_], bin_)
            for length in out:
                self.items[bin_].remove(length)
            self.items[bin_].extend(into)
            self.free[bin_] += sum(out) - sum(into)
            self._index(bin_)

    def _step(self, a: int) -> bool:
        """One move or swap out of ``a`` that raises the squared fill; the largest gain of its kind first."""
        fill = self.capacity - self.free[a]
        own = sorted(set(self.items[a]), reverse=True)
        for x in own:
            for room in sorted(self.by_room):
                if room >= x and self.capacity - room + x > fill:
                    if (b := next((b for b in self.by_room[room] if b != a), None)) is not None:
                        self._exchange(a, [x], b, [])
                        return True
        twice = {x for x in own if self.items[a].count(x) > 1}
        pairs = [(x, y) for i, x in enumerate(own) for y in own[i:] if x != y or x in twice]
        most = max(self.by_room, default=0)
        for given in [(x,) for x in own] + pairs:
            size = sum(given)
            for taken in range(max(1, size - most), size):
                for room in sorted(self.holds.get(taken, ())):
                    if room >= size - taken and self.capacity - room + size - taken > fill:
                        if (b := next((b for b in self.holds[taken][room] if b != a), None)) is not None:
                            self._exchange(a, given, b, [taken])
                            return True
        return False


def pack_lengths(lengths: Sequence[int], capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every item, given the lengths, each from 1 to ``capacity``."""
    bins = _Bins(capacity)
    bins.best_fit(lengths)
    bins.improve()
    places: dict[int, list[tuple[int, int]]] = defaultdict(list)
    number = 0
    for items in bins.items:
        at = 0
        for length in items:
            places[length].append((number, at))
            at += length
        number += bool(items)
    spots = [places[int(length)].pop() for length in lengths]
    out = np.array(spots, np.int64).reshape(len(spots), 2)
    return out[:, 0], out[:, 1]


def pack(pieces: DataFrame, length: str = "length", capacity: int = CAPACITY, task_pieces: int = TASK_PIECES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``. ``pieces`` should be a written table, as it is read twice.

    Sequences never span tasks, which leaves at most one underfull sequence per ``task_pieces`` pieces
    beyond what the search itself leaves.
    """
    from pyspark import TaskContext

    full = pieces.where(F.col(length) >= capacity)
    short = pieces.where(F.col(length) < capacity)
    tasks = max(1, -(-short.count() // task_pieces))
    at = pieces.columns.index(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 40
        for batch in _regrouped(batches, task_pieces):
            number, offset = pack_lengths(batch.column(at).to_pylist(), capacity)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(number + sequence), pa.array(offset)], names=[*batch.schema.names, "sequence_id", "offset"]
            )
            sequence += int(number.max()) + 1

    schema = extended(pieces.schema, sequence_id="long", offset="long")
    packed = short.repartition(tasks).mapInArrow(run, schema)
    alone = full.withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    return packed.unionByName(alone)


def _regrouped(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches joined and cut to ``size`` rows, the last one shorter; a rest of up to a tenth joins the one before."""
    waiting: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if batch.num_rows:
            waiting.append(batch)
            rows += batch.num_rows
        while rows >= size + size // 10:
            table = pa.Table.from_batches(waiting)
            yield table.slice(0, size).combine_chunks().to_batches()[0]
            waiting, rows = table.slice(size).to_batches(), rows - size
    if rows:
        yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]


def pack_documents(
    docs: DataFrame, model: str, ranks: str | None = None, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """(key, piece, start, length, ids_crc32, sequence_id, offset) for all documents."""
    return pack(written(token_pieces(docs, model, ranks, key, text, capacity, end_id), "pieces"), capacity=capacity)
