"""Passages of a benchmark in documents, found by SimHash over item-sized windows.

A window's 64-bit fingerprint has a bit set where most of its lower-cased words' hashes have it. Window
sizes form a ladder. Each item is fingerprinted at all its places with the largest size
that fits well inside it and the next smaller one; documents every ``STRIDE`` words with all sizes in use, so
some window of a whole copy of an item always equals one of the item's. Fingerprints are
cut into four blocks of 16 bits. Two that differ in at most ``RADIUS`` = 7 bits differ in at most
one bit in some block, so a table of each block's values and their one-bit neighbours finds
them all. A candidate puts the item's whole length over the document, and the pair counts
if the weighted similarity of the five-word shingles (sum of the smaller counts over the sum of the greater) is
at least ``MIN_PERCENT``.

Items come to the tasks in blocks of at most ``ITEM_BLOCK`` items and ``BLOCK_WORDS`` words, with one pass over the
documents for each; a longer item is a block of its own. The driver holds one block at a time, and so does a task: with
several, each pass writes its hits, which are joined to the documents at the end. Items and documents that are null or have no words match nothing. Items of fewer than five words are one shingle.
Repeated documents are each reported, repeated items by each of their ids. Empty tables give an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm import words as W
from eventloom.llm.tables import extended, written

MIN_PERCENT = 75
RADIUS = 7
STRIDE = 4
ITEM_BLOCK = 5_000
# An index takes about 600 bytes for each word, so a block about 60 MB.
BLOCK_WORDS = 100_000
# Words by which a candidate may be moved to fit best.
SHIFT = 2

_BLOCK_BITS = 16
# Up to this size windows start at every word, from the next one on at every fourth.
_DENSE = 7
# Counts are kept in bytes, so a window has at most 255 words.
LADDER = [*range(1, _DENSE + 1), 8, 11, 15, 20, 27, 36, 48, 64, 85, 113, 150, 200]

_SPREAD = np.zeros(256, np.uint64)
for _bit in range(8):
    _SPREAD |= ((np.arange(256, dtype=np.uint64) >> np.uint64(_bit)) & np.uint64(1)) << np.uint64(8 * _bit)


def stride(size: int) -> int:
    return 1 if size <= _DENSE else STRIDE


def sizes_of(n_words: int) -> list[int]:
    """The window sizes of an item."""
    return [s for s in LADDER if s + stride(s) - 1 <= n_words][-2:]


def _running_counts(words: np.ndarray) -> np.ndarray:
    """(words + 1, 8): bit counts before each word, eight to a number of 64 bits."""
    out = np.zeros((len(words) + 1, 8), np.uint64)
    np.cumsum(_SPREAD[words.view(np.uint8).reshape(-1, 8)], axis=0, out=out[1:])
    return out


def _fingerprints(running: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    counts = (running[starts + size] - running[starts]).view(np.uint8).reshape(-1, 64)
    return np.packbits(counts > size // 2, axis=1).view(np.uint64).ravel()


def _window_starts(bounds: np.ndarray, size: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the windows within each text, and the number of the text."""
    room = np.diff(bounds) - size
    counts = np.where(room >= 0, room // step + 1, 0)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    text = np.repeat(np.arange(len(counts)), counts)
    return bounds[text] + (np.arange(len(text)) - first[text]) * step, text


class Index:
    """The items of one block: words, shingle counts, and per size the fingerprints by block value."""

    def __init__(self, ids: list, texts: list):
        self.ids = ids
        self.words: list[np.ndarray] = []
        for _, _, data, offsets in W.chunks(pa.array(texts, pa.string())):
            start, end, bounds = W.find_words(data, offsets)
            hashes = W.word_hashes(data, start, end, lower=True)
            self.words += [hashes[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        self.shingles = [_shingle_counts(w) for w in self.words]
        self.known = [np.array(sorted(c), np.uint64) for c in self.shingles]
        found: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        for i, words in enumerate(self.words):
            running = _running_counts(words)
            for size in sizes_of(len(words)):
                at = np.arange(len(words) - size + 1)
                found.setdefault(size, []).append((_fingerprints(running, at, size), np.full(len(at), i), at))
        self.tables = {size: _Table(*map(np.concatenate, zip(*parts))) for size, parts in found.items()}


    def common(self, item: int, shingles: np.ndarray) -> int:
        """How many of these shingles the item has: no place among them has more in common with it."""
        known = self.known[item]
        at = np.minimum(np.searchsorted(known, shingles), len(known) - 1)
        return int(np.count_nonzero(known[at] == shingles))


class _Table:
    """Fingerprints of one size, by the values and one-bit neighbours of their blocks."""

    def __init__(self, prints: np.ndarray, item: np.ndarray, at: np.ndarray):
        self.prints, self.item, self.at = prints, item, at
        flips = np.concatenate([[0], 1 << np.arange(_BLOCK_BITS)]).astype(np.uint16)
        self.lists = []
        for block in prints.view(np.uint16).reshape(-1, 64 // _BLOCK_BITS).T:
            values = (block[:, None] ^ flips[None, :]).ravel()
            order = np.argsort(values, kind="stable")
            ends = np.concatenate([[0], np.cumsum(np.bincount(values, minlength=1 << _BLOCK_BITS))])
            self.lists.append((ends, (order // len(flips)).astype(np.int32)))

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, fingerprint) of all pairs within the radius; a pair may come more than once."""
        found = []
        for block, (ends, rows) in zip(prints.view(np.uint16).reshape(-1, 64 // _BLOCK_BITS).T, self.lists):
            counts = (ends[1:] - ends[:-1])[block]
            hit = np.flatnonzero(counts)
            for part in np.array_split(hit, max(1, int(counts[hit].sum()) >> 20)):
                n = counts[part]
                window = np.repeat(part, n)
                index = np.repeat(ends[block[part]] - np.cumsum(n) + n, n) + np.arange(len(window))
                row = rows[index]
                close = np.bitwise_count(prints[window] ^ self.prints[row]) <= RADIUS
                found.append((window[close], row[close]))
        return tuple(map(np.concatenate, zip(*found)))


def _shingle_counts(words: np.ndarray) -> Counter:
    return Counter(W.shingle_hashes(words, np.array([0, len(words)]))[0].tolist())


def similarity(a: Counter, b: Counter) -> tuple[int, int]:
    """Sum of the smaller and of the greater counts."""
    common = sum((a & b).values())
    return common, sum(a.values()) + sum(b.values()) - common


def matches(column, index: Index, percent: int) -> Iterator[tuple[int, int, int, float]]:
    """(row, item, first word, similarity) of the best window of each matching pair of an Arrow column of texts."""
    for first, _, data, offsets in W.chunks(column):
        start, end, bounds = W.find_words(data, offsets)
        if not len(start):
            continue
        words = W.word_hashes(data, start, end, lower=True)
        running = _running_counts(words)
        candidates = set()
        for size, table in index.tables.items():
            starts, text = _window_starts(bounds, size, stride(size))
            if not len(starts):
                continue
            window, row = table.near(_fingerprints(running, starts, size))
            place = starts[window] - table.at[row]
            candidates.update(zip(text[window].tolist(), table.item[row].tolist(), place.tolist()))
        best: dict[tuple[int, int], tuple[float, int]] = {}
        tried = set()
        # Shingles from every word on; those of a place within a text are a stretch of them.
        rolled = W.shingle_hashes(words, np.array([0, len(words)]))[0]
        for text, item, place in candidates:
            n = len(index.words[item])
            if n >= W.SHINGLE_WORDS:
                low, high = max(place - SHIFT, bounds[text]), min(place + n + SHIFT, bounds[text + 1])
                if index.common(item, rolled[low : high - W.SHINGLE_WORDS + 1]) * 100 < percent * (n - W.SHINGLE_WORDS + 1):
                    continue
            for moved in range(place - SHIFT, place + SHIFT + 1):
                low, high = max(moved, bounds[text]), min(moved + n, bounds[text + 1])
                if high <= low or (text, item, low, high) in tried:
                    continue
                tried.add((text, item, low, high))
                common, either = similarity(_shingle_counts(words[low:high]), index.shingles[item])
                if 100 * common >= percent * either:
                    value = (common / either, int(bounds[text] - low))
                    best[text, item] = max(best.get((text, item), value), value)
        for (text, item), (value, at) in sorted(best.items()):
            yield first + text, item, -at, value


def _with_matches(rows: DataFrame, index: Index, text: str, percent: int, id_type: str) -> DataFrame:
    """``rows`` (a struct ``row``, perhaps with more columns) with an array ``hits`` of (item, start, similarity)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own: list[list] = [[] for _ in range(batch.num_rows)]
            for row, item, at, value in matches(pa.compute.struct_field(batch.column(0), text), index, percent):
                own[row].append({"item": index.ids[item], "start": at, "similarity": value})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, kind)], names=[*batch.schema.names, "hits"])

    schema = extended(rows.schema, hits=_hits(id_type))
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(schema["hits"].dataType)
    return rows.mapInArrow(run, schema)


def _hits(id_type: str) -> str:
    return f"array<struct<item:{id_type},start:bigint,similarity:double>>"


def item_blocks(items: Iterable[tuple]) -> Iterator[list[tuple]]:
    """(id, text) pairs in lists of bounded numbers of items and words."""
    block: list[tuple] = []
    words = 0
    for item in items:
        n = len(item[1].encode().split())
        if block and (len(block) == ITEM_BLOCK or words + n > BLOCK_WORDS):
            yield block
            block, words = [], 0
        block.append(tuple(item))
        words += n
    if block:
        yield block


def find_passages(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", percent: int = MIN_PERCENT
) -> DataFrame:
    """A struct ``row`` with all columns of ``docs``, and ``hits``: an array of (item, start, similarity).

    ``start`` counts words. There is a hit for each item that the document holds, at its best place.
    """
    rows = docs.select(F.struct("*").alias("row"))
    id_type = dict(items.dtypes)[item_id]
    known = items.where(F.col(item_text).isNotNull()).select(item_id, item_text)
    blocks = item_blocks(known.toLocalIterator())

    def indexed(block: list[tuple]) -> Index:
        return Index(*map(list, zip(*block)))

    empty = F.expr(f"CAST(array() AS {_hits(id_type)})")
    first = next(blocks, None)
    if first is None:
        return rows.select("row", empty.alias("hits"))
    second = next(blocks, None)
    if second is None:
        return _with_matches(rows, indexed(first), text, percent, id_type)
    # Written, so that a row has the same number in every pass.
    rows = written(rows.withColumn("number", F.monotonically_increasing_id()), "numbered")
    parts = []
    for i, block in enumerate(chain((first, second), blocks)):
        found = _with_matches(rows, indexed(block), text, percent, id_type).select("number", F.posexplode("hits").alias("place", "hit"))
        parts.append(written(found.select("number", F.struct(F.lit(i).alias("block"), "place", "hit").alias("found")), "passages"))
    every = reduce(DataFrame.unionAll, parts).groupBy("number").agg(F.array_sort(F.collect_list("found")).alias("found"))
    return rows.join(every, "number", "left").select("row", F.coalesce("found.hit", empty).alias("hits"))
