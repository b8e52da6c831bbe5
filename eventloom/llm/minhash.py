"""Near duplicates by min-max hashing.

A document is the set of its distinct five-word shingles. Under each of ``PERMUTATIONS`` random
permutations both the least and the greatest value of the set are kept: two unbiased samples
for one hash evaluation. Bands of ``ROWS`` values make candidates, and a link holds if the
exact similarity of the two full sets is at least ``MIN_PERCENT``.

Equal sets are one class from the start and take part once. A band value that several classes
share is a bucket. All of a bucket are compared with its first member; the links found connect
most of them. Only buckets that are not then within one component go on: their members meet
in blocks of bounded size, where a pair is compared unless it is connected already or its
sizes or the shingles nobody else in the block has rule a link out. Only links that connect something
leave a block. So a bucket of near copies costs about its size, and no link between
classes of one bucket is lost.

A null text or one without words has no set and links with nothing. A text of fewer than five words
is one shingle. Rows with equal keys are one document and in one component, each row with the size of its own set.
Rows without a key are left out. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm import words as W
from eventloom.llm.components import components
from eventloom.llm.tables import extended, small, written

PERMUTATIONS = 64
ROWS = 4
BANDS = 2 * PERMUTATIONS // ROWS
MIN_PERCENT = 75
# Members of a bucket that meet in one block; a task holds the sets of two blocks.
BLOCK = 512

_draw = np.random.Generator(np.random.PCG64(7))
_FACTOR = _draw.integers(0, 1 << 31, PERMUTATIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFT = _draw.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32)
_ROW = _draw.integers(0, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SECOND = np.uint64(0xA5A3564E27F88695)


def shingle_sets(column) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, all sets one after the other in rising order, their bounds) per chunk of texts."""
    for first, _, data, offsets in W.chunks(column):
        start, end, bounds = W.find_words(data, offsets)
        hashes, at = W.shingle_hashes(W.word_hashes(data, start, end, lower=True), bounds)
        sets = [np.unique(hashes[a:b]) for a, b in zip(at[:-1], at[1:])]
        yield first, np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])])


def min_max(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(sets, 2 * PERMUTATIONS): minima, then maxima, of non-empty sets that begin at ``starts``."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(starts), 2 * PERMUTATIONS), np.uint32)
    for k in range(PERMUTATIONS):
        values = x * _FACTOR[k] + _SHIFT[k]
        out[:, k] = np.minimum.reduceat(values, starts)
        out[:, PERMUTATIONS + k] = np.maximum.reduceat(values, starts)
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """(sets, BANDS): a hash of each band's number and values."""
    n = len(signatures)
    bands = signatures.reshape(n, BANDS, ROWS).astype(np.uint64)
    mixed = W.mix((bands * _ROW).sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * _SECOND)
    return W.mix(mixed ^ W.mix((bands[:, :, ::-1] * _ROW).sum(axis=2, dtype=np.uint64)))


def _totals(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return (sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64)


def signatures(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, n_shingles, set_a, set_b, bands): size and 128-bit hash of each set, and its band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, hashes, bounds in shingle_sets(batch.column(1)):
                n = np.diff(bounds)
                some = np.flatnonzero(n)
                keys = np.zeros((len(n), BANDS), np.int64)
                if len(some):
                    keys[some] = band_keys(min_max(hashes, bounds[some])).view(np.int64)
                lists = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, BANDS, dtype=np.int32), keys.ravel())
                sums = [_totals(W.mix(hashes ^ seed), bounds) for seed in (np.uint64(0), _SECOND)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(n)), pa.array(n), *map(pa.array, sums), lists],
                    names=["key", "n_shingles", "set_a", "set_b", "bands"],
                )

    picked = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), text)
    schema = extended(picked.select("key").schema, n_shingles="long", set_a="long", set_b="long", bands="array<bigint>")
    return picked.mapInArrow(run, schema)


def full_sets(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(node, shingles): each set as rising 64-bit numbers in bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, hashes, bounds in shingle_sets(batch.column(1)):
                sets = [hashes[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(sets)), pa.array(sets, pa.binary())], names=["node", "shingles"]
                )

    picked = docs.select(F.col(key).alias("node"), text)
    return picked.mapInArrow(run, extended(picked.select("node").schema, shingles="binary"))


def _linked(common: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    return 100 * common >= percent * (n + m - common)


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            holds = []
            for left, right in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(side.as_buffer(), np.uint64) for side in (left, right))
                few, many = min(len(x), len(y)), max(len(x), len(y))
                common = 0
                if 100 * few >= percent * many:
                    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                    common = int((y[at] == x).sum())
                holds.append(bool(_linked(common, len(x), len(y), percent)))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(holds, pa.bool_()))

    return run


def block_links(components_: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Pairs of indices that are linked and connect members of different components."""
    sizes = np.array([len(s) for s in sets])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    _, at, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.add.reduceat(counts[at] > 1, starts)
    label = np.unique(components_, return_inverse=True)[1]
    mark = np.zeros(len(counts), bool)
    links = []
    for i in range(len(sets) - 1):
        rest = np.arange(i + 1, len(sets))
        bound = np.minimum(shared[i], shared[rest])
        rest = rest[(label[rest] != label[i]) & _linked(bound, sizes[i], sizes[rest], percent)]
        if not len(rest):
            continue
        mark[at[starts[i] : starts[i] + sizes[i]]] = True
        common = np.array([np.count_nonzero(mark[at[starts[j] : starts[j] + sizes[j]]]) for j in rest])
        mark[at[starts[i] : starts[i] + sizes[i]]] = False
        for j in rest[_linked(common, sizes[i], sizes[rest], percent)]:
            if label[j] != label[i]:
                links.append((i, int(j)))
                label[label == label[j]] = label[i]
    return links


def _blocks(percent: int):
    """Groups of rows (band, low, high, component, shingles), sorted by the first three, to links of components."""

    def links(group: list) -> pa.RecordBatch:
        whole = pa.Table.from_batches(group).combine_chunks().to_batches()[0]
        sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in whole.column(4)]
        names = whole.column(3)
        found = block_links(np.unique(names.to_numpy(zero_copy_only=False), return_inverse=True)[1], sets, percent)
        a, b = (names.take(pa.array([pair[side] for pair in found], pa.int64())) for side in (0, 1))
        return pa.RecordBatch.from_arrays([a, b], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, current = [], None
        for batch in batches:
            ids = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            first = 0
            for i in range(len(ids) + 1):
                if i == len(ids) or ids[i] != current:
                    if i > first:
                        group.append(batch.slice(first, i - first))
                    if i < len(ids):
                        if group:
                            yield links(group)
                        group, current, first = [], ids[i], i
        if group:
            yield links(group)

    return run


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = MIN_PERCENT) -> DataFrame:
    """(key, n_shingles, component_id, kept) per row with a key; ``kept`` is the smallest key of a component."""
    signed = written(signatures(docs, key, text), "signatures")
    classes = (
        signed.where(F.col("n_shingles") > 0)
        .groupBy("set_a", "set_b")
        .agg(F.min(F.struct("key", "bands")).alias("first"))
        .select("set_a", "set_b", F.col("first.key").alias("node"), "first.bands")
    )
    classes = written(classes, "classes")
    labels = class_components(docs, classes, key, text, percent)
    members = signed.join(classes.select("set_a", "set_b", "node"), ["set_a", "set_b"], "left")
    members = members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    # Rows of one key with different texts connect what each of them belongs to.
    several = members.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b")
    several = written(several.select("a", "b"), "same-key")
    if several.take(1):
        joined = members.select(F.col("key").alias("a"), F.col("component").alias("b")).where("b IS NOT NULL")
        members = members.drop("component").join(components(joined).withColumnRenamed("node", "key"), "key", "left")
    component = F.coalesce("component", "key")
    return members.select(
        F.col("key").alias(key), "n_shingles", component.alias("component_id"), (F.col("key") == component).alias("kept")
    )


def class_components(docs: DataFrame, classes: DataFrame, key: str, text: str, percent: int) -> DataFrame:
    """(node, component) of the classes that are linked with another one."""
    banded = classes.select("node", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(
        F.count(F.lit(1)).alias("size"), F.min("node").alias("pivot"), F.sum(F.shiftright(F.xxhash64("node"), 20)).alias("who")
    )
    # Bands that hold the same members say the same; one of them is enough.
    buckets = buckets.where(F.col("size") > 1).groupBy("pivot", "size", "who").agg(F.min("band").alias("band"))
    buckets = written(buckets.select("band", "pivot", "size"), "buckets")
    members = written(banded.join(small(buckets), "band"), "members")

    wanted = written(members.select("node").distinct(), "candidates")
    owned = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("node"), text).join(small(wanted), "node", "left_semi")
    sets = written(full_sets(owned, "node", text).distinct(), "sets")

    pairs = members.where(F.col("node") != F.col("pivot")).select("pivot", "node").distinct()
    sided = pairs.join(sets, "node").withColumnRenamed("shingles", "right").join(
        sets.select(F.col("node").alias("pivot"), F.col("shingles").alias("left")), "pivot"
    )
    link = extended(classes.select(F.col("node").alias("a"), F.col("node").alias("b")).schema)
    stars = written(sided.select("pivot", "node", "left", "right").mapInArrow(_verified(percent), link), "star-links")
    first = written(components(stars), "star-components")

    placed = members.join(first, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = written(placed.select("band", "node", "component", "size"), "placed")
    open_ = placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    open_ = written(open_.where("low < high").select("band"), "open-buckets")
    parts = F.ceil(F.col("size") / BLOCK)
    own = F.pmod(F.xxhash64("band", "node"), F.col("parts"))
    dealt = (
        placed.join(small(open_), "band")
        .withColumn("parts", parts)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        .select("band", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "component", "node")
        .join(sets, "node")
        .select("band", "low", "high", "component", "shingles")
        .repartition("band", "low", "high")
        .sortWithinPartitions("band", "low", "high")
    )
    rest = written(dealt.mapInArrow(_blocks(percent), link), "block-links")
    second = components(rest)
    joined = first.join(second.select(F.col("node").alias("component"), F.col("component").alias("final")), "component", "left")
    merged = joined.select("node", F.coalesce("final", "component").alias("component"))
    # Components of the second round may be classes without a link in the first.
    alone = second.join(first.select("node"), "node", "left_anti")
    return written(merged.unionByName(alone), "components")
