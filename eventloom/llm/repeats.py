"""Long repeated byte strings, from the common-prefix interval tree of an enhanced suffix array.

Matches are sought between all texts and within them, as UTF-8 bytes. The suffix array is sparse: it
has the suffixes that start at anchors. The anchor of a window of ``LENGTH`` bytes is the place in it whose
following ``GRAM`` bytes have the least hash, the first of several, so equal windows have their anchor at the same
distance from their start. Neighbouring windows share their anchor; about one byte in 185 is one.

1. Every text gives its anchors, each with the range of its windows and a hash of their bytes. Anchors
   whose gram occurs once are done. Those whose whole range occurs twice are repeated throughout.
2. Where anchors have the same gram but different ranges, one occurrence of each range goes into the suffix array of the
   gram: the bytes after the anchor are sorted, their common prefixes measured, and the intervals of
   suffixes with a longer common prefix found by a scan with a stack. In each interval the bytes before the
   anchors are sorted in the same way. A set of occurrences with a common left and right part of ``LENGTH`` bytes or
   more in all is a maximal repeat if neither all left nor all right neighbours agree.
3. A gram with more than ``GROUP`` different ranges is too large for one task. The windows of its ranges are then
   counted by hash instead, which is exact too. For the groups, the parts right of the anchors and left of them are
   counted, and then the pairs of those that do not all go on in the same way.

A null or empty text has no bytes. Rows count each for itself, also those with equal keys or without one. An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm import words as W
from eventloom.llm.tables import extended, small, written

LENGTH = 400
GRAM = 32
GROUP = 4096

# A place within a chunk takes this many bits of a number, its gram's hash the others.
_PLACE_BITS = 20
_CHUNK = 1 << _PLACE_BITS
_ANCHOR = ["gram", "span", "first", "anchor", "last"]


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` consecutive ones."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def find_anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, gram, span, first, anchor, last) per anchor of texts of at most ``_CHUNK`` bytes in all.

    ``first`` and ``last`` are the starts of the first and last window with the anchor, all counted in ``data``.
    """
    room = np.maximum(np.diff(offsets) - length + 1, 0)
    if not room.any():
        return (np.zeros(0, np.int64),) * 6
    before = np.concatenate([[0], np.cumsum(room)[:-1]])
    text = np.repeat(np.arange(len(room)), room)
    start = np.arange(len(text)) + np.repeat(offsets[:-1] - before, room)
    prefix = W.prefix_hash(data)
    at = np.arange(len(data) - gram + 1)
    grams = W.range_hash(prefix, at, at + gram)
    rank = (grams >> np.uint64(_PLACE_BITS)) << np.uint64(_PLACE_BITS) | at.astype(np.uint64)
    anchor = (_sliding_least(rank, length - gram + 1)[start] & np.uint64(_CHUNK - 1)).astype(np.int64)
    begins = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    ends = np.concatenate([begins[1:], [len(anchor)]]) - 1
    first, last, anchor = start[begins], start[ends], anchor[begins]
    span = W.range_hash(prefix, first, last + length)
    # The same bytes about another place in them are another range.
    span = W.mix(span ^ (anchor - first).astype(np.uint64))
    return text[begins], grams[anchor], span, first, anchor, last


def _pieces(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(start, bytes, offsets): all texts at once, or a longer text in parts that overlap by a window less one byte."""
    if len(data) <= _CHUNK:
        yield 0, data, offsets
        return
    for begin in range(0, max(1, len(data) - length + 1), _CHUNK - length + 1):
        part = data[begin : begin + _CHUNK]
        yield begin, part, np.array([0, len(part)])


def anchors(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """(key, version, gram, span, first, anchor, last) of a frame (key, version, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, _, data, offsets in W.chunks(batch.column(2), _CHUNK):
                for begin, part, bounds in _pieces(data, offsets, length):
                    text, grams, span, first, anchor, last = find_anchors(part, bounds, length, gram)
                    own = pa.array(text + row)
                    shift = begin - offsets[text]
                    places = [pa.array((x + shift).astype(np.int64)) for x in (first, anchor, last)]
                    hashes = [pa.array(x.view(np.int64)) for x in (grams, span)]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(own), batch.column(1).take(own), *hashes, *places], names=["key", "version", *_ANCHOR]
                    )

    schema = extended(texts.select("key", "version").schema, **dict.fromkeys(_ANCHOR, "long"))
    return texts.mapInArrow(run, schema)


def contexts(texts: DataFrame, length: int) -> DataFrame:
    """(gram, key, version, first, anchor, last, left, right, span) of a frame (key, version, text, found)."""
    names = ["first", "anchor", "last"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = batch.column(2)[i].as_py().encode()
                found = batch.column(3)[i].values
                first, anchor, last = (found.field(n).to_pylist() for n in names)
                left = [data[a:b] for a, b in zip(first, anchor)]
                right = [data[a : b + length] for a, b in zip(anchor, last)]
                own = pa.array([i] * len(first), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [found.field("gram"), batch.column(0).take(own), batch.column(1).take(own), *(found.field(n) for n in names), pa.array(left, pa.binary()), pa.array(right, pa.binary()), found.field("span")],
                    names=["gram", "key", "version", *names, "left", "right", "span"],
                )

    id_ = texts.select("key", "version").schema
    schema = extended(extended(type(id_)([]), gram="long"))
    schema = extended(type(id_)([*schema.fields, *id_.fields]), first="long", anchor="long", last="long", left="binary", right="binary", span="long")
    return texts.mapInArrow(run, schema)


def _matrix(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(s) for s in strings], np.int64)
    width = int(sizes.max(initial=0)) + 1
    flat = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8)
    return flat.reshape(len(strings), width), sizes


def _common(matrix: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each string and the one before it in ``order``; 0 for the first."""
    differ = matrix[order[1:]] != matrix[order[:-1]]
    lengths = np.where(differ.any(axis=1), differ.argmax(axis=1), matrix.shape[1])
    return np.concatenate([[0], np.minimum(lengths, np.minimum(sizes[order[1:]], sizes[order[:-1]]))])


def prefix_intervals(common: np.ndarray, least: int = 0) -> Iterator[tuple[int, int, int]]:
    """(length, first, last) of each interval of two or more sorted strings whose common prefix is longer than
    that of any larger interval around it, by a scan with a stack; ``length`` is at least ``least``."""
    values = common.tolist()
    stack = [(-1, 0)]
    for i in range(1, len(values) + 1):
        value = values[i] if i < len(values) else -1
        begin = i - 1
        while stack[-1][0] > value:
            length, begin = stack.pop()
            if length >= least:
                yield length, begin, i - 1
        if stack[-1][0] < value:
            stack.append((value, begin))


def maximal_repeats(lefts: list[bytes], rights: list[bytes], length: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(left part, right part, occurrences) of the maximal repeats of at least ``length`` bytes through one gram.

    ``lefts`` end and ``rights`` start at the anchor. All occurrences of a repeat share its left and right
    part; not all agree, or go on, beyond either.
    """
    after, after_sizes = _matrix(rights)
    before, before_sizes = _matrix([s[::-1] for s in lefts])
    order = np.array(sorted(range(len(rights)), key=rights.__getitem__))
    left_rank = np.empty(len(lefts), np.int64)
    left_rank[sorted(range(len(lefts)), key=lambda i: lefts[i][::-1])] = np.arange(len(lefts))
    most_left = int(before_sizes.max())
    common = _common(after, after_sizes, order)
    for right, low, high in prefix_intervals(common, length - most_left):
        inside = order[low : high + 1]
        branch = np.cumsum(np.concatenate([[0], common[low + 1 : high + 1] == right]))
        by_left = np.argsort(left_rank[inside])
        members, branch = inside[by_left], branch[by_left]
        for left, a, b in prefix_intervals(_common(before, before_sizes, members), max(0, length - right)):
            if (branch[a : b + 1] != branch[a]).any():
                yield left, right, members[a : b + 1]


def _repeats(length: int, merged: bool):
    """Rows of ``contexts``, sorted by gram, to what the maximal repeats say.

    Either (gram, repeat, left, right, span) for each repeat and range it occurs in. Or, ``merged``,
    (key, version, start, size) for each row that has a repeat: the union of its repeats, which is one range
    as all go through the anchor.
    """

    def groups(rows: pa.RecordBatch, repeats: Iterator[tuple[int, int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        spans = rows.column(8).to_numpy()
        for number, (left, right, members) in enumerate(repeats):
            members = members[np.unique(spans[members], return_index=True)[1]]
            n, own = len(members), pa.array(members)
            sides = [pa.array(np.full(n, x)) for x in (number, left, right)]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).take(own), *sides, rows.column(8).take(own)], names=["gram", "repeat", "left", "right", "span"]
            )

    def unions(rows: pa.RecordBatch, repeats: Iterator[tuple[int, int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        before, after = np.zeros(rows.num_rows, np.int64), np.zeros(rows.num_rows, np.int64)
        for left, right, members in repeats:
            before[members] = np.maximum(before[members], left)
            after[members] = np.maximum(after[members], right)
        own = np.flatnonzero(after)
        start = rows.column(4).to_numpy()[own] - before[own]
        at = pa.array(own)
        yield pa.RecordBatch.from_arrays(
            [rows.column(1).take(at), rows.column(2).take(at), pa.array(start), pa.array((before + after)[own])],
            names=["key", "version", "start", "size"],
        )

    def found(group: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(group).combine_chunks().to_batches()[0]
        repeats = maximal_repeats(rows.column(6).to_pylist(), rows.column(7).to_pylist(), length)
        yield from (unions if merged else groups)(rows, repeats)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[pa.RecordBatch] = []
        for batch in batches:
            grams = batch.column(0).to_numpy()
            cuts = np.flatnonzero(grams[1:] != grams[:-1]) + 1
            for low, high in zip([0, *cuts], [*cuts, len(grams)]):
                if group and low < high and group[-1].column(0)[0].as_py() != grams[low]:
                    yield from found(group)
                    group = []
                group.append(batch.slice(low, high - low))
        if group:
            yield from found(group)

    return run


def _windows(length: int):
    """Rows of ``contexts`` to (gram, window, key, version, start): every window with its distance from the anchor, hashed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = np.frombuffer(batch.column(6)[i].as_py() + batch.column(7)[i].as_py(), np.uint8)
                first, anchor, last = (batch.column(c)[i].as_py() for c in (3, 4, 5))
                start = np.arange(first, last + 1)
                hashes = W.range_hash(W.prefix_hash(data), start - first, start - first + length)
                hashes = W.mix(hashes ^ (anchor - start).astype(np.uint64)).view(np.int64)
                own = pa.array(np.full(len(start), i))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(own), pa.array(hashes), batch.column(1).take(own), batch.column(2).take(own), pa.array(start)],
                    names=["gram", "window", "key", "version", "start"],
                )

    return run


def _parts(length: int):
    """Rows of ``contexts`` with ``copies`` to (gram, span, copies, side, size, hash, beyond): every part of a range that
    ends (side 0) or starts (side 1) at the anchor and can be in a repeat, and the byte beyond it, -1 at the range's end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                left, right = (np.frombuffer(batch.column(c)[i].as_py(), np.uint8) for c in (6, 7))
                for side, data, other in ((0, left[::-1], right), (1, right, left)):
                    sizes = np.arange(max(0, length - len(other)), len(data) + 1)
                    hashes = W.range_hash(W.prefix_hash(data), np.zeros(len(sizes), np.int64), sizes).view(np.int64)
                    beyond = np.concatenate([data.astype(np.int64), [-1]])[sizes]
                    own = pa.array(np.full(len(sizes), i))
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(c).take(own) for c in (0, 8, 9)), *map(pa.array, (np.full(len(sizes), side), sizes, hashes, beyond))],
                        names=["gram", "span", "copies", "side", "size", "hash", "beyond"],
                    )

    return run


def _differ(beyond: str):
    """Whether the occurrences of a group do not all go on with the same byte; at the ends of ranges none agree."""
    return (F.min(beyond) != F.max(beyond)) | (F.min(beyond) == -1)


class Repeats:
    """The tables of steps 1 and 2 for the texts of a frame, each written once."""

    def __init__(self, docs: DataFrame, key: str, text: str, length: int, gram: int, group: int):
        self.length = length
        id_ = F.col(key).alias("key"), F.xxhash64(text).alias("version")
        texts = docs.where(F.octet_length(text) >= length).select(*id_, F.col(text).alias("text"))
        self.id = texts.select("key", "version").schema
        every = written(anchors(texts, length, gram), "anchors")
        grams = every.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), (F.min("span") != F.max("span")).alias("mixed"))
        grams = written(grams.where("n > 1").select("gram", "mixed"), "grams")
        again = written(every.join(small(grams), "gram"), "repeated-anchors")
        #: Anchors of grams all of whose occurrences have the same range, and of the others.
        self.alike, self.mixed = again.where("NOT mixed"), again.where("mixed")

        place = F.struct("key", "version", "first", "anchor", "last")
        spans = self.mixed.groupBy("gram", "span").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("place"))
        self.spans = written(spans, "spans")
        large = self.spans.groupBy("gram").count().where(F.col("count") > group).select("gram")
        self.large = small(written(large, "large-grams"))
        chosen = self.spans.select("gram", "span", "place.*")
        fields = ["gram", "first", "anchor", "last", "span"]
        by_text = chosen.groupBy("key", "version").agg(F.collect_list(F.struct(*fields)).alias("found"))
        wanted = written(chosen.select("version").distinct(), "wanted-texts")
        # One text stands for all rows with its key.
        own = texts.join(small(wanted), "version", "left_semi").dropDuplicates(["key", "version"])
        same = own.key.eqNullSafe(by_text.key) & (own.version == by_text.version)
        joined = own.join(by_text, same).select(own.key, own.version, "text", "found")
        self.around = written(contexts(joined, length), "contexts")

    def _schema(self, *before: str, **after: str):
        kind = type(self.id)
        return extended(kind([*extended(kind([]), **dict.fromkeys(before, "long")).fields, *self.id.fields]), **after)

    def trees(self, merged: bool) -> DataFrame:
        """The repeats through grams that fit into one task."""
        fitting = self.around.join(self.large, "gram", "left_anti").select(self.around.columns)
        if merged:
            schema = self._schema(start="long", size="long")
        else:
            # A range that occurs twice or more is a repeat by itself, and two suffixes stand for any number of equal ones.
            fitting = fitting.unionByName(fitting.join(self.twice(), ["gram", "span"], "left_semi").select(fitting.columns))
            schema = extended(type(self.id)([]), **dict.fromkeys(["gram", "repeat", "left", "right", "span"], "long"))
        return fitting.repartition("gram").sortWithinPartitions("gram").mapInArrow(_repeats(self.length, merged), schema)

    def counted(self) -> DataFrame:
        """(key, version, start) of the windows that occur twice or more, for the other grams."""
        rest = self.around.join(self.large, "gram", "left_semi").select(self.around.columns)
        windows = written(rest.mapInArrow(_windows(self.length), self._schema("gram", "window", start="long")), "windows")
        often = windows.groupBy("gram", "window").count().where("count > 1").drop("count")
        return windows.join(often, ["gram", "window"], "left_semi").select("key", "version", "start")

    def counted_groups(self) -> DataFrame:
        """(gram, repeat, left, right, span) of the repeats through the other grams.

        Not all occurrences of a repeat go on in the same way beyond its right part, so neither do all that have the
        right part alone, and the same holds on the left. Only pairs of such parts are counted.
        """
        rest = self.around.join(self.large, "gram", "left_semi").select(self.around.columns)
        rest = rest.join(self.twice().withColumn("twice", F.lit(True)), ["gram", "span"], "left")
        rest = rest.select(*self.around.columns, F.when(F.col("twice"), 2).otherwise(1).cast("long").alias("copies"))
        names = ["gram", "span", "copies", "side", "size", "hash", "beyond"]
        schema = extended(type(self.id)([]), **dict.fromkeys(names, "long"))
        parts = written(rest.mapInArrow(_parts(self.length), schema), "parts")
        kind = ["gram", "side", "size", "hash"]
        ends = parts.groupBy(*kind).agg(F.sum("copies").alias("n"), _differ("beyond").alias("differ")).where("n > 1 AND differ").select(kind)
        parts = written(parts.join(ends, kind, "left_semi").select(names), "part-ends")

        def side(number: int, name: str) -> DataFrame:
            renamed = [F.col("size").alias(name), F.col("hash").alias(f"{name}_hash"), F.col("beyond").alias(f"{name}_beyond")]
            return parts.where(F.col("side") == number).select("gram", "span", *(["copies"] if number else []), *renamed)

        pairs = side(0, "left").join(side(1, "right"), ["gram", "span"]).where(F.col("left") + F.col("right") >= self.length)
        kind = ["gram", "left", "right", "left_hash", "right_hash"]
        pairs = written(pairs.withColumn("repeat", F.xxhash64(*kind[1:])), "pairs")
        found = pairs.groupBy(*kind).agg(F.sum("copies").alias("n"), (_differ("left_beyond") & _differ("right_beyond")).alias("differ"))
        found = found.where("n > 1 AND differ").select(kind)
        return pairs.join(found, kind, "left_semi").select("gram", "repeat", "left", "right", "span")

    def twice(self) -> DataFrame:
        """(gram, span) of the ranges in mixed grams that occur twice or more."""
        return small(written(self.spans.where("n > 1").select("gram", "span"), "copied-spans"))

    def copied(self) -> DataFrame:
        """Anchors of mixed grams whose range occurs twice or more."""
        return self.mixed.join(self.twice(), ["gram", "span"], "left_semi")


def repeated_ranges(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """(key, version, start, size): ranges of bytes that cover what lies in a repeated string of ``length`` bytes.

    Ranges may overlap. ``version`` is the hash of the text.
    """
    found = Repeats(docs, key, text, length, gram, group)

    def whole(df: DataFrame) -> DataFrame:
        return df.select("key", "version", F.col("first").alias("start"), (F.col("last") + length - F.col("first")).alias("size"))

    single = found.counted().withColumn("size", F.lit(length).cast("long"))
    parts = [found.trees(merged=True), whole(found.alike), whole(found.copied()), single]
    return written(reduce(DataFrame.unionByName, parts), "ranges")


def repeat_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """(gram, repeat, size, key, version, start): the maximal repeats through each gram, with all occurrences.

    A repeat is seen through each anchor in it, as far as the windows with that anchor reach. Repeat 0 of a
    gram whose occurrences are all alike is that range. In grams with more than ``group`` ranges ``repeat`` is a hash.
    """
    found = Repeats(docs, key, text, length, gram, group)
    ranges = found.trees(merged=False).unionByName(found.counted_groups()).join(found.mixed.select("gram", "span", "key", "version", "anchor"), ["gram", "span"])
    size, start = F.col("left") + F.col("right"), F.col("anchor") - F.col("left")
    mixed = ranges.select("gram", "repeat", size.alias("size"), "key", "version", start.alias("start"))
    size = F.col("last") + length - F.col("first")
    alike = found.alike.select("gram", F.lit(0).cast("long").alias("repeat"), size.alias("size"), "key", "version", F.col("first").alias("start"))
    return mixed.unionByName(alike)


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """(row, n_bytes, n_removed, n_spans, kept_sha256, kept): the bytes left of each text, as binary."""
    ranges = repeated_ranges(docs, key, text, length, gram, group)
    cut = ranges.groupBy("key", "version").agg(F.collect_set(F.struct("start", "size")).alias("ranges"))
    touched = small(written(ranges.select("version").distinct(), "touched"))
    rows = docs.select(F.struct("*").alias("row"), F.col(key).alias("key"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("version"))
    body = F.coalesce(F.col(f"row.{text}"), F.lit(""))
    zero = F.lit(0).cast("long")
    whole = body.cast("binary")
    clean = rows.join(touched, "version", "left_anti").select(
        "row", F.octet_length(body).cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.sha2(whole, 256).alias("kept_sha256"), whole.alias("kept")
    )
    hit = rows.join(touched, "version", "left_semi")
    same = hit.key.eqNullSafe(cut.key) & (hit.version == cut.version)
    joined = hit.join(cut, same, "left").select("row", "ranges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.compute.struct_field(batch.column(0), text)
            out = [_cut((texts[i].as_py() or "").encode(), batch.column(1)[i]) for i in range(batch.num_rows)]
            cols = list(zip(*out)) or [[]] * 5
            kinds = [pa.int64()] * 3 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, cols, kinds)], names=["row", *names])

    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    schema = extended(joined.select("row").schema, n_bytes="long", n_removed="long", n_spans="long", kept_sha256="string", kept="binary")
    return joined.mapInArrow(run, schema).unionByName(clean)


def _cut(data: bytes, ranges) -> tuple[int, int, int, str, bytes]:
    if not ranges.is_valid:
        return len(data), 0, 0, hashlib.sha256(data).hexdigest(), data
    start = ranges.values.field("start").to_numpy()
    order = np.argsort(start, kind="stable")
    start = start[order]
    reach = np.maximum.accumulate(start + ranges.values.field("size").to_numpy()[order])
    fresh = np.concatenate([[True], start[1:] > reach[:-1]])
    lows, highs = start[fresh], reach[np.concatenate([np.flatnonzero(fresh)[1:] - 1, [len(reach) - 1]])]
    edges = zip([0, *highs.tolist()], [*lows.tolist(), len(data)])
    kept = b"".join(data[a:b] for a, b in edges)
    return len(data), len(data) - len(kept), len(lows), hashlib.sha256(kept).hexdigest(), kept
