"""Quality scores: ridge regression on random Fourier features of document statistics, then calibrated.

Each text is described by ``STATISTICS``, counts and shares that Python computes from its bytes. They are
standardized and sent through ``FEATURES`` random cosines, whose inner products approach a Gaussian
kernel. Each task sums the normal equations of its labelled rows, and the sums are added in two steps, so the
driver gets ``SUMS`` small matrices whatever the number of rows. The rows have two folds; each fold's raw
scores come from a model fitted to the other, and an isotonic fit to them, over ``BINS`` equal bins of the
raw score, gives the calibration of the model fitted to both.

Null and empty texts are all zeros and get a score like any other. Null labels are left out, several labels
of a document all count, and documents without one take no part in the fit. Without labels of both kinds
every score is the share of label 1, or 0.5. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm import words as W
from eventloom.llm.quality import count_rules
from eventloom.llm.tables import extended, written

FEATURES = 256
# Width of the kernel in standard deviations, times the square root of the number of statistics.
WIDTH = 1.0
RIDGE = 1e-2
BINS = 1024
SUMS = 8
# Share of the raw score in the result, which keeps the order within a pooled block.
RAW_SHARE = 0.02

_CLASSES = {
    "letters": range(65, 91), "small": range(97, 123), "digits": range(48, 58), "symbols": b"#*$%&|<>", "stops": b".,;:",
    "calls": b"!?", "brackets": b"()[]{}/\\=_+-@", "high": range(128, 256), "lines": b"\n", "blanks": b" \t\r\v\f", "quotes": b"'\"",
}
STATISTICS = [
    "log_bytes", "log_words", "log_lines", *(f"share_{name}" for name in _CLASSES), "word_length", "word_spread", "distinct_words",
    "distinct_shingles", "repeat_words", "dup_lines", "marked_words", "loud_words", "short_words", "line_words",
]


def _class(members) -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[list(members)] = 1
    return out


_TABLES = {name: _class(members) for name, members in _CLASSES.items()}
_LOUD = _class(range(65, 91)).astype(bool)
_MARK = _class(b"#*$%&|<>!").astype(bool)


def describe(column) -> np.ndarray:
    """(texts, STATISTICS) of an Arrow column of texts."""
    col = W.text_column(column)
    out = []
    counted = np.array(count_rules(col), np.float64).T
    for first, last, data, offsets in W.chunks(col):
        start, end, bounds = W.find_words(data, offsets)
        hashes = W.word_hashes(data, start, end, lower=False)
        shingles, at = W.shingle_hashes(hashes, bounds)
        size, n_words = np.diff(offsets), np.diff(bounds)
        per_byte, per_word = np.maximum(size, 1), np.maximum(n_words, 1)

        def by_text(values: np.ndarray, edges: np.ndarray = bounds) -> np.ndarray:
            return np.diff(np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])[edges])

        length = (end - start).astype(np.float64)
        shares = [by_text(table[data], offsets) / per_byte for table in _TABLES.values()]
        lines = by_text(_TABLES["lines"][data], offsets) + 1
        mean = by_text(length) / per_word
        spread = np.sqrt(np.maximum(by_text(length**2) / per_word - mean**2, 0))
        distinct = [len(np.unique(hashes[a:b])) for a, b in zip(bounds[:-1], bounds[1:])]
        fresh = [len(np.unique(shingles[a:b])) for a, b in zip(at[:-1], at[1:])]
        loud = _LOUD[data[start]] & _LOUD[data[end - 1]] if len(start) else np.zeros(0)
        marked = _MARK[data[end - 1]] if len(start) else np.zeros(0)
        rules = counted[first:last]
        out.append(
            np.column_stack([
                np.log1p(size), np.log1p(n_words), np.log(lines), *shares, mean, spread, distinct / per_word, fresh / np.maximum(np.diff(at), 1),
                rules[:, 4] / per_word, rules[:, 3] / lines, by_text(marked) / per_word, by_text(loud) / per_word, by_text(length <= 2) / per_word,
                np.log1p(n_words / lines),
            ])
        )
    return np.concatenate(out) if out else np.zeros((0, len(STATISTICS)))


def statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, stats) with an array of ``STATISTICS`` per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(describe(batch.column(1)))], names=[key, "stats"])

    picked = docs.select(key, text)
    return picked.mapInArrow(run, extended(picked.select(key).schema, stats="array<double>"))


def _lists(values: np.ndarray) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(np.arange(0, (n + 1) * width, width, dtype=np.int32), values.ravel())


def _rows(column, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


@dataclass
class Model:
    """Statistics to scores; small enough to travel with each task."""

    mean: np.ndarray
    scale: np.ndarray
    turns: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        inner = np.clip((stats - self.mean) / self.scale, -8, 8) @ self.turns + self.phase
        return np.column_stack([np.sqrt(2 / len(self.phase)) * np.cos(inner), np.ones(len(stats))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def scores(self, stats: np.ndarray) -> np.ndarray:
        raw = self.raw(stats)
        fitted = np.interp(raw, self.knots, self.values)
        return np.clip((1 - RAW_SHARE) * fitted + RAW_SHARE * np.clip(raw, 0, 1), 0, 1)


def _summed(rows: DataFrame, model: Model) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Normal equations by fold of a frame (fold, label, stats)."""
    size = len(model.phase) + 1

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            folds = batch.column(0).to_numpy()
            for fold in np.unique(folds).tolist():
                own = folds == fold
                x = model.features(_rows(batch.column(2), len(model.mean))[own])
                y = batch.column(1).to_numpy()[own]
                part = np.vstack([x.T @ x, x.T @ y])
                sums[fold] = sums.get(fold, 0) + part
        yield packed(sums)

    def packed(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["fold", "sums"]
        )

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for fold, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                sums[fold] = sums.get(fold, 0) + np.frombuffer(part.as_buffer()).reshape(size + 1, size)
        yield packed(sums)

    kind = "fold int, sums binary"
    out: dict[int, np.ndarray] = {}
    for row in rows.mapInArrow(equations, kind).repartition(SUMS).mapInArrow(added, kind).collect():
        out[row.fold] = out.get(row.fold, 0) + np.frombuffer(row.sums).reshape(size + 1, size)
    return {fold: (s[:-1], s[-1]) for fold, s in out.items()}


def isotonic(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Rising fit to the means ``total / n`` by pooling neighbours that fall."""
    blocks: list[list[float]] = []
    for weight, amount in zip(n.tolist(), total.tolist()):
        blocks.append([weight, amount, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.repeat([t / w for w, t, _ in blocks], [int(k) for _, _, k in blocks])


def fit(rows: DataFrame, seed: int = 11) -> Model | float:
    """A model from a written frame (fold, label, stats) with folds 0 and 1, or the constant score."""
    width = len(STATISTICS)
    at = [F.col("stats")[i] for i in range(width)]
    n, ones, *moments = rows.agg(
        F.count(F.lit(1)), F.sum("label"), *[f(c) for c in at for f in (F.avg, F.stddev_pop)]
    ).first()
    if not n or not 0 < ones < n:
        return ones / n if n else 0.5
    mean, scale = np.array(moments[::2]), np.array(moments[1::2])
    draw = np.random.Generator(np.random.PCG64(seed))
    turns = draw.normal(size=(width, FEATURES)) / (WIDTH * np.sqrt(width))
    phase = draw.uniform(0, 2 * np.pi, FEATURES)
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0), turns, phase, np.zeros(FEATURES + 1), np.zeros(1), np.zeros(1))
    sums = _summed(rows, model)

    def solved(parts) -> np.ndarray:
        a, b = (sum(x) for x in zip(*parts))
        return np.linalg.solve(a + RIDGE * max(a[-1, -1], 1) / FEATURES * np.eye(len(b)), b)

    both = solved(sums.values())
    crossed = [solved([sums[1 - fold]]) if 1 - fold in sums else both for fold in (0, 1)]

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = model.features(_rows(batch.column(2), width))
            value = np.where(batch.column(0).to_numpy() == 0, x @ crossed[0], x @ crossed[1])
            bins = np.clip((value + 0.5) / 2 * BINS, 0, BINS - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bins), pa.array(value), batch.column(1)], names=["bin", "value", "label"])

    binned = rows.mapInArrow(raw, "bin long, value double, label double").groupBy("bin")
    # At most BINS rows.
    table = np.array(binned.agg(F.count(F.lit(1)).cast("double"), F.sum("label"), F.avg("value")).orderBy("bin").collect(), float)
    model.weights = both
    model.knots, model.values = np.maximum.accumulate(table[:, 3]), isotonic(table[:, 1], table[:, 2])
    return model


def scored(stats: DataFrame, model: Model | float, key: str = "doc_id") -> DataFrame:
    """(key, score) of the result of ``statistics``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _rows(batch.column(1), len(STATISTICS))
            score = np.full(len(x), model) if isinstance(model, float) else model.scores(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=[key, "score"])

    return stats.select(key, "stats").mapInArrow(run, extended(stats.select(key).schema, score="double"))


def score_documents(docs: DataFrame, labels: DataFrame, train: Column, fold: Column, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """(key, score): fitted to the labelled documents for which ``train`` holds, given to all.

    ``train`` and ``fold`` (0 or 1) are expressions of the key.
    """
    stats = written(statistics(docs, key, text), "statistics")
    known = labels.where(F.col(label).isNotNull()).select(key, F.col(label).cast("double").alias("label"))
    rows = known.where(train).withColumn("fold", fold.cast("int")).join(stats, key)
    model = fit(written(rows.select("fold", "label", "stats"), "labelled"))
    return scored(stats, model, key)
