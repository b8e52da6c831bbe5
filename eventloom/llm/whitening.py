"""Whitening of embeddings by shifted CholeskyQR.

The rows, made integers and centred, are a tall matrix X. A pass over the rows sums X'X, whose Cholesky factor,
after a small shift of the diagonal that keeps it positive, gives a first R. Each further pass solves the rows
against R, sums the Gram matrix of the result and multiplies its own factor into R; after three the rows
are orthonormal, so X = QR without X'X being ever trusted at the square of its condition. The singular
vectors of R are the components, and its squared singular values over the number of rows their variances.
Passes send one row for each entry of a Gram matrix and task, summed by Spark; the driver sees matrices of the
dimension alone.

Vectors that are null or hold null or non-finite entries are left out, and so are those with an entry of 2**30 or more
either way and those whose length is not the most common one (the longer, if two are as common). An entry c stands as
floor(``SCALE`` * c) + ``OFFSET``. Directions in which nothing varies are no components, so equal
rows, or fewer rows than asked components, give fewer or none. Repeated rows count as often as they occur;
an empty table gives an empty result. Entries of a component are signed so that the largest one is positive.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.tables import extended

SCALE = 1024
OFFSET = 100_000
COMPONENTS = 8
# Entries from here on do not fit the exact sums.
LARGEST = float(1 << 30)
# Directions of a smaller share of their length after two passes hold rounding alone: they vary by less than
# about 1e-14 of the others.
LEAST = 1e-8


@dataclass(frozen=True)
class Whitening:
    """``components``: rows are unit vectors by falling ``variances``. ``n`` rows with exact ``sums`` were fitted;
    ``identity_error`` is the largest entry of the whitened rows' covariance minus the identity."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    total_variance: float
    identity_error: float

    @property
    def explained(self) -> np.ndarray:
        return self.variances / self.total_variance


def vectors(column) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Lengths of the lists of an Arrow column (-1: not fit for use), and per length (row numbers, integer matrix)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    valid = np.array(column.is_valid())
    ends = np.frombuffer(column.buffers()[1], np.int32 if pa.types.is_list(column.type) else np.int64)
    ends = ends[column.offset : column.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
    values = column.values
    entries = np.asarray(values.to_numpy(zero_copy_only=False), np.float64)
    # Null entries are NaN by now.
    bad = ~(np.abs(entries) < LARGEST)
    before = np.concatenate([[0], np.cumsum(bad)])
    valid &= before[ends[1:]] == before[ends[:-1]]
    length = np.where(valid, np.diff(ends), -1)
    found = []
    for size in np.unique(length[length >= 0]):
        rows = np.flatnonzero(length == size)
        picked = entries[ends[rows][:, None] + np.arange(size)]
        found.append((rows, np.floor(picked * SCALE).astype(np.int64) + OFFSET))
    return length, found


def _own(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and integers of the vectors of the fitted length in the last column."""
    for rows, x in vectors(batch.column(batch.num_columns - 1))[1]:
        if x.shape[1] == size:
            return rows, x
    return np.zeros(0, np.int64), np.zeros((0, size), np.int64)


def _sums(picked: DataFrame) -> tuple[int, list[int]] | None:
    """Number and exact sums of the usable vectors of the most common length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in vectors(batch.column(0))[1]:
                size, total = x.shape[1], x.sum(axis=0)
                # Entry -1 counts the rows.
                at = np.arange(-1, size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(size + 1, size)), pa.array(at), pa.array(np.concatenate([[len(rows)], total]))], names=["size", "entry", "total"]
                )

    parts = picked.mapInArrow(run, "size bigint, entry bigint, total bigint")
    sums = parts.groupBy("size", "entry").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    most = sums.where("entry = -1").orderBy(F.desc("total"), F.desc("size")).first()
    if most is None or most.size == 0:
        return None
    rows = sums.where(F.col("size") == most["size"]).where("entry >= 0").orderBy("entry").collect()
    return int(most.total), [int(r.total) for r in rows]


def centring(n: int, sums: list[int]) -> Callable[[np.ndarray], np.ndarray]:
    """x - sums / n for integers x; the whole part is taken away exactly, so nothing is lost by cancellation."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return lambda x: (x - whole) - rest


def _gram(picked: DataFrame, size: int, transform: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sum of y'y, and of y, over the rows y that ``transform`` makes of the integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = total = None
        for batch in batches:
            y = transform(_own(batch, size)[1])
            if gram is None:
                gram, total = np.zeros((y.shape[1], y.shape[1])), np.zeros(y.shape[1])
            gram += y.T @ y
            total += y.sum(axis=0)
        if gram is not None:
            i, j = np.triu_indices(len(gram))
            at = np.concatenate([np.full(len(total), -1), i]), np.concatenate([np.arange(len(total)), j])
            yield pa.RecordBatch.from_arrays([*map(pa.array, at), pa.array(np.concatenate([total, gram[i, j]]))], names=["i", "j", "part"])

    parts = picked.mapInArrow(run, "i bigint, j bigint, part double")
    # As many rows as a matrix of the dimension has, whatever the input.
    rows = np.array([tuple(r) for r in parts.groupBy("i", "j").agg(F.sum("part")).collect()])
    i, j, part = rows[:, 0].astype(int), rows[:, 1].astype(int), rows[:, 2]
    width = j.max() + 1
    total, gram = np.zeros(width), np.zeros((width, width))
    total[j[i < 0]] = part[i < 0]
    i, j, part = i[i >= 0], j[i >= 0], part[i >= 0]
    gram[i, j] = part
    gram[j, i] = part
    return gram, total


def _solved(centre: Callable[[np.ndarray], np.ndarray], factor: np.ndarray | None) -> Callable[[np.ndarray], np.ndarray]:
    """Centred rows solved against an upper triangular ``factor``, by forward substitution over blocks of columns."""

    def transform(x: np.ndarray) -> np.ndarray:
        y = centre(x)
        if factor is None:
            return y
        out = np.empty_like(y)
        for j in range(y.shape[1]):
            out[:, j] = (y[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
        return out

    return transform


def _shifted(gram: np.ndarray, n: int) -> np.ndarray:
    """Upper Cholesky factor of a Gram matrix, its diagonal raised by more than its rounding can take away."""
    size = len(gram)
    share = min(11 * (n * size + size * (size + 1)) * np.finfo(float).eps / 2, 1e-3)
    return np.linalg.cholesky(gram + max(share, 1e-10) * np.linalg.norm(gram, 2) * np.eye(size)).T


def qr_factor(picked: DataFrame, size: int, n: int, centre: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray, float]:
    """R with R'R the Gram matrix of the centred rows, their sum, and the trace.

    R is square and triangular if all directions vary, else it has a row for each that does.
    """
    first, total = _gram(picked, size, _solved(centre, None))
    scale = np.sqrt(np.diag(first))
    varies = np.flatnonzero(scale > 0)
    if not len(varies):
        return np.zeros((0, size)), total, 0.0
    scale = scale[varies]
    # Columns of very different size would need a shift that drowns the smaller ones.
    factor = _shifted(first[np.ix_(varies, varies)] / np.outer(scale, scale), n) * scale

    def own(x: np.ndarray) -> np.ndarray:
        return centre(x)[:, varies]

    gram, _ = _gram(picked, size, _solved(own, factor))
    well = np.linalg.eigvalsh(gram)[0] > 0.1
    factor = (np.linalg.cholesky(gram).T if well else _shifted(gram, n)) @ factor
    gram, _ = _gram(picked, size, _solved(own, factor))
    values, basis = np.linalg.eigh(gram)
    keep = values > LEAST
    last = np.linalg.cholesky(gram).T if keep.all() else np.sqrt(values[keep])[:, None] * basis[:, keep].T
    whole = np.zeros((len(last), size))
    whole[:, varies] = last @ factor
    return whole, total, float(np.trace(first))


def fit_whitening(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The components of all usable vectors of ``rows``; None if there are none."""
    picked = rows.select(F.col(vector).cast("array<double>").alias("vector"))
    found = _sums(picked)
    if found is None:
        return None
    n, sums = found
    centre = centring(n, sums)
    factor, total, trace = qr_factor(picked, len(sums), n, centre)
    _, singular, basis = np.linalg.svd(factor, full_matrices=False)
    basis, variances = basis[:components], singular[:components] ** 2 / n
    largest = np.abs(basis).argmax(axis=1)
    basis = basis * np.sign(basis[np.arange(len(basis)), largest])[:, None]
    fitted = Whitening(n, sums, basis, variances, trace / n, 0.0)
    if not len(basis):
        return fitted
    # The whitened rows have the mean of the centred ones, which is zero but for rounding.
    project = _projection(fitted)
    mean = total / n @ (basis / np.sqrt(variances)[:, None]).T
    gram, _ = _gram(picked, len(sums), lambda x: project(x) - mean)
    return replace(fitted, identity_error=float(np.abs(gram / n - np.eye(len(basis))).max()))


def _projection(fitted: Whitening) -> Callable[[np.ndarray], np.ndarray]:
    centre = centring(fitted.n, fitted.sums)
    weights = (fitted.components / np.sqrt(fitted.variances)[:, None]).T
    return lambda x: centre(x) @ weights


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[Decimal]:
    """Exact sums over the dimensions of (n * x - sums)**2."""
    y = x - np.array([s // n for s in sums], np.int64)
    rest = [s % n for s in sums]
    most = n * (int(np.abs(y).max(initial=0)) + 1)
    if most * most * len(sums) < 1 << 63:
        d = n * y - np.array(rest, np.int64)
        return list(map(Decimal, (d * d).sum(axis=1).tolist()))
    if most >= 1 << 62:
        d = n * y.astype(object) - np.array(rest, object)
        return [Decimal(int(v)) for v in (d * d).sum(axis=1)]
    d = n * y - np.array(rest, np.int64)
    # Three parts of 21 bits, whose products add up in 64 bits.
    a, b, c = d >> 42, (d >> 21) & 0x1FFFFF, d & 0x1FFFFF
    sums_of = [(p * q).sum(axis=1).tolist() for p, q in ((a, a), (a, b), (a, c), (b, b), (b, c), (c, c))]
    return [Decimal((aa << 84) + (ab << 64) + ((2 * ac + bb) << 42) + (bc << 22) + cc) for aa, ab, ac, bb, bc, cc in zip(*sums_of)]


def whitened(rows: DataFrame, fitted: Whitening | None, vector: str = "embedding") -> DataFrame:
    """A struct ``row`` with all columns of each row that has a usable vector, its ``deviation`` (38 digits at
    most), and ``whitened``: an array with a number for each component."""
    picked = rows.select(F.struct("*").alias("row"), F.col(vector).cast("array<double>").alias("vector"))
    schema = extended(picked.select("row").schema, deviation="decimal(38,0)", whitened="array<double>")
    if fitted is None:
        return rows.sparkSession.createDataFrame([], schema)
    project = _projection(fitted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = _own(batch, len(fitted.sums))
            z = project(x)
            lists = pa.ListArray.from_arrays(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1], z.ravel())
            far = pa.array(_deviations(x, fitted.n, fitted.sums), pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), far, lists], names=schema.names)

    return picked.mapInArrow(run, schema)
