"""Words and shingles of many texts at once, as numpy arrays over their UTF-8 bytes.

A word is a run of bytes other than space, tab, newline, vertical tab, form feed and carriage
return. Texts come as an Arrow column and are worked through in chunks of about two
megabytes; only a single longer text makes a longer chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 21
SHINGLE_WORDS = 5

_draw = np.random.Generator(np.random.PCG64(20240601))
_BYTE = _draw.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_LOWER = _BYTE[_LOWER]
_BASE = 0x9E3779B97F4A7C15
_PLACE = _draw.integers(1, 1 << 63, SHINGLE_WORDS + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True

_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    """The first ``n`` powers of the hash base (``up``) or of its inverse modulo 2^64 (``down``)."""
    if len(_powers[kind]) < n:
        base = _BASE if kind == "up" else pow(_BASE, -1, 1 << 64)
        size = max(n, CHUNK_BYTES + (1 << 17))
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        made = np.cumprod(steps, dtype=np.uint64)
        if size > 4 * CHUNK_BYTES:  # for one very long text; not worth keeping
            return made[:n]
        _powers[kind] = made
    return _powers[kind][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values under which every bit depends on all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_column(column) -> pa.Array:
    """An Arrow column as plain large strings; null gives an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_string()).fill_null("")


def chunks(column, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets of the texts and the end) per chunk."""
    col = text_column(column)
    ends = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(col):
        last = int(np.searchsorted(ends, ends[first] + limit, "right")) - 1
        last = min(len(col), max(first + 1, last))
        yield first, last, data[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        first = last


def prefix_hash(data: np.ndarray, table: np.ndarray = _BYTE) -> np.ndarray:
    """Running polynomial hash, one longer than ``data``; see ``range_hash``."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * _power("up", len(data)), out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte ranges, equal for equal bytes wherever they stand."""
    return mix((prefix[end] - prefix[start]) * _power("down", len(prefix))[start])


def find_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and per text the number of words before it (and in all)."""
    solid = ~_SPACE[data]
    begins, closes = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    closes[:-1] &= ~solid[1:]
    edges = offsets[1:-1]
    edges = edges[edges < len(data)]
    begins[edges] = solid[edges]
    inner = edges[edges > 0]
    closes[inner - 1] = solid[inner - 1]
    start = np.flatnonzero(begins)
    return start, np.flatnonzero(closes) + 1, np.searchsorted(start, offsets)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool) -> np.ndarray:
    return range_hash(prefix_hash(data, _BYTE_LOWER if lower else _BYTE), start, end)


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, width: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each ``width`` consecutive words of a text, and their bounds by text.

    A text with fewer words has its whole sequence as one shingle, one without words none.
    """
    n = np.diff(bounds)
    counts = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    at = np.concatenate([[0], np.cumsum(counts)])
    rolled = np.zeros(max(len(words) - width + 1, 0), np.uint64)
    for j in range(width):
        rolled += words[j : j + len(rolled)] * _PLACE[j]
    index = np.arange(at[-1]) + np.repeat(bounds[:-1] - at[:-1], counts)
    short = np.flatnonzero((n > 0) & (n < width))
    out = np.zeros(at[-1], np.uint64)
    whole = np.ones(at[-1], bool)
    whole[at[short]] = False
    out[whole] = rolled[index[whole]]
    for t in short:
        own = words[bounds[t] : bounds[t + 1]]
        out[at[t] : at[t] + 1] = (own * _PLACE[: len(own)]).sum(keepdims=True) + _PLACE[-1:] * np.uint64(len(own))
    return mix(out), at
