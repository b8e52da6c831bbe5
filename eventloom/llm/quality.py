"""Quality rules on documents and on the hosts they come from.

Each document is tested by two base rules. Their failures are summed by host, and a host's
rate is shrunk to the common one by a beta prior whose mean and weight are estimated from all
hosts, so that a host with a few documents is not condemned by chance. A host whose shrunk rate
is above ``max_host_rate`` takes all its documents with it.

Null and empty texts have no words and fail. Documents without a host count for no host and
are judged on their own. Repeated rows count as often as they occur. An empty table gives an
empty result. Other columns pass through untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm import words as W
from eventloom.llm.tables import extended, written

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_HOST_RATE = 0.5
# Weight of the prior, in documents, where hosts differ no more than by chance.
FULL_WEIGHT = 1e6

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = 1
_SOLID_CHAR = (~W._SPACE & ((np.arange(256) & 0xC0) != 0x80)).astype(np.int64)
_BLANK = " \t\n\v\f\r"


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(values)])[offsets])


def _repeat_words(grams: np.ndarray, n_words: int) -> int:
    """Words covered by the windows whose hash occurs twice or more."""
    if n_words < W.SHINGLE_WORDS + 1:
        return 0
    order = np.argsort(grams, kind="stable")
    ranked = grams[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(grams), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    change = np.zeros(n_words + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(change, at, 1)
    np.add.at(change, at + W.SHINGLE_WORDS, -1)
    return int((np.cumsum(change[:-1]) > 0).sum())


def _dup_lines(text: str) -> int:
    seen: set[str] = set()
    n = 0
    for line in text.split("\n"):
        if line in seen:
            n += 1
        elif line.strip(_BLANK):
            seen.add(line)
    return n


def count_rules(texts) -> list[np.ndarray]:
    """The columns ``COUNTS`` of an Arrow column of texts."""
    col = W.text_column(texts)
    out = []
    for first, last, data, offsets in W.chunks(col):
        start, end, bounds = W.find_words(data, offsets)
        n_words = np.diff(bounds)
        grams, at = W.shingle_hashes(W.word_hashes(data, start, end, lower=False), bounds)
        repeats = [_repeat_words(grams[at[i] : at[i + 1]], int(n)) for i, n in enumerate(n_words)]
        dups = [_dup_lines(t) for t in col.slice(first, last - first).to_pylist()]
        out.append([n_words, _sums(_SOLID_CHAR[data], offsets), _sums(_SYMBOL[data], offsets), dups, repeats])
    return [np.concatenate(c).astype(np.int64) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 5


def rule_counts(rows: DataFrame, text: str = "text") -> DataFrame:
    """A struct ``row`` with all columns of ``rows``, ``COUNTS`` and ``base_failed``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column(0)
            counts = count_rules(row.field(text) if not row.null_count else pa.compute.struct_field(row, text))
            yield pa.RecordBatch.from_arrays([row, *map(pa.array, counts)], names=["row", *COUNTS])

    packed = rows.select(F.struct("*").alias("row"))
    schema = extended(packed.schema, **dict.fromkeys(COUNTS, "long"))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return packed.mapInArrow(run, schema).withColumn("base_failed", failed)


def host_verdicts(counts: DataFrame, host: str = "row.source", max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """(host, host_docs, host_failed, host_rate, host_rejected) from the result of ``rule_counts``.

    The prior has the pooled rate as its mean. Its weight is found from the spread of the hosts'
    rates by the method of moments: the part of the spread that binomial chance does
    not explain. Only five sums reach the driver.
    """
    hosts = (
        counts.where(F.col(host).isNotNull())
        .groupBy(F.col(host).alias("host"))
        .agg(F.count(F.lit(1)).alias("host_docs"), F.sum(F.col("base_failed").cast("long")).alias("host_failed"))
    )
    hosts = written(hosts, "hosts")
    n, f = F.col("host_docs"), F.col("host_failed")
    k, docs, fails, squares, spread = hosts.agg(
        F.count(F.lit(1)), F.sum(n), F.sum(f), F.sum(n.cast("double") * n), F.sum(f.cast("double") * f / n)
    ).first()
    mean, weight = 0.0, FULL_WEIGHT
    if k and fails:
        mean = fails / docs
        chance = mean * (1 - mean)
        # Between hosts: sum of n (p - mean)^2 = spread - docs * mean^2, by chance (k - 1) * chance.
        share = docs - squares / docs
        between = (spread - docs * mean * mean - (k - 1) * chance) / share if share > 0 else 0.0
        if between > 0:
            weight = min(FULL_WEIGHT, max(chance / between - 1, 0.0))
    rate = (f + mean * weight) / (n + weight)
    return hosts.withColumn("host_rate", rate).withColumn("host_rejected", rate > max_host_rate)


def judged(rows: DataFrame, text: str = "text", host: str = "source", max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The result of ``rule_counts`` with the verdict on the host (``host_rejected``) and ``kept``.

    The counted rows are written once. The hosts are a table of known size, so that Spark itself
    broadcasts them if they are few and otherwise shuffles, splitting a host with many rows.
    """
    counts = written(rule_counts(rows, text), "rules")
    verdicts = host_verdicts(counts, f"row.{host}", max_host_rate).select("host", "host_rejected")
    joined = counts.join(verdicts, F.col(f"row.{host}") == F.col("host"), "left").drop("host")
    rejected = F.coalesce(F.col("host_rejected"), F.lit(False))
    return joined.withColumn("host_rejected", rejected).withColumn("kept", ~F.col("base_failed") & ~rejected)


def keep_good(rows: DataFrame, text: str = "text", host: str = "source", max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The rows that pass, with their own columns."""
    return judged(rows, text, host, max_host_rate).where("kept").select("row.*")
