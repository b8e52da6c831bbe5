"""Repeated lines across documents, found against sorted runs of the lines seen before.

Documents come in batches in ascending order of their keys. The seen lines are kept as runs: tables of
128-bit line hashes, bucketed by the hash and sorted within the bucket. A batch
anti-joins every run by merging, drops the lines it finds there, keeps a line that is new only
in its smallest document, and adds the new hashes as a run of the first level. As many runs of a level
as ``fan_in`` are merged into one of the next, so a batch meets few runs.

A line's key is the line without white space (space, tab to carriage return) at its ends and with
A-Z lower-cased. Keys of fewer than ``min_chars`` code points are never dropped. A null or
empty text is one empty line. A line repeated within its own document stays. Rows with equal keys are one document;
rows without a key pass unchanged and count for no line. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.tables import written
from eventloom.session import work_dir

MIN_CHARS = 10
FAN_IN = 3
BATCHES = 4

_BLANK = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_HASH = ["line_a", "line_b"]
# Rows of three numbers that are broadcast: a few megabytes.
COMMON = 100_000
# Makes Spark rely on the order of a bucket that is one file.
_FILE_ORDER = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def line_key(line: Column) -> Column:
    """The line as it is compared."""
    bare = F.btrim(line, F.lit(_BLANK))
    ascii_only = F.octet_length(bare) == F.length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _UPPER.lower()))


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(key, version, pos, line_a, line_b) of the lines long enough; ``version`` tells texts of one key apart."""
    lines = docs.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(
        F.col(key).alias("key"), F.xxhash64(text).alias("version"), F.posexplode(split_lines(F.col(text))).alias("pos", "line")
    )
    keyed = lines.select("key", "version", "pos", line_key(F.col("line")).alias("line"))
    return keyed.where(F.length("line") >= min_chars).select(
        "key", "version", "pos", F.xxhash64("line").alias("line_a"), F.xxhash64(F.lit(1), "line").alias("line_b")
    )


class LineRuns:
    """The lines seen so far, by level."""

    def __init__(self, spark: SparkSession, fan_in: int = FAN_IN):
        self.spark = spark
        self.fan_in = fan_in
        # As many as a shuffle has partitions, so that a batch is dealt out as the runs are.
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def _write(self, rows: DataFrame) -> str:
        """``rows``, dealt out by their hashes, as a table of one sorted file for each bucket."""
        name = f"line_run_{uuid.uuid4().hex}"
        path = work_dir(self.spark, "run")
        rows.write.option("path", path).bucketBy(self.buckets, *_HASH).sortBy(*_HASH).saveAsTable(name)
        return name

    def merged(self, one: str, other: str) -> DataFrame:
        """The rows of two runs, which have none in common, merged bucket by bucket."""
        a, b = self.spark.table(one).alias("a"), self.spark.table(other).alias("b")
        same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in _HASH]
        both = a.join(b.hint("merge"), same, "full_outer")
        return both.select(*[F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in _HASH])

    def _push(self, rows: DataFrame, level: int = 0) -> None:
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(self._write(rows))
        if len(self.levels[level]) == self.fan_in:
            full, self.levels[level] = self.levels[level], []
            while len(full) > 2:
                one, other = full.pop(), full.pop()
                full.append(self._write(self.merged(one, other)))
                self._drop(one, other)
            self._push(self.merged(*full) if len(full) == 2 else self.spark.table(*full), level + 1)
            self._drop(*full)

    def add(self, lines: DataFrame) -> DataFrame:
        """(key, version, pos) of the lines to drop from this batch, whose lines join the runs.

        The batch's different lines are dealt out once, like a run. Joins with the runs then need no
        exchange, and no sort, as each bucket is one sorted file."""
        trusted = self.spark.conf.get(_FILE_ORDER)
        self.spark.conf.set(_FILE_ORDER, "true")
        try:
            return self._add(lines)
        finally:
            self.spark.conf.set(_FILE_ORDER, trusted)

    def _add(self, lines: DataFrame) -> DataFrame:
        counts = [F.min("key").alias("owner"), F.max("key").alias("last"), F.count(F.lit(1)).alias("n")]
        batch = self._write(lines.groupBy(*_HASH).agg(*counts).repartition(self.buckets, *_HASH))
        seen = self.spark.table(batch)
        fresh = self.unseen(seen)
        known = [seen.join(run.hint("merge"), _HASH, "left_semi").select(*_HASH, "n", F.lit(None).alias("owner")) for run in self.runs()]
        shared = fresh.where(F.col("owner") < F.col("last")).select(*_HASH, "n", "owner")
        marked = written(reduce(DataFrame.unionByName, [shared, *known]), "marked")
        # The most frequent of the repeated lines, which are sent to all; each other one holds under 1 / COMMON of the lines.
        common = marked.orderBy(F.desc("n"), *_HASH).limit(COMMON).select(*_HASH, "owner")
        rare = marked.select(*_HASH, "owner").join(F.broadcast(common.select(*_HASH)), _HASH, "left_anti")
        repeated = lines.join(F.broadcast(common), _HASH)
        if marked.count() > COMMON:
            rest = lines.join(F.broadcast(common.select(*_HASH)), _HASH, "left_anti")
            repeated = repeated.unionByName(rest.join(rare, _HASH))
        drops = repeated.where(F.col("owner").isNull() | (F.col("key") > F.col("owner")))
        drops = written(drops.select("key", "version", "pos"), "line-drops")
        self._push(fresh.select(*_HASH))
        self._drop(batch)
        return drops

    def unseen(self, lines: DataFrame) -> DataFrame:
        """Rows of a table dealt out like the runs that are in none of them."""
        for run in self.runs():
            lines = lines.join(run.hint("merge"), _HASH, "left_anti")
        return lines

    def _drop(self, *names: str) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE {name}")

    def close(self) -> None:
        self._drop(*(name for level in self.levels for name in level))
        self.levels = []


def ranges(docs: DataFrame, key: str, batches: int) -> list[Column]:
    """Conditions that cut a numeric key into about equal batches, in ascending order."""
    shares = [i / batches for i in range(1, batches)]
    cuts = docs.agg(F.percentile_approx(key, shares).alias("cuts")).first()["cuts"] if shares else []
    cuts = sorted(set(cuts or []))
    at = F.col(key)
    edges = [None, *cuts, None]
    return [
        reduce(Column.__and__, [c for c in (at > low if low is not None else None, at <= high if high is not None else None) if c is not None], at.isNotNull())
        for low, high in zip(edges, edges[1:])
    ]


def drop_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, batches: int = BATCHES, fan_in: int = FAN_IN
) -> DataFrame:
    """(all columns as struct ``row``, ``kept_text``, ``n_lines``, ``n_dropped``)."""
    hashed = written(line_hashes(docs, key, text, min_chars), "lines")
    runs = LineRuns(docs.sparkSession, fan_in)
    drops = [runs.add(hashed.where(batch)) for batch in ranges(hashed, "key", batches)]
    runs.close()
    return without_lines(docs, drops, key, text)


def without_lines(docs: DataFrame, drops: Sequence[DataFrame], key: str, text: str) -> DataFrame:
    by_doc = reduce(DataFrame.unionByName, drops).groupBy("key", "version").agg(F.collect_set("pos").alias("drop_pos"))
    rows = docs.select(F.struct("*").alias("row"))
    body = F.col(f"row.{text}")
    joined = rows.join(by_doc, (F.col(f"row.{key}") == F.col("key")) & (F.xxhash64(body) == F.col("version")), "left")
    lines = split_lines(body)
    everything = F.sequence(F.lit(0), F.size(lines) - 1)
    left = F.array_except(everything, F.col("drop_pos"))
    kept = F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")
    return joined.select(
        "row",
        F.when(F.col("drop_pos").isNull(), F.coalesce(body, F.lit(""))).otherwise(kept).alias("kept_text"),
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("drop_pos"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def add_batches(spark: SparkSession, batches: Iterable[DataFrame], key: str = "doc_id", text: str = "text", fan_in: int = FAN_IN) -> list[DataFrame]:
    """``without_lines`` for each of several frames that arrive one after the other in order of their keys."""
    runs = LineRuns(spark, fan_in)
    out = []
    for docs in batches:
        drops = runs.add(written(line_hashes(docs, key, text), "lines"))
        out.append(without_lines(docs, [drops], key, text))
    runs.close()
    return out
