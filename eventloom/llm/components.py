"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.tables import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node with a link to another.

    Alternates two steps on the set of links until it no longer changes: each node hands its greater
    neighbours, then its smaller ones, to the smallest. The number of rounds grows with the
    logarithm of the longest path. Rows only meet at a node's smallest neighbour, found by an aggregate
    beforehand, so a node with very many links is never gathered. Each round is written.
    """
    u, v = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    edges = written(links.select(u, v).where(F.col("u") != F.col("v")).distinct(), "links")
    state = _state(edges)
    while True:
        both = edges.unionAll(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        other = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
        edges = written(large.join(least, "u").select(other.alias("u"), F.col("m").alias("v")).distinct(), "links")
        before, state = state, _state(edges)
        if state == before:
            roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)


def _state(edges: DataFrame) -> tuple:
    mark = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(mark), F.sum(F.shiftright(mark, 24))).first())
