"""URL filters by hashed host-suffix and path-prefix expressions.

A rule is a host, a path and a verdict. It fits its host and all subdomains, if the path of the url
starts with its own; the longest rule that fits decides, the longer host among equally long ones, and a block before
an allowance among equal ones.

Each distinct host and path is expanded into the expressions that rules could have: the suffixes of as many
labels as some rule's host has, with the prefixes that end at as many slashes, or hold as many characters, as
some rule's path does. Expressions meet the rules on the first four bytes of their SHA-256; those found are
confirmed on the whole digest. Very common expressions are counted before they meet the rules; the most common of
the confirmed rules, ``BROADCAST_ROWS`` at most, go back to the urls by broadcast, so no key that many urls
hold is shuffled.

A url that is null or has no ``://`` has an empty host and path. Hosts are compared with A-Z lower-cased, paths as they
are. Rules without a host or a known verdict fit nothing; a null path is an empty one. Repeated urls all get the
verdict of one; an empty table gives an empty result, and without rules the default decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.tables import BROADCAST_ROWS, written

PREFIX_BYTES = 4
VERDICTS = ("allow", "block")

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url)))


def url_host(url: Column) -> Column:
    """What stands between the first ``://`` and a slash, question mark or number sign."""
    return F.coalesce(lower_ascii(F.regexp_extract(_rest(url), r"^[^/?#]*", 0)), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to a question mark or number sign."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*(/[^?#]*)?", 1), F.lit(""))


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def _slashes(path: Column) -> Column:
    return F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))


def _digest(host: Column, path: Column) -> Column:
    return F.unhex(F.sha2(F.concat(host, F.lit("\n"), path), 256))


def _prefix(digest: Column) -> Column:
    return F.substring(digest, 1, PREFIX_BYTES)


def hashed_rules(rules: DataFrame, host: str = "host", path: str = "path", verdict: str = "verdict") -> DataFrame:
    """(prefix, digest, blocks, labels, to_slash, size): one row for each different host and path."""
    known = rules.where(F.col(host).isNotNull() & F.col(verdict).isin(*VERDICTS)).select(
        lower_ascii(F.col(host)).alias("host"), F.coalesce(path, F.lit("")).alias("path"), (F.col(verdict) == "block").alias("blocks")
    )
    different = known.groupBy("host", "path").agg(F.max("blocks").alias("blocks"))
    to_slash = F.col("path").endswith("/")
    size = F.when(to_slash, _slashes(F.col("path"))).otherwise(F.length("path"))
    digest = _digest(F.col("host"), F.col("path"))
    return different.select(
        _prefix(digest).alias("prefix"), digest.alias("digest"), "blocks", _labels(F.col("host")).alias("labels"), to_slash.alias("to_slash"), size.alias("size")
    )


def shapes(hashed: DataFrame) -> Column:
    """An array literal of the different (labels, to_slash, size) of the rules: at most as many as there are
    label counts times lengths of a path in the rules, whatever their number."""
    rows = hashed.select("labels", "to_slash", "size").distinct().orderBy("labels", "to_slash", "size").collect()
    listed = ", ".join(f"named_struct('labels', {r.labels}, 'to_slash', {str(r.to_slash).lower()}, 'size', {r.size})" for r in rows)
    return F.expr(f"array({listed})")


def expressions(places: DataFrame, shape: Column) -> DataFrame:
    """(host, path, suffix, start, prefix, digest) for each ``shape`` that a host and path have room for."""
    host, path = F.col("host"), F.col("path")

    def fits(s: Column) -> Column:
        room = F.when(s["to_slash"], F.col("_slashes")).otherwise(F.col("_chars"))
        return (s["labels"] <= F.col("_labels")) & (s["size"] <= room)

    counted = places.select("host", "path", _labels(host).alias("_labels"), _slashes(path).alias("_slashes"), F.length(path).alias("_chars"))
    each = counted.select("host", "path", F.explode(F.filter(shape, fits)).alias("s"))
    suffix = F.expr("substring_index(host, '.', -s.labels)")
    start = F.expr("CASE WHEN s.to_slash THEN concat(substring_index(path, '/', s.size), '/') ELSE left(path, s.size) END")
    made = each.select("host", "path", suffix.alias("suffix"), start.alias("start"))
    made = made.withColumn("digest", _digest(F.col("suffix"), F.col("start")))
    return made.withColumn("prefix", _prefix(F.col("digest")))


def confirmed_rules(made: DataFrame, hashed: DataFrame) -> DataFrame:
    """(digest, blocks, n): the rules that fit some of the expressions, with the number of those."""
    # Counted before the first shuffle, so a common expression is one row for each task.
    counted = made.groupBy("prefix", "digest").agg(F.count(F.lit(1)).alias("n"))
    rules = hashed.select("prefix", F.col("digest").alias("rule_digest"), "blocks")
    found = counted.join(rules, "prefix")
    return found.where(F.col("digest") == F.col("rule_digest")).select("digest", "blocks", "n")


def url_verdicts(
    urls: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", host: str = "host", path: str = "path", verdict: str = "verdict"
) -> DataFrame:
    """A struct ``row`` with all columns of ``urls``, and ``host``, ``path``, ``rule`` (host and path of the rule
    that decides, else null), ``verdict`` (allow or block)."""
    rows = urls.select(F.struct("*").alias("row"))
    rows = rows.select("row", url_host(F.col(f"row.`{url}`")).alias("host"), url_path(F.col(f"row.`{url}`")).alias("path"))
    hashed = written(hashed_rules(rules, host, path, verdict), "url-rules")
    # Equal urls are judged once.
    places = rows.select("host", "path").distinct()
    made = written(expressions(places, shapes(hashed)), "url-expressions") if hashed.limit(1).count() else None
    if made is None:
        return rows.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    confirmed = written(confirmed_rules(made, hashed), "url-confirmed")
    # Rows of 32 bytes and a flag. Beyond them a rule holds under 1 / BROADCAST_ROWS of the expressions.
    common = confirmed.orderBy(F.desc("n"), "digest").limit(BROADCAST_ROWS)
    hits = made.join(F.broadcast(common), "digest")
    if confirmed.count() > BROADCAST_ROWS:
        rest = confirmed.join(common.select("digest"), "digest", "left_anti")
        hits = hits.unionByName(made.join(rest.hint("shuffle_hash"), "digest"))
    rule = F.concat("suffix", "start")
    rank = F.struct(F.length(rule).alias("size"), F.length("suffix").alias("host_size"), "blocks", rule.alias("rule"))
    decided = hits.groupBy("host", "path").agg(F.max(rank).alias("best"))
    decided = decided.select("host", "path", F.col("best.rule").alias("rule"), F.when(F.col("best.blocks"), "block").otherwise("allow").alias("verdict"))
    joined = rows.join(decided, ["host", "path"], "left")
    return joined.select("row", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
