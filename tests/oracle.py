"""Compare a query with its SQL in DuckDB: columns, types by family, and the multiset of rows."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, bytearray):
        return bytes(value)
    return value


# Spark type -> DuckDB types that hold the same values.
_SAME = {
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "smallint": {"SMALLINT"},
    "double": {"DOUBLE"},
    "string": {"VARCHAR"},
    "boolean": {"BOOLEAN"},
}


def compare(spark_df, con, sql: str) -> list[str]:
    """Differences, empty if there are none."""
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    rows = rel.fetchall()
    types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    problems = []
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} <> {sorted(names)}"]
    for name, kind in spark_df.dtypes:
        if types[name] not in _SAME.get(kind, {kind}):
            problems.append(f"type of {name}: {kind} <> {types[name]}")
    order = sorted(names)
    at = [names.index(n) for n in order]
    want = Counter(tuple(_plain(r[i]) for i in at) for r in rows)
    got = Counter(tuple(_plain(v) for v in r) for r in spark_df.select(*[f"`{n}`" for n in order]).collect())
    if got != want:
        problems.append(f"{sum(got.values())} rows <> {sum(want.values())}")
        problems += [f"only Spark: {r} x{n}" for r, n in list((got - want).items())[:3]]
        problems += [f"only SQL: {r} x{n}" for r, n in list((want - got).items())[:3]]
    if not want:
        problems.append("no rows")
    return problems
