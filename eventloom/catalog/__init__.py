"""The queries of ``__spark_entry__``: every operator on the given tables, with its SQL check."""

from __future__ import annotations

import importlib

from eventloom.catalog.registry import QUERIES, SQL, Query

MODULES = ["sources", "records", "joins", "aggregates", "windows", "jobs", "streams"]


def load() -> tuple[dict[str, Query], dict[str, str]]:
    """All queries and their SQL, by name."""
    for name in MODULES:
        importlib.import_module(f"eventloom.catalog.{name}")
    return QUERIES, SQL
