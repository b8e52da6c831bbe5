"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from eventloom.catalog import load
from eventloom.operators import running
from eventloom.plans import reassembly
from oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
SQL = load()[1]
QUERIES = {name: query for name, query in entry.queries().items() if name in load()[0]}
# Queries that run a stream.
STREAMED = [
    "lookup_state_store",
    "lookup_state_store_map",
    "sink_foreach",
    "sink_processor",
    "sink_topic",
    "src_earliest",
    "state_changes",
    "state_read",
    "state_timers",
    "stateful_processor",
    "timers",
]


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, SQL[name]) == []


# Streams with keyed state do not split keys, those with tables in its place do.
TABLED = ["count_updates_stream", "join_stream_table_split_stream"]
SPLIT = sorted(
    name
    for name in QUERIES
    if name in TABLED or not name.endswith("_stream") and name not in STREAMED
)


@pytest.mark.parametrize("name", SPLIT)
def test_query_with_all_keys_hot(spark, con, monkeypatch, name):
    """The same with every repeated key taken for a hot one and every group for a large one."""
    monkeypatch.setattr(running, "HOT_ROWS", 2)
    monkeypatch.setattr(running, "HOT_KEYS", 40)
    monkeypatch.setattr(reassembly, "LARGE_PARTS", 1)
    monkeypatch.setattr(reassembly, "HOT_KEYS", 5)
    assert compare(QUERIES[name](spark, SF_DIR), con, SQL[name]) == []


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
