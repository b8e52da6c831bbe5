"""Custom aggregates: adder and merger."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# States a task holds before it hands them on.
MAX_STATES = 100_000


def fold_by_key(
    df: DataFrame,
    key: str,
    add: Callable,
    merge: Callable,
    state: T.StructType,
    max_states: int = MAX_STATES,
) -> DataFrame:
    """Aggregate per key with user code, for what SQL aggregates cannot express.

    ``add`` turns a pandas frame of rows into a frame of states, one row per key with columns
    (key, state fields); ``merge`` does the same with a frame of states. Neither may depend on
    row order. As with a built-in aggregate each task folds its own rows first, so a hot key
    is shuffled as about one state per task. States are then sorted by key within their
    partitions and merged batch by batch, at most ``max_states`` in memory.
    """
    import pandas as pd

    schema = T.StructType([df.schema[key], *state.fields])
    columns = schema.names

    def fold(batches: Iterator) -> Iterator:
        held = None
        for rows in batches:
            states = add(rows)[columns]
            held = states if held is None else merge(pd.concat([held, states]))[columns]
            if len(held) >= max_states:
                yield held
                held = None
        if held is not None:
            yield held

    def join(batches: Iterator) -> Iterator:
        held = None
        for states in batches:
            held = merge(states if held is None else pd.concat([held, states]))[columns]
            last = held[key].max()
            yield held[held[key] != last]
            held = held[held[key] == last]
        if held is not None:
            yield held

    partial = df.where(F.col(key).isNotNull()).mapInPandas(fold, schema)
    return partial.repartition(key).sortWithinPartitions(key).mapInPandas(join, schema)
