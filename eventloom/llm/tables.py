"""Tables written to the shared folder, which cut lineage and survive lost executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from eventloom.session import work_dir


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read again."""
    path = work_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def extended(schema: StructType, **columns: str) -> StructType:
    """``schema`` followed by more columns, given as name and DDL type."""
    return StructType([*schema.fields, *(StructField(n, DataType.fromDDL(t)) for n, t in columns.items())])


# Rows of at most 100 bytes that may be sent to every executor: about 100 MB at the most.
BROADCAST_ROWS = 1_000_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written narrow table, marked for broadcast if it has at most ``rows`` rows; else it is shuffled."""
    return F.broadcast(df) if df.count() <= rows else df
