"""Session settings and the shared work folder."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def configure(spark: SparkSession) -> SparkSession:
    """Set what the operators rely on; everything else stays as the cluster has it.

    Event times are UTC, and ``transformWithState`` needs the RocksDB state store; its commits write changes
    only, which is also what the change feed of a state reads.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return spark


def local_session(cores: str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and benches on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("eventloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    return configure(builder.getOrCreate())


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="run-")


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach, for written tables and stream checkpoints.

    It lies below ``spark.checkpoint.dir``. Only a session whose driver and executors are one
    process may leave that unset, as tests do; elsewhere the setting is required.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = _local_folder()
    return f"{base.rstrip('/')}/eventloom/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the work folder, read again: a loop's plan stays short, and a lost
    executor costs no more than its tasks."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
