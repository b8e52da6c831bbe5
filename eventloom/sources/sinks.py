"""Writing feeds: topic-shaped rows, finite stream runs, and keyed tables kept by a stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from eventloom.functions.codecs import encode_json
from eventloom.operators.changelog import latest_by_key


def topic_rows(df: DataFrame, key: Column | str, values: Sequence[str] | None = None) -> DataFrame:
    """(key, value) rows as the Kafka sink takes them: text key, JSON value."""
    key = F.col(key) if isinstance(key, str) else key
    return df.select(
        key.cast("string").alias("key"), encode_json(*(values or df.columns)).alias("value")
    )


def write_files(
    stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", every: str | None = None
) -> StreamingQuery:
    """Append a stream to files, exactly once: what is available, or ``every`` so often until
    stopped.

    State machines on the wall clock need ``every``, as their timers never run out of work.
    """
    return (
        stream.writeStream.outputMode("append")
        .format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .start()
    )


def _trigger(every: str | None) -> dict[str, str | bool]:
    return {"processingTime": every} if every else {"availableNow": True}


def write_kafka(
    stream: DataFrame,
    servers: str,
    topic: str,
    checkpoint: str,
    mode: str = "append",
    every: str | None = None,
) -> StreamingQuery:
    """Send (key, value) rows to a topic: what is available, or ``every`` so often until stopped;
    needs Spark's Kafka connector. An aggregate sends its changed rows with ``mode`` update."""
    return (
        stream.writeStream.outputMode(mode)
        .trigger(**_trigger(every))
        .format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def for_each_batch(
    stream: DataFrame,
    action: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    every: str | None = None,
) -> StreamingQuery:
    """Run ``action(rows, batch_id)`` on every micro-batch: of what is available, or ``every`` so
    often until stopped."""
    return (
        stream.writeStream.outputMode(mode)
        .foreachBatch(action)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .start()
    )


def split_sink(children: dict[str, Column], root: str) -> Callable[[DataFrame, int], None]:
    """Batch action that sends rows to child tables by condition, in one write.

    A row goes to every child whose condition holds. Each batch has its own folder,
    overwritten when the batch is repeated after a failure, so a retry leaves no row twice.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        names = F.array(*[F.when(cond, F.lit(name)) for name, cond in children.items()])
        sent = rows.withColumn("child", F.explode(F.array_compact(names)))
        sent.write.mode("overwrite").partitionBy("child").parquet(f"{root}/batch={batch_id}")

    return write


def read_child(spark: SparkSession, root: str, child: str, schema: T.StructType) -> DataFrame:
    """Rows of one child table; the others' files are not read."""
    partitions = [T.StructField("batch", T.LongType()), T.StructField("child", T.StringType())]
    rows = spark.read.schema(T.StructType(schema.fields + partitions)).parquet(root)
    return rows.where(F.col("child") == child).drop("batch", "child")


def log_changes(root: str) -> Callable[[DataFrame, int], None]:
    """Batch action that appends the changes of a batch to a keyed table's change log."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{root}/batch={batch_id}")

    return write


def read_log(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    keys: Sequence[str],
    order: Sequence[str],
    batches: range | None = None,
) -> DataFrame:
    """The keyed table behind a change log: the latest row per key, deletes included.

    The latest is the last by ``order``, in whichever batch it came; without an order, and among
    equals, that of the last batch. Reading merges the log; a stream never rewrites rows it has
    already written. With ``batches`` only those of the log are read.
    """
    with_batch = T.StructType(schema.fields + [T.StructField("batch", T.LongType())])
    log = spark.read.schema(with_batch).parquet(root)
    if batches is not None:
        log = log.where((F.col("batch") >= batches.start) & (F.col("batch") < batches.stop))
    return latest_by_key(log, keys, [*order, "batch"]).drop("batch")


def compact_log(
    spark: SparkSession,
    root: str,
    target: str,
    schema: T.StructType,
    keys: Sequence[str],
    order: Sequence[str],
) -> None:
    """Write the merged table as one batch of a new log at ``target``."""
    read_log(spark, root, schema, keys, order).write.mode("overwrite").parquet(f"{target}/batch=-1")
