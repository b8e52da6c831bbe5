"""Reading feeds: Kafka topics, and files laid out like them.

Every operator takes the same columns whether they come from a table or a stream, so a feed
is a DataFrame of topic records (``schemas.TOPIC_RECORD``) that one ``select`` decodes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.functions.codecs import decode_json


def kafka_options(
    servers: str,
    topics: str | None = None,
    pattern: str | None = None,
    headers: bool = False,
    max_records_per_batch: int | None = None,
    **extra: str,
) -> dict[str, str]:
    """Options of a Kafka source: by list or by regular expression, from the earliest offset."""
    if (topics is None) == (pattern is None):
        raise ValueError("give either topics or a pattern")
    options = {
        "kafka.bootstrap.servers": servers,
        "startingOffsets": "earliest",
        "includeHeaders": str(headers).lower(),
        **extra,
    }
    options["subscribe" if topics else "subscribePattern"] = topics or pattern
    if max_records_per_batch:
        options["maxOffsetsPerTrigger"] = str(max_records_per_batch)
    return options


def kafka_feed(spark: SparkSession, streaming: bool = True, **options) -> DataFrame:
    """Topic records of a Kafka feed; needs Spark's Kafka connector on the class path."""
    reader = spark.readStream if streaming else spark.read
    return reader.format("kafka").options(**kafka_options(**options)).load()


def exact_glob(path: str) -> str:
    """``path`` as a glob that matches only itself; file streams take globs for single files."""
    return f"{path[:-1]}[{path[-1]}]"


def file_feed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    streaming: bool = False,
    max_files_per_batch: int | None = None,
) -> DataFrame:
    """A feed kept as files; on a stream every file present at the start is read (earliest)."""
    if not streaming:
        return spark.read.schema(schema).format(fmt).load(path)
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.load(exact_glob(path))


def file_feeds_by_pattern(
    spark: SparkSession, glob: str, pattern: str, schema: T.StructType, fmt: str = "parquet"
) -> DataFrame:
    """All files below ``glob`` whose path matches a regular expression, with that path."""
    files = spark.read.schema(schema).format(fmt).load(glob)
    return files.withColumn("feed", F.col("_metadata.file_path")).where(F.col("feed").rlike(pattern))


def feeds_by_pattern(records: DataFrame, pattern: str) -> DataFrame:
    """Records of the topics whose whole name matches ``pattern``."""
    return records.where(F.col("topic").rlike(f"^(?:{pattern})$"))


def json_feed(records: DataFrame, schema: T.StructType, *keep: str | Column) -> DataFrame:
    """Text key and decoded JSON fields of topic records, plus the ``keep`` columns."""
    decoded = records.select(
        F.col("key").cast("string").alias("_key"),
        decode_json(F.col("value").cast("string"), schema).alias("_value"),
        *keep,
    )
    kept = [c for c in decoded.columns if c not in ("_key", "_value")]
    fields = [f.name for f in schema.fields]
    return decoded.select(
        F.col("_key").alias("record_key"), *[F.col(f"_value.`{f}`").alias(f) for f in fields], *kept
    )


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file is there, in whatever store Spark reads it from."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def write_in_stages(rows: DataFrame, order: str, stages: int, path: str) -> None:
    """A finite feed as one file for each of ``stages`` equal stretches of the whole number ``order``, written one
    after the other: a stream of one file per micro-batch takes them in that order."""
    last = rows.agg(F.max(order)).first()[0] or 0
    for stage in range(stages):
        own = F.expr(f"`{order}` * {stages} div {last + 1} = {stage}")
        rows.where(own).coalesce(1).write.mode("append").parquet(path)
