"""From raw documents to packed training sequences, stage by stage.

Each stage is written as Parquet and read again as the documents of the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.decontamination import find_passages
from eventloom.llm.lines import drop_lines
from eventloom.llm.minhash import near_duplicates
from eventloom.llm.packing import pack_documents
from eventloom.llm.quality import keep_good
from eventloom.llm.queries import public_tokenizer
from eventloom.llm.tables import small, written

# The last stage depends on a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and whose host does."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier one holds; ``n_chars`` follows the text."""
    kept = drop_lines(docs)
    changed = F.col("n_dropped") > 0
    text = F.when(changed, F.col("kept_text")).otherwise(F.col("row.text"))
    chars = F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("row.n_chars"))
    row = F.col("row").withField("text", text).withField("n_chars", chars)
    return kept.select(row.alias("row")).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates, once; those without an id stay.

    Of rows with one id that stays the first by hash of the text, then by the text, then by a hash of all columns."""
    repeated = near_duplicates(docs).where(~F.col("kept")).select("doc_id").distinct()
    kept = docs.join(small(written(repeated, "repeated")), "doc_id", "left_anti")
    twice = kept.groupBy("doc_id").count().where("doc_id IS NOT NULL AND count > 1").select("doc_id")
    twice = small(written(twice, "twice"))
    rows = kept.join(twice, "doc_id", "left_semi").select("doc_id", F.struct(*docs.columns).alias("row"))
    order = F.struct(F.xxhash64("row.text"), "row.text", F.xxhash64("row"))
    once = rows.groupBy("doc_id").agg(F.min_by("row", order).alias("row")).select("row.*")
    return kept.join(twice, "doc_id", "left_anti").select(docs.columns).unionByName(once)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_passages(docs, items).where(F.size("hits") == 0).select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in sequences of 1,024."""
    return pack_documents(docs, *public_tokenizer())


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
