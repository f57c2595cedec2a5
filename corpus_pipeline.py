"""A corpus from raw documents to packed sequences: quality, lines, near-duplicates, mix, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import line_dedup, mixing, packing, quality, simhash
from millrace.llm.common import written
from millrace.plans.registry import query


def _recounted(docs: DataFrame) -> DataFrame:
    """Documents whose texts changed, with their number of characters."""
    return docs.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs)


def line_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(line_dedup.remove(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(mixing.mix(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.digest(docs)


STAGES = [
    ("quality", quality_rules),
    ("line_dedup", line_duplicates),
    ("simhash", near_duplicates),
    ("mixing", source_mix),
    ("packing", packed),
]

# Tokens, signatures and pseudorandom draws are not SQL's.
ORACLE_SQL = None


@query("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs)
    return docs
