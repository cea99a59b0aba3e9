"""A corpus from raw documents to packed sequences: quality rules, exact and near duplicates, repeated passages, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrine.llm import exact, packing, quality, simhash, suffix
from papyrine.llm.common import store


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return quality.keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the smallest id."""
    return exact.deduplicate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates, the one with the smallest id."""
    return simhash.deduplicate(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of passages cut out of the texts; ``n_chars`` follows the text where the table has it."""
    cut = suffix.remove_repeats(docs)
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("passage_dedup", passage_dedup),
    ("packing", pack),
]

#: Fingerprints and passages have no SQL; tests/llm compares every stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and reread as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
