"""The training-data pipeline over ``documents``: rules, near copies, contamination, secrets, mixing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.llm import contamination, mixing, rules, secrets, simhash
from tagweave.session import tune


def _sized(changed: DataFrame, docs: DataFrame) -> DataFrame:
    return changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that line-first cleaning keeps, without their failing and repeated lines; ``n_chars`` follows the text."""
    return _sized(rules.clean(docs), docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return contamination.contaminated(docs, benchmark).where(~F.col("contaminated")).select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked; ``n_chars`` follows the text."""
    return _sized(secrets.masked(docs), docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with the words taken and their places in the output shards."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_copies),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("mixing to target weights", mixture),
]

# Fingerprints need 64-bit xxHash and groups a fixed point over them, which DuckDB's SQL cannot state.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, one after the other."""
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
