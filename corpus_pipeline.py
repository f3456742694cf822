"""A training corpus from raw documents: quality rules, near-copies, repeated passages, benchmark leaks, mixing.

Every stage works on what the one before kept; each result is written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transferkit.llm.decontaminate import decontaminate
from transferkit.llm.jaccard import drop_near_copies
from transferkit.llm.mixing import mix
from transferkit.llm.quality import keep_good
from transferkit.llm.suffixes import remove_repeated
from transferkit.llm.tables import where_computed
from transferkit.session import workspace


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a rule go."""
    return keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of copies and near-copies the document with the smallest id stays."""
    return drop_near_copies(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that repeat are cut from the texts; documents of which nothing is left go."""
    kept = where_computed(remove_repeated(docs), F.col("text") != "")
    if "n_chars" in docs.columns:
        chars = F.length("text").cast("long")
        kept = kept.select(*[chars.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])
    return kept


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix draws them, with their shard and place in it."""
    return mix(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("source_mix", source_mix),
]
# Near-copies are found by sampled paths and shards dealt by a hash that SQL engines do not share.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = workspace(spark, f"pipeline_{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
