"""Registered queries of the scans and models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from transferkit.llm.language import identify
from transferkit.llm.license import scan_licenses
from transferkit.llm.lm import score_documents
from transferkit.llm.queries_filters import documents
from transferkit.llm.toxicity import score_toxicity


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_language_id": op2_language_id,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_toxicity": op4_toxicity,
}
SQL: dict[str, str] = {}
