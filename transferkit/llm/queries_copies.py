"""Registered queries about copies and archives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from transferkit.llm.jaccard import jaccard_classes
from transferkit.llm.queries_filters import documents
from transferkit.llm.suffixes import repeated_passages
from transferkit.llm.warc import archived


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(documents(spark, sf_dir))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(documents(spark, sf_dir))


def op6_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(spark.read.parquet(f"{sf_dir}/pages.parquet"))


SQL6 = """
with p as (select page_id, coalesce(html, '') as html from pages),
g as (
  select *, strlen(html)::bigint as n, max(page_id) over (partition by html) as first from p)
select page_id, n as payload_bytes, sha1(html) as payload_digest,
  case when n >= 1000 and page_id <> first then 'revisit' else 'response' end as record_type,
  case when n >= 1000 and page_id <> first then first end as refers_to
from g
"""

QUERIES = {
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_warc_archives": op6_warc_archives,
    "op10_ngram_jaccard": op10_ngram_jaccard,
}
SQL = {"op6_warc_archives": SQL6}
