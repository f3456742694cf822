"""Staged and load files back to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transferkit.functions.load import NUL
from transferkit.operators.project import from_canonical
from transferkit.session import few_listing_tasks, larger_than_a_split
from transferkit.sources.records import records
from transferkit.types import META, TEXT, ColumnInfo, column

# RFC 4180: quotes are doubled, fields may span lines, blanks count, "" is an empty text.
CSV_READ = {
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "mode": "FAILFAST",
}


def text_schema(columns: list[ColumnInfo]) -> T.StructType:
    return T.StructType(
        [T.StructField(c.name, T.StringType(), True, {META: c.metadata()}) for c in columns]
    )


def read_staged(
    spark: SparkSession,
    path: str,
    columns: list[ColumnInfo],
    null: str = "{nll}",
    typed: bool = False,
    split: bool | None = None,
) -> DataFrame:
    """Rows of a staged CSV folder, as canonical text with true NULLs, or as typed values.

    Fields may span lines, so Spark's own reader takes a file for one task.  ``split`` reads a file by many tasks, at the
    price of a pass over the text that finds where records begin; by default where a file is larger than
    ``spark.sql.files.maxPartitionBytes``.
    """
    options = {**CSV_READ, "nullValue": null}
    if larger_than_a_split(spark, path) if split is None else split:
        fields = ", ".join(f"c{n} string" for n in range(len(columns)))
        parsed = records(spark, path).select(F.from_csv("value", fields, options).alias("r"))
        df = parsed.select(*[F.col("r")[f"c{n}"].alias(c.name) for n, c in enumerate(columns)])
    else:
        reader = spark.read.schema(text_schema(columns)).options(**options, recursiveFileLookup="true")
        with few_listing_tasks(spark):
            df = reader.csv(path)
    # the reader drops column metadata; the order of columns is the contract
    return from_canonical(df, columns, null=None) if typed else _described(df, columns)


def read_keys(
    spark: SparkSession, path: str, columns: list[ColumnInfo], null: str = "{nll}", typed: bool = True
) -> DataFrame:
    """Rows of a staged key folder: the primary-key columns of ``columns``."""
    return read_staged(spark, path, [c for c in columns if c.primary_key], null, typed)


def read_load(
    spark: SparkSession,
    path: str,
    target: str,
    columns: list[ColumnInfo],
    null: str = "{nll}",
    delimiter: str = "{dlm}",
    newline: str = "{nwln}",
) -> DataFrame:
    """Load files of ``target`` back to typed rows, as its bulk loader would read them."""
    if target != "mssql":
        return read_staged(spark, path, columns, null, typed=True)
    with few_listing_tasks(spark):
        lines = spark.read.option("lineSep", newline).option("recursiveFileLookup", "true").text(path)
    parts = F.split(F.col("value"), _literal_pattern(delimiter), -1)
    fields = lines.select(*[parts[i].alias(c.name) for i, c in enumerate(columns)])
    out = []
    for c in columns:
        text = F.when(column(c.name) != "", column(c.name))
        if c.type in TEXT:
            text = F.when(text == F.lit(NUL), F.lit("")).otherwise(text)
        out.append(text.alias(c.name))
    return from_canonical(fields.select(*out), columns, null=None)


def _literal_pattern(text: str) -> str:
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def _described(df: DataFrame, columns: list[ColumnInfo]) -> DataFrame:
    return df.select(*[column(c.name).alias(c.name, metadata={META: c.metadata()}) for c in columns])
