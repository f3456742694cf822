"""JDBC reads and the catalog queries of the five systems."""

from __future__ import annotations

import math
from dataclasses import replace
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transferkit.functions.identifiers import string_literal
from transferkit.sources import splits
from transferkit.sources.endpoint import Endpoint, Partitioning
from transferkit.sources.metadata import positional
from transferkit.types import ColumnInfo, apply_infos


def query_options(source: Endpoint, query: str, partition: Partitioning | None = None) -> dict[str, str]:
    text = query.strip().rstrip(";")
    if partition is None:
        return {**source.read_options(), "query": text}
    # a partitioned read needs a table, so the query becomes a derived one
    return {**source.read_options(), "dbtable": f"({text}) q", **partition.options()}


def table_options(source: Endpoint, table: str, partition: Partitioning | None = None) -> dict[str, str]:
    opts = {**source.read_options(), "dbtable": table}
    return {**opts, **partition.options()} if partition else opts


def custom_schema(columns: list[ColumnInfo]) -> dict[str, str]:
    """Read as text what Spark's own choice would cut: numbers without a size or wider than 38 digits,
    and times of day."""
    text = [c for c in columns if c.type == "time" or c.type == "decimal" and c.spark_type() == T.StringType()]
    if not text:
        return {}
    return {"customSchema": ", ".join(f"`{c.name.replace('`', '``')}` STRING" for c in text)}


def query_plan(
    source: Endpoint, query: str, labels: list[str], infos: list[ColumnInfo], partition: Partitioning | None = None
) -> dict[str, str]:
    """Options that read a query's result by position.

    The query is left as it is unless Spark could not name its columns apart; then it becomes a derived table with
    names of its own, and a partition's column is found by its label.
    """
    apart = [i.name for i in infos] == labels
    if not apart:
        names = [f"c{n}" for n in range(len(infos))]
        if partition:
            places = [n for n, label in enumerate(labels) if label.lower() == partition.column.lower()]
            if not places:
                raise ValueError(f"the query has no column {partition.column}")
            partition = replace(partition, column=names[places[0]])
        infos = [replace(i, name=n) for i, n in zip(infos, names)]
        table = positional(source.system, query.strip().rstrip(";"), names)
        options = {**source.read_options(), "dbtable": table, **(partition.options() if partition else {})}
    else:
        options = query_options(source, query, partition)
    return {**options, **custom_schema(infos)}


def load_query(
    spark: SparkSession,
    source: Endpoint,
    query: str,
    labels: list[str],
    infos: list[ColumnInfo],
    partition: Partitioning | None = None,
) -> DataFrame:
    return apply_infos(load(spark, query_plan(source, query, labels, infos, partition)), infos)


def load(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def load_by_predicates(
    spark: SparkSession, source: Endpoint, table: str, predicates: list[str], infos: list[ColumnInfo] | None = None
) -> DataFrame:
    """One query, and one task, for each condition."""
    properties = {**source.read_options(), **custom_schema(infos or [])}
    url = properties.pop("url")
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties)


def split_predicates(
    spark: SparkSession, source: Endpoint, table: str, names: list[str], keys: list[ColumnInfo], partitions: int
) -> list[str]:
    """Conditions for parts of about equal size: two queries, which return a count and a key per part.

    A key that may be NULL, as any that is not the table's primary key, gets a part for its NULLs.
    """
    rows = int(load(spark, query_options(source, f"select count(*) as n from {table}")).first()[0])
    fraction = min(1.0, splits.SAMPLED_PER_PART * partitions / max(rows, 1))
    query = splits.cuts_query(source.system, table, names, keys, partitions, fraction)
    cuts = load(spark, {**query_options(source, query), **custom_schema(keys)})
    cuts = apply_infos(cuts, [*keys, ColumnInfo("tk_row", "int64")])
    literals = splits.cut_literals(cuts, source.system, names)
    return splits.range_predicates(names, literals, not all(k.primary_key for k in keys))


def bounds(spark: SparkSession, source: Endpoint, table: str, key: str, partitions: int) -> Partitioning:
    """Range partitioning between the smallest and largest key, asked of the database."""
    row = load(spark, query_options(source, f"select min({key}) lo, max({key}) hi from {table}")).first()
    return whole_bounds(key, row[0], row[1], partitions)


def whole_bounds(key: str, lo, hi, partitions: int) -> Partitioning:
    """Bounds as Spark takes them: whole numbers around a key's ends, or dates and times as they are.

    Bounds only place the cuts: rows outside them, and NULLs, are in the outer ranges.
    """
    if lo is None or hi is None:
        return Partitioning(key, 0, 1, partitions)
    if isinstance(lo, (Decimal, float, int)):
        lo, hi = math.floor(lo), math.ceil(hi)
        # a range of bigints; a wider key's cuts stay inside it
        lo, hi = max(lo, -(2**63)), min(max(hi, lo + 1), 2**63 - 1)
    return Partitioning(key, lo, hi, partitions)


def largest(spark: SparkSession, source: Endpoint, table: str, name: str) -> DataFrame:
    """One row: the largest value of a column, asked of the database; NULL for an empty table."""
    return load(spark, query_options(source, f"select max({name}) as m from {table}"))


_SIZES = "numeric_precision as col_precision, numeric_scale as col_scale, character_maximum_length as col_length"
_ORDER = "ordinal_position as col_ordinal"


def _in(expr: str, names: list[str] | None, upper: bool = False) -> str:
    if not names:
        return ""
    listed = ", ".join(string_literal(n.upper() if upper else n) for n in names)
    return f" and {expr} in ({listed})"


def columns_query(system: str, schema: str | None, tables: list[str] | None = None) -> str:
    """One row per column of the schema's tables.  Names are passed as string literals."""
    if system == "oracle":
        where = f"owner = {string_literal((schema or '').upper())}" + _in("table_name", tables, True)
        return (
            "select owner as table_schema, table_name, column_name, column_id as col_ordinal, data_type, "
            "data_precision as col_precision, data_scale as col_scale, data_length as col_length "
            f"from all_tab_columns where {where}"
        )
    if system == "snowflake":
        where = f"upper(table_schema) = {string_literal((schema or '').upper())}"
        where += _in("upper(table_name)", tables, True)
    elif system == "mysql":
        where = f"table_schema = {string_literal(schema) if schema else 'database()'}"
        where += _in("table_name", tables)
    else:
        where = f"table_schema = {string_literal(schema or '')}" + _in("table_name", tables)
    data_type = "data_type"
    if system == "mysql":  # the plain type name hides the sign
        data_type = (
            "case when column_type like '%unsigned%' then concat('unsigned ', data_type) "
            "else data_type end as data_type"
        )
    return (
        f"select table_schema, table_name, column_name, {_ORDER}, {data_type}, {_SIZES} "
        f"from information_schema.columns where {where}"
    )


def keys_query(system: str, schema: str | None, tables: list[str] | None = None) -> str | None:
    """One row per primary-key column; None where the system keeps no enforced keys."""
    if system == "snowflake":
        return None
    if system == "oracle":
        where = f"c.owner = {string_literal((schema or '').upper())}" + _in("c.table_name", tables, True)
        return (
            "select k.owner as table_schema, k.table_name, k.column_name, k.position as key_position "
            "from all_constraints c join all_cons_columns k "
            "on k.owner = c.owner and k.constraint_name = c.constraint_name "
            f"where c.constraint_type = 'P' and {where}"
        )
    owner = "database()" if system == "mysql" and not schema else string_literal(schema or "")
    where = f"c.table_schema = {owner}" + _in("c.table_name", tables)
    return (
        "select k.table_schema, k.table_name, k.column_name, k.ordinal_position as key_position "
        "from information_schema.table_constraints c join information_schema.key_column_usage k "
        "on k.constraint_name = c.constraint_name and k.table_schema = c.table_schema "
        "and k.table_name = c.table_name "
        f"where c.constraint_type = 'PRIMARY KEY' and {where}"
    )


def catalog_rows(raw: DataFrame) -> DataFrame:
    """Catalog rows as every system names and types them, in the shape of the catalog operators."""
    raw = raw.toDF(*[c.lower() for c in raw.columns])
    ints = {"ordinal": "col_ordinal", "precision": "col_precision", "scale": "col_scale"}
    # an nvarchar(max) is -1 long, a 4 GB text overflows an int
    length = F.least(F.col("col_length").cast("long"), F.lit(2**31 - 1)).cast("int")
    return raw.select(
        "table_schema",
        "table_name",
        "column_name",
        *[F.col(src).cast("int").alias(name) for name, src in ints.items()],
        length.alias("length"),
        "data_type",
        F.lit(True).alias("nullable"),
    )
