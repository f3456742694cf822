"""Table scans, query scans and schema discovery for every kind of endpoint."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transferkit.functions.identifiers import qualify_name, quote_name
from transferkit.operators import catalog
from transferkit.session import is_folder, path_exists
from transferkit.sources import jdbc, metadata
from transferkit.sources.endpoint import Endpoint, Partitioning, hash_predicates
from transferkit.types import ColumnInfo, apply_infos


def file_path(endpoint: Endpoint, table: str, schema: str | None = None) -> str:
    parts = [endpoint.path, *([schema] if schema else []), table]
    return os.path.join(*parts)


def stored_path(spark: SparkSession, source: Endpoint, table: str, schema: str | None = None) -> str:
    """Where a folder endpoint has a table: a file or folder with the format's ending, or else a folder without."""
    base = file_path(source, table, schema)
    single = f"{base}.{source.file_format}"
    return single if path_exists(spark, single) else base


def read_table(
    spark: SparkSession,
    source: Endpoint,
    table: str,
    schema: str | None = None,
    partition: Partitioning | None = None,
    partitions: int | None = None,
    key: str | list[str] | None = None,
    infos: list[ColumnInfo] | None = None,
    by_hash: bool = False,
) -> DataFrame:
    """A full table.

    Nothing is read yet: filters and column choices made on the result are pushed to the files or to
    the database.  Over JDBC, ``partition``, or ``key`` and ``partitions``, makes the read parallel; without it one
    connection reads everything.  Along ``key``, a column or several of any type with an order, the table is cut into
    parts of equal size where the database's own quantiles lie; without ``infos``, which name the key's types, into
    equal ranges between its bounds.  ``by_hash`` splits an integer key by its remainder, for keys of which one value
    has very many rows.  ``infos``, the columns as the source's catalog has them, also sets the canonical types and
    keeps wide numbers whole.
    """
    if source.is_jdbc:
        full = qualify_name(schema, table, source.system)
        keys = [key] if isinstance(key, str) else key or []
        names = [quote_name(k, source.system) for k in keys]
        known = {i.name: i for i in infos or []}
        if by_hash:
            if not (len(keys) == 1 and partitions):
                raise ValueError("by_hash needs one key column and partitions")
            predicates = hash_predicates(names[0], partitions, source.system)
            rows = jdbc.load_by_predicates(spark, source, full, predicates, infos)
        elif partition is None and partitions and keys and all(k in known for k in keys):
            predicates = jdbc.split_predicates(spark, source, full, names, [known[k] for k in keys], partitions)
            rows = jdbc.load_by_predicates(spark, source, full, predicates, infos)
        else:
            if partition is None and keys and partitions:
                if len(keys) > 1:
                    raise ValueError("several key columns need infos")
                partition = jdbc.bounds(spark, source, full, names[0], partitions)
            rows = jdbc.load(spark, {**jdbc.table_options(source, full, partition), **jdbc.custom_schema(infos or [])})
        return apply_infos(rows, infos) if infos else rows
    if source.path:
        path = stored_path(spark, source, table, schema)
        return spark.read.format(source.file_format).options(**source.options).load(path)
    return spark.table(f"{schema}.{table}" if schema else table)


def read_stream(spark: SparkSession, source: Endpoint, table: str, schema: str | None = None) -> DataFrame:
    """A table of a folder endpoint as a stream: files that appear in it later are new rows."""
    if not source.path:
        raise ValueError("only tables in a folder can be followed")
    rows = read_table(spark, source, table, schema)
    reader = spark.readStream.schema(rows.schema).format(source.file_format).options(**source.options)
    base = file_path(source, table, schema)
    single = f"{base}.{source.file_format}"
    for place in (single, base):
        if is_folder(spark, place):
            return reader.load(place)
    folder, name = os.path.split(single)
    return reader.option("pathGlobFilter", name).load(folder)


def read_query(
    spark: SparkSession,
    source: Endpoint,
    query: str,
    tables: list[str] | None = None,
    partition: Partitioning | None = None,
    compat: bool = False,
) -> DataFrame:
    """The result of the caller's SQL, passed unchanged.

    Over JDBC the source database runs it, once, or once per range of ``partition``; the columns' types are those the
    database gives for the statement.  Elsewhere Spark does, with the folder's tables that the query names
    (``tables``) as views.  Columns go by position: of equal names the later ones get a number.
    """
    if source.is_jdbc:
        found = metadata.statement_columns(spark, source, query.strip().rstrip(";"))
        infos = metadata.query_infos(spark, source.system, found, compat)
        return jdbc.load_query(spark, source, query, [c[0] for c in found], infos, partition)
    if source.path:
        for t in tables or []:
            read_table(spark, source, t).createOrReplaceTempView(t)
    rows = spark.sql(query)
    names = metadata.unique_names(rows.columns)
    return rows if names == rows.columns else rows.toDF(*names)


def columns(
    spark: SparkSession, source: Endpoint, schema: str | None = None, tables: list[str] | None = None
) -> DataFrame:
    """Catalog rows of many tables: sizes normalized, primary keys marked."""
    if not source.is_jdbc:
        if not tables:
            raise ValueError("name the tables to describe")
        found = {(schema or "", t): read_table(spark, source, t, schema) for t in tables}
        return catalog.with_sizes(catalog.describe_all(spark, found))
    query = jdbc.columns_query(source.system, schema, tables)
    rows = jdbc.catalog_rows(jdbc.load(spark, jdbc.query_options(source, query)))
    keys = jdbc.keys_query(source.system, schema, tables)
    if keys is None:
        return catalog.with_sizes(rows.withColumn("is_primary", F.lit(False)))
    key_rows = jdbc.load(spark, jdbc.query_options(source, keys))
    key_rows = key_rows.toDF(*[c.lower() for c in key_rows.columns])
    return catalog.with_sizes(catalog.with_keys(rows, key_rows))


def table_exists(spark: SparkSession, endpoint: Endpoint, table: str, schema: str | None = None) -> bool:
    """False means a first load: nothing to compare with, no high-water mark."""
    if endpoint.is_jdbc:
        query = jdbc.columns_query(endpoint.system, schema, [table])
        return not jdbc.load(spark, jdbc.query_options(endpoint, query)).isEmpty()
    if endpoint.path:
        base = file_path(endpoint, table, schema)
        return path_exists(spark, base) or path_exists(spark, f"{base}.{endpoint.file_format}")
    return spark.catalog.tableExists(f"{schema}.{table}" if schema else table)
