"""Types of a query's result as its database names them, from the prepared statement; and names for its columns.

Spark's schema of a JDBC query has lost what the database said: lengths, whether a number has a size, money, JSON,
uuids, bits.  The statement still has it.  Only descriptions of columns come to the driver, never rows.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

from transferkit.operators import catalog
from transferkit.sources.endpoint import Endpoint
from transferkit.types import ColumnInfo

# What drivers report as the length of a text without one.
UNBOUNDED = 1 << 30


def connect(spark: SparkSession, options: dict[str, str]):
    """A connection of the driver's JVM; its class is found where Spark finds it."""
    jvm = spark._jvm
    properties = jvm.java.util.Properties()
    for name, value in options.items():
        if name not in ("url", "driver"):
            properties.setProperty(name, value)
    loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
    return loader.loadClass(options["driver"]).newInstance().connect(options["url"], properties)


def statement_columns(spark: SparkSession, source: Endpoint, query: str) -> list[tuple]:
    """(label, type name, precision, scale, nullable) of every column, from a statement that is prepared, not run.

    A driver that knows nothing before it runs a statement is asked for one row, which is not read.
    """
    connection = connect(spark, source.read_options())
    try:
        statement = connection.prepareStatement(query)
        meta = statement.getMetaData()
        if meta is None:
            statement.setMaxRows(1)
            meta = statement.executeQuery().getMetaData()
        return [
            (
                meta.getColumnLabel(n), meta.getColumnTypeName(n), meta.getPrecision(n), meta.getScale(n),
                meta.isNullable(n) != meta.columnNoNulls,
            )
            for n in range(1, meta.getColumnCount() + 1)
        ]
    finally:
        connection.close()


def type_name(system: str, name: str) -> str:
    """A driver's type name in the form of the type tables: without sizes and marks of generated columns."""
    name = re.sub(r"\s*\([^)]*\)", "", name).lower().strip()
    if system == "mssql":
        name = name.removesuffix(" identity")
    if system == "mysql":
        name = name.removesuffix(" zerofill")
        if name.endswith(" unsigned"):
            name = "unsigned " + name.removesuffix(" unsigned")
    return name


def column_sizes(precision: int, scale: int) -> tuple[int, int, int]:
    """Precision, scale and length, -1 where unknown: what a number's precision is, is a text's length."""
    if not 0 < precision < UNBOUNDED:
        return -1, -1, -1
    return precision, scale if scale >= 0 else -1, precision


def unique_names(labels: list[str]) -> list[str]:
    """Names by position: of equal ones, in any case, the later get a number, and those without a name one too."""
    taken, out = {x.lower() for x in labels}, []
    seen: set[str] = set()
    for n, label in enumerate(labels, start=1):
        name, k = label or f"column_{n}", 1
        while name.lower() in seen or (k > 1 or not label) and name.lower() in taken:
            k += 1
            name = f"{label or f'column_{n}'}_{k}"
        seen.add(name.lower())
        out.append(name)
    return out


def query_infos(
    spark: SparkSession, system: str, columns: list[tuple], compat: bool = False
) -> list[ColumnInfo]:
    """Canonical descriptions of a statement's columns, under names that differ; an unknown type stops here."""
    rows = []
    names = unique_names([c[0] for c in columns])
    for n, (name, (_, kind, precision, scale, nullable)) in enumerate(zip(names, columns), start=1):
        rows.append(("", "", name, n, type_name(system, kind), *column_sizes(precision, scale), nullable, False))
    described = spark.createDataFrame(rows, catalog.CATALOG_SCHEMA)
    return catalog.infos_from_rows(catalog.with_canonical_types(described, system, "statement", compat))


def positional(system: str, query: str, names: list[str]) -> str:
    """The query as a derived table whose columns have the given plain names, whatever the query calls them."""
    listed = ", ".join(names)
    if system == "oracle":  # no column list after a derived table there
        return f"(with q ({listed}) as ({query}) select * from q)"
    return f"({query}) q ({listed})"
