"""Rows into tables: over JDBC, into the Spark catalog, or into a folder of files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transferkit.functions.identifiers import qualify_name, quote_name, string_literal
from transferkit.operators import catalog
from transferkit.session import path_exists
from transferkit.sinks import ledger
from transferkit.sources import jdbc
from transferkit.sources.endpoint import Endpoint
from transferkit.sources.metadata import connect
from transferkit.sources.tables import file_path
from transferkit.systems import profile
from transferkit.types import column, column_infos, tag


def schema_statement(target: str, schema: str) -> str | None:
    """Create the schema unless it is there.  None for Oracle, where a schema is a user: an
    administrator makes that."""
    name = quote_name(schema, target)
    if target == "mssql":
        create = string_literal(f"create schema {name}")
        return f"if schema_id({string_literal(schema)}) is null exec({create})"
    if target == "mysql":
        return f"create database if not exists {name}"
    if target == "oracle":
        return None
    return f"create schema if not exists {name}"


def drop_statement(target: str, schema: str | None, table: str) -> str:
    full = qualify_name(schema, table, target)
    if target == "oracle":  # ORA-00942: there is no such table
        text = string_literal(f"drop table {full}")
        return (
            f"begin execute immediate {text}; "
            "exception when others then if sqlcode != -942 then raise; end if; end;"
        )
    return f"drop table if exists {full}"


def run_statements(spark: SparkSession, target: Endpoint, statements: list[str]) -> None:
    """Run DDL or one-statement DML on a JDBC database, once, from the driver, in one transaction where
    the database has transactional DDL.  Only statement text passes through here, never rows."""
    connection = connect(spark, target.write_options())
    try:
        connection.setAutoCommit(False)
        for text in statements:
            statement = connection.createStatement()
            statement.execute(text)
            statement.close()
        connection.commit()
    finally:
        connection.close()


def _statement_for(
    df: DataFrame, target: str, schema: str | None, table: str, incremental: bool, compat: bool, allow_loss: bool
) -> str:
    rows = catalog.translate(catalog.describe(df, schema or "", table), None, target, compat=compat)
    if not (compat or allow_loss):
        lossy = [f"{r.column_name} ({r.target_type})" for r in rows.where("lossy").collect()]
        if lossy:
            raise ValueError(f"columns of {table} that could cut values: {', '.join(lossy)}; see allow_loss")
    made = catalog.ddl(rows, target, incremental, compat).first()
    if made["refused"]:
        raise ValueError(f"{table}: {made['refused']}")
    return made["statement"]


def write_jdbc_options(
    target: Endpoint, table: str, connections: int | None = None, batch: int = 10_000
) -> dict[str, str]:
    """Without ``connections`` every task that writes has one; with it, rows are drawn together into so many."""
    limit = {"numPartitions": str(connections)} if connections else {}
    return {**target.write_options(), "dbtable": table, **limit, "batchsize": str(batch)}


def for_jdbc(df: DataFrame, target: str) -> DataFrame:
    """Values in the form the target's columns take over JDBC: uuids are bytes where the column is."""
    rules = profile(target).load
    if not (rules.bare_uuid or rules.bare_uuid_exact):
        return df
    out = []
    for i, f in zip(column_infos(df), df.schema.fields):
        c = column(f.name)
        if i.type == "uuid" and isinstance(f.dataType, T.StringType):
            c = F.unhex(F.replace(c, F.lit("-"))).alias(f.name, metadata=f.metadata)
        out.append(c)
    return df.select(*out)


def write_table(
    df: DataFrame,
    target: Endpoint,
    table: str,
    schema: str | None = None,
    create_schema: bool = False,
    create_table: bool = False,
    drop_table: bool = False,
    incremental: bool = False,
    connections: int | None = None,
    exactly_once: bool = True,
    keys: list[str] | None = None,
    load_id: str | None = None,
    location: str | None = None,
    allow_loss: bool = False,
    compat: bool = False,
) -> None:
    """Append the rows of ``df`` by position, after creating or dropping what the flags say.

    Catalog and folder targets commit all rows or none.  JDBC commits task by task, so a lost executor
    may leave rows of a failed attempt behind: ``exactly_once`` stages the rows by part and attempt and moves each part
    once, under a ledger in the target's schema.  ``load_id`` names the load there: a run under the name of an
    unfinished load goes on with it.  With ``keys`` the table's rows of the same keys are deleted in the transaction
    that moves all staged rows (JDBC; use ``upsert`` or ``ChangeLog`` elsewhere).  ``location`` is where a new schema of
    the Spark catalog keeps its tables; the default is the session's warehouse.
    """
    if target.profile.schema_required and target.is_jdbc and not schema:
        raise ValueError(f"{target.system} targets need a schema")
    if keys and not (target.is_jdbc and exactly_once):
        raise ValueError("keys need a JDBC target with exactly_once; see upsert and ChangeLog")
    if load_id and not (target.is_jdbc and exactly_once):
        raise ValueError("a load_id needs a JDBC target with exactly_once")
    spark = df.sparkSession
    if target.is_jdbc:
        _write_jdbc(
            df, target, table, schema, create_schema, create_table, drop_table, incremental,
            connections, exactly_once, keys, load_id, allow_loss, compat,
        )
    elif target.path:
        base = file_path(target, table, schema)
        there = path_exists(spark, base)
        if not (there or create_table or drop_table):
            raise ValueError(f"no table at {base}; pass create_table=True")
        out = df if drop_table or not there else _by_position(df, spark.read.format(target.file_format).load(base))
        out.write.format(target.file_format).mode("overwrite" if drop_table else "append").save(base)
    else:
        _write_catalog(df, table, schema, create_schema, create_table, drop_table, location)


def _by_position(df: DataFrame, existing: DataFrame) -> DataFrame:
    if len(df.columns) != len(existing.columns):
        raise ValueError(f"{len(df.columns)} columns for a table of {len(existing.columns)}")
    return df.select(
        *[
            F.col(f"`{src}`").cast(dst.dataType).alias(dst.name)
            for src, dst in zip(df.columns, existing.schema.fields)
        ]
    )


def append_by_position(df: DataFrame, table: str) -> None:
    """Add rows to a catalog table, first column to first column, whatever the names."""
    df.write.insertInto(table)


def _write_catalog(df, table, schema, create_schema, create_table, drop_table, location) -> None:
    spark = df.sparkSession
    full = f"`{schema}`.`{table}`" if schema else f"`{table}`"
    if create_schema and schema:
        place = f" location {string_literal(location)}" if location else ""
        spark.sql(f"create schema if not exists `{schema}`{place}")
    if drop_table:
        spark.sql(f"drop table if exists {full}")
    if create_table or drop_table:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        spark.sql(f"create table if not exists {full} ({cols}) using parquet")
    append_by_position(df, full)


def _write_jdbc(
    df, target, table, schema, create_schema, create_table, drop_table, incremental, connections,
    exactly_once, keys, load_id, allow_loss, compat,
) -> None:
    spark, system = df.sparkSession, target.system
    full = qualify_name(schema, table, system)
    # what needs no connection comes first: a table that is refused leaves nothing behind
    schemas = []
    if create_schema and schema and target.profile.schema_required:
        schemas += filter(None, [schema_statement(system, schema)])
    before = [drop_statement(system, schema, table)] if drop_table else []
    if create_table:
        before.append(_statement_for(df, system, schema, table, incremental, compat, allow_loss))
    infos, df = column_infos(df), for_jdbc(df, system)
    if not exactly_once:
        if schemas + before:
            run_statements(spark, target, schemas + before)
        df.write.format("jdbc").options(**write_jdbc_options(target, full, connections)).mode("append").save()
        return
    load = ledger.Load(load_id or uuid.uuid4().hex, system, table, schema, infos, tuple(keys or ()))
    staged = ledger.with_attempt(df)
    shape = tag(staged, {i.name: "ntext" for i in infos if i.type == "json"}) if target.profile.json_from_text else staged
    run_statements(spark, target, [*schemas, ledger.ledger_statement(spark, system, schema)])

    def stage() -> None:
        options = write_jdbc_options(target, load.staging, connections)
        staged.write.format("jdbc").options(**options).mode("append").save()

    ledger.run_load(
        load,
        lambda statements: run_statements(spark, target, statements),
        lambda text: jdbc.load(spark, jdbc.query_options(target, text)).collect(),
        stage,
        before,
        [_statement_for(shape, system, schema, load.staging_name, False, compat, True)],
        [drop_statement(system, schema, load.staging_name)],
        connections,
    )
