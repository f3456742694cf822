"""Move a table or a query result from one system to another, in one Spark job."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession

from transferkit.functions.identifiers import qualify_name, quote_name
from transferkit.operators import catalog
from transferkit.operators.incremental import after, mark_literal
from transferkit.operators.project import to_load
from transferkit.operators.values import free_tokens, sized_by_values
from transferkit.sinks.files import (
    DELIMITER, NEWLINE, client_path, data_files, load_commands, write_control, write_load,
)
from transferkit.sinks.tables import write_table
from transferkit.sources import jdbc
from transferkit.sources.endpoint import Endpoint, Partitioning
from transferkit.sources.splits import split_keys
from transferkit.sources.staged import read_load
from transferkit.sources.tables import columns, file_path, read_query, read_table, table_exists
from transferkit.streaming.changes import ChangeLog
from transferkit.types import ColumnInfo, column_infos, tag


@dataclass(frozen=True)
class TransferResult:
    """``rows`` reads the moved rows back, lazily; ``commands`` loads files into the target."""

    columns: list[ColumnInfo]
    rows: DataFrame
    commands: list[str] = field(default_factory=list)


def check_arguments(
    source: Endpoint,
    target: Endpoint,
    table: str | None,
    schema: str | None,
    query: str | None,
    target_table: str | None,
    target_schema: str | None,
) -> None:
    """The rules of a transfer; all broken ones are named at once."""
    problems = []
    if query and (table or schema):
        problems.append("give a query or a source table, not both")
    if not query and not table:
        problems.append("give a source table or a query")
    if not query and source.is_jdbc and source.profile.schema_required and not schema:
        problems.append(f"a {source.system} source table needs a schema")
    if not target_table:
        problems.append("give a target table")
    if target.is_jdbc and target.profile.schema_required and not target_schema:
        problems.append(f"a {target.system} target needs a schema")
    if problems:
        raise ValueError("; ".join(problems))


def read_source(
    spark: SparkSession,
    source: Endpoint,
    table: str | None = None,
    schema: str | None = None,
    query: str | None = None,
    query_tables: list[str] | None = None,
    partition: Partitioning | None = None,
    compat: bool = False,
    key: str | list[str] | None = None,
    partitions: int | None = None,
    by_hash: bool = False,
) -> DataFrame:
    """The rows to move, with canonical types in their metadata.

    A JDBC table's types come from the source's catalog, a query's from the metadata of its statement, a file's from
    its schema.
    A JDBC table is read in ``partitions`` parts of equal size along ``key`` (or by its remainder, ``by_hash``): by
    default as many as the session has cores, along the primary key, whatever its types and number of columns.  A
    table without one is read over one connection.
    """
    if query:
        return read_query(spark, source, query, query_tables, partition, compat)
    if not source.is_jdbc:
        return read_table(spark, source, table, schema)
    found = catalog.require_columns(columns(spark, source, schema, [table]), schema, table)
    known = catalog.with_canonical_types(found, source.system, "table", compat)
    infos = catalog.infos_from_rows(known)
    key = None if partition else key or [i.name for i in split_keys(infos)]
    if not key:
        return read_table(spark, source, table, schema, partition, infos=infos)
    partitions = partitions or max(2, spark.sparkContext.defaultParallelism)
    return read_table(spark, source, table, schema, partitions=partitions, key=key, infos=infos, by_hash=by_hash)


def transfer(
    spark: SparkSession,
    source: Endpoint,
    target: Endpoint,
    target_table: str,
    target_schema: str | None = None,
    table: str | None = None,
    schema: str | None = None,
    query: str | None = None,
    query_tables: list[str] | None = None,
    partition: Partitioning | None = None,
    key: str | list[str] | None = None,
    partitions: int | None = None,
    by_hash: bool = False,
    load_path: str | None = None,
    create_schema: bool = False,
    create_table: bool = False,
    drop_table: bool = False,
    null: str | None = None,
    delimiter: str = DELIMITER,
    newline: str = NEWLINE,
    target_file_bytes: int | None = None,
    connections: int | None = None,
    load_id: str | None = None,
    quote_clash: bool = False,
    find_tokens: bool = False,
    measure: bool = False,
    client_folder: str | None = None,
    allow_loss: bool = False,
    compat: bool = False,
) -> TransferResult:
    """Read, translate, write.

    With ``load_path`` the rows become files for the target's own bulk loader, and the result has the
    commands that load them, one or two per file, besides Oracle's control file among them.
    ``client_folder`` is where the loader's machine sees ``load_path``, which it must be told where that is
    a remote store.  Values that hold a NULL token or separator stop the job; ``find_tokens`` looks for ones that no
    value holds, in a pass of its own.  ``measure`` gives columns without a size the smallest that holds their values,
    in another: numbers then need not travel as text, and texts can be keys.  A table whose columns could cut values is not created unless ``allow_loss`` or
    ``compat`` says so.  Without ``load_path`` they are appended to the target table directly; over JDBC under
    ``load_id``, with which a load that was cut off goes on.  Every pair of systems goes through the same canonical
    types, so no pair needs code of its own.
    """
    check_arguments(source, target, table, schema, query, target_table, target_schema)
    rows = read_source(
        spark, source, table, schema, query, query_tables, partition, compat, key, partitions, by_hash
    )
    if measure:
        rows = sized_by_values(rows)
    infos = column_infos(rows)
    if load_path:
        if find_tokens:
            null, delimiter, newline = free_tokens(to_load(rows, target.system, None, compat, source.system))
        token = null or target.profile.null_token
        seen_at = client_path(client_folder or load_path)  # fails here rather than after the work
        lengths = Observation() if target.system == "oracle" and infos else None
        write_load(
            rows, load_path, target.system, source.system, token, delimiter, newline, target_file_bytes,
            compat=compat, quote_clash=quote_clash, lengths=lengths,
        )
        control = None
        if target.system == "oracle":
            known = lengths.get if lengths else {}
            # beside the data, where reads of the folder do not look
            made = write_control(
                spark, f"{load_path}/_control", infos, known, target_table, target_schema, token, compat
            )
            control = f"{seen_at}/_control/{made.rsplit('/', 1)[-1]}"
        back = read_load(spark, load_path, target.system, infos, token, delimiter, newline)
        files = [f"{seen_at}/{name}" for name in data_files(spark, load_path)]
        commands = load_commands(
            target.system, target_table, files, infos, target_schema or "public", token, delimiter, newline,
            control=control,
        )
        return TransferResult(infos, back, commands)
    write_table(
        rows, target, target_table, target_schema, create_schema, create_table, drop_table,
        connections=connections, load_id=load_id, allow_loss=allow_loss, compat=compat,
    )
    return TransferResult(infos, read_table(spark, target, target_table, target_schema))


def incremental_transfer(
    spark: SparkSession,
    source: Endpoint,
    target: Endpoint,
    table: str,
    keys: list[str],
    mark: str,
    target_table: str | None = None,
    schema: str | None = None,
    target_schema: str | None = None,
    partition: Partitioning | None = None,
    inclusive: bool = True,
) -> DataFrame:
    """Bring a target up to date: everything the first time, then the rows from the target's newest mark on,
    each replacing the target's rows of the same key.  Returns the target's rows.

    The mark is pushed to the source as a literal.  JDBC targets delete and insert in one transaction; folder
    targets keep a ``ChangeLog``, so a small load does not rewrite a large target.
    """
    target_table = target_table or table
    check_arguments(source, target, table, schema, None, target_table, target_schema)
    rows = tag(read_source(spark, source, table, schema, partition=partition), keys=keys)
    if target.path:
        log = ChangeLog(file_path(target, target_table, target_schema), tuple(keys))
        log.load(spark, rows, mark, inclusive)
        return log.current(spark)
    if not target.is_jdbc:
        raise ValueError("an incremental transfer needs a JDBC or a folder target")
    first = not table_exists(spark, target, target_table, target_schema)
    if not first:
        full = qualify_name(target_schema, target_table, target.system)
        newest = jdbc.largest(spark, target, full, quote_name(mark, target.system))
        rows = after(rows, mark, mark_literal(newest, rows.schema[mark].dataType), inclusive)
    write_table(
        rows, target, target_table, target_schema, create_table=first, incremental=True,
        keys=None if first else keys,
    )
    return read_table(spark, target, target_table, target_schema)
