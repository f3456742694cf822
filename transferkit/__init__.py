"""Move tables and query results between database systems with Spark."""

from transferkit.operators.catalog import ddl, describe, primary_keys, translate
from transferkit.operators.incremental import (
    delete_by_keys,
    delete_statements,
    high_water_mark,
    latest_per_key,
    since,
    upsert,
)
from transferkit.operators.places import PlacedTable
from transferkit.operators.project import from_canonical, key_columns, to_canonical, to_literals, to_load
from transferkit.operators.sizing import max_byte_length
from transferkit.operators.values import free_tokens, sized_by_values, value_profile
from transferkit.plans.transfer import TransferResult, incremental_transfer, transfer
from transferkit.sinks import (
    append_by_position,
    control_text,
    load_commands,
    write_keys,
    write_load,
    write_staged,
    write_table,
)
from transferkit.sources import (
    Endpoint,
    columns,
    read_keys,
    read_load,
    read_query,
    read_staged,
    read_stream,
    read_table,
    table_exists,
)
from transferkit.streaming import ChangeLog, TableStream, follow_table
from transferkit.systems import SYSTEMS
from transferkit.types import ColumnInfo, column_infos, nested_as_json, tag

__all__ = [
    "SYSTEMS",
    "ChangeLog",
    "ColumnInfo",
    "Endpoint",
    "PlacedTable",
    "TableStream",
    "TransferResult",
    "append_by_position",
    "column_infos",
    "columns",
    "control_text",
    "ddl",
    "delete_by_keys",
    "delete_statements",
    "describe",
    "follow_table",
    "free_tokens",
    "from_canonical",
    "high_water_mark",
    "incremental_transfer",
    "key_columns",
    "latest_per_key",
    "load_commands",
    "max_byte_length",
    "nested_as_json",
    "primary_keys",
    "read_keys",
    "read_load",
    "read_query",
    "read_staged",
    "read_stream",
    "read_table",
    "since",
    "sized_by_values",
    "table_exists",
    "tag",
    "to_canonical",
    "to_literals",
    "to_load",
    "transfer",
    "translate",
    "upsert",
    "value_profile",
    "write_keys",
    "write_load",
    "write_staged",
    "write_table",
]
