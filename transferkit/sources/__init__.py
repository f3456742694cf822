"""Where rows come from: tables, queries, JDBC databases, staged files."""

from transferkit.sources.endpoint import Endpoint
from transferkit.sources.staged import read_keys, read_load, read_staged
from transferkit.sources.tables import columns, read_query, read_stream, read_table, table_exists

__all__ = [
    "Endpoint",
    "columns",
    "read_keys",
    "read_load",
    "read_query",
    "read_staged",
    "read_stream",
    "read_table",
    "table_exists",
]
