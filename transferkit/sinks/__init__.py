"""Where rows go: staged files, load files, tables."""

from transferkit.sinks.files import control_text, load_commands, write_keys, write_load, write_staged
from transferkit.sinks.tables import append_by_position, drop_statement, schema_statement, write_table

__all__ = [
    "append_by_position",
    "control_text",
    "drop_statement",
    "load_commands",
    "schema_statement",
    "write_keys",
    "write_load",
    "write_staged",
    "write_table",
]
