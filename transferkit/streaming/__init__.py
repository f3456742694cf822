"""Incremental loads as a stream of changes."""

from transferkit.streaming.changes import ChangeLog
from transferkit.streaming.tables import TableStream, follow_table

__all__ = ["ChangeLog", "TableStream", "follow_table"]
