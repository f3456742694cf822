"""A JDBC table followed as a stream: bounded batches along (mark, key), with offsets kept as literals.

The offset of a batch is the mark and key of its last row, in the words of the source's own SQL.  It is written down
before the batch is read and a commit after it is handled, so a run that was cut off reads the same range again and
goes on from there: no row is lost, and none comes in two batches.  Rows are taken in the order of (mark, key); the
database finds the end of a batch, and only that one row comes to the driver.

A row that gets a mark before the last offset is not seen; ``hold_back`` leaves out marks that are too young for that.
Rows without a mark or key are not part of the order and never read.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from transferkit.functions.identifiers import qualify_name, quote_name
from transferkit.session import child_names, make_folder
from transferkit.sources import jdbc, splits
from transferkit.sources.endpoint import Endpoint
from transferkit.streaming.changes import ChangeLog
from transferkit.types import ColumnInfo, apply_infos

ROWS_PER_BATCH = 1_000_000


@dataclass(frozen=True)
class TableStream:
    """``infos`` describe the table's columns (see ``read_source``); ``keys`` with the mark name one row."""

    source: Endpoint
    table: str
    infos: list[ColumnInfo]
    mark: str
    keys: tuple[str, ...]
    checkpoint: str
    schema: str | None = None
    rows_per_batch: int = ROWS_PER_BATCH
    hold_back: str | None = None

    @property
    def full(self) -> str:
        return qualify_name(self.schema, self.table, self.source.system)

    def _order(self) -> tuple[list[str], list[ColumnInfo]]:
        known = {i.name: i for i in self.infos}
        columns = [known[c] for c in (self.mark, *self.keys)]
        return [quote_name(c.name, self.source.system) for c in columns], columns

    def offsets(self, spark: SparkSession) -> list[list[str]]:
        """The end of every batch that was begun, as literals."""
        names = sorted(child_names(spark, f"{self.checkpoint}/offsets"), key=int)
        return [json.loads(spark.read.text(f"{self.checkpoint}/offsets/{n}").first()[0]) for n in names]

    def committed(self, spark: SparkSession) -> int:
        """How many batches are done."""
        return len(child_names(spark, f"{self.checkpoint}/commits"))

    def _end_query(self, start: list[str] | None) -> str:
        """The row a batch ends with: the last but for the batch's size, or of all."""
        names, columns = self._order()
        system = self.source.system
        where = [f"{n} is not null" for n in names]
        if start:
            where.append(splits.beyond(names, start))
        if self.hold_back:
            where.append(f"{names[0]} <= {self.hold_back}")
        order = ", ".join(splits.ordering(system, n, c) for n, c in zip(names, columns))
        keys = ", ".join(names)
        ranked = (
            f"select {keys}, row_number() over (order by {order}) as tk_row, count(*) over () as tk_rows "
            f"from {self.full} where {' and '.join(where)}"
        )
        n = self.rows_per_batch
        return f"select {keys}, tk_row from ({ranked}) q where tk_row = {n} or (tk_rows < {n} and tk_row = tk_rows)"

    def _next_end(self, spark: SparkSession, start: list[str] | None) -> list[str] | None:
        names, columns = self._order()
        options = {**jdbc.query_options(self.source, self._end_query(start)), **jdbc.custom_schema(columns)}
        rows = apply_infos(jdbc.load(spark, options), [*columns, ColumnInfo("tk_row", "int64")])
        found = splits.cut_literals(rows, self.source.system, names)
        return found[0] if found else None

    def rows(self, spark: SparkSession, start: list[str] | None, end: list[str]) -> DataFrame:
        """The rows after one offset and up to another."""
        names, _ = self._order()
        both = [splits.beyond(names, start)] if start else []
        condition = " and ".join([*both, splits.up_to(names, end)])
        rows = jdbc.load_by_predicates(spark, self.source, self.full, [condition], self.infos)
        return apply_infos(rows, self.infos)

    def run(self, spark: SparkSession, handle: Callable[[DataFrame, int], None]) -> int:
        """Hand over batch after batch until the table has no rows beyond the last; returns how many.

        ``handle`` may get a batch again that was cut off, under the same number and with the same range.
        """
        ends, done = self.offsets(spark), self.committed(spark)
        handled = 0
        while True:
            start = ends[done - 1] if done else None
            if done == len(ends):
                end = self._next_end(spark, start)
                if end is None:
                    return handled
                line = spark.createDataFrame([(json.dumps(end),)], "value string").coalesce(1)
                line.write.mode("overwrite").text(f"{self.checkpoint}/offsets/{done}")
                ends.append(end)
            handle(self.rows(spark, start, ends[done]), done)
            make_folder(spark, f"{self.checkpoint}/commits/{done}")
            done, handled = done + 1, handled + 1


def follow_table(spark: SparkSession, stream: TableStream, log: ChangeLog) -> int:
    """Write a table's new and changed rows into a log until none are left; returns the number of batches."""
    return stream.run(spark, lambda rows, epoch: log.apply_epoch(rows, epoch, stream.checkpoint))
