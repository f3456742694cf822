"""Exactly-once loads over JDBC: rows staged by part and attempt, parts moved once each, a ledger in the target.

Spark's JDBC writer commits a task's rows in one transaction, but a task that is run again leaves them twice.  So the
staged rows carry the number of their part and of the attempt that wrote them; of every part one attempt is chosen,
by one grouped query.  A part then moves in a transaction that also enters it in the ledger, whose key is (load,
part): a move that is repeated, by a driver that lost its connection or by another run, fails on that key.  Rows are
stored twice, staged and moved; nothing is numbered, copied or ordered.

``load_id`` names a load.  A run under the id of an unfinished load goes on with it: if its rows are all staged, only
the parts that the ledger lacks move; else it starts anew, for then nothing has moved.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transferkit.functions.identifiers import qualify_name, quote_name, string_literal
from transferkit.operators import catalog
from transferkit.systems import profile
from transferkit.types import ColumnInfo

PART, TRY = "transferkit_part", "transferkit_try"
LEDGER = "transferkit_ledger"
# Entries of a load besides its parts: all rows are staged; all parts have moved.
STAGED, DONE = -1, -2
# Connections over which parts move at once.
MOVERS = 4


def with_attempt(df: DataFrame) -> DataFrame:
    """The rows with their part and the attempt that writes them.

    Only the part's number goes through Python, which knows the attempt; the rows stay in the JVM.
    """

    @F.pandas_udf("long")
    def attempt(part: pd.Series) -> pd.Series:
        return pd.Series(TaskContext.get().taskAttemptId(), index=part.index)

    return df.withColumns({PART: F.spark_partition_id(), TRY: attempt.asNondeterministic()(F.spark_partition_id())})


def ledger_statement(spark: SparkSession, target: str, schema: str | None) -> str:
    """Create the ledger beside the target table unless it is there."""
    rows = [
        (schema or "", LEDGER, "load_id", 1, "nvarchar", -1, -1, 64, False, True),
        (schema or "", LEDGER, "part_no", 2, "int32", -1, -1, -1, False, True),
        (schema or "", LEDGER, "try_id", 3, "int64", -1, -1, -1, False, False),
    ]
    columns = spark.createDataFrame(rows, catalog.CATALOG_SCHEMA).withColumnRenamed("data_type", "canonical_type")
    return catalog.ddl(catalog.translate(columns, None, target), target, incremental=True).first()["statement"]


def staging_name(schema: str | None, table: str, load: str) -> str:
    """A name of its own for each load, 30 characters whatever the table's: within every system's limit."""
    return "tk_" + hashlib.md5(f"{schema}|{table}|{load}".encode()).hexdigest()[:27]


@dataclass(frozen=True)
class Load:
    """A load of a table and the statements it takes."""

    name: str
    target: str
    table: str
    schema: str | None
    columns: list[ColumnInfo]
    keys: tuple[str, ...] = ()

    @property
    def full(self) -> str:
        return qualify_name(self.schema, self.table, self.target)

    @property
    def staging_name(self) -> str:
        return staging_name(self.schema, self.table, self.name)

    @property
    def staging(self) -> str:
        return qualify_name(self.schema, self.staging_name, self.target)

    @property
    def ledger(self) -> str:
        return qualify_name(self.schema, LEDGER, self.target)

    def entry(self, part: int, attempt: int = 0) -> str:
        return f"insert into {self.ledger} (load_id, part_no, try_id) values ({string_literal(self.name)}, {part}, {attempt})"

    def entries(self) -> str:
        """Query: the parts that have moved, and the load's other entries."""
        return f"select part_no from {self.ledger} where load_id = {string_literal(self.name)}"

    def attempts(self) -> str:
        """Query: one attempt of every staged part; a part's attempts hold the same rows."""
        return f"select {PART} as part_no, min({TRY}) as try_id from {self.staging} group by {PART}"

    def index(self) -> list[str]:
        """So that a part is found without a scan.  Snowflake has no indexes; it prunes by the values of its files."""
        if self.target == "snowflake":
            return []
        return [f"create index {self.staging_name[:-1]}i on {self.staging} ({PART}, {TRY})"]

    def _insert(self, source: str) -> str:
        """By position, as the bulk loaders do, but by name on Oracle."""
        prof = profile(self.target)
        names = [quote_name(c.name, self.target) for c in self.columns]
        values = [
            prof.json_from_text.format(f"s.{n}") if c.type == "json" and prof.json_from_text else f"s.{n}"
            for n, c in zip(names, self.columns)
        ]
        listed = f" ({', '.join(names)})" if prof.loads_by_name else ""
        return f"insert into {self.full}{listed} select {', '.join(values)} from {source}"

    def move(self, part: int, attempt: int) -> list[str]:
        """One transaction: the part's entry, then its rows."""
        source = f"{self.staging} s where s.{PART} = {part} and s.{TRY} = {attempt}"
        return [self.entry(part, attempt), self._insert(source)]

    def delete_replaced(self) -> str:
        """Delete the table's rows whose key is among the staged rows."""
        name = quote_name(self.table, self.target)
        on = " and ".join(f"s.{quote_name(k, self.target)} = {name}.{quote_name(k, self.target)}" for k in self.keys)
        return f"delete from {self.full} where exists (select 1 from {self.staging} s where {on})"

    def replace(self) -> list[str]:
        """One transaction for a load that replaces rows by key: readers never see the table without them.

        The entries name the chosen attempts, and the staged rows are joined with them.
        """
        load = string_literal(self.name)
        chosen = f"select {load}, {PART}, min({TRY}) from {self.staging} group by {PART}"
        on = f"l.load_id = {load} and l.part_no = s.{PART} and l.try_id = s.{TRY}"
        return [
            self.entry(DONE),
            f"insert into {self.ledger} (load_id, part_no, try_id) {chosen}",
            self.delete_replaced(),
            self._insert(f"{self.staging} s join {self.ledger} l on {on}"),
            self._forget_parts(),
        ]

    def _forget_parts(self) -> str:
        return f"delete from {self.ledger} where load_id = {string_literal(self.name)} and part_no > {DONE}"

    def end(self) -> list[str]:
        """One transaction: the load is done, its parts need no entries any more."""
        return [self._forget_parts(), self.entry(DONE)]


def run_load(
    load: Load,
    run: Callable[[list[str]], None],
    query: Callable[[str], list],
    stage: Callable[[], None],
    prepare: list[str],
    create: list[str],
    drop: list[str],
    movers: int | None = None,
) -> None:
    """The order of a load.

    ``run`` executes statements in one transaction, ``query`` returns a query's rows, ``stage`` writes the rows into the
    staging table.  ``prepare`` are the statements on the target table, ``create`` and ``drop`` those on the staging
    table.  What comes to the driver is two numbers for each part.
    """
    known = {int(r[0]) for r in query(load.entries())}
    if DONE in known:
        run(drop)
        return
    if STAGED not in known:
        if prepare:
            run(prepare)
        run(drop)  # what a run left that ended while it staged
        run(create)
        try:
            stage()
            if load.index():
                run(load.index())
            run([load.entry(STAGED)])
        except Exception:
            run(drop)
            raise
    try:
        if load.keys:
            run(load.replace())
        else:
            left = [(int(part), int(attempt)) for part, attempt in query(load.attempts()) if int(part) not in known]
            with ThreadPoolExecutor(movers or MOVERS) as pool:
                list(pool.map(lambda x: run(load.move(*x)), left))
            run(load.end())
    except Exception as e:
        raise RuntimeError(f"load {load.name} is staged but has not moved; run it again with load_id={load.name!r}") from e
    run(drop)
