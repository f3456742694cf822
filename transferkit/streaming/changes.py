"""A target kept as a log of keyed batches.

Rewriting a large target for every small load does not scale, so each load only adds its own rows under
its batch number.  Reading applies the loads in order: delete by key, then append.

Each batch also keeps the range of its keys and the cells its keys hash to, out of a fixed number.  Reading compares
the ranges: batches that share no key with another pass through as they are.  Of the oldest batch, usually by far the
largest, only rows whose cell a later batch has are looked up by key; the others pass a broadcast set of cells, so the
batch is not exchanged.  ``tidy`` merges batches in tiers, in place: a merged run counts in their stead from the moment
its record is there, and who reads meanwhile goes on with the batches.

The log keeps its own records, as folder names and one line of text, so it depends on no file that a committer
may leave out.  Every write goes to a folder of its own, an attempt at its batch; a batch counts once a commit
record names the attempt, after its job has ended.  What a cut-off write left behind is never read, counted or
written over.  One writer at a time: loads and streams may take turns.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transferkit.operators.incremental import after, latest_per_key, mark_literal
from transferkit.session import child_names, make_folder, path_exists, remove_folder
from transferkit.types import column

BATCH = "batch_id"
TRY = "try_id"
# Cells a key can hash to: what is broadcast is at most so many numbers.
CELLS = 1 << 20
CELL = "transferkit_cell"
# Adjacent runs of a tier that are merged into one of the next.
FANOUT = 4


@dataclass(frozen=True)
class Run:
    """Batches ``first`` to ``last`` as one folder: a batch, or several merged ones."""

    first: int
    last: int
    batches: int
    folder: str
    keys: str


@dataclass(frozen=True)
class ChangeLog:
    path: str
    keys: tuple[str, ...]

    def _records(self, spark: SparkSession, kind: str) -> dict[int, int]:
        """Per batch the newest attempt that has a record of this kind: one listing."""
        found: dict[int, int] = {}
        for name in child_names(spark, f"{self.path}/{kind}"):
            batch, attempt = map(int, name.split("."))
            found[batch] = max(attempt, found.get(batch, -1))
        return found

    def _commits(self, spark: SparkSession) -> dict[int, int]:
        return self._records(spark, "_commits")

    def batches(self, spark: SparkSession) -> list[int]:
        """Numbers of the committed batches."""
        return sorted(self._commits(spark))

    def _folder(self, batch: int, attempt: int) -> str:
        return f"{self.path}/{BATCH}={batch}/{TRY}={attempt}"

    def _runs(self, spark: SparkSession) -> list[Run]:
        """What the committed batches are read from, in order: the widest merged runs, and the batches outside of them."""
        commits = self._commits(spark)
        merged = []
        for name in child_names(spark, f"{self.path}/_merges"):
            first, last, mark = name.split("-")
            merged.append((int(first), int(last), mark))
        runs, covered = [], set()
        for first, last, mark in sorted(merged, key=lambda m: (m[0] - m[1], m)):
            inside = {b for b in commits if first <= b <= last}
            if not inside & covered:
                covered |= inside
                folder = f"{self.path}/{BATCH}={last}/{TRY}=m{mark}"
                runs.append(Run(first, last, len(inside), folder, f"{self.path}/_keys/m{first}-{last}-{mark}"))
        for b in set(commits) - covered:
            runs.append(Run(b, b, 1, self._folder(b, commits[b]), f"{self.path}/_keys/{b}.{commits[b]}"))
        return sorted(runs, key=lambda r: r.first)

    def schema(self, spark: SparkSession) -> T.StructType | None:
        """The columns of the log: those of its first batch and all that later ones added."""
        versions = [int(n) for n in child_names(spark, f"{self.path}/_schemas")]
        if not versions:
            return None
        text = spark.read.text(f"{self.path}/_schemas/{max(versions)}").first()
        return T.StructType.fromJson(json.loads(text.value)) if text else None

    def _keep_schema(self, rows: DataFrame) -> None:
        """Keep the columns before their first rows; new ones are added, missing or retyped ones refused."""
        spark = rows.sparkSession
        kept = self.schema(spark)
        given = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in rows.schema.fields])
        if kept is None:
            version, merged = 0, given
        else:
            types = {f.name: f.dataType for f in given.fields}
            wrong = [f.name for f in kept.fields if types.get(f.name) != f.dataType]
            if wrong:
                raise ValueError(f"columns of the log that the batch lacks or has in another type: {', '.join(wrong)}")
            added = [f for f in given.fields if f.name not in kept.names]
            if not added:
                return
            version = 1 + max(int(n) for n in child_names(spark, f"{self.path}/_schemas"))
            merged = T.StructType([*kept.fields, *added])
        line = spark_row(spark, [(merged.json(),)], T.StructType([T.StructField("value", T.StringType())]))
        line.write.mode("overwrite").text(f"{self.path}/_schemas/{version}")

    def read(self, spark: SparkSession, batches: list[int] | None = None) -> DataFrame:
        """All rows of the given batches (default: all), with their batch number as a column.

        A batch from before a column was added has NULL there.
        """
        runs = self._runs(spark)
        if batches is not None:
            runs = [r for r in runs if any(r.first <= b <= r.last for b in batches)]
        return self._rows(spark, runs)

    def _rows(self, spark: SparkSession, runs: list[Run]) -> DataFrame:
        if not runs:
            raise ValueError(f"no committed batch in {self.path}")
        kept = self.schema(spark)
        whole = T.StructType([*kept.fields, T.StructField(BATCH, T.IntegerType())])
        found = spark.read.schema(whole).option("basePath", self.path).parquet(*[r.folder for r in runs])
        return found.select(*[column(n) for n in kept.names], BATCH)

    def _cell(self) -> Column:
        return F.pmod(F.xxhash64(*[column(k) for k in self.keys]), F.lit(CELLS)).cast("int")

    def _keep_keys(self, spark: SparkSession, folder: str, place: str) -> None:
        """Keep range and cells of a folder's keys: one pass over its key columns."""
        rows = spark.read.parquet(folder).where(reduce(and_, [column(k).isNotNull() for k in self.keys]))
        key = F.struct(*[column(k) for k in self.keys])
        rows.agg(F.min(key).alias("low"), F.max(key).alias("high")).coalesce(1).write.mode("overwrite").parquet(f"{place}/range")
        rows.select(self._cell().alias("cell")).distinct().coalesce(1).write.mode("overwrite").parquet(f"{place}/cells")

    def _sharing(self, spark: SparkSession, runs: list[Run]) -> set[int]:
        """Which runs, by place, may share a key with another: those whose key ranges overlap."""
        ranges = [
            spark.read.parquet(f"{r.keys}/range").select(F.lit(n).alias("n"), "low", "high") for n, r in enumerate(runs)
        ]
        a = reduce(DataFrame.unionByName, ranges).where("low is not null")
        b = a.select(F.col("n").alias("m"), F.col("low").alias("low2"), F.col("high").alias("high2"))
        pairs = a.join(b, F.expr("n < m and low <= high2 and low2 <= high")).select("n", "m")
        return {n for pair in pairs.collect() for n in pair}

    def current(self, spark: SparkSession) -> DataFrame:
        """The target as it is after every batch."""
        return self._folded(spark, self._runs(spark)).drop(BATCH)

    def _folded(self, spark: SparkSession, runs: list[Run]) -> DataFrame:
        """The rows of runs that no later one of them replaces, with their batch number."""
        keys = list(self.keys)
        if len(runs) < 2:
            return self._rows(spark, runs)
        if not all(path_exists(spark, r.keys) for r in runs):  # batches of an older log
            return latest_per_key(self._rows(spark, runs), keys, BATCH, oldest=runs[0].last)
        sharing = self._sharing(spark, runs)
        alone = [r for n, r in enumerate(runs) if n not in sharing]
        if not sharing:
            return self._rows(spark, runs)
        oldest, *later = [runs[n] for n in sorted(sharing)]
        cells = spark.read.schema("cell int").parquet(*[f"{r.keys}/cells" for r in later]).distinct()
        cells = cells.withColumnRenamed("cell", CELL)
        base = self._rows(spark, [oldest])
        hit = self._cell() == F.col(CELL)
        # at most CELLS numbers, whatever the batches
        untouched = base.join(F.broadcast(cells), hit, "left_anti")
        touched = base.join(F.broadcast(cells), hit, "left_semi")
        changes = touched.unionByName(self._rows(spark, later))
        out = untouched.unionByName(latest_per_key(changes, keys, BATCH, oldest=oldest.last))
        return out.unionByName(self._rows(spark, alone)) if alone else out

    def merge(self, spark: SparkSession, first: int, last: int) -> None:
        """Make one run of all batches from ``first`` to ``last``, in place; they stay until ``vacuum``."""
        runs = [r for r in self._runs(spark) if first <= r.last and r.first <= last]
        if not runs or runs[0].first < first or runs[-1].last > last:
            raise ValueError(f"batches {first} to {last} are not a row of whole runs")
        mark = uuid.uuid4().hex[:12]
        first, last = runs[0].first, runs[-1].last
        folder, keys = f"{self.path}/{BATCH}={last}/{TRY}=m{mark}", f"{self.path}/_keys/m{first}-{last}-{mark}"
        self._folded(spark, runs).drop(BATCH).write.parquet(folder)
        self._keep_keys(spark, folder, keys)
        make_folder(spark, f"{self.path}/_merges/{first}-{last}-{mark}")

    def tidy(self, spark: SparkSession, fanout: int = FANOUT) -> int:
        """Merge adjacent runs of one tier, ``fanout`` at a time, until none are left; returns the number of merges.

        The tier of a run is the power of ``fanout`` its batches make up, so a row is rewritten once per tier.  The oldest
        batch is left alone.
        """

        def tier(run: Run) -> int:
            n, t = run.batches, 0
            while n >= fanout:
                n, t = n // fanout, t + 1
            return t

        merges = 0
        while True:
            runs = self._runs(spark)[1:]
            for i in range(len(runs) - fanout, -1, -1):
                some = runs[i : i + fanout]
                if len({tier(r) for r in some}) == 1:
                    self.merge(spark, some[0].first, some[-1].last)
                    merges += 1
                    break
            else:
                return merges

    def vacuum(self, spark: SparkSession) -> int:
        """Delete the folders that reading does not need: merged batches, older attempts, what was cut off.

        Returns how many.  Nobody may be reading or writing the log meanwhile.
        """
        needed = {x for r in self._runs(spark) for x in (r.folder, r.keys)}
        found = [f"{self.path}/_keys/{n}" for n in child_names(spark, f"{self.path}/_keys")]
        for name in child_names(spark, self.path):
            if name.startswith(f"{BATCH}="):
                found += [f"{self.path}/{name}/{n}" for n in child_names(spark, f"{self.path}/{name}")]
        gone = [f for f in found if f not in needed]
        for f in gone:
            remove_folder(spark, f)
        return len(gone)

    def write(self, rows: DataFrame, batch: int, mark: str | None = None) -> None:
        """Write one batch; its largest mark is observed by the same job and kept beside the log."""
        spark = rows.sparkSession
        if any(r.batches > 1 and r.first <= batch <= r.last for r in self._runs(spark)):
            raise ValueError(f"batch {batch} is merged with others")
        self._keep_schema(rows)
        attempt = self._records(spark, "_started").get(batch, -1) + 1
        make_folder(spark, f"{self.path}/_started/{batch}.{attempt}")
        if mark is None:
            rows.write.mode("error").parquet(self._folder(batch, attempt))
        else:
            seen = Observation()
            of = rows.schema[mark].dataType
            zoned = isinstance(of, T.TimestampType)  # goes as a number: a Python time has hours that come twice
            newest = F.max(F.unix_micros(column(mark)) if zoned else column(mark))
            observed = rows.observe(seen, newest.alias("mark"))
            observed.write.mode("error").parquet(self._folder(batch, attempt))
            schema = T.StructType([T.StructField("mark", T.LongType() if zoned else of)])
            kept = spark_row(spark, [(seen.get["mark"],)], schema)
            if zoned:
                kept = kept.select(F.timestamp_micros("mark").alias("mark"))
            kept.write.mode("overwrite").parquet(f"{self._marks(mark)}/{batch}.{attempt}")
        self._keep_keys(spark, self._folder(batch, attempt), f"{self.path}/_keys/{batch}.{attempt}")
        make_folder(spark, f"{self.path}/_commits/{batch}.{attempt}")

    def _marks(self, mark: str) -> str:
        return f"{self.path}/_marks/{mark}"

    def _kept_marks(self, spark: SparkSession, mark: str) -> DataFrame | None:
        """One column: the kept marks of the batches, and the marks in the rows of batches without."""
        commits = self._commits(spark)
        names = set(child_names(spark, self._marks(mark)))
        known = {b: f"{b}.{k}" for b, k in commits.items() if f"{b}.{k}" in names}
        found = []
        if known:
            found.append(spark.read.parquet(*[f"{self._marks(mark)}/{n}" for n in known.values()]))
        rest = sorted(set(commits) - set(known))
        if rest:
            found.append(self.read(spark, rest).select(column(mark).alias("mark")))
        return found[0].unionByName(found[1]) if len(found) > 1 else found[0] if found else None

    def high_water_mark(self, spark: SparkSession, mark: str):
        """The largest mark of all batches, or None."""
        marks = self._kept_marks(spark, mark)
        return None if marks is None else marks.agg(F.max("mark")).first()[0]

    def load(self, spark: SparkSession, source: DataFrame, mark: str | None = None, inclusive: bool = True) -> int:
        """Add one batch: everything on a first load, afterwards the rows from the mark on.

        Rows at the mark and rows without one are taken again and replaced by their keys, so that none is
        missed when several share the newest mark or get it late.  ``inclusive=False`` leaves both out.  Rows
        with a NULL in the key can't be replaced and are added again each time.
        """
        batch = self._next_batch(spark)
        if mark and self.batches(spark):
            # one value, pushed to the source as a literal
            newest = mark_literal(self._kept_marks(spark, mark), source.schema[mark].dataType)
            source = after(source, mark, newest, inclusive)
        self.write(source, batch, mark)
        return batch

    def _epochs(self, spark: SparkSession, stream: str | None = None) -> dict[tuple[str, int], int]:
        """The batch number given to each epoch of a stream, or of all, kept as folder names."""
        found = {}
        for name in [stream] if stream else child_names(spark, f"{self.path}/_streams"):
            for epoch_batch in child_names(spark, f"{self.path}/_streams/{name}"):
                epoch, batch = map(int, epoch_batch.split("-"))
                found[name, epoch] = batch
        return found

    def _next_batch(self, spark: SparkSession) -> int:
        return max([-1, *self._records(spark, "_started"), *self._epochs(spark).values()]) + 1

    def compact(self, spark: SparkSession, path: str) -> "ChangeLog":
        """A new log whose only batch is the current state."""
        folded = ChangeLog(path, self.keys)
        folded.write(self.current(spark), 0)
        return folded

    def apply_epoch(self, rows: DataFrame, epoch: int, checkpoint: str) -> None:
        """Write an epoch of a stream; one that comes again replaces itself."""
        spark = rows.sparkSession
        name = hashlib.md5(checkpoint.encode()).hexdigest()[:16]
        batch = self._epochs(spark, name).get((name, epoch))
        if batch is None:
            batch = self._next_batch(spark)
            make_folder(spark, f"{self.path}/_streams/{name}/{epoch}-{batch}")
        elif any(r.batches > 1 and r.first <= batch <= r.last for r in self._runs(spark)):
            return  # the epoch was committed, and merged since
        self.write(rows, batch)

    def follow(self, stream: DataFrame, checkpoint: str):
        """Write a stream's micro-batches into the log until its available input is used up.

        An epoch keeps the batch number it got first, so an epoch that runs again replaces itself.
        """
        def write(rows: DataFrame, epoch: int) -> None:
            self.apply_epoch(rows, epoch, checkpoint)

        writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        return query


def spark_row(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A one-row table in one file."""
    return spark.createDataFrame(rows, schema).coalesce(1)
