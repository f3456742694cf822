"""Deletes from a folder of Parquet files by place: lists of (file, row) instead of new files.

A keyed delete of a few rows need not rewrite a large table.  The rows to delete are found by a join of the key
columns alone and noted by file and row number; reading leaves them out, and files without such rows are read as they
are, without a join.  Where a file has lost a large share of its rows, ``rewrite`` replaces that file and no other.

Every change counts from the moment its record, an empty folder, is there: what a cut-off job left is never read.
One writer at a time; files may be added to the folder by appends meanwhile.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transferkit.operators.incremental import _distinct_keys, _no_nulls
from transferkit.session import child_names, make_folder, remove_file, remove_folder
from transferkit.types import column

FILE, ROW = "transferkit_file", "transferkit_row"
# Files named in a condition, which Spark uses to leave files out; with more of them all rows go through the join.
NAMED_FILES = 2_000


@dataclass(frozen=True)
class PlacedTable:
    path: str

    def _records(self, spark: SparkSession, kind: str) -> list[str]:
        return sorted(child_names(spark, f"{self.path}/_{kind}"))

    def _files(self, spark: SparkSession) -> DataFrame:
        """All rows with their places: the folder's files and those of rewrites, without the files these replace."""
        done = self._records(spark, "rewritten")
        rows = spark.read.parquet(self.path, *[f"{self.path}/_new/{r}" for r in done])
        # the place as columns: metadata does not go through a join
        placed = rows.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(ROW))
        if not done:
            return placed
        gone = spark.read.parquet(*[f"{self.path}/_replaced/{r}" for r in done]).select(FILE).distinct()
        return self._outside(placed, gone)

    @staticmethod
    def _names(files: DataFrame) -> list[str] | None:
        """File names, if they are few enough to be named in a condition."""
        found = [r[0] for r in files.limit(NAMED_FILES + 1).collect()]
        return found if len(found) <= NAMED_FILES else None

    def _outside(self, placed: DataFrame, files: DataFrame) -> DataFrame:
        names = self._names(files)
        if names is None:
            return placed.join(files, FILE, "left_anti").select(placed.columns)
        return placed.where(~F.col(FILE).isin(names)) if names else placed

    def _deleted(self, spark: SparkSession) -> DataFrame | None:
        lists = set(self._records(spark, "deletes"))
        # an upsert's deletes count with its new files
        done = [r for kind in ("deleted", "rewritten") for r in self._records(spark, kind) if r in lists]
        if not done:
            return None
        return spark.read.schema(f"{FILE} string, {ROW} long").parquet(*[f"{self.path}/_deletes/{r}" for r in done]).distinct()

    def _live(self, spark: SparkSession) -> DataFrame:
        """Rows that are not deleted, with their places."""
        placed, deleted = self._files(spark), self._deleted(spark)
        if deleted is None:
            return placed
        files = deleted.select(FILE).distinct()
        names = self._names(files)
        if names is None:
            return placed.join(deleted, [FILE, ROW], "left_anti").select(placed.columns)
        if not names:
            return placed
        named: Column = F.col(FILE).isin(names)
        left = placed.where(named).join(deleted, [FILE, ROW], "left_anti").select(placed.columns)
        return placed.where(~named).unionByName(left)

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows that are left."""
        return self._live(spark).drop(FILE, ROW)

    def delete(self, spark: SparkSession, keys_df: DataFrame, keys: list[str]) -> None:
        """Delete the rows whose key tuple is among ``keys_df``; a NULL in a key never matches.

        Reads the key columns of the table and writes the places of the rows found, nothing else.
        """
        record = uuid.uuid4().hex
        self._note(spark, keys_df, keys, record)
        make_folder(spark, f"{self.path}/_deleted/{record}")

    def _note(self, spark: SparkSession, keys_df: DataFrame, keys: list[str], record: str) -> None:
        doomed = _distinct_keys(keys_df.where(_no_nulls(keys)), keys)
        places = self._files(spark).select(*[column(k) for k in keys], FILE, ROW).join(doomed, keys, "left_semi")
        places.select(FILE, ROW).write.parquet(f"{self.path}/_deletes/{record}")

    def upsert(self, spark: SparkSession, rows: DataFrame, keys: list[str]) -> None:
        """Delete by the keys of the new rows, then add all of them.

        The new rows are written first, where nothing reads them; they and the deletes count from one record.
        """
        record = uuid.uuid4().hex
        rows.write.parquet(f"{self.path}/_new/{record}")
        new = spark.read.schema(rows.schema).parquet(f"{self.path}/_new/{record}")
        self._note(spark, new.select(*[column(k) for k in keys]), keys, record)
        spark.createDataFrame([], f"{FILE} string").write.parquet(f"{self.path}/_replaced/{record}")
        make_folder(spark, f"{self.path}/_rewritten/{record}")

    def rewrite(self, spark: SparkSession, share: float = 0.2) -> int:
        """Replace the files that lost at least this share of their rows, and only those; returns how many."""
        deleted = self._deleted(spark)
        if deleted is None:
            return 0
        lost = deleted.groupBy(FILE).agg(F.count("*").alias("lost"))
        held = self._files(spark).groupBy(FILE).agg(F.count("*").alias("held"))
        thin = held.join(lost, FILE).where(F.col("lost") >= F.col("held") * share).select(FILE)
        record = uuid.uuid4().hex
        thin.write.parquet(f"{self.path}/_replaced/{record}")
        thin = spark.read.schema(f"{FILE} string").parquet(f"{self.path}/_replaced/{record}")
        n = thin.count()
        if n:
            names = self._names(thin)
            live = self._live(spark)
            rows = live.where(F.col(FILE).isin(names)) if names else live.join(thin, FILE, "left_semi")
            rows.drop(FILE, ROW).write.parquet(f"{self.path}/_new/{record}")
            make_folder(spark, f"{self.path}/_rewritten/{record}")
        return n

    def vacuum(self, spark: SparkSession) -> int:
        """Remove replaced files and what cut-off jobs left; returns how many files and folders.

        Nobody may be reading or writing the table meanwhile.
        """
        done = set(self._records(spark, "rewritten")) | set(self._records(spark, "deleted"))
        left = [(k, n) for k in ("new", "replaced", "deletes") for n in self._records(spark, k) if n not in done]
        for kind, name in left:
            remove_folder(spark, f"{self.path}/_{kind}/{name}")
        rewritten = self._records(spark, "rewritten")
        gone = []
        if rewritten:
            files = spark.read.parquet(*[f"{self.path}/_replaced/{r}" for r in rewritten]).distinct()
            gone = [r[0] for r in files.toLocalIterator()]
        return len(left) + sum(remove_file(spark, f) for f in gone)
