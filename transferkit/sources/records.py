"""Records of RFC 4180 files, read by as many tasks as the files have splits.

A line end inside quotes does not end a record, so whether a split begins inside a record depends on all that is
before it in the file.  In this format a quote stands only around a field or doubled in it, so a split does nothing to
that state but turn it over once per quote: its effect, for both states it may begin in, is the parity of its
quotes.  One pass counts them per split, a prefix sum over the splits of a file gives the state each begins in,
and the second pass cuts records at the line ends outside quotes.  What a split holds of a record that began before it
is put together afterwards: that is at most one piece at either end of a split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUOTE = '"'
# Kinds of pieces: a whole record; of a record that began in another split the end, or a split's length; the beginning
# of one that goes on in another split.
WHOLE, END, THROUGH, BEGIN = range(4)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the split they begin in; a task has the lines of a split in their order."""
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(path)
    return lines.select(
        "value",
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
    )


def _states(lines: DataFrame) -> DataFrame:
    """For every split with lines whether it begins inside quotes: one row of three numbers each."""
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit(QUOTE), F.lit("")))
    counted = lines.groupBy("file", "split").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    state = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2
    return counted.select("file", "split", state.cast("int").alias("inside"))


def _cutter():
    """The worker's part, as a function that needs no module of this package there."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces of a task's lines: records, and what is left at the ends of its splits."""
        now, inside, begun = None, 0, False  # ``begun``: the open record began in this split
        open_lines: list[str] = []

        def rows(values: list | pa.Array, kind: int) -> pa.RecordBatch:
            n = len(values)
            texts = values if isinstance(values, pa.Array) else pa.array(values, pa.string())
            columns = [texts.cast(pa.string()), *(pa.array(np.full(n, x, t)) for x, t in ((now[0], np.int64), (now[1], np.int64), (kind, np.int32)))]
            return pa.record_batch(columns, names=["value", "file", "split", "kind"])

        def left() -> Iterator[pa.RecordBatch]:
            if open_lines:
                yield rows(["\n".join(open_lines)], BEGIN if begun else THROUGH)

        for batch in batches:
            file, split = (batch.column(c).to_numpy() for c in ("file", "split"))
            edges = np.flatnonzero((file[1:] != file[:-1]) | (split[1:] != split[:-1])) + 1 if len(file) else []
            for i, j in zip([0, *edges], [*edges, len(file)]):
                if i == j:
                    continue
                if now != (file[i], split[i]):
                    yield from left()
                    now, open_lines = (file[i], split[i]), []
                    inside = int(batch.column("inside")[i].as_py())
                    begun = not inside
                lines = batch.column("value").slice(i, j - i)
                quotes = pc.count_substring(lines, QUOTE).to_numpy(zero_copy_only=False)
                after = (inside + np.cumsum(quotes)) % 2
                ends = np.flatnonzero(after == 0)
                inside = int(after[-1])
                if not len(ends):
                    open_lines += lines.to_pylist()
                    continue
                first = 0
                if open_lines or not begun:  # the first record here began before these lines
                    first = ends[0] + 1
                    open_lines += lines.slice(0, first).to_pylist()
                    yield rows(["\n".join(open_lines)], WHOLE if begun else END)
                    open_lines, begun = [], True
                    ends = ends[1:]
                if len(ends):
                    last = ends[-1] + 1
                    offsets = np.r_[0, ends + 1 - first].astype(np.int32)
                    records = pa.ListArray.from_arrays(pa.array(offsets), lines.slice(first, last - first))
                    yield rows(pc.binary_join(records, "\n"), WHOLE)
                    first = last
                open_lines = lines.slice(first).to_pylist()
        yield from left()

    return cut


def records(spark: SparkSession, path: str) -> DataFrame:
    """``value``: the records of all files under a path, without their line ends; a file is read by many tasks.

    Memory of a task holds a batch and one record.  A quoted field that does not end in its file stops the job.
    """
    lines = _lines(spark, path)
    states = F.broadcast(_states(lines))  # three numbers per split, of 128 MB by default
    pieces = lines.join(states, ["file", "split"]).select("value", "file", "split", "inside")
    pieces = pieces.mapInArrow(_cutter(), "value string, file long, split long, kind int")
    whole = pieces.where(F.col("kind") == WHOLE).select("value")
    # at most two pieces per split: a record's other pieces belong to the beginning before them
    parts = pieces.where(F.col("kind") != WHOLE)
    order = Window.partitionBy("file").orderBy("split", "kind").rowsBetween(Window.unboundedPreceding, 0)
    begin = F.last(F.when(F.col("kind") == BEGIN, F.col("split")), ignorenulls=True).over(order)
    grouped = parts.withColumn("begin", begin).groupBy("file", "begin").agg(
        F.array_sort(F.collect_list(F.struct("split", "value"))).alias("pieces"),
        F.max((F.col("kind") == END).cast("int")).alias("ended"),
    )
    broken = F.raise_error(F.lit("a quoted field does not end in its file")).cast("string")
    joined = F.array_join(F.transform("pieces", lambda p: p["value"]), "\n")
    return whole.unionByName(grouped.select(F.when(F.col("ended") == 1, joined).otherwise(broken).alias("value")))
