"""One running number over all rows of a table, without a window over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transferkit.session import workspace
from transferkit.types import column

# monotonically_increasing_id has the partition above these bits and the row in it below
ROW_BITS = 33


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """The rows with their place, from 0, in the order of some columns; ties in any order.

    Rows are range-partitioned and sorted where they land; a place is the row's place in its partition and the size of
    the partitions before, of which one number each goes through the driver.  The sorted rows are kept in the shared
    folder, so that a task that runs again finds the same places.
    """
    spark, keys = rows.sparkSession, [column(c) for c in order]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(name, F.monotonically_increasing_id())
    path = workspace(spark, "numbered")
    placed.write.parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path)
    part = F.shiftright(column(name), ROW_BITS)
    sizes = sorted(tuple(r) for r in placed.groupBy(part.alias("part")).agg(F.count("*")).collect())
    starts, total = [], 0
    for p, n in sizes:
        starts.append((p, total))
        total += n
    offsets = spark.createDataFrame(starts, "_part long, _start long")
    place = F.col("_start") + column(name).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    joined = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return joined.select(*[place.alias(name) if c == name else column(c) for c in placed.columns])
