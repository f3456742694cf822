"""Cut points and joins whose small side is measured first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transferkit.session import workspace

# Rows, and bytes as stored, up to which a measured side is broadcast; beyond either both sides are shuffled by
# the key.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 16 << 20


# Spark's setting: a query's shuffle files go when it ends, not when its plan is collected as garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, compression: str = "snappy", cleanup: bool = False) -> DataFrame:
    """The rows as a Parquet table in the shared folder: computed once, safe when executors are lost.

    ``cleanup``: the shuffles that made it are removed as soon as it is written.
    """
    spark = df.sparkSession
    path, before = workspace(spark, name), spark.conf.get(CLEANUP, None)
    if cleanup:
        spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path, compression=compression)
    finally:
        if cleanup:
            spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def _place(df: DataFrame):
    """Folder and file system of a stored table; None if it has no files."""
    spark, files = df.sparkSession, df.inputFiles()
    if not files:
        return None
    folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
    return folder, folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def discard(df: DataFrame) -> None:
    """Delete the files of a stored table that nothing reads any more."""
    if place := _place(df):
        place[1].delete(place[0], True)


def sized(df: DataFrame, name: str) -> DataFrame:
    """The stored rows, to be broadcast if they are few and small."""
    df = stored(df, name, compression="uncompressed")
    place = _place(df)
    small = df.count() <= BROADCAST_ROWS and (
        place is None or place[1].getContentSummary(place[0]).getLength() <= BROADCAST_BYTES
    )
    return F.broadcast(df) if small else df


def where_computed(df: DataFrame, condition: Column) -> DataFrame:
    """The rows that meet a condition on computed columns, each computed once.

    A plain filter would be pushed below the projection with the columns' expressions written out in it; it is
    not pushed below a column that depends on a row's place.
    """
    place = "_place"
    return df.select("*", F.monotonically_increasing_id().alias(place)).where(condition & (F.col(place) >= 0)).drop(place)
