"""Session matters: the shared folder for staged data, and path checks."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
# Folders named by this process, for ``remove_workspaces``.
_workspaces: list[str] = []


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder name for staged files, under the shared folder the cluster names.

    Every executor must reach it, so a machine-local folder serves only a local session that names none.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        root = tempfile.gettempdir()
    path = f"{root.rstrip('/')}/transferkit/{name}-{uuid.uuid4().hex[:12]}"
    _workspaces.append(path)
    return path


def remove_workspaces(spark: SparkSession, since: int = 0) -> int:
    """Delete the folders that ``workspace`` has named, after the first ``since``; returns how many there were.

    For the end of a job: tables that read from such folders, as results of numbered or stored rows do, are gone then.
    """
    gone = [p for p in _workspaces[since:] if path_exists(spark, p)]
    for p in gone:
        remove_folder(spark, p)
    del _workspaces[since:]
    return len(gone)


@contextmanager
def staging(spark: SparkSession):
    """Folders named inside are deleted at the end of the block, also after an error."""
    before = len(_workspaces)
    try:
        yield
    finally:
        remove_workspaces(spark, before)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on the file system it names."""
    hadoop_path, fs = _file_system(spark, path)
    return fs.exists(hadoop_path)


@contextmanager
def few_listing_tasks(spark: SparkSession):
    """Folders read inside are listed by some tasks per core; by default Spark takes a task for every folder below."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def larger_than_a_split(spark: SparkSession, path: str) -> bool:
    """Whether a file under a path is longer than what Spark gives to one task; only lengths are read."""
    with few_listing_tasks(spark):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    most = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return (files.agg(F.max("length")).first()[0] or 0) > most


def is_folder(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _file_system(spark, path)
    return fs.exists(hadoop_path) and fs.getFileStatus(hadoop_path).isDirectory()


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files under a folder; only lengths are read."""
    hadoop_path, fs = _file_system(spark, path)
    return fs.getContentSummary(hadoop_path).getLength()


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; none where there is no folder."""
    hadoop_path, fs = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return [s.getPath().getName() for s in fs.listStatus(hadoop_path)]


def file_paths(spark: SparkSession, path: str) -> list[str]:
    """Paths, from a folder on, of the files in it and in folders below; hidden ones and their folders are left out.

    One call lists a folder, and its entries say what they are: rolled files have a folder each.
    """
    hadoop_path, fs = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        return []
    found, folders = [], [("", hadoop_path)]
    while folders:
        above, folder = folders.pop()
        for status in fs.listStatus(folder):
            below = status.getPath()
            name = below.getName()
            if name.startswith(("_", ".")):
                continue
            if status.isDirectory():
                folders.append((f"{above}{name}/", below))
            else:
                found.append(above + name)
    return sorted(found)


def make_folder(spark: SparkSession, path: str) -> None:
    hadoop_path, fs = _file_system(spark, path)
    fs.mkdirs(hadoop_path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder made for one job, with what is in it."""
    hadoop_path, fs = _file_system(spark, path)
    fs.delete(hadoop_path, True)


def remove_file(spark: SparkSession, uri: str) -> bool:
    """Delete a file that Spark's metadata names; False if it is gone already."""
    hadoop_path, fs = _file_system(spark, spark._jvm.java.net.URI(uri))
    return fs.delete(hadoop_path, False)


def _file_system(spark: SparkSession, path):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

