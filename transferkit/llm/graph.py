"""Connected components by contraction, with tables in the shared folder between rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transferkit.llm.tables import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``a, b``: the label is one node of its component.

    Each round points every node at its smallest neighbour, shortens the pointers by jumping, and contracts
    the edges; a round at least halves the nodes of every component that is not done.
    """
    edges = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    labels = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label"))
        to = _shortened(stored(to, "pointers"))
        if labels is None:
            labels = to
        else:
            step = to.select(F.col("node").alias("label"), F.col("label").alias("next"))
            labels = stored(labels.join(step, "label", "left").select("node", F.coalesce("next", "label").alias("label")), "labels")
        left = to.select(F.col("node").alias("a"), F.col("label").alias("la"))
        right = to.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        rest = edges.join(left, "a").join(right, "b").where("la <> lb")
        edges = stored(rest.select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct(), "edges")
        if edges.isEmpty():
            return labels


def _shortened(to: DataFrame) -> DataFrame:
    """Every pointer leads to the end of its chain."""
    while True:
        end = to.select(F.col("node").alias("label"), F.col("label").alias("next"))
        moved = to.join(end, "label").select("node", F.col("next").alias("label"), (F.col("next") != F.col("label")).alias("moved"))
        moved = stored(moved, "pointers")
        to = moved.select("node", "label")
        if moved.where("moved").isEmpty():
            return to
