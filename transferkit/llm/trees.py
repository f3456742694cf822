"""Reply trees: root-to-leaf paths by iterative self-joins, ranked by score.

Only numbers travel here, never texts.  A pointer leads from every message to the one it answers; each round joins the
pointers with themselves and doubles their reach, so a thread of n turns takes log2(n) rounds.  The same
pointers, from the longest down, then lay out the messages of the chosen branches.  Messages are joined by number,
so no thread or tree has to fit one task; a message that very many answer is a hot key, which AQE's skew join splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transferkit.llm.tables import discard, stored

# Documented layout of monotonically_increasing_id: the partition above, the row below.
ROW_BITS = 33


def message_keys(*columns: Column) -> list[Column]:
    """128 bits of a message's content that name it in the tables of links."""
    return [F.xxhash64(*columns).alias("k1"), F.xxhash64(F.lit(1), *columns).alias("k2")]


def thread_links(rows: DataFrame, order: list[str]) -> DataFrame:
    """Links ``no, parent, score, tree, k1, k2`` of threads without reply ids: each row of ``tree`` answers the row before.

    Rows are numbered by one range sort of ``tree``, the ``order`` columns and the keys, so rows that tie stand
    next to each other by content.  Equal rows are one link.
    """
    keys = ["tree", *order, "k1", "k2"]
    numbered = rows.select(*keys).distinct().repartitionByRange(*keys).sortWithinPartitions(*keys)
    numbered = stored(numbered.withColumn("no", F.monotonically_increasing_id()), "thread_rows")
    # the row before the first of a partition is the last of the one before: one number per partition
    part = F.shiftright("no", ROW_BITS).alias("part")
    lasts = sorted(tuple(r) for r in numbered.groupBy(part).agg(F.max("no")).collect())
    firsts = [(p << ROW_BITS, before) for (p, _), (_, before) in zip(lasts[1:], lasts)]
    borders = rows.sparkSession.createDataFrame(firsts, "no long, border long")
    before = numbered.join(F.broadcast(borders), "no", "left")
    inner = F.when(F.col("no").bitwiseAND((1 << ROW_BITS) - 1) > 0, F.col("no") - 1)
    before = before.withColumn("before", F.coalesce("border", inner))
    other = numbered.select(F.col("no").alias("before"), F.col("tree").alias("other"))
    # a null number joins nothing and must not gather in one task
    linked = before.where("before is not null").join(other, "before", "left")
    same = F.when(F.col("tree").eqNullSafe(F.col("other")), F.col("before"))
    linked = linked.select("no", same.alias("parent"), "tree", "k1", "k2")
    first = before.where("before is null").select("no", F.lit(None).cast("long").alias("parent"), "tree", "k1", "k2")
    links = linked.unionByName(first).withColumn("score", F.lit(0.0))
    return stored(links.select("no", "parent", "score", "tree", "k1", "k2"), "links")


def reply_links(rows: DataFrame) -> DataFrame:
    """Links of messages ``id, parent_id, score, k1, k2``; ``tree`` is the message's own id.

    Equal rows are one link.  Of messages that share an id one has the answers; an answer to no known message
    starts a tree of its own.
    """
    numbered = rows.select("id", "parent_id", "score", "k1", "k2").distinct()
    numbered = stored(numbered.withColumn("no", F.monotonically_increasing_id()), "messages")
    named = numbered.where("id is not null").groupBy(F.col("id").alias("parent_id")).agg(F.min("no").alias("parent"))
    answers = numbered.where("parent_id is not null").join(named, "parent_id", "left")
    starts = numbered.where("parent_id is null").withColumn("parent", F.lit(None).cast("long"))
    links = answers.unionByName(starts).withColumn("score", F.coalesce(F.col("score").cast("double"), F.lit(0.0)))
    return stored(links.select("no", "parent", "score", F.col("id").alias("tree"), "k1", "k2"), "links")


def _doubled(links: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Pointers of reach 1, 2, 4, ... and every message's root, number of steps to it and sum of scores on the way.

    Messages whose pointers run in a circle reach no root and are not in the second table.
    """
    n = links.count()
    first = F.when(F.col("parent").isNull(), F.col("no"))
    steps = F.when(F.col("parent").isNull(), 0).otherwise(1).cast("long")
    state = stored(
        links.select("no", F.col("parent").alias("jump"), steps.alias("steps"), F.col("score").alias("total"), first.alias("root")),
        "pointers",
    )
    levels = []
    while True:
        active = state.where("jump is not null")
        if active.isEmpty() or 1 << len(levels) > n:
            return levels, state.where("jump is null")
        levels.append(state)
        beyond = state.select(
            F.col("no").alias("jump"),
            F.col("jump").alias("jump2"),
            F.col("steps").alias("steps2"),
            F.col("total").alias("total2"),
            F.col("root").alias("root2"),
        )
        moved = active.drop("root").join(beyond, "jump").select(
            "no",
            F.col("jump2").alias("jump"),
            (F.col("steps") + F.col("steps2")).alias("steps"),
            (F.col("total") + F.col("total2")).alias("total"),
            F.col("root2").alias("root"),
        )
        state = stored(moved.unionByName(state.where("jump is null")), "pointers")


def reply_paths(links: DataFrame, top: int | None = 1) -> DataFrame:
    """Messages of the chosen root-to-leaf paths: ``path`` (the leaf's number), ``root``, ``rank``, ``position``, ``no``.

    Branches of a root rank by the mean score of their messages, highest first, then the longer, then the smaller number
    of the leaf; the first ``top`` are chosen, or all.  Messages in a circle of replies, and those that hang on one, are
    on no path.
    """
    levels, ends = _doubled(links)
    parents = links.where("parent is not null").select(F.col("parent").alias("no")).distinct()
    leaves = ends.join(parents, "no", "left_anti")
    mean = F.col("total") / (F.col("steps") + 1)
    order = Window.partitionBy("root").orderBy(mean.desc(), F.desc("steps"), "no")
    leaves = leaves.withColumn("rank", F.row_number().over(order))
    if top is not None:
        leaves = leaves.where(F.col("rank") <= top)
    paths = leaves.select(F.col("no").alias("path"), "root", "rank", F.col("steps").alias("position"), "no")
    for k in range(len(levels) - 1, -1, -1):
        jumps = levels[k].where("jump is not null").select("no", "jump")
        here = F.struct("no", "position")
        there = F.when(F.col("jump").isNotNull(), F.struct(F.col("jump").alias("no"), (F.col("position") - (1 << k)).alias("position")))
        both = paths.join(jumps, "no", "left").select("path", "root", "rank", F.explode(F.array_compact(F.array(here, there))).alias("x"))
        paths = both.select("path", "root", "rank", "x.position", "x.no")
    paths = stored(paths, "paths")
    for level in levels:
        discard(level)
    return paths
