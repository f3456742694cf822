"""Mixing sources to target weights: block quotas dealt to shards by a hypergeometric splitting tree.

Every source is cut into blocks by a hash of the document id.  A source's target is drawn as whole passes over
its blocks and part of one more pass in permuted order.  The draws of all sources are split in two, again and
again, until every shard has its exact quota of each source's draws.  Only a row per block, source or shard is
gathered; documents fall to blocks, draws and shards by expressions over those small tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transferkit.llm.tables import sized, stored
from transferkit.llm.words import text_of, tokens

WEIGHTS = (5.0, 2.0, 1.0)
MOST_PASSES = 3
SHARDS = 16
# Blocks hold about so many words, more only where that would make more than so many blocks.
BLOCK_WORDS = 50_000
MOST_BLOCKS = 8_192
# A shard is spread over tasks in so many slices.
SLICES = 4


def _hash(*parts: str | Column) -> Column:
    """A number below 2^60 that any engine can compute: the start of an MD5."""
    text = F.concat_ws("|", *[p if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_PASSES) -> DataFrame:
    """``source, source_size`` with ``source_no`` and ``target``.

    Sources take the weights in turn, by code point with null last.  Resharing excess until no source is above
    ``most`` times its size ends at min(most * size, weight * level), where the first source that stays below
    its cap, in the order of cap to weight, sets the level.
    """
    s = sources.select(
        "*", (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1).alias("source_no")
    )
    s = s.select(
        "*",
        F.get(F.array(*map(F.lit, weights)), F.col("source_no") % len(weights)).alias("weight"),
        (most * F.col("source_size")).cast("double").alias("cap"),
        F.sum("source_size").over(Window.partitionBy()).alias("total"),
    )
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    full = F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing))
    s = s.select("*", ((F.col("total") - full) / rest).alias("level"))
    low = F.when(F.col("cap") >= F.col("weight") * F.col("level"), F.col("level"))
    s = s.select("*", F.first(low, True).over(fill.rowsBetween(Window.unboundedPreceding, 0)).alias("set"))
    target = F.when(F.col("set").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("weight") * F.col("set")))
    return s.select("source", "source_no", "source_size", "total", target.alias("target"))


# One by one, each of a source's draws goes left with the chance (places free on the left) / (draws not yet
# dealt): sampling without replacement, so a node's counts are multivariate hypergeometric and both halves exact.
_DEAL = """
aggregate(quotas, named_struct('rest', n, 'room', room, 'got', cast(array() as array<bigint>)),
  (s, q) -> aggregate(if(q.draws > 0, sequence(1L, q.draws), cast(array() as array<bigint>)),
    named_struct('rest', s.rest, 'room', s.room, 'got', s.got, 'x', 0L),
    (a, j) -> if(pmod(xxhash64(first, width, q.source_no, j), 1000003L) * a.rest < a.room * 1000003L,
      named_struct('rest', a.rest - 1L, 'room', a.room - 1L, 'got', a.got, 'x', a.x + 1L),
      named_struct('rest', a.rest - 1L, 'room', a.room, 'got', a.got, 'x', a.x)),
    a -> named_struct('rest', a.rest, 'room', a.room, 'got', concat(a.got, array(a.x)))),
  s -> s.got)"""


def deal(quotas: DataFrame, shards: int) -> DataFrame:
    """``source_no, ends``: where, among a source's draws, each shard's part ends.

    ``quotas`` has a row per source: ``source_no, draws``.  A tree node is a range of shards with the draws of
    each source; it is split until it is one shard.
    """
    node = quotas.groupBy().agg(F.sort_array(F.collect_list(F.struct("source_no", "draws"))).alias("quotas"))
    node = node.selectExpr("0L as first", f"{shards}L as width", "quotas")
    for _ in range((shards - 1).bit_length()):
        node = node.selectExpr("*", "width div 2 as half", "aggregate(quotas, 0L, (s, q) -> s + q.draws) as n")
        node = node.selectExpr("*", "n * half div width as room").selectExpr("*", f"{_DEAL} as got")
        node = node.selectExpr(
            """explode(filter(array(
                named_struct('first', first, 'width', half, 'quotas', transform(quotas, (q, i) ->
                  named_struct('source_no', q.source_no, 'draws', got[i]))),
                named_struct('first', first + half, 'width', width - half, 'quotas', transform(quotas, (q, i) ->
                  named_struct('source_no', q.source_no, 'draws', q.draws - got[i])))), c -> c.width > 0)) as c"""
        ).select("c.*")
    leaf = node.select(F.col("first").alias("shard"), F.inline("quotas"))
    end = F.sum("draws").over(Window.partitionBy("source_no").orderBy("shard"))
    leaf = leaf.select("source_no", F.struct("shard", end.alias("end")).alias("e"))
    return leaf.groupBy("source_no").agg(F.sort_array(F.collect_list("e")).alias("e")).select("source_no", "e.end")


def _plan(sizes: DataFrame, weights, most: int, shards: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Per source its target, passes, blocks and edge; per block its place in the source's permuted order.

    ``sizes``: stored rows of ``id, source, size``.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = targets(sources, weights, most)
    block_words = F.greatest(F.lit(BLOCK_WORDS), F.ceil(F.col("total") / MOST_BLOCKS))
    sources = sources.select(
        "*",
        F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)).cast("long").alias("n_blocks"),
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
        .otherwise(0)
        .cast("long")
        .alias("passes"),
    )
    sources = sources.select("*", (F.col("target") - F.col("passes") * F.col("source_size")).alias("part"))
    sources = sized(sources, "mix_sources")
    rows = sizes.join(sources, sizes.source.eqNullSafe(sources.source)).drop(sources.source)
    rows = rows.select("*", (_hash(str(seed), F.col("id")) % F.col("n_blocks")).alias("block"))
    blocks = rows.groupBy("source_no", "block", "part").agg(F.sum("size").alias("words"))
    permuted = Window.partitionBy("source_no").orderBy(_hash(str(seed), "block", F.col("source_no"), F.col("block")), "block")
    blocks = blocks.select(
        "*",
        (F.row_number().over(permuted) - 1).cast("long").alias("rank"),
        F.sum("words").over(permuted.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
    )
    left = F.col("part") - (F.col("upto") - F.col("words"))
    blocks = blocks.select(
        "source_no", "block", "rank", F.when(left > 0, F.when(left < F.col("words"), left)).alias("edge"),
        (left > 0).alias("drawn"),
    )
    blocks = sized(blocks, "mix_blocks")
    # the one block of a source that is drawn in part: its documents in hashed order, up to the target
    edge = blocks.where("edge is not null").select("source_no", "block", "edge")
    at = F.struct(_hash(str(seed), "doc", F.col("id")).alias("h"), "size")
    inside = rows.join(edge, ["source_no", "block"]).select("source_no", "edge", "size", at.alias("at"))
    upto = F.sum("size").over(Window.partitionBy("source_no").orderBy("at"))
    inside = inside.select("source_no", "at", (upto - F.col("size") / 2 <= F.col("edge")).alias("taken"))
    last = inside.where("taken").groupBy("source_no").agg(F.max("at").alias("last"))
    draws = blocks.groupBy("source_no").agg(F.sum(F.col("drawn").cast("long")).alias("more"), F.count("*").alias("b"))
    sources = sources.join(draws, "source_no", "left").join(last, "source_no", "left")
    sources = sources.select(
        "source", "source_no", "source_size", "target", "passes", "n_blocks", "b", "last",
        (F.col("passes") * F.col("b") + F.col("more")).alias("draws"),
    )
    sources = stored(sources, "mix_quotas")
    return sized(sources.join(deal(sources.select("source_no", "draws"), shards), "source_no", "left"), "mix_deal"), blocks


def _drawn(rows: DataFrame, sources: DataFrame, blocks: DataFrame, seed: int) -> DataFrame:
    """Rows with ``id, source, size`` get their source's figures and ``shards``: where each of their draws goes."""
    rows = rows.join(sources, rows.source.eqNullSafe(sources.source)).drop(sources.source)
    rows = rows.select("*", (_hash(str(seed), F.col("id")) % F.col("n_blocks")).alias("block"))
    rows = rows.join(blocks, ["source_no", "block"])
    at = F.struct(_hash(str(seed), "doc", F.col("id")).alias("h"), "size")
    again = F.col("drawn") & (F.col("edge").isNull() | F.coalesce(at <= F.col("last"), F.lit(False)))
    passes = F.col("passes") + again.cast("long")
    turns = F.when(passes > 0, F.sequence(F.lit(0).cast("long"), passes - 1)).otherwise(
        F.array().cast("array<bigint>")
    )
    draws = F.transform(turns, lambda p: p * F.col("b") + F.col("rank"))
    return rows.select("*", F.transform(draws, lambda d: F.size(F.filter("end", lambda e: e <= d))).alias("shards"))


def _columns(row: Column, id_col: str, text_col: str, source_col: str) -> list[Column]:
    """``id, source, size`` of a row."""
    return [
        F.coalesce(row[id_col].cast("string"), F.lit("")).alias("id"),
        row[source_col].alias("source"),
        F.size(tokens(text_of(row[text_col]))).cast("long").alias("size"),
    ]


def mixture(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    most: int = MOST_PASSES,
    shards: int = SHARDS,
    seed: int = 7,
) -> DataFrame:
    """Per input row: its size, its source's size and target, the words taken of it, and the shards they go to.

    A null or empty text has size 0, and nothing is taken of it; null is a source like another; a source
    without words has target 0.  Rows that share an id fall to one block; equal rows are taken alike.  Other
    columns are not read.
    """
    rows = docs.select(F.struct(id_col, text_col, source_col).alias("row"))
    rows = rows.select(F.col("row")[id_col].alias("doc"), *_columns(F.col("row"), id_col, text_col, source_col))
    rows = stored(rows, "mix_sizes")
    sources, blocks = _plan(rows.drop("doc"), weights, most, shards, seed)
    return _drawn(rows, sources, blocks, seed).select(
        F.col("doc").alias(id_col), "size", "source_size", "target",
        (F.col("size") * F.size("shards")).alias("taken"), F.filter("shards", lambda s: F.col("size") > 0).alias("shards"),
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    most: int = MOST_PASSES,
    shards: int = SHARDS,
    seed: int = 7,
) -> DataFrame:
    """The mix itself: the input's columns once per draw, with ``mix_shard`` and ``mix_position``.

    Shards lie together and in hashed order; input columns of those two names give way.  Texts without words
    are in no shard.
    """
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    parts = _columns(F.col("row"), id_col, text_col, source_col)
    sources, blocks = _plan(stored(whole.select(*parts), "mix_sizes"), weights, most, shards, seed)
    rows = _drawn(whole.select("row", *parts), sources, blocks, seed)
    drawn = F.filter("shards", lambda s: F.col("size") > 0)
    rows = rows.select("row", "id", F.posexplode(drawn).alias("copy", "mix_shard"))
    rows = rows.select("row", "mix_shard", _hash(str(seed), "position", F.col("id"), F.col("copy")).alias("mix_position"))
    rows = rows.repartition(F.col("mix_shard"), F.col("mix_position") % SLICES)
    rows = rows.sortWithinPartitions("mix_shard", "mix_position")
    names = [c for c in docs.columns if c not in ("mix_shard", "mix_position")]
    return rows.select(*[F.col("row")[c].alias(c) for c in names], "mix_shard", "mix_position")
