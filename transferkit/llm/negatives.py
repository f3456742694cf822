"""Hard negatives by exact integer scores: several candidates share one wide integer per component.

Components are whole numbers after scaling.  Less their smallest value they are not negative, so those of
several candidates stand side by side in the fields of one word; a field is as wide as the largest score needs, and a
product with one anchor component multiplies all of them at once.  After the last component every field is one
candidate's score, up to sums that are known for each row.

Anchors are a stated query set: they go to the workers in blocks of bounded bytes, and every block meets all
rows where these lie.  Per block and task only the first few rows of each list are kept and shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transferkit.llm.batches import map_batches
from transferkit.llm.tables import stored
from transferkit.session import workspace

SCALE = 256
# Bytes of anchor components in one block: what a task holds of the query set at once.
BLOCK_BYTES = 8 << 20
# Products worked off at once, of anchors by words.
TILE_ANCHORS, TILE_WORDS = 32, 4096
WORD_BITS = 64


def rows_of(df: DataFrame, id_col: str, vector_col: str, label_col: str, anchor: Column, scale: int) -> DataFrame:
    """``id, label, q, anchor`` of the rows that take part, components as whole numbers."""
    x = F.col(vector_col)
    whole = F.transform(x, lambda v: F.floor(F.lit(scale) * v.cast("double")).cast("long"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    rows = df.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & x.isNotNull() & F.coalesce(fine, F.lit(False)))
    return rows.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("long").alias("label"),
        whole.alias("q"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    )


def field_bits(low: int, high: int, dims: int) -> int:
    """Bits that hold the product sum of any two rows, each less the smallest component."""
    return max(1, (dims * (high - low) ** 2).bit_length())


def pack(q: np.ndarray, low: int, bits: int) -> np.ndarray:
    """Components (row, place) as words (place, word): field ``f`` of word ``w`` is row ``f * words + w``.

    Fields wider than a machine word make Python's integers of any length.
    """
    fields = max(1, WORD_BITS // bits)
    kind = np.uint64 if bits <= WORD_BITS else object
    n_words = -(-len(q) // fields)
    biased = np.zeros((fields * n_words, q.shape[1]), kind)
    biased[: len(q)] = (q.astype(object) - low) if kind is object else (q - low).astype(np.uint64)
    out = np.zeros((n_words, q.shape[1]), kind)
    for f in range(fields):
        part = biased[f * n_words : (f + 1) * n_words]
        out |= part << kind(f * bits) if kind is np.uint64 else part
    return np.ascontiguousarray(out.T)


def scores(anchors: np.ndarray, words: np.ndarray, n: int, sums: np.ndarray, low: int, bits: int) -> np.ndarray:
    """Inner products (anchor, row) of ``n`` packed rows whose components sum to ``sums``."""
    fields, dims = max(1, WORD_BITS // bits), anchors.shape[1]
    kind = words.dtype.type if words.dtype != object else object
    biased = (anchors.astype(object) - low) if kind is object else (anchors - low).astype(np.uint64)
    n_words = words.shape[1]
    out = np.zeros((len(anchors), fields * n_words), object if kind is object else np.int64)
    mask = (1 << bits) - 1
    for i in range(0, len(anchors), TILE_ANCHORS):
        for j in range(0, n_words, TILE_WORDS):
            a, w = biased[i : i + TILE_ANCHORS], words[:, j : j + TILE_WORDS]
            total = np.zeros((len(a), w.shape[1]), w.dtype)
            for d in range(dims):  # one product per component, for all fields
                total += a[:, d, None] * w[d]
            for f in range(fields):
                field = total if kind is object else (total >> np.uint64(f * bits)) & np.uint64(mask)
                out[i : i + len(a), f * n_words + j : f * n_words + j + w.shape[1]] = field
    out = out[:, :n]
    # sum (a - low)(c - low) = sum ac - low (sum a + sum c) + dims low^2
    out += low * anchors.sum(axis=1, dtype=out.dtype)[:, None]
    out += (low * sums - dims * low * low)[None, :].astype(out.dtype)
    return out.astype(np.int64)  # fails where a score has more than 64 bits


def first_of_each(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` entries of every group: higher scores first, then smaller ids."""
    order = np.lexsort((ids, -score, group))
    g = group[order]
    start = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, int)
    rank = np.arange(len(g)) - np.repeat(start, np.diff(np.r_[start, len(g)]))
    return order[rank < k]


class _Kept:
    """The first ``k`` (score, id) of every group so far."""

    def __init__(self, k: int, groups: int):
        self.k, self.limit = k, 4 * k * max(groups, 1000)
        self.parts: list[tuple] = []
        self.size = 0

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        at = first_of_each(group, score, ids, self.k)
        self.parts.append((group[at], score[at], ids[at]))
        self.size += len(at)
        if self.size > self.limit:
            self.shrink()

    def shrink(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return (np.zeros(0, np.int64),) * 3
        group, score, ids = (np.concatenate(x) for x in zip(*self.parts))
        at = first_of_each(group, score, ids, self.k)
        self.parts = [(group[at], score[at], ids[at])]
        self.size = len(at)
        return self.parts[0]


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, labels and components of the rows of each vector length."""
    ids = batch.column("id").to_numpy(zero_copy_only=False)
    labels = batch.column("label").to_numpy(zero_copy_only=False)
    q = batch.column("q")
    flat = q.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths := q.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
    for n in np.unique(lengths):
        mine = np.flatnonzero(lengths == n)
        yield ids[mine], labels[mine], flat[(ends[mine] - n)[:, None] + np.arange(n)]


def _tiles(anchors: dict, batch: pa.RecordBatch, low: int, bits: int, same: bool) -> Iterator[tuple]:
    """Scores of a batch's rows with the anchors of their length: of equal label only, or of another only."""
    for ids, labels, q in _by_length(batch):
        known = anchors.get(q.shape[1])
        if known is None:
            continue
        for label in np.unique(labels):
            meets = np.flatnonzero((known["label"] == label) == same)
            mine = np.flatnonzero(labels == label)
            if not len(meets):
                continue
            words, sums = pack(q[mine], low, bits), q[mine].sum(axis=1)
            for i in range(0, len(meets), 8 * TILE_ANCHORS):
                rows = meets[i : i + 8 * TILE_ANCHORS]
                yield known["no"][rows], known["id"][rows], ids[mine], scores(known["q"][rows], words, len(mine), sums, low, bits)


def _blocks(anchors: DataFrame, low: int, bits: int) -> Iterator[dict]:
    """The anchors, some megabytes at a time, by vector length."""
    size = anchors.agg(F.count("*"), F.sum(F.size("q") + 4)).first()
    n_blocks = max(1, -(-(size[1] or 0) * 8 // BLOCK_BYTES))
    for block in range(n_blocks if size[0] else 0):
        table = anchors.where(F.pmod(F.xxhash64("no"), F.lit(n_blocks)) == block).toArrow()
        out: dict[int, dict] = {}
        for batch in table.combine_chunks().to_batches():
            no = batch.column("no").to_numpy(zero_copy_only=False)
            numbered = batch.set_column(batch.schema.get_field_index("id"), "id", pa.array(np.arange(len(no))))
            own = batch.column("id").to_numpy(zero_copy_only=False)
            for at, labels, q in _by_length(numbered):
                new = {"no": no[at], "id": own[at], "label": labels, "q": q}
                old = out.get(q.shape[1])
                out[q.shape[1]] = {k: np.concatenate([old[k], v]) for k, v in new.items()} if old else new
        yield out


def _nearest(rows: DataFrame, anchors: dict, low: int, bits: int, k: int) -> DataFrame:
    """Per task: the first ``k`` rows of each anchor's own label, but for those of its id."""
    shared = rows.sparkSession.sparkContext.broadcast(anchors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = _Kept(k, sum(len(a["no"]) for a in shared.value.values()))
        for batch in batches:
            for no, own, ids, s in _tiles(shared.value, batch, low, bits, True):
                if s.shape[1] > k + 1:  # one may be the anchor itself
                    least = np.partition(s, s.shape[1] - k - 1, axis=1)[:, s.shape[1] - k - 1]
                else:
                    least = s.min(axis=1)
                # copies of an anchor's id would fill the first places, so these are looked at one by one
                i, j = np.nonzero((s >= least[:, None]) & (ids[None, :] != own[:, None]))
                few = np.bincount(i, minlength=len(no)) < min(k, s.shape[1])
                for x in np.flatnonzero(few):
                    i, j = np.r_[i[i != x], np.full(len(ids), x)], np.r_[j[i != x], np.arange(len(ids))]
                other = ids[j] != own[i]
                i, j = i[other], j[other]
                kept.add(no[i], s[i, j], ids[j])
        group, score, found = kept.shrink()
        yield pa.record_batch([pa.array(group), pa.array(score), pa.array(found)], names=["no", "score", "id"])

    return map_batches(rows, run, "no long, score long, id long")


def _between(rows: DataFrame, anchors: dict, positives: dict, low: int, bits: int, k: int) -> DataFrame:
    """Per task: the first ``k`` rows of other labels within the bounds of each positive of each anchor."""
    shared = rows.sparkSession.sparkContext.broadcast((anchors, positives))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, positives = shared.value
        width = positives["least"].shape[1]
        kept = _Kept(k, len(positives["no"]) * width)
        for batch in batches:
            for no, own, ids, s in _tiles(anchors, batch, low, bits, False):
                at = np.searchsorted(positives["no"], no)
                at = np.where((at < len(positives["no"])) & (positives["no"][np.minimum(at, len(positives["no"]) - 1)] == no), at, -1)
                least, most = positives["least"][at], positives["most"][at]
                least[at < 0], most[at < 0] = 1, 0
                real = least <= most
                floor = np.where(real, least, np.iinfo(np.int64).max).min(axis=1)
                top = np.where(real, most, np.iinfo(np.int64).min).max(axis=1)
                i, j = np.nonzero((s >= floor[:, None]) & (s <= top[:, None]) & (ids[None, :] != own[:, None]))
                if not len(i):
                    continue
                score, found = s[i, j], ids[j]
                for r in range(width):
                    fits = np.flatnonzero((score >= least[i, r]) & (score <= most[i, r]))
                    kept.add(no[i[fits]] * width + r, score[fits], found[fits])
        group, score, found = kept.shrink()
        yield pa.record_batch(
            [pa.array(group // width), pa.array((group % width + 1).astype(np.int32)), pa.array(score), pa.array(found)],
            names=["no", "place", "score", "id"],
        )

    return map_batches(rows, run, "no long, place int, score long, id long")


def _bounds(found: pa.Table, width: int, low_percent: int, high_percent: int) -> dict:
    """For each anchor number the smallest and largest negative score of each of its positives."""
    no, place, score = (found.column(c).to_numpy() for c in ("no", "place", "score"))
    known = np.unique(no)
    least = np.ones((len(known), width), np.int64)
    most = np.zeros((len(known), width), np.int64)  # no score lies between 1 and 0
    at = np.searchsorted(known, no)
    exact = score.astype(object)
    least[at, place - 1] = -((-low_percent * exact) // 100)
    most[at, place - 1] = (high_percent * exact) // 100
    return {"no": known, "least": least, "most": most}


def mine_negatives(
    vectors: DataFrame,
    anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = 5,
    negatives: int = 3,
    low_percent: int = 50,
    high_percent: int = 95,
    scale: int = SCALE,
) -> DataFrame:
    """For each anchor and each of its first ``positives`` rows of the same label the first ``negatives`` rows of
    another label whose score lies between the given percentages of the positive's.

    ``anchor`` says which rows are anchors.  The score is the inner product of components times ``scale``, rounded down;
    higher ones come first, ties by smaller id.  Rows without an id or a label, without a vector, or with a null or
    non-finite component take no part, nor do vectors of another length than the anchor's meet it; vectors without
    components score 0.  Rows with the anchor's own id are never its positives or negatives.  A repeated row counts as
    often as it stands; as an anchor it counts once.  A score beyond 64 bits stops the job.  Other columns are not
    read.  Returns ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``; anchors without a
    positive, and positives without a negative, give no row.
    """
    spark = vectors.sparkSession
    rows = stored(rows_of(vectors, id_col, vector_col, label_col, anchor, scale), "vectors")
    ends = rows.agg(F.min(F.array_min("q")), F.max(F.array_max("q")), F.max(F.size("q"))).first()
    low, high, dims = ends[0] or 0, ends[1] or 0, ends[2] or 0
    bits = field_bits(low, high, dims)
    anchors = rows.where("anchor").select("id", "label", "q").distinct()
    anchors = stored(anchors.withColumn("no", F.monotonically_increasing_id()), "anchors")
    found_path, mined_path = workspace(spark, "positives"), workspace(spark, "negatives")
    kinds = "no long, place int, score long, id long"
    spark.createDataFrame([], kinds).write.parquet(found_path)
    spark.createDataFrame([], kinds).write.parquet(mined_path)
    candidates = rows.select("id", "label", "q")
    for n, block in enumerate(_blocks(anchors, low, bits)):
        best = _nearest(candidates, block, low, bits, positives)
        best = best.withColumn("place", F.row_number().over(Window.partitionBy("no").orderBy(F.desc("score"), "id")))
        best = best.where(F.col("place") <= positives).select("no", "place", "score", "id")
        own = f"{found_path}/block={n}"
        best.write.parquet(own)
        bounds = _bounds(spark.read.schema(kinds).parquet(own).toArrow(), positives, low_percent, high_percent)
        if not len(bounds["no"]):
            continue
        fits = _between(candidates, block, bounds, low, bits, negatives)
        order = Window.partitionBy("no", "place").orderBy(F.desc("score"), "id")
        fits = fits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
        fits.select("no", "place", "rank", "score", "id").write.parquet(f"{mined_path}/block={n}")
    # blocks are folders under one name, so that all are read as one table
    read = spark.read.option("recursiveFileLookup", "true")
    found = read.schema(kinds).parquet(found_path)
    mined = read.schema("no long, place int, rank int, score long, id long").parquet(mined_path)
    found = found.select("no", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    mined = mined.select("no", "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    names = anchors.select("no", F.col("id").alias("anchor_id"))
    return (
        mined.join(found, ["no", "place"])
        .join(names, "no")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
