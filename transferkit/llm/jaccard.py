"""Join of documents on the Jaccard similarity of their five-word shingles, by chosen paths.

Documents with equal sets are one class.  A class chooses tokens of its set by a shared hash, about 1/(0.8 n)
of them in each run, and meets in a bucket per token those that chose it too.  Buckets that are too large are
split again by tokens chosen under the bucket's own hash; what is still large then is worked off in blocks.
Within buckets all pairs are compared by sketches; classes that any sketch ties together form clusters, in
which all pairs are compared by their sets.  The number of runs follows from the target recall.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transferkit.llm.batches import column_bytes, map_batches, mix64, pieces, words
from transferkit.llm.graph import components
from transferkit.llm.tables import sized, stored
from transferkit.llm.words import text_of

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.9999
BUCKET = 256
# A split leaves about a hundredth of a bucket together; so many documents need one split, their square two.
DEPTH_DOCUMENTS = 1_000_000
BLOCK = 1024
SKETCH = 64
# Standard deviations by which the cells of two sketches may fall short of the threshold: the sketch is the same in every
# run, so what it drops stays dropped; at 0.8 and 64 cells that is less than one pair in a million.
DEVIATIONS = 5.5


def runs_for(recall: float, threshold: float, depth: int) -> int:
    """Runs after which a pair at the threshold is found with the target chance.

    A run gives two such sets on average as many common buckets as they share tokens, over t times the larger set: 2/(1+t)
    where they have one size, and 1 where one contains the other, the least there can be.  Each further level keeps a
    common bucket with the survival chance of that branching.
    """
    mean = 1.0
    alive = 1.0
    for _ in range(depth - 1):
        alive = 1 - math.exp(-mean * alive)
    return math.ceil(-math.log(1 - recall) / (mean * alive))


def depth_for(n: int) -> int:
    """Levels of buckets that ``n`` documents need: 2 up to a million, one more for every further millionfold."""
    return max(2, 1 + math.ceil(math.log(max(n, 1)) / math.log(DEPTH_DOCUMENTS)))


_SALT = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def shingle_sets(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted shingles of each document, and where each document's begin, one more at the end.

    A document of fewer words, but not none, has one shingle of all of them.
    """
    hashes, _, _, per_doc = words(data, starts)
    n = len(per_doc) - 1
    doc = np.repeat(np.arange(n), np.diff(per_doc))
    total = np.zeros(len(hashes), np.uint64)
    left = per_doc[doc + 1] - np.arange(len(hashes)) if len(hashes) else np.zeros(0, np.int64)
    for k, salt in enumerate(_SALT):
        size = max(len(hashes) - k, 0)
        total[:size] += np.where(left[:size] > k, hashes[k:] * salt, np.uint64(0))
    first = np.arange(len(hashes)) == per_doc[doc] if len(hashes) else np.zeros(0, bool)
    keep = (left >= SHINGLE) | first
    doc, shingle = doc[keep], mix64(total[keep])
    order = np.lexsort((shingle, doc))
    doc, shingle = doc[order], shingle[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (shingle[1:] != shingle[:-1])
    doc, shingle = doc[new], shingle[new]
    return shingle, np.searchsorted(doc, np.arange(n + 1))


def _sums(x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _describe(docs: DataFrame, runs: int, threshold: float) -> DataFrame:
    """``id, text_hash, n, a, b, sketch, keys``: set size, 128 bits of the set, sketch and root buckets."""
    kind = docs.schema["id"].dataType.simpleString()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, starts in pieces(batch, "text"):
                tokens, bounds = shingle_sets(data, starts)
                size = np.diff(bounds)
                doc = np.repeat(np.arange(rows.num_rows), size)
                second = mix64(tokens ^ np.uint64(0x5851F42D4C957F2D))
                # one hash for all runs: its place among the runs picks the run, what is left of it the token
                share = (second >> np.uint64(11)).astype(np.float64) / 2.0**53 * runs
                chosen = np.flatnonzero(share - np.floor(share) < runs / (threshold * size[doc]))
                keys = mix64(tokens[chosen] + np.uint64(1)).view(np.int64)
                at = np.searchsorted(doc[chosen], np.arange(rows.num_rows + 1))
                sketch = np.zeros((rows.num_rows, SKETCH), np.uint64)
                slot = (tokens >> np.uint64(58)).astype(np.int64)
                cell = doc * SKETCH + slot
                flat = np.full(rows.num_rows * SKETCH, np.iinfo(np.uint64).max, np.uint64)
                if len(cell):  # sorted tokens: the first of a cell is its least
                    new = np.ones(len(cell), bool)
                    new[1:] = cell[1:] != cell[:-1]
                    flat[cell[new]] = tokens[new]
                empty = flat == np.iinfo(np.uint64).max
                sketch = np.where(empty, 0, mix64(flat) % np.uint64(255) + np.uint64(1)).astype(np.uint8)
                raw = sketch.tobytes()
                yield pa.record_batch(
                    [
                        rows.column("id"),
                        rows.column("text_hash"),
                        pa.array(size),
                        pa.array(_sums(tokens, bounds).view(np.int64)),
                        pa.array(_sums(second, bounds).view(np.int64)),
                        pa.array([raw[i * SKETCH : (i + 1) * SKETCH] for i in range(rows.num_rows)], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(keys)),
                    ],
                    names=["id", "text_hash", "n", "a", "b", "sketch", "keys"],
                )

    return map_batches(
        docs, emit, f"id {kind}, text_hash long, n long, a long, b long, sketch binary, keys array<long>"
    )


def _live(rows: DataFrame, whole: int | None) -> DataFrame:
    """``key, node, size`` of buckets with two classes or more.

    Of buckets with the same classes one is compared; but those above ``whole`` are split, and all of them
    are: each is another chance for a pair to stay together.
    """
    rows = rows.distinct()
    sizes = rows.groupBy("key").agg(F.count("*").alias("size"), F.bit_xor(F.xxhash64("node")).alias("who"))
    alone = F.lit(0) if whole is None else F.when(F.col("size") > whole, F.col("key")).otherwise(0)
    sizes = sizes.where("size > 1").groupBy("size", "who", alone.alias("alone")).agg(F.min("key").alias("key"))
    return rows.join(sizes.select("key", "size"), "key")


def _texts(docs: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (by node, unique) with ``text``: the text of one document of each class."""
    wanted = wanted.join(classes.select("node", "doc", "text_hash"), "node")
    wanted = sized(wanted, "jaccard_wanted")
    on = docs.id.eqNullSafe(wanted.doc) & (docs.text_hash == wanted.text_hash)
    return docs.select("id", "text_hash", "text").join(wanted, on).drop("id", "text_hash", "doc")


def _split(rows: DataFrame, threshold: float) -> DataFrame:
    """``key, node`` one level down; ``rows`` has ``node, keys, text``."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, starts in pieces(batch, "text"):
                tokens, bounds = shingle_sets(data, starts)
                node = part.column("node").to_numpy()
                out_key, out_node = [], []
                for i, keys in enumerate(part.column("keys").to_pylist()):
                    own = tokens[bounds[i] : bounds[i + 1]]
                    for key in keys:
                        mixed = mix64(own ^ mix64(np.array([key], np.int64).view(np.uint64)))
                        chosen = mixed[(mixed >> np.uint64(11)).astype(np.float64) / 2.0**53 < 1 / (threshold * len(own))]
                        out_key.append(mix64(chosen + np.uint64(1)).view(np.int64))
                        out_node.append(np.full(len(chosen), node[i]))
                if out_key:
                    yield pa.record_batch({"key": np.concatenate(out_key), "node": np.concatenate(out_node)})

    return map_batches(rows.select("node", "keys", "text"), emit, "key long, node long")


def _grouped(batches: Iterator[pa.RecordBatch], by: tuple[str, ...]) -> Iterator[pa.Table]:
    """Runs of rows that agree in ``by``, from batches in which such rows are neighbours."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        columns = [table.column(c).to_numpy() for c in by]
        new = np.zeros(table.num_rows, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(new), table.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            key = tuple(c[a] for c in columns)
            if key != last and held:
                yield pa.concat_tables(held)
                held = []
            last = key
            held.append(table.slice(a, b - a))
    if held:
        yield pa.concat_tables(held)


def _blocks(rows: DataFrame) -> DataFrame:
    """``group`` of at most about ``BLOCK`` rows become one task's work; larger ones all pairs of blocks.

    Adds ``i, j, side``: a row is in the pairs of its block with each block; side tells its end of the pair.
    """
    n_blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    rows = rows.select("*", n_blocks.alias("blocks"))
    rows = rows.select("*", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("own"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    return rows.select(
        "*", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
    ).drop("own", "other", "blocks")


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("group", "i", "j").sortWithinPartitions("group", "i", "j", "node")


def _roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Least member of each row's component under the links."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, left, least)
        np.minimum.at(root, right, least)
        root = root[root]
        if (root == before).all():
            return root


def _sketch_links(size: np.ndarray, sketch: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that may reach the threshold: their sizes allow it, and their sketches agree up to ``DEVIATIONS``."""
    left, right = [], []
    for a in range(0, len(size), 64):
        x, n = sketch[a : a + 64, None, :], size[a : a + 64, None]
        used = ((x != 0) | (sketch[None] != 0)).sum(axis=2)
        same = ((x == sketch[None]) & (x != 0)).sum(axis=2)
        near = same >= used * threshold - DEVIATIONS * np.sqrt(used * threshold * (1 - threshold))
        near &= np.minimum(n, size) >= threshold * np.maximum(n, size)
        i, j = np.nonzero(near)
        i += a
        left.append(i[i < j])
        right.append(j[i < j])
    return np.concatenate(left), np.concatenate(right)


def _sketched(buckets: DataFrame, threshold: float) -> DataFrame:
    """``a, b``: a star for each set of classes that sketches tie together within a bucket."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches, ("group", "i", "j")):
            node = table.column("node").to_numpy()
            node, at = np.unique(node, return_index=True)
            data, _ = column_bytes(table.column("sketch").combine_chunks())
            sketch = data.reshape(-1, SKETCH)[at]
            left, right = _sketch_links(table.column("n").to_numpy()[at], sketch, threshold)
            if len(left):
                root = _roots(len(node), left, right)
                tied = np.flatnonzero(root != np.arange(len(node)))
                yield pa.record_batch({"a": node[root[tied]], "b": node[tied]})

    return map_batches(_dealt(buckets).select("group", "i", "j", "node", "n", "sketch"), emit, "a long, b long")


def _set_links(tokens: np.ndarray, bounds: np.ndarray, threshold: float) -> np.ndarray:
    """Rows x rows: Jaccard similarity at the threshold or above."""
    size = np.diff(bounds)
    n = len(size)
    row = np.repeat(np.arange(n), size)
    order = np.argsort(tokens, kind="stable")
    ordered, row = tokens[order], row[order]
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    number = np.cumsum(new) - 1
    often = np.bincount(number)
    some = often[number] > 1
    row, number = row[some], number[some]
    common = np.zeros((n, n), np.float32)
    if len(number):
        number = np.cumsum(np.append(True, number[1:] != number[:-1])) - 1
        width = 4096
        cut = np.searchsorted(number, np.arange(0, number[-1] + width + 1, width))
        for k, (a, b) in enumerate(zip(cut, cut[1:])):
            x = np.zeros((n, width), np.float32)
            x[row[a:b], number[a:b] - k * width] = 1
            common += x @ x.T
    either = size[:, None] + size[None, :] - common
    return common >= threshold * either.astype(np.float64)


def _verified(clusters: DataFrame, threshold: float) -> DataFrame:
    """``node, links, root``: a class's links found here, and the least class it is tied to.

    ``clusters`` has ``group, i, j, side, node, text``.
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, starts in pieces(batch, "text"):
                tokens, bounds = shingle_sets(data, starts)
                raw = tokens.tobytes()
                blobs = pa.array([raw[8 * a : 8 * b] for a, b in zip(bounds, bounds[1:])], pa.binary())
                yield pa.record_batch(
                    [part.column("node"), part.column("group"), part.column("size"), blobs],
                    names=["node", "group", "size", "tokens"],
                )

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches, ("group", "i", "j")):
            node, at = np.unique(table.column("node").to_numpy(), return_index=True)
            if len(node) < 2:
                continue
            table = table.take(at)
            data, starts = column_bytes(table.column("tokens").combine_chunks())
            near = _set_links(np.frombuffer(data.tobytes(), np.uint64), starts // 8, threshold)
            np.fill_diagonal(near, False)
            if table.column("i")[0].as_py() != table.column("j")[0].as_py():  # pairs within a block are its own work
                side = table.column("side").to_numpy()
                near &= side[:, None] != side[None, :]
            left, right = np.nonzero(np.triu(near))
            if len(left):
                root = _roots(len(node), left, right)
                yield pa.record_batch({"node": node, "links": near.sum(axis=1), "root": node[root]})

    rows = map_batches(clusters, sets, "node long, group long, size long, tokens binary")
    rows = _dealt(_blocks(rows)).select("group", "i", "j", "side", "node", "tokens")
    return map_batches(rows, emit, "node long, links long, root long")


def _joined(docs: DataFrame, threshold: float, recall: float, depth: int | None) -> tuple[DataFrame, DataFrame]:
    """Described documents, and ``n, a, b, label, class, links, copies`` of each set: its class and that one's least id.

    ``docs`` has ``id, text, text_hash``.
    """
    depth = depth or depth_for(docs.count())
    runs = runs_for(recall, threshold, depth)
    described = stored(_describe(docs, runs, threshold), "jaccard_documents")
    classes = described.where("n > 0").groupBy("n", "a", "b").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("doc"), "text_hash")).alias("first"),
        F.count("*").alias("copies"),
        F.first("sketch").alias("sketch"),
        F.first("keys").alias("keys"),
    )
    classes = classes.select("n", "a", "b", "first.doc", "first.text_hash", "copies", "sketch", "keys")
    # numbers that stay as they are once written
    classes = stored(classes.select(F.monotonically_increasing_id().alias("node"), "*"), "jaccard_classes")
    rows = classes.select("node", F.explode("keys").alias("key")).select("key", "node")
    leaves = []
    for level in range(depth):
        last = level == depth - 1
        live = stored(_live(rows, None if last else BUCKET), f"jaccard_level{level + 1}")
        leaves.append(live if last else live.where(F.col("size") <= BUCKET))
        large = live.where(F.col("size") > BUCKET)
        if last or large.isEmpty():
            break
        wanted = _texts(docs, classes, large.groupBy("node").agg(F.collect_list("key").alias("keys")))
        rows = stored(_split(wanted, threshold), "jaccard_split")  # sizes and members are both read from it
    buckets = leaves[0]
    for more in leaves[1:]:
        buckets = buckets.unionByName(more)
    buckets = buckets.join(classes.select("node", "n", "sketch"), "node").withColumnRenamed("key", "group")
    clusters = components(_sketched(_blocks(buckets), threshold))
    sizes = clusters.groupBy("label").agg(F.count("*").alias("size"))
    clusters = clusters.join(sizes, "label").select("node", F.col("label").alias("group"), "size")
    found = stored(_verified(_texts(docs, classes, clusters), threshold), "jaccard_links")
    tied = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = classes.select("node", "n", "a", "b", "doc", "copies").join(links, "node", "left").join(tied, "node", "left")
    known = known.select(
        "n", "a", "b", "doc", "copies", F.coalesce("links", F.lit(0)).cast("long").alias("links"),
        F.coalesce("label", "node").alias("label"),
    )
    known = stored(known, "jaccard_known")
    ends = known.groupBy("label").agg(F.min("doc").alias("class"), F.count("*").alias("members"))
    return described, known.join(ends, "label")


def _prepared(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    return rows.select("id", "text", F.xxhash64("text").alias("text_hash"))


def jaccard_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    depth: int | None = None,
) -> DataFrame:
    """One row for each input row: its class, its links and its exact copies.

    ``class_id`` is the smallest id among the documents tied to it by any chain of links, ``n_links`` the
    number of different shingle sets that reach the threshold with its own, ``n_copies`` the documents with
    its own set.  Null and empty texts, and those without a word, have no links and are their own class, with
    no copies counted; ids that are null count after all others.  Repeated rows are copies.
    """
    described, known = _joined(_prepared(docs, id_col, text_col), threshold, recall, depth)
    out = described.select("id", "n", "a", "b").join(known, ["n", "a", "b"], "left")
    return out.select(
        F.col("id").alias(id_col),
        F.when(F.col("n") > 0, F.col("class")).otherwise(F.col("id")).alias("class_id"),
        F.coalesce("links", F.lit(0)).alias("n_links"),
        F.coalesce("copies", F.lit(1)).alias("n_copies"),
    )


def drop_near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    depth: int | None = None,
) -> DataFrame:
    """The input's columns, and of every class the row with the smallest id; texts without words all stay.

    Exactly one row of each class stays: of its rows that share that id, or if none has an id, one with the least
    hash of its text.
    """
    rows = _prepared(docs, id_col, text_col)
    described, known = _joined(rows, threshold, recall, depth)
    member = described.join(known, ["n", "a", "b"], "left")
    first = member.where("n > 0").where(F.col("id").eqNullSafe(F.col("class")))
    # by class: an id, or none, may be the least of several
    first = first.groupBy("label", "id").agg(F.min("text_hash").alias("text_hash"), F.count("*").alias("rows")).drop("label")
    blank = sized(described.where("n = 0").select("text_hash").distinct(), "jaccard_wordless")
    keep = sized(first, "jaccard_kept")
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_col).alias("row_id"),
        F.xxhash64(text_of(text_col)).alias("row_hash"),
    )
    found = whole.join(keep, whole.row_id.eqNullSafe(keep.id) & (whole.row_hash == keep.text_hash))
    single = found.where("rows = 1").select("row")
    shared = found.where("rows > 1").dropDuplicates(["row_id", "row_hash"]).select("row")
    wordless = whole.join(blank, whole.row_hash == blank.text_hash, "left_semi").select("row")
    return single.unionByName(shared).unionByName(wordless).select("row.*")
