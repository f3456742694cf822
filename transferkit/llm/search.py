"""Ranked lexical search: posting lists in blocks of similar documents, under coordinatewise-maximum summaries.

Documents are laid out by a geometric code, the signs of random projections of their weighted terms, so that neighbours
are alike.  A shard is a run of them.  In it every term's posting list is cut into blocks of documents that follow
each other in that layout; a block's summary has, for each term that any query asks along with the list's,
the largest weight in the block, rounded up.  A query goes through its lists from the heaviest on; what it
does not look at cannot reach its k-th best score so far: the rest of the lists by their maxima, a block by its summary.
A document that holds an earlier term of the query was met in that term's list, so a bound counts the later terms only.

Queries are a stated set: they go to the workers in blocks of bounded vocabulary, each block over all documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from transferkit.llm.batches import map_batches, mix64, pieces, words
from transferkit.llm.tables import discard, stored
from transferkit.llm.words import text_of
from transferkit.session import workspace

K = 20
# Distinct terms of one block of queries.
BLOCK_TERMS = 4096
# Cells (document, term) of a shard, and its most and fewest documents.
SHARD_CELLS, SHARD_DOCS, SHARD_LEAST = 8 << 20, 2048, 32
# Postings of a block.
BLOCK_POSTINGS = 32
# Documents scored before the bound is raised again.
STEP_DOCS = 256
CODE_BITS = 32
LEVELS = 255


def _terms(df: DataFrame, vocabulary: np.ndarray | None) -> DataFrame:
    """``id, n, terms, counts`` of rows ``id, text`` with words: places in the vocabulary, or hashes without one."""
    kind = df.schema["id"].dataType.simpleString()
    shared = None if vocabulary is None else df.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, starts in pieces(batch, "text"):
                h, _, _, first = words(data, starts)
                n = np.diff(first)
                row = np.repeat(np.arange(len(n)), n)
                if shared is None:
                    names, term = np.unique(h, return_inverse=True)
                else:
                    names = shared.value
                    term = np.minimum(np.searchsorted(names, h), len(names) - 1)
                    known = names[term] == h
                    row, term = row[known], term[known]
                pair, count = np.unique(row * max(1, len(names)) + term, return_counts=True)
                row, term = np.divmod(pair, max(1, len(names)))
                values = names[term].view(np.int64) if shared is None else term.astype(np.int64)
                ends = np.r_[0, np.cumsum(np.bincount(row, minlength=len(n)))].astype(np.int32)
                out = pa.record_batch(
                    [
                        rows.column("id"),
                        pa.array(n.astype(np.int64)),
                        pa.ListArray.from_arrays(ends, pa.array(values)),
                        pa.ListArray.from_arrays(ends, pa.array(count.astype(np.int32))),
                    ],
                    names=["id", "n", "terms", "counts"],
                )
                yield out.filter(pa.array(n > 0))

    return map_batches(df, run, f"id {kind}, n long, terms array<long>, counts array<int>")


def _flat(batch: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and count of every entry."""
    sizes = batch.column("terms").value_lengths().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(batch.num_rows), sizes)
    return row, batch.column("terms").flatten().to_numpy(zero_copy_only=False), batch.column("counts").flatten().to_numpy(zero_copy_only=False)


class Queries:
    """A block of queries over a vocabulary, and the weights of its terms in a collection."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        batch = table.to_batches()[0]
        row, term, count = _flat(batch)
        self.no = batch.column("no").to_numpy()
        self.vocabulary, term = np.unique(term.view(np.uint64), return_inverse=True)
        bounds = np.searchsorted(row, np.arange(batch.num_rows + 1))
        self.terms = [term[a:b] for a, b in zip(bounds, bounds[1:])]
        self.counts = [count[a:b].astype(np.int64) for a, b in zip(bounds, bounds[1:])]

    def weigh(self, n_docs: int, length: int, df: dict[int, int]) -> None:
        self.n_docs, self.length = n_docs, length
        self.weight = np.array(
            [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(self.vocabulary))], np.int64
        )
        # terms without a document or a weight add nothing
        held = np.array([df.get(t, 0) > 0 for t in range(len(self.vocabulary))], bool) & (self.weight > 0)
        for q, (terms, counts) in enumerate(zip(self.terms, self.counts)):
            self.terms[q], self.counts[q] = terms[held[terms]], counts[held[terms]]
        # what is asked along with each term: the coordinates of its summaries
        asked: dict[int, list[np.ndarray]] = {}
        for terms in self.terms:
            for t in terms:
                asked.setdefault(int(t), []).append(terms)
        self.along = {t: np.unique(np.concatenate(x)) for t, x in asked.items()}


def impacts(count: np.ndarray, n: np.ndarray, n_docs: int, length: int) -> np.ndarray:
    """What a term adds to a document's score per unit of its weight."""
    m = 75 + (25 * n * n_docs) // length
    return (1_000_000_000 * count) // (1000 * count + 12 * m)


class Shard:
    """A run of documents with its posting lists, cut into blocks; summaries are made when a list is first asked for."""

    def __init__(self, docs: pa.RecordBatch, queries: Queries):
        self.queries = queries
        self.ids = docs.column("id")
        self.rank = pc.rank(self.ids, sort_keys="ascending", null_placement="at_end", tiebreaker="first").to_numpy()
        row, term, count = _flat(docs)
        n = docs.column("n").to_numpy()
        value = impacts(count.astype(np.int64), n[row], queries.n_docs, queries.length)
        size = len(queries.vocabulary)
        self.dense = np.zeros((docs.num_rows, size), np.int32)
        self.dense[row, term] = value
        by_term = np.lexsort((row, term))
        self.docs = row[by_term]
        self.starts = np.searchsorted(term[by_term], np.arange(size + 1))
        self.most = self.dense.max(axis=0, initial=0).astype(np.int64)
        self.unit = -(-self.most // LEVELS)
        self.summaries: dict[int, np.ndarray] = {}

    def summary(self, term: int) -> np.ndarray:
        """For every block of the list, and each term asked along, the largest impact in its unit, rounded up."""
        if term not in self.summaries:
            along = self.queries.along[term]
            docs = self.docs[self.starts[term] : self.starts[term + 1]]
            unit = np.maximum(self.unit[along], 1)
            out = []
            step = max(1, SHARD_CELLS // (8 * len(along)) // BLOCK_POSTINGS) * BLOCK_POSTINGS
            for i in range(0, len(docs), step):
                part = self.dense[np.ix_(docs[i : i + step], along)]
                most = np.maximum.reduceat(part, np.arange(0, len(part), BLOCK_POSTINGS), axis=0)
                out.append((-(-most // unit)).astype(np.uint8))
            self.summaries[term] = np.concatenate(out)
        return self.summaries[term]

    def search(self, q: int, best: Best) -> None:
        """Meets every document that can be among the best of a query."""
        terms, counts = self.queries.terms[q], self.queries.counts[q]
        weight = self.queries.weight[terms] * counts
        top = weight * self.most[terms]
        order = np.argsort(-top, kind="stable")
        terms, weight, top = terms[order], weight[order], top[order]
        rest = np.cumsum(top[::-1])[::-1]
        seen = np.zeros(len(self.ids), bool)
        for at, term in enumerate(terms):
            if not top[at] or rest[at] < best.least:
                return
            docs = self.docs[self.starts[term] : self.starts[term + 1]]
            later = terms[at:]
            places = np.searchsorted(self.queries.along[int(term)], later)
            bound = self.summary(int(term))[:, places].astype(np.int64) @ (weight[at:] * self.unit[later])
            blocks = np.argsort(-bound, kind="stable")
            step = max(1, STEP_DOCS // BLOCK_POSTINGS)
            for i in range(0, len(blocks), step):
                some = blocks[i : i + step]
                some = some[bound[some] >= best.least]
                if not len(some):
                    break
                found = (some[:, None] * BLOCK_POSTINGS + np.arange(BLOCK_POSTINGS)).ravel()
                found = docs[found[found < len(docs)]]
                found = found[~seen[found]]
                seen[found] = True
                if len(found):
                    score = self.dense[np.ix_(found, terms)].astype(np.int64) @ weight
                    best.add(score, found, self)


class Best:
    """The first ``k`` (score, id) of a query so far, and the least score that may still enter."""

    def __init__(self, k: int):
        self.k, self.least = k, 1
        self.rows: list[tuple] = []

    def add(self, score: np.ndarray, docs: np.ndarray, shard: Shard) -> None:
        fits = np.flatnonzero(score >= self.least)
        if not len(fits):
            return
        score, docs = score[fits], docs[fits]
        first = np.lexsort((shard.rank[docs], -score))[: self.k]
        ids = shard.ids.take(pa.array(docs[first])).to_pylist()
        self.rows += [(-int(s), i is None, i) for s, i in zip(score[first], ids)]
        self.rows.sort(key=lambda r: (r[0], r[1], 0 if r[1] else r[2]))
        del self.rows[self.k :]
        if len(self.rows) == self.k:
            self.least = -self.rows[-1][0]


def _coded(vectors: DataFrame, weight: np.ndarray, vocabulary: np.ndarray) -> DataFrame:
    """The documents' geometric codes: signs of projections on directions drawn from the terms' hashes."""
    spark, kind = vectors.sparkSession, vectors.schema["id"].dataType.simpleString()
    signs = ((mix64(vocabulary)[:, None] >> np.arange(CODE_BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float32) * 2 - 1
    shared = spark.sparkContext.broadcast(signs * weight[:, None].astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, SHARD_DOCS):
                batch = whole.slice(i, SHARD_DOCS)
                row, term, count = _flat(batch)
                total = np.zeros((batch.num_rows, CODE_BITS), np.float32)
                starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else row
                if len(row):
                    total[row[starts]] = np.add.reduceat(shared.value[term], starts, axis=0)
                code = (total > 0) @ (np.int64(1) << np.arange(CODE_BITS, dtype=np.int64)[::-1])
                yield batch.append_column("code", pa.array(code.astype(np.int64)))

    return map_batches(vectors, run, f"id {kind}, n long, terms array<long>, counts array<int>, no long, code long")


def _searched(docs: DataFrame, queries: Queries, k: int) -> DataFrame:
    """Each task's first ``k`` documents of every query of the block; documents come in the order of their code."""
    kind = docs.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value
        size = max(SHARD_LEAST, min(SHARD_DOCS, SHARD_CELLS // max(1, len(queries.vocabulary))))
        best = [Best(k) for _ in queries.no]
        schema = None
        for batch in batches:
            schema = batch.schema
            for i in range(0, batch.num_rows, size):
                shard = Shard(batch.slice(i, size), queries)
                for q in range(len(best)):
                    shard.search(q, best[q])
        if schema is not None:
            rows = [(int(no), -s, i) for no, b in zip(queries.no, best) for s, _, i in b.rows]
            kinds = (pa.int64(), pa.int64(), schema.field("id").type)
            columns = [pa.array([r[c] for r in rows], t) for c, t in enumerate(kinds)]
            yield pa.record_batch(columns, names=["no", "score", "id"])

    return map_batches(docs, run, f"no long, score long, id {kind}")


def search(
    docs: DataFrame,
    queries: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    query_id_col: str = "item_id",
    query_text_col: str = "text",
    k: int = K,
) -> DataFrame:
    """The ``k`` highest-scoring documents of every query: ``rank, score`` beside both ids.

    Terms are runs of letters, digits and characters beyond ASCII, A-Z in lower case, over whole texts.  Only scores
    above 0 count; equal ones rank by smaller document id, null ids last.  Null and empty texts have no terms: such
    documents are not counted, such queries find nothing.  Repeated documents rank next to each other; every row of
    ``queries`` has its own list.  Empty tables give no rows; other columns are not read.  Terms are compared by
    64 bits of their hash.
    """
    spark = docs.sparkSession
    asked = _terms(queries.select(F.col(query_id_col).alias("id"), text_of(query_text_col).alias("text")), None)
    asked = stored(asked.withColumn("no", F.monotonically_increasing_id()), "queries")
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    n_blocks = -(-total // BLOCK_TERMS)
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    path, kind = workspace(spark, "ranked"), texts.schema["id"].dataType.simpleString()
    schema = f"no long, rank int, id {kind}, score long"
    spark.createDataFrame([], schema).write.parquet(path)
    for n in range(n_blocks):
        table = asked.where(F.pmod(F.xxhash64("no"), F.lit(n_blocks)) == n).toArrow()
        if not table.num_rows:
            continue
        block = Queries(table)
        vectors = _terms(texts, block.vocabulary).withColumn("no", F.monotonically_increasing_id())
        vectors = stored(vectors, "vectors", "zstd")
        n_docs, length = vectors.agg(F.count("*"), F.sum("n")).first()
        if n_docs:
            df = vectors.select(F.explode("terms").alias("t")).groupBy("t").count().toArrow()
            block.weigh(n_docs, length, dict(zip(df.column("t").to_pylist(), df.column("count").to_pylist())))
            coded = _coded(vectors.where(F.size("terms") > 0), block.weight, block.vocabulary)
            # equal codes, those of copies, are dealt out by number
            laid = coded.repartitionByRange("code", "no").sortWithinPartitions("code", "no")
            found = _searched(laid.select("id", "n", "terms", "counts"), block, k)
            order = Window.partitionBy("no").orderBy(F.desc("score"), F.asc_nulls_last("id"))
            ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            ranked.select("no", "rank", "id", "score").write.parquet(f"{path}/block={n}")
        discard(vectors)
    ranked = spark.read.option("recursiveFileLookup", "true").schema(schema).parquet(path)
    names = asked.select("no", F.col("id").alias("query"))
    return ranked.join(names, "no").select(
        F.col("query").alias(query_id_col), "rank", F.col("id").alias(id_col), "score"
    )
