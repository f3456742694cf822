"""Toxicity by weak supervision: voters, a generative label model, and a linear classifier on its posteriors.

All words that mark labelled toxic documents are mined from all training rows and dealt to lexicon voters by how
surely they mark; patterns vote beside them, and so does a training label where there is one.  Votes of all
documents, counted by vote pattern, give the voters' accuracies, and pairs that agree more than independence
allows are correlated and share their weight.  A logistic regression over voters, patterns and hashed words is
fitted to the posteriors of a bounded sample and scores every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transferkit.llm.batches import map_batches, pieces, word_hash, words
from transferkit.llm.tables import sized, stored
from transferkit.llm.words import text_of

# Common English insults, as a first lexicon; the mined words are added to it.
INSULTS = ("idiot", "stupid", "moron", "pathetic", "loser", "trash", "scum", "worthless", "disgusting", "dumb")
# One voter has the insults that are not mined; the others the mined words, by their deviation from chance.
LEXICON_VOTERS = 7
# Up to so many marking words go to the workers; more are joined on the documents' words.
BROADCAST_WORDS = 200_000
# All words of a document fall to so many features of the classifier by their hash.
FEATURE_BITS = 9
FEATURES = 1 << FEATURE_BITS
# A mined word stands in so many labelled documents at least, in toxic ones so many times as often.
LEAST_DOCS = 5
LEAST_LIFT = 4.0
LEAST_Z = 3.0
# The classifier is fitted on at most so many labelled rows, those of smallest hash.
SAMPLE_ROWS = 20_000
EM_ROUNDS = 50
# How often a label is taken to be right.
LABEL_ACCURACY = 0.98
PATTERNS = ("shouting", "exclamations", "short")


@dataclass(frozen=True)
class Model:
    """Weights of hashed words, of votes and the bias."""

    words: np.ndarray
    votes: np.ndarray
    bias: float


@dataclass(frozen=True)
class Lexicon:
    """Marking words and their voters: sorted hashes if few, else the lexicon's votes by the two hashes of a text."""

    hashes: np.ndarray
    voters: np.ndarray
    hits: DataFrame | None = None


def document_words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, word hash) pairs."""
    hashes, _, _, per_doc = words(data, starts)
    doc = np.repeat(np.arange(len(starts) - 1), np.diff(per_doc))
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    return doc[new], hashes[new]


def pattern_votes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Documents x patterns: mostly capitals, many exclamation marks, and hardly any text."""
    n = np.maximum(np.diff(starts), 1)

    def per_doc(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return total[starts[1:]] - total[starts[:-1]]

    upper = per_doc((data >= 0x41) & (data <= 0x5A))
    lower = per_doc((data >= 0x61) & (data <= 0x7A))
    marks = per_doc(data == 0x21)
    return np.stack([upper > lower, marks * 50 > n, np.diff(starts) < 40], axis=1)


def mine(labelled: DataFrame) -> tuple[int, int, DataFrame]:
    """Labelled documents of either kind, and ``word, toxic, clean``: how many of them hold each word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, starts in pieces(batch, "text"):
                label = np.asarray(rows.column("label").to_pylist(), np.int64)
                doc, hashes = document_words(data, starts)
                word, at = np.unique(hashes, return_inverse=True)
                toxic = np.bincount(at, label[doc], len(word)).astype(np.int64)
                n = np.bincount(at, minlength=len(word))
                yield pa.record_batch({"word": word.view(np.int64), "toxic": toxic, "clean": n - toxic})

    counts = map_batches(labelled, count, "word long, toxic long, clean long")
    counts = counts.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    n = {r.label: r.n for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    return n.get(1, 0), n.get(0, 0), counts.where(F.col("toxic") + F.col("clean") >= LEAST_DOCS)


def lexicon(labelled: DataFrame) -> tuple[DataFrame, float]:
    """``word, voter`` of every word that marks toxic documents, and the share of toxic documents.

    A voter's words deviate from chance by up to the root of two times as much as those of the voter before.
    """
    n_toxic, n_clean, counts = mine(labelled)
    share = (n_toxic + 1) / (n_toxic + n_clean + 2)
    both = F.col("toxic") + F.col("clean")
    z = (F.col("toxic") - both * share) / F.sqrt(both * share * (1 - share))
    lift = (F.col("toxic") / max(n_toxic, 1)) / ((F.col("clean") + 0.5) / max(n_clean, 1))
    marks = counts.select("word", z.alias("z"), lift.alias("lift")).where((F.col("z") > LEAST_Z) & (F.col("lift") >= LEAST_LIFT))
    band = F.floor(2 * F.log2(F.col("z") / LEAST_Z)).cast("int")
    mined = stored(marks.select("word", F.least(band + 1, F.lit(LEXICON_VOTERS - 1)).alias("voter")), "toxic_mined")
    seeds = np.array([word_hash(w) for w in INSULTS], np.uint64).view(np.int64).tolist()
    given = labelled.sparkSession.createDataFrame([(w, 0) for w in seeds], "word long, voter int")
    return mined.unionByName(given.join(mined, "word", "left_anti")), share


def _text_hashes() -> list[Column]:
    return [F.xxhash64("text").alias("a"), F.xxhash64("text", F.lit(1)).alias("b")]


def looked_up(docs: DataFrame, marked: DataFrame) -> Lexicon:
    """The marking words for ``docs``: sent to the workers if few, else joined on the words of the texts."""
    marked = stored(marked, "toxic_marked")
    if marked.count() <= BROADCAST_WORDS:
        rows = marked.toPandas()
        hashes = rows["word"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(hashes)
        return Lexicon(hashes[order], rows["voter"].to_numpy(np.int64)[order])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, starts in pieces(batch, "text"):
                doc, word = document_words(data, starts)
                a, b = (rows.column(c).to_numpy()[doc] for c in ("a", "b"))
                yield pa.record_batch({"a": a, "b": b, "word": word.view(np.int64)})

    found = map_batches(docs.select(*_text_hashes(), "text"), emit, "a long, b long, word long").join(marked, "word")
    hits = found.groupBy("a", "b").agg(F.bit_or(F.expr("shiftleft(1, voter)")).alias("hits"))
    return Lexicon(np.zeros(0, np.uint64), np.zeros(0, np.int64), stored(hits, "toxic_hits"))


def described(docs: DataFrame, lexicon: Lexicon, columns: str, describe) -> DataFrame:
    """``docs`` (of ``label, text`` and others) with ``votes`` and, for the text, what ``describe`` makes of its words.

    ``describe`` takes distinct (document, word) pairs and the number of documents.
    """
    others = [c for c in docs.columns if c != "text"]
    if lexicon.hits is not None:
        docs = docs.select("*", *_text_hashes())
    kept = [c for c in docs.columns if c != "text"]
    hashes, voters = lexicon.hashes, lexicon.voters

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, starts in pieces(batch, "text"):
                pairs = document_words(data, starts)
                votes = votes_of(*pairs, data, starts, hashes, voters).astype(np.int32)
                made = [pa.array(votes), *describe(*pairs, rows.num_rows)]
                yield pa.record_batch([*[rows.column(c) for c in kept], *made], names=names)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema]
    schema = ", ".join([*fields, "votes int", *([columns] if columns else [])])
    names = [*kept, "votes", *[c.split()[0] for c in columns.split(", ") if c]]
    out = map_batches(docs.select(*kept, "text"), emit, schema)
    if lexicon.hits is not None:
        out = out.join(lexicon.hits, ["a", "b"], "left")
        out = out.withColumn("votes", F.col("votes").bitwiseOR(F.coalesce("hits", F.lit(0)))).select(*others, *names[len(kept) :])
    return out


def votes_of(
    doc: np.ndarray, word: np.ndarray, data: np.ndarray, starts: np.ndarray, hashes: np.ndarray, voters: np.ndarray
) -> np.ndarray:
    """Each document's votes as bits: lexicon voters first, then patterns."""
    votes = np.zeros((len(starts) - 1, LEXICON_VOTERS + len(PATTERNS)), bool)
    if len(hashes):
        at = np.minimum(np.searchsorted(hashes, word), len(hashes) - 1)
        hit = np.flatnonzero(hashes[at] == word)
        votes[doc[hit], voters[at[hit]]] = True
    votes[:, LEXICON_VOTERS:] = pattern_votes(data, starts)
    return votes @ (1 << np.arange(votes.shape[1]))


def label_model(label: np.ndarray, votes: np.ndarray, n: np.ndarray, share: float) -> np.ndarray:
    """Posterior of the toxic class for each pattern of votes and label.

    Voters fire with one chance on toxic and another on clean documents; EM estimates both.  Then each
    voter's log odds are divided by one plus its positive residual correlations, and the posteriors redone.
    """
    m = LEXICON_VOTERS + len(PATTERNS)
    v = ((votes[:, None] >> np.arange(m)) & 1).astype(float)
    told = np.select([label == 1, label == 0], [1.0, -1.0], 0.0) * np.log(LABEL_ACCURACY / (1 - LABEL_ACCURACY))
    any_word = v[:, :LEXICON_VOTERS].any(axis=1)
    q = np.select([label == 1, label == 0], [LABEL_ACCURACY, 1 - LABEL_ACCURACY], np.where(any_word, 0.9, 0.02))
    weight = np.ones(m)
    for step in range(EM_ROUNDS):
        toxic, clean = n * q, n * (1 - q)
        fire1 = (toxic @ v + 0.5) / (toxic.sum() + 1)
        fire0 = (clean @ v + 0.5) / (clean.sum() + 1)
        prior = (toxic.sum() + share) / (n.sum() + 1)
        if step == EM_ROUNDS // 2:
            weight = 1 / (1 + _correlations(v, toxic, fire1, clean, fire0))
        odds = v * np.log(fire1 / fire0) + (1 - v) * np.log((1 - fire1) / (1 - fire0))
        logit = np.log(prior / (1 - prior)) + odds @ weight + told
        q = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return q


def _correlations(v: np.ndarray, toxic: np.ndarray, fire1: np.ndarray, clean: np.ndarray, fire0: np.ndarray) -> np.ndarray:
    """Sum, for each voter, of its positive correlations with others once the class is known."""
    total = np.zeros((v.shape[1],) * 2)
    for mass, fire in ((toxic, fire1), (clean, fire0)):
        off = v - fire
        cov = (off * mass[:, None]).T @ off / max(mass.sum(), 1)
        total += cov / np.sqrt(np.outer(fire * (1 - fire), fire * (1 - fire))) / 2
    np.fill_diagonal(total, 0)
    return np.clip(total, 0, 1).sum(axis=1)


def train(sample: DataFrame, lexicon: Lexicon, posterior: np.ndarray) -> Model:
    """Logistic regression on posterior labels; ``sample`` is bounded and has ``label, text``."""

    def packed(doc: np.ndarray, word: np.ndarray, n: int) -> list[pa.Array]:
        held = np.zeros((n, FEATURES), bool)
        held[doc, (word >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)] = True
        return [pa.array([x.tobytes() for x in np.packbits(held, axis=1)], pa.binary())]

    rows = described(sample.select("label", "text"), lexicon, "words binary", packed).toPandas()
    votes, m = rows["votes"].to_numpy(np.int64), LEXICON_VOTERS + len(PATTERNS)
    k = FEATURES + m
    x = np.ones((len(rows), k + 1), np.float32)
    raw = np.frombuffer(b"".join(bytes(b) for b in rows["words"]), np.uint8)
    x[:, :FEATURES] = np.unpackbits(raw.reshape(len(rows), FEATURES // 8), axis=1)
    x[:, FEATURES:k] = (votes[:, None] >> np.arange(m)) & 1
    y = posterior[rows["label"].to_numpy(np.int64) + 1, votes]
    ridge = np.full(k + 1, 0.5)
    ridge[k] = 1e-3

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((np.logaddexp(0, z) - y * z).sum() + (ridge * w * w).sum() / 2)

    w = np.zeros(k + 1)
    w[k] = -2.0
    now = loss(w)
    for _ in range(25):  # Newton steps with a ridge, halved until they lead down
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * w
        hessian = (x * np.maximum(p * (1 - p), 1e-4)[:, None].astype(np.float32)).T @ x + np.diag(ridge)
        step = np.linalg.solve(hessian, gradient)
        while (then := loss(w - step)) > now and np.abs(step).max() >= 1e-6:
            step = step / 2
        w, now = w - step, then
        if np.abs(step).max() < 1e-6:
            break
    w = np.round(w, 9)
    return Model(w[:FEATURES], w[FEATURES:k], float(w[k]))


def apply(docs: DataFrame, lexicon: Lexicon, model: Model) -> DataFrame:
    """``id, score`` of each input row."""

    def weighed(doc: np.ndarray, word: np.ndarray, n: int) -> list[pa.Array]:
        feature = np.unique(doc * FEATURES + (word >> np.uint64(64 - FEATURE_BITS)).astype(np.int64))
        return [pa.array(np.bincount(feature >> FEATURE_BITS, model.words[feature % FEATURES], n))]

    rows = described(docs.select("id", "text"), lexicon, "logit double", weighed)
    logit = F.col("logit") + model.bias
    for i, w in enumerate(model.votes.tolist()):
        logit = logit + F.col("votes").bitwiseAND(1 << i).cast("boolean").cast("double") * w
    logit = F.greatest(F.least(logit, F.lit(30.0)), F.lit(-30.0))
    return rows.select("id", (1 / (1 + F.exp(-logit))).alias("score"))


def _part(id_col: Column, parts: int) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % parts


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    parts: int = 5,
    held: int = 0,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Toxicity of every document, learned from labels of ids that fall to another part than ``held``.

    A null or empty text is scored by its patterns and the bias.  An id labelled more than once is toxic if
    any of its labels says so; null labels, and labels of ids that no document has, teach nothing.  Without labels the given lexicon alone votes.  Repeated rows give
    repeated results; other columns are not read.
    """
    out = _part(F.col(id_col), parts) == held
    known = labels.select(F.col(id_col).alias("label_id"), F.col(label_col).cast("int").alias("label"))
    known = known.where((_part(F.col("label_id"), parts) != held) & F.col("label").isin(0, 1))
    known = known.groupBy("label_id").agg(F.max("label").alias("label"))
    known = sized(known, "toxic_labels")
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    rows = rows.join(known, rows.id == known.label_id, "left").select(
        "id", F.coalesce("label", F.lit(-1)).alias("label"), "text"
    )
    labelled = rows.where("label >= 0")
    marked, share = lexicon(labelled.select("label", "text"))
    found = looked_up(rows, marked)
    votes = described(rows.select("label", "text"), found, "", lambda doc, word, n: [])
    counts = votes.groupBy("label", "votes").agg(F.count("*").alias("n")).orderBy("label", "votes").toPandas()
    label, votes = counts["label"].to_numpy(np.int64), counts["votes"].to_numpy(np.int64)
    posterior = np.full((3, 1 << (LEXICON_VOTERS + len(PATTERNS))), share)
    if len(votes):
        posterior[label + 1, votes] = label_model(label, votes, counts["n"].to_numpy(float), share)
    # the bound first, from hashes alone; rows that share the last hash are equal
    row = F.xxhash64("id", "text")
    bound = labelled.select(row.alias("h")).orderBy("h").limit(sample_rows).agg(F.max("h")).first()[0]
    sample = labelled.where(row <= F.lit(bound)).limit(sample_rows)
    model = train(sample, found, posterior)
    scored = apply(rows, found, model).withColumnRenamed("id", id_col)
    return scored.select(id_col, out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
