"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transferkit.llm.batches import map_batches, pieces
from transferkit.llm.words import text_of

ORDERS = (1, 2, 3, 4)
BUCKET_BITS = 16
SMOOTHING = 0.1
UNDECIDED = "und"
# Count tables a training task holds before it hands them on, each half a megabyte.
HELD = 64

# small letters of the characters below; an ASCII character that is no letter is a blank to the model
_SHAPES = 1 << 16
_SHAPE = np.arange(_SHAPES, dtype=np.uint32)
for _c in range(_SHAPES):
    _small = chr(_c).lower()
    _SHAPE[_c] = ord(_small) if len(_small) == 1 else _c
_SHAPE[[c for c in range(128) if not 0x61 <= _SHAPE[c] <= 0x7A]] = 0x20


def characters(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, in small letters, and where each document's begin, one more at the end."""
    lead = (data & 0xC0) != 0x80
    at = np.flatnonzero(lead)
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    first, second, third, fourth = (padded[at + k].astype(np.uint32) for k in range(4))
    second, third, fourth = second & 0x3F, third & 0x3F, fourth & 0x3F
    code = np.where(
        first < 0xC0,
        first,
        np.where(
            first < 0xE0,
            (first & 0x1F) << 6 | second,
            np.where(first < 0xF0, (first & 0x0F) << 12 | second << 6 | third, (first & 0x07) << 18 | second << 12 | third << 6 | fourth),
        ),
    ).astype(np.uint32)
    low = code < _SHAPES
    code[low] = _SHAPE[code[low]]
    return code, np.concatenate([[0], np.cumsum(lead)])[starts]


def grams(shape: np.ndarray, starts: np.ndarray, bits: int = BUCKET_BITS) -> Iterator[np.ndarray]:
    """For every order, each character's n-gram as a bucket; one bucket more where it would leave the document."""
    code = np.zeros(len(shape), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        code *= np.uint64(0x9E3779B97F4A7C15)
        code[: len(shape) - n + 1] += shape[n - 1 :]
        if n in ORDERS:
            mixed = code ^ np.uint64(n * 0x3C6EF372FE94F82B & 0xFFFFFFFFFFFFFFFF)
            mixed ^= mixed >> np.uint64(29)
            bucket = ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - bits)).astype(np.int64)
            for back in range(1, n):
                at = starts[1:] - back
                bucket[at[at >= 0]] = 1 << bits
            yield bucket


def language_counts(training: DataFrame, bits: int = BUCKET_BITS) -> DataFrame:
    """``lang, bucket, n`` over rows of ``lang, text``; bucket -1 counts documents."""
    size = (1 << bits) + 1

    def rows_of(held: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, total in held.items():
            some = np.flatnonzero(total)
            yield pa.record_batch(
                {"lang": [lang] * len(some), "bucket": (some - 1).astype(np.int32), "n": total[some]}
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for rows, data, starts in pieces(batch, "text"):
                langs = np.asarray(rows.column("lang").to_pylist(), object)
                data, starts = characters(data, starts)
                for lang in dict.fromkeys(langs):
                    if lang not in held and len(held) >= HELD:
                        yield from rows_of(held)
                        held = {}
                    total = held.setdefault(lang, np.zeros(size, np.int64))
                    mine = np.flatnonzero(langs == lang)
                    total[0] += len(mine)
                    length = np.diff(starts)[mine]
                    own = np.concatenate([data[starts[i] : starts[i + 1]] for i in mine])
                    bounds = np.concatenate([[0], np.cumsum(length)])
                    for bucket in grams(own, bounds, bits):
                        total[1:] += np.bincount(bucket, minlength=size)[: size - 1]
        yield from rows_of(held)

    counts = map_batches(training.select("lang", "text"), count, "lang string, bucket int, n long")
    return counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(training: DataFrame, bits: int = BUCKET_BITS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages by code point, log priors, and log probabilities (buckets + 1, languages).

    What comes to the driver is at most 2^bits + 1 counts for each language.
    """
    counts = language_counts(training, bits).toPandas()
    langs = sorted(counts["lang"].unique())
    table = np.zeros(((1 << bits) + 1, len(langs)))
    at = counts["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(dtype=np.int64)
    bucket = counts["bucket"].to_numpy(dtype=np.int64)
    table[bucket, at] = counts["n"].to_numpy()  # row -1, the last, has the documents
    prior = np.log(table[-1] / table[-1].sum()) if langs else np.zeros(0)
    seen = table[:-1] + SMOOTHING
    logs = np.zeros_like(table, dtype=np.float32)  # grams that leave the document count nothing
    logs[:-1] = np.log(seen / seen.sum(axis=0))
    return langs, prior, logs


def predict(docs: DataFrame, model: tuple, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``lang_pred`` and ``score``, the posterior of it, for each input row."""
    langs, prior, logs = model
    shared = docs.sparkSession.sparkContext.broadcast(logs)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = shared.value
        bits = (len(logs) - 1).bit_length() - 1
        for batch in batches:
            for rows, data, starts in pieces(batch, "text"):
                data, starts = characters(data, starts)
                total = np.tile(prior, (rows.num_rows, 1))
                full = np.flatnonzero(np.diff(starts))
                if len(full) and langs:
                    for bucket in grams(data, starts, bits):
                        for k in range(len(langs)):
                            total[full, k] += np.add.reduceat(logs[bucket, k], starts[full], dtype=np.float64)
                decided = np.asarray(rows.column("has_letter").to_pylist(), bool) & bool(langs)
                if langs:
                    total -= total.max(axis=1, keepdims=True)
                    likely = np.exp(total)
                    best = total.argmax(axis=1)
                    sure = likely.max(axis=1) / likely.sum(axis=1)
                else:
                    best, sure = np.zeros(rows.num_rows, int), np.zeros(rows.num_rows)
                names = [langs[b] if d else UNDECIDED for b, d in zip(best, decided)]
                yield pa.record_batch(
                    [rows.column("id"), pa.array(names, pa.string()), pa.array(np.where(decided, sure, 0.0))],
                    names=["id", "lang_pred", "score"],
                )

    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    rows = rows.select("*", F.col("text").rlike(r"\p{L}").alias("has_letter"))
    out = map_batches(rows, score, f"id {rows.schema['id'].dataType.simpleString()}, lang_pred string, score double")
    return out.withColumnRenamed("id", id_col)


def identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", parts: int = 3, held: int = 1
) -> DataFrame:
    """Predicted language of every document, learned from those whose id falls to another part than ``held``.

    A null text or one without a letter is ``und`` with score 0, and so is all if nothing can be learned.
    Equal posteriors go to the language first by code point.  A null id counts as an empty one.  Repeated rows
    give repeated results; rows without a language are predicted but not learned from.
    """
    out = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % parts == held
    training = docs.where(~out & F.col(lang_col).isNotNull())
    model = fit(training.select(F.col(lang_col).alias("lang"), text_of(text_col).alias("text")))
    return predict(docs, model, id_col, text_col).select(id_col, out.alias("held_out"), "lang_pred", "score")
