"""Repeated passages by a depth-limited radix sort of suffixes.

Suffixes are ordered only through the threshold, by most-significant-digit passes.  The first digit is 50
bytes, and of all suffixes only those take part whose digit has the smallest hash in some window of threshold
length: every window has exactly one such anchor, chosen by its content, so equal windows have equal anchors
at equal distance.  Digits met once end there.  The next digit is the anchor's whole surrounding, the bytes of
all windows it stands for; where all surroundings of an anchor are equal, so are its windows.  The last digit
tells the windows of differing surroundings apart: equal groups are the repeated windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transferkit.llm.batches import _VALUE, column_bytes, map_batches, mix64, pieces, powers
from transferkit.llm.tables import sized, stored
from transferkit.llm.words import text_of

WINDOW = 200
DIGIT = 50
# Longer documents are worked off in overlapping segments of so many bytes.
SEGMENT = 1 << 21
# Repeated digits up to which the sorted list of them (8 bytes each) is broadcast; a longer one is joined.
BROADCAST_DIGITS = 4_000_000
# Surroundings of one anchor up to which one task compares them; more are dealt out window by window.
GROUP_ROWS = 20_000
BATCH_ROWS = 4_000


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by running minima from both sides of blocks."""
    n = len(x) - width + 1
    pad = -len(x) % width
    blocks = np.concatenate([x, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def _totals(data: np.ndarray) -> np.ndarray:
    up, _ = powers(max(len(data), 1 << 12))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * up[: len(data)], out=total[1:])
    return total


def anchors(data: np.ndarray, starts: np.ndarray, window: int = WINDOW, digit: int = DIGIT):
    """Of each document's windows: anchor hash, hash of the surrounding, document, anchor place, first and
    last window that it stands for."""
    n = len(data)
    if n < window:
        return None
    total = _totals(data)
    _, down = powers(max(n, 1 << 12))
    place = np.arange(n - digit + 1)
    hashes = mix64((total[digit:] - total[:-digit]) * down[: len(place)])
    # the order is by the upper half of the hash, then from the left
    key = (hashes & np.uint64(0xFFFFFFFF00000000)) | place.astype(np.uint64)
    anchor = (_sliding_min(key, window - digit + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    doc = np.searchsorted(starts, np.arange(len(anchor)), "right") - 1
    inside = np.flatnonzero(np.arange(len(anchor)) + window <= starts[doc + 1])
    if not len(inside):
        return None
    own, of = anchor[inside], doc[inside]
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (of[1:] != of[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(own)) - 1
    at, lo, hi, of = own[first], inside[first], inside[last], of[first]
    around = (total[hi + window] - total[lo]) * down[lo]
    shape = ((at - lo) * 1024 + (hi - lo)).astype(np.uint64)
    return hashes[at], mix64(around + mix64(shape)), of, at, lo, hi


def _segments(batch: pa.RecordBatch, window: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, int]]:
    """Pieces of a batch, long documents in segments that share ``window - 1`` bytes: rows, bytes, starts, shift."""
    for rows, data, starts in pieces(batch, "text"):
        if len(data) <= 2 * SEGMENT:
            yield rows, data, starts, 0
            continue
        for a in range(0, max(len(data) - window + 1, 1), SEGMENT):
            part = data[a : a + SEGMENT + window - 1]
            yield rows, part, np.array([0, len(part)]), a


def _repeated_digits(docs: DataFrame, window: int) -> DataFrame:
    """``digit, mixed``: digits of two anchors or more, and whether their surroundings differ."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, starts, _ in _segments(batch, window):
                if (found := anchors(data, starts, window)) is not None:
                    yield pa.record_batch({"digit": found[0].view(np.int64), "around": found[1].view(np.int64)})

    rows = map_batches(docs.select("text"), emit, "digit long, around long")
    rows = rows.groupBy("digit").agg(F.count("*").alias("n"), F.min("around").alias("a"), F.max("around").alias("b"))
    return rows.where("n > 1").select("digit", (F.col("a") != F.col("b")).alias("mixed"))


def _members(docs: DataFrame, repeated: DataFrame, window: int) -> DataFrame:
    """Anchors whose digit repeats: ``id, text_hash, digit, around, mixed, at, lo, hi`` and, if mixed, ``bytes``."""
    id_type = docs.schema["id"].dataType.simpleString()
    count = repeated.count()
    known = None
    if count <= BROADCAST_DIGITS:
        table = repeated.toArrow()
        digit = table.column("digit").to_numpy()
        order = np.argsort(digit)
        known = docs.sparkSession.sparkContext.broadcast((digit[order], table.column("mixed").to_numpy()[order]))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, starts, shift in _segments(batch, window):
                found = anchors(data, starts, window)
                if found is None:
                    continue
                digit, around, of, at, lo, hi = found
                digit = digit.view(np.int64)
                mixed = np.ones(len(digit), bool)
                if known is not None:
                    digits, flags = known.value
                    if not len(digits):
                        continue
                    k = np.minimum(np.searchsorted(digits, digit), len(digits) - 1)
                    some = np.flatnonzero(digits[k] == digit)
                    mixed = flags[k[some]]
                    digit, around, of, at, lo, hi = (x[some] for x in (digit, around, of, at, lo, hi))
                raw = data.tobytes()
                begin = starts[of] - shift
                yield pa.record_batch(
                    [
                        rows.column("id").take(pa.array(of)),
                        rows.column("text_hash").take(pa.array(of)),
                        pa.array(digit),
                        pa.array(around.view(np.int64)),
                        pa.array(mixed),
                        pa.array(at - begin),
                        pa.array(lo - begin),
                        pa.array(hi - begin),
                        pa.array([raw[a : b + window] if m else None for a, b, m in zip(lo, hi, mixed)], pa.binary()),
                    ],
                    names=["id", "text_hash", "digit", "around", "mixed", "at", "lo", "hi", "bytes"],
                )

    rows = map_batches(
        docs,
        emit,
        f"id {id_type}, text_hash long, digit long, around long, mixed boolean, at long, lo long, hi long, bytes binary",
    )
    if known is None:
        rows = rows.drop("mixed").join(repeated, "digit")
    return rows


def _window_hashes(at: np.ndarray, raw: pa.Array, window: int, digit: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows x relative starts: the hash of each window of each surrounding, and which of them exist.

    ``at``: bytes before the anchor.  Column c is the window that begins (window - digit - c) bytes before it.
    """
    data, starts = column_bytes(raw)
    reach = window - digit
    length = np.diff(starts)
    total = _totals(data)
    _, down = powers(max(len(data), 1 << 12))
    begin = (starts[:-1] + at - reach)[:, None] + np.arange(reach + 1)
    valid = (begin >= starts[:-1, None]) & (begin + window <= (starts[:-1] + length)[:, None])
    begin = np.where(valid, begin, 0)
    hashes = (total[np.minimum(begin + window, len(data))] - total[begin]) * down[np.minimum(begin, len(data) - 1)]
    return mix64(hashes.ravel()).reshape(hashes.shape), valid


def _runs(digit: np.ndarray, around: np.ndarray, again: np.ndarray, valid: np.ndarray, reach: int) -> pa.RecordBatch:
    """Runs of repeated windows of each surrounding, as first and last start relative to the anchor."""
    edge = np.zeros((len(again), again.shape[1] + 2), np.int8)
    edge[:, 1:-1] = again & valid
    step = np.diff(edge, axis=1)
    row, first = np.nonzero(step == 1)
    _, last = np.nonzero(step == -1)
    return pa.record_batch(
        {"digit": digit[row], "around": around[row], "first": first - reach, "last": last - 1 - reach}
    )


_RUNS = "digit long, around long, first long, last long"


def _compare(groups: DataFrame, window: int, digit_width: int) -> DataFrame:
    """Repeated windows among the surroundings of each digit, whole digits to a task."""
    reach = window - digit_width

    def work(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        raw = rows.column("bytes").combine_chunks()
        hashes, valid = _window_hashes(rows.column("at").to_numpy(), raw, window, digit_width)
        flat = hashes[valid]
        order = np.argsort(flat, kind="stable")
        ordered = flat[order]
        same = ordered[1:] == ordered[:-1]
        twice = np.zeros(len(flat), bool)
        twice[order[1:]] = same
        twice[order[:-1]] |= same
        again = np.zeros(valid.shape, bool)
        again[valid] = twice
        again |= (rows.column("n").to_numpy() > 1)[:, None]
        return _runs(rows.column("digit").to_numpy(), rows.column("around").to_numpy(), again, valid, reach)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if held.num_rows < BATCH_ROWS:
                continue
            digits = held.column("digit").to_numpy()
            cut = int(np.flatnonzero(digits != digits[-1])[-1]) + 1 if (digits != digits[-1]).any() else 0
            while cut:  # whole digits, some thousand rows at a time
                upto = min(cut, BATCH_ROWS)
                while upto < cut and digits[upto] == digits[upto - 1]:
                    upto += 1
                yield work(held.slice(0, upto))
                held, digits, cut = held.slice(upto), digits[upto:], cut - upto
        if held is not None and held.num_rows:
            yield work(held)

    dealt = groups.repartition("digit").sortWithinPartitions("digit")
    return map_batches(dealt.select("digit", "around", "at", "n", "bytes"), emit, _RUNS)


def _compare_dealt(groups: DataFrame, window: int, digit_width: int) -> DataFrame:
    """The same for digits with very many surroundings: one row per window, counted by two hashes."""
    reach = window - digit_width

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(i, BATCH_ROWS)
                hashes, valid = _window_hashes(part.column("at").to_numpy(), part.column("bytes"), window, digit_width)
                row, column = np.nonzero(valid)
                yield pa.record_batch(
                    {
                        "digit": part.column("digit").to_numpy()[row],
                        "around": part.column("around").to_numpy()[row],
                        "n": part.column("n").to_numpy()[row],
                        "start": column - reach,
                        "window": hashes[valid].view(np.int64),
                    }
                )

    rows = map_batches(
        groups.select("digit", "around", "at", "n", "bytes"),
        explode,
        "digit long, around long, n long, start long, window long",
    )
    repeated = rows.groupBy("digit", "start", "window").agg(F.sum("n").alias("total")).where("total > 1").drop("total")
    rows = rows.join(repeated, ["digit", "start", "window"])
    return rows.select("digit", "around", F.col("start").alias("first"), F.col("start").alias("last"))


def repeated_ranges(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``id, text_hash, ranges``: byte ranges covered by repeated windows, of documents that have any.

    ``docs`` has ``id, text, text_hash``; ranges are maximal, [from, to), and in order.
    """
    repeated = stored(_repeated_digits(docs, window), "suffix_digits")
    members = stored(_members(docs, repeated, window), "suffix_members")
    whole = members.where("not mixed").select("id", "text_hash", "lo", (F.col("hi") + window).alias("to"))
    mixed = members.where("mixed")
    groups = mixed.groupBy("digit", "around").agg(
        F.count("*").alias("n"), F.first(F.col("at") - F.col("lo")).alias("at"), F.first("bytes").alias("bytes")
    )
    groups = stored(groups, "suffix_groups")
    many = groups.groupBy("digit").agg(F.count("*").alias("k")).where(F.col("k") > GROUP_ROWS).select("digit")
    many = sized(many, "suffix_hot_digits")
    runs = _compare(groups.join(many, "digit", "left_anti"), window, DIGIT)
    if not many.isEmpty():
        runs = runs.unionByName(_compare_dealt(groups.join(many, "digit", "left_semi"), window, DIGIT))
    part = mixed.select("id", "text_hash", "digit", "around", "at").join(runs, ["digit", "around"])
    part = part.select(
        "id", "text_hash", (F.col("at") + F.col("first")).alias("lo"), (F.col("at") + F.col("last") + window).alias("to")
    )
    ranges = whole.unionByName(part).groupBy("id", "text_hash").agg(F.collect_list(F.struct("lo", "to")).alias("ranges"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = batch.column("ranges")
            flat, ends = runs.flatten(), np.cumsum([0, *(len(r) for r in runs)])
            lo, to = flat.field("lo").to_numpy(), flat.field("to").to_numpy()
            merged = [_union(lo[a:b], to[a:b]) for a, b in zip(ends, ends[1:])]
            yield pa.record_batch(
                [batch.column("id"), batch.column("text_hash"), pa.array(merged, batch.schema.field("ranges").type)],
                names=["id", "text_hash", "ranges"],
            )

    id_type = docs.schema["id"].dataType.simpleString()
    return map_batches(ranges, merge, f"id {id_type}, text_hash long, ranges array<struct<lo: long, to: long>>")


def _union(lo: np.ndarray, to: np.ndarray) -> list[dict]:
    """Maximal runs of ranges that overlap or touch, in order."""
    order = np.argsort(lo, kind="stable")
    lo, reach = lo[order], np.maximum.accumulate(to[order])
    first = np.flatnonzero(np.append(True, lo[1:] > reach[:-1]))
    last = np.append(first[1:], len(lo)) - 1
    return [{"lo": a, "to": b} for a, b in zip(lo[first].tolist(), reach[last].tolist())]


def _kept(raw: bytes, runs: list[dict] | None) -> bytes:
    """The bytes outside the runs."""
    ends = [0, *(r["to"] for r in runs or ())]
    begins = [*(r["lo"] for r in runs or ()), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(ends, begins))


def _with_ranges(docs: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """``row, id, text, ranges``."""
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_col).alias("id"),
        text_of(text_col).alias("text"),
    ).withColumn("text_hash", F.xxhash64("text"))
    ranges = sized(repeated_ranges(rows.select("id", "text_hash", "text"), window), "suffix_ranges")
    on = rows.id.eqNullSafe(ranges.id) & (rows.text_hash == ranges.text_hash)
    return rows.join(ranges, on, "left").select("row", rows.id.alias("id"), "text", "ranges")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """What repeats of every document, and a digest of what is left, one row for each input row.

    Bytes of a ``window``-byte string that also starts anywhere else are removed, in all places where it
    stands.  Null and shorter texts lose nothing; repeated rows repeat each other.  Other columns are not read.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, ranges in zip(batch.column("text").cast(pa.large_binary()), batch.column("ranges")):
                raw, runs = text.as_py(), ranges.as_py() or []
                kept = _kept(raw, runs)
                out.append((len(raw), len(raw) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*out)) or [()] * 4
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.record_batch(
                [batch.column("id"), *[pa.array(c, t) for c, t in zip(columns, types)]],
                names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    rows = _with_ranges(docs, id_col, text_col, window).select("id", "text", "ranges")
    kind = rows.schema["id"].dataType.simpleString()
    out = map_batches(rows, emit, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.withColumnRenamed("id", id_col)


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The input's rows and columns with repeated passages cut from the text.

    A character that a cut would split goes as well.  Texts that lose nothing are unchanged, null stays null.
    """

    @F.pandas_udf("string")
    def cut(text, ranges):
        kept = [t if r is None else _kept(t.encode(), list(r)).decode("utf-8", "ignore") for t, r in zip(text, ranges)]
        return pd.Series(kept, dtype=object)

    rows = _with_ranges(docs, id_col, text_col, window)
    text = F.when(F.col("ranges").isNull(), F.col("row")[text_col]).otherwise(cut("text", "ranges"))
    return rows.select(*[(text if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns])
