"""Language-model scoring by a hierarchical Pitman-Yor model.

A token's context is the token before it, or the start of the document; every context is a restaurant, and all
share one parent over words, whose base is uniform.  Customers are the training tokens.  Gibbs sweeps
take each word's customers out of a restaurant and seat them again given all other tables; predictive
probabilities are averaged over the sweeps after the first ones.

Documents are packed into chunks of distinct words and token numbers.  A chunk asks the parts of the vocabulary
for its distinct (word, context) pairs, so what is shuffled is a pair per chunk and not a token; parts hold all
contexts of their words.  Beyond them a sweep needs the totals of each context, which lie in many parts: every part
sends its sums to the part a context's hash names, which adds them up and sends them back.  Shuffle files are as large as
the pairs, so every step is written as a table and its shuffles are removed at once.  Rows are megabytes long: few
at a time go to Python, and counts take as few bytes as they need.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transferkit.llm.batches import column_bytes, map_batches, mix64, pieces, tokens
from transferkit.llm.jaccard import _grouped
from transferkit.llm.tables import discard
from transferkit.llm.tables import stored as _stored
from transferkit.llm.words import text_of

# Contexts of a part made by hand; those of a corpus are as many as its words.
CLASSES = 128
CHUNK_TOKENS = 1_000_000
PART_TOKENS = 1_000_000
# Passes in which the parts answer: what is shuffled at once are the requests to, and the model of, a share of them.
ROUNDS = 2
# Bytes of rows that are sent to Python at once, or one longer row.
BATCH_BYTES = 4 << 20
BATCHES = "spark.sql.execution.arrow.maxBytesPerBatch"
# Bytes of text that are hashed at once, few enough that what is made of them stays in a core's cache.
HASHED_BYTES = 1 << 17
# Pairs that are looked up at once, or those of one longer request.
ASKED_PAIRS = 1 << 18
DISCOUNT, CONCENTRATION = 0.75, 5.0
ROOT_DISCOUNT, ROOT_CONCENTRATION = 0.5, 50.0
BURN_IN, SAMPLES = 2, 2
# Customers seated one by one; more sit down in blocks of an eighth of those before them.
SINGLE = 64
START, END = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)


def stored(df: DataFrame, name: str) -> DataFrame:
    """A table of the model; its shuffles are as large as the pairs, and gone once it is written."""
    conf = df.sparkSession.conf
    before = conf.get(BATCHES, None)
    conf.set(BATCHES, str(BATCH_BYTES))
    try:
        return _stored(df, name, compression="zstd", cleanup=True)
    finally:
        conf.unset(BATCHES) if before is None else conf.set(BATCHES, before)


def _raw(x: np.ndarray, kind) -> bytes:
    return np.ascontiguousarray(x, kind).tobytes()


def _narrow(x: np.ndarray) -> bytes:
    """Counts or numbers in as few bytes each as the largest needs."""
    most = int(x.max(initial=0))
    return _raw(x, next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if most <= np.iinfo(k).max))


def _wide(raw, n: int) -> np.ndarray:
    """``n`` numbers of ``_narrow``."""
    raw = bytes(raw)
    return np.frombuffer(raw, f"u{len(raw) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


def _sorted(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unsigned numbers and their stable order: each, or a hash's first bits, is sorted in one integer with its place."""
    bits = max(len(x) - 1, 0).bit_length()
    places = np.uint64((1 << bits) - 1)
    whole = int(x.max(initial=0)) < 1 << (64 - bits)
    key = x.astype(np.uint64) << np.uint64(bits) if whole else x & ~places
    key |= np.arange(len(x), dtype=np.uint64)
    key.sort()
    order = (key & places).astype(np.int64)
    if whole:
        return (key >> np.uint64(bits)).astype(x.dtype), order
    found = x[order]
    if (found[1:] < found[:-1]).any():  # hashes that differ in their last bits only
        order = np.argsort(x, kind="stable")
        found = x[order]
    return found, order


def _begins(x: np.ndarray) -> np.ndarray:
    """Whether a value differs from the one before it."""
    new = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=new[1:])
    return new


def _distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct unsigned numbers in order, and the place of each number among them."""
    found, order = _sorted(x)
    new = _begins(found)
    of = np.empty(len(x), np.int64)
    of[order] = np.cumsum(new) - 1
    return found[new], of


class _Places:
    """Looks up distinct hashes: the first bits of one tell where to begin, and few others share them."""

    def __init__(self, hashes: np.ndarray):
        kind = np.uint32 if len(hashes) < 1 << 32 else np.int64
        found, order = _sorted(hashes)
        self.hashes = np.append(found, np.uint64(2**64 - 1))
        self.order = np.append(order, len(order)).astype(kind)
        bits = max(len(hashes).bit_length(), 1)
        self.shift = np.uint64(64 - bits)
        n = np.bincount((self.hashes[:-1] >> self.shift).astype(np.int64), minlength=1 << bits)
        self.start = (np.cumsum(n) - n).astype(kind)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Place of each hash, one past the last if absent."""
        at = self.start[(x >> self.shift).astype(np.int64)].astype(np.int64)
        below = np.flatnonzero(self.hashes[at] < x)
        while len(below):
            at[below] += 1
            below = below[self.hashes[at[below]] < x[below]]
        return self.order[np.where(self.hashes[at] == x, at, len(self.order) - 1)].astype(np.int64)


def _chunks(docs: DataFrame) -> DataFrame:
    """Rows of ``id, held, text`` packed: ids, flags and lengths of documents, distinct words, token numbers."""
    kind = docs.schema["id"].dataType.simpleString()

    def pack(number: int, held: list) -> pa.RecordBatch:
        flat = np.concatenate([h for _, _, _, h in held])
        words, numbers = _distinct(flat)
        # frequent words get small numbers, and a number's bytes lie apart: what is stored is mostly zeros
        order = np.argsort(-np.bincount(numbers), kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        words, numbers = words[order], rank[numbers]
        ids = pa.concat_arrays([x[0] for x in held])
        counts = np.concatenate([x[2] for x in held])
        return pa.record_batch(
            [
                pa.array([(TaskContext.get().partitionId() << 32) + number]),
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                pa.array([_raw(np.concatenate([x[1] for x in held]), np.uint8)]),
                pa.array([_raw(counts, np.int64)]),
                pa.array([_raw(words, np.uint64)]),
                pa.array([_raw(numbers.view(np.uint8).reshape(-1, 4).T, np.uint8)]),
            ],
            names=["chunk", "ids", "held", "counts", "words", "numbers"],
        )

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, number = [], 0, 0
        for batch in batches:
            for piece, _, _ in pieces(batch, "text"):
                for rows, data, starts in pieces(piece, "text", HASHED_BYTES):
                    hashes, _, _, per_doc = tokens(data, starts)
                    counts = np.diff(per_doc) + 1
                    ends = np.cumsum(counts) - 1
                    flat = np.full(len(hashes) + rows.num_rows, END, np.uint64)
                    inner = np.ones(len(flat), bool)
                    inner[ends] = False
                    flat[inner] = hashes
                    flags = np.asarray(rows.column("held").to_pylist(), np.uint8)
                    held.append((rows.column("id"), flags, counts, flat))
                    size += len(flat)
                if size >= CHUNK_TOKENS:
                    yield pack(number, held)
                    held, size, number = [], 0, number + 1
        if held:
            yield pack(number, held)

    return map_batches(
        docs, emit, f"chunk long, ids array<{kind}>, held binary, counts binary, words binary, numbers binary"
    )


def _pairs(words: np.ndarray, numbers: np.ndarray, counts: np.ndarray, tokens: bool = True):
    """Distinct (word, token before) pairs of a chunk by their numbers, a document's start after all words; and each token's pair if wanted."""
    n = len(words) + 1
    kind = np.uint32 if n**2 <= 1 << 32 else np.uint64
    pair = np.empty(len(numbers), kind)
    pair[1:] = numbers[:-1]
    pair[np.cumsum(counts) - counts] = len(words)
    pair += numbers * kind(n)
    if tokens:
        pair, of = _distinct(pair)
    else:
        pair.sort()
        pair, of = pair[_begins(pair)], None
    return (pair // kind(n)).astype(np.uint32), (pair % kind(n)).astype(np.uint32), of


def _rows(batch: pa.RecordBatch, *columns: str) -> Iterator[list[np.ndarray]]:
    """The bytes of binary columns row by row, without a copy."""
    found = [column_bytes(batch.column(c)) for c in columns]
    for i in range(batch.num_rows):
        yield [data[starts[i] : starts[i + 1]] for data, starts in found]


def _as(raw: np.ndarray, kind) -> np.ndarray:
    """Bytes as numbers; copied, as they may lie unaligned."""
    return np.frombuffer(raw.tobytes(), kind)


def _chunk_arrays(words, numbers, counts, held) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    plain = np.ascontiguousarray(numbers.reshape(4, -1).T).view(np.uint32).ravel()
    return _as(words, np.uint64), plain, _as(counts, np.int64), held


def _by_part(words: np.ndarray, word: np.ndarray, parts: int, turn: tuple[int, int] = (0, 1)):
    """Pairs ordered by the part of their word: the order, the parts that occur, where each begins, its words, and where they begin.

    Pairs come in the order of their words.  ``turn``: as of ``_requests``.
    """
    part = (words % np.uint64(parts)).astype(np.uint32)
    mine = np.flatnonzero((part % turn[1] == turn[0])[word]) if turn[1] > 1 else np.arange(len(word))
    part = part[word[mine]]
    part, order = _sorted(part)
    order = mine[order]
    at = np.flatnonzero(_begins(part))
    begins = np.flatnonzero(_begins(word[order]))
    return order, part[at], np.append(at, len(order)), np.append(begins, len(order)), np.append(np.searchsorted(begins, at), len(begins))


_REQUEST = "part long, chunk long, words binary, per binary, ks binary, at binary, ns binary"


def _requests(chunks: DataFrame, parts: int, training: bool, turn: tuple[int, int] = (0, 1)) -> DataFrame:
    """A chunk's pairs by part: distinct words, pairs of each, distinct contexts, each pair's; and training tokens if wanted.

    ``turn``: which of how many shares of the parts are asked.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, raw in zip(batch.column("chunk").to_pylist(), _rows(batch, "words", "numbers", "counts", "held")):
                words, numbers, counts, held = _chunk_arrays(*raw)
                word, before, of = _pairs(words, numbers, counts, tokens=training)
                contexts = np.append(words, START)
                n = np.bincount(of[np.repeat(held == 0, counts)], minlength=len(word)) if training else None
                del numbers, of
                order, some, at, begins, own = _by_part(words, word, parts, turn)
                asked, per = words[word[order[begins[:-1]]]], np.diff(begins)
                nth = np.repeat(np.arange(len(some), dtype=np.uint64), np.diff(at))
                ks, place = _distinct(nth * np.uint64(len(contexts)) + before[order])  # frequent contexts have small numbers
                first = np.searchsorted(ks // np.uint64(len(contexts)), np.arange(len(some) + 1, dtype=np.uint64))
                place -= first[nth.astype(np.int64)]
                ks = contexts[ks % np.uint64(len(contexts))]
                n, out = n[order] if training else None, []
                for i in range(len(some)):
                    pairs, of_part, k = slice(at[i], at[i + 1]), slice(own[i], own[i + 1]), slice(first[i], first[i + 1])
                    out.append(
                        (
                            _raw(asked[of_part], np.uint64), _narrow(per[of_part]), _raw(ks[k], np.uint64), _narrow(place[pairs]),
                            _narrow(n[pairs]) if training else None,
                        )
                    )
                columns = list(zip(*out)) or [()] * 5
                yield pa.record_batch(
                    [pa.array(some, pa.int64()), pa.array([chunk] * len(out), pa.int64()), *[pa.array(c, pa.binary()) for c in columns]],
                    names=["part", "chunk", "words", "per", "ks", "at", "ns"],
                )

    return map_batches(chunks.select("chunk", "words", "numbers", "counts", "held"), emit, _REQUEST)


_STATE = (
    "part long, words binary, contexts binary, per binary, ks binary, cs binary, t binary, m binary, kept array<binary>, "
    "kept_m array<binary>, totals array<long>"
)


def _totals(cs: np.ndarray, t: np.ndarray, m: np.ndarray) -> list[int]:
    """Customers and tables of all restaurants, words, and the root's tables."""
    return [int(cs.sum()), int(t.sum()), len(m), int(m.sum())]


def _count(requests: DataFrame, parts: int) -> DataFrame:
    """The model of every part: its words, and for each its contexts with customers, at one table each.

    ``contexts`` are all that are asked for, of held-out documents too, by owner and hash; ``ks`` are places in them.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches, ("part",)):
            part = table.column("part")[0].as_py()
            words, ks, ns = [], [], []
            for batch in table.to_batches():
                for w, per, k, at, n in _rows(batch, "words", "per", "ks", "at", "ns"):
                    w = _as(w, np.uint64)
                    words.append(np.repeat(w, _wide(per, len(w))))
                    ks.append(_as(k, np.uint64)[_wide(at, len(words[-1]))])
                    ns.append(_wide(n, len(words[-1])))
            words, ks, ns = np.concatenate(words), np.concatenate(ks), np.concatenate(ns)
            contexts, ks = _distinct(ks)
            _, order = _sorted(contexts % np.uint64(parts))
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            contexts, some = contexts[order], ns > 0
            words, ks, ns = words[some], place[ks][some], ns[some]
            own, at = _distinct(words)
            pair, of = _distinct((at * len(contexts) + ks).astype(np.uint64))
            cs = np.bincount(of, ns, len(pair)).astype(np.int64)
            pair = pair.astype(np.int64)
            ks = pair % len(contexts)
            per = np.bincount(pair // len(contexts), minlength=len(own))
            t, m = np.ones(len(cs), np.int64), np.ones(len(own), np.int64)
            yield pa.record_batch(
                [
                    pa.array([part]),
                    *[pa.array([_raw(x, np.uint64)]) for x in (own, contexts)],
                    *[pa.array([_narrow(x)]) for x in (per, ks, cs, t, m)],
                    *[pa.array([[]], pa.list_(pa.binary()))] * 2,
                    pa.array([_totals(cs, t, m)]),
                ],
                names=[f.split()[0] for f in _STATE.split(", ")],
            )

    rows = requests.select("part", "words", "per", "ks", "at", "ns")
    return map_batches(rows.repartition("part").sortWithinPartitions("part"), emit, _STATE)


def _pairs_of(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A part's context hashes, and of each pair the word's number, the context's place, and the customers."""
    contexts = np.frombuffer(row["contexts"], np.uint64)
    n = row["totals"][2]
    per = _wide(row["per"], n)
    word = np.repeat(np.arange(n), per)
    return contexts, word, _wide(row["ks"], len(word)), _wide(row["cs"], len(word))


def _context_totals(state: DataFrame, parts: int, customers: bool = True) -> DataFrame:
    """``part, customers, tables``: totals over all parts of each of a part's contexts, in pieces in their order.

    Customers do not change, so those of the first model are enough.
    """
    wanted = {"customers": "cs", "tables": "t"} if customers else {"tables": "t"}

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                contexts, n = np.frombuffer(row["contexts"], np.uint64), int(_wide(row["per"], row["totals"][2]).sum())
                ks = _wide(row["ks"], n)
                own = [np.bincount(ks, _wide(row[c], n), len(contexts)).astype(np.int64) for c in wanted.values()]
                owner, at = np.unique(contexts % np.uint64(parts), return_index=True)
                cuts = list(zip(at, np.append(at[1:], len(contexts))))
                yield pa.record_batch(
                    [
                        pa.array(owner, pa.int64()), pa.array([row["part"]] * len(owner), pa.int64()),
                        pa.array([_raw(contexts[a:b], np.uint64) for a, b in cuts], pa.binary()),
                        *[pa.array([_narrow(x[a:b]) for a, b in cuts], pa.binary()) for x in own],
                    ],
                    names=["owner", "part", "contexts", *wanted],
                )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches, ("owner",)):
            rows = table.to_pylist()
            contexts = [np.frombuffer(r["contexts"], np.uint64) for r in rows]
            _, at = _distinct(np.concatenate(contexts))
            ends = np.cumsum([len(x) for x in contexts])
            found = {c: table.column(c) for c in ("part", "owner")}
            for c in wanted:
                sums = np.bincount(at, np.concatenate([_wide(r[c], len(x)) for r, x in zip(rows, contexts)])).astype(np.int64)
                mine = (sums[at[end - len(x) : end]] for x, end in zip(contexts, ends))
                found[c] = pa.array([_narrow(x) if c == "tables" else _raw(x, np.int64) for x in mine], pa.binary())
            yield from pa.table(found).combine_chunks().to_batches()

    fields = ", ".join(f"{c} binary" for c in wanted)
    shares = map_batches(
        state.select("part", "contexts", "per", "ks", *wanted.values(), "totals"), share, f"owner long, part long, contexts binary, {fields}"
    )
    dealt = shares.repartition("owner").sortWithinPartitions("owner", "part")
    summed = map_batches(dealt, add, f"part long, owner long, {fields}")
    whole = summed.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("owner", *wanted))).alias("all"))
    return stored(whole.select("part", *[f"all.{c}" for c in wanted]), "lm_contexts")


def _tables(pieces: list[bytes], contexts: np.ndarray, parts: int) -> np.ndarray:
    """Tables of a part's contexts from the pieces of their owners."""
    _, n = np.unique(contexts % np.uint64(parts), return_counts=True)
    return np.concatenate([np.zeros(0, np.int64), *[_wide(x, k) for x, k in zip(pieces, n)]])


def seat(c: np.ndarray, others: np.ndarray, chance: np.ndarray, discount: float, concentration: float, rng) -> np.ndarray:
    """Tables that ``c`` customers of one dish take, given the tables of all others and the dish's chance above."""
    t = (c > 0).astype(np.int64)
    live = np.flatnonzero(c > 1)
    c, others, chance, own = c[live], others[live], chance[live], np.ones(len(live))
    seated = 1
    while len(live):
        block = 1 if seated < SINGLE else seated // 8
        new = (concentration + discount * (others + own)) * chance
        new = new / (new + seated - discount * own)
        own += rng.random(len(live)) < new if block == 1 else rng.binomial(np.minimum(block, c - seated), np.clip(new, 0, 1))
        seated += block
        stay = c > seated
        if not stay.all():
            t[live[~stay]] = own[~stay]
            live, c, others, chance, own = (x[stay] for x in (live, c, others, chance, own))
    return t


def root_chance(n: np.ndarray, m: np.ndarray, customers: float, tables: float, v: int) -> np.ndarray:
    """A word's chance in the parent, from its customers and tables there."""
    new = (ROOT_CONCENTRATION + ROOT_DISCOUNT * tables) / (v + 1)
    return (n - ROOT_DISCOUNT * m + new) / (ROOT_CONCENTRATION + customers)


def _sweep(
    state: DataFrame, contexts: DataFrame, parts: int, totals: list[int], number: int, keep: bool, seed: int
) -> DataFrame:
    """Every word's customers leave each restaurant and sit down again, first below, then in the parent."""
    _, all_tables, v, root_tables = totals

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # one part at a time
                row = batch.slice(i, 1).to_pylist()[0]
                rng = np.random.default_rng([seed, number, row["part"]])
                hashes, word, ks, cs = _pairs_of(row)
                tables = _tables(row.pop("tables"), hashes, parts).astype(np.float64)
                t, m = _wide(row["t"], len(word)), _wide(row["m"], row["totals"][2])
                n = np.bincount(word, t, len(m))
                # without the pair's own tables
                rest = n[word] - t
                chance = root_chance(np.maximum(rest, 0), np.minimum(m[word], rest), all_tables, root_tables, v)
                t = seat(cs, tables[ks] - t, np.maximum(chance, 1e-300), DISCOUNT, CONCENTRATION, rng)
                n = np.bincount(word, t, len(m)).astype(np.int64)
                m = seat(n, np.maximum(root_tables - m, 0).astype(np.float64), np.full(len(n), 1 / (v + 1)), ROOT_DISCOUNT, ROOT_CONCENTRATION, rng)
                row |= {"t": _narrow(t), "m": _narrow(m), "totals": _totals(cs, t, m)}
                if keep:
                    row |= {"kept": [*row["kept"], row["t"]], "kept_m": [*row["kept_m"], row["m"]]}
                yield pa.RecordBatch.from_pylist([row], pa.schema([f for f in batch.schema if f.name != "tables"]))

    return map_batches(state.join(contexts.select("part", "tables"), "part"), emit, _STATE)


def _sum_totals(state: DataFrame) -> list[int]:
    """Totals over all parts, one row for each."""
    rows = state.select(F.posexplode("totals").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).collect()
    found = {r.i: r.x for r in rows}
    return [found.get(i, 0) for i in range(4)]


_OWN = ("words", "per", "ks", "at", "contexts", "cs", "kept", "kept_m", "customers", "tables")


def _model(state: DataFrame, first: DataFrame, samples: list[DataFrame]) -> DataFrame:
    """``part`` and all that its answers need: words, pairs, the contexts' customers, and of each sample all tables."""
    model = state.select("part", *[c for c in _OWN[:8] if c != "at"]).join(first.select("part", "customers"), "part")
    for i, contexts in enumerate(samples):
        model = model.join(contexts.select("part", F.col("tables").alias(f"tables{i}")), "part")
    tables = [f"tables{i}" for i in range(len(samples))]
    return model.withColumn("tables", F.array(*tables)).drop(*tables)


def _answers(requests: DataFrame, model: DataFrame, parts: int, scalars: list[list[int]]) -> DataFrame:
    """``chunk, part, c, p``: training count of each word asked for, log10 probability of each pair.

    ``scalars``: each sample's totals.  Every part has a row of the model, as it was counted from the same requests.
    """
    none = [F.lit(None).cast(model.schema[c].dataType).alias(c) for c in _OWN[4:]]
    both = model.select("part", F.lit(-1).cast("long").alias("chunk"), *_OWN[:3], F.lit(b"").alias("at"), *_OWN[4:]).unionByName(
        requests.select("part", "chunk", *_OWN[:4], *none)
    )

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, places = None, None

        def answer(rows: list) -> pa.RecordBatch:
            """Answers to requests of one part, looked up together."""
            chunks, asked, words, per, ks, at = zip(*rows)
            n, pairs = np.cumsum([len(x) for x in words])[:-1], np.cumsum([len(x) for x in at])[:-1]
            first = np.cumsum([0, *[len(x) for x in ks[:-1]]])
            ks = places.find(np.concatenate(ks))[np.concatenate([x + a for x, a in zip(at, first)])]
            c, p = part.answer(np.concatenate(words), np.concatenate(per), ks)
            p = p.astype(np.float32)
            return pa.record_batch(
                {
                    "chunk": list(chunks),
                    "part": list(asked),
                    "c": [_raw(x, np.uint32 if x.max(initial=0) < 1 << 32 else np.uint64) for x in np.split(c, n)],
                    "p": [_raw(x, np.float32) for x in np.split(p, pairs)],
                }
            )

        for batch in batches:
            chunks, asked = batch.column("chunk").to_pylist(), batch.column("part").to_pylist()
            rows, size = [], 0
            for i, (words, per, ks, at) in enumerate(_rows(batch, "words", "per", "ks", "at")):
                if rows and (chunks[i] == -1 or size >= ASKED_PAIRS):
                    yield answer(rows)
                    rows, size = [], 0
                if chunks[i] == -1:
                    row = batch.slice(i, 1).to_pylist()[0]
                    contexts, word, _, _ = _pairs_of(row | {"totals": [0, 0, len(row["words"]) // 8]})
                    for c, n in (("kept", len(word)), ("kept_m", len(row["words"]) // 8)):
                        row[c] = b"".join(_raw(_wide(x, n), np.int64) for x in row[c])
                    customers, found = np.frombuffer(b"".join(row["customers"]), np.int64), []
                    for totals, x in zip(scalars, row["tables"]):
                        found.append(np.concatenate([customers, _tables(x, contexts, parts), totals[2:]]))
                    part = _Part(row, found, [totals[1] for totals in scalars])
                    places = _Places(contexts)
                    continue
                words = _as(words, np.uint64)
                per = _wide(per, len(words))
                rows.append((chunks[i], asked[i], words, per, _as(ks, np.uint64), _wide(at, int(per.sum()))))
                size += len(rows[-1][-1])
            if rows:
                yield answer(rows)

    dealt = both.repartition("part").sortWithinPartitions("part", "chunk")
    return map_batches(dealt, emit, "chunk long, part long, c binary, p binary")


class _Part:
    """A part's words and pairs with their averaged probabilities."""

    def __init__(self, row: dict, samples: list, everywhere: list[int] | None = None):
        """Each sample: customers of the part's contexts, their tables, then words and the root's tables.

        ``everywhere``: each sample's tables of all contexts, where the part has some only.
        """
        self.words = np.frombuffer(row["words"], np.uint64)
        per = _wide(row["per"], len(self.words))
        self.word = np.repeat(np.arange(len(per)), per)
        ks, self.cs = _wide(row["ks"], len(self.word)), _wide(row["cs"], len(self.word))
        t = np.frombuffer(row["kept"], np.int64).reshape(len(samples), len(self.cs))
        m = np.frombuffer(row["kept_m"], np.int64).reshape(len(samples), len(per))
        self.c = np.bincount(self.word, self.cs, len(per)).astype(np.int64)
        self.samples = []
        self.contexts = (len(samples[0]) - 2) // 2
        for i, (s, tt, mm) in enumerate(zip(samples, t, m)):
            customers, tables = np.array(s[: self.contexts], np.float64), np.array(s[self.contexts : -2], np.float64)
            v, root_tables = s[-2:]
            all_tables = everywhere[i] if everywhere else tables.sum()
            n = np.bincount(self.word, tt, len(per))
            chance = root_chance(n, mm, all_tables, root_tables, v)
            unseen = root_chance(np.zeros(1), np.zeros(1), all_tables, root_tables, v)[0]
            back = (CONCENTRATION + DISCOUNT * tables) / (CONCENTRATION + customers)
            own = (self.cs - DISCOUNT * tt) / (CONCENTRATION + customers[ks])
            self.samples.append((np.append(chance, unseen), back, np.append(own, 0.0)))
        self.found = _Places(self.words)
        self.pairs = _Places(mix64(self.word * self.contexts + ks))

    def answer(self, words: np.ndarray, per: np.ndarray, ks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.found.find(words)
        pair = self.pairs.find(mix64(np.repeat(at, per) * self.contexts + ks))
        total = np.zeros(len(ks))
        for chance, back, own in self.samples:
            total += own[pair] + back[ks] * np.repeat(chance[at], per)
        return np.append(self.c, 0)[at], np.log10(total / len(self.samples))


def _scores(chunks: DataFrame, answers: DataFrame, parts: int, n: int, v: int) -> DataFrame:
    """Scores of a chunk's documents from the answers of all parts."""
    kind = chunks.schema["ids"].dataType.elementType.simpleString()
    got = answers.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("part", "c", "p"))).alias("got"))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, raw in enumerate(_rows(batch, "words", "numbers", "counts", "held")):
                one = batch.slice(i, 1)
                words, numbers, counts, held = _chunk_arrays(*raw)
                word, _, of = _pairs(words, numbers, counts)
                order, _, _, begins, own = _by_part(words, word, parts)
                c, p = np.zeros(len(words), np.int64), np.zeros(len(word))
                answers = pa.RecordBatch.from_struct_array(one.column("got").flatten())
                known = [_wide(x, k) for (x,), k in zip(_rows(answers, "c"), np.diff(own))]
                c[word[order[begins[:-1]]]] = np.concatenate([np.zeros(0, np.int64), *known])
                p[order] = _as(column_bytes(answers.column("p"))[0], np.float32)
                starts = np.cumsum(counts) - counts
                base = np.log10((c + 1) / (n + v + 1))
                yield pa.record_batch(
                    [
                        one.column("ids").flatten(),
                        pa.array(held != 0),
                        pa.array(counts),
                        pa.array(np.add.reduceat((c > 0)[numbers].astype(np.int64), starts)),
                        pa.array(np.full(len(counts), n)),
                        pa.array(np.add.reduceat(base[numbers], starts)),
                        pa.array(np.add.reduceat(p[of], starts)),
                    ],
                    names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    rows = chunks.select("chunk", "ids", "held", "counts", "words", "numbers").join(got, "chunk")
    return map_batches(
        rows,
        emit,
        f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )


def score_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    parts: int = 7,
    held: int = 2,
    burn_in: int = BURN_IN,
    samples: int = SAMPLES,
    seed: int = 3,
) -> DataFrame:
    """Log10 probability of every document under the model and a smoothed unigram, one row for each input row.

    Learned from documents whose id does not fall to part ``held``.  Tokens are lower-cased runs of
    non-blanks, and one end per document; a null or empty text is the end alone.  A null id counts as an empty
    one.  Without training documents all tokens are equally unlikely.  Reruns agree; other columns are not
    read.
    """
    out = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % parts == held
    rows = docs.select(F.col(id_col).alias("id"), out.alias("held"), text_of(text_col).alias("text"))
    chunks = stored(_chunks(rows), "lm_chunks")
    size = chunks.agg(F.sum(F.octet_length("numbers") / 4).alias("n")).first().n or 0
    n_parts = max(8, int(size) // PART_TOKENS)
    counted = stored(_count(_requests(chunks, n_parts, training=True), n_parts), "lm_counts")
    totals = _sum_totals(counted)
    n, v = totals[0], totals[2]
    state, kept, first = counted, [], _context_totals(counted, n_parts)
    contexts = first
    for i in range(burn_in + samples):
        swept = stored(_sweep(state, contexts, n_parts, totals, i, i >= burn_in, seed), "lm_state")
        totals = _sum_totals(swept)
        discard(state)  # the sweep before this one
        if 0 < i <= burn_in:
            discard(contexts)
        state, contexts = swept, _context_totals(swept, n_parts, customers=False)
        if i >= burn_in:
            kept.append((totals, contexts))
    model = stored(_model(state, first, [x for _, x in kept]), "lm_model")
    for done in (state, first, *[x for _, x in kept]):
        discard(done)
    scalars, answers = [x for x, _ in kept], []
    for i in range(ROUNDS):
        requests = _requests(chunks, n_parts, training=False, turn=(i, ROUNDS))
        answers.append(stored(_answers(requests, model.where(F.col("part") % ROUNDS == i), n_parts, scalars), "lm_answers"))
    discard(model)
    found = stored(_scores(chunks, reduce(DataFrame.unionByName, answers), n_parts, n, v), "lm_scores")
    for done in (chunks, *answers):
        discard(done)
    return found.withColumnRenamed("id", id_col)
