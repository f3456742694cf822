"""Texts of an Arrow batch as byte arrays, and their words as 64-bit hashes.

Batches are worked off in pieces of some megabytes, so the memory of a task does not grow with a batch; one
document is never cut.
"""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

import transferkit

PIECE_BYTES = 1 << 20


def _lut(word_bytes) -> np.ndarray:
    """Byte -> lower-cased byte, 0 where it stands between words."""
    table = np.zeros(256, np.uint8)
    for b in range(256):
        if word_bytes(b):
            table[b] = b + 32 if 0x41 <= b <= 0x5A else b
    return table


# letters, digits and bytes beyond ASCII
ALNUM = _lut(lambda b: 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)
# all but blanks; byte 0 is a character too, hence the shift by the caller's mask
NONBLANK = ~np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 32

_RNG = np.random.default_rng(20_240_601)
_VALUE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_CACHE: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """First ``n`` powers of the hash base and of its inverse modulo 2^64."""
    if len(_CACHE.get("up", ())) < n:
        _CACHE["up"], _CACHE["down"] = _powers(_BASE, n), _powers(_INVERSE, n)
    return _CACHE["up"][:n], _CACHE["down"][:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """Scatters 64-bit numbers; one to one."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def map_batches(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with workers that find this package where the driver has it, as local ones must.

    Workers live on for later tasks; what a task has freed goes back to the system at its end.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(transferkit.__file__)))
    env = df.sparkSession.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), root) if x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library keeps freed arrays
        if trim:
            trim(0)

    return df.mapInArrow(run, schema)


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text or binary column without nulls, and each value's start, one more for the end."""
    kind = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    column = column.cast(kind)
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    if data is None:
        return np.zeros(0, np.uint8), starts - starts[0]
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def pieces(batch: pa.RecordBatch, text: str, limit: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows with at most ``limit`` bytes of text, or one longer row: rows, bytes, starts."""
    data, starts = column_bytes(batch.column(text))
    i, n = 0, batch.num_rows
    while i < n:
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + limit, "right")) - 1)
        yield batch.slice(i, j - i), data[starts[i] : starts[j]], starts[i : j + 1] - starts[i]
        i = j


def spans(inside: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every run of true bytes; runs end with their document."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    bounds = starts[(starts > 0) & (starts < len(inside))]
    first[bounds] = inside[bounds]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[bounds - 1] = inside[bounds - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def span_hashes(folded: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of bytes, the same wherever it stands."""
    if not len(begin):
        return np.zeros(0, np.uint64)
    up, down = powers(max(len(folded), 1 << 12))
    total = np.zeros(len(folded) + 1, np.uint64)
    np.cumsum(_VALUE[folded] * up[: len(folded)], out=total[1:])
    return mix64((total[end] - total[begin]) * down[begin])


def words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words: hashes, begins, ends, and the index of each document's first word, one more at the end."""
    folded = ALNUM[data]
    begin, end = spans(folded != 0, starts)
    return span_hashes(folded, begin, end), begin, end, np.searchsorted(begin, starts)


def tokens(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased runs of non-blank bytes, as ``words``."""
    begin, end = spans(NONBLANK[data], starts)
    return span_hashes(FOLD[data], begin, end), begin, end, np.searchsorted(begin, starts)


def word_hash(word: str) -> int:
    """The hash ``words`` gives to a lower-cased word."""
    raw = np.frombuffer(word.encode(), np.uint8)
    return int(span_hashes(raw, np.array([0]), np.array([len(raw)]))[0])
