"""Shared helpers: table reads and vectorised word hashing inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one vectorised step works on; a longer text is a step of its own.
BLOCK_BYTES = 1 << 20

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
_LOWER_LUT = np.arange(256, dtype=np.uint8)
_LOWER_LUT[65:91] += 32
_SEP_LUT = np.zeros(256, dtype=bool)
_SEP_LUT[[0x20, *range(0x09, 0x0E)]] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = {"p": np.ones(1, np.uint64), "i": np.ones(1, np.uint64)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix)."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**k and BASE**-k (mod 2**64) for k < n.  The tables of a usual block
    are kept by the worker; those of a very long text end with it."""
    if len(_powers["p"]) >= n:
        return _powers["p"], _powers["i"]
    size = next((x for x in (BLOCK_BYTES + 1, 2 * BLOCK_BYTES + 1) if n <= x), n)
    made = []
    for base in (_BASE, _BASE_INV):
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        made.append(np.multiply.accumulate(steps))
    if size <= 2 * BLOCK_BYTES + 1:
        _powers.update(p=made[0], i=made[1])
    return made[0], made[1]


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null is empty.  The bytes
    are the column's own unless a null has some."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    for _ in range(2):
        _, offsets, data = col.buffers()
        wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
        offs = np.frombuffer(offsets, np.int64 if wide else np.int32) if offsets is not None and offsets.size else np.zeros(1, np.int64)
        offs = offs[col.offset:col.offset + len(col) + 1].astype(np.int64)
        if not col.null_count or not np.diff(offs)[col.is_null().to_numpy(zero_copy_only=False)].any():
            break
        col = col.cast(pa.large_binary()).fill_null(b"")
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def release() -> None:
    """Hands memory that this worker has freed back to the system: workers are
    used again, and what one stage leaves in them would count in the next."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` with `release` before each batch and at its end."""
    @wraps(run)
    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fed():
            for batch in batches:
                yield batch
                del batch
                release()
        yield from run(fed())
        release()
    return inner


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes (one row at least)."""
    n, at = len(offsets) - 1, 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        to = min(n, max(at + 1, to))
        yield at, to
        at = to


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a block of texts: byte spans, the text
    each belongs to, and 64-bit hashes (equal words, equal hashes).  ``sep``:
    for each byte, whether it separates words."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, lower: bool = False, sep: np.ndarray = _SEP_LUT):
        self.raw, self.offsets = raw, offsets
        sep = sep[raw]
        edge = np.zeros(len(raw) + 1, bool)
        edge[offsets] = True
        before = np.ones(len(raw), bool)
        after = np.ones(len(raw), bool)
        if len(raw):
            before[1:] = sep[:-1]
            after[:-1] = sep[1:]
        self.start = np.flatnonzero(~sep & (before | edge[:-1]))
        self.end = np.flatnonzero(~sep & (after | edge[1:])) + 1
        self.row = np.searchsorted(offsets, self.start, "right") - 1
        #: first[r]..first[r + 1]: the words of row r
        self.first = np.searchsorted(self.start, offsets)
        p, inv = power_tables(len(raw) + 1)
        v = (_LOWER_LUT[raw] if lower else raw).astype(np.uint64)
        v += np.uint64(1)
        v *= p[:len(raw)]
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(v, out=total[1:])
        self._total, self._inv = total, inv
        self.hash = self.span_hash(self.start, self.end)

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of byte spans of the block."""
        h = (self._total[end] - self._total[start]) * self._inv[start]
        return mix64(h ^ (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def gram_hash(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the ``n``-grams starting at each position (all rows run on:
    the caller drops those that cross a row's end)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    m = len(h) - n + 1
    out = np.zeros(m, np.uint64)
    for k in range(n):
        out = out * np.uint64(0xF1357AEA2E62A9C5) + h[k:k + m]
        out ^= out >> np.uint64(29)
    return mix64(out, n)


def crc32_of_id(id_col):
    """crc32 of the id as text (a column)."""
    return F.crc32(id_col.cast("string").cast("binary"))
