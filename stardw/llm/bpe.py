"""BPE encoding and decoding with content-defined chunk reuse.

A text is cut where a rolling hash of its last bytes hits a mask, so passages
shared by several texts give the same chunks wherever they stand.  Texts are
routed to tasks by their smallest chunk hash (copies share it, near copies
mostly do); the exchange is a ``rebalance``, so a hot route is split by size
instead of landing in one task.  Within a task a chunk is encoded once and its
ids are reused.  Chunk ends cut words, so every join is repaired: the stretch
between the nearest boundaries that *both* encodings must agree on is encoded
again, and grows until the token ends of both sides meet it exactly.

A boundary both must agree on is a single space between two visible ASCII
characters: the pre-tokeniser's pattern can only start a piece there, whatever
stands further away, and pieces are merged independently of each other.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stardw.llm.common import blocks, lean, mix64, power_tables, text_buffer

MIN_CHUNK, MAX_CHUNK, CHUNK_MASK = 256, 8192, np.uint32(0x3FF)
#: Bytes of chunk text whose ids a task keeps for reuse.
STORE_BYTES = 16 << 20
_GEAR = (mix64(np.arange(256, dtype=np.uint64), 7) >> np.uint64(16)).astype(np.uint32)


def default_vocabulary() -> str:
    """The byte-level 50k vocabulary of the installed public tokenizers."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class Codec:
    """Ids of a byte-level BPE vocabulary file (merges numbered in id order)."""

    #: FIXED VALUE: the byte-level pre-tokeniser's pattern.
    PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kind = spec.get("pre_tokenizer") or {}
        if (spec["model"].get("type", "BPE"), kind.get("type"), kind.get("add_prefix_space"), spec.get("normalizer")) != (
                "BPE", "ByteLevel", False, None):
            raise ValueError("a byte-level BPE vocabulary without prefix space or normaliser is needed")
        visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in visible]
        byte_of = {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = {k: v for k, v in spec["model"]["vocab"].items() if k not in special}
        ranks = {bytes(byte_of[c] for c in k): v for k, v in vocab.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        if any(vocab[a + b] != 256 + k for k, (a, b) in enumerate(pairs)):
            raise ValueError("merges are not numbered in id order")
        self._ranks, self._special, self._path = ranks, special, path
        by_id = {v: k for k, v in ranks.items()} | {v: k.encode() for k, v in special.items()}
        size = max(by_id) + 1
        parts = [by_id.get(k, b"") for k in range(size)]
        self.lengths = np.array([len(x) for x in parts], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.bytes = np.frombuffer(b"".join(parts), np.uint8)

    @cached_property
    def encoding(self):
        """The merges, built where a task first encodes."""
        import tiktoken
        return tiktoken.Encoding(self._path, pat_str=self.PATTERN, mergeable_ranks=self._ranks, special_tokens=self._special)

    def encode(self, data: bytes) -> np.ndarray:
        ids = self.encoding.encode(data.decode("utf-8", "replace"), allowed_special="all")
        return np.array(ids, np.uint32)

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 bytes of the ids' tokens, special ones included."""
        n = self.lengths[ids]
        ends = np.cumsum(n)
        if not len(ids):
            return b""
        at = np.arange(ends[-1]) + np.repeat(self.starts[ids] - (ends - n), n)
        return self.bytes[at].tobytes()


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


def chunk_cuts(raw: np.ndarray, offsets: np.ndarray) -> list[list[int]]:
    """Chunk starts of each row (its own start first), from a rolling hash of
    the last 16 bytes; cuts never split a character."""
    h = _GEAR[raw]
    for step in (1, 2, 4, 8):  # each doubles the window
        if len(h) > step:
            g = h.copy()
            g[step:] ^= (h[:-step] << np.uint32(step)) | (h[:-step] >> np.uint32(32 - step))
            h = g * np.uint32(0x9E3779B1)
    hits = np.flatnonzero(((h >> np.uint32(12)) & CHUNK_MASK) == 0) + 1
    inner = (raw & 0xC0) == 0x80
    out = []
    for r in range(len(offsets) - 1):
        a, b = int(offsets[r]), int(offsets[r + 1])
        cuts = [a]
        near = hits[np.searchsorted(hits, a + MIN_CHUNK):np.searchsorted(hits, b)].tolist()
        for at in [*near, b]:
            while at - cuts[-1] > MAX_CHUNK:
                forced = cuts[-1] + MAX_CHUNK
                while inner[forced]:
                    forced -= 1
                cuts.append(forced)
            if at < b and at - cuts[-1] >= MIN_CHUNK:
                while at < b and inner[at]:
                    at += 1
                if at < b:
                    cuts.append(at)
        out.append(cuts)
    return out


class ChunkStore:
    """Ids of the chunks met lately; the older half goes when it is full."""

    def __init__(self, codec: Codec, limit: int = STORE_BYTES):
        self.codec, self.limit = codec, limit
        self.new: dict[bytes, np.ndarray] = {}
        self.old: dict[bytes, np.ndarray] = {}
        self.size = self.encoded = self.reused = 0

    def ids(self, chunk: bytes) -> np.ndarray:
        got = self.new.get(chunk)
        if got is not None:
            self.reused += 1
            return got
        got = self.old.get(chunk)
        if got is None:
            self.encoded += 1
            got = self.codec.encode(chunk)
        else:
            self.reused += 1
        if self.size > self.limit // 2:
            self.old, self.new, self.size = self.new, {}, 0
        self.new[chunk] = got
        self.size += len(chunk)
        return got


def encode_chunks(text: bytes, cuts: list[int], joints: np.ndarray, store: ChunkStore) -> np.ndarray:
    """Ids of ``text`` from its chunks' ids.  ``cuts``: chunk starts from 0;
    ``joints``: positions of the boundaries on which any two encodings agree."""
    if len(cuts) == 1:
        return store.ids(text)
    ends = [*cuts[1:], len(text)]
    chunks = [store.ids(text[a:b]) for a, b in zip(cuts, ends, strict=True)]
    bounds = [np.concatenate([[a], a + np.cumsum(store.codec.lengths[x])]) for a, x in zip(cuts, chunks, strict=True)]

    def agreed(k: int, at: int) -> bool:
        i = np.searchsorted(bounds[k], at)
        return i < len(bounds[k]) and bounds[k][i] == at

    def where(lo: int, hi: int, k: int, last: bool) -> int | None:
        """The last (first) joint in [lo, hi] at which chunk k has a token end."""
        near = joints[np.searchsorted(joints, lo):np.searchsorted(joints, hi, "right")]
        return next((int(x) for x in (near[::-1] if last else near) if agreed(k, int(x))), None)

    gaps: list[list[int]] = []  # stretches to encode again, as [from, to, first chunk, last chunk]
    for k in range(1, len(cuts)):
        first, last, left, right = k - 1, k, None, None
        while left is None:  # grows to earlier chunks if this one has no such boundary
            left = where(cuts[first] + 1, ends[first] - 2, first, True)
            if left is None:
                if first == 0:
                    left = 0
                else:
                    first -= 1
        while right is None:
            right = where(cuts[last] + 1, ends[last] - 2, last, False)
            if right is None:
                if last == len(cuts) - 1:
                    right = len(text)
                else:
                    last += 1
        if gaps and left <= gaps[-1][1]:
            gaps[-1][1], gaps[-1][3] = max(right, gaps[-1][1]), max(last, gaps[-1][3])
            if left < gaps[-1][0]:
                gaps[-1][0], gaps[-1][2] = left, first
        else:
            gaps.append([left, right, first, last])
        while len(gaps) > 1 and gaps[-1][0] <= gaps[-2][1]:
            a, b = gaps.pop(-2), gaps.pop()
            gaps.append([min(a[0], b[0]), max(a[1], b[1]), min(a[2], b[2]), max(a[3], b[3])])
    out, at, k = [], 0, 0  # all before byte ``at`` is out; it lies in chunk k
    for left, right, first, last in gaps:
        while k < first:  # whole chunks between two gaps (only the last gap's end and this one's start share one)
            out.append(chunks[k][np.searchsorted(bounds[k], at):])
            k, at = k + 1, ends[k]
        out.append(chunks[first][np.searchsorted(bounds[first], at):np.searchsorted(bounds[first], left)])
        out.append(store.ids(text[left:right]))
        k, at = last, right
    out.append(chunks[k][np.searchsorted(bounds[k], at):])
    return np.concatenate(out)


def _joints(raw: np.ndarray) -> np.ndarray:
    """Single spaces between two visible ASCII characters."""
    if len(raw) < 3:
        return np.zeros(0, np.int64)
    visible = (raw > 0x20) & (raw < 0x7F)
    return np.flatnonzero((raw[1:-1] == 0x20) & visible[:-2] & visible[2:]) + 1


@lean
def _routes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offsets = text_buffer(batch.column("text"))
        route = np.zeros(batch.num_rows, np.int64)
        for lo, hi in blocks(offsets):
            part, offs = raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
            p, inv = power_tables(len(part) + 1)
            total = np.zeros(len(part) + 1, np.uint64)
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * p[:len(part)], out=total[1:])
            for r, cuts in enumerate(chunk_cuts(part, offs)):
                ends = [*cuts[1:], offs[r + 1]]
                route[lo + r] = mix64((total[ends] - total[cuts]) * inv[cuts]).min().astype(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), pa.array(route)], ["doc_id", "text", "route"])


def _encoder(path: str):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = ChunkStore(codec(path))
        for batch in batches:
            raw, offsets = text_buffer(batch.column("text"))
            for lo, hi in blocks(offsets):
                part, offs = raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
                joints, data, ids = _joints(part), part.tobytes(), []
                for r, cuts in enumerate(chunk_cuts(part, offs)):
                    a, b = int(offs[r]), int(offs[r + 1])
                    near = joints[np.searchsorted(joints, a + 1):np.searchsorted(joints, b - 1)] - a
                    ids.append(encode_chunks(data[a:b], [c - a for c in cuts], near, store) if b > a else np.zeros(0, np.uint32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array([len(x) for x in ids], pa.int64()),
                     pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())], ["doc_id", "n_tokens", "ids"])
    return run


def bpe_encode(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids`` for every row of ``docs``; ``ids`` holds
    little-endian unsigned 32-bit ids.

    Special tokens' strings in a text become their ids, none are added.  Null
    and empty texts have no ids; null and repeated ids keep their rows; other
    columns are ignored; an empty table gives no rows.
    """
    path = vocabulary or default_vocabulary()
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    routed = rows.mapInArrow(_routes, f"doc_id {kind}, text string, route long").hint("rebalance", "route")
    return routed.select("doc_id", "text").mapInArrow(_encoder(path), f"doc_id {kind}, n_tokens long, ids binary")


def bpe_decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded``: the text of every row of `bpe_encode`
    (null ids: null); bytes that are no UTF-8 become U+FFFD."""
    path = vocabulary or default_vocabulary()

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            ids = batch.column("ids")
            for x in range(0, batch.num_rows, 256):
                part = ids.slice(x, 256)
                texts = [None if v is None else c.decode(np.frombuffer(v, "<u4")).decode("utf-8", "replace") for v in part.to_pylist()]
                got = batch.slice(x, 256)
                yield pa.RecordBatch.from_arrays([*got.columns, pa.array(texts, pa.string())], [*got.schema.names, "decoded"])
    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids binary, decoded string")

