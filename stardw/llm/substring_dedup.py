"""Substring dedup by super-k-mer partitioning.

A window is ``k`` consecutive words; its minimiser is the smallest hash among
its ``m``-word grams.  Consecutive windows that share a minimiser travel as one
packed string (a super-k-mer) to the minimiser's bucket, where sorted window
hashes (128 bits) tell in which document each window starts first.

Only what may repeat travels: a window shared by two documents shares its
minimiser, so super-k-mers whose minimiser occurs in one document stay home.
Of equal super-k-mers in one task only the smallest id's is sent, for the
others are known to repeat it; buckets of very frequent minimisers are split
by a second one, so that what such documents have in common folds as well.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stardw.llm.common import Words, blocks, gram_hash, mix64, power_tables, text_buffer
from stardw.llm.components import stored

#: A minimiser found in more documents than this is split by a second one.
HOT_DOCS = 1000
_STRING = "bucket long, doc_id long, th long, start int, n int, packed string"


def _prefix(h: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    p, inv = power_tables(len(h) + 1)
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(mix64(h, seed) * p[:len(h)], out=total[1:])
    return total, inv


def span_hashes(h: np.ndarray, start: np.ndarray, size) -> tuple[np.ndarray, np.ndarray]:
    """128-bit hashes of spans of a run of word hashes."""
    out = []
    for seed in (31, 32):
        total, inv = _prefix(h, seed)
        out.append(mix64((total[start + size] - total[start]) * inv[start] + np.asarray(size).astype(np.uint64), seed))
    return out[0], out[1]


def _least(g: np.ndarray, width: int) -> np.ndarray:
    """Least of each run of ``width`` values."""
    size = 1
    while size * 2 <= width:
        g = np.minimum(g[:-size], g[size:])
        size *= 2
    rest = width - size
    return np.minimum(g[:len(g) - rest], g[rest:]) if rest else g


def super_kmers(w: Words, k: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, first word, windows, minimiser) of each super-k-mer of a block."""
    none = np.zeros(0, np.int64)
    if len(w.hash) < k:
        return none, none, none, none.astype(np.uint64)
    least = _least(gram_hash(w.hash, m), k - m + 1)
    at = np.arange(len(least))
    at = at[at + k <= w.first[w.row[:len(least)] + 1]]
    row, value = w.row[at], least[at]
    new = np.append(True, (value[1:] != value[:-1]) | (row[1:] != row[:-1]))[:len(at)]
    edge = np.flatnonzero(new)
    return row[edge], at[edge], np.diff(np.append(edge, len(at))), value[edge]


def kept_texts(w: Words, keep: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The kept words of each row joined by one space, as one buffer with row offsets."""
    mark = np.zeros(len(w.raw) + 1, np.int8)
    mark[w.start[keep]] = 1
    mark[w.end[keep]] -= 1
    inside = np.cumsum(mark, dtype=np.int8)[:-1].astype(bool)
    idx = np.flatnonzero(keep)
    joined = w.end[idx[:-1]][w.row[idx[:-1]] == w.row[idx[1:]]]
    raw = w.raw.copy()
    raw[joined] = 0x20
    inside[joined] = True
    total = np.concatenate([[0], np.cumsum(inside)])
    return raw[inside].tobytes(), total[w.offsets]


def _block_words(batch: pa.RecordBatch, limit: int = 1 << 20):
    raw, offsets = text_buffer(batch.column("text"))
    for lo, hi in blocks(offsets, limit):
        w = Words(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        yield lo, hi, w


def _text_hash(w: Words) -> np.ndarray:
    return w.span_hash(w.offsets[:-1], w.offsets[1:]).astype(np.int64)


def _minimisers(k: int, m: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, _, w in _block_words(batch):
                row, _, _, value = super_kmers(w, k, m)
                if len(row):
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(lo + row)), pa.array(value.astype(np.int64))],
                                                     ["doc_id", "mh"])
    return run


def _stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without a shared minimiser are done; the others keep their text."""
    for batch in batches:
        done = batch.column("shared").is_null().to_numpy(zero_copy_only=False)
        for lo, hi, w in _block_words(batch):
            data, offs = kept_texts(w, np.ones(len(w.start), bool))
            sha = [hashlib.sha256(data[offs[r]:offs[r + 1]]).hexdigest() if done[lo + r] else None for r in range(hi - lo)]
            part = batch.slice(lo, hi - lo)
            text = pa.array(part.column("text").to_pylist(), pa.string(), mask=done[lo:hi])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(_text_hash(w)), pa.array(np.diff(w.first)), pa.array(sha, pa.string()),
                                              text, part.column("shared"), part.column("hot")],
                                             ["doc_id", "th", "n_words", "sha", "text", "shared", "hot"])


def _cut(k: int, m: int):
    """Super-k-mers whose minimiser other documents have too.  Rows without a
    packed string are already known to repeat a smaller id's."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = batch.column("doc_id").to_numpy(zero_copy_only=False)
            shared, hot = (batch.column(x).to_pylist() for x in ("shared", "hot"))
            for lo, _, w in _block_words(batch, 2 << 20):
                row, at, n, value = super_kmers(w, k, m)
                if not len(row):
                    continue
                edge = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
                take = np.zeros(len(row), bool)
                split = np.zeros(len(row), bool)
                for a, b in zip(edge, np.append(edge[1:], len(row)), strict=True):
                    r = lo + row[a]
                    take[a:b] = np.isin(value[a:b], np.array(shared[r], np.int64).astype(np.uint64))
                    if hot[r]:
                        split[a:b] = take[a:b] & np.isin(value[a:b], np.array(hot[r], np.int64).astype(np.uint64))
                plain = take & ~split
                parts = [(row[plain], at[plain], n[plain], value[plain])]
                if split.any():  # windows of these, dealt again by a second minimiser
                    m2 = max(1, m // 2)
                    least = _least(gram_hash(mix64(w.hash, 41), m2), k - m2 + 1)
                    x = np.repeat(np.flatnonzero(split), n[split])
                    first = np.repeat(at[split], n[split])
                    win = first + np.arange(len(x)) - np.repeat(np.cumsum(n[split]) - n[split], n[split])
                    v = mix64(value[x] ^ mix64(least[win], 42))
                    e = np.flatnonzero(np.append(True, (v[1:] != v[:-1]) | (x[1:] != x[:-1])))
                    parts.append((row[x[e]], win[e], np.diff(np.append(e, len(x))), v[e]))
                row, at, n, value = (np.concatenate(c) for c in zip(*parts, strict=True))
                if not len(row):
                    continue
                data, _ = kept_texts(w, np.ones(len(w.start), bool))
                size = w.end - w.start + 1
                size[np.append(w.row[1:] != w.row[:-1], True)] -= 1  # no space after a row's last word
                begin = np.concatenate([[0], np.cumsum(size)[:-1]])
                a, b = span_hashes(w.hash, at, n + k - 1)
                ids, th = doc[lo + row], _text_hash(w)[row]
                order = np.lexsort((ids, b, a))
                new = np.append(True, (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1]))
                least_id = ids[order][np.flatnonzero(new)][np.cumsum(new) - 1]
                sent = np.zeros(len(row), bool)
                sent[order] = ids[order] == least_id
                last = at + n + k - 2
                packed = [data[x:y].decode("utf-8", "surrogateescape") if s else None
                          for x, y, s in zip(begin[at].tolist(), (begin[last] + w.end[last] - w.start[last]).tolist(), sent.tolist(), strict=True)]
                bucket = np.where(sent, value, mix64(th.astype(np.uint64), 43)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket), pa.array(ids, pa.int64()), pa.array(th), pa.array((at - w.first[row]).astype(np.int32)),
                     pa.array(n.astype(np.int32)), pa.array(packed, pa.string())], ["bucket", "doc_id", "th", "start", "n", "packed"])
    return run


def _repeats(k: int):
    """Per bucket (rows sorted by bucket and id): the windows that start in a
    smaller id, as runs (doc_id, th, start, n)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
        last = None
        for batch in batches:
            known = batch.column("packed").is_null()
            if known.true_count:
                got = batch.filter(known)
                yield pa.RecordBatch.from_arrays([got.column(x) for x in ("doc_id", "th", "start", "n")], ["doc_id", "th", "start", "n"])
                batch = batch.filter(pa.compute.invert(known))
            if not batch.num_rows:
                continue
            bucket, doc, th, start = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("bucket", "doc_id", "th", "start"))
            raw, offsets = text_buffer(batch.column("packed"))
            if bucket[0] != last:
                seen = tuple(x[:0] for x in seen)
            last = bucket[-1]
            for lo, hi in blocks(offsets, 2 << 20):
                w = Words(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                at = np.arange(max(0, len(w.hash) - k + 1))
                at = at[at + k <= w.first[w.row[at] + 1]]
                a, b = span_hashes(w.hash, at, k)
                row = lo + w.row[at]
                own = doc[row]
                held = len(seen[0])
                aa, bb, dd = (np.concatenate(x) for x in zip(seen, (a, b, own), strict=True))
                order = np.lexsort((bb, aa))
                new = np.append(True, (aa[order][1:] != aa[order][:-1]) | (bb[order][1:] != bb[order][:-1]))
                edge = np.flatnonzero(new)
                low = np.minimum.reduceat(dd[order], edge)
                least = np.empty(len(dd), np.int64)
                least[order] = low[np.cumsum(new) - 1]
                hit = np.flatnonzero(least[held:] < own)
                if len(hit):
                    e = np.flatnonzero(np.append(True, (np.diff(hit) > 1) | (np.diff(row[hit]) != 0)))
                    r, size = row[hit[e]], np.diff(np.append(e, len(hit)))
                    off = at[hit[e]] - w.first[w.row[at[hit[e]]]]
                    yield pa.RecordBatch.from_arrays([pa.array(doc[r]), pa.array(th[r]), pa.array((start[r] + off).astype(np.int32)),
                                                      pa.array(size.astype(np.int32))], ["doc_id", "th", "start", "n"])
                # windows of the bucket that may go on: those of the last string's bucket
                tail = np.append(np.full(held, bucket[lo] == bucket[hi - 1]), bucket[row] == bucket[hi - 1])[order]
                pick = edge[np.logical_or.reduceat(tail, edge)]
                seen = (aa[order][pick], bb[order][pick], low[np.logical_or.reduceat(tail, edge)])
    return run


def _finish(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column("marks").to_pylist()
            for lo, hi, w in _block_words(batch):
                cover = np.zeros(len(w.start) + 1, np.int64)
                for r in range(hi - lo):
                    for x in marks[lo + r] or ():
                        cover[w.first[r] + x["start"]] += 1
                        cover[w.first[r] + x["start"] + x["n"] + k - 1] -= 1
                keep = np.cumsum(cover)[:-1] == 0
                data, offs = kept_texts(w, keep)
                texts = [data[offs[r]:offs[r + 1]] for r in range(hi - lo)]
                removed = np.diff(w.first) - np.bincount(w.row[keep], minlength=hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(np.diff(w.first)), pa.array(removed),
                     pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept"])
    return run


def _staged(docs: DataFrame, k: int, m: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = stored(rows.where("doc_id IS NOT NULL").mapInArrow(_minimisers(k, m), "doc_id long, mh long"), "substring-minimisers")
    several = (found.groupBy("mh").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count(F.lit(1)).alias("n"))
               .where("lo < hi").select("mh", (F.col("n") > HOT_DOCS).alias("is_hot")))
    lists = (found.join(several, "mh").groupBy("doc_id")  # at most a text's own minimisers
             .agg(F.collect_set("mh").alias("shared"), F.collect_set(F.when(F.col("is_hot"), F.col("mh"))).alias("hot")))
    staged = stored(rows.join(lists, "doc_id", "left").select("doc_id", "text", "shared", "hot").mapInArrow(
        _stage, "doc_id long, th long, n_words long, sha string, text string, shared array<long>, hot array<long>"), "substring-staged")
    strings = staged.where("text IS NOT NULL AND shared IS NOT NULL").select("doc_id", "text", "shared", "hot").mapInArrow(_cut(k, m), _STRING)
    marks = (strings.repartition("bucket").sortWithinPartitions("bucket", "doc_id")
             .mapInArrow(_repeats(k), "doc_id long, th long, start int, n int")
             .groupBy("doc_id", "th").agg(F.collect_list(F.struct("start", "n")).alias("marks")))  # at most a text's own windows
    return staged, marks


def substring_dedup(docs: DataFrame, k: int = 50, m: int = 12, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept, kept_sha256`` for every row.

    Every word (``[^\\x20\\x09-\\x0D]+``) covered by a ``k``-word window whose
    words also start in a document with a smaller id goes; windows are judged
    on the input.  ``kept`` holds the other words joined by one space where the
    text shares a minimiser with another, and null where nothing could repeat
    (its words are all kept); ``kept_sha256`` is there for all.  Null texts
    have no words; rows with a null id repeat nothing and are repeated by none;
    rows that share an id are one document, so none is smaller; other columns
    are ignored; an empty table gives no rows.  Ids are integers.
    """
    staged, marks = _staged(docs, k, m, id_col, text_col)
    alone = staged.where("sha IS NOT NULL").select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.lit(None).cast("string").alias("kept"), F.col("sha").alias("kept_sha256"))
    others = (staged.where("sha IS NULL").join(marks, ["doc_id", "th"], "left").select("doc_id", "text", "marks")
              .mapInArrow(_finish(k), "doc_id long, n_words long, n_removed long, kept string")
              .withColumn("kept_sha256", F.sha2(F.col("kept").cast("binary"), 256)))
    return alone.unionByName(others)
