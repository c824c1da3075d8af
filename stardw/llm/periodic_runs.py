"""Periodic runs of words by block convolution.

A run is a maximal stretch whose words repeat at a smallest period ``q``, at
least twice.  At each dyadic scale the text is cut into blocks of ``b`` words.
A run of period ``2b - 1 <= q <= 4b - 2`` holds a whole block that occurs again
``q`` words on, so the following window of each block is searched for its
zero-mismatch places: the sum of squared differences of the word numbers is a
convolution, taken exactly by a number-theoretic transform.  Places that
successive blocks share at one distance are laid together, extended word by
word to both sides, and kept where they are two periods long.

Texts are judged inside tasks, each on its own; nothing is shuffled.  Blocks
with a word that does not recur in their window at all are not transformed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stardw.llm.common import Words, blocks, text_buffer
from stardw.llm.substring_dedup import kept_texts

#: 15 * 2**27 + 1 is prime and 31 generates its units: lengths up to 2**27.
MODULUS, GENERATOR = 15 * 2**27 + 1, 31
_P = np.uint64(MODULUS)
#: Elements that one transform, or one ragged comparison, works on at once.
STEP = 1 << 20
_RUNS = "array<struct<start:long,length:long,period:long>>"


def _roots(size: int, inverse: bool) -> list[np.ndarray]:
    """For each half length 1, 2, 4 ... size / 2: the powers of its root of unity."""
    out, half = [], 1
    while half < size:
        root = pow(GENERATOR, (MODULUS - 1) // (2 * half), MODULUS)
        root = pow(root, -1, MODULUS) if inverse else root
        w = np.ones(half, np.uint64)
        done = 1
        while done < half:
            w[done:2 * done] = w[:done] * np.uint64(pow(root, done, MODULUS)) % _P
            done *= 2
        out.append(w)
        half *= 2
    return out


def ntt(a: np.ndarray, roots: list[np.ndarray]) -> np.ndarray:
    """Transform of each row (a power of two long), in bit-reversed order."""
    rows = len(a)
    for w in reversed(roots):
        half = len(w)
        v = a.reshape(rows, -1, 2, half)
        lo, hi = v[:, :, 0], v[:, :, 1]
        a = np.stack([(lo + hi) % _P, (lo + _P - hi) * w % _P], axis=2).reshape(rows, -1)
    return a


def inverse_ntt(a: np.ndarray, roots: list[np.ndarray]) -> np.ndarray:
    """Rows from their bit-reversed transforms."""
    rows, size = a.shape
    for w in roots:
        half = len(w)
        v = a.reshape(rows, -1, 2, half)
        lo, hi = v[:, :, 0], v[:, :, 1] * w % _P
        a = np.stack([(lo + hi) % _P, (lo + _P - hi) % _P], axis=2).reshape(rows, -1)
    return a * np.uint64(pow(size, -1, MODULUS)) % _P


def squared_differences(block: np.ndarray, window: np.ndarray) -> np.ndarray:
    """For each row and each place of ``block`` in ``window``: the sum of the
    squared differences, modulo MODULUS (values below MODULUS)."""
    b, width = block.shape[1], window.shape[1]
    size = 1
    while size < width:
        size *= 2
    fwd, back = _roots(size, False), _roots(size, True)
    wide = lambda x: np.pad(x, ((0, 0), (0, size - x.shape[1])))
    product = inverse_ntt(ntt(wide(block[:, ::-1]), fwd) * ntt(wide(window), fwd) % _P, back)[:, b - 1:width]
    squares = np.zeros((len(window), width + 1), np.uint64)
    np.cumsum(window * window % _P, axis=1, out=squares[:, 1:])
    own = (block * block % _P).sum(axis=1, keepdims=True)
    return (own + squares[:, b:] - squares[:, :width - b + 1] + np.uint64(2) * (_P - product)) % _P


def scales(longest: int, min_words: int) -> list[tuple[int, int, int]]:
    """(block, least distance, greatest distance) of each scale for texts of
    ``longest`` words.  Where every run has nine words or more, blocks of two
    also find the periods 1 and 2."""
    out, b = [], 1
    while 2 * b - 1 <= longest // 2:
        out.append((b, 2 * b - 1, 4 * b - 2))
        b *= 2
    if min_words >= 9 and len(out) > 1:
        out[:2] = [(2, 1, 6)]
    return out


def _ragged(left: np.ndarray, size: np.ndarray) -> np.ndarray:
    """left[0], left[0] + 1, ... (size[0] of them), left[1], ..."""
    return np.arange(size.sum()) + np.repeat(left - (np.cumsum(size) - size), size)


def _extended(w: np.ndarray, left: np.ndarray, right: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal stretches (start, end, distance) of words equal to those ``d``
    later, within left..right (which the stretches do not fill)."""
    found, size, at = [], right - left, 0
    while at < len(left):
        to = max(at + 1, int(np.searchsorted(np.cumsum(size[at:]), STEP, "right")) + at)
        n, gap = size[at:to], d[at:to]
        pos, row = _ragged(left[at:to], n), np.repeat(np.arange(to - at), n)
        same = w[pos] == w[pos + gap[row]]
        first = np.flatnonzero(same & np.append(True, ~same[:-1] | (row[1:] != row[:-1])))
        last = np.flatnonzero(same & np.append(~same[1:] | (row[1:] != row[:-1]), True))
        found.append((pos[first], pos[last] + 1 + gap[row[first]], gap[row[first]]))
        at = to
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _hits(w: np.ndarray, at: np.ndarray, b: int, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """(place of the block, distance) of each zero-mismatch occurrence of the
    blocks that start at ``at``.  Where the numbers are too great for an exact
    sum (b * max**2 beyond the modulus) a hit is a residue and is compared
    word by word when it is extended."""
    places, gaps = [], []
    step = max(1, STEP // (4 * b))
    tail = np.concatenate([w, np.zeros(hi + b, w.dtype)]).astype(np.uint64)
    for k in range(0, len(at), step):
        x = at[k:k + step, None]
        miss = squared_differences(tail[x + np.arange(b)], tail[x + np.arange(lo, hi + b)])
        r, c = np.nonzero(miss == 0)
        places.append(at[k:k + step][r])
        gaps.append(c + lo)
    return np.concatenate(places), np.concatenate(gaps)


def _farthest(starts: np.ndarray, ends: np.ndarray, periods: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of the run that reaches farthest of those that
    start (in order) at or before each place; the first run if none does."""
    far = np.maximum.accumulate(ends)
    best = np.maximum.accumulate(np.where(ends == far, np.arange(len(ends)), 0))
    k = best[np.maximum(np.searchsorted(starts, at, "right") - 1, 0)]
    return starts[k], ends[k], periods[k]


def find_runs(w: np.ndarray, first: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, smallest period) of the runs of ``min_words`` words or more
    in a sequence of word numbers (from 1); text ``r`` is first[r]..first[r + 1]
    and runs do not cross texts."""
    none = np.zeros(0, np.int64)
    starts, ends, periods = none, none, none
    length = np.diff(first)
    if not len(w) or length.max() < 2:
        return none, none, none
    end_of = np.repeat(first[1:], length)
    begin_of = np.repeat(first[:-1], length)
    # (number, place) in order: a word's next occurrence is found by search
    order = np.argsort(w, kind="stable")
    stride = np.int64(4 * len(w) + 16)
    place = w[order].astype(np.int64) * stride + order
    for b, lo, hi in scales(int(length.max()), min_words):
        at = np.arange(0, len(w) - b + 1, b)
        at = at[at + b + lo <= end_of[at]]  # its next occurrence may be in the same text
        if not len(at):
            break
        nxt = np.searchsorted(place, place + lo)
        again = np.zeros(len(w) + b, bool)
        again[order] = np.append(place, np.iinfo(np.int64).max)[nxt] - place <= hi
        at = at[again[:len(w) // b * b].reshape(-1, b).all(axis=1)[at // b]]
        if len(starts):  # a window inside a run of period b or less: its places are that period's multiples
            s, e, q = _farthest(starts, ends, periods, at)
            at = at[(s > at) | (e < at + hi + b) | (q > b)]
        if not len(at):
            continue
        x, d = _hits(w, at, b, lo, hi)
        inside = x + b + d <= end_of[x]
        x, d = x[inside], d[inside]
        if not len(x):
            continue
        o = np.lexsort((x, d))
        x, d = x[o], d[o]
        new = np.append(True, (np.diff(d) != 0) | (np.diff(x) != b))
        edge = np.flatnonzero(new)
        x0, x1, d = x[edge], x[np.append(edge[1:], len(x)) - 1] + b, d[edge]
        if len(starts):  # a multiple of a known run's period inside that run says nothing new
            s, e, q = _farthest(starts, ends, periods, x0)
            known = (s <= x0) & (e >= x1 + d) & (d % q == 0)
            x0, x1, d = x0[~known], x1[~known], d[~known]
            if not len(x0):
                continue
        left = np.maximum(begin_of[x0], x0 - b)
        right = np.minimum(end_of[x0] - d, x1 + b)
        s, e, q = _extended(w, left, right, d)
        good = e - s >= np.maximum(min_words, 2 * q)
        starts, ends, periods = (np.concatenate(v) for v in ((starts, s[good]), (ends, e[good]), (periods, q[good])))
        # one run may be found at several multiples of its smallest period; kept by start and then end
        o = np.lexsort((periods, ends, starts))
        starts, ends, periods = starts[o], ends[o], periods[o]
        keep = np.append(True, (np.diff(starts) != 0) | (np.diff(ends) != 0))[:len(starts)]
        starts, ends, periods = starts[keep], ends[keep], periods[keep]
    return starts, ends, periods


def word_numbers(w: Words) -> np.ndarray:
    """Numbers from 1, the same for equal words (compared as bytes)."""
    if not len(w.start):
        return np.zeros(0, np.int64)
    edges = np.empty(2 * len(w.start) + 1, np.int64)
    edges[0:-1:2], edges[1::2], edges[-1] = w.start, w.end, len(w.raw)
    pieces = pa.Array.from_buffers(pa.large_binary(), 2 * len(w.start), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(w.raw))])
    every_other = pieces.take(pa.array(np.arange(0, 2 * len(w.start), 2)))
    return every_other.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1


def _runs_of(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_buffer(batch.column("text"))
            for lo, hi in blocks(offsets):
                w = Words(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                start, end, period = find_runs(word_numbers(w), w.first, min_words)
                cover = np.zeros(len(w.start) + 1, np.int64)
                np.add.at(cover, start + period, 1)
                np.add.at(cover, end, -1)
                data, offs = kept_texts(w, np.cumsum(cover)[:-1] == 0)
                row = np.searchsorted(w.first, start, "right") - 1
                sizes = np.searchsorted(row, np.arange(hi - lo + 1)).astype(np.int32)
                runs = pa.ListArray.from_arrays(pa.array(sizes), pa.StructArray.from_arrays(
                    [pa.array(start - w.first[row]), pa.array(end - start), pa.array(period)], ["start", "length", "period"]))
                texts = pa.array([data[offs[r]:offs[r + 1]] for r in range(hi - lo)], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(np.diff(w.first)), runs, texts],
                                                 ["doc_id", "n_words", "runs", "collapsed"])
    return run


def periodic_runs(docs: DataFrame, min_words: int = 12, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0, and equal when their
    bytes are.  ``runs`` lists, by start and then period, every stretch with
    smallest period ``q`` of at least ``min_words`` (2 or more) and ``2q`` words
    that no neighbouring word extends keeping the period; there are no ties,
    for a start and a period name one run.  ``collapsed`` holds the words that
    no run covers after its first ``q`` words, joined by one space.

    Null and empty texts have no words, no runs and an empty ``collapsed``; a
    very long text is judged whole, in memory in proportion to its length; null
    and repeated ids keep their rows; other columns are ignored; an empty table
    gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(_runs_of(max(2, min_words)), f"doc_id {kind}, n_words long, runs {_RUNS}, collapsed string"))


def run_digests(found: DataFrame) -> DataFrame:
    """``doc_id, n_runs, start, length, period, exponent_milli, runs_sha256,
    collapsed_sha256`` of `periodic_runs`: its longest run (ties: the smallest
    start, then period; four nulls without a run) and digests of all of them."""
    longest = found.select("*", F.expr("array_max(transform(runs, r -> struct(r.length AS length, -r.start AS s, -r.period AS p)))").alias("top"))
    lines = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')"
    return longest.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.s")).alias("start"), F.col("top.length").alias("length"),
        (-F.col("top.p")).alias("period"), F.expr("1000 * top.length DIV -top.p").alias("exponent_milli"),
        F.sha2(F.expr(lines).cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
