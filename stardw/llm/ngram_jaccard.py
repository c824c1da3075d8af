"""N-gram Jaccard join by parity sketches.

A document's set holds its distinct word n-grams.  Sets of a size band are
folded into a bit sketch: each element flips one bit, so the Hamming distance
of two sketches never exceeds the symmetric difference of the sets.  A pair at
or above the threshold differs in at most ``d`` elements, so of ``d + 1 +
spare`` sketch segments at least ``spare + 1`` hold the same elements.  A set
need not index the segments that say little - with less than ``low`` n-grams
that are not common - if they number at most ``spare``: whatever the list of
common n-grams, a pair keeps a shared segment.  Segments meet in an equi-join; within one, pairs whose whole
sketches differ in more than ``d`` bits go.  A whole sketch is wide enough for
its set: in one that is full, all pairs differ in half of the bits, and long
texts that share a line would be one candidate group that grows with the
corpus.  What is left connected forms candidate groups, and there every pair is verified on the exact sets, group by
group and in blocks of bounded size.  Only spanning links leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stardw.llm.common import Words, blocks, gram_hash, lean, mix64, text_buffer
from stardw.llm.components import connected_components, stored

#: 64-bit words of a whole sketch at least, and the share of its bits that a pair
#: which links may differ in at most (one of unlike sets differs in half of them).
SEGMENT_BITS, SKETCH_WORDS, SKETCH_FAR = 1024, 8, 0.35
#: An n-gram is common if so many documents hold it, counted where a part of
#: the corpus holds it LOCAL_DOCS times; the list keeps the most common ones
#: (it steers what is indexed, never what links).
COMMON_DOCS, LOCAL_DOCS, COMMON_MAX = 8, 3, 1 << 20
#: Rows of one segment whose sketches are compared with each other; a larger one
#: becomes one candidate group unseen (verification sees all of it).
RUN_ROWS = 4096
#: A verification block: sets and elements at most (a larger set is alone).
BLOCK_SETS, BLOCK_ELEMENTS = 1024, 1_500_000


class Bands:
    """Size bands for a threshold of ``percent`` / 100.  Band ``b`` holds pairs
    whose larger set has between ``tops[b - 1]`` + 1 and ``tops[b]`` elements."""

    def __init__(self, percent: int):
        self.percent = percent
        # elements per segment are few where the threshold is low: then more
        # segments, narrower bands and less asked of a segment
        dense = (100 + percent) >= 16 * (100 - percent)
        self.slack, self.low = (0.12, 3) if dense else (0.5, 2)
        self.tops = [1]
        while self.tops[-1] < 1 << 40:
            wide = self.tops[-1] * 10000 // percent**2 if dense else self.tops[-1] * 100 // percent
            self.tops.append(max(self.tops[-1] + 1, wide))

    def of(self, n: int) -> list[tuple[int, int, int]]:
        """(band, segments, spare) for each band in which a set of n elements
        may have a partner; none where only equal sets link."""
        lo, hi = np.searchsorted(self.tops, [n, n * 100 // self.percent])
        out = []
        for b in range(lo, hi + 1):
            d = self.most(self.tops[b], self.tops[b])
            if d:
                segments = d + 1 + max(1, int((d + 1) * self.slack))
                out.append((b, segments, segments - self.most(n, self.tops[b]) - 1))
        return out

    def most(self, a, b):
        """The largest symmetric difference of sets of these sizes that link."""
        return (100 - self.percent) * (a + b) // (100 + self.percent)

    def sketch_words(self, n: int) -> int:
        """Words (a power of two) of the whole sketch of a set of n elements,
        whose largest partner has n * 100 / percent."""
        words = SKETCH_WORDS
        while (100 - self.percent) * n > SKETCH_FAR * 64 * words * self.percent:
            words *= 2
        return words


def shingle_sets(batch: pa.RecordBatch, words: int, lower: bool) -> Iterator[tuple[int, np.ndarray, int, int]]:
    """(row, sorted element hashes, class hash, second hash) of each text."""
    raw, offsets = text_buffer(batch.column("text"))
    for lo, hi in blocks(offsets):
        w = Words(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], lower)
        grams = gram_hash(w.hash, words)
        for r in range(hi - lo):
            a, b = int(w.first[r]), int(w.first[r + 1])
            if b - a >= words:
                h = np.unique(grams[a:b - words + 1])
            elif b > a:
                h = gram_hash(w.hash[a:b], b - a)
            else:
                h = np.zeros(0, np.uint64)
            n = np.uint64(len(h))
            c = mix64(np.array([mix64(h, 11).sum(dtype=np.uint64) + n]), 12).astype(np.int64)[0]
            yield lo + r, h, int(c), int(mix64(h, 13).sum(dtype=np.uint64).astype(np.int64))


def segment_keys(h: np.ndarray, bands: Bands, rare: np.ndarray | None = None) -> np.ndarray:
    """Join keys of a set: one per indexed segment of its sketch in each band.
    ``rare``: whether each element is no common n-gram (default: all are)."""
    out = []
    rare = np.ones(len(h), bool) if rare is None else rare
    for band, segments, spare in bands.of(len(h)):
        x = mix64(h, 20 + band)
        seg = ((x >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
        bit = np.sort(seg * np.uint64(SEGMENT_BITS) + (x & np.uint64(SEGMENT_BITS - 1)))
        edge = np.flatnonzero(np.append(True, bit[1:] != bit[:-1]))
        odd = bit[edge[np.diff(np.append(edge, len(bit))) % 2 == 1]]  # bits flipped an odd number of times
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(odd, 1))])
        at = np.searchsorted(odd, np.arange(segments + 1, dtype=np.uint64) * np.uint64(SEGMENT_BITS))
        number = np.arange(segments, dtype=np.uint64) + np.uint64((band * 1_000_003 + 7) << 24)
        key = mix64(total[at[1:]] - total[at[:-1]] + mix64(number, 2), 3)
        empty = np.diff(at) == 0
        low = empty | (np.bincount(seg[rare].astype(np.int64), minlength=segments) < bands.low)
        out.append(key[~low] if low.sum() <= spare else key[~empty] if empty.sum() <= spare else key)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def sketch(h: np.ndarray, words: int = SKETCH_WORDS) -> np.ndarray:
    """Parity sketch of the whole set."""
    x = mix64(h, 5) & np.uint64(64 * words - 1)
    bits = (np.bincount(x.astype(np.int64), minlength=64 * words) & 1).astype(np.uint8)
    return np.packbits(bits, bitorder="little")


def folded(sketches: np.ndarray, words: int) -> np.ndarray:
    """Sketches of ``words`` words or more as if they had been made that wide."""
    size = np.array([len(x) for x in sketches])
    out = np.empty((len(sketches), words), np.uint64)
    for k in np.unique(size):
        at = np.flatnonzero(size == k)
        out[at] = np.bitwise_xor.reduce(np.frombuffer(b"".join(sketches[at]), np.uint64).reshape(len(at), -1, words), axis=1)
    return out


def _signatures(words: int, lower: bool, percent: int):
    bands = Bands(percent)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(len(h), c, c2, sketch(h, bands.sketch_words(len(h))).tobytes()) for _, h, c, c2 in shingle_sets(batch, words, lower)]
            n, c, c2, s = zip(*rows, strict=True) if rows else ([], [], [], [])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), pa.array(n, pa.int64()), pa.array(c, pa.int64()),
                                              pa.array(c2, pa.int64()), pa.array(s, pa.binary())], ["doc_id", "th", "n", "c", "c2", "sketch"])
    return run


def _local_counts(words: int, lower: bool):
    """N-grams that LOCAL_DOCS documents of a part of the corpus hold."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, n = [], 0
            for r, h, _, _ in shingle_sets(batch, words, lower):
                held.append(h)
                n += len(h)
                if n > 1_000_000 or r == batch.num_rows - 1:
                    value, count = np.unique(np.concatenate(held), return_counts=True)
                    often = count >= LOCAL_DOCS
                    if often.any():
                        yield pa.RecordBatch.from_arrays([pa.array(value[often].astype(np.int64)), pa.array(count[often])], ["gram", "n"])
                    held, n = [], 0
    return run


def common_grams(rows: DataFrame, words: int, lower: bool) -> np.ndarray:
    """Hashes of the most common n-grams, sorted: at most COMMON_MAX (8 MB)."""
    counts = rows.select("text").mapInArrow(_local_counts(words, lower), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    top = counts.where(F.col("n") >= COMMON_DOCS).orderBy(F.desc("n"), "gram").limit(COMMON_MAX).select("gram")
    return np.sort(top.toArrow().column("gram").to_numpy().astype(np.uint64))


class Common:
    """Membership in a sorted list of hashes."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.maybe = np.zeros(1 << 24, bool)
        self.maybe[hashes >> np.uint64(40)] = True

    def rare(self, h: np.ndarray) -> np.ndarray:
        out = ~self.maybe[h >> np.uint64(40)]
        k = np.flatnonzero(~out)
        if len(k):
            at = np.minimum(np.searchsorted(self.hashes, h[k]), len(self.hashes) - 1)
            out[k] = self.hashes[at] != h[k]
        return out


def _keys(words: int, lower: bool, percent: int, listed):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, common = Bands(percent), Common(listed.value)

        def out(keys, classes):
            key = np.concatenate(keys)
            c = np.repeat(np.array(classes, np.int64), [len(k) for k in keys])
            return pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64)), pa.array(c)], ["key", "c"])
        for batch in batches:
            keys, classes, n, seen = [], [], 0, set()
            for _, h, c, _ in shingle_sets(batch, words, lower):
                if c in seen:  # a copy in this batch has the same keys
                    continue
                seen.add(c)
                k = segment_keys(h, bands, common.rare(h))
                if len(k):
                    keys.append(k)
                    classes.append(c)
                    n += len(k)
                if n > 200_000:
                    yield out(keys, classes)
                    keys, classes, n = [], [], 0
            if keys:
                yield out(keys, classes)
    return run


def _runs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[list[np.ndarray], bool]]:
    """Columns of the rows that share the first column, in sorted input, and
    whether they are but a part of their run: one of more than RUN_ROWS rows
    comes in parts, each led by its first row."""
    held, parted = None, False
    for batch in batches:
        cols = [batch.column(x).to_numpy(zero_copy_only=False) for x in names]
        if held is not None:
            cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
        if not len(cols[0]):
            continue
        edge = np.flatnonzero(np.append(True, cols[0][1:] != cols[0][:-1]))
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            if b - a > 1:
                yield [x[a:b] for x in cols], parted and a == 0
            parted = parted and a != 0
        held = [x[edge[-1]:] for x in cols]
        while len(held[0]) > RUN_ROWS:
            yield [x[:RUN_ROWS] for x in held], True
            held, parted = [np.concatenate([x[:1], x[RUN_ROWS:]]) for x in held], True
    if held is not None and len(held[0]) > 1:
        yield held, parted


@lean
def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of segments that several classes share; segments with the same
    members get the same run number and are folded.  Parts of a run that is
    too long are marked ``joined``."""
    seen: set[int] = set()
    runs, members = [], []
    for (_, c), parted in _runs(batches, ["key", "c"]):
        c = np.unique(c)
        if len(c) > 1:
            run = int(mix64(np.array([mix64(c.astype(np.uint64), 4).sum(dtype=np.uint64)]), 6 + parted).astype(np.int64)[0])
            run = run & ~1 | parted  # the last bit: joined
            if run in seen:
                continue
            if len(seen) < 200_000:  # the rest is folded by the distinct that follows
                seen.add(run)
            runs.append(np.full(len(c), run))
            members.append(c)
        if len(runs) > 5000:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(runs)), pa.array(np.concatenate(members))], ["run", "c"])
            runs, members = [], []
    if runs:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(runs)), pa.array(np.concatenate(members))], ["run", "c"])


def _near(percent: int):
    """Links the members of a run whose sketches are near enough, or all of
    them if it is part of a longer one (its rows have not all met)."""
    bands = Bands(percent)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_out, b_out, twos = [], [], []

        def compared(pairs):
            """The pairs (n, c and sketch of two rows each) that are near."""
            n, c, s = (np.concatenate([x[k] for x in pairs]).reshape(-1, 2) for k in (0, 1, 2))
            ok = n.min(axis=1) * 100 >= percent * n.max(axis=1)
            n, c, s = n[ok], c[ok], s[ok]
            wide = np.array([min(len(x), len(y)) // 8 for x, y in s])
            far = np.zeros(len(n), np.int64)
            for w in np.unique(wide):
                at = np.flatnonzero(wide == w)
                bits = folded(s[at].ravel(), int(w)).reshape(len(at), 2, -1)
                far[at] = np.bitwise_count(bits[:, 0] ^ bits[:, 1]).sum(axis=1, dtype=np.int64)
            ok = far <= bands.most(n[:, 0], n[:, 1])
            return c[ok, 1], c[ok, 0]
        for (key, c, n, s), parted in _runs(batches, ["run", "c", "n", "sketch"]):
            if len(c) == 2 and not parted and not key[0] & 1:
                twos.append((n, c, s))
                if len(twos) > 5000:
                    a, b = compared(twos)
                    twos = []
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
                continue
            if parted or key[0] & 1:
                a_out.append(c[1:])
                b_out.append(np.full(len(c) - 1, c[0]))
                continue
            order = np.argsort(n, kind="stable")
            c, n, s = c[order], n[order], s[order]
            wide = np.array([len(x) // 8 for x in s])
            end = np.searchsorted(n, n * 100 // percent, "right")  # of the sizes that may link
            group = np.arange(len(c))
            for w in np.unique(wide):
                lo, hi = np.searchsorted(wide, w), np.searchsorted(wide, w, "right")
                bits = folded(s[lo:end[hi - 1]], int(w))
                for i in range(lo, hi):
                    far = np.bitwise_count(bits[i + 1 - lo:end[i] - lo] ^ bits[i - lo]).sum(axis=1, dtype=np.int64)
                    hit = np.flatnonzero(far <= bands.most(n[i + 1:end[i]], n[i])) + i + 1
                    if len(hit):
                        old = np.unique(group[np.append(hit, i)])
                        if len(old) > 1:
                            group[np.isin(group, old)] = old[0]
            moved = np.flatnonzero(group != np.arange(len(c)))
            if len(moved):
                a_out.append(c[moved])
                b_out.append(c[group[moved]])
            if len(a_out) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a_out)), pa.array(np.concatenate(b_out))], ["a", "b"])
                a_out, b_out = [], []
        if twos:
            a, b = compared(twos)
            a_out.append(a)
            b_out.append(b)
        if a_out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a_out)), pa.array(np.concatenate(b_out))], ["a", "b"])
    return run


def _member_sets(words: int, lower: bool):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c, c2 = (batch.column(x).to_pylist() for x in ("c", "c2"))
            rows, sets = [], []
            for r, h, own, own2 in shingle_sets(batch, words, lower):
                if (own, own2) == (c[r], c2[r]):  # another text under the same id is no member
                    rows.append(r)
                    sets.append(h.tobytes())
                if len(rows) == 256:
                    yield _with_sets(batch, rows, sets)
                    rows, sets = [], []
            if rows:
                yield _with_sets(batch, rows, sets)

    def _with_sets(batch, rows, sets):
        names = ["cluster", "parts", "part", "rep", "k"]
        return pa.RecordBatch.from_arrays([*(batch.column(x).take(pa.array(rows)) for x in names), pa.array(sets, pa.binary())], [*names, "elements"])
    return run


def link_groups(sets: list[np.ndarray], percent: int, split: int | None = None) -> np.ndarray:
    """Group number (a member's index) of each set: connected by exact Jaccard
    links; with ``split`` only pairs across that index are compared."""
    n = np.array([len(s) for s in sets])
    m = len(sets)
    owner = np.repeat(np.arange(m, dtype=np.int32), n)
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    edge = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    size = np.diff(np.append(edge, len(values)))
    common = np.zeros(m * m, np.int32)
    for width in range(2, min(16, int(size.max(initial=0))) + 1):  # elements of few sets: their pairs
        at = edge[size == width]
        if not len(at):
            continue
        got = owner[at[:, None] + np.arange(width)]
        i, j = np.triu_indices(width, 1)
        for lo in range(0, len(at), 200_000 // width):
            part = got[lo:lo + 200_000 // width]
            common += np.bincount((part[:, i].astype(np.int64) * m + part[:, j]).ravel(), minlength=m * m).astype(np.int32)
    common = common.reshape(m, m)
    common = common + common.T
    at = np.flatnonzero(size > 16)
    for lo in range(0, len(at), 1024):  # elements of many sets: a product of 0/1 columns
        part = at[lo:lo + 1024]
        x = np.zeros((m, len(part)), np.float32)
        x[owner[np.concatenate([np.arange(edge[k], edge[k] + size[k]) for k in part])], np.repeat(np.arange(len(part)), size[part])] = 1
        common += (x @ x.T).astype(np.int32)
    linked = 100 * common.astype(np.int64) >= percent * (n[:, None] + n[None, :] - common)
    if split is not None:
        linked[:split, :split] = False
        linked[split:, split:] = False
    np.fill_diagonal(linked, True)
    group = np.arange(m)
    while True:
        low = np.where(linked, group[None, :], m).min(axis=1)
        low = np.minimum(low, low[low])
        if (low == group).all():
            return group
        group = low


def _verified(percent: int):
    """Links of each unit (a pair of blocks of one candidate group), as (a, b)."""
    def links(part, rep, nth, elements, cross):
        order = np.lexsort((nth, rep, part))
        part, rep, nth = part[order], rep[order], nth[order]
        sets = [np.frombuffer(elements[k], np.uint64) for k in order]
        group = link_groups(sets, percent, int(np.searchsorted(part, part[-1])) if cross and part[0] != part[-1] else None)
        moved = np.flatnonzero(group != np.arange(len(rep)))
        return rep[moved], nth[moved], rep[group[moved]], nth[group[moved]]

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["cluster", "i", "j", "part", "rep", "k", "elements"]
        held: list[np.ndarray] | None = None
        out = []

        def take(cols):
            if len(cols[0]) > 1:
                out.append(links(*cols[3:], cols[1][0] != cols[2][0]))
        for batch in batches:
            cols = [batch.column(x).to_numpy(zero_copy_only=False) for x in names]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
            if not len(cols[0]):
                continue
            new = np.append(True, (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]) | (cols[2][1:] != cols[2][:-1]))
            edge = np.flatnonzero(new)
            for a, b in zip(edge[:-1], edge[1:], strict=True):
                take([x[a:b] for x in cols])
            held = [x[edge[-1]:] for x in cols]
        if held is not None:
            take(held)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in zip(*out, strict=True)], ["a", "ak", "b", "bk"])
    return run


def jaccard_components(docs: DataFrame, percent: int = 80, words: int = 5, lower: bool = True,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    Two documents link when 100 * |A & B| >= ``percent`` * |A | B| for their
    sets of distinct word n-grams (words: ``[^\\x20\\x09-\\x0D]+``, A-Z
    lower-cased if ``lower``; a text with fewer words counts as one n-gram; a
    null text or one without words has an empty set and links with nothing).
    ``component_id`` is the smallest id reachable by links, the own one
    included.  Equal sets are one class, so copies cost one comparison.  Rows
    with a null id get a null component and link nothing; repeated rows keep
    their rows; an id that carries several texts joins their components where
    it is the smallest of its class; other columns are ignored; an empty table
    gives no rows.  Ids are integers.
    """
    sig, root = _classes(docs, percent, words, lower, id_col, text_col)
    # where an id is the smallest of several classes, their components are one
    smallest = connected_components(root.select(F.col("rep").alias("a"), F.col("root.rep").alias("b")))
    root = root.select("c", "c2", F.col("root.rep").alias("node")).join(smallest, "node", "left").select(
        "c", "c2", F.coalesce("component", "node").alias("root"))
    return (sig.join(root, ["c", "c2"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce(F.when(F.col("n") > 0, F.col("root")), F.col("doc_id"))).alias("component_id")))


def _classes(docs: DataFrame, percent: int, words: int, lower: bool, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``doc_id, th, n, c, c2`` of every row (hashes of its text, its set's size
    and class) and ``c, c2, rep, k, root`` of every class: its smallest id, the
    number among the classes of that id, and the (rep, k) that leads its component."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sig = stored(rows.withColumn("th", F.xxhash64("text")).mapInArrow(_signatures(words, lower, percent), "doc_id long, th long, n long, c long, c2 long, sketch binary"),
                 "jaccard-sig")
    reps = sig.where("n > 0 AND doc_id IS NOT NULL").groupBy("c", "c2").agg(F.min("doc_id").alias("rep"), F.min("n").alias("n"))
    # classes of one id: as many as it has texts
    classes = stored(reps.withColumn("k", F.row_number().over(Window.partitionBy("rep").orderBy("c", "c2")).cast("long")), "jaccard-classes")
    known = rows.where("doc_id IS NOT NULL")
    listed = docs.sparkSession.sparkContext.broadcast(common_grams(known, words, lower))
    keys = known.mapInArrow(_keys(words, lower, percent, listed), "key long, c long")
    shared = (keys.repartition("key").sortWithinPartitions("key", "c").mapInArrow(_shared, "run long, c long").distinct())
    sketches = sig.where("n > 0").groupBy("c").agg(F.min("n").alias("n"), F.min("sketch").alias("sketch"))
    near = (shared.join(sketches, "c").select("run", "c", "n", "sketch").repartition("run").sortWithinPartitions("run", "c")
            .mapInArrow(_near(percent), "a long, b long"))
    clusters = connected_components(near)
    listed.unpersist()
    members = classes.join(clusters.select(F.col("node").alias("c"), F.col("component").alias("cluster")), "c")
    sizes = members.groupBy("cluster").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_SETS)), F.ceil(F.sum("n") / F.lit(BLOCK_ELEMENTS))).cast("int").alias("parts"))
    members = members.join(sizes, "cluster").select(
        "cluster", "parts", F.pmod(F.xxhash64("c", "c2"), F.col("parts")).cast("int").alias("part"), "c", "c2", "rep", "k")
    sets = (rows.join(members, rows["doc_id"] == members["rep"]).select("cluster", "parts", "part", "rep", "k", "c", "c2", "text")
            .mapInArrow(_member_sets(words, lower), "cluster long, parts int, part int, rep long, k long, elements binary"))
    units = (sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("cluster", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "rep", "k", "elements"))
    links = (units.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
             .mapInArrow(_verified(percent), "a long, ak long, b long, bk long"))
    pair = lambda x: F.struct(F.col(x).alias("rep"), F.col(f"{x}k").alias("k"))
    found = connected_components(links.select(pair("a").alias("a"), pair("b").alias("b")))
    own = classes.select("c", "c2", "rep", "k", F.struct("rep", "k").alias("node"))
    return sig, own.join(found, "node", "left").select("c", "c2", "rep", "k", F.coalesce("component", "node").alias("root"))


def without_near_copies(docs: DataFrame, percent: int = 80, words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that lead their component (the smallest id), all
    columns kept.

    Rows of one id with different texts are documents of their own, each
    judged by its text; equal sets under one id lead together.  Null and empty
    texts link with nothing and stay, very long ones count whole; rows with a
    null id stay; an empty table gives no rows."""
    sig, root = _classes(docs, percent, words, True, id_col, text_col)
    gone = (sig.where("n > 0 AND doc_id IS NOT NULL").join(root, ["c", "c2"]).where("doc_id <> rep OR struct(rep, k) <> root")
            .select(F.col("doc_id").alias("__gone_id"), F.col("th").alias("__gone_th")).distinct())
    return docs.join(gone, (F.col(id_col).cast("long") == F.col("__gone_id")) & (F.xxhash64(F.col(text_col)) == F.col("__gone_th")), "left_anti")
