"""Phrase collocations by multikey quicksort of suffix pointers.

Phrases are counted in two passes over the texts.  The first one counts single
words and word pairs by their hashes, map side first, and marks the frequent
ones in a bit filter of fixed size.  The second one cuts each suffix (a place
in a piece) where its next pair is not marked: a phrase with an infrequent part
is infrequent, so nothing that counts is cut, and wrong marks only send more.
Equal suffixes fold to one row with their number.  Folded suffixes are routed
by their two leading words; within a task a three-way quicksort, one word
deeper for the equal part, sorts pointers to them.  The size of an equal part
is its phrase's count, and parts that are too small are abandoned.

Leading pairs with very many suffixes are dealt to all tasks instead, in which
nothing is abandoned; the parts' counts add up afterwards like all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stardw.llm.common import Words, blocks, lean, mix64, text_buffer
from stardw.llm.components import stored
from stardw.llm.periodic_runs import word_numbers

MAX_WORDS, MIN_COUNT, TOP = 5, 100, 2000
#: Bits of the filter of frequent words and pairs (8 MB, whatever the corpus).
FILTER_BITS = 1 << 26
#: A leading pair with more distinct suffixes than this is dealt to all tasks.
HOT_SUFFIXES = 50_000
#: Suffixes that one quicksort works on.
BUFFER = 100_000
_SPLIT = np.zeros(256, bool)
_SPLIT[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_SEP = _SPLIT.copy()
_SEP[[0x20, 0x09]] = True


class Pieces:
    """Lower-cased words of a block of texts, their hashes (with the language's)
    and how many words of their piece follow."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, lang: np.ndarray):
        low = raw.copy()
        low[(raw >= 65) & (raw <= 90)] += 32
        self.words = w = Words(low, offsets, sep=_SEP)
        piece = np.concatenate([[0], np.cumsum(_SPLIT[raw])])[w.start] + w.row  # no piece goes on in the next text
        last = np.flatnonzero(np.append(piece[1:] != piece[:-1], True)) if len(piece) else piece
        self.after = np.repeat(last, np.diff(np.append(-1, last))) - np.arange(len(piece))
        self.single = mix64(w.hash ^ lang[w.row])
        self.pair = mix64(self.single[:-1] * np.uint64(0x9E3779B97F4A7C15) + self.single[1:], 1)
        self.has_next = self.after[:-1] > 0


def _lang_hashes(lang: pa.Array) -> np.ndarray:
    raw, offsets = text_buffer(lang)
    return Words(raw, offsets, sep=np.zeros(256, bool)).span_hash(offsets[:-1], offsets[1:])


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[int, int, Pieces]]:
    raw, offsets = text_buffer(batch.column("text"))
    lang = _lang_hashes(batch.column("lang"))
    for lo, hi in blocks(offsets):
        yield lo, hi, Pieces(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], lang[lo:hi])


@lean
def _hash_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of words and pairs with their numbers in a block."""
    for batch in batches:
        for _, _, p in _pieces(batch):
            h, n = np.unique(np.concatenate([p.single, p.pair[p.has_next]]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.astype(np.int64)), pa.array(n)], ["h", "n"])


def _bits(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(FILTER_BITS - 1)).astype(np.int64)


def frequent_filter(counts: DataFrame, min_count: int) -> np.ndarray:
    """A bit for each residue of the hashes ``h`` that have ``min_count`` or more."""
    place = F.col("h").bitwiseAND(F.lit(FILTER_BITS - 1)) + 1  # bitmaps count from 1
    marked = (counts.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count).select(place.alias("at"))
              .groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")))
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for bucket, bits in marked.toLocalIterator():  # buckets of 4 KB, FILTER_BITS / 8 bytes in all
        out[(bucket - 1) * 4096:bucket * 4096] = np.frombuffer(bytes(bits), np.uint8)
    return out


def marked(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which hashes the filter marks."""
    k = _bits(h)
    return (bits[k >> 3] >> (k & 7).astype(np.uint8)) & 1 == 1


def _suffixes(shared, max_words: int):
    """Distinct suffixes of a block, cut where nothing frequent follows."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            for lo, _, p in _pieces(batch):
                w, total = p.words, len(p.words.start)
                single = marked(bits, p.single)
                # frequent pairs on end, from each word on
                linked = np.append(marked(bits, p.pair) & p.has_next & single[:-1] & single[1:], False)[:total]
                size = single.astype(np.int64)
                more = linked.copy()
                for k in range(1, max_words):
                    size += more
                    rest = max(0, total - k)
                    more[:rest] &= linked[k:]
                    more[rest:] = False
                at = np.flatnonzero(size)
                lang = batch.column("lang")
                yield from _totals(lang, lo, w)
                if not len(at):
                    continue
                ids = np.append(word_numbers(w), np.zeros(max_words, np.int64))
                langs = pa.compute.index_in(lang, value_set=lang.unique()).to_numpy(zero_copy_only=False)[lo + w.row[at]]
                keys = [np.where(k < size[at], ids[at + k], 0) for k in range(max_words)]
                order = np.lexsort([*reversed(keys), langs])
                new = np.append(True, np.any([x[order][1:] != x[order][:-1] for x in (langs, *keys)], axis=0))
                edge = np.flatnonzero(new)
                first = at[order[edge]]
                n = np.diff(np.append(edge, len(order)))
                data, begin, end = w.raw.tobytes(), w.start, w.end
                text = []
                for x, s in zip(first.tolist(), size[first].tolist(), strict=True):
                    text.append(data[begin[x]:end[x]] if s == 1 else b" ".join([data[begin[y]:end[y]] for y in range(x, x + s)]))
                for k in range(0, len(first), 10000):
                    part = first[k:k + 10000]
                    yield pa.RecordBatch.from_arrays([lang.take(pa.array(lo + w.row[part])), pa.array(text[k:k + 10000], pa.binary()).cast(pa.string()),
                                                      pa.array(size[part].astype(np.int32)), pa.array(n[k:k + 10000])], ["lang", "suffix", "size", "n"])
    return run


def _totals(lang: pa.Array, lo: int, w: Words) -> Iterator[pa.RecordBatch]:
    """All words of each language, as rows of an empty suffix."""
    here = lang.slice(lo, len(w.offsets) - 1).dictionary_encode()
    n = np.bincount(here.indices.to_numpy(zero_copy_only=False), np.diff(w.first)).astype(np.int64)
    yield pa.RecordBatch.from_arrays([here.dictionary, pa.array([""] * len(n), pa.string()), pa.array(np.zeros(len(n), np.int32)), pa.array(n)],
                                     ["lang", "suffix", "size", "n"])


def multikey_quicksort(keys: np.ndarray, n: np.ndarray, least: int, depth: int = 0) -> Iterator[tuple[int, int, int]]:
    """(a pointer, depth + 1, count) of each prefix of the rows of ``keys``
    (0 ends a row) that ``least`` rows or more have, each row counting ``n``;
    prefixes of up to ``depth`` columns are taken as equal."""
    todo = [(np.arange(len(n)), depth)]
    while todo:
        ptr, d = todo.pop()
        if not len(ptr) or n[ptr].sum() < least:
            continue  # abandoned: no phrase in it is frequent
        key = keys[ptr, d]
        pivot = np.sort(key[[0, len(key) // 2, -1]])[1]
        equal = key == pivot
        if not equal.all():
            todo += [(ptr[key < pivot], d), (ptr[key > pivot], d)]
            ptr = ptr[equal]
        count = int(n[ptr].sum())
        if pivot and count >= least:
            yield int(ptr[0]), d + 1, count
            if d + 1 < keys.shape[1]:
                todo.append((ptr, d + 1))


def _counted(rows: pa.Table, least: int, max_words: int) -> pa.RecordBatch:
    """Counts of the phrases of two words or more that begin these suffixes."""
    raw, offsets = text_buffer(rows.column("suffix"))
    w = Words(raw, offsets, sep=_SEP)
    ids, size = np.append(word_numbers(w), np.zeros(max_words, np.int64)), np.diff(w.first)
    keys = np.zeros((len(size), max_words + 1), np.int64)
    keys[:, 0] = rows.column("lang").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False) + 1
    for k in range(max_words):
        keys[:, k + 1] = np.where(k < size, ids[np.minimum(w.first[:-1] + k, len(ids) - 1)], 0)
    n = rows.column("n").to_numpy()
    got = [x for x in multikey_quicksort(keys, n, least) if x[1] > 2]
    data = raw.tobytes()
    phrase = [data[w.start[w.first[x]]:w.end[w.first[x] + d - 2]] for x, d, _ in got]
    ptr = np.array([x for x, _, _ in got], np.int64)
    return pa.RecordBatch.from_arrays([rows.column("lang").take(pa.array(ptr)).combine_chunks(), pa.array(phrase, pa.binary()).cast(pa.string()),
                                       pa.array([d - 1 for _, d, _ in got], pa.int32()), pa.array([c for *_, c in got], pa.int64())],
                                      ["lang", "phrase", "size", "n"])


def _sorted_counts(min_count: int, max_words: int, buffer: int):
    """Quicksorts rows in order of their route, whole routes at a time; parts
    of a hot lead are sorted as they come, keeping all counts."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bool, list[pa.Table]] = {False: [], True: []}
        for batch in batches:
            for hot in (False, True):
                rows = pa.Table.from_batches([batch]).filter(pa.compute.equal(batch.column("hot"), hot))
                if rows.num_rows:
                    held[hot].append(rows)
                if sum(x.num_rows for x in held[hot]) < buffer:
                    continue
                rows = pa.concat_tables(held[hot])
                # the last route may go on (it has HOT_SUFFIXES at most)
                route = rows.column("route").to_numpy()
                cut = len(route) if hot else int(np.flatnonzero(np.append(True, route[1:] != route[:-1]))[-1])
                if cut:
                    yield _counted(rows.slice(0, cut), 1 if hot else min_count, max_words)
                held[hot] = [rows.slice(cut)] if cut < len(route) else []
        for hot, rows in held.items():
            if rows:
                yield _counted(pa.concat_tables(rows), 1 if hot else min_count, max_words)
    return run


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, lang_col: str = "lang",
                  text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, size, a`` of all phrases of one to ``max_words`` words
    that occur ``min_count`` times or more, and ``lang, n`` (all words)."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(frequent_filter(rows.mapInArrow(_hash_counts, "h long, n long"), min_count))
    folded = stored(rows.mapInArrow(_suffixes(shared, max_words), "lang string, suffix string, size int, n long")
                    .groupBy("lang", "suffix", "size").agg(F.sum("n").alias("n")), "phrase-suffixes")
    shared.unpersist()
    totals = folded.where("size = 0").select("lang", "n")
    # single words are counted with map-side sums: all suffixes that start with one may be a third of the rows
    ones = folded.where("size > 0").groupBy("lang", F.substring_index("suffix", " ", 1).alias("phrase")).agg(F.sum("n").alias("a")).where(F.col("a") >= min_count)
    longer = folded.where("size > 1").withColumn("lead", F.substring_index("suffix", " ", 2))
    hot = longer.groupBy("lang", "lead").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > HOT_SUFFIXES).select("lang", "lead", F.lit(True).alias("hot"))
    routed = longer.join(hot, ["lang", "lead"], "left").withColumn("hot", F.coalesce("hot", F.lit(False))).select(
        "lang", "suffix", "n", "hot", F.when(F.col("hot"), F.xxhash64("lang", "suffix")).otherwise(F.xxhash64("lang", "lead")).alias("route"))
    counts = (routed.repartition("route").sortWithinPartitions("route").mapInArrow(_sorted_counts(min_count, max_words, BUFFER), "lang string, phrase string, size int, n long")
              .groupBy("lang", "phrase", "size").agg(F.sum("n").alias("a")).where(F.col("a") >= min_count))
    every = ones.select("lang", "phrase", F.lit(1).alias("size"), "a").unionByName(counts)
    return stored(every, "phrase-counts"), totals


def _part(first: int | str, size: Column | str) -> Column:
    return F.expr(f"array_join(slice(words, CAST({first} AS INT), CAST({size} AS INT)), ' ')")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP, contained_percent: int = 100,
                 lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each
    language (null: ``und``), by score and then ``a`` descending, then phrase.

    Texts are lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and
    those into words ``[^\\x20\\x09]+``; ``n`` counts the language's words and
    ``a`` the occurrences of a phrase within pieces, overlaps included.
    Candidates have 2 to ``max_words`` words and occur ``min_count`` times or
    more (two or more words and times).  Cut after its first k words a candidate
    has ``l`` and ``r``, the counts of both sides, and the score
    floor(1000 a n / (l r)); its lowest score counts, ties go to the smallest k.
    A candidate goes if a longer one contains it and has ``contained_percent``
    of its occurrences or more.

    Null and empty texts have no words; very long texts count whole; repeated
    rows count each; other columns are ignored; an empty table gives no rows.
    Phrases are kept joined by single spaces.
    """
    every, totals = phrase_counts(docs, min_count, max_words, lang_col, text_col)
    found = every.where("size > 1").withColumn("words", F.split("phrase", " "))
    inner = found.select("lang", "a", F.explode_outer(F.expr(
        "flatten(transform(sequence(2, greatest(2, size - 1)), k -> transform(sequence(1, size - k + 1), i -> IF(k < size, array_join(slice(words, i, k), ' '), NULL))))"
    )).alias("phrase")).where("phrase IS NOT NULL").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = found.join(inner, ["lang", "phrase"], "left").where(F.expr(f"longer IS NULL OR 100 * longer < {contained_percent} * a"))
    cuts = kept.select("lang", "phrase", "words", "size", "a", F.explode(F.expr("sequence(1, size - 1)")).alias("k")).select(
        "lang", "phrase", "a", "k", _part(1, "k").alias("head"), _part("k + 1", "size - k").alias("rest"))
    one = lambda name, count: every.select("lang", F.col("phrase").alias(name), F.col("a").alias(count))
    whole = lambda x: f"CAST({x} AS DECIMAL(38,0))"
    scored = cuts.join(one("head", "l"), ["lang", "head"]).join(one("rest", "r"), ["lang", "rest"]).join(totals, "lang").withColumn(
        "score", F.expr(f"({whole('1000')} * a * n) DIV ({whole('l')} * r)"))
    least = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    ranked = least.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score").withColumn("rank", F.expr(
        "CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS BIGINT)"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
