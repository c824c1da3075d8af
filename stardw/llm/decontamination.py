"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are read as case-folded words.  Items that share
a run of ``seed`` words with a document (found by Karp-Rabin hashes of all its
runs) are tiled on it: the longest match that touches no marked word is marked
on both sides, again and again, until none of ``seed`` words is left.  An item
whose tiles cover ``threshold`` of its words is in the document, in whatever
order its passages stand.
"""

from __future__ import annotations

import heapq
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stardw.llm.common import Words, blocks, gram_hash, lean, text_buffer
from stardw.session import scratch_dir

SEED_WORDS, THRESHOLD = 5, 0.8
#: Characters of benchmark text that one pass over the documents looks for.
PASS_CHARS = 8 << 20

#: Scripts written without spaces (Han, kana, Thai, Lao, Myanmar, Khmer and their kin).
_UNSPACED = [(0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x3005, 0x3007), (0x3021, 0x312F), (0x31A0, 0x31FF),
             (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xA980, 0xA9DF), (0xAA60, 0xAA7F), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1B000, 0x1B16F), (0x20000, 0x3FFFF)]
_OTHER = re.compile(r"[^\w\x00-\x7f]|[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in _UNSPACED) + "]")
#: A letter that is a word, and the marks on it.
_MARKED = re.compile(r"\0((?:[^\w\x00-\x7f])*)")
_SEP = np.ones(256, bool)
_SEP[[*range(48, 58), *range(65, 91), *range(97, 123), 95, *range(128, 256)]] = False


@lru_cache(maxsize=1 << 17)
def _spaced(c: str) -> str:
    """A character of a word (marks too), one that is a word or none, or no character."""
    kind = unicodedata.category(c)
    if kind[0] == "M":
        return "" if "\ufe00" <= c <= "\ufe0f" or "\U000e0100" <= c <= "\U000e01ef" else c
    if kind == "Cf":
        return " " if c == "\u200b" else ""
    return f" {c}\0" if kind[0] in "LN" else " "


def fold(text: str) -> str:
    """Case-folded text in which all beyond ASCII is words: other characters
    there (quotes, dashes, spaces) part words, format characters and variation
    selectors go, and letters of unspaced scripts are words, with their marks."""
    text = text.casefold()
    if text.isascii():
        return text
    text = _OTHER.sub(lambda m: _spaced(m[0]), text)
    return _MARKED.sub(r"\1 ", text) if "\0" in text else text


def folded_words(texts: list[str | None], limit: int = 1 << 20) -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, words) of blocks of case-folded texts; a word is a
    run of letters, marks, digits and underscores, or one letter of an unspaced
    script."""
    raw, offsets = text_buffer(pa.array([fold(t) if t else "" for t in texts], pa.large_string()))
    for lo, hi in blocks(offsets, limit):
        yield lo, hi, Words(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], sep=_SEP)


def tiles(item: np.ndarray, doc: np.ndarray, at: np.ndarray, to: np.ndarray, seed: int) -> list[tuple[int, int, int]]:
    """Greedy tiling (item position, doc position, words).  ``at``/``to``:
    positions in item and doc of equal runs of ``seed`` words."""
    order = np.lexsort((at, to - at))
    at, to = at[order], to[order]
    edge = np.flatnonzero(np.append(True, (np.diff(at) != 1) | (np.diff(to) != 1)))
    size = np.diff(np.append(edge, len(at))) + seed - 1
    heap = [(-n, a, b) for n, a, b in zip(size.tolist(), at[edge].tolist(), to[edge].tolist(), strict=True)]
    heapq.heapify(heap)
    marked_item, marked_doc, out = np.zeros(len(item), bool), {}, []
    while heap:
        n, a, b = heapq.heappop(heap)
        n = -n
        free = ~marked_item[a:a + n]
        if marked_doc:
            free &= np.fromiter((x not in marked_doc for x in range(b, b + n)), bool, n)
        if free.all():
            out.append((a, b, n))
            marked_item[a:a + n] = True
            marked_doc.update(dict.fromkeys(range(b, b + n)))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[False], free, [False]]).astype(np.int8)))
        for lo, hi in edges.reshape(-1, 2).tolist():  # what is left of it, to be met again by its length
            if hi - lo >= seed:
                heapq.heappush(heap, (lo - hi, a + lo, b + lo))
    return out


class Seeds:
    """Runs of ``seed`` words of the items with their place in them; with
    ``whole`` only those that are an item."""

    def __init__(self, items: list[np.ndarray], seed: int, whole: bool):
        self.seed = seed
        grams = [gram_hash(h, seed) if not whole or len(h) == seed else h[:0] for h in items]
        size = [len(g) for g in grams]
        h = np.concatenate([np.zeros(0, np.uint64), *grams])
        order = np.argsort(h, kind="stable")
        self.hashes = h[order]
        self.owner = np.repeat(np.arange(len(items)), size)[order]
        self.place = (np.arange(len(h)) - np.repeat(np.cumsum(size) - size, size))[order]
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[self.hashes >> np.uint64(42)] = True

    def found(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """(place in the block, place in ``hashes``) of the seeds in its texts."""
        g = gram_hash(w.hash, self.seed)
        near = np.flatnonzero(self.maybe[g >> np.uint64(42)])
        near = near[near + self.seed <= w.first[w.row[near] + 1]]
        lo, hi = np.searchsorted(self.hashes, g[near]), np.searchsorted(self.hashes, g[near], "right")
        near, lo, n = near[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
        return np.repeat(near, n), np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


class BenchmarkIndex:
    """Seeds of a bounded part of the benchmark: runs of ``seed`` words, and
    shorter items as a whole."""

    def __init__(self, items: list[tuple[int, str | None]], seed: int = SEED_WORDS):
        self.ids, self.words = [i for i, _ in items], []
        for lo, hi, w in folded_words([t for _, t in items]):
            self.words += [w.hash[w.first[r]:w.first[r + 1]] for r in range(hi - lo)]
        sizes = {min(seed, len(h)) for h in self.words} - {0}
        self.seeds = [Seeds(self.words, k, k < seed) for k in sorted(sizes)]

    def matches(self, w: Words, rows: int) -> list[list[tuple[float, int]]]:
        """(coverage, item id) of every item that shares a seed, for each row."""
        out: list[list[tuple[float, int]]] = [[] for _ in range(rows)]
        for seeds in self.seeds:
            pos, at = seeds.found(w)
            if not len(pos):
                continue
            row, item = w.row[pos], seeds.owner[at]
            order = np.lexsort((item, row))
            row, item, pos, at = row[order], item[order], pos[order], at[order]
            edge = np.flatnonzero(np.append(True, (np.diff(row) != 0) | (np.diff(item) != 0)))
            for a, b in zip(edge.tolist(), np.append(edge[1:], len(row)).tolist(), strict=True):
                r, i = int(row[a]), int(item[a])
                first = int(w.first[r])
                got = tiles(self.words[i], w.hash[first:w.first[r + 1]], seeds.place[at[a:b]], pos[a:b] - first, seeds.seed)
                out[r].append((sum(x[2] for x in got) / len(self.words[i]), self.ids[i]))
        return out


def benchmark_parts(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", pass_chars: int = PASS_CHARS) -> tuple[DataFrame, int]:
    """The items with the number of their pass, and the number of passes, each
    of about ``pass_chars`` characters (a longer item is alone)."""
    items = benchmark.where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = int(total // pass_chars) + 1
    return items.withColumn("part", F.pmod(F.xxhash64("id", "text"), F.lit(parts))), parts


def part_index(numbered: DataFrame, part: int, seed: int):
    """The broadcast index of one pass; no other part is on the driver."""
    got = numbered.where(F.col("part") == part).select("id", "text").distinct().collect()
    return numbered.sparkSession.sparkContext.broadcast(BenchmarkIndex(sorted((x.id, x.text) for x in got), seed))


def _text_keys(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def passes(texts: DataFrame, numbered: DataFrame, parts: int, threshold: float, seed: int) -> DataFrame:
    """``k1, k2`` (of the text), ``coverage, item_ids`` of the column ``text``
    where it shares a seed.  What a pass finds is written, and its index let go,
    before the next one is built."""
    path = scratch_dir(texts.sparkSession, "tiles")
    k1, k2 = _text_keys(F.col("text"))
    rows = texts.where(F.col("text").isNotNull()).select(k1.alias("k1"), k2.alias("k2"), "text")
    kind = "k1 long, k2 long, part int, coverage double, item_ids array<long>"
    for part in range(parts):
        index = part_index(numbered, part, seed)
        rows.mapInArrow(_finder(index, part, threshold), kind).write.mode("append").parquet(path)
        index.destroy()
    found = texts.sparkSession.read.schema(kind).parquet(path).dropDuplicates(["k1", "k2", "part"])
    return found.groupBy("k1", "k2").agg(F.max("coverage").alias("coverage"), F.flatten(F.collect_list("item_ids")).alias("item_ids"))


def _finder(index, part: int, threshold: float):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, w in folded_words(batch.column("text").to_pylist()):
                found = index.value.matches(w, hi - lo)
                at = [k for k, got in enumerate(found) if got]
                keys = batch.select(["k1", "k2"]).slice(lo, hi - lo).take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays([*keys.columns, pa.array([part] * len(at), pa.int32()),
                                                  pa.array([max(c for c, _ in found[k]) for k in at], pa.float64()),
                                                  pa.array([[i for c, i in found[k] if c >= threshold] for k in at], pa.list_(pa.int64()))],
                                                 ["k1", "k2", "part", "coverage", "item_ids"])
    return run


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  threshold: float = THRESHOLD, seed: int = SEED_WORDS, pass_chars: int = PASS_CHARS) -> DataFrame:
    """``doc_id, contaminated, coverage, item_ids`` for every row of ``docs``.

    ``coverage`` is the largest share of an item's words that its tiles on the
    text cover, ``item_ids`` the items with ``threshold`` or more, in order.
    An item with fewer words than a seed is looked for as a whole.  Null and
    empty texts match nothing, very long ones are read whole; items without a
    word, with a null id or text are not looked for; null or repeated ids keep
    their rows; other columns are ignored; an empty table gives no rows, an
    empty benchmark no matches.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.lit(0.0).alias("coverage"),
                      F.array().cast("array<long>").alias("item_ids"))
    numbered, parts = benchmark_parts(benchmark, pass_chars=pass_chars)
    if parts > 1:
        found = passes(out, numbered, parts, threshold, seed)
        k1, k2 = _text_keys(F.col("text"))
        out = out.select("doc_id", k1.alias("k1"), k2.alias("k2")).join(found, ["k1", "k2"], "left").select(
            "doc_id", F.coalesce("coverage", F.lit(0.0)).alias("coverage"), F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"))
    else:
        out = out.mapInArrow(_adder(part_index(numbered, 0, seed), threshold), f"doc_id {kind}, text string, coverage double, item_ids array<long>")
    return out.select("doc_id", (F.size("item_ids") > 0).alias("contaminated"), "coverage", F.array_sort("item_ids").alias("item_ids"))


def _adder(index, threshold: float):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, w in folded_words(batch.column("text").to_pylist()):
                part = batch.slice(lo, hi - lo)
                found = index.value.matches(w, hi - lo)
                best = [max([c, *(x for x, _ in got)]) for c, got in zip(part.column("coverage").to_pylist(), found, strict=True)]
                ids = [old + [i for x, i in got if x >= threshold] for old, got in zip(part.column("item_ids").to_pylist(), found, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text"), pa.array(best, pa.float64()), pa.array(ids, pa.list_(pa.int64()))],
                                                 ["doc_id", "text", "coverage", "item_ids"])
    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", threshold: float = THRESHOLD,
                  seed: int = SEED_WORDS, pass_chars: int = PASS_CHARS) -> DataFrame:
    """The rows of ``docs``, all columns kept, that hold no benchmark item."""
    def keeper(index):
        @lean
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lo, hi, w in folded_words(batch.column(text_col).to_pylist()):
                    clean = [all(x < threshold for x, _ in got) for got in index.value.matches(w, hi - lo)]
                    yield batch.slice(lo, hi - lo).filter(pa.array(clean, pa.bool_()))
        return run
    numbered, parts = benchmark_parts(benchmark, pass_chars=pass_chars)
    if parts == 1:
        return docs.mapInArrow(keeper(part_index(numbered, 0, seed)), docs.schema)
    found = passes(docs.select(F.col(text_col).alias("text")), numbered, parts, threshold, seed)
    found = found.where(F.size("item_ids") > 0).select("k1", "k2")
    k1, k2 = _text_keys(docs[text_col])
    return docs.join(found, (k1 == found["k1"]) & (k2 == found["k2"]), "left_anti")
