"""Quality classifier: generalised additive model with pairwise interactions.

Cyclic boosting: each round visits every feature in turn and adds one shallow
tree over that feature's bins to its lookup table; then the strongest pairs of
features get small two-way tables the same way.  A score is the logistic of
the sum of the looked-up bins.  The model is fitted on at most ``SAMPLE_ROWS``
labelled rows, picked by a hash of the id; features are computed in tasks from
whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stardw.llm.common import Words, blocks, lean, text_buffer

SAMPLE_ROWS = 8000
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE = 150, 60, 0.1

FEATURES = ["log_words", "word_length", "short_words", "long_words", "repeats_last", "distinct_words", "symbol_end",
            "upper", "lower", "digit", "space", "stop", "comma", "exclaim", "pipe", "symbol", "beyond_ascii",
            "upper_start", "bytes_a_line", "repeated_lines"]

_CLASSES = {1: range(65, 91), 2: range(97, 123), 3: range(48, 58), 4: b" \t\n\x0b\x0c\r", 5: b".", 6: b",;:", 7: b"!?", 8: b"|",
            10: range(128, 256)}
_LUT = np.full(256, 9, np.uint8)
for _k, _v in _CLASSES.items():
    _LUT[list(_v)] = _k


def features(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows x FEATURES of a block of texts; an empty text has zeros."""
    n = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1)
    kind = _LUT[raw]
    row = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets))
    share = np.bincount(row * 11 + kind, minlength=11 * n).reshape(n, 11) / size[:, None]
    w = Words(raw, offsets)
    words = np.diff(w.first)
    per = np.maximum(words, 1)
    of = lambda x: np.bincount(w.row, x, minlength=n) / per
    length = w.end - w.start
    same = np.zeros(len(length))
    if len(length) > 1:
        same[1:] = (w.hash[1:] == w.hash[:-1]) & (w.row[1:] == w.row[:-1])
    order = np.lexsort((w.hash, w.row))
    new = np.ones(len(order))
    if len(order) > 1:
        a, b = order[1:], order[:-1]
        new[1:] = (w.hash[a] != w.hash[b]) | (w.row[a] != w.row[b])
    distinct = np.bincount(w.row[order], new, minlength=n) / per
    last, first = kind[w.end - 1], kind[w.start]
    edge = np.flatnonzero(raw == 10)
    start = np.union1d(offsets[:-1][np.diff(offsets) > 0], edge + 1)
    start = start[start < len(raw)]
    end = np.append(start[1:], len(raw))
    line_row = row[start] if len(start) else np.zeros(0, np.int64)
    lines = np.maximum(np.bincount(line_row, minlength=n), 1)
    last_byte = end - 1
    end = np.where((end > start) & (raw[last_byte] == 10), last_byte, end) if len(start) else end
    h = w.span_hash(start, end)
    o = np.lexsort((h, line_row))
    again = np.zeros(len(o))
    if len(o) > 1:
        again[1:] = (h[o][1:] == h[o][:-1]) & (line_row[o][1:] == line_row[o][:-1])
    again = np.bincount(line_row[o], again, minlength=n) / lines
    return np.column_stack([np.log1p(words), of(length), of(length <= 3), of(length > 20), of(same), distinct,
                            of((last == 9) | (last == 7)), share[:, 1], share[:, 2], share[:, 3], share[:, 4], share[:, 5],
                            share[:, 6], share[:, 7], share[:, 8], share[:, 9], share[:, 10], of(first == 1),
                            np.log1p(np.diff(offsets) / lines), again])


@dataclass
class AdditiveModel:
    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    @property
    def fitted(self) -> bool:
        return bool(self.edges)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, k]) for k, e in enumerate(self.edges)]) if self.edges else x[:, :0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        b, total = self.bins(x), np.full(len(x), self.base)
        for k, t in enumerate(self.tables):
            total += t[b[:, k]]
        for (i, j), t in zip(self.pairs, self.pair_tables, strict=True):
            total += t[_coarse(b[:, i]), _coarse(b[:, j])]
        return np.round(1 / (1 + np.exp(-total)), 6)


def _coarse(b: np.ndarray) -> np.ndarray:
    return b * PAIR_BINS // BINS


def _split(g: np.ndarray, h: np.ndarray) -> tuple[int, float]:
    """The cut of an ordered run of bins that gains most (0: none)."""
    if len(g) < 2:
        return 0, 0.0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl**2 / (hl + 1) + gr**2 / (hr + 1) - g.sum()**2 / (h.sum() + 1)
    gain[(hl < 0.5) | (hr < 0.5)] = 0
    k = int(gain.argmax())
    return (k + 1, float(gain[k])) if gain[k] > 1e-9 else (0, 0.0)


def _shallow_tree(g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Leaf values over ordered bins: the best cut, then the best cut of a part."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        cut = max(((*_split(g[a:b], h[a:b]), a, b) for a, b in parts), key=lambda c: c[1])
        if not cut[0]:
            break
        k, _, a, b = cut
        parts.remove((a, b))
        parts += [(a, a + k), (a + k, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + 1)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Four leaves of a two-way grid: a cut of the rows, one of the columns in each part."""
    out = np.zeros_like(g)
    k, _ = _split(g.sum(axis=1), h.sum(axis=1))
    for a, b in ((0, k), (k, len(g))) if k else ((0, len(g)),):
        out[a:b] = _shallow_tree(g[a:b].sum(axis=0), h[a:b].sum(axis=0), 2)
    return out


def fit_additive(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Boosts on rows x features and 0/1 labels; a single class (or no row)
    gives a constant score."""
    p = (y.sum() + 0.5) / (len(y) + 1)
    m = AdditiveModel(base=float(np.log(p / (1 - p))))
    if len(np.unique(y)) < 2:
        return m
    # half of the edges among the values above the least: rare features are mostly 0
    half = np.linspace(0, 1, BINS // 2 + 1)[:-1]
    m.edges = [np.unique([*np.quantile(c, half[1:]), c.min(), *(np.quantile(c[c > c.min()], half[1:]) if c.max() > c.min() else [])])
               for c in x.T]
    m.tables = [np.zeros(BINS) for _ in m.edges]
    b = m.bins(x)
    total = np.full(len(y), m.base)

    def slopes():
        q = 1 / (1 + np.exp(-total))
        return y - q, q * (1 - q)
    for _ in range(ROUNDS):
        for k in range(len(m.tables)):
            g, h = slopes()
            step = RATE * _shallow_tree(np.bincount(b[:, k], g, BINS), np.bincount(b[:, k], h, BINS))
            m.tables[k] += step
            total += step[b[:, k]]
    c = _coarse(b)
    grid = lambda i, j, v: np.bincount(c[:, i] * PAIR_BINS + c[:, j], v, PAIR_BINS**2).reshape(PAIR_BINS, -1)
    g, h = slopes()
    gains = {}
    for i in range(len(m.tables)):
        for j in range(i + 1, len(m.tables)):
            gg, hh = grid(i, j, g), grid(i, j, h)
            gains[i, j] = float((gg * _pair_tree(gg, hh)).sum())
    m.pairs = sorted(gains, key=lambda k: (-gains[k], k))[:PAIRS]
    m.pair_tables = [np.zeros((PAIR_BINS, PAIR_BINS)) for _ in m.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (i, j) in enumerate(m.pairs):
            g, h = slopes()
            step = RATE * _pair_tree(grid(i, j, g), grid(i, j, h))
            m.pair_tables[k] += step
            total += step[c[:, i], c[:, j]]
    return m


@lean
def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offsets = text_buffer(batch.column("text"))
        for a, b in blocks(offsets):
            x = features(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            yield pa.RecordBatch.from_arrays([batch.column("label").slice(a, b - a), batch.column("id").slice(a, b - a),
                                              pa.array(list(x), pa.list_(pa.float64()))], ["label", "id", "x"])


def fit_quality_model(docs: DataFrame, labels: DataFrame, learn: Column | None = None, id_col: str = "doc_id",
                      text_col: str = "text", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> AdditiveModel:
    """Fits on rows of ``docs`` with a label in ``labels`` (null labels and ids
    are left out) for which ``learn`` (over the id of ``labels``) holds.  With
    no such row the model is not ``fitted`` and scores all texts 0.5.  The
    driver gets at most ``sample_rows`` labels and the features of as many
    rows, also where an id has several rows or labels."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()
                         & F.coalesce(F.lit(True) if learn is None else learn, F.lit(False)))
    known = known.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label"))
    sample = known.distinct().orderBy(F.xxhash64("id"), "id", "label").limit(sample_rows).collect()
    if not sample:
        return AdditiveModel()
    picked = docs.sparkSession.createDataFrame(sample, known.schema)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(picked), "id")  # sample_rows rows
    kind = known.schema["id"].dataType.simpleString()
    # an id may be on many rows: the bound holds for what reaches the driver
    got = (rows.mapInArrow(_feature_rows, f"label double, id {kind}, x array<double>")
           .orderBy(F.xxhash64("id"), "id", "label", "x").limit(sample_rows).collect())
    if not got:
        return AdditiveModel()
    got.sort(key=lambda r: (r.id, r.label, r.x))
    return fit_additive(np.array([r.x for r in got]).reshape(len(got), len(FEATURES)), np.array([r.label for r in got]))


def score_quality(docs: DataFrame, model: AdditiveModel, id_col: str = "doc_id", text_col: str = "text",
                  threshold: float = 0.7) -> DataFrame:
    """``doc_id, score, predicted`` for every row (score: 0 to 1, higher is
    better; predicted: 1 from ``threshold`` on).  Null texts score as empty
    ones; null or repeated ids keep their rows; other columns are ignored; an
    empty table gives no rows."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few tables, whatever the corpus

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_buffer(batch.column("text"))
            for a, b in blocks(offsets):
                s = shared.value.scores(features(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                                                 ["doc_id", "score", "predicted"])
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"doc_id {kind}, score double, predicted int"))


def keep_quality(docs: DataFrame, model: AdditiveModel, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, all columns kept;
    every row if the model is not ``fitted``."""
    if not model.fitted:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_buffer(batch.column(text_col))
            for a, b in blocks(offsets):
                s = shared.value.scores(features(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]))
                yield batch.slice(a, b - a).filter(pa.array(s >= threshold))
    return docs.mapInArrow(run, docs.schema)
