"""Language identification: nearest clustered centroid of TF-IDF vectors.

A text's vector counts its byte 2- and 3-grams (A-Z lower-cased, every ASCII
byte that is no letter a space), hashed to `DIM` features, log-damped, weighted
by inverse document frequency and normalised.  Each language has several
centroids from spherical k-means; the nearest by cosine names the language.  A
text further from its centroid than the training texts of that cluster is
flagged (and called ``und`` if ``reject``).

Document frequencies count all learnable rows; the clusters are fitted on at
most ``SAMPLE_PER_LANG`` rows per language, picked by a hash of the id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stardw.llm.common import blocks, mix64, text_buffer

DIM = 4096
SAMPLE_PER_LANG = 600
CENTROIDS = 4
#: Radius of a cluster: this quantile of its training distances, and a margin.
RADIUS_QUANTILE, RADIUS_MARGIN = 0.995, 0.1

_MAP = np.full(256, 0x20, np.uint8)
_MAP[65:91] = np.arange(97, 123)
_MAP[97:123] = np.arange(97, 123)
_MAP[128:] = np.arange(128, 256)
_PAIR = (mix64(np.arange(65536, dtype=np.uint64), 1) % np.uint64(DIM // 4)).astype(np.int32)
_TRI = (mix64(np.arange(65536, dtype=np.uint64), 2) >> np.uint64(32)).astype(np.uint32)
_TRI_LAST = (mix64(np.arange(256, dtype=np.uint64), 3) >> np.uint64(32)).astype(np.uint32)


def counts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows x DIM n-gram counts of a block of texts."""
    n = len(offsets) - 1
    b = _MAP[raw]
    row = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets))
    out = np.zeros(n * DIM)
    if len(b) > 1:
        pair = (b[:-1].astype(np.uint16) << np.uint16(8)) | b[1:]
        ok = (row[:-1] == row[1:]) & (pair != 0x2020)
        out += np.bincount(row[:-1][ok] * DIM + _PAIR[pair[ok]], minlength=n * DIM)
        if len(b) > 2:
            tri = (_TRI[pair[:-1]] ^ _TRI_LAST[b[2:]]) * np.uint32(0x9E3779B1)
            tri = (tri >> np.uint32(8)) % np.uint32(DIM - DIM // 4) + np.uint32(DIM // 4)
            ok = (row[:-2] == row[2:]) & (pair[:-1] != 0x2020) & (pair[1:] != 0x2020)
            out += np.bincount(row[:-2][ok] * DIM + tri[ok], minlength=n * DIM)
    return out.reshape(n, DIM)


def has_letter(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text holds a letter of any script."""
    ascii_letter = np.concatenate([[0], np.cumsum(((raw | 0x20) >= 97) & ((raw | 0x20) <= 122))])
    out = ascii_letter[offsets[1:]] > ascii_letter[offsets[:-1]]
    for r in np.flatnonzero(~out):
        text = raw[offsets[r]:offsets[r + 1]]
        if (text >= 128).any():
            out[r] = any(ch.isalpha() for ch in text.tobytes().decode("utf-8", "replace"))
    return out


@dataclass
class LanguageModel:
    idf: np.ndarray
    centroids: np.ndarray  # clusters x DIM, unit length
    langs: list[str]       # of each cluster
    radius: np.ndarray     # of each cluster, as a cosine distance

    def vectors(self, tf: np.ndarray) -> np.ndarray:
        x = np.log1p(tf) * self.idf
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def predict(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Languages, cosines (0 to 1) and whether each text is further away
        than its cluster's radius; ``und`` without letters or clusters."""
        n = len(offsets) - 1
        if not self.langs:
            return ["und"] * n, np.zeros(n), np.ones(n, bool)
        sim = self.vectors(counts(raw, offsets)) @ self.centroids.T
        best = sim.argmax(axis=1)
        score = np.round(np.clip(sim[np.arange(n), best], 0, 1), 6)
        ok = has_letter(raw, offsets)
        lang = [self.langs[k] if o else "und" for k, o in zip(best, ok, strict=True)]
        return lang, np.where(ok, score, 0.0), ~ok | (1 - score > self.radius[best])


def _cluster(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from spread-out first centroids."""
    c = [x.mean(axis=0)]
    far = x @ (c[0] / max(np.linalg.norm(c[0]), 1e-12))
    c = [x[far.argmax()]]
    while len(c) < min(k, len(x)):
        far = np.max(x @ np.array(c).T, axis=1)
        c.append(x[far.argmin()])
    c = np.array(c)
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        c = np.array([x[own == j].mean(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def _each_block(batch: pa.RecordBatch):
    raw, offsets = text_buffer(batch.column("text"))
    for lo, hi in blocks(offsets):
        # rows x DIM counts: at most 256 rows at a time
        for a in range(lo, hi, 256):
            b = min(hi, a + 256)
            yield a, b, raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, n = np.zeros(DIM, np.int64), 0
    for batch in batches:
        for a, b, raw, offs in _each_block(batch):
            df += (counts(raw, offs) > 0).sum(axis=0)
            n += b - a
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, DIM)), pa.array(np.concatenate([[n], df]))], ["feature", "n"])


def _sparse_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, raw, offs in _each_block(batch):
            tf = counts(raw, offs)
            at = [np.flatnonzero(x) for x in tf]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").slice(a, b - a), batch.column("lang").slice(a, b - a),
                 pa.array([x.astype(np.int32) for x in at], pa.list_(pa.int32())),
                 pa.array([t[x] for t, x in zip(tf, at, strict=True)], pa.list_(pa.float64()))], ["id", "lang", "at", "tf"])


def fit_language_model(docs: DataFrame, learn: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
                       lang_col: str = "lang", sample_per_lang: int = SAMPLE_PER_LANG, centroids: int = CENTROIDS) -> LanguageModel:
    """Learns from the rows of ``docs`` with a language for which ``learn``
    holds (null: no); null texts count as empty.  Without such rows the model
    has no clusters.  The driver gets DIM counts and the sample's sparse counts
    (at most ``sample_per_lang`` rows per language)."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.coalesce(F.lit(True) if learn is None else learn, F.lit(False)))
    rows = rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    df = np.zeros(DIM + 1)
    for feature, n in rows.select("text").mapInArrow(_frequencies, "feature long, n long").groupBy("feature").agg(F.sum("n")).collect():
        df[feature + 1] = n
    idf = np.log((1 + df[0]) / (1 + df[1:])) + 1
    rows = rows.withColumn("th", F.xxhash64("text"))
    by = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id", "th")
    picked = rows.where("id IS NOT NULL").select("id", "lang", "th").withColumn("k", F.row_number().over(by)).where(F.col("k") <= sample_per_lang)
    ids = picked.select("id", "lang", "th").distinct().collect()
    model = LanguageModel(idf, np.zeros((0, DIM)), [], np.zeros(0))
    if not ids:
        return model
    spark = docs.sparkSession
    wanted = spark.createDataFrame(ids, rows.select("id", "lang", "th").schema)
    # bounded: sample_per_lang rows per language, each once however often it is repeated
    sample = rows.join(F.broadcast(wanted), ["id", "lang", "th"]).groupBy("id", "lang", "th").agg(F.min("text").alias("text")).mapInArrow(
        _sparse_counts, f"id {rows.schema['id'].dataType.simpleString()}, lang string, at array<int>, tf array<double>").collect()
    sample.sort(key=lambda r: (r.lang, r.id, r.at, r.tf))
    langs = sorted({r.lang for r in sample})
    found, names, radius = [], [], []
    for lang in langs:
        own = [r for r in sample if r.lang == lang]
        tf = np.zeros((len(own), DIM))
        for k, r in enumerate(own):
            tf[k, r.at] = r.tf
        x = model.vectors(tf)
        x = x[np.linalg.norm(x, axis=1) > 0]
        if not len(x):
            continue
        c = _cluster(x, centroids)
        sim = x @ c.T
        near, best = sim.max(axis=1), sim.argmax(axis=1)
        found.append(c)
        names += [lang] * len(c)
        radius += [float(np.quantile(1 - near[best == j], RADIUS_QUANTILE)) + RADIUS_MARGIN if (best == j).any() else 0.0
                   for j in range(len(c))]
    if found:
        model = LanguageModel(idf, np.concatenate(found), names, np.array(radius))
    return model


def identify_language(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text",
                      reject: bool = True) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` for every row of ``docs``.

    ``score`` is the cosine to the nearest centroid.  Null texts and texts
    without a letter give ``und`` with score 0; with ``reject`` so do texts
    beyond their cluster's radius (their score stays).  Ties go to the
    language that sorts first; null or repeated ids keep their rows; other
    columns are ignored; an empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # clusters x DIM, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for a, b, raw, offs in _each_block(batch):
                lang, score, far = m.predict(raw, offs)
                if reject:
                    lang = ["und" if f else x for x, f in zip(lang, far, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(lang, pa.string()), pa.array(score),
                                                  pa.array(far)], ["doc_id", "lang_pred", "score", "rejected"])
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, rejected boolean"))
