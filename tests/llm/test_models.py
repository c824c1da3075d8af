"""Language identification, quality classifier and decontamination."""

import random

import numpy as np
from helpers import table
from pyspark.sql import functions as F

from stardw.llm import decontamination as D
from stardw.llm import language_id as L
from stardw.llm import quality as Q
from stardw.llm.common import text_buffer
from stardw.llm.language_id import fit_language_model, has_letter, identify_language
from stardw.llm.queries import op1_language_id, op10_quality

SF = "/root/testdata/sf0.01"
ODD = [(901, None), (902, ""), (903, "123 !!"), (904, "日本語の文"), (905, "a"), (906, "xq " * 40000), (None, "the and of")]


def test_language_held_out_accuracy_and_rejection(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = op1_language_id(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 100 and np.mean([r.lang_pred == r.lang for r in got]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)
    model = fit_language_model(docs, sample_per_lang=50, centroids=2)
    assert {model.langs.count(x) for x in set(model.langs)} == {2}
    rows = {r.doc_id: r for r in identify_language(table(spark, ODD), model).collect()}
    assert len(rows) == len(ODD)
    for i in (901, 902, 903):
        assert (rows[i].lang_pred, rows[i].score) == ("und", 0.0)
    assert rows[904].lang_pred == "und" and rows[904].rejected  # letters, but far from every centroid
    kept = {r.doc_id: r.lang_pred for r in identify_language(table(spark, ODD), model, reject=False).collect()}
    assert kept[904] in model.langs and kept[901] == "und"
    assert identify_language(docs.limit(0), model).count() == 0
    none = fit_language_model(docs.where("false"))
    assert {r.lang_pred for r in identify_language(table(spark, ODD), none).collect()} == {"und"}


def test_has_letter():
    import pyarrow as pa
    raw, offs = text_buffer(pa.array(["1 2", "é", "1a", None, "…", "日"]))
    assert has_letter(raw, offs).tolist() == [False, True, True, False, False, True]


def test_quality_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = op10_quality(spark, SF)
    assert got.count() == 1000
    known = got.join(labels, "doc_id").where("held_out AND quality IS NOT NULL").collect()
    good, bad = ([r for r in known if r.quality == q] for q in (1, 0))
    assert np.mean([r.predicted for r in good]) > 0.95 and np.mean([r.predicted for r in bad]) < 0.3
    assert all(r.predicted == int(r.score >= 0.7) for r in known)


def test_quality_edges(spark):
    docs = table(spark, ODD + [(1, "Fine words here, all of them."), (1, "Fine words here, all of them.")])
    labels = spark.createDataFrame([(1, 1), (902, 0), (903, None), (None, 1)], "doc_id long, quality int")
    model = Q.fit_quality_model(docs, labels)
    got = Q.score_quality(docs, model).collect()
    assert len(got) == len(ODD) + 2 and all(0 <= r.score <= 1 for r in got)
    kept = Q.keep_quality(docs, model, threshold=0.0)
    assert kept.columns == docs.columns and kept.count() == len(got)
    assert Q.keep_quality(docs, model, threshold=1.1).count() == 0
    assert Q.score_quality(docs.limit(0), model).count() == 0
    empty = Q.fit_quality_model(docs, labels.where("false"))
    assert {r.score for r in Q.score_quality(docs, empty).collect()} == {0.5}


def test_quality_stage_without_labels_keeps_all(spark, tmp_path):
    import corpus_pipeline
    docs = table(spark, ODD + [(1, "Fine words here, all of them.")])
    for k, rows in enumerate(([], [(1, None), (None, 1)], [(-77, 1)])):  # none, none usable, none of these documents
        spark.createDataFrame(rows, "doc_id long, quality int").write.parquet(f"{tmp_path}/{k}/labels.parquet")
        kept = corpus_pipeline.quality(spark, docs, f"{tmp_path}/{k}")
        assert kept.columns == docs.columns and kept.count() == len(ODD) + 1


def test_additive_model_learns_steps_and_a_pair():
    rnd = np.random.default_rng(0)
    x = rnd.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # no single feature tells
    m = Q.fit_additive(x[:3000], y[:3000])
    assert (0, 1) in m.pairs
    assert np.mean((m.scores(x[3000:]) > 0.5) == y[3000:]) > 0.9
    y = (x[:, 2] > 0.3).astype(float)
    assert np.mean((Q.fit_additive(x[:3000], y[:3000]).scores(x[3000:]) > 0.5) == y[3000:]) > 0.97


def brute_coverage(item, doc, seed):
    """Greedy string tiling by trying all pairs of positions."""
    a, b = (D_words(t) for t in (item, doc))
    ua, ub, covered = [False] * len(a), [False] * len(b), 0
    while True:
        best = (seed - 1, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and not ua[i + n] and not ub[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < seed:
            return covered / len(a)
        for x in range(n):
            ua[i + x] = ub[j + x] = True
        covered += n


def D_words(text):
    import re
    return re.findall(r"\w+", text.casefold())


def test_tiling_against_brute_force(spark):
    rnd = random.Random(4)
    items = [(k, " ".join(rnd.choices("abcdefgh", k=rnd.randint(5, 30)))) for k in range(8)]
    rows = []
    for i in range(60):
        parts = [x for _, t in rnd.sample(items, 2) for x in (t.split()[:12], t.split()[12:])]
        rnd.shuffle(parts)
        rows.append((i, " ".join(w.upper() + "!" for p in parts for w in p) + " " + " ".join(rnd.choices("abcdefgh", k=9))))
    bench = table(spark, items, "item_id long, text string")
    for chars in (D.PASS_CHARS, 60):  # one pass, several passes
        got = D.contamination(table(spark, rows), bench, pass_chars=chars).collect()
        for r in got:
            want = {k: brute_coverage(t, rows[r.doc_id][1], 5) for k, t in items}
            assert abs(r.coverage - max(want.values())) < 1e-9, r.doc_id
            assert r.item_ids == sorted(k for k, c in want.items() if c >= 0.8) and r.contaminated == bool(r.item_ids)


def test_words_beyond_ascii(spark):
    han, thai = "今天天气很好我们去公园散步吧", "วันนี้อากาศดีมาก"
    plain, hindi = "he said the quick brown fox jumps over it", "यह एक छोटा सा हिन्दी वाक्य है"
    bench = table(spark, [(1, han), (2, plain), (3, thai), (4, hindi)], "item_id long, text string")
    rows = [(1, f"前言{han}後記"), (2, "\u201che\u00a0said\u2014the\u00abquick\u00bbbrown\u2019fox\u2026jumps\u2013over\u3000it\u201d"), (3, f"x{thai}y"),
            (4, f"({hindi}।)"), (5, "今天我们很好"), (6, "he said the quick"), (7, "he said the qu\u00adick brown fox jumps over it")]
    got = {r.doc_id: r.item_ids for r in D.contamination(table(spark, rows), bench).collect()}
    assert got == {1: [1], 2: [2], 3: [3], 4: [4], 5: [], 6: [], 7: [2]}


def test_one_index_at_a_time(spark, monkeypatch):
    from pyspark.core.broadcast import Broadcast
    rnd, events = random.Random(6), []
    items = [(k % 9, " ".join(rnd.choices("abcdefghij", k=8))) for k in range(12)]
    rows = [(i % 25, rnd.choice(items)[1] + " x " + rnd.choice(items)[1]) for i in range(30)] + [(None, items[0][1]), (50, None), (51, "none of it")]
    docs, bench = table(spark, rows), table(spark, items, "item_id long, text string")
    want, clean = (sorted(map(str, f(docs, bench).collect())) for f in (D.contamination, D.decontaminate))
    init, destroy = D.BenchmarkIndex.__init__, Broadcast.destroy
    monkeypatch.setattr(D.BenchmarkIndex, "__init__", lambda self, *a: (events.append("built"), init(self, *a))[1])
    monkeypatch.setattr(Broadcast, "destroy", lambda self, *a: (events.append("gone"), destroy(self, *a))[1])
    for f, known in ((D.contamination, want), (D.decontaminate, clean)):
        events.clear()
        got = f(docs, bench, pass_chars=40)
        assert sorted(map(str, got.collect())) == known
        assert len(events) > 4 and events == ["built", "gone"] * (len(events) // 2)


def test_reordered_passages_and_edges(spark):
    item = "Alpha beta gamma delta epsilon zeta eta theta iota kappa"
    bench = table(spark, [(7, item), (8, None), (None, item), (9, "too short"), (7, item)], "item_id long, text string")
    moved = "zeta eta theta iota kappa -- and then -- alpha beta gamma delta epsilon"
    rows = [(1, moved), (2, item.upper() + "!!"), (3, "alpha beta gamma delta"), (4, None), (5, ""), (None, item), (1, moved),
            (6, "too short"), (7, "filler " * 50000 + item)]
    got = D.contamination(table(spark, rows), bench).collect()
    assert len(got) == len(rows)
    flagged = sorted(str(r.doc_id) for r in got if r.contaminated)
    assert flagged == ["1", "1", "2", "6", "7", "None"]
    assert all(r.item_ids == ([9] if r.doc_id == 6 else [7]) for r in got if r.contaminated)
    docs = table(spark, rows)
    clean = D.decontaminate(docs, bench)
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == [3, 4, 5]
    assert D.contamination(docs.limit(0), bench).count() == 0
    assert D.contamination(docs, bench.limit(0)).where(F.col("contaminated")).count() == 0


def test_fits_are_bounded_where_ids_repeat(spark, monkeypatch):
    rows = [(1, f"text number {k}", "en") for k in range(300)] + [(2, "other text", "fr")] * 300
    seen = []
    monkeypatch.setattr(Q, "fit_additive", lambda x, y: seen.append(len(x)) or Q.AdditiveModel())
    docs = table(spark, rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1), (2, 0)] * 50 + [(1, 0)], "doc_id long, quality int")
    Q.fit_quality_model(docs, labels, F.lit(True), sample_rows=10)
    assert seen == [10]
    counted = []
    monkeypatch.setattr(L, "_cluster", lambda x, k, f=L._cluster: counted.append(len(x)) or f(x, k))
    model = L.fit_language_model(docs, sample_per_lang=7)
    assert counted == [7, 1] and sorted(set(model.langs)) == ["en", "fr"]


def test_short_items_are_looked_for_whole(spark):
    bench = table(spark, [(1, "four words only here"), (2, "two words"), (3, "好"), (4, "..."), (5, "one two three four five six")], "item_id long, text string")
    rows = [(1, "so FOUR words, only here!"), (2, "words two words"), (3, "今天好吗"), (4, "four words only"), (5, "one two three four five"), (6, "words only here four")]
    for chars in (D.PASS_CHARS, 10):
        got = {r.doc_id: r.item_ids for r in D.contamination(table(spark, rows), bench, pass_chars=chars).collect()}
        assert got == {1: [1], 2: [2], 3: [3], 4: [], 5: [5], 6: []}
