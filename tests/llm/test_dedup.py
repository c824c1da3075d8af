"""Exact, near-duplicate, substring and line dedup against brute force."""

import hashlib
import random

import numpy as np
import pytest
from helpers import jaccard_components as brute_components
from helpers import kept_words, removed_lines, table
from pyspark.sql import functions as F

from stardw.llm import line_dedup, ngram_jaccard, substring_dedup
from stardw.llm.exact_dedup import exact_groups, without_copies

EDGE = [(901, None), (902, ""), (903, " \n\t "), (904, "one"), (905, "One"), (906, "word " * 30000)]


def variants(seed, groups=12, copies=7, size=90):
    """Groups of texts that differ in a few words each, with exact copies."""
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)] + ["the", "of", "and"] * 40
    rows, n = [], 0
    for _ in range(groups):
        base = rnd.choices(vocabulary, k=rnd.randint(4, size))
        for c in range(copies):
            w = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 5])):
                w[rnd.randrange(len(w))] = f"v{rnd.randrange(10**6)}"
            rows.append((n, ("  " if c % 2 else " ").join(w) + "\n" * (c % 3)))
            n += 1
    return rows


def test_exact_groups(spark):
    rows = [*EDGE, (1, "A b"), (2, "a B"), (3, "a b "), (3, "a b "), (None, "a b"), (None, "alone"), (4, "É"), (5, "é")]
    for bits in (128, 4):  # 4 bits: texts collide
        got = exact_groups(table(spark, rows), hash_bits=bits).collect()
        want = {}
        for i, t in rows:
            want.setdefault((t or "").translate({k: k + 32 for k in range(65, 91)}), []).append(i)
        assert len(got) == len(rows)
        by_sha = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in want.items()}
        for r in got:
            group = by_sha[r.text_sha256]
            assert r.group_size == len(group) and r.keep_id == max((x for x in group if x is not None), default=None)
        for sha, group in by_sha.items():
            kept = [r.doc_id for r in got if r.text_sha256 == sha and r.kept]
            assert kept == [max((x for x in group if x is not None), default=None)]
    assert exact_groups(table(spark, rows).limit(0)).count() == 0


def test_without_copies_keeps_columns_and_one_of_each(spark):
    docs = table(spark, [(1, "a"), (2, "A"), (3, "b"), (3, "b"), (None, "c")])
    got = without_copies(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in got.collect()) == [(0, "c"), (2, "A"), (3, "b")]


@pytest.mark.parametrize(("percent", "k"), [(90, 3), (80, 5), (50, 2)])
def test_jaccard_components(spark, percent, k):
    rows = variants(percent) + EDGE
    got = ngram_jaccard.jaccard_components(table(spark, rows + [rows[0]] + [(None, rows[1][1])]), percent, k).collect()
    want = brute_components(rows, percent, k)
    assert len(got) == len(rows) + 2
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert [r.component_id for r in got if r.doc_id is None] == [None]


def test_jaccard_of_long_runs_and_blocks(spark, monkeypatch):
    """Runs and blocks cut small: parts of a run and pairs of blocks must lose no link."""
    rows = variants(3, groups=2, copies=40, size=60)
    want = brute_components(rows, 80, 3)
    sets = {}
    for i, t in rows:
        w = t.split()
        sets[i] = {hash(tuple(w[j:j + 3])) & (2**63 - 1) for j in range(max(1, len(w) - 2))}
    import numpy as np
    ids = sorted(sets)
    a = [np.array(sorted(sets[i]), np.uint64) for i in ids]
    group = ngram_jaccard.link_groups(a, 80)
    assert {i: ids[g] for i, g in zip(ids, group, strict=True)} == {i: c for i, (_, c) in want.items()}
    half = ngram_jaccard.link_groups(a, 80, split=40)  # only pairs across the two halves
    assert all(ids[g] <= i for i, g in zip(ids, half, strict=True))
    monkeypatch.setattr(ngram_jaccard, "BLOCK_SETS", 7)
    got = ngram_jaccard.jaccard_components(table(spark, rows), 80, 3).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_long_texts_with_shared_lines_are_no_candidates(spark, monkeypatch):
    """Sets larger than a narrow sketch: unlike texts that share lines were one
    candidate group, compared pair by pair."""
    rnd = random.Random(5)
    lines = [" ".join(f"l{rnd.randrange(10**6)}" for _ in range(9)) for _ in range(30)]
    rows = []
    for i in range(24):
        w = [f"w{rnd.randrange(10**7)}" for _ in range(rnd.randint(1800, 2400))]
        for line in rnd.sample(lines, 15):
            w.insert(rnd.randrange(len(w)), line)
        rows.append((i, " ".join(w)))
    cut = rows[3][1].split()
    rows += [(90, " ".join(cut[:-60])), (91, " ".join(cut[200:]) + " x"), (92, rows[7][1] + " y"), (93, " ".join(["a b c d e f g", *cut[:700]]))]
    groups, real = [], ngram_jaccard.connected_components
    monkeypatch.setattr(ngram_jaccard, "connected_components", lambda edges: groups.append(real(edges)) or groups[-1])
    got = {r.doc_id: r.component_id for r in ngram_jaccard.jaccard_components(table(spark, rows), 80, 5).collect()}
    assert got == {i: x[1] for i, x in brute_components(rows, 80, 5).items()}
    assert got[92] == 7 and got[90] == got[91] == 3 and got[93] == 93
    assert sorted(r["count"] for r in groups[0].groupBy("component").count().collect()) == [2, 3]


@pytest.mark.parametrize("percent", [80, 50])
def test_sketches_fold_and_keep_what_links(percent):
    rnd = np.random.default_rng(percent)
    bands = ngram_jaccard.Bands(percent)
    for n in (5, 600, 717, 1500, 9000):
        a = rnd.integers(0, 1 << 63, n, np.uint64)
        b = np.concatenate([a[bands.most(n, n) // 2:], rnd.integers(0, 1 << 63, n // 4, np.uint64)])
        x, y = (ngram_jaccard.sketch(h, bands.sketch_words(len(h))).tobytes() for h in (a, b))
        w = min(len(x), len(y)) // 8
        both = ngram_jaccard.folded(np.array([x, y], object), w)
        assert [r.tobytes() for r in both] == [ngram_jaccard.sketch(h, w).tobytes() for h in (a, b)]
        assert np.bitwise_count(both[0] ^ both[1]).sum() <= len(np.setxor1d(a, b))
        other = ngram_jaccard.sketch(rnd.integers(0, 1 << 63, n * 100 // percent, np.uint64), w).view(np.uint64)
        assert n < 100 or np.bitwise_count(both[0] ^ other).sum() > bands.most(n, n * 100 // percent)


def test_runs_come_in_parts_led_by_their_first_row(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(ngram_jaccard, "RUN_ROWS", 3)
    keys = [1] * 2 + [2] * 8 + [3] + [4] * 2
    batches = [pa.record_batch([pa.array(keys[k:k + 5]), pa.array(range(k, min(k + 5, len(keys))))], ["key", "c"]) for k in range(0, len(keys), 5)]
    got = [(c[0][0], c[1].tolist(), part) for c, part in ngram_jaccard._runs(iter(batches), ["key", "c"])]
    two = [x for x in got if x[0] == 2]
    assert [x for x in got if x[0] != 2] == [(1, [0, 1], False), (4, [11, 12], False)]
    assert all(part and members[0] == 2 for _, members, part in two) and {m for x in two for m in x[1]} == set(range(2, 10))


def test_jaccard_empty_table(spark):
    assert ngram_jaccard.jaccard_components(table(spark, EDGE).limit(0)).count() == 0
    docs = table(spark, [(1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f")])
    kept = ngram_jaccard.without_near_copies(docs)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "None"]


def test_texts_of_one_id_are_judged_by_themselves(spark):
    t, u = " ".join(f"w{k}" for k in range(60)), " ".join(f"v{k}" for k in range(60))
    rows = [(1, t), (2, t + " x"), (2, u), (3, u + " y"), (2, u), (4, "lone"), (4, None), (4, "")]
    kept = ngram_jaccard.without_near_copies(table(spark, rows))
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == sorted((i, x or "") for i, x in rows if (i, x) not in [(2, t + " x"), (3, u + " y")])
    found = {(r.doc_id, r.component_id) for r in ngram_jaccard.jaccard_components(table(spark, rows)).collect()}
    assert found == {(1, 1), (2, 1), (3, 1), (4, 4)}


def passages(seed):
    rnd = random.Random(seed)
    text = lambda n: [f"p{rnd.randrange(3000)}" for _ in range(n)]
    shared = [text(60), text(51), text(50), text(49), text(200)]
    rows = []
    for i in range(60):
        w = text(rnd.randint(0, 80))
        for _ in range(rnd.randint(0, 2)):
            p = rnd.choice(shared)
            w += p[rnd.randint(0, 3):] + text(rnd.randint(0, 30))
        rows.append((i, rnd.choice([" ", "\n", "\t "]).join(w)))
    return rows + [(100, rows[5][1]), (101, "The " * 300), (102, "The " * 200), (103, "The " * 49)]


@pytest.mark.parametrize("hot", [substring_dedup.HOT_DOCS, 3])
def test_substring_dedup(spark, hot, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT_DOCS", hot)
    rows = passages(hot) + EDGE
    got = substring_dedup.substring_dedup(table(spark, rows + [(None, rows[0][1]), rows[1]])).collect()
    want = kept_words(rows, 50)
    assert len(got) == len(rows) + 2
    for r in got:
        if r.doc_id is None:
            assert r.n_removed == 0
            continue
        w, kept = want[r.doc_id]
        assert (r.n_words, r.n_removed) == (len(w), len(w) - len(kept)), r.doc_id
        assert r.kept_sha256 == hashlib.sha256(" ".join(kept).encode()).hexdigest()
        assert r.kept is None and r.n_removed == 0 or r.kept == " ".join(kept)
    assert sum(r.n_removed for r in got) > 1000
    assert substring_dedup.substring_dedup(table(spark, rows).limit(0)).count() == 0


def lines(seed):
    rnd = random.Random(seed)
    base = ["".join(rnd.choices("abcde é", k=rnd.randint(1, 45))) for _ in range(12)]
    rows = []
    for i in range(50):
        out = []
        for _ in range(rnd.randint(0, 6)):
            x = list(rnd.choice(base))
            for _ in range(rnd.choice([0, 0, 1, 2, 3])):
                k = rnd.randrange(len(x) + 1)
                x[k:k + rnd.randint(0, 1)] = rnd.choices("abcdeé", k=rnd.randint(0, 1))
                x = x or ["a"]
            out.append("".join(x))
        rows.append((i, "\n".join(out)))
    return rows


@pytest.mark.parametrize(("tau", "min_chars"), [(2, 20), (1, 6), (3, 8)])
def test_line_dedup(spark, tau, min_chars):
    rows = lines(tau) + [(901, None), (902, ""), (903, " \n\t "), (904, "x" * 70000 + "\n" + "x" * 69999)]
    got = line_dedup.repeated_lines(table(spark, rows + [(None, rows[0][1]), rows[1]]), tau, min_chars).collect()
    want = removed_lines([r for r in rows if r[0] < 904], tau, min_chars)
    assert len(got) == len(rows) + 2
    for r in got:
        if r.doc_id is None:
            assert r.removed == []
        elif r.doc_id == 904:
            assert r.removed == [1]
        else:
            text = dict(rows)[r.doc_id]
            assert (r.n_lines, r.removed, r.n_removed) == (0 if text is None else len(text.split("\n")), want[r.doc_id], len(want[r.doc_id])), r.doc_id
    assert line_dedup.repeated_lines(table(spark, rows).limit(0)).count() == 0


def stamped(seed, n=260):
    """Lines that share a start, an end or both, some within a few edits of
    another; stamps of one letter match at several shifts."""
    rnd = random.Random(seed)
    ends = ["".join(rnd.choices("abcdefgh", k=rnd.randint(12, 24))) for _ in range(n // 3)]
    out = []
    for i in range(n):
        x = list(rnd.choice(["Posted in: ", "Posted in: ", "aaaaaaaaaaaa", ""]) + rnd.choice(ends) + rnd.choice(["", " by the editor"]))
        for _ in range(rnd.choice([0, 1, 2, 3])):
            k = rnd.randrange(len(x) + 1)
            x[k:k + rnd.randint(0, 1)] = rnd.choices("abcdefgh:é", k=rnd.randint(0, 1))
        out.append((i, "".join(x)))
    return out


@pytest.mark.parametrize(("tau", "hot", "rounds"), [(2, 3, 6), (2, 0, 3), (1, 2, 4), (3, 3, 6)])
def test_line_dedup_of_hot_segments(spark, monkeypatch, tau, hot, rounds):
    """The same rows whatever is hot: here nearly every segment is."""
    monkeypatch.setattr(line_dedup, "HOT_LINES", hot)
    monkeypatch.setattr(line_dedup, "ROUNDS", rounds)
    rows = stamped(tau + hot)
    got = {r.doc_id: r.removed for r in line_dedup.repeated_lines(table(spark, rows), tau, 20).collect()}
    assert got == removed_lines(rows, tau, 20)
    assert 20 < sum(map(len, got.values())) < len(rows)


def test_line_dedup_compares_no_all_pairs_of_a_shared_start(spark):
    """What is compared follows the lines, not their square."""
    rnd = random.Random(7)
    rows = [(i, "Posted in: " + "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=22)) + ("" if i % 2 else "zz")) for i in range(3000)]
    rows += [(3000 + i, rows[i][1][:20] + "#" + rows[i][1][21:]) for i in range(50)]
    own = spark.createDataFrame(rows, "doc_id long, line string").select(
        "doc_id", F.lit(0).alias("line_no"), "line", line_dedup._letters(F.col("line")).alias("letters"))
    pairs = {(r.a_doc, r.b_doc) for r in line_dedup._candidates(own, 2, 20).collect()}
    assert {(i, 3000 + i) for i in range(50)} <= pairs
    assert len(pairs) < 10 * len(rows)


def test_within_edits_is_the_edit_distance(spark):
    from helpers import edits
    rnd = random.Random(1)
    pairs = [("".join(rnd.choices("abé", k=rnd.randint(1, 9))), "".join(rnd.choices("abé", k=rnd.randint(1, 9)))) for _ in range(300)]
    df = spark.createDataFrame(pairs, "x string, y string").select("x", "y", F.split("x", "").alias("a"), F.split("y", "").alias("b"))
    for tau in (1, 2, 3):
        for r in df.select("x", "y", line_dedup.within_edits("a", "b", tau).alias("near")).collect():
            assert r.near == (edits(r.x, r.y) <= tau), (r.x, r.y, tau)


def test_without_lines(spark):
    got = spark.createDataFrame([("a\nb\nc", [1]), ("a", None), (None, [0])], "t string, r array<int>").select(
        line_dedup.without_lines(F.col("t"), F.col("r")).alias("x")).collect()
    assert [r.x for r in got] == ["a\nc", "a", None]


def test_line_dedup_runs_no_python(spark):
    import contextlib
    import io
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        line_dedup.repeated_lines(table(spark, [(1, "a line that is long enough\nx")])).explain()
    assert not any(x in out.getvalue() for x in ("Python", "Arrow", "Pandas"))
