"""Collocations against plain counting."""

import random
import re
from collections import Counter

import numpy as np
from helpers import LOWER, table
from hypothesis import given, settings
from hypothesis import strategies as st

from stardw.llm import collocations as C

SCHEMA = "doc_id long, text string, lang string"


def plain(rows, min_count, max_words, top, percent=100):
    """[(lang, rank, phrase, a, l, r, n, score)] from counts of all phrases."""
    f, total = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, max_words + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    out = []
    for (lang, w), a in f.items():
        if len(w) < 2 or a < min_count:
            continue
        holds = [n for (x, v), n in f.items() if x == lang and len(v) > len(w) and n >= min_count
                 and any(v[i:i + len(w)] == w for i in range(len(v) - len(w) + 1))]
        if any(100 * n >= percent * a for n in holds):
            continue
        n = total[lang]
        score, k = min((1000 * a * n // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
        out.append((lang, -score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]], n))
    out.sort()
    ranks = Counter()
    for lang, score, a, phrase, left, right, n in out:
        ranks[lang] += 1
        if ranks[lang] <= top:
            yield lang, ranks[lang], phrase.decode(), -a, left, right, n, -score


def texts(seed, n):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "of", "é", "x", "y,z", "ß.", "a", "b\tc", "d\n"]
    rows = [(i, " ".join(rng.choices(vocabulary, [9, 2, 5, 3, 3, 1, 1, 2, 1, 1], k=rng.randrange(40))), rng.choice(["en", "fr", None, "und"])) for i in range(n)]
    return rows + [(n, None, "en"), (n + 1, "", None), (n + 2, "of the é " * 50, "de"), (None, "of of of of of of of", "de"), (0, rows[0][1], rows[0][2])]


def check(spark, rows, **kw):
    got = sorted(tuple(r) for r in C.collocations(table(spark, rows, SCHEMA), **kw).collect())
    assert got == sorted(plain(rows, kw.get("min_count", 100), kw.get("max_words", 5), kw.get("top", 2000), kw.get("contained_percent", 100)))
    return got


def test_against_plain_counts(spark):
    assert len(check(spark, texts(1, 60), min_count=4)) > 20
    check(spark, texts(2, 60), min_count=7, max_words=4, top=5, contained_percent=80)


def test_hot_leads_and_full_buffers(spark, monkeypatch):
    monkeypatch.setattr(C, "HOT_SUFFIXES", 3)
    monkeypatch.setattr(C, "BUFFER", 5)
    check(spark, texts(3, 60), min_count=3)


def test_a_long_text_and_great_counts(spark):
    check(spark, [(1, "a b " * 20000, "en"), (2, "a b c, " * 100, "en"), (3, "x. y. " * 500, "en")], min_count=100)


def test_empty(spark):
    assert check(spark, [(1, None, None), (2, "", "en"), (3, "one two", "en")]) == []
    assert C.collocations(table(spark, texts(1, 2), SCHEMA).limit(0)).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(1, 3), min_size=1, max_size=4), st.integers(1, 5)), max_size=40), st.integers(1, 12))
def test_multikey_quicksort(rows, least):
    keys = np.zeros((len(rows), 4), np.int64)
    for r, (k, _) in enumerate(rows):
        keys[r, :len(k)] = k
    want = Counter()
    for k, n in rows:
        for d in range(1, len(k) + 1):
            want[tuple(k[:d])] += n
    got = {tuple(keys[p, :d].tolist()): c for p, d, c in C.multikey_quicksort(keys, np.array([n for _, n in rows], np.int64), least)}
    assert got == {k: c for k, c in want.items() if c >= least}
