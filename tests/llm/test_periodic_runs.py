"""Periodic runs against brute force: the finder, the operator, the query."""

import hashlib
import zlib

import numpy as np
from helpers import table, words
from hypothesis import given, settings
from hypothesis import strategies as st

from stardw.llm.periodic_runs import find_runs, inverse_ntt, ntt, periodic_runs, squared_differences
from stardw.llm.periodic_runs import MODULUS, _roots
from stardw.llm.queries import QUERIES


def runs_of(w, least):
    """[(start, length, period)] by comparing all words at all distances."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)  # the smallest period comes first
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def kept(w, runs):
    return [x for i, x in enumerate(w) if not any(s + q <= i < s + n for s, n, q in runs)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(1, 4), st.integers(1, 20), st.integers(0, 40), st.integers(0, 10**6)), min_size=1, max_size=4),
       st.sampled_from([2, 3, 8, 9, 12]))
def test_runs(texts, least):
    docs = []
    for n, letters, period, a, seed in texts:
        w = np.random.default_rng(seed).integers(1, letters + 1, n).tolist()
        docs.append([w[i] if i < a else w[a + (i - a) % period] if a + (i - a) % period < n else w[i] for i in range(n)])
    first = np.cumsum([0, *map(len, docs)])
    s, e, q = find_runs(np.array(sum(docs, []), np.int64), first, least)
    got = [(int(x), int(y - x), int(z)) for x, y, z in zip(s, e, q, strict=True)]
    assert got == [(int(f) + x, n, p) for f, w in zip(first, docs, strict=False) for x, n, p in runs_of(w, least)]


def test_great_numbers_and_a_long_text():
    """Numbers whose squared differences pass the modulus are compared again."""
    w = np.random.default_rng(1).integers(1, MODULUS, 30000)
    w = w[np.where(np.arange(30000) < 77, np.arange(30000), 77 + (np.arange(30000) - 77) % 9001)]
    assert [x.tolist() for x in find_runs(w, np.array([0, 30000]), 12)] == [[77], [30000], [9001]]
    ones = find_runs(np.ones(50000, np.int64), np.array([0, 50000]), 12)
    assert [x.tolist() for x in ones] == [[0], [50000], [1]]


def test_transform():
    a = np.random.default_rng(2).integers(0, MODULUS, (3, 64)).astype(np.uint64)
    assert (inverse_ntt(ntt(a, _roots(64, False)), _roots(64, True)) == a).all()
    block, window = a[:, :5] % np.uint64(1000), a[:, 5:25] % np.uint64(1000)
    want = [[sum((int(x) - int(y)) ** 2 for x, y in zip(b, v[k:], strict=False)) for k in range(16)] for b, v in zip(block, window, strict=True)]
    assert squared_differences(block, window).tolist() == want


TEXTS = [(1, "a b c " * 9 + "d"), (2, None), (3, ""), (4, " \t\n"), (None, "x " * 30), (1, "a b c " * 9 + "d"), (5, "x " * 11), (6, "x " * 12),
         (7, "é é ü " * 6 + "é é"), (8, "p q " * 6 + "p p p p p p p p p p p p q"), (9, " ".join(str(i % 700) for i in range(3000)))]


def test_operator_on_edges(spark):
    got = sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(table(spark, TEXTS)).collect())
    want = []
    for i, t in TEXTS:
        w, runs = words(t), runs_of(words(t), 12)
        want.append((str(i), len(w), runs, " ".join(kept(w, runs))))
    assert got == sorted(want)
    assert periodic_runs(table(spark, TEXTS).limit(0)).count() == 0


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](spark, sf).collect()}
    assert set(got) == set(rows)
    planted = 0
    for i, t in rows.items():
        w, h = words(t), zlib.crc32(str(i).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if j < a else w[a + (j - a) % p] for j, x in enumerate(w)]
            planted += 1
        if n > 1500:  # the comparison of all distances takes long
            continue
        runs = runs_of(w, 12)
        top = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        r = got[i]
        assert (r.start, r.length, r.period, r.exponent_milli) == ((*top, 1000 * top[1] // top[2]) if top else (None,) * 4)
        assert r.n_runs == len(runs)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(kept(w, runs)).encode()).hexdigest()
    assert planted > 5
