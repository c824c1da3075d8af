"""Small tables and brute-force versions for the operators' tests."""

import re

#: Column names that operators use inside.
CLASHING = ["id", "h", "n", "c", "key", "route", "th", "shared", "cluster", "part", "lang_pred", "score", "kept_key", "sha", "line"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {k: k + 32 for k in range(65, 91)}


def table(spark, rows, schema="doc_id long, text string"):
    """``rows`` with further columns whose names clash with inner ones."""
    names = [x.split()[0] for x in schema.split(", ")]
    extra = [x for x in CLASHING if x not in names]
    return spark.createDataFrame([(*r, *[f"x{k}" for k in range(len(extra))]) for r in rows],
                                 schema + "".join(f", {x} string" for x in extra))


def words(text, lower=False):
    return WORD.findall((text or "").translate(LOWER) if lower else text or "")


def jaccard_components(rows, percent, k):
    """{id: (set size, component)} by comparing all pairs."""
    sets = {}
    for i, t in rows:
        w = words(t, True)
        sets[i] = frozenset(tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in sets}


def kept_words(rows, k):
    """{id: (words, kept words)}: words covered by a window that also starts in a smaller id go."""
    first = {}
    for i, t in sorted(rows):
        w = words(t)
        for j in range(len(w) - k + 1):
            first.setdefault(tuple(w[j:j + k]), i)
    out = {}
    for i, t in rows:
        w, covered = words(t), set()
        for j in range(len(w) - k + 1):
            if first[tuple(w[j:j + k])] < i:
                covered |= set(range(j, j + k))
        out[i] = (w, [x for j, x in enumerate(w) if j not in covered])
    return out


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def removed_lines(rows, tau, min_chars):
    """{id: numbers of the lines that go}, comparing all pairs of first occurrences."""
    first = {}
    for i, t in sorted(rows):
        for n, line in enumerate((t or "").split("\n")):
            if line.strip(" \t\r\x0b\x0c"):
                first.setdefault(line, (i, n))
    long = [x for x in first if len(x) >= min_chars]
    gone = {x for x in long for y in long if first[y] < first[x] and abs(len(x) - len(y)) <= tau and edits(x, y) <= tau}
    return {i: [n for n, line in enumerate((t or "").split("\n"))
                if line in first and (first[line] != (i, n) or line in gone)] for i, t in rows}
