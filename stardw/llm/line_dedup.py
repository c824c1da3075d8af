"""Line dedup by a segment-partition edit join, in DataFrame operations only.

Equal lines meet by a 128-bit hash.  Of the first occurrences, lines within
``tau`` edits of each other share one of ``tau + 1`` segments: each line is
indexed by its segments and probes, for each length up to ``tau`` shorter, the
substrings at the positions where such a segment can stand.  Letter counts,
which an edit changes by two at most, thin the matches inside the join; what is
left is verified by a banded edit distance whose band is one bit vector per
number of edits, advanced a character at a time.

A segment that many lines have (a date stamp, a byline) is not compared line by
line.  It is taken out of the lines that have it, and what is left of them, which
is still within ``tau`` edits for every pair that this segment stands for, is cut
into segments of its own, and so on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stardw.llm.components import stored

TAU, MIN_CHARS = 2, 20
#: Letters whose counts (modulo 8) are compared before a pair is verified.
LETTERS = "etaoinsrhldu"
#: A segment of more indexed lines is taken out and the rest cut again.
HOT_LINES = 256
#: Times that lines are cut; what is hot in the last one is compared as it is.
ROUNDS = 6
_BLANK = " \\t\\r\\u000b\\u000c"


def _listed(places: list[tuple[int, int, int]]) -> str:
    return "array(" + ", ".join(f"struct({i} AS i, {shorter} AS shorter, {shift} AS shift)" for i, shorter, shift in places) + ")"


def _span(chars: str, t: str, tau: int) -> tuple[str, str]:
    """Start and size, in a text of so many characters, of the place ``t``: where
    the segment of a line that is ``shorter`` stands, moved by the shift.

    Segments are numbered from 1; the first ones have the base size, the last
    ``length % (tau + 1)`` one character more."""
    n = f"({chars} - {t}.shorter)"
    base, plain = f"({n} DIV {tau + 1})", f"({tau + 1} - {n} % {tau + 1})"
    return (f"CAST(1 + ({t}.i - 1) * {base} + greatest(0, {t}.i - 1 - {plain}) + {t}.shift AS INT)",
            f"CAST({base} + IF({t}.i > {plain}, 1, 0) AS INT)")


def _keyed(work: DataFrame, places: list[tuple[int, int, int]], tau: int, least: int) -> DataFrame:
    """A row for each place ``k`` of the texts ``rest`` whose indexed text has
    ``least`` characters or more (and is ``shorter`` by as much as is known so
    far), with its ``key``: the hash of ``seed``, the segment's number, the indexed
    text's length and the substring there.  The places are dealt before the
    substrings are cut, so that one small compiled expression cuts them all."""
    start, size = _span("chars", "t", tau)
    return (work.withColumn("chars", F.length("rest")).select("*", F.posexplode(F.expr(_listed(places))).alias("k", "t"))
            .where(f"chars - t.shorter >= {least} AND (shorter IS NULL OR t.shorter = shorter)")
            .withColumn("key", F.expr(f"xxhash64(seed, t.i, chars - t.shorter, substring(rest, {start}, {size}))")))


def _probes(tau: int) -> list[tuple[int, int, int]]:
    """The places that a line probes, those of lines of its own length first."""
    return [(i, shorter, shift) for shorter in range(tau + 1) for i in range(1, tau + 2)
            for shift in range(max(1 - i, shorter - (tau + 1 - i)), min(i - 1, shorter + tau + 1 - i) + 1)]


def _letters(line: Column) -> Column:
    """Counts of LETTERS, modulo 8, three bits each."""
    out = F.lit(0).cast("long")
    for k, ch in enumerate(LETTERS):
        count = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(ch)))
        out = out.bitwiseOR(F.shiftleft((count % 8).cast("long"), 3 * k))
    return out


def _letter_difference(a: Column, b: Column) -> Column:
    """At most the sum of the counts' differences."""
    total = F.lit(0).cast("long")
    for k in range(len(LETTERS)):
        d = F.abs(F.shiftright(a, 3 * k).bitwiseAND(F.lit(7)) - F.shiftright(b, 3 * k).bitwiseAND(F.lit(7)))
        total = total + F.least(d, F.lit(8) - d)
    return total


def within_edits(a: str, b: str, tau: int) -> Column:
    """Whether the character arrays ``a`` and ``b`` are within ``tau`` edits.

    Bit ``k`` of vector ``e`` says that the first ``i`` characters of ``a`` and
    the first ``i + k - tau`` of ``b`` are within ``e`` edits.
    """
    width = 2 * tau + 1
    full = (1 << width) - 1
    same = " | ".join(f"CASE WHEN get({b}, i + {k - tau}) = get({a}, i) THEN {1 << k}L ELSE 0L END" for k in range(width))
    first = ", ".join(f"'r{e}', {sum(1 << k for k in range(tau, tau + e + 1))}L" for e in range(tau + 1))
    step = "(s.r0 & m)"
    steps = [step]
    for e in range(1, tau + 1):  # a match, a substitution, a deletion, an insertion
        step = f"(((s.r{e} & m) | s.r{e - 1} | shiftright(s.r{e - 1}, 1) | shiftleft({step}, 1)) & {full}L)"
        steps.append(step)
    after = ", ".join(f"'r{e}', {x}" for e, x in enumerate(steps))
    last = (f"aggregate(transform(sequence(0, size({a}) - 1), i -> {same}), named_struct({first}), (s, m) -> named_struct({after}), s -> s.r{tau})")
    return F.expr(f"abs(size({b}) - size({a})) <= {tau} AND size({a}) > 0 AND "
                  f"(shiftright({last}, CAST(size({b}) - size({a}) + {tau} AS INT)) & 1L) = 1L")


def _candidates(own: DataFrame, tau: int, min_chars: int) -> DataFrame:
    """Pairs ``a_doc, a_line, b_doc, b_line`` of the lines ``doc_id, line_no,
    line, letters`` that share a segment: all pairs within ``tau`` edits.

    Each round counts the lines indexed under a key.  Probes meet the lines of
    the usual keys, and one marker of a hot key: those lines go on without the
    segment, named by the places taken out so far (``path``).  No loss: of a
    pair's edits none falls in the segment at its place, so all fall in the rest.
    """
    places = _probes(tau)
    of_own_length = sum(shorter == 0 for _, shorter, _ in places)
    index_places = [(i, 0, 0) for i in range(1, tau + 2)]
    at = f"get({_listed(places)}, k)"
    start, size = _span("length(x)", at, tau)
    without = (f"aggregate(path, line, (x, k) -> concat(substring(x, 1, {start} - 1), substring(x, {start} + {size}, length(x))))")
    other = "(a_doc < b_doc OR (a_doc = b_doc AND a_line < b_line))"
    work = own.select("doc_id", "line_no", "letters", F.col("line").alias("rest"), F.lit(0).cast("long").alias("seed"),
                      F.lit(None).cast("int").alias("shorter"), F.lit(True).alias("indexed"), F.array().cast("array<int>").alias("path"))
    found = None
    for turn in range(ROUNDS):
        least = 0 if turn else min_chars
        known = ["indexed", "path"] if turn else []  # at first the same for all lines, so not sent
        index = stored(_keyed(work.where("indexed"), index_places, tau, least).select(  # read twice, cut once
            F.col("doc_id").alias("a_doc"), F.col("line_no").alias("a_line"), F.col("letters").alias("a_letters"), "key"), "lines-index")
        probe = _keyed(work, places, tau, least).select(
            F.col("doc_id").alias("b_doc"), F.col("line_no").alias("b_line"), F.col("letters").alias("b_letters"), "k", "key", *known)
        last = turn == ROUNDS - 1
        met_with = index.withColumn("hot", F.lit(False))
        if not last:
            hot = stored(index.groupBy("key").count().where(F.col("count") > HOT_LINES).select("key"), "lines-hot")
            mark = hot.select(*(F.lit(None).cast(index.schema[c].dataType).alias(c) for c in ("a_doc", "a_line", "a_letters")), "key", F.lit(True).alias("hot"))
            met_with = met_with.join(hot, "key", "left_anti").unionByName(mark)
        met = probe.join(met_with, "key").where(F.col("hot") | (
            F.expr(f"{other} OR (k >= {of_own_length} AND NOT (a_doc = b_doc AND a_line = b_line))")
            & (_letter_difference(F.col("a_letters"), F.col("b_letters")) <= 2 * tau)))
        met = stored(met.select("a_doc", "a_line", "b_doc", "b_line", "hot", *(
            F.when(F.col("hot"), F.col(c)).alias(c) for c in ("key", "k", *known))), "lines-met")
        pairs = met.where("NOT hot").select("a_doc", "a_line", "b_doc", "b_line")
        found = pairs if found is None else found.union(pairs)
        if last or hot.isEmpty():
            break
        if not known:
            met = met.withColumns({"indexed": F.lit(True), "path": F.array().cast("array<int>")})
        work = (met.where("hot").select(F.col("b_doc").alias("doc_id"), F.col("b_line").alias("line_no"), F.col("key").alias("seed"),
                                        F.expr(f"{at}.shorter AS shorter"),
                                        F.expr(f"indexed AND {at}.shift = 0 AND {at}.shorter = 0").alias("indexed"),
                                        F.concat("path", F.array("k")).alias("path"))
                .join(own.select("doc_id", "line_no", "line", "letters"), ["doc_id", "line_no"])
                .select("doc_id", "line_no", "letters", F.expr(without).alias("rest"), "seed", "shorter", "indexed", "path").distinct())
        work = stored(work, "lines-rest")
    return found.distinct()


def repeated_lines(docs: DataFrame, tau: int = TAU, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_lines, n_removed, removed`` for every row of ``docs``;
    ``removed`` lists the numbers (from 0) of the lines that go, in order.

    Lines are what ``\\n`` separates.  A line goes if it equals an earlier one,
    or if its first occurrence is within ``tau`` edits (insert, delete, replace
    a character) of a line that first occurs earlier and both have
    ``min_chars`` characters or more; earlier means a smaller (id, number).
    Lines of white space only stay.  A null text has no lines, an empty one a
    single empty line.  Rows with a null id keep all lines and repeat none.
    Rows that share an id are copies of one document: equal lines of one number
    in them are one place, and a number that goes is listed for each of them
    (should their texts differ, near lines are judged by any of them).  Other
    columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    known = rows.where("doc_id IS NOT NULL AND text IS NOT NULL").withColumn("th", F.xxhash64("text"))
    # the lines of a text that count, in order, as (number, line)
    solid = f"filter(transform(split(text, '\\n'), (x, i) -> struct(i AS line_no, x AS line)), s -> trim(LEADING '{_BLANK}' FROM s.line) <> '')"
    # explode_outer, here and below: explode would first filter by the array, computing it three times
    lines = stored(known.select("doc_id", "th", F.explode_outer(F.expr(solid)).alias("s")).where("s IS NOT NULL")
             .select("doc_id", "th", "s.line_no", F.xxhash64("s.line").alias("h1"), F.xxhash64(F.lit("line"), "s.line").alias("h2"),
                     (F.length("s.line") >= min_chars).alias("long")), "lines-cut")
    firsts = lines.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "line_no")).alias("first"))
    placed = stored(lines.join(firsts, ["h1", "h2"]).select(
        "doc_id", "th", "line_no", "long", (F.struct("doc_id", "line_no") == F.col("first")).alias("is_first")).distinct(), "lines-placed")

    # the numbers of a text's long first lines are laid beside the text, which is split once; a text's own lines only
    numbers = placed.where("is_first AND long").groupBy("doc_id", "th").agg(F.collect_list("line_no").alias("numbers"))
    beside = r"get(transform(array(split(text, '\n')), parts -> transform(numbers, i -> struct(i AS line_no, get(parts, i) AS line))), 0)"
    own = stored(known.join(numbers, ["doc_id", "th"]).select("doc_id", F.explode_outer(F.expr(beside)).alias("s")).where("s IS NOT NULL")
                 .select("doc_id", "s.line_no", "s.line").withColumn("letters", _letters(F.col("line"))), "lines-own")
    pairs = stored(_candidates(own, tau, min_chars), "lines-pairs")
    wanted = pairs.select(F.col("a_doc").alias("doc_id"), F.col("a_line").alias("line_no")).union(pairs.select("b_doc", "b_line")).distinct()
    texts = stored(own.join(wanted, ["doc_id", "line_no"], "left_semi").select("doc_id", "line_no", F.split("line", "").alias("chars")), "lines-texts")
    a = texts.select(F.col("doc_id").alias("a_doc"), F.col("line_no").alias("a_line"), F.col("chars").alias("a"))
    b = texts.select(F.col("doc_id").alias("b_doc"), F.col("line_no").alias("b_line"), F.col("chars").alias("b"))
    other = "(a_doc < b_doc OR (a_doc = b_doc AND a_line < b_line))"
    near = pairs.join(a, ["a_doc", "a_line"]).join(b, ["b_doc", "b_line"]).where(within_edits("a", "b", tau))
    later = near.select(F.expr(f"CASE WHEN {other} THEN struct(b_doc AS doc_id, b_line AS line_no) ELSE struct(a_doc AS doc_id, a_line AS line_no) END").alias("x"))
    dropped = placed.where("is_first").join(later.select("x.doc_id", "x.line_no").distinct(), ["doc_id", "line_no"], "left_semi")
    gone = (placed.where("NOT is_first").select("doc_id", "th", "line_no").union(dropped.select("doc_id", "th", "line_no"))  # no place twice
            .groupBy("doc_id", "th").agg(F.array_sort(F.collect_list("line_no")).alias("removed")))
    counted = rows.select("doc_id", F.xxhash64("text").alias("th"),
                          F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).alias("n_lines"))
    return counted.join(gone, ["doc_id", "th"], "left").select(
        "doc_id", "n_lines", F.coalesce("removed", F.array().cast("array<int>")).alias("removed")).select(
        "doc_id", "n_lines", F.size("removed").alias("n_removed"), "removed")


def without_lines(text: Column, removed: Column) -> Column:
    """``text`` without the lines of these numbers (null: null)."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains(F.coalesce(removed, F.array().cast("array<int>")), i)), "\n")
