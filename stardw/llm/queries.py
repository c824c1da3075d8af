"""Registered queries of the subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stardw.llm.bpe import bpe_decode, bpe_encode
from stardw.llm.collocations import collocations
from stardw.llm.common import crc32_of_id, table
from stardw.llm.decontamination import contamination
from stardw.llm.exact_dedup import exact_groups
from stardw.llm.html_text import extract_text
from stardw.llm.language_id import fit_language_model, identify_language
from stardw.llm.line_dedup import repeated_lines
from stardw.llm.ngram_jaccard import jaccard_components
from stardw.llm.periodic_runs import periodic_runs, run_digests
from stardw.llm.quality import fit_quality_model, score_quality
from stardw.llm.substring_dedup import substring_dedup
from stardw.llm.url_filter import Rule, filter_urls
from stardw.llm.warc import read_archives, write_archives
from stardw.session import scratch_dir


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "warc")
    archives = write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, archives, path, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_lines(table(spark, sf_dir, "documents"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents")).drop("kept")


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), percent=90, words=3)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = F.coalesce(crc32_of_id(F.col("doc_id")) % 4 == 2, F.lit(False))
    return score_quality(docs, fit_quality_model(docs, labels, ~held)).withColumn("held_out", held)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(crc32_of_id(F.col("doc_id")) % 5 == 0, F.lit(False))
    model = fit_language_model(docs, ~held)
    return identify_language(docs, model, reject=False).withColumn("held_out", held)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = bpe_decode(bpe_encode(table(spark, sf_dir, "documents")))
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(periodic_runs(_with_periods(table(spark, sf_dir, "documents"))))


#: The rules that op13 judges by.
URL_RULES = [Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"), Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow")]


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def _with_periods(docs: DataFrame) -> DataFrame:
    """Input of op12: where crc32(doc_id) is divisible by ten, the text from word
    a on repeats its words a..a+p-1 (a, p: from the crc and the word count)."""
    words = docs.select("doc_id", "text", crc32_of_id(F.col("doc_id")).alias("h"), F.when(
        crc32_of_id(F.col("doc_id")) % 10 == 0, F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)")).alias("words"))
    sized = words.withColumn("n", F.size("words")).withColumn("g", F.expr("h DIV 10"))
    placed = sized.withColumn("a", F.expr("IF(n > 0, g % n, NULL)")).withColumn("p", F.expr("1 + (n - a) DIV (3 + g % 8)"))
    repeated = F.expr("""array_join(concat(slice(words, 1, CAST(a AS INT)), slice(flatten(array_repeat(
        slice(words, CAST(a AS INT) + 1, CAST(p AS INT)), CAST(1 + (n - a) DIV p AS INT))), 1, CAST(n - a AS INT))), ' ')""")
    return placed.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_decontamination": op2_decontamination,
    "op3_bpe": op3_bpe,
    "op4_warc": op4_warc,
    "op5_line_dedup": op5_line_dedup,
    "op6_html_extraction": op6_html_extraction,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_ngram_jaccard": op8_ngram_jaccard,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_quality": op10_quality,
    "op11_collocations": op11_collocations,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_url_filter": op13_url_filter,
}

_NORM = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
         "'abcdefghijklmnopqrstuvwxyz')")

#: A word, as a pattern.
_WORD = r"'[^ \x09-\x0D]+'"

SQL: dict[str, str] = {
    "op9_exact_dedup": f"""
WITH n AS (SELECT doc_id, {_NORM} AS norm FROM documents),
g AS (SELECT doc_id, norm, max(doc_id) OVER (PARTITION BY norm) AS keep_id,
             count(*) OVER (PARTITION BY norm) AS group_size,
             row_number() OVER (PARTITION BY norm, doc_id) AS k FROM n)
SELECT doc_id, keep_id, group_size,
       doc_id IS NOT DISTINCT FROM keep_id AND k = 1 AS kept, sha256(norm) AS text_sha256 FROM g""",
    # base32 of the SHA-1: its bits in groups of five
    "op4_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes,
             array_to_string([lpad(bin(strpos('0123456789abcdef', c) - 1), 4, '0') FOR c IN string_split(sha1(html), '')], '') AS bits,
             min(page_id) OVER (PARTITION BY html) AS first_id FROM p)
SELECT page_id, payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + 16 * substr(bits, 5 * k + 1, 1)::INT + 8 * substr(bits, 5 * k + 2, 1)::INT + 4 * substr(bits, 5 * k + 3, 1)::INT
           + 2 * substr(bits, 5 * k + 4, 1)::INT + substr(bits, 5 * k + 5, 1)::INT, 1) FOR k IN range(0, 32)], '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM d""",
    # every window as text; the words that no window seen in a smaller id covers
    "op7_substring_dedup": f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM documents),
v AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS s
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d) x),
f AS (SELECT s, min(doc_id) AS first_id FROM v GROUP BY s),
c AS (SELECT DISTINCT doc_id, p FROM (
        SELECT v.doc_id, unnest(range(i, i + 50)) AS p FROM v JOIN f ON v.s = f.s WHERE f.first_id < v.doc_id) x),
k AS (SELECT x.doc_id, count(*) AS n, string_agg(x.word, ' ' ORDER BY x.p) AS kept
      FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) x
      ANTI JOIN c ON x.doc_id = c.doc_id AND x.p = c.p GROUP BY x.doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id""",
    # all pairs that share a shingle, then reachability
    "op8_ngram_jaccard": f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_NORM}, {_WORD}) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, sh FROM (
        SELECT doc_id, unnest(CASE WHEN len(w) >= 3 THEN [array_to_string(w[i:i + 2], ' ') FOR i IN range(1, len(w) - 1)]
                                   WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS sh FROM d) x),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 90 * (x.n + y.n - k)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(id, reached) AS (SELECT a, b FROM both_ways UNION SELECT r.id, l.b FROM r JOIN both_ways l ON r.reached = l.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(m.low, d.doc_id)) AS component_id
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN (SELECT id, min(reached) AS low FROM r GROUP BY id) m ON d.doc_id = m.id""",
    # all phrases of one to five words, counted as text
    "op11_collocations": rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_NORM}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^ \x09]+') AS w FROM p),
t AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
f AS (SELECT lang, phrase, k, count(*) AS a
      FROM (SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase FROM w, range(1, 6) s(k) WHERE len(w) >= k) x
      GROUP BY lang, phrase, k HAVING count(*) >= 100),
c AS (SELECT lang, phrase, k, a, string_split(phrase, ' ') AS v FROM f WHERE k > 1),
inside AS (SELECT lang, phrase, max(a) AS longer
           FROM (SELECT lang, a, unnest([array_to_string(v[i:i + m - 1], ' ') FOR i IN range(1, k - m + 2)]) AS phrase FROM c, range(2, 5) s(m) WHERE m < k) x
           GROUP BY lang, phrase),
cut AS (SELECT c.lang, c.phrase, c.a, c.v, c.k, j.j FROM c LEFT JOIN inside i ON c.lang = i.lang AND c.phrase = i.phrase, range(1, 5) j(j)
        WHERE j.j < c.k AND (i.longer IS NULL OR 100 * i.longer < 100 * c.a)),
s AS (SELECT cut.lang, cut.phrase, cut.a, j, x.a AS l, y.a AS r, t.n,
             CAST((1000::HUGEINT * cut.a * t.n) // (x.a::HUGEINT * y.a) AS BIGINT) AS score
      FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(v[1:j], ' ')
               JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(v[j + 1:], ' ') JOIN t ON t.lang = cut.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM b
QUALIFY rank <= 2000""",
    # twenty rounds; the row '*' hands every host its own part in each of them
    "op13_url_filter": r"""
WITH RECURSIVE rules(rh, rp, rv) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
u AS (SELECT row_number() OVER () AS k, page_id, html,
             translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
f AS (SELECT k, arg_max(struct_pack(rule := rh || rp, verdict := rv), struct_pack(a := length(rh || rp), b := rh || rp, c := rv)) AS r
      FROM u JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY k),
j AS (SELECT u.*, r.rule AS rule, r.verdict AS verdict FROM u LEFT JOIN f ON u.k = f.k),
seeds AS (SELECT host, count(*) AS pages, count(*) FILTER (verdict = 'allow') AS allowed, count(*) FILTER (verdict = 'block') AS blocked
          FROM j WHERE host <> '' GROUP BY host),
own AS (SELECT 'trust' AS kind, host, (allowed * 1000000000 // pages) * 15 // 100 AS mass FROM seeds WHERE allowed > 0
        UNION ALL SELECT 'distrust', host, (blocked * 1000000000 // pages) * 15 // 100 FROM seeds WHERE blocked > 0),
links AS (SELECT src, dst, count(*) AS n FROM (
            SELECT host AS src, translate(unnest(regexp_extract_all(html, '(?i)\bhref\s*=\s*["'']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"''\s<>]+)', 1)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst FROM u) x WHERE src <> '' AND src <> dst GROUP BY src, dst),
edges AS (SELECT 'trust' AS kind, src AS host, dst AS dest, n, sum(n) OVER (PARTITION BY src) AS total, NULL AS fixed FROM links
          UNION ALL SELECT 'distrust', dst, src, n, sum(n) OVER (PARTITION BY dst), NULL FROM links
          UNION ALL SELECT kind, '*', host, NULL, NULL, mass FROM own
          UNION ALL SELECT DISTINCT kind, '*', '*', NULL, NULL, 1 FROM own),
state(round, kind, host, mass) AS (
  SELECT 0, kind, host, CAST(mass AS HUGEINT) FROM own UNION ALL SELECT DISTINCT 0, kind, '*', CAST(1 AS HUGEINT) FROM own
  UNION ALL
  SELECT round, kind, host, CAST(sum(mass) AS HUGEINT) FROM (
    SELECT s.round + 1 AS round, s.kind AS kind, e.dest AS host, coalesce(CAST(e.fixed AS HUGEINT), s.mass * 85 * e.n // (CAST(e.total AS HUGEINT) * 100)) AS mass
    FROM state s JOIN edges e ON s.kind = e.kind AND s.host = e.host WHERE s.round < 20) x GROUP BY round, kind, host),
bad AS (SELECT host FROM state WHERE round = 20 AND host <> '*' GROUP BY host
        HAVING sum(CASE kind WHEN 'distrust' THEN mass ELSE -mass END) >= 75000000)
SELECT page_id, j.host, path, rule, coalesce(verdict, CASE WHEN bad.host IS NULL THEN 'allow' ELSE 'block' END) AS verdict, rule IS NULL AS by_host
FROM j LEFT JOIN bad ON j.host = bad.host""",
}
