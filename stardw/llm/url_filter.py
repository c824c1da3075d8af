"""URL filters with link-graph propagation, in DataFrame operations only.

A rule allows or blocks a host with its subdomains, or a path on them; the
longest rule that fits a URL judges it.  What no rule judges is judged by its
host: hosts start with the share of their pages that rules allow (trust) or
block (distrust).  Trust runs along the links between hosts, distrust runs
against them (who links to blocked hosts is suspect), both as personalised
PageRank; a host whose distrust exceeds its trust by the threshold is blocked.

Masses are whole numbers, so results do not depend on the order of additions.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stardw.llm.common import LOWER, UPPER
from stardw.llm.components import stored


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str  # allow or block


#: The mass of a host whose pages are all blocked (or all allowed) by rules.
UNIT = 10**9
#: Percent of a host's mass that moves on in each round; rounds; rounds between two written tables.
DAMPING, ROUNDS, CUT = 85, 20, 5
#: Percent of UNIT (less damping) by which distrust must exceed trust.
THRESHOLD = 50
#: Rows of one host are dealt to this many parts.
SALTS = 16
#: The host of an absolute link (no backtracking over long spaces).
_LINK = r"""(?i)\bhref\s*+=\s*+["']?+\s*+(?:[a-z][a-z0-9+.-]*+:)?+//([^/?#"'\s<>]++)"""


def url_host(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end,
    A-Z lower-cased; empty for null and without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty likewise."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def _salted(rows: DataFrame) -> DataFrame:
    """Each row once for each salt: the small side of a join with dealt rows."""
    return rows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def apply_rules(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row: the longest fitting
    rule (as host and path in one; of equal ones ``block`` wins) and its
    verdict, both null where none fits.

    Rules are joined to the distinct hosts by the hosts' last labels, at most
    as many as a rule has, and to the pages by host, rows of a host being dealt
    to ``SALTS`` parts; a host carries the rules that fit it.
    """
    page = pages.select(F.col(id_col).alias("page_id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    if not rules:
        return page.select("*", *(F.lit(None).cast("string").alias(x) for x in ("rule", "verdict")))
    listed = pages.sparkSession.createDataFrame([(r.host, r.path, r.verdict) for r in rules], "suffix string, rule_path string, rule_verdict string")
    labels = max(r.host.count(".") + 1 for r in rules)
    hosts = page.select("host").where("host <> ''").distinct().withColumn("labels", F.split("host", r"\."))
    suffixes = hosts.select("host", F.explode_outer(F.expr(
        f"transform(sequence(1, least({labels}, size(labels))), k -> array_join(slice(labels, -k, k), '.'))")).alias("suffix"))
    fitting = suffixes.join(listed, "suffix").groupBy("host").agg(F.sort_array(F.collect_list(F.struct(
        F.length(F.concat("suffix", "rule_path")).alias("size"), F.concat("suffix", "rule_path").alias("rule"),
        "rule_verdict", "rule_path")), asc=False).alias("rules"))
    dealt = page.withColumn("salt", F.expr(f"CAST(pmod(xxhash64(page_id, path), {SALTS}) AS INT)"))
    first = dealt.join(_salted(fitting), ["host", "salt"], "left").withColumn(
        "first", F.expr("get(filter(rules, r -> startswith(path, r.rule_path)), 0)"))
    return first.select("page_id", "host", "path", "first.rule", F.col("first.rule_verdict").alias("verdict"))


def host_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``src, dst, n``: how many links the pages of a host hold to another host."""
    found = pages.select(url_host(F.col(url_col)).alias("src"), F.explode_outer(F.regexp_extract_all(F.col(html_col), F.lit(_LINK), F.lit(1))).alias("dst"))
    links = found.where("dst IS NOT NULL AND src <> ''").withColumn("dst", F.translate("dst", UPPER, LOWER)).where("src <> dst")
    return links.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def propagate(seeds: DataFrame, links: DataFrame, damping: int = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """``host, trust, distrust`` from seeds ``host, trust, distrust`` (0 to UNIT)
    and links ``src, dst, n``, for all hosts that mass reaches.

    A round gives each host its own part, ``(100 - damping)`` percent of its
    seed, and from each neighbour ``damping`` percent of that one's mass in
    proportion to the links between them; parts are rounded down.  What hosts
    without links would pass on is lost.
    """
    forth = links.join(links.groupBy("src").agg(F.sum("n").alias("total")), "src").select(
        F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), "n", "total")
    back = links.join(links.groupBy("dst").agg(F.sum("n").alias("total")), "dst").select(
        F.lit("distrust").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), "n", "total")
    edges = forth.unionByName(back).withColumn("salt", F.expr(f"CAST(pmod(xxhash64(to), {SALTS}) AS INT)"))
    own = seeds.select("host", F.expr(f"stack(2, 'trust', trust, 'distrust', distrust) AS (kind, seed)")).where("seed > 0")
    own = stored(own.select("kind", "host", F.expr(f"(seed * {100 - damping}) DIV 100").alias("mass")), "url-seeds")
    state = own
    if rounds and not links.isEmpty():  # without links every round gives the seeds' own parts again
        edges = stored(edges, "url-links")
        part = F.expr(f"(CAST(mass AS DECIMAL(38,0)) * {damping} * n) DIV (CAST(total AS DECIMAL(38,0)) * 100)")
        for k in range(1, rounds + 1):
            moved = _salted(state).join(edges, ["kind", "host", "salt"]).select("kind", F.col("to").alias("host"), part.alias("mass"))
            state = own.unionByName(moved).groupBy("kind", "host").agg(F.sum("mass").alias("mass")).where("mass > 0")
            if k % CUT == 0 or k == rounds:
                state = stored(state, "url-masses")
    return state.groupBy("host").agg(*(F.sum(F.when(F.col("kind") == x, F.col("mass")).otherwise(0)).alias(x) for x in ("trust", "distrust")))


def filter_urls(pages: DataFrame, rules: Sequence[Rule], threshold: int = THRESHOLD, damping: int = DAMPING, rounds: int = ROUNDS,
                id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, host, path, rule, verdict, by_host`` for every row of ``pages``.

    ``rule`` is the longest rule that fits the URL (its host is the URL's or a
    parent domain of it, its path starts the URL's; null if none fits) and
    ``verdict`` that rule's, else the one of the host: ``block`` if its
    distrust exceeds its trust by ``threshold`` percent of what a host with
    blocked pages only has of itself, else ``allow``.  ``by_host`` tells
    whether the host decided.

    A null URL, or one without ``://``, has an empty host and path, no rule,
    and is allowed.  Null, empty and very long html is searched whole for links
    (absolute ones, in ``href``); links within a host and to unknown hosts give
    no evidence of their own.  Repeated rows and ids keep their rows and count
    each; other columns are ignored; an empty table gives no rows; without
    rules all is allowed.
    """
    judged = stored(apply_rules(pages, rules, id_col, url_col), "url-rules")
    share = "CAST({0} * CAST(%d AS DECIMAL(38,0)) DIV pages AS BIGINT)" % UNIT
    seeds = (judged.where("host <> ''").groupBy("host")
             .agg(F.count(F.lit(1)).alias("pages"), F.count_if(F.col("verdict") == "allow").alias("allowed"), F.count_if(F.col("verdict") == "block").alias("blocked"))
             .select("host", F.expr(share.format("allowed")).alias("trust"), F.expr(share.format("blocked")).alias("distrust")))
    links = stored(host_links(pages, url_col, html_col), "url-host-links")
    least = UNIT * (100 - damping) // 100 * threshold // 100
    blocked = propagate(seeds, links, damping, rounds).where(F.col("distrust") - F.col("trust") >= max(1, least)).select("host", F.lit(True).alias("bad"))
    # rows of a host are dealt to parts; only rows without a rule ask for their host
    asked = judged.withColumn("asks", F.when(F.col("rule").isNull() & (F.col("host") != ""), F.col("host"))).withColumn(
        "salt", F.expr(f"CAST(pmod(xxhash64(page_id, path), {SALTS}) AS INT)"))
    answer = F.when(F.col("bad"), F.lit("block")).otherwise(F.lit("allow"))
    return (asked.join(_salted(blocked.withColumnRenamed("host", "asks")), ["asks", "salt"], "left")
            .select("page_id", "host", "path", "rule", F.coalesce("verdict", answer).alias("verdict"), F.col("rule").isNull().alias("by_host")))
