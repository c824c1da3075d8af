"""URL filters against a plain version over dictionaries."""

import random
import re
from collections import Counter, defaultdict

import pytest

from helpers import table
from stardw.llm.queries import QUERIES, URL_RULES
from stardw.llm.url_filter import DAMPING, ROUNDS, THRESHOLD, UNIT, Rule, filter_urls

SCHEMA = "page_id long, url string, html string"


def parts(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    return ("".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")


def longest(host, path, rules):
    fit = [r for r in rules if host and (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: (len(r.host + r.path), r.host + r.path, r.verdict), default=None)


def judged(rows, rules, rounds=ROUNDS, threshold=THRESHOLD):
    """{(page_id, url): (host, path, rule, verdict)} by whole-number PageRank."""
    pages, allowed, blocked, links = Counter(), Counter(), Counter(), Counter()
    for _, url, html in rows:
        host, path = parts(url)
        if not host:
            continue
        rule = longest(host, path, rules)
        pages[host] += 1
        allowed[host] += rule is not None and rule.verdict == "allow"
        blocked[host] += rule is not None and rule.verdict == "block"
        for x in re.findall(r"""href="(?:https?:)?//([^/"]+)""", html or ""):
            if x.lower() != host:
                links[host, x.lower()] += 1

    def rank(seed, edges):
        total = Counter()
        for (a, _), n in edges.items():
            total[a] += n
        own = {h: n * UNIT // pages[h] * (100 - DAMPING) // 100 for h, n in seed.items()}
        mass = dict(own)
        for _ in range(rounds):
            new = defaultdict(int, own)
            for (a, b), n in edges.items():
                new[b] += mass.get(a, 0) * DAMPING * n // (total[a] * 100)
            mass = new
        return mass
    trust = rank(allowed, links)
    distrust = rank(blocked, {(b, a): n for (a, b), n in links.items()})
    bad = {h for h, m in distrust.items() if m - trust.get(h, 0) >= max(1, UNIT * (100 - DAMPING) // 100 * threshold // 100)}
    out = {}
    for i, url, _ in rows:
        host, path = parts(url)
        rule = longest(host, path, rules)
        out[i, url] = (host, path, rule and rule.host + rule.path, rule.verdict if rule else "block" if host in bad else "allow")
    return out


def got(spark, rows, rules, **kw):
    found = filter_urls(table(spark, rows, SCHEMA), rules, **kw).collect()
    assert len(found) == len(rows)
    return Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in found)


def want(rows, rules, **kw):
    by = judged(rows, rules, **kw)
    return Counter((i, *by[i, u]) for i, u, _ in rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_links_between_hosts(spark, seed):
    rng = random.Random(seed)
    hosts = [f"{a}.{b}" for a in ("x", "y.z", "WWW", "q") for b in ("bad", "good.com", "new.org", "else.io")]
    rows = [(i, f"http://{rng.choice(hosts)}/{rng.choice(['a', 'b', ''])}{rng.choice(['', '/c', '?q', '#f'])}",
             "".join(f'<a href="{rng.choice(["https:", "", "http:"])}//{rng.choice(hosts)}/k">t</a>' for _ in range(rng.randrange(6)))) for i in range(80)]
    rules = [Rule("bad", "/", "block"), Rule("good.com", "/", "allow"), Rule("y.z.bad", "/a", "allow"), Rule("new.org", "/a/c", "block")]
    assert got(spark, rows, rules) == want(rows, rules)
    verdicts = Counter(v for (_, _, _, r, v) in got(spark, rows, rules, threshold=20) if r is None)
    assert got(spark, rows, rules, threshold=20, rounds=7) == want(rows, rules, threshold=20, rounds=7)
    assert set(verdicts) == {"allow", "block"}  # both by links


def test_distrust_runs_against_links_and_trust_along(spark):
    rows = [(1, "http://spam.net/", ""), (2, "http://fan.com/", '<a HREF = \'http://spam.net/x\'>'), (3, "http://famed.com/", ""),
            (4, "http://best.org/", "<a href=//famed.com>"), (5, "http://lone.com/", "")]
    rules = [Rule("net", "/", "block"), Rule("best.org", "/", "allow")]
    out = {r.page_id: r.verdict for r in filter_urls(table(spark, rows, SCHEMA), rules).collect()}
    assert out == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow"}


def test_edges(spark):
    rows = [(1, None, None), (2, "", ""), (3, "no scheme.net/x", "<a href='http://'>"), (None, "http://A.Example.NET/en/1?x#y", "x" * 300000), (5, "http://net", None),
            (6, "http://net/", None), (7, "ftp://a.net:80/", None), (7, "ftp://a.net:80/", None), (8, "http://xexample.net/en/", None), (9, "http:///path", None),
            (10, "a://b://example.net/en/", None), (11, "HTTP://É.org/FR/", "href=" + " " * 100000), (12, "http://é.ORG/fr/\n?", None), (13, "http://net?/", None)]
    assert got(spark, rows, URL_RULES) == want(rows, URL_RULES)
    assert filter_urls(table(spark, rows, SCHEMA).limit(0), URL_RULES).count() == 0
    assert {r.verdict for r in filter_urls(table(spark, rows, SCHEMA), []).collect()} == {"allow"}
    both = [Rule("net", "/", "allow"), Rule("net", "/", "block")]
    assert {r.verdict for r in filter_urls(table(spark, rows[5:6], SCHEMA), both).collect()} == {"block"}


def test_query_against_plain_version(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    found = Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in QUERIES["op13_url_filter"](spark, sf).collect())
    assert found == want(rows, URL_RULES)
