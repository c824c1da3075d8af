"""HTML extraction with wrappers inferred as union-free regular expressions.

A page is a stream of tags and text slots, runs of equal groups folded into one
repeated group.  The distinct streams of a host are aligned one after the other
into the host's expression (items that some pages lack are optional), and every
stream is then aligned with the finished expression: each text of a page stands
at an item of its host's expression.  Items and texts are counted in Spark over
all pages: a text on all pages that have its item, two different ones at least,
is template, other texts fill a slot.  Streams are merged in the order of their
digests, so the result does not depend on the order of pages.  Copies (pages
whose texts that are not set aside are equal) are one page here.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Collection, Iterator, Sequence
from difflib import SequenceMatcher
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stardw.llm.components import stored

LONGEST_GROUP = 24
SALTS = 16

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>"""
                    r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
#: An attribute's name and value; the attributes that mark what an element is.
_ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'<>]*))?""")
MARKS = {"class", "id", "role", "hidden", "aria-hidden"}
_MARKED = re.compile("class|id|role|hidden", re.I)
_MAIN = re.compile(r"<main[ >]|<[^>]* role=main[ >]")
_SPACE, _DIGITS = re.compile(r"\s+"), re.compile(r"[0-9]+")
#: Elements whose content is no markup.
RAW = {"script", "style", "textarea", "title", "xmp", "noembed", "noframes", "iframe"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
ASIDE = {"nav", "footer", "aside", "form", "script", "style", "noscript", "template", "svg", "head", "button", "select", "menu", "dialog",
         "iframe", "object", "textarea", "title", "xmp", "noembed", "noframes"}
ASIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar"}
ASIDE_NAMES = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alerts?|popup|modal|overlay|"
                         r"side-?bar|menu|nav|navbar|navigation|breadcrumbs?|header|masthead|footer|comments?|disqus|replies|respond|share|sharing|"
                         r"social|related|recommend\w*|newsletter|subscribe|signup|login|widget|pagination|pager|toolbar|skip-link)(?:$|[\s_-])", re.I)
#: What a name can set aside in the main part; names there that are its own; words that leave a name what it is.
BOXES = {"div", "section", "ul", "ol", "dl", "table"}
HEADERS = {"header", "masthead"}
BOX_WORDS = {"area", "articles", "bar", "block", "box", "button", "buttons", "container", "entry", "form", "icons", "inner", "item", "items", "links",
             "list", "post", "posts", "section", "site", "slot", "stories", "thread", "unit", "widgets", "wrap", "wrapper"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption",
         "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre",
         "section", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul", "caption"}
#: What an opening tag ends when it is still open.
ENDS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}}
ENDS |= {t: {"p"} for t in BLOCK if t not in ENDS}


def marks_of(attrs: str) -> dict[str, str]:
    """The attributes of a tag that are in MARKS, by whole name; of one that is
    repeated the first counts."""
    out: dict[str, str] = {}
    if _MARKED.search(attrs):
        for k, v in _ATTR.findall(attrs):
            if k.lower() in MARKS:
                out.setdefault(k.lower(), v.strip("\"'"))
    return out


def _named_aside(name: str, names: dict[str, str], main: bool) -> bool:
    """Whether class or id set an element aside; in the main part only those of
    boxes, and only names all of whose parts say so."""
    if not main:
        return bool(ASIDE_NAMES.search(names.get("class", "")) or ASIDE_NAMES.search(names.get("id", "")))
    if name not in BOXES:
        return False
    for one in (names.get("class", "") + " " + names.get("id", "")).split():
        parts = [x for x in re.split(r"[_-]+", one.lower()) if x]
        named = [x for x in parts if ASIDE_NAMES.search(x) and x not in HEADERS]
        if named and all(x in named or x in BOX_WORDS for x in parts):
            return True
    return False


def _digest(data: bytes) -> bytes:
    return blake2b(data, digest_size=8).digest()


def page_tokens(text: str) -> tuple[list[str], list[tuple[int, str]]]:
    """The tag stream of a page, ``#m``/``#p``/``#x`` for a text in the main
    part, elsewhere, or in what is set aside; and the texts as (place in the
    stream, raw text)."""
    tokens: list[str] = []
    texts: list[tuple[int, str]] = []
    stack: list[tuple[str, bool, bool]] = []  # element, set aside, main
    at, lower = 0, None
    out, main = False, False

    def say(raw: str) -> None:
        if raw and not raw.isspace():
            texts.append((len(tokens), raw))
            tokens.append("#x" if out else "#m" if main else "#p")
    for m in _TOKEN.finditer(text):
        if m.start() < at:  # inside a raw element
            continue
        say(text[at:m.start()])
        at = m.end()
        name = m.group(2) or m.group(5)
        if name is None:
            continue
        close, name, attrs = m.group(1) or m.group(4), name.lower(), m.group(3) or m.group(6) or ""
        if close:
            k = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if k is not None:
                del stack[k:]
                out, main = stack[-1][1:3] if stack else (False, False)
            tokens.append(f"</{name}>")
            continue
        ends = ENDS.get(name)
        if ends:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ends:
                    del stack[i:]
                    out, main = stack[-1][1:3] if stack else (False, False)
                    break
                if stack[i][0] in BLOCK and stack[i][0] != "p":
                    break
        names = marks_of(attrs) if attrs else {}
        label = " ".join(f"{k}={v.lower()}" for k, v in names.items())
        tokens.append(f"<{name} {label}>" if label else f"<{name}>")
        if name in VOID or attrs.endswith("/") and name not in RAW and name not in BLOCK:
            continue
        role = names.get("role", "").lower()
        aside = (name in ASIDE or name == "header" and not main or role in ASIDE_ROLES or "hidden" in names
                 or names.get("aria-hidden", "").lower() == "true"
                 or name not in ("html", "body", "article", "main") and _named_aside(name, names, main))
        out, main = out or aside, main or name in ("article", "main") or role in ("main", "article")
        stack.append((name, out, main))
        if name in RAW:
            lower = text.lower() if lower is None else lower
            if len(lower) != len(text):  # lower-casing changed a length: look in the text itself
                found = re.compile(f"</{name}", re.I).search(text, at)
                at = found.start() if found else len(text)
            else:
                at = lower.find(f"</{name}", at)
                at = len(text) if at < 0 else at
    say(text[at:])
    return tokens, texts


@lru_cache(maxsize=65536)
def _kind(token: str) -> str:
    """A token as it is aligned: elements of a page's own names (ids, numbers in
    labels, labels of the whole page) meet those of other pages."""
    name, _, label = token[1:-1].partition(" ")
    if token[0] != "<" or not label:
        return token
    if name in ("html", "body"):
        return f"<{name}>"
    label = " ".join(x for x in re.split(r" (?=(?:class|id|role|hidden|aria-hidden)=)", label) if not x.startswith("id="))
    return _DIGITS.sub("0", f"<{name} {label}>" if label else f"<{name}>")


def _repeats(seq: list[str], size: int) -> bool:
    """Whether any group of ``size`` tokens stands twice in a row."""
    ids: dict[str, int] = {}
    a = np.fromiter((ids.setdefault(t, len(ids)) for t in seq), np.int64, len(seq))
    same = np.concatenate(([0], np.cumsum(a[:-size] == a[size:])))
    return len(same) > size and bool((same[size:] - same[:-size] == size).any())


@lru_cache(maxsize=4096)
def folded(tokens: tuple[str, ...]) -> tuple[tuple[str, ...], tuple[bool, ...], tuple[int, ...]]:
    """The stream with runs of equal groups as one, whether each token is in
    such a group, and for each token of the input its place in the result."""
    seq, rep = list(tokens), [False] * len(tokens)
    place = [[k] for k in range(len(tokens))]
    for size in range(1, LONGEST_GROUP + 1):
        if not _repeats(seq, size):
            continue
        i = 0
        out, orep, oplace = [], [], []
        n = len(seq)
        while i < n:
            if i + 2 * size <= n and seq[i] == seq[i + size] and seq[i:i + size] == seq[i + size:i + 2 * size]:
                j = i + size
                group = [list(p) for p in place[i:i + size]]
                while seq[j:j + size] == seq[i:i + size]:
                    for k in range(size):
                        group[k] += place[j + k]
                    j += size
                out += seq[i:i + size]
                orep += [True] * size
                oplace += group
                i = j
            else:
                out.append(seq[i])
                orep.append(rep[i])
                oplace.append(place[i])
                i += 1
        seq, rep, place = out, orep, oplace
    where = [0] * len(tokens)
    for k, p in enumerate(place):
        for x in p:
            where[x] = k
    return tuple(seq), tuple(rep), tuple(where)


def shape(tokens: list[str]) -> tuple[tuple[str, ...], tuple[bool, ...], tuple[int, ...]]:
    """`folded` of a page's stream as it is aligned."""
    return folded(tuple(map(_kind, tokens)))


@lru_cache(maxsize=1024)
def _aligned(a: tuple[str, ...], b: tuple[str, ...]) -> tuple[tuple[int, int, int], ...]:
    """Blocks (place in a, place in b, length) of equal tokens; what both start
    and end with first, for most streams of a host differ little."""
    n, lo, hi = min(len(a), len(b)), 0, 0
    while lo < n and a[lo] == b[lo]:
        lo += 1
    while hi < n - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    middle = SequenceMatcher(None, a[lo:len(a) - hi], b[lo:len(b) - hi], autojunk=False).get_matching_blocks()[:-1]
    blocks = [(0, 0, lo), *((i + lo, j + lo, k) for i, j, k in middle), (len(a) - hi, len(b) - hi, hi)]
    return (*(x for x in blocks if x[2]), (len(a), len(b), 0))


def _hash(text: str) -> str:
    return _digest(_SPACE.sub(" ", text).strip().encode("utf-8", "replace")).hex()


class Wrapper:
    """Items [token, optional, repeated, texts, pages]: ``texts`` are the hashes
    of the texts that all ``pages`` with the item share there (none: a slot)."""

    def __init__(self, items: list, pages: int):
        self.items, self.pages = items, pages
        self.tokens = tuple(x[0] for x in items)

    @classmethod
    def of_page(cls, text: str) -> Wrapper:
        tokens, texts = page_tokens(text)
        seq, rep, where = shape(tokens)
        shared: dict[int, set[str]] = {}
        for k, raw in texts:
            shared.setdefault(where[k], set()).add(_hash(raw))
        items = [[t, False, r, sorted(shared.get(k, ())), 1] for k, (t, r) in enumerate(zip(seq, rep, strict=True))]
        return cls(items, 1)

    @classmethod
    def of_stream(cls, seq: Sequence[str], rep: Sequence[bool]) -> Wrapper:
        """Of the pages with one folded stream, whose texts are counted elsewhere."""
        return cls([[t, False, r, [], 1] for t, r in zip(seq, rep, strict=True)], 1)

    def places(self, seq: Sequence[str]) -> list[int | None]:
        """For each token of a folded stream the item it stands at."""
        at: list[int | None] = [None] * len(seq)
        for a, b, n in _aligned(self.tokens, tuple(seq)):
            at[b:b + n] = range(a, a + n)
        return at

    def merge(self, other: Wrapper) -> Wrapper:
        """The wrapper of the pages of both."""
        out, i, j = [], 0, 0
        for a, b, n in _aligned(self.tokens, other.tokens):
            gap = [[t, True, *x] for t, _, *x in self.items[i:a]]
            more = [[t, True, *x] for t, _, *x in other.items[j:b]]
            out += gap + more
            for (t, o, r, x, k), (_, o2, r2, y, k2) in zip(self.items[a:a + n], other.items[b:b + n], strict=True):
                out.append([t, o or o2, r or r2, x if x == y else sorted(set(x) & set(y)), k + k2])
            i, j = a + n, b + n
        return Wrapper(out, self.pages + other.pages)

    def expression(self) -> str:
        """The union-free regular expression, for reading."""
        out, open_ = [], (False, False)
        for t, o, r, x, _ in [*self.items, [None, False, False, [], 0]]:
            if (o, r) != open_:
                out += [")" + "+" * open_[1] + "?" * open_[0]] * any(open_) + ["("] * (o or r)
                open_ = (o, r)
            if t is not None:
                out.append(t + ("=" + "|".join(x) if x else ""))
        return " ".join(out)

    def dumps(self) -> str:
        return json.dumps([self.pages, self.items], separators=(",", ":"))

    @classmethod
    def loads(cls, text: str) -> Wrapper:
        pages, items = json.loads(text)
        return cls(items, pages)


def _key(*parts: bytes) -> int:
    return int.from_bytes(_digest(b"".join(parts)), "big", signed=True)


def main_text(page: str, wrapper: Wrapper | None = None, told: Collection[int] = ()) -> str:
    """The main text of a page: what is neither set aside nor template of its
    host (texts that are ``told`` by their number k on the page, or that the
    pages of ``wrapper`` share).  The marks check that: beside a ``main``
    element nothing is main text, beside an ``article`` what fills a slot of the
    host is (-1 - k is told); and if most of the marked part would go as
    template while nothing beside it stays, it is a copied text, and stays."""
    tokens, texts = page_tokens(page)
    template = {k for n, (k, _) in enumerate(texts) if n in told}
    if wrapper is not None and wrapper.pages > 1:
        seq, _, where = shape(tokens)
        item = wrapper.places(seq)
        for k, raw in texts:
            at = item[where[k]]
            _, _, _, shared, pages = wrapper.items[at] if at is not None else (None, None, None, (), 0)
            if pages > 1 and _hash(raw) in shared:
                template.add(k)
    marked = {k: len(raw.strip()) for k, raw in texts if tokens[k] == "#m"}
    slots = {k for n, (k, _) in enumerate(texts) if -1 - n in told}
    only = marked and any(_MAIN.match(t) for t in tokens)
    keep = {k for k, _ in texts if tokens[k] == "#p" and k not in template and (not marked or not only and k in slots)}
    lost = sum(n for k, n in marked.items() if k in template)
    keep |= {k for k in marked if k not in template or 2 * lost > sum(marked.values()) and not keep}
    blocks, line, at = [], [], 0
    for k, raw in [*texts, (len(tokens), "")]:
        for t in tokens[at:k]:
            name = t.strip("</>").split(" ", 1)[0]
            if name in BLOCK:
                blocks.append("".join(line))
                line = []
            elif name in ("br", "td", "th"):
                line.append(" ")
        at = k
        if k in keep:
            line.append(html.unescape(raw))
    blocks.append("".join(line))
    blocks = [_SPACE.sub(" ", b).strip() for b in blocks]
    return "\n\n".join(b for b in blocks if b)


def _infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got: dict[str, Wrapper] = {}
        for host, text in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            w = Wrapper.of_page(text or "")
            got[host] = got[host].merge(w) if host in got else w
        yield pa.RecordBatch.from_arrays([pa.array(list(got), pa.string()), pa.array([w.dumps() for w in got.values()], pa.string())], ["host", "wrapper"])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Wrappers of one host, which come in a row, as one."""
    host, held = None, None
    for batch in batches:
        hosts, out = [], []
        for h, text in zip(batch.column("host").to_pylist(), batch.column("wrapper").to_pylist(), strict=True):
            if held is not None and h == host:
                held = held.merge(Wrapper.loads(text))
                continue
            if held is not None:
                hosts.append(host)
                out.append(held.dumps())
            host, held = h, Wrapper.loads(text)
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(out, pa.string())], ["host", "wrapper"])
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([host], pa.string()), pa.array([held.dumps()], pa.string())], ["host", "wrapper"])


def _hosted(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    host = F.regexp_extract(F.lower(F.col(url_col)), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1)
    return pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
                        F.coalesce(host, F.lit("")).alias("host"))


def _merged(parts: DataFrame) -> DataFrame:
    """One wrapper per host of the ``host, wrapper`` of its parts."""
    kind = "host string, wrapper string"
    parts = parts.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)))
    some = parts.repartition("host", "salt").sortWithinPartitions("host", "salt", "wrapper").select("host", "wrapper").mapInArrow(_merge, kind)
    return some.repartition("host").sortWithinPartitions("host", "wrapper").mapInArrow(_merge, kind)


def host_wrappers(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``host, wrapper`` (`Wrapper.loads` reads it) of all pages of each host
    with the texts they share, for reading; pages whose url is null or names
    none share the host "".  `extract_text` merges distinct streams alone."""
    return _merged(_hosted(pages, id_col, url_col, html_col).select("host", "html").mapInArrow(_infer, "host string, wrapper string"))


_PARSED = ("uid long, host string, page long, shape long, stream string, place array<int>, text array<long>, "
           "own_place array<int>, own_text array<long>, own array<int>")


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each page a digest of its texts and of its stream; the places in the
    folded stream with the texts at them (null: the place itself); and what
    `main_text` asks of them (`told`).  The stream comes once per batch."""
    longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
    for batch in batches:
        for lo in range(0, batch.num_rows, 512):
            part, cols = batch.slice(lo, 512), [[] for _ in range(8)]
            seen = set()
            for host, page in zip(part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True):
                tokens, texts = page_tokens(page or "")
                seq, rep, where = shape(tokens)
                stream = json.dumps([seq, rep], separators=(",", ":"))
                digest = _key(stream.encode())
                at = [(n, where[k], int.from_bytes(bytes.fromhex(_hash(raw)), "big", signed=True), tokens[k])
                      for n, (k, raw) in enumerate(texts) if tokens[k] != "#x"]
                pairs = list(dict.fromkeys((p, t) for _, p, t, _ in at))
                places = list(dict.fromkeys(p for p, _ in pairs))
                asked = [(p, t, n) for n, p, t, _ in at]
                if "#m" in tokens:  # else no slot is asked for
                    asked += [(p, None, -1 - n) for n, p, _, token in at if token == "#p"]
                row = (_key(*(t.to_bytes(8, "big", signed=True) for _, _, t, _ in at)), digest, None if (host, digest) in seen else stream,
                       places + [p for p, _ in pairs], [None] * len(places) + [t for _, t in pairs],
                       [p for p, _, _ in asked], [t for _, t, _ in asked], [n for _, _, n in asked])
                seen.add((host, digest))
                for col, x in zip(cols, row, strict=True):
                    col.append(x)
            kinds = (pa.int64(), pa.int64(), pa.string(), ints, longs, ints, longs, ints)
            yield pa.RecordBatch.from_arrays([part.column("uid"), part.column("host"), *map(pa.array, cols, kinds)],
                                             [x.split()[0] for x in _PARSED.split(", ")])


def _of_streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [Wrapper.of_stream(*json.loads(x)).dumps() for x in batch.column("stream").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(made, pa.string())], ["host", "wrapper"])


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The item at each place of a host's streams, which follow its wrapper; a
    token that meets none is an item of its stream alone."""
    wrapper = None
    for batch in batches:
        hosts, shapes, items = [], [], []
        for host, text, key, stream in zip(*(batch.column(x).to_pylist() for x in ("host", "wrapper", "shape", "stream")), strict=True):
            if text is not None:
                wrapper = Wrapper.loads(text)
                continue
            of = host.encode("utf-8", "replace")
            hosts.append(host)
            shapes.append(key)
            items.append([_key(of, b"\n%d" % at) if at is not None else _key(of, b"\n%d %d" % (key, k))
                          for k, at in enumerate(wrapper.places(json.loads(stream)[0]))])
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(shapes, pa.int64()), pa.array(items, pa.list_(pa.int64()))],
                                         ["host", "shape", "items"])


def _identified(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    return _hosted(pages, id_col, url_col, html_col).withColumn("uid", F.xxhash64("host", "html"))


def _aligned_streams(parsed: DataFrame) -> DataFrame:
    """``host, shape, items`` of the distinct streams of every host."""
    streams = parsed.where(F.col("stream").isNotNull()).groupBy("host", "shape").agg(F.max("stream").alias("stream"))
    streams = stored(streams.withColumn("salt", F.pmod("shape", F.lit(SALTS))), "html-streams")
    wrappers = _merged(streams.select("host", "stream").mapInArrow(_of_streams, "host string, wrapper string"))
    none = F.lit(None)
    first = (wrappers.join(streams.select("host", "salt").distinct(), "host")
             .select("host", "salt", "wrapper", none.cast("long").alias("shape"), none.cast("string").alias("stream")))
    rows = first.unionByName(streams.withColumn("wrapper", none.cast("string"))).repartition("host", "salt")
    rows = rows.sortWithinPartitions("host", "salt", F.asc_nulls_first("shape"))
    return stored(rows.mapInArrow(_align, "host string, shape long, items array<long>"), "html-aligned")


def page_keys(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Of every page the keys that counting and telling need, from one parse:
    its items with the texts at them (null: the item itself), and the keys of
    which `main_text` asks, with what it is told of them."""
    parsed = stored(_identified(pages, id_col, url_col, html_col).select("uid", "host", "html").mapInArrow(_parse, _PARSED), "html-keys")

    def keys(place: str, text: str) -> Column:
        item = F.transform(F.col(place), lambda p: F.get("items", p))
        return F.zip_with(item, F.col(text), lambda i, t: F.struct(i.alias("item"), F.when(t.isNotNull(), F.xxhash64(i, t)).alias("text")))
    own = F.zip_with(keys("own_place", "own_text"), F.col("own"), lambda x, n: F.struct(F.coalesce(x["text"], x["item"]).alias("key"), n.alias("told")))
    return parsed.join(_aligned_streams(parsed), ["host", "shape"]).select("uid", "page", keys("place", "text").alias("at"), own.alias("own"))


def host_template(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``key``: of the items that two different pages have or more, and of the
    texts that all pages with such an item share (copies raise both counts
    alike).  Keys go by the expressions of these pages."""
    return _template(page_keys(pages, id_col, url_col, html_col))


def _template(keys: DataFrame) -> DataFrame:
    rows = keys.select("page", F.explode("at").alias("at")).select("at.item", "at.text", "page")
    counts = rows.groupBy("item", "text").agg(F.count(F.lit(1)).alias("n"), (F.min("page") < F.max("page")).alias("differ"))
    counts = stored(counts.where(F.col("text").isNull() | F.col("differ")), "html-items")
    items = counts.where(F.col("text").isNull()).select("item", F.col("n").alias("pages"), F.col("differ").alias("slot"))
    shared = counts.where(F.col("text").isNotNull()).join(items, "item").where(F.col("n") == F.col("pages"))
    return stored(shared.select(F.col("text").alias("key")).unionByName(items.where("slot").select(F.col("item").alias("key"))), "html-template")


def extract_text(pages: DataFrame, template: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``.

    Blocks are joined by an empty line, white space within one is a single
    space, character references are decoded.  Null and empty html, and pages
    without main text, give "".  Null or repeated ids and urls keep their
    rows; other columns are ignored; an empty table gives no rows.
    """
    rows = _identified(pages, id_col, url_col, html_col)
    kind = rows.schema["page_id"].dataType.simpleString()
    keys = page_keys(pages, id_col, url_col, html_col)
    if template is None:  # both read the keys of one parse
        template = _template(keys)
    told = keys.select("uid", F.explode("own").alias("own")).select("uid", "own.key", "own.told").join(template, "key", "left_semi")
    told = stored(told.groupBy("uid").agg(F.collect_set("told").alias("told")), "html-told")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                texts = [main_text(t, None, frozenset(k or ())) if t else "" for t, k in
                         zip(*(part.column(x).to_pylist() for x in ("html", "told")), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])
    return (rows.join(told, "uid", "left").select("page_id", "url", "html", "told")
            .mapInArrow(run, f"page_id {kind}, url string, text string").withColumn("n_chars", F.length("text").cast("long")))
