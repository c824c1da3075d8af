"""WARC round trip and HTML extraction."""

import gzip
import random

import pytest
from helpers import table
from pyspark.sql import functions as F

from stardw.llm import warc
from stardw.llm.html_text import Wrapper, extract_text, host_wrappers, main_text
from stardw.session import scratch_dir

PAGE = "page_id long, url string, html string"


def test_round_trip_in_ranges(spark):
    rnd = random.Random(2)
    text = lambda n: "".join(rnd.choices("abc<>é\n", k=n))
    same = text(500)
    rows = [(k, f"http://h/{k}\r\nX: y", same if k % 5 == 3 else text(rnd.randint(0, 3000))) for k in range(120)]
    rows += [(500, None, None), (501, "u", ""), (502, "u", text(400_000)), (None, "n", same), (502, "u", rows[7][2])]
    path = scratch_dir(spark, "warc-test")
    archives = warc.write_archives(table(spark, rows, PAGE).repartition(3), path)
    assert sum(r.records for r in archives.collect()) == len(rows)
    for split in (1 << 20, 700):
        got = warc.read_archives(spark, archives, path, split_bytes=split).collect()
        assert len(got) == len(rows)
        first = {}
        for i, _, h in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
            first.setdefault(h or "", i)
        want = sorted(((i, (h or "") if first[h or ""] == i else None, len((h or "").encode()), warc.digest((h or "").encode()),
                        None if first[h or ""] == i else first[h or ""]) for i, _, h in rows), key=str)
        assert sorted(((r.page_id, r.payload, r.payload_bytes, r.payload_digest, r.refers_to) for r in got), key=str) == want
        assert all((r.record_type == "revisit") == (r.refers_to is not None) for r in got)
    assert len({(r.archive, r.position) for r in got}) == len(rows)
    none = warc.write_archives(table(spark, rows, PAGE).limit(0), scratch_dir(spark, "warc-none"))
    assert warc.read_archives(spark, none, path).count() == 0


def test_splits_are_read_by_tasks_of_their_own(spark):
    rnd = random.Random(3)
    rows = [(k, f"http://h/{k}", "".join(chr(rnd.randrange(33, 1000)) for _ in range(2000))) for k in range(120)]
    path = scratch_dir(spark, "warc-test")
    archives = warc.write_archives(table(spark, rows, PAGE), path)
    splits = sum(-(-r.bytes // 8000) for r in archives.collect())
    read = warc.read_archives(spark, archives, path, split_bytes=8000)
    busy = read.select(F.spark_partition_id().alias("p")).distinct().count()
    assert splits > 20 and busy > splits // 3 and read.count() == len(rows)


def test_small_payloads_stay_responses(spark):
    path = scratch_dir(spark, "warc-small")
    archives = warc.write_archives(table(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], PAGE), path, revisit_from=3)
    got = {r.page_id: r.refers_to for r in warc.read_archives(spark, archives, path).collect()}
    assert got == {1: None, 2: None, 3: None, 4: 3}


def test_false_magic_is_no_member(tmp_path):
    import pyarrow.fs as fs
    inner = warc.member(warc.encode_record(9, "u", b"nested", None, "1970-01-01T00:00:00Z"))
    members = [warc.member(warc.encode_record(k, "u", p, None, "1970-01-01T00:00:00Z"), level=0)  # stored: payload bytes stand as they are
               for k, p in enumerate([b"x" * 50 + warc.MAGIC + b"y" * 50, b"a" + inner + b"b", b"plain"])]
    data = b"".join(members)
    assert inner in data
    path = tmp_path / "a.warc.gz"
    path.write_bytes(data)
    assert len(gzip.decompress(data)) > 0  # any gzip reader reads the archive
    with fs.LocalFileSystem().open_input_file(str(path)) as f:
        for step in (7, 64, 10_000):
            got = [x for lo in range(0, len(data), step) for x in warc.read_range(f, len(data), lo, min(len(data), lo + step))]
            assert [fields["page-id"] for _, fields, _ in got] == ["0", "1", "2"]


def page(body, title="T"):
    return f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var t='</p>';</script></head><body>{body}</body></html>"


@pytest.mark.parametrize(("html", "want"), [
    ("<nav><a>Menu</a></nav><article><h1>A  b</h1><p>x&nbsp;&amp; <b>y</b><br>z<p>w</article><footer>f</footer>", "A b\n\nx & y z\n\nw"),
    ("<header>top</header><main><p>one</p><aside>no</aside><form>no</form><div class='comments'><p>reader</p></div><p>two</main>", "one\n\ntwo"),
    ("<div class='cookie-notice'>c</div><p>text &lt;tag&gt; &#233;</p><div id=sidebar>s</div>", "text <tag> é"),
    ("<article><header><h1>Title</h1></header><ul><li>a<li>b</ul><table><tr><td>1<td>2</table></article>", "Title\n\na\n\nb\n\n1 2"),
    ("<article><p>cut &am", "cut &am"), ("", ""), ("plain text", "plain text"), ("<!-- open <p>x", ""),
])
def test_main_text_of_one_page(html, want):
    for text in (page(html), html):
        assert main_text(text, Wrapper.of_page(text)) == main_text(text, None) == want or "open" in html


@pytest.mark.parametrize(("attrs", "shown"), [
    ('style="overflow:hidden"', True), ('title="hidden gems"', True), ('data-role="banner"', True), ('data-hidden="false"', True), ('data-id="sidebar"', True),
    ('aria-hidden="false"', True), ('title=" class=sidebar id=menu"', True), ("data-x='role=banner' lang=en", True), ("hidden", False), ('HIDDEN=""', False),
    ('aria-hidden="true"', False), ('class=sidebar class=text', False), ("role = 'banner'", False), ('x=1/ id="menu"', False)])
def test_attributes_are_whole_names_and_values(attrs, shown):
    for html, want in ((f"<article><div {attrs}><p>Real text.</p></div><p>More.</p></article>", "Real text.\n\nMore."),
                       (f"<div {attrs}><p>Real text.</p></div><p>More.</p>", "Real text.\n\nMore.")):
        assert main_text(page(html), None) == (want if shown else "More.")


def test_wrapper_folds_repeats_and_finds_options_and_slots():
    pages = [page(f"<ul>{'<li><a>n</a></li>' * n}</ul><p>{t}</p>{extra}", t) for n, t, extra in ((2, "a", ""), (5, "b", "<i>o</i>"))]
    w = Wrapper.of_page(pages[0]).merge(Wrapper.of_page(pages[1]))
    assert w.pages == 2
    text = w.expression()
    assert "( <li> <a>" in text and "</a> </li> )+" in text and "( <i> #p=" in text and "</i> )?" in text
    assert "<p> #p </p>" in text  # a slot
    assert Wrapper.loads(w.dumps()).items == w.items


@pytest.mark.parametrize(("html", "want"), [
    ("<article><h2 id='login'>Login</h2><section id='related-work'><p>work</p></section></article>", "Login\n\nwork"),
    ("<article><div class='entry-header'><h1>Title</h1></div><table><tr class='header'><th>a</th></tr></table></article>", "Title\n\na"),
    ("<article><p>text</p><div class='related-posts'>r</div><div id='comments'>c</div><section class='social share'>s</section></article>", "text"),
    ("<div class='site-header'>top</div><p>text</p><div class='entry-footer'>f</div>", "text"),
])
def test_names_set_aside_boxes_but_no_article_text(html, want):
    assert main_text(page(html), None) == want


def test_template_text_goes_where_no_main_part_is_marked(spark):
    rows = [(k, "http://h.example/" + str(k), page(f"<div>Welcome to us</div><div>Story {k} here</div><div>All rights</div>")) for k in range(6)]
    rows += [(90, None, None), (91, "http://h.example/x", ""), (92, "bad", "<p>alone"), (0, *rows[0][1:]), (None, "http://o/", page("<p>lone page</p>"))]
    docs = table(spark, rows, PAGE)
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in extract_text(docs).collect()}
    for k in range(6):
        assert got[k, f"http://h.example/{k}"] == (f"Story {k} here", 12)
    assert got[90, None] == ("", 0) and got[91, "http://h.example/x"] == ("", 0) and got[92, "bad"][0] == "alone"
    assert got[None, "http://o/"][0] == "lone page"
    assert extract_text(docs).count() == len(rows) and extract_text(docs.limit(0)).count() == 0
    assert {r.host for r in host_wrappers(docs).collect()} == {"h.example", "o", ""}


def test_template_text_without_limits(spark):
    head = f"<ul>{''.join(f'<li>Link {j}</li>' for j in range(400))}</ul>" + "".join(f"<br class='{chr(97 + j % 26)}{j}'>" for j in range(3100))
    rows = [(k, f"http://long.example/{k}", page(f"{head}<p>Story {k}</p><section>Legal text</section>")) for k in range(3)]
    got = {r.page_id: r.text for r in extract_text(table(spark, rows, PAGE).repartition(3)).collect()}
    assert got == {k: f"Story {k}" for k in range(3)}


def test_copies_keep_their_text(spark):
    body = page("<div>Welcome</div><p>Only story</p>")
    rows = [(1, "http://c.example/a", body), (2, "https://c.example/a?utm_source=x", body), (3, "http://c.example/a", body.replace("var t", "var u")),
            *((k, f"http://d.example/{k % 2}", page(f"<div>Welcome</div><p>Story {k % 2}</p>")) for k in range(4, 8))]
    got = {r.page_id: r.text for r in extract_text(table(spark, rows, PAGE)).collect()}
    assert got == {1: "Welcome\n\nOnly story", 2: "Welcome\n\nOnly story", 3: "Welcome\n\nOnly story", 4: "Story 0", 5: "Story 1", 6: "Story 0", 7: "Story 1"}


def test_template_decides_beside_and_inside_marked_parts(spark):
    marked = [f"<p>Story {k} outside</p><article><p>Subscribe to us</p></article>" for k in range(4)]
    within = [f"<article><h1>Title {k}</h1><p>Text of {k}, and quite a bit more of it</p><div>Share this</div></article><div>Imprint</div>" for k in range(4)]
    main = [f"<div>Page {k} of 9</div><main><p>Main {k}</p></main>" for k in range(4)]
    copied = [f"<article><h1>Title {k}</h1><p>A long text that two pages hold alike</p><p>and its end</p></article>" for k in range(2)]
    rows = [(10 * n + k, f"http://h{n}.example/{k}", page(body)) for n, bodies in enumerate((marked, within, main, copied)) for k, body in enumerate(bodies)]
    got = {r.page_id: r.text for r in extract_text(table(spark, rows, PAGE)).collect()}
    for k in range(4):
        assert got[k] == f"Story {k} outside"
        assert got[10 + k] == f"Title {k}\n\nText of {k}, and quite a bit more of it"
        assert got[20 + k] == f"Main {k}"
    for k in range(2):  # most of the part is shared: copied, no template
        assert got[30 + k] == f"Title {k}\n\nA long text that two pages hold alike\n\nand its end"


def test_very_long_and_malformed_pages():
    assert main_text(page("<article>" + "<p>x</p>" * 30000), None).count("x") == 30000
    assert main_text('<p a="' + "<b " * 20000, None) is not None
    assert main_text("<p>" + "<div>" * 5000 + "deep", None) == "deep"


def test_pages_are_parsed_once_for_their_keys(spark, monkeypatch):
    """Counting and telling read stored keys; a template given from outside tells alike."""
    from stardw.llm import html_text
    names, real = [], html_text.stored
    monkeypatch.setattr(html_text, "stored", lambda df, name: (names.append(name), real(df, name))[1])
    page = "<body><div><p>{}</p><p>shared line</p></div></body>"
    rows = [(k, "http://a.example/x", page.format(f"own {k}")) for k in range(3)] + [(3, None, None), (4, "http://b.example/", "<p>only</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract_text(pages).collect()}
    assert got == {0: "own 0", 1: "own 1", 2: "own 2", 3: "", 4: "only"} and names.count("html-keys") == 1
    assert got == {r.page_id: r.text for r in html_text.extract_text(pages, html_text.host_template(pages)).collect()}


def test_aligned_streams_decide_what_is_template(spark):
    """A box that only some pages have shifts what follows it; aligned, its text
    stands at an optional item of its own, which all pages with the box share."""
    box = "<ul><li>Link {0}</li></ul><div>Sponsored links</div>"
    rows = [(k, f"http://a.example/{k}", page((box.format(k) if k % 2 else "") + f"<p>Note {k}</p><div>Story {k}</div>")) for k in range(6)]
    got = {r.page_id: r.text for r in extract_text(table(spark, rows, PAGE).repartition(3)).collect()}
    assert got == {k: f"Link {k}\n\n" * (k % 2) + f"Note {k}\n\nStory {k}" for k in range(6)}


def test_template_equals_plain_counting_at_the_items_of_the_expression(spark):
    """Every stream of a host goes in order through the host's expression, and
    what extract_text drops is what a plain count over the items says."""
    from stardw.llm import html_text as H
    rnd = random.Random(5)
    parts = ["<ul>{}</ul>", "<div>{}</div>", "<p>{}</p>", "<section><h2>Head</h2><p>{}</p></section>", "<hr><div>Legal</div>", "<span>More</span>"]
    rows = []
    for k in range(60):
        body = "".join(x.format("".join(f"<b>w{rnd.randrange(4)}</b>" for _ in range(rnd.randint(1, 3)))) for x in parts if rnd.random() < .8)
        rows.append((k, f"http://h{k % 4}.example/{k}", page(body)))
    pages = table(spark, rows, PAGE).repartition(5)
    hosts, want = {}, {}
    parsed = H._identified(pages, "page_id", "url", "html").select("uid", "host", "html").mapInArrow(H._parse, H._PARSED)
    items = {(r.host, r.shape): r["items"] for r in H._aligned_streams(parsed).collect()}
    for k, url, html in rows:
        tokens, texts = H.page_tokens(html)
        seq, rep, where = H.shape(tokens)
        at = items[url.split("/")[2], H._key(H.json.dumps([seq, rep], separators=(",", ":")).encode())]
        assert len(at) == len(seq) == len(set(at))
        hosts.setdefault(url.split("/")[2], []).append((k, html, [(n, at[where[p]], raw.strip()) for n, (p, raw) in enumerate(texts) if tokens[p] != "#x"]))
    for of in hosts.values():
        for k, html, texts in of:
            told = []
            for n, item, raw in texts:
                having = [x for _, _, x in of if any(i == item for _, i, _ in x)]
                if all((item, raw) in [y[1:] for y in x] for x in having) and len({tuple(y[2] for y in x) for x in having}) > 1:
                    told.append(n)
            want[k] = main_text(html, None, told)
    got = {r.page_id: r.text for r in extract_text(pages).collect()}
    assert got == want and any(got[k] != main_text(html) for k, _, html in rows)
    again = {r.page_id: r.text for r in extract_text(table(spark, rows[::-1], PAGE).repartition(2)).collect()}
    assert again == got
