"""Main text, WARC round trips and the index merge."""

import html as html_lib
import random
import re

from llm_fixtures import SF_SMALL, duck, odd_docs, small_docs  # noqa: F401

from adpulse.llm import style_tree, warc
from adpulse.llm.common import scratch
from adpulse.llm.queries import ORACLES, QUERIES


def test_warc_query_against_sql(spark, duck):
    got = sorted(map(str, (tuple(r) for r in QUERIES["op7_warc"](spark, SF_SMALL).collect())))
    assert got == sorted(map(str, duck.execute(ORACLES["op7_warc"]).fetchall()))


ODD_PAGES = [
    (1, "http://a.example/x", "<p>" + "same " * 400),
    (2, "http://a.example/y", "<p>" + "same " * 400),
    (9, "http://b.example/", "<p>" + "same " * 400),
    (3, None, None),
    (4, "http://a.example/\r\nWARC/1.1", ""),
    (5, "http://www.a.example/x", "body\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 30),
    (6, "http://c.example/é", "é\u0000\U0001f600\n\r\n" * 300),
    (7, "not a url", "short"),
    (8, "http://c.example/é", "short"),
    (8, "http://c.example/é", "short"),
    (None, "http://n.example/", "<p>" + "same " * 400),
]


def test_warc_round_trip_and_revisits(spark):
    import hashlib
    pages = spark.createDataFrame([(*p, "x") for p in ODD_PAGES], "page_id long, url string, html string, record_type string")
    rows = warc.archive_pages(pages).collect()
    assert len(rows) == len(ODD_PAGES) and all(r.digest_ok for r in rows)
    by_id = {r.page_id: r for r in rows}
    for page_id, url, html in ODD_PAGES:
        payload = (html or "").encode()
        assert by_id[page_id].payload_bytes == len(payload) and by_id[page_id].payload_digest == hashlib.sha1(payload).hexdigest()
    assert {i: (by_id[i].record_type, by_id[i].refers_to) for i in (1, 2, 9, None, 7, 8)} == {
        1: ("revisit", 9), 2: ("revisit", 9), 9: ("response", None), None: ("revisit", 9), 7: ("response", None),
        8: ("response", None)}
    assert by_id[3].url is None and "\r" not in by_id[4].url
    order = [warc._order(tuple(r)) for r in sorted(rows, key=lambda r: (r.part, r.position))]
    assert order == sorted(order)
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_warc_payloads_are_byte_exact(spark):
    path = scratch(spark, "warc-test")
    pages = spark.createDataFrame([p for p in ODD_PAGES if p[0] not in (1, 2, None)], "page_id long, url string, html string")
    warc.write_warc(pages, path)
    import zlib
    found = {}
    for f in spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).collect():
        for _, _, head, block in warc.records(zlib.decompress(bytes(f.content), wbits=47)):
            assert head["WARC-Type"] == "response"
            found[head["WARC-Record-ID"]] = block[block.index(b"\r\n\r\n") + 4:]
    assert found == {f"<urn:page:{i}>": (h or "").encode() for i, _, h in ODD_PAGES if i not in (1, 2, None)}


def test_loser_tree_merges_like_sort():
    rng = random.Random(8)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted(rng.randint(0, 50) for _ in range(rng.randint(0, 30))) for _ in range(k)]
        assert list(warc.LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)


def test_index_is_globally_ordered(spark):
    rows = warc.archive_pages(spark.read.parquet(f"{SF_SMALL}/pages.parquet")).collect()
    order = [warc._order(tuple(r)) for r in sorted(rows, key=lambda r: (r.part, r.position))]
    assert order == sorted(order) and len({r.archive for r in rows}) >= 1


def test_url_keys():
    assert warc.url_key("http://www.Example.com:80/a?b#c") == "com,example)/a?b"
    assert warc.url_key(None) == "" and warc.url_key("x") == "x)"


def article_of(page):
    """The text of the tables' pages: the blocks of their one article."""
    inside = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = (" ".join(html_lib.unescape(re.sub("<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", inside))
    return "\n".join(b for b in blocks if b)


def test_main_text_query(spark, duck):
    got = {r.page_id: r for r in QUERIES["op6_style_tree"](spark, SF_SMALL).collect()}
    rows = duck.execute("SELECT page_id, html FROM pages").fetchall()
    assert len(got) == len(rows)
    for page_id, page in rows:
        assert got[page_id].text == article_of(page) and got[page_id].n_chars == len(got[page_id].text)


RICH = """<html><head><title>T</title><script>var a="</p><article>no</article>";</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><a href=/>Home</a></nav>
<div class="cookie-notice">We use cookies</div><aside id="sidebar">Side</aside>
<main><article class="post"><header><h2>Title &amp; more</h2><p>By someone</p></header>
<p>First <b>bold</b>&nbsp;text<br>goes   on<p>Second &lt;p&gt; here <!-- hidden --> end
<ul><li>one<li>two</ul><div class="ad-box ads">Buy</div><form><label>Name</label><input></form>
<blockquote title="a>b">Quoted</blockquote><div class="share">Share this</div>
<pre>x  y
z</pre><footer>Tags</footer></article>
<section id="comments"><article class="comment"><p>Nice post</p></article></section></main>
<footer>Copyright</footer></body></html>"""


def test_rich_page():
    assert style_tree.main_text(RICH, {}).split("\n") == [
        "Title & more", "First bold text goes on", "Second <p> here end", "one", "two", "Quoted", "x y z"]


def test_page_without_article_uses_the_site_style_tree(spark):
    rng = random.Random(6)
    words = lambda n: " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(n))
    texts = {i: words(40) for i in range(30)}
    page = ("<html><body><div id='top'><span>Welcome to the site</span><a href='/a'>All pages</a></div>"
            "<div id='box'><p>{}</p></div><div id='low'>Made by us</div></body></html>")
    rows = [(i, f"http://tree.example/{i}", page.format(t)) for i, t in texts.items()] + [(900, "http://other.example/", page.format("alone"))]
    got = {r.page_id: r.main_text for r in style_tree.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {i: got[i] for i in texts} == texts
    assert got[900].split("\n") == ["Welcome to the siteAll pages", "alone", "Made by us"]  # one page teaches nothing


def test_copied_pages_keep_their_article(spark):
    rows = [(i, "http://copy.example/x", "<body><nav>menu</nav><article><h1>Same</h1><p>Same text</p></article></body>") for i in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.main_text for r in style_tree.extract_main_text(df).collect()} == {"Same\nSame text"}


def test_odd_pages(spark):
    deep = "<div>" * 20_000 + "deep" + "</div>" * 20_000
    rows = [(1, None, None), (2, "", ""), (3, "http://x.example", "no markup < 3 & more"), (4, "http://x.example", deep),
            (5, "http://x.example", "<p title='unclosed>text"), (6, "http://x.example", "<!-- never closed <p>x</p>"),
            (7, "http://x.example", "a" * 500_000), (8, "http://x.example", "<" * 50_000), (8, "http://x.example", '<a "' * 20_000),
            (None, "http://x.example", "<script>never closed")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, main_text string")
    out = style_tree.extract_main_text(df).collect()
    got = {r.page_id: r.main_text for r in out}
    assert len(out) == len(rows) and got[1] == "" and got[2] == "" and got[3] == "no markup < 3 & more"
    assert got[4] == "deep" and got[6] == "" and len(got[7]) == 500_000 and got[None] == ""
    assert style_tree.extract_main_text(df.limit(0)).count() == 0
