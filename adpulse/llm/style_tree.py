"""Main text of web pages with a site style tree.

1. *Trees.* A page's markup becomes a tree of elements; an element's path is the
   chain of (tag, class, id) down to it, as a hash.
2. *Site style tree.* The trees of one host are merged path by path. A style
   node keeps, over the host's pages, the distribution of its presentations
   (sequences of child tags) and of its content (texts, link targets).
   Presentation importance is the entropy of the presentations with
   base m, the number of pages that have the node; content importance is 1
   minus the mean entropy of the contents (a content that all m pages show has entropy 1, one that a single page shows 0).
   Both come from two counted aggregations with map-side combining; a host
   with a third of all pages is counted by all tasks.
3. *Extraction.* On a page's own tree the importance of a node is composed
   bottom-up: (1 - g^l) * presentation + g^l * mean of its l children. Branches
   below ``KEEP`` are removed, and with them what markup itself declares not
   to be the article: menus, headers, footers, sidebars, notices, adverts,
   forms, comments, scripts and styles. Headings, paragraphs and text of a
   declared article (``article``, ``main``) are the article and never removed
   for being repeated elsewhere. If nothing would be left, importance is ignored.

Only nodes on at least ``MIN_PAGES`` and one in ``SHARE`` of a host's pages are
joined back (others have importance 1), one row per host: at most SHARE times
as many nodes as a page has on average.

Defined results: null or empty html has the empty text; a null or odd URL is
the host ''; unclosed and misnested tags close as browsers close them;
repeated pages are treated alike.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Stored, map_batches

GAMMA = 0.9
KEEP = 0.15
MIN_PAGES = 5
SHARE = 1000  # a style node is on at least one in SHARE of its host's pages

# Markup that is never main text (fixed values).
SKIP_TAGS = frozenset("script style noscript template head title nav aside footer form button select option textarea"
                      " input svg canvas iframe object embed applet dialog menu map audio video".split())
RAW_TAGS = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK_TAGS = frozenset("html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table"
                       " caption thead tbody tfoot tr td th figure figcaption address details summary header footer"
                       " nav aside form fieldset hr center".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TEXT_TAGS = HEADINGS | frozenset("p blockquote pre".split())
SKIP_WORDS = frozenset("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav"
                       " navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside widget footer masthead topbar"
                       " cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe"
                       " subscription signup comment comments commentlist disqus reply replies respond share sharing"
                       " social related recommended recommendations pagination pager toolbar login search copyright"
                       " legal disclaimer alert".split())
SKIP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar"
                       " toolbar".split())
MAIN_WORDS = frozenset("article content main post entry story articlebody maincontent".split())
# Start tags that close an open element of the named kinds (fixed values).
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th"),
          "tfoot": ("tbody", "tr", "td", "th")}
SCOPES = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",),
          "thead": ("table",), "tbody": ("table",), "tfoot": ("table",)}

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^<>"']++|"[^"<]*+"|'[^'<]*+')*+)>|<!--|<[!?/]""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/><]*)([^>]*)>")
_ATTR = re.compile(r"""([a-zA-Z_:][-a-zA-Z0-9_:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_SPLIT = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_HOST = re.compile(r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)")


class Node:
    __slots__ = ("tag", "words", "role", "sig", "hidden", "href", "children", "parent", "path")

    def __init__(self, tag: str, attrs: str, parent):
        self.tag, self.parent, self.children, self.path = tag, parent, [], 0
        self.words, self.role, self.sig, self.hidden, self.href = frozenset(), "", tag, False, None
        if attrs and not attrs.isspace():
            got = {}
            for m in _ATTR.finditer(attrs):
                got.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
            names = f"{got.get('class', '')} {got.get('id', '')}"
            if names != " ":
                self.words = frozenset(_SPLIT.split(_CAMEL.sub(" ", names).lower())) - {""}
                self.sig = f"{tag}.{'.'.join(sorted(got.get('class', '').split()))}#{got.get('id', '')}"
            self.role = got.get("role", "").lower()
            self.hidden = "hidden" in got or "display:none" in got.get("style", "").replace(" ", "").lower()
            self.href = got.get("href")


def parse(html: str) -> Node:
    """The element tree of a page; text stands in ``children`` as str."""
    root = Node("#root", "", None)
    node, pos, size = root, 0, len(html)
    lower = None
    while pos < size:
        lt = html.find("<", pos)
        if lt < 0:
            node.children.append(html[pos:])
            break
        m = _TAG.match(html, lt) or _LOOSE.match(html, lt)
        if m is None:  # a bare <
            node.children.append(html[pos:lt + 1])
            pos = lt + 1
            continue
        if lt > pos:
            node.children.append(html[pos:lt])
        if m[2] is None:
            if m[0] == "<!--":
                end = html.find("-->", lt + 4)
                pos = size if end < 0 else end + 3
            else:
                end = html.find(">", lt + 2)
                pos = size if end < 0 else end + 1
            continue
        pos, tag = m.end(), m[2].lower()
        if m[1]:
            up = node
            while up is not None and up.tag != tag:
                up = up.parent
            if up is not None and up.parent is not None:
                node = up.parent
            continue
        # implied ends
        if tag in BLOCK_TAGS:
            up = node
            while up.parent is not None and up.tag not in BLOCK_TAGS:
                up = up.parent
            if up.tag == "p" or up.tag in HEADINGS and tag in HEADINGS:
                node = up.parent
        if tag in CLOSES:
            up, stop, to = node, SCOPES.get(tag, ()), None
            while up.parent is not None and up.tag not in stop:
                if up.tag in CLOSES[tag]:
                    to = up
                up = up.parent
            if to is not None:
                node = to.parent
        child = Node(tag, m[3], node)
        node.children.append(child)
        if tag in RAW_TAGS:
            if lower is None:
                lower = html.lower() if len(html.lower()) == size else html
            end = lower.find("</" + tag, pos)
            if end < 0:
                break
            gt = html.find(">", end)
            pos = size if gt < 0 else gt + 1
        elif tag not in VOID_TAGS and not (m[3].endswith("/") and tag not in BLOCK_TAGS):
            node = child  # HTML ignores the slash of <p/>
    return root


def _elements(root: Node) -> Iterator[Node]:
    """All elements, parents before children; sets their paths."""
    from xxhash import xxh64_intdigest
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        for c in reversed(node.children):
            if type(c) is not str:
                c.path = xxh64_intdigest(f"{node.path}>{c.sig}") - (1 << 63)
                stack.append(c)


def _presentation(node: Node) -> str:
    """The sequence of child signatures, repeats merged."""
    out: list[str] = []
    for c in node.children:
        if type(c) is not str and (not out or out[-1] != c.sig):
            out.append(c.sig)
    return " ".join(out)


def _contents(node: Node) -> Iterator[str]:
    if node.href:
        yield "@" + node.href
    for c in node.children:
        if type(c) is str and not c.isspace():
            yield " ".join(c.split())


def host_of(url: str | None) -> str:
    m = _HOST.match(url or "")
    return m[1].lower() if m else ""


def features(html: str) -> set[tuple[int, int]]:
    """The (path, feature) pairs of a page: presentations even, contents odd."""
    from xxhash import xxh64_intdigest
    out = set()
    for n in _elements(parse(html)):
        if n.tag in RAW_TAGS:
            continue
        out.add((n.path, (xxh64_intdigest(_presentation(n)) >> 1 << 1) - (1 << 63)))
        for c in _contents(n):
            out.add((n.path, (xxh64_intdigest(c) | 1) - (1 << 63)))
    return out


def site_styles(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """(host, path, presentation, content): importance of the style nodes that
    at least MIN_PAGES pages of a host have."""
    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            seen: Counter = Counter()
            for url, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                host = host_of(url)
                seen.update((host, *f) for f in features(html or ""))
            if seen:
                h, p, f = zip(*seen)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h), pa.array(p, type=pa.int64()), pa.array(f, type=pa.int64()),
                     pa.array(list(seen.values()), type=pa.int64())], names=["host", "path", "feature", "c"])

    rows = pages.select(F.col(f"`{url_col}`").alias("u"), F.col(f"`{html_col}`").alias("h")).mapInArrow(
        count, "host string, path long, feature long, c long")
    nodes = rows.groupBy("host", "path", "feature").agg(F.sum("c").alias("c"))
    # a page has one presentation of a path at least: pages with the node <= their sum
    look, c = F.col("feature") % 2 == 0, F.col("c").cast("double")
    sums = nodes.groupBy("host", "path").agg(
        F.sum(F.when(look, c)).alias("m"), F.sum(F.when(look, c * F.log(c))).alias("clogc"),
        F.sum(F.when(~look, F.log(c))).alias("logc"), F.count(F.when(~look, 1)).alias("n"))
    sums = Stored(sums.where(F.col("m") >= MIN_PAGES), "style-sums").df
    pages_of = sums.where("path = 0").select("host", F.col("m").alias("pages"))  # the root is on every page
    sums = sums.join(pages_of, "host").where(F.col("m") * SHARE >= F.col("pages"))
    log_m = F.log("m")
    return sums.select(
        "host", "path", ((log_m - F.col("clogc") / F.col("m")) / log_m).alias("presentation"),
        F.when(F.col("n") > 0, 1 - F.coalesce("logc", F.lit(0.0)) / F.col("n") / log_m).alias("content"))


def _declared(node: Node, in_article: bool) -> bool:
    """What the markup itself declares not to be the article."""
    tag = node.tag
    if tag in SKIP_TAGS or node.hidden:
        return True
    if tag in ("html", "body", "main"):
        return False
    if node.role in SKIP_ROLES or node.words & SKIP_WORDS:
        return True
    return tag == "header" and not in_article


def _importance(order: list[Node], styles: dict[int, tuple[float, float | None]]) -> dict[int, float]:
    """Composite importance of every element, children before parents."""
    value: dict[int, float] = {}
    for n in reversed(order):
        kids = [value[id(c)] for c in n.children if type(c) is not str]
        own = styles.get(n.path)
        if own is None:
            value[id(n)] = 1.0
            continue
        parts = kids + ([own[1]] if own[1] is not None else [])
        weight = GAMMA ** len(parts)
        value[id(n)] = (1 - weight) * own[0] + weight * sum(parts) / len(parts) if parts else own[0]
    return value


def _blocks(top: list[Node], low: frozenset[int], article: bool) -> Iterator[str]:
    """Texts of the blocks below ``top``, in page order."""
    buffer: list[str] = []
    tops = {id(n) for n in top}

    def flush():
        text = " ".join(_html.unescape("".join(buffer)).split())
        buffer.clear()
        return text

    stack: list = [(n, False) for n in reversed(top)]
    while stack:
        node, done = stack.pop()
        if type(node) is str:
            buffer.append(node)
            continue
        block = node.tag in BLOCK_TAGS
        if done or node.tag == "br":
            if node.tag == "br":
                buffer.append(" ")
            elif block and (text := flush()):
                yield text
            continue
        if id(node) not in tops and (_declared(node, article) or id(node) in low):
            if block and (text := flush()):
                yield text
            continue
        if node.tag == "header":  # an article's header: its headings only
            heads = [c for c in _elements_below(node) if c.tag in HEADINGS]
            stack.append((node, True))
            stack.extend((h, False) for h in reversed(heads))
            if text := flush():
                yield text
            continue
        if block and (text := flush()):
            yield text
        stack.append((node, True))
        stack.extend((c, False) for c in reversed(node.children))
    if text := flush():
        yield text


def _elements_below(node: Node) -> list[Node]:
    out, stack = [], [c for c in reversed(node.children) if type(c) is not str]
    while stack:
        n = stack.pop()
        out.append(n)
        stack.extend(c for c in reversed(n.children) if type(c) is not str)
    return out


def main_text(html: str | None, styles: dict[int, tuple[float, float | None]]) -> str:
    """The main text of one page under its host's style nodes."""
    root = parse(html or "")
    order = list(_elements(root))
    importance = _importance(order, styles) if styles else {}
    declared: set[int] = set()
    regions: dict[str, list[Node]] = {"article": [], "main": [], "named": []}
    inside: set[int] = set()
    for n in order:
        up = id(n.parent) if n.parent is not None else None
        if up in declared or n.parent is not None and _declared(n, n.tag == "article" or up in inside):
            declared.add(id(n))
            continue
        if up in inside:
            inside.add(id(n))
        kind = ("article" if n.tag == "article" else "main" if n.tag == "main" or n.role == "main" else
                "named" if n.tag in ("div", "section", "td") and n.words & MAIN_WORDS else None)
        if kind:
            if kind == "article" and up not in inside:
                inside.add(id(n))
            regions[kind].append(n)
    top, article = [root], False
    for kind in ("article", "main", "named"):
        if regions[kind]:
            chosen = {id(n) for n in regions[kind]}
            top = []
            for n in regions[kind]:  # outermost ones only
                up = n.parent
                while up is not None and id(up) not in chosen:
                    up = up.parent
                if up is None:
                    top.append(n)
            article = kind != "named"
            break
    low = frozenset()
    if importance:
        safe = {id(n) for n in top} if article else set()
        removed = set()
        for n in order:
            if importance[id(n)] >= KEEP or id(n) in safe or n.tag in ("#root", "html", "body"):
                continue
            if article and n.tag in TEXT_TAGS:
                continue
            if n.tag in BLOCK_TAGS:
                removed.add(id(n))
        low = frozenset(removed)
    text = "\n".join(_blocks(top, low, article))
    return text if text or not low else "\n".join(_blocks(top, frozenset(), article))


def extract_main_text(pages: DataFrame, url_col: str = "url", html_col: str = "html",
                      keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns plus ``main_text``. The join with the host's style
    nodes is broadcast only if Spark measures them small; else both sides
    are shuffled by host and a hot host's pages are split."""
    styles = Stored(site_styles(pages, url_col, html_col), "style-nodes").df
    per_host = Stored(styles.groupBy("host").agg(
        F.collect_list(F.struct("path", "presentation", "content")).alias("nodes")), "host-styles").df
    cols = list(dict.fromkeys((*keep, html_col)))
    host = F.coalesce(F.lower(F.regexp_extract(F.col(f"`{url_col}`"), _HOST.pattern, 1)), F.lit(""))
    src = pages.select(F.struct(*[f"`{c}`" for c in cols]).alias("page"), host.alias("__host"))
    joined = src.join(per_host.select(F.col("host").alias("__h"), "nodes"), F.col("__host") == F.col("__h"), "left")
    flat = joined.select(*[F.col(f"page.`{c}`").alias(c) for c in cols], F.col("__host"), F.col("nodes").alias("__nodes"))

    def start():
        cache: dict[str, dict] = {}

        def run(texts, hosts, nodes):
            for t, h, n in zip(texts, hosts, nodes):
                if h not in cache:
                    if len(cache) >= 64:
                        cache.clear()
                    cache[h] = {x["path"]: (x["presentation"], x["content"]) for x in n or ()}
                yield (main_text(t, cache[h]),)
        return run

    return map_batches(flat, [html_col, "__host", "__nodes"], list(keep),
                       T.StructType([T.StructField("main_text", T.StringType())]), start)
