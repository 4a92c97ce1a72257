"""Main text of web pages: subtrees of the site's template are found by counting, and deleted.

1. Each page is parsed into elements. Every block element with text gets a hash of its subtree (tags,
   classes, text).
2. Spark counts, for each host and subtree hash, the pages of different content that hold it. A subtree on
   ``MIN_PAGES`` or more such pages of its host and on ``SHARE`` or more of them belongs to the template. One
   that is flow of text (a paragraph, a heading, a list item) outside of articles must be on ``FLOW_SHARE`` of
   them, as sites do republish passages; within an article flow is never counted.
3. Template subtrees go first, whatever their names. What does not recur goes by what HTML says of it: tags
   and roles that are no article (``nav``, ``footer``, ``aside``, ``form``, ...), hidden elements, and boxes whose
   class or id is made up of words for adverts, notices or comments alone (``cookie-banner``, ``ad``,
   ``comment-list``; not ``has-comments``). Names never touch flow of text, the page or an article.
4. What is left inside ``article`` (else ``main``, else the body) is the text; several articles are joined in
   page order, and a ``main`` with text beside its articles is read whole.

Copies of a page count once (by the digest of their html), so a page that is posted many times keeps its text.
Only hashes are shuffled for the counts: a common subtree is first made distinct per page content
and counted with partial aggregates, so a host with a third of all pages is no hot key. Template hashes are
sent to the tasks that cut the pages where they are few (counted before), and no page is shuffled; else they
are joined by keys and a salt, so neither a menu nor a page that is posted a million times is one key.

Defined results: null or empty html gives an empty text; a null url is a host of its own; repeated
rows each give their row; other columns, whatever their names, are ignored; pages without markup are one
block; a very long page is parsed whole, in linear time; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldmark.llm.common import BROADCAST_ROWS, column_or_null, map_arrow, written
from foldmark.llm.common import counted as counted_rows
from foldmark.llm.words import mix

MIN_PAGES, SHARE, FLOW_SHARE = 5, 0.01, 0.5
SALTS = 16

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.DOTALL)
_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.DOTALL)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

# fixed values: element names of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark math nobr q rp rt ruby s samp small span strike strong sub sup svg time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
SIBLING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
NO_TEXT = frozenset(
    "head title script style noscript template nav aside footer form button select option textarea input iframe object embed canvas audio video svg math dialog menu search noframes noembed xmp".split()
)
FLOW = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th tr figcaption caption".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar status note".split())
# fixed values: words of a class or id that name what is not the article, and words that only say where or what a box is
SHY = frozenset(
    """ad ads adv advert adverts advertisement advertisements advertising adsbygoogle sponsor sponsored sponsors promo promos banner banners cookie cookies consent gdpr notice notices
    notification notifications alert alerts popup popover modal overlay nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager sidebar sidebars aside footer foot masthead
    comment comments commentlist respond discussion disqus newsletter subscribe subscription signup login widget widgets toolbar topbar topnav outbrain taboola""".split()
)
PLAIN = frozenset(
    """area article bar block body bottom box column container content count entry form global group header holder icon in inner inline item items left line link links list main message outer page panel
    post posts primary reader readers region right row secondary section sheet site skip slot small stories story text thread title top unit user users view wrap wrapper wide""".split()
)
#: Of these, what names the words of readers; in such boxes articles are no articles.
REPLIES = frozenset("comment comments commentlist respond discussion disqus reply replies".split())
# fixed values: names that speak against a box only if its text is mostly links
LINKED = frozenset("related recommended recommendations share sharing social follow tags more-posts read-more".split())

_NEVER = INLINE | RAW | {"#root", "html", "body", "head", "li"}


class Node:
    __slots__ = ("tag", "parent", "attrs", "parts", "hash", "has_text", "article", "title", "size", "linked")

    def __init__(self, tag: str, parent: int, attrs: str):
        self.tag, self.parent, self.attrs = tag, parent, attrs
        self.parts: list[str | int] = []  # texts and numbers of child elements, in order
        self.hash, self.has_text = 0, False
        self.article = self.title = False  # whether an article or main element, or an h1, lies within
        self.size = self.linked = 0  # characters of text, and those within links


def parse(html: str) -> list[Node]:
    """Elements in document order, the root first; unclosed and stray tags are mended as browsers do.

    In linear time: a tag is looked for only while a ``>`` is left, and what is open is known by its tag and by the
    nearest element that is not inline, so no tag walks down the stack but over what it closes.
    """
    nodes = [Node("#root", -1, "")]
    stack, solid = [0], [0]  # open elements, and for each depth that of the nearest one that is not inline
    where: dict[str, list[int]] = defaultdict(list)  # depths of the open elements of a tag
    at, end, last = 0, len(html), html.rfind(">")

    def close(depth: int) -> None:
        while len(stack) > depth:
            where[nodes[stack.pop()].tag].pop()
            solid.pop()

    def nearest(tags: set[str]) -> int:
        return max((where[t][-1] for t in tags if where[t]), default=0)

    while at < end:
        found = (_TOKEN if at <= last else _COMMENT).search(html, at)
        text = html[at : found.start() if found else end]
        if text:
            nodes[stack[-1]].parts.append(unescape(text) if "&" in text else text)
        if not found:
            break
        at = found.end()
        tag = found.group(2) or found.group(5) if found.re is _TOKEN else None
        if not tag:
            continue
        tag = tag.lower()
        if found.group(1) or found.group(4):
            if where[tag] and (tag not in INLINE or solid[-1] < where[tag][-1]):
                close(where[tag][-1])
            continue
        if tag in CLOSES_P and nodes[stack[solid[-1]]].tag == "p":
            close(solid[-1])
        if tag in SIBLING and (depth := nearest(SIBLING[tag])) > nearest(SCOPE[tag]):
            close(depth)
        attrs = found.group(3) if found.group(2) else found.group(6)
        nodes.append(Node(tag, stack[-1], attrs or ""))
        nodes[stack[-1]].parts.append(len(nodes) - 1)
        if tag in VOID or (attrs or "").endswith("/") and tag not in INLINE and tag not in CLOSES_P:
            continue
        if tag in RAW:
            over = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.IGNORECASE).search(html, at)
            raw = html[at : over.start() if over else end]
            if raw:
                nodes[-1].parts.append(raw)
            if not over:
                break
            at = html.find(">", over.end())
            at = at + 1 if at >= 0 else end
            continue
        solid.append(solid[-1] if tag in INLINE else len(stack))
        where[tag].append(len(stack))
        stack.append(len(nodes) - 1)
    return nodes


def attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(raw):
        out.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    return out


def mark(nodes: list[Node]) -> None:
    """Subtree hashes, bottom up."""
    for node in reversed(nodes):
        names = ""
        if node.attrs:
            a = attributes(node.attrs)
            names = f"{a.get('class', '')}#{a.get('id', '')}"
        parts = [node.tag, names]
        for part in node.parts:
            if isinstance(part, int):
                child = nodes[part]
                parts.append(str(child.hash))
                node.has_text |= child.has_text
                node.article |= child.article or child.tag in ("article", "main")
                node.title |= child.title or child.tag == "h1"
                node.size += child.size
                node.linked += child.size if child.tag == "a" else child.linked
            elif words := part.split():
                node.has_text = True
                parts.append(" ".join(words))
                node.size += len(parts[-1])
        node.hash = xxhash.xxh64_intdigest("\x00".join(parts)) - (1 << 63)


def counted(nodes: list[Node]) -> dict[int, bool]:
    """Hashes of the subtrees that may belong to a template, and whether they are flow of text; no flow within articles, nor articles in articles."""
    inside: list[bool] = []
    out = {}
    for node in nodes:
        inside.append(node.parent >= 0 and inside[node.parent] or node.tag in ("article", "main"))
        if node.has_text and not node.article and node.tag not in _NEVER and not (inside[-1] and (node.tag in FLOW or node.tag in ("article", "main"))):
            out[node.hash] = node.tag in FLOW
    return out


def _shy(node: Node) -> bool:
    if node.article or node.tag == "form" and node.title:
        return False  # some sites put the whole page into a form
    return _named_shy(node)


def _says(name: str, what: frozenset[str] = SHY) -> bool:
    """Whether a class or id is made up of words for what is no article, at least one of them of ``what``, and words of layout."""
    words = [w for w in re.split(r"[_-]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower()) if w and not w.isdigit()]
    return any(w in what for w in words) and all(w in SHY or w in PLAIN or w in what for w in words)


def _no_place(node: Node) -> bool:
    """Whether an article within this element is a teaser or a reader's: by its tag, or as it names replies."""
    if node.tag in NO_TEXT:
        return True
    if not node.attrs or node.tag in ("html", "body", "main"):
        return False
    a = attributes(node.attrs)
    return a.get("role", "").lower() in ROLES or any(_says(n, REPLIES) for n in f"{a.get('class', '')} {a.get('id', '')}".split())


def _named_shy(node: Node) -> bool:
    if node.tag in NO_TEXT:
        return True
    if not node.attrs:
        return False
    a = attributes(node.attrs)
    if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or a.get("role", "").lower() in ROLES:
        return True
    if "display:none" in a.get("style", "").replace(" ", "").lower():
        return True
    if node.tag in ("html", "body", "main"):
        return False
    names = f"{a.get('class', '')} {a.get('id', '')}".split()
    if node.tag == "article":
        return any(n.lower() in ("comment", "comment-body", "reply") for n in names)
    return any(map(_says, names)) or 2 * node.linked > node.size and any(n.lower() in LINKED or _says(n, LINKED) for n in names)


def main_text(nodes: list[Node], template: set[int]) -> str:
    """Text of the article of a marked page without the subtrees whose hash is in ``template``.

    An empty ``template`` is what is left of the method without its counts."""

    def gather(top: int, article: bool, without: frozenset[int] = frozenset()) -> str:
        out: list[str] = []
        stack: list[str | int] = [top]
        while stack:
            part = stack.pop()
            if isinstance(part, str):
                out.append(part)
                continue
            node = nodes[part]
            if part != top and (part in without or node.hash in template and node.tag not in INLINE and not (article and node.tag in FLOW) or _shy(node)):
                if node.tag not in INLINE:
                    out.append(" ")
                continue
            if node.tag == "header" and part != top and not article and not node.article and not node.title:
                continue
            if node.tag in INLINE:
                stack.extend(reversed(node.parts))
            else:
                out.append(" ")  # blocks are joined by one space: the same as white space between them
                stack.append(" ")
                stack.extend(reversed(node.parts))
        return " ".join("".join(out).split())

    closed, main, depth = [False] * len(nodes), [-1] * len(nodes), [0] * len(nodes)
    articles, mains = [], []
    for k, node in enumerate(nodes):
        if k:
            closed[k], main[k], depth[k] = closed[node.parent], main[node.parent], depth[node.parent] + _no_place(node)
        if closed[k] or k and _shy(node):
            closed[k] = True
        elif node.tag == "article":
            articles.append(k)
            closed[k] = True
        elif main[k] < 0 and (node.tag == "main" or node.attrs and attributes(node.attrs).get("role") == "main"):
            mains.append(k)
            main[k] = k
    whole = {m for m in mains if gather(m, True, frozenset(articles))}
    texts = [(depth[k], t) for k in sorted([*whole, *(k for k in articles if main[k] not in whole)]) if (t := gather(k, True))]
    if texts:  # an article within an aside is a teaser if there are others outside of it
        least = min(d for d, _ in texts)
        return " ".join(t for d, t in texts if d == least)
    return gather(0, False)


_KEY = "xxhash64(coalesce(html, ''), host)"


def _places(host: int, subtrees: list[int]) -> np.ndarray:
    """A number for each subtree on this host."""
    return mix(np.array(subtrees, np.int64).view(np.uint64) ^ mix(np.array([host], np.int64).view(np.uint64))).view(np.int64)


def template_places(pages: DataFrame, min_pages: int = MIN_PAGES, share: float = SHARE) -> tuple[DataFrame, DataFrame]:
    """``place`` (host and subtree) of all templates, and ``key, place`` of the subtrees of each page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks, flow = [], []
            for html, host in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                nodes = parse(html or "")
                mark(nodes)
                found = counted(nodes)
                marks.append(_places(host, [h for h, f in found.items() if not f]))
                flow.append(_places(host, [h for h, f in found.items() if f]))
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(marks, kind), pa.array(flow, kind)], ["key", "host", "boxes", "flow"])

    found = written(map_arrow(pages.select("key", "html", "host"), run, "key long, host long, boxes array<long>, flow array<long>"), "subtrees")
    boxes, lines = (found.select("key", F.explode(c).alias("place"), "host", F.lit(c == "flow").alias("flow")) for c in ("boxes", "flow"))
    each = boxes.unionByName(lines)
    many = each.distinct().groupBy("place", "host", "flow").count().where(F.col("count") >= min_pages)
    hosts = written(found.select("host", "key").distinct().groupBy("host").agg(F.count("*").alias("pages")).where(F.col("pages") >= min_pages), "hosts")
    wanted = F.col("pages") * F.when(F.col("flow"), FLOW_SHARE).otherwise(share)
    return written(many.join(counted_rows(hosts), "host").where(F.col("count") >= wanted).select("place").distinct(), "places"), each.select("key", "place")


def _cut(html: str | None, host: int, template: np.ndarray) -> tuple[str, int]:
    """The text of a page, and how many of its subtrees are among ``template``, places in ascending order."""
    nodes = parse(html or "")
    mark(nodes)
    own = list(counted(nodes)) if len(template) else []
    places = _places(host, own)
    gone = {own[k] for k in np.flatnonzero(template[np.minimum(np.searchsorted(template, places), len(template) - 1)] == places)} if own else set()
    return main_text(nodes, gone), len(gone)


_OUT = "page_id long, url string, text string, n_chars long, n_template long"


def _rows(batch: pa.RecordBatch, cut: list[tuple[str, int]]) -> pa.RecordBatch:
    counts = [pa.array([len(t) for t, _ in cut], pa.int64()), pa.array([n for _, n in cut], pa.int64())]
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([t for t, _ in cut], pa.string()), *counts], ["page_id", "url", "text", "n_chars", "n_template"])


def extract_text(pages: DataFrame, min_pages: int = MIN_PAGES, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``page_id, url, text, n_chars, n_template`` for each row of ``pages`` (page_id, url, html); ``n_template`` subtrees were its site's."""
    pages = pages.select(
        column_or_null(pages, "page_id", T.LongType()).alias("page_id"), column_or_null(pages, "url", T.StringType()).alias("url"), column_or_null(pages, "html", T.StringType()).alias("html")
    )
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    keyed = pages.withColumn("host", F.xxhash64(host)).withColumn("key", F.expr(_KEY))
    places, each = template_places(keyed, min_pages)
    if places.count() <= broadcast_rows:
        sent = pages.sparkSession.sparkContext.broadcast(np.sort(places.toPandas()["place"].to_numpy(np.int64)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield _rows(batch, [_cut(h, w, sent.value) for h, w in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)])

        return map_arrow(keyed.select("page_id", "url", "html", "host"), run, _OUT)

    # each page content with its templates, by salted keys: a menu or a page that is everywhere is not one key
    salted = lambda few: few.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = lambda *by: F.pmod(F.xxhash64(*by), F.lit(SALTS)).cast("int")
    found = each.withColumn("salt", salt("key")).join(salted(places), ["place", "salt"]).groupBy("key").agg(F.sort_array(F.collect_set("place")).alias("template"))
    joined = keyed.withColumn("salt", salt("page_id", "url")).join(salted(found), ["key", "salt"], "left")

    def run_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True)
            yield _rows(batch, [_cut(h, w, np.array(t or (), np.int64)) for h, w, t in rows])

    return map_arrow(joined.select("page_id", "url", "html", "host", "template"), run_joined, _OUT)


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
