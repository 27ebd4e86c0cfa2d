"""Main text of web pages, with site templates found over all pages of a host.

A page is parsed into elements. Every element's subtree has a hash of its tags
and its text; Spark counts on how many different pages of a host, and of a
section of it, each hash occurs, and subtrees that recur on a large share of
them are the site's template and are deleted, as are menus that recur on any
share. From what is left, the text blocks of the article
are taken, without the elements that HTML itself or their class names mark as
menus, headers, footers, sidebars, notices, adverts, forms or comments.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp svg math".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td "
    "tfoot th thead tr ul".split())
DROPPED = RAW | frozenset(
    "head nav footer aside form menu dialog button select option input label object embed audio video canvas "
    "map search".split())
#: Words in class, id or role that mark what is not the article.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion banner "
    "banners nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars aside footer masthead cookie "
    "cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login "
    "comment comments commentlist reply replies respond disqus share sharing social related recommended toolbar "
    "pagination pager widget contentinfo complementary".split())
#: An open element of the key is ended by the start of one of the values.
ENDED_BY = {
    "p": BLOCKS - frozenset(["body", "html"]),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "thead", "tfoot"]), "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "option": frozenset(["option", "optgroup"]),
    "head": frozenset(["body"]),
}
#: Elements that the search for an open one to end does not look beyond.
SCOPES = frozenset("ul ol dl table td th article section div main body html blockquote aside nav form".split())

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
LETTER = re.compile(r"[^\W_]")


class Element:
    """One element: tag, marking words, and children, each an Element or a string of text."""

    __slots__ = ("tag", "words", "children")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag = tag
        self.words = frozenset(w.lower() for m in NAMED.finditer(attrs) for v in m.groups() if v
                               for w in WORDS.findall(v)) if "=" in attrs else frozenset()
        self.children: list = []


def parse(source: str) -> Element:
    """The element tree of a page; never fails, unclosed elements end with what holds them."""
    root = Element("#page")
    stack, at = [root], 0
    while True:
        m = MARKUP.search(source, at)
        if m is None:
            break
        if m.start() > at:
            stack[-1].children.append(html.unescape(source[at:m.start()]))
        at = m.end()
        if m["tag"] is None:
            if m[0].startswith("<![CDATA["):
                stack[-1].children.append(m[0][9:].removesuffix("]]>"))
            continue
        tag = m["tag"].lower()
        if m["close"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if stack[k].tag in SCOPES and tag not in BLOCKS:
                    break
            continue
        while True:
            for k in range(len(stack) - 1, 0, -1):
                if tag in ENDED_BY.get(stack[k].tag, ()):
                    del stack[k:]
                    break
                if stack[k].tag in SCOPES:
                    k = 0
                    break
            else:
                k = 0
            if not k:
                break
        element = Element(tag, m["attrs"])
        stack[-1].children.append(element)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(source, at)
            at = end.end() if end else len(source)
        elif tag not in VOID and not m["attrs"].rstrip().endswith("/"):
            stack.append(element)
    if at < len(source):
        stack[-1].children.append(html.unescape(source[at:]))
    return root


def _top_down(root: Element) -> list[Element]:
    """Every element, each before those in it."""
    order, todo = [], [root]
    while todo:
        element = todo.pop()
        order.append(element)
        todo.extend(c for c in element.children if isinstance(c, Element))
    return order


def subtree_hashes(root: Element) -> dict[int, int]:
    """id(element) -> 64-bit hash of its tags and text, for every element with text that can be a template.

    Elements within a line of running text (a link or a bold word in a sentence) cannot.
    Works from the leaves up without recursion; each element is hashed from its children's hashes.
    """
    import xxhash

    order = _top_down(root)
    out: dict[int, int] = {}
    for element in reversed(order):
        h, some = xxhash.xxh64(element.tag.encode()), False
        for c in element.children:
            if isinstance(c, Element):
                if id(c) in out:
                    h.update(b"\x01" + out[id(c)].to_bytes(8, "little", signed=True))
                    some = True
            elif text := " ".join(c.split()):
                h.update(b"\x02" + text.encode(errors="replace"))
                some = True
        if some:
            out[id(element)] = int.from_bytes(h.digest(), "big", signed=True)
    for element in order:
        if any(isinstance(c, str) and LETTER.search(c) for c in element.children):
            for c in element.children:
                if isinstance(c, Element) and c.tag not in BLOCKS:
                    out.pop(id(c), None)
    return out


def link_lists(root: Element) -> set[int]:
    """id(element) of every block outside articles and main elements that has half of its letters or more in links."""
    order = _top_down(root)
    inside: set[int] = set()
    for element in order:
        if element.tag in ("article", "main") or id(element) in inside:
            inside.update([id(element)], (id(c) for c in element.children if isinstance(c, Element)))
    total: dict[int, int] = {}
    linked: dict[int, int] = {}
    out = set()
    for element in reversed(order):
        parts = [c for c in element.children if isinstance(c, Element)]
        n = sum(len("".join(c.split())) for c in element.children if isinstance(c, str)) + sum(total[id(c)] for c in parts)
        m = n if element.tag == "a" else sum(linked[id(c)] for c in parts)
        total[id(element)], linked[id(element)] = n, m
        if element.tag in BLOCKS and n and 2 * m >= n and id(element) not in inside:
            out.add(id(element))
    return out


def _unwanted(element: Element, in_article: bool) -> bool:
    if element.tag in DROPPED or element.tag == "header" and not in_article:
        return True
    return element.tag not in ("html", "body", "main") and not element.words.isdisjoint(MARKS)


def article_roots(root: Element, gone: set[int], hashes: dict[int, int]) -> list[Element]:
    """The outermost articles that are wanted, else the main element, else the whole page."""
    articles, mains, todo = [], [], [root]
    while todo:
        element = todo.pop()
        if _unwanted(element, False) or hashes.get(id(element)) in gone:
            continue
        if element.tag == "article":
            articles.append(element)
            continue
        if element.tag == "main" or "main" in element.words and element.tag not in ("body", "html"):
            mains.append(element)
        todo.extend(c for c in reversed(element.children) if isinstance(c, Element))
    return articles or mains[:1] or [root]


def main_text(source: str, template: frozenset[int] | set[int] = frozenset()) -> str:
    """Text blocks of the article in page order, white space made single, joined by empty lines."""
    root = parse(source)
    hashes = subtree_hashes(root) if template else {}
    blocks, words = [], []

    def flush():
        if words and (text := " ".join("".join(words).split())):
            blocks.append(text)
        words.clear()

    for top in article_roots(root, template, hashes):
        todo: list = [top]
        in_article = top.tag in ("article", "main") or "main" in top.words
        while todo:
            node = todo.pop()
            if node is None:
                flush()
            elif isinstance(node, str):
                words.append(node)
            elif node.tag == "br":
                words.append(" ")
            elif not _unwanted(node, in_article) and hashes.get(id(node)) not in template:
                block = node.tag in BLOCKS
                if block:
                    flush()
                    todo.append(None)
                todo.extend(reversed(node.children))
        flush()
    return "\n\n".join(blocks)


def host_of(url: Column) -> Column:
    """Host of a URL in lower case; null if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def section_of(url: Column) -> Column:
    """Hash of the first directory of a URL's path; null if there is none."""
    name = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)/", 1)
    return F.when(name != "", F.xxhash64(name))


def subtrees(pages: DataFrame) -> DataFrame:
    """host, section, page, subtree and links (whether it is a list of links) of every element with text.

    ``page`` is a hash of the whole html. Pages without a host or html have no rows.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, subtree, links = [], [], []
            for i, source in enumerate(batch.column("html").to_pylist()):
                root = parse(source)
                lists = link_lists(root)
                own: dict[int, bool] = {}  # a subtree that is an article's somewhere is no menu
                for element, h in subtree_hashes(root).items():
                    own[h] = own.get(h, True) and element in lists
                rows += [i] * len(own)
                subtree += own
                links += own.values()
            at = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(at) for c in ("host", "section", "page")), pa.array(subtree, pa.int64()),
                 pa.array(links, pa.bool_())], names=["host", "section", "page", "subtree", "links"])

    rows = pages.select(host_of(F.col("url")).alias("host"), section_of(F.col("url")).alias("section"),
                        F.xxhash64("html").alias("page"), F.col("html").alias("html"))
    return rows.filter("host is not null and html is not null").mapInArrow(
        scan, "host string, section long, page long, subtree long, links boolean")


def site_templates(seen: DataFrame, share: float = 0.5, many: int = 8, link_share: float = 0.02) -> DataFrame:
    """(host, section, subtree): what is deleted from the pages of a host, or of one section where that is not null.

    Pages of equal html count once (in the first of their sections), so copies
    of one page make no template. A subtree is a host's template if more than
    ``share`` of its pages, and one besides, have it (4 of 5 pages, 51 of 100;
    at least 4), or if it is a list of links outside any article on three pages
    and ``link_share`` of them or more. It is a section's template by the same
    share of the section's pages, at least ``many`` of them, as a few copied
    articles may well stand in one section. The shares bound the templates of a
    host by those of a page, however many pages it has.
    """
    once = (seen.groupBy("host", "subtree", "page")
            .agg(F.min("section").alias("section"), F.min("links").alias("links")))
    by_section = written(once.groupBy("host", "subtree", "section").agg(
        F.count(F.lit(1)).alias("n"), F.min("links").alias("links")), "subtree-counts")
    sizes = written(seen.groupBy("host", "page").agg(F.min("section").alias("section"))
                    .groupBy("host", "section").agg(F.count(F.lit(1)).alias("pages")), "host-sizes")
    enough = F.col("n") - 1 >= share * F.col("pages")
    often = (by_section.groupBy("host", "subtree").agg(F.sum("n").alias("n"), F.min("links").alias("links"))
             .filter("n >= 3"))
    whole = (often.join(sizes.groupBy("host").agg(F.sum("pages").alias("pages")), "host")
             .filter((F.col("n") >= 4) & enough | F.col("links") & (F.col("n") >= link_share * F.col("pages")))
             .select("host", F.lit(None).cast("long").alias("section"), "subtree"))
    part = (by_section.filter(F.col("n") >= many).join(sizes, ["host", "section"])
            .filter(enough).select("host", "section", "subtree"))
    return whole.unionByName(part)


def page_texts(pages: DataFrame, share: float = 0.5, many: int = 8, link_share: float = 0.02) -> DataFrame:
    """page_id, url, text and n_chars of every row: the article without its site's template.

    Null and empty html give an empty text; pages without a host in their url
    lose no template. Character references are decoded, white space within a
    block is one space, blocks are joined by two line feeds. Repeated rows get
    equal results; other columns are not read.
    """
    found = written(site_templates(written(subtrees(pages), "subtrees"), share, many, link_share), "templates")
    lists = F.collect_list("subtree")
    whole = found.filter("section is null").groupBy("host").agg(lists.alias("template"))
    part = found.filter("section is not null").groupBy("host", "section").agg(lists.alias("own"))
    rows = (pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"),
                         section_of(F.col("url")).alias("section"))
            .join(whole, "host", "left").join(part, ["host", "section"], "left")
            .select("page_id", "url", "html", "template", "own"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, frozenset[int]] = {}

        def values(found) -> frozenset[int]:
            if not found.is_valid:
                return frozenset()
            numbers = found.values.to_numpy(zero_copy_only=False).astype(np.int64)
            if (raw := numbers.tobytes()) not in known:
                if len(known) > 1000:
                    known.clear()
                known[raw] = frozenset(numbers.tolist())
            return known[raw]

        for batch in batches:
            texts = []
            for source, template, own in zip(*(batch.column(c) for c in ("html", "template", "own"))):
                gone, more = values(template), values(own)
                texts.append(main_text(source.as_py() or "", gone | more if more else gone))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kinds = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long"
    return rows.mapInArrow(scan, kinds)
