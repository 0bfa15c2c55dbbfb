"""Main text of web pages by composite text density.

Method (content extraction via text density): every page is parsed into a DOM tree;
for every node the characters ``C``, tags ``T``, link characters ``LC`` and link tags
``LT`` of its subtree give its composite text density

    CTD = C / T * log_b(C / LC * T / LT),   b = ln(C / nLC * LC + LCb / Cb * C + e)

(``nLC = C - LC``; ``LCb`` and ``Cb`` are the link characters and characters of
``body``; zero counts count 1). A block's density sum is the sum of the densities of
its block children (seen through inline elements such as ``b`` or ``a``, which belong
to the block that holds them). The block of largest density sum is the main subtree; its threshold is the
smallest density on the path from ``body`` down to it. Inside the subtree, a child
subtree whose density is below the threshold and whose characters are mostly link text
(menus, lists of related links) is left out; all other text stays.

Before the densities are taken, elements that are never main text go: scripts,
styles, templates, forms and their controls, navigation, page headers (a ``header``
outside ``article``/``main``), footers, sidebars, and elements whose class or id names
an advert, notice, comment section, menu or sidebar (the fixed word list below).

Text: character references are decoded, white space (any Unicode white space) inside a
block becomes one space, blocks are trimmed, and non-empty blocks are joined in page
order by two line breaks. Nothing else is dropped or cut.

Edge cases: a NULL or empty page, or one without ``body`` text, gives ``""``; broken
markup (unclosed tags, stray end tags, implicit paragraph ends) is repaired as browsers
do for the common cases; nesting deeper than ``MAX_DEPTH`` is flattened (its text
stays); very long pages are parsed whole, one row at a time. Ties of
density sum go to the deepest, then first, block in page order. Extra input columns are ignored.

Spark's part: pages are read and dealt over tasks; the parse is per page, so nothing
shuffles and no page meets another. The per-page work runs in an Arrow-batched pandas
UDF, because a DOM parse has no form in Spark's built-in functions.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: elements that never hold main text
DROPPED_TAGS = {
    "script", "style", "noscript", "template", "iframe", "svg", "canvas", "object", "embed",
    "form", "button", "input", "select", "option", "textarea", "label", "fieldset",
    "nav", "footer", "aside", "menu", "dialog", "head", "title",
}
# fixed values: words in a class or id that mark boilerplate
BOILERPLATE_WORDS = [
    "ad", "ads", "advert", "advertisement", "banner", "sponsor", "promo",
    "cookie", "consent", "notice", "alert", "popup", "modal", "newsletter", "subscribe",
    "comment", "comments", "reply", "replies", "disqus", "respond",
    "nav", "navbar", "menu", "breadcrumb", "sidebar", "widget", "share", "social",
    "related", "footer", "header", "masthead", "toolbar", "pagination",
]
# fixed values: elements without content or end tag
VOID_TAGS = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
    "source", "track", "wbr",
}
# fixed values: elements that start a block of text
BLOCK_TAGS = {
    "address", "article", "blockquote", "body", "caption", "dd", "details", "div", "dl",
    "dt", "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "hr", "li", "main",
    "ol", "p", "pre", "section", "summary", "table", "td", "th", "tr", "ul", "html",
}
# fixed values: start tags that end an open paragraph
CLOSES_P = BLOCK_TAGS - {"body", "html", "td", "th", "tr", "caption", "li", "dd", "dt"} | {
    "li", "dd", "dt", "form", "header", "footer", "nav", "aside", "menu",
}
# Deeper elements are kept as empty ones and their text goes to the deepest open one,
# so that pathological nesting cannot exhaust the stack; no text is lost.
MAX_DEPTH = 256
SCOPE = {"html", "body", "table", "td", "th", "caption", "button", "object", "template"}

_WORD = re.compile(r"[a-z0-9]+")
_SPACE = re.compile(r"\s+")
_BAD = set(BOILERPLATE_WORDS)


class Node:
    __slots__ = ("tag", "attrs", "children", "parent", "drop")

    def __init__(self, tag: str, attrs: dict, parent: "Node | None"):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []
        self.drop = False


class _Builder(HTMLParser):
    """A DOM tree from markup, with the usual repairs of broken pages."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", {}, None)
        self.stack = [self.root]

    def _open_index(self, tag: str, scope: set[str]) -> int:
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                return i
            if self.stack[i].tag in scope:
                return -1
        return -1

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P:
            i = self._open_index("p", SCOPE)
            if i > 0:
                del self.stack[i:]
        if tag in ("li", "dd", "dt"):
            i = self._open_index(tag, SCOPE | {"ul", "ol", "dl"})
            if i > 0:
                del self.stack[i:]
        node = Node(tag, {k: v or "" for k, v in attrs}, self.stack[-1])
        self.stack[-1].children.append(node)
        if tag not in VOID_TAGS and len(self.stack) < MAX_DEPTH:
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS and self.stack[-1].tag == tag:
            self.stack.pop()

    def handle_endtag(self, tag):
        i = self._open_index(tag, set())
        if i > 0:
            del self.stack[i:]
        elif tag == "p":  # a stray </p> is an empty paragraph
            self.stack[-1].children.append(Node("p", {}, self.stack[-1]))

    def handle_data(self, data):
        if data:
            self.stack[-1].children.append(data)


def parse(html: str) -> Node:
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root


def _is_boilerplate(node: Node, in_article: bool) -> bool:
    if node.tag in DROPPED_TAGS or (node.tag == "header" and not in_article):
        return True
    names = f"{node.attrs.get('class', '')} {node.attrs.get('id', '')}".lower()
    if any(w in _BAD for w in _WORD.findall(names)):
        return True
    role = node.attrs.get("role", "").lower()
    return role in {"navigation", "banner", "contentinfo", "complementary", "dialog"}


def _find(node: Node, tag: str) -> Node | None:
    for c in node.children:
        if isinstance(c, Node):
            if c.tag == tag:
                return c
            found = _find(c, tag)
            if found is not None:
                return found
    return None


class _Stats:
    __slots__ = ("c", "t", "lc", "lt", "ctd", "ds")


def _measure(node: Node, in_link: bool, stats: dict[int, _Stats]) -> _Stats:
    """Characters, tags, link characters and link tags of every kept subtree."""
    s = _Stats()
    s.c = s.t = s.lc = s.lt = 0
    link = in_link or node.tag == "a"
    for c in node.children:
        if isinstance(c, str):
            n = len(_SPACE.sub("", c))
            s.c += n
            s.lc += n if link else 0
        elif not c.drop:
            k = _measure(c, link, stats)
            s.c += k.c
            s.t += k.t + 1
            s.lc += k.lc
            s.lt += k.lt + (1 if c.tag == "a" else 0)
    stats[id(node)] = s
    return s


def _density(s: _Stats, body: _Stats) -> float:
    c, t = max(s.c, 1), max(s.t, 1)
    lc, lt = max(s.lc, 1), max(s.lt, 1)
    nlc = max(s.c - s.lc, 1)
    share = body.lc / body.c if body.c else 0.0
    base = math.log(c / nlc * s.lc + share * s.c + math.e)
    ratio = c / lc * t / lt
    # base 1 (no link text at all): the logarithm of base e stands for it
    log = math.log(ratio) / math.log(base) if base > 1.0 + 1e-9 else math.log(ratio)
    return c / t * log


def _mark(node: Node, in_article: bool) -> None:
    for c in node.children:
        if isinstance(c, Node):
            c.drop = _is_boilerplate(c, in_article)
            if not c.drop:
                _mark(c, in_article or c.tag in ("article", "main"))


def _block_kids(node: Node):
    """Block children, looking through inline elements such as ``b`` or ``a``."""
    for c in node.children:
        if isinstance(c, Node) and not c.drop:
            if c.tag in BLOCK_TAGS:
                yield c
            else:
                yield from _block_kids(c)


def _blocks(node: Node, keep, out: list[str], buf: list[str]) -> None:
    for c in node.children:
        if isinstance(c, str):
            buf.append(c)
        elif c.drop or not keep(c):
            continue
        elif c.tag == "br":
            buf.append(" ")
        elif c.tag in BLOCK_TAGS:
            _flush(out, buf)
            _blocks(c, keep, out, buf)
            _flush(out, buf)
        else:
            _blocks(c, keep, out, buf)


def _flush(out: list[str], buf: list[str]) -> None:
    text = _SPACE.sub(" ", "".join(buf)).strip()
    if text:
        out.append(text)
    buf.clear()


def extract(html: str | None) -> str:
    """The main text of one page; see the module's description."""
    if not html:
        return ""
    root = parse(html)
    body = _find(root, "body") or root
    _mark(body, body.tag in ("article", "main"))
    stats: dict[int, _Stats] = {}
    whole = _measure(body, False, stats)
    if whole.c == 0:
        return ""
    # densities, density sums, and the node of largest sum in page order
    best, best_sum, path, best_path = body, -math.inf, [], []
    ctd: dict[int, float] = {}

    def walk(node: Node) -> None:
        nonlocal best, best_sum, best_path
        ctd[id(node)] = _density(stats[id(node)], whole)
        path.append(node)
        kids = [c for c in node.children if isinstance(c, Node) and not c.drop]
        for c in kids:
            walk(c)
        if node.tag in BLOCK_TAGS or node is body:
            total = sum(ctd[id(c)] for c in _block_kids(node))
            if total > best_sum:
                best, best_sum, best_path = node, total, list(path)
        path.pop()

    walk(body)
    threshold = min(ctd[id(n)] for n in best_path)

    def keep(node: Node) -> bool:
        s = stats[id(node)]
        mostly_links = s.c > 0 and 2 * s.lc >= s.c
        return not (ctd[id(node)] < threshold and mostly_links)

    out: list[str] = []
    buf: list[str] = []
    wrapper = Node("div", {}, None)
    wrapper.children = [best]
    _blocks(wrapper, keep, out, buf)
    _flush(out, buf)
    return "\n\n".join(out)


def main_text(html: Column) -> Column:
    """The main text of every page, as a column."""

    @F.pandas_udf("string")
    def texts(pages: pd.Series) -> pd.Series:
        return pages.map(lambda h: extract(h if isinstance(h, str) else None))

    return texts(html)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and its code points (``n_chars``) for every page."""
    found = pages.select("page_id", "url", main_text(F.col("html")).alias("text"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
