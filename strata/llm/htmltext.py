"""Main text of HTML pages: flat text blocks, classified by a decision tree.

A page is read once, from left to right, into *blocks*: the text between two
block-level tags, white space collapsed.  Every block carries its word count,
its link density (share of its words inside links), both of the blocks before
and after it, whether it is a heading or paragraph, and what the elements
around it say: the nearest element that names itself content, and elements
that name themselves a menu, footer, advert, comment or the like inside or
outside of it.  A decision tree, trained on a small table of labelled blocks,
marks each block as main text or not; the main blocks, joined by line feeds in
page order, are the page's text.

The labelled table is the blocks of ``LABELLED_PAGES`` (under 200); pass other labelled
pages to ``train`` for other sites.  Nothing else is dropped and nothing is cut.

Defined results: a page that is NULL or empty, and one without main blocks,
gives the empty text; repeated rows give repeated rows; an empty table gives an
empty result; an unclosed element lasts to the end of its parent, an unclosed
comment, script or style to the end of the page; a tag whose quote never closes
ends at its ``>``; a NULL id or url stays NULL.  Only the three named columns
are read, so others may have any name.  Every row is read in time linear in
its length (nesting included); one page must fit in a task's memory.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import col, map_rows

# HTML elements that break a line of text, and those whose content is never page text.
BLOCK_TAGS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol p pre
search section summary table tbody td tfoot th thead tr ul""".split())
RAW_TAGS = frozenset("script style textarea title iframe noembed noframes xmp".split())
SKIP_TAGS = frozenset("audio button canvas datalist object select svg template video".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# a new element of the set closes the open element named by the key, if it is the innermost block
CLOSED_BY = {"li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
             "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
             "tr": frozenset(["tr", "tbody", "tfoot"]), "p": BLOCK_TAGS - {"caption", "td", "th", "tr", "tbody", "thead", "tfoot"}}

# How pages name their parts (tags, roles, words of class and id).
OTHER_TAGS = frozenset("nav footer aside form menu dialog noscript search".split())
OTHER_ROLES = frozenset("""alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status
toolbar""".split())
OTHER_WORDS = frozenset("""ad ads advert advertisement advertising adverts aside banner breadcrumb breadcrumbs comment commentlist
comments consent cookie cookies copyright disclaimer disqus discussion feedback foot footer gdpr login masthead menu modal nav navbar
navigation newsletter notice notification pager pagination popup promo promotion promoted recommended related replies reply respond search
share sharing sidebar signup skip social sponsor sponsored subscribe teaser toolbar topbar trending widget""".split())
OTHER_STARTS = ("advert", "comment", "cookie", "footer", "navbar", "newsletter", "sidebar")
CONTENT_WORDS = frozenset("article articlebody body content entry hentry main post story text".split())
OUTER_WORDS = frozenset("ad ads advert comment comments commentlist discussion disqus recommended related replies respond teaser".split())
_NOT = frozenset("has no not with without".split())

_ATTRIBUTE = re.compile(r"""[\s/]*+([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+("[^"]*"|'[^']*'|[^\s>"'][^\s>]*+)?)?""")
_NAME = re.compile(r"[A-Za-z][^\s/>]*+")
_WORDS = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none")


class Block(NamedTuple):
    """One text block; ``label`` is whether an element marked ``data-main`` encloses it (training pages)."""

    text: str
    words: int
    linked: int
    content: bool    # inside an element that names itself content
    other: bool      # inside, below that, one that names itself something else
    outer: bool      # the content element itself lies in a comment list, advert or the like
    heading: bool
    paragraph: bool
    label: bool


class _Open(NamedTuple):
    tag: str
    content: bool
    other: bool
    outer: bool
    strong: bool
    label: bool
    block: int       # place in the stack of the innermost block-level element


def _says(tag: str, attributes: dict[str, str], content: bool) -> tuple[str, bool]:
    """What an element names itself: ``("content" | "other" | "", whether it counts for content elements inside it)``."""
    if tag in ("html", "body"):
        return "", False
    role = attributes.get("role", "").strip().lower()
    named = attributes.get("class", "") + " " + attributes.get("id", "") + " " + attributes.get("itemprop", "")
    words: set[str] = set()
    for token in named.split():
        parts = [w.lower() for w in _WORDS.findall(token)]
        if not _NOT.intersection(parts):
            words.update(parts)
            words.add("".join(parts))
    if tag in OTHER_TAGS or role in OTHER_ROLES:
        return "other", True
    if words & OTHER_WORDS or any(w.startswith(OTHER_STARTS) for w in words) or "hidden" in attributes or _HIDDEN.search(attributes.get("style", "").lower()):
        return "other", bool(words & OUTER_WORDS)
    if tag == "header" or "header" in words:
        # the header of an article is part of it
        return ("", False) if content or words & CONTENT_WORDS else ("other", False)
    if tag in ("article", "main") or role in ("article", "main") or words & CONTENT_WORDS:
        return "content", False
    return "", False


class _Reader:
    """Collects the blocks of one page."""

    def __init__(self) -> None:
        self.blocks: list[Block] = []
        self.stack = [_Open("", False, False, False, False, False, 0)]
        self.open: Counter[str] = Counter()
        self.text: list[str] = []
        self.links: list[str] = []
        self.skipped = 0   # open elements whose content is no page text
        self.in_link = 0

    def flush(self) -> None:
        words = "".join(self.text).split() if self.text else []
        if words:
            linked = len("".join(self.links).split())
            top, tags = self.stack[-1], self.open
            self.blocks.append(Block(" ".join(words), len(words), min(linked, len(words)), top.content, top.other, top.outer,
                                     any(tags[h] for h in HEADINGS), bool(tags["p"]), top.label))
        self.text, self.links = [], []

    def data(self, text: str) -> None:
        if self.skipped or not text:
            return
        text = html.unescape(text) if "&" in text else text
        self.text.append(text)
        if self.in_link:
            self.links.append(text)

    def pop(self) -> None:
        tag = self.stack.pop().tag
        self.open[tag] -= 1
        self.skipped -= tag in SKIP_TAGS
        self.in_link -= tag == "a"

    def start(self, tag: str, attributes: dict[str, str]) -> None:
        if tag == "br":
            self.data(" ")
        if tag in BLOCK_TAGS:
            self.flush()
        if tag in VOID_TAGS:
            return
        if tag == "a" and self.in_link:  # links do not nest
            self.end("a")
        at = self.stack[-1].block
        if tag in BLOCK_TAGS and tag in CLOSED_BY.get(self.stack[at].tag, ()):
            while len(self.stack) > at:  # the block that this one ends, with the formatting left open in it
                self.pop()
        top = self.stack[-1]
        says, strong = _says(tag, attributes, top.content and not top.other)
        content, other, outer = top.content, top.other, top.outer
        if says == "content":
            outer = outer or top.strong
            content, other = True, False
        elif says == "other":
            other = True
        self.stack.append(_Open(tag, content, other, outer, top.strong or (says == "other" and strong),
                                top.label or "data-main" in attributes,
                                len(self.stack) if tag in BLOCK_TAGS else top.block))
        self.open[tag] += 1
        self.skipped += tag in SKIP_TAGS
        self.in_link += tag == "a"

    def end(self, tag: str) -> None:
        if tag in BLOCK_TAGS:
            self.flush()
        if tag == "br":
            self.data(" ")
        if not self.open[tag]:
            return
        while self.stack[-1].tag != tag:
            if tag not in BLOCK_TAGS and self.stack[-1].tag in BLOCK_TAGS:
                return  # an inline end tag does not end blocks
            self.pop()
        self.pop()


def _attributes(page: str, at: int) -> tuple[dict[str, str], int]:
    """The attributes from ``at`` on and the place after the tag's ``>``."""
    found: dict[str, str] = {}
    n = len(page)
    while at < n:
        while at < n and (page[at].isspace() or page[at] == "/"):
            at += 1
        if at >= n or page[at] == ">":
            return found, at + 1
        m = _ATTRIBUTE.match(page, at)
        if m is None:
            at += 1
            continue
        value = m[2]
        at = m.end()
        if value is None and at < n and page[at] in "\"'" and page[at - 1] != page[at]:
            at = _unclosed(page, at)  # the quote never closes: the tag ends at its next ">"
            return found, at
        value = value or ""
        found.setdefault(m[1].lower(), html.unescape(value[1:-1] if value[:1] in ("'", '"') else value))
    return found, n


def _unclosed(page: str, at: int) -> int:
    end = page.find(">", at)
    return len(page) if end < 0 else end + 1


def read_blocks(page: str | None) -> list[Block]:
    """The text blocks of a page in page order."""
    reader, at = _Reader(), 0
    page = page or ""
    n, lower = len(page), None
    missing: set[str] = set()  # end markers known not to occur any more
    while at < n:
        lt = page.find("<", at)
        if lt < 0 or lt == n - 1:
            reader.data(page[at:])
            break
        reader.data(page[at:lt])
        c = page[lt + 1]
        closing = c == "/"
        m = _NAME.match(page, lt + 2 if closing else lt + 1) if closing or c.isalpha() else None
        if m is not None:
            tag = m[0].lower()
            attributes, at = _attributes(page, m.end())
            if closing:
                reader.end(tag)
            else:
                reader.start(tag, attributes) if tag not in RAW_TAGS else None
                if tag in RAW_TAGS:
                    lower = lower if lower is not None else page.lower() if len(page.lower()) == n else page
                    end = -1 if tag in missing else lower.find(f"</{tag}", at)
                    if end < 0:
                        missing.add(tag)
                        if tag in ("script", "style"):
                            break
                    else:
                        at = end
        elif page.startswith("<!--", lt):
            if page.startswith((">", "->"), lt + 4):
                at = page.find(">", lt + 4) + 1
                continue
            end = page.find("-->", lt + 4)
            if end < 0:
                break
            at = end + 3
        elif c in "!?/":
            end = -1 if ">" in missing else page.find(">", lt + 2)
            if end < 0:
                break
            at = end + 1
        else:
            reader.data("<")
            at = lt + 1
    reader.flush()
    return reader.blocks


FEATURES = ("other", "outer", "content", "link density", "words", "link density before", "words before", "link density after",
            "words after", "heading", "paragraph")


def features(blocks: list[Block]) -> np.ndarray:
    """One row of ``FEATURES`` a block; a missing neighbour has no words and no links."""
    if not blocks:
        return np.zeros((0, len(FEATURES)))
    words = np.array([b.words for b in blocks], float)
    density = np.array([b.linked for b in blocks], float) / words
    before, after = lambda x: np.r_[0.0, x[:-1]], lambda x: np.r_[x[1:], 0.0]
    flags = {k: np.array([getattr(b, k) for b in blocks], float) for k in ("other", "outer", "content", "heading", "paragraph")}
    return np.column_stack([flags["other"], flags["outer"], flags["content"], density, words, before(density), before(words),
                            after(density), after(words), flags["heading"], flags["paragraph"]])


class Node(NamedTuple):
    """A split (``feature <= threshold`` goes left) or, with ``feature`` -1, a leaf with the share of main blocks."""

    feature: int
    threshold: float
    left: "Node | None"
    right: "Node | None"
    share: float


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8, leaf: int = 1) -> Node:
    """A classification tree (Gini impurity; ties go to the earlier feature, then the lower threshold)."""
    share = float(y.mean()) if len(y) else 0.0
    if depth == 0 or len(y) < 2 * leaf or share in (0.0, 1.0):
        return Node(-1, 0.0, None, None, share)
    best = (len(y) * 2 * share * (1 - share) - 1e-9, -1, 0.0)
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, hits = x[order, f], np.cumsum(y[order])
        at = np.flatnonzero(v[1:] > v[:-1]) + 1
        at = at[(at >= leaf) & (at <= len(y) - leaf)]
        if not len(at):
            continue
        a, b = hits[at - 1], hits[-1] - hits[at - 1]
        cost = 2 * (a * (1 - a / at) + b * (1 - b / (len(y) - at)))
        k = int(np.argmin(cost))
        if cost[k] < best[0] - 1e-9:
            best = (float(cost[k]), f, float((v[at[k] - 1] + v[at[k]]) / 2))
    if best[1] < 0:
        return Node(-1, 0.0, None, None, share)
    low = x[:, best[1]] <= best[2]
    return Node(best[1], best[2], grow(x[low], y[low], depth - 1, leaf), grow(x[~low], y[~low], depth - 1, leaf), share)


def classify(tree: Node, x: np.ndarray) -> np.ndarray:
    """Whether each row is main text."""
    out = np.zeros(len(x), bool)
    todo = [(tree, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        if node.feature < 0:
            out[rows] = node.share > 0.5
        else:
            low = x[rows, node.feature] <= node.threshold
            todo += [(node.left, rows[low]), (node.right, rows[~low])]
    return out


#: Labelled pages: ``#n`` stands for n words, ``data-main`` marks main text.  Each shows one way to lay out a page.
LABELLED_PAGES = [
    # plain article with menu, advert and footer; paragraphs from one word to many
    """<nav><ul><li><a>#1</a><li><a>#2</a><li><a>#1</a></ul></nav><div class=ad>#9</div><article data-main><h1>#8</h1><p>#40<p>#1
    <p>#120<p>#2<p>#14<h2>#3</h2><p>#60</article><footer>#2 <a>#1</a> #12</footer>""",
    # header, sidebar, cookie notice, form and comments around an article
    """<div class="cookie-notice"><p>#45</p><button>#1</button></div><header><h1>#3</h1><p>#6</p><a>#1</a></header><main><article
    data-main><header><h1>#9</h1><p>#4</p></header><p>#70 <a>#2</a> #20</p><p>#3</p><ul><li>#4<li>#9</ul><p>#25</p></article>
    <aside><h3>#2</h3><p>#30</p><ul><li><a>#5</a><li><a>#6</a></ul></aside><form><p>#12</p><label>#2</label></form>
    <section id=comments><h2>#2</h2><article><p>#50</p></article><article><p>#3</p></article><div><p>#20</p></div></section></main>
    <footer><p>#40</p><ul><li><a>#1</a><li><a>#2</a></ul></footer>""",
    # the parts named by class only
    """<div class="site-header"><a>#2</a></div><div class=navbar><a>#1</a> <a>#1</a> <a>#1</a></div><div id=content><div class="post">
    <h1 data-main>#7</h1><div data-main><p>#55</p><p>#2</p><blockquote>#18</blockquote><p>#33</p></div><div class="share-buttons">#3</div>
    <div class="advertisement"><p>#28</p></div><p data-main>#44</p><p data-main>#1</p></div><div class="comment-list"><p>#35</p><p>#2</p>
    <p>#70</p></div></div><div class="sidebar"><p>#42</p><p>#4</p><h3>#2</h3></div><div class="footer-legal"><p>#60</p><p>#8</p></div>""",
    # adverts, notices and subscription boxes inside the article
    """<main><h1 data-main>#6</h1><p data-main>#80</p><aside><p>#22</p></aside><p data-main>#2</p><div class="newsletter-signup"><p>#16</p>
    </div><p data-main>#5</p><div role=alert>#15</div><p data-main>#31</p><div class="related"><h2>#2</h2><a>#7</a><p>#12</p></div>
    <p data-main>#17</p><table data-main><tr><td>#1<td>#2<tr><td>#1<td>#3</table><footer><p>#10</p><p>#1</p></footer></main>""",
    # main text whose list entries and headings are links
    """<article><h2 data-main><a>#5</a></h2><p data-main>#25</p><ul data-main><li><a>#3</a><li><a>#4</a> #2<li><a>#2</a></ul><p data-main>#12
    <a>#9</a></p><p data-main><a>#6</a></p></article>""",
    # short main text next to menus, and long text that is none
    """<nav><a>#2</a></nav><article data-main><h1>#4</h1><p>#3</p><p>#9</p></article><nav><a>#2</a> <a>#3</a></nav><div class=promo>#90</div>""",
    """<ul class=menu><li><a>#1</a><li><a>#3</a></ul><article data-main><p>#2</p></article><div class="side-bar"><a>#4</a></div>""",
    """<nav><a>#2</a></nav><main data-main><div>#1</div><div>#6</div><div>#12 <a>#1</a></div></main><footer><a>#2</a><p>#2</p></footer>""",
    """<div class=topbar><a>#3</a></div><div id=content data-main><h1>#2</h1><div>#16</div><p>#21</p></div><aside><a>#3</a><p>#150</p></aside>""",
    """<div class=banner><a>#3</a> #14</div><article data-main><p><a>#3</a></p><p>#5</p><p><a>#2</a></p><p>#1 <a>#1</a></p></article><div
    class=comments><p><a>#1</a></p><p>#130</p><article><a>#1</a><p>#16</p></article></div>""",
    """<div class=comments><article><p>#33</p><p>#80</p></article><article><p>#1</p></article></div><div class="ads"><main><p>#40</p></main></div>""",
    # nothing is named: word counts and links of a block and its neighbours decide
    """<div><a>#1</a> | <a>#1</a> | <a>#2</a></div><div><a>#3</a></div><h1 data-main>#7</h1><p data-main>#60</p><p data-main>#35</p><p data-main>
    #18 <a>#2</a> #14</p><p data-main>#9</p><p data-main>#48</p><p data-main>#26</p><div><a>#4</a></div><div><a>#5</a></div><div><a>#6</a> #1
    </div><div>#3 <a>#2</a></div>""",
    """<table><tr><td><a>#1</a><td><a>#1</a><td><a>#2</a></table><div><h2 data-main>#5</h2><p data-main>#90</p><p data-main>#42</p><p data-main>
    #11</p><p data-main>#75</p><p data-main>#21</p></div><div><ul><li><a>#4</a><li><a>#3</a><li><a>#5</a></ul></div><div>#4</div><div>#6</div>
    <div><a>#2</a> #1</div>""",
    """<p><a>#2</a></p><p><a>#3</a> <a>#1</a></p><p data-main>#30</p><p data-main>#110</p><p data-main>#64</p><p data-main>#24</p><div><a>#8</a>
    </div><div><a>#2</a></div><div>#2</div><div>#5 <a>#4</a></div>""",
    # pages without main text
    """<nav><a>#1</a></nav><form><p>#6</p></form><div class=login><p>#20</p></div><footer><p>#30</p></footer>""",
    """<div class="popup"><p>#18</p></div><div class="search"><p>#2</p></div><div class="pagination"><a>#1</a> <a>#1</a></div>
    <div class="teaser"><article><h2><a>#6</a></h2><p>#25</p></article></div><div class="related"><article><p>#14</p></article></div>""",
    # a wrapper around everything names itself content
    """<div id=main><div class=breadcrumb><a>#1</a> <a>#2</a></div><div class="entry-header" data-main><h1>#6</h1></div><div class="entry-content"
    data-main><p>#1</p><p>#36</p><p>#13</p><pre>#10</pre><dl><dt>#1<dd>#8</dl></div><div class="entry-footer">#7</div><div id=respond><h3>#3
    </h3><p>#9</p></div></div><noscript>#8</noscript><div class="copyright">#11</div>""",
]


def labelled_blocks(pages: list[str] | None = None) -> list[list[Block]]:
    """The blocks of labelled pages, ``#n`` written out as n words."""
    def fill(page: str) -> str:
        return re.sub(r"#(\d+)", lambda m: " ".join(["word"] * int(m[1])), page)

    return [read_blocks(fill(p)) for p in (LABELLED_PAGES if pages is None else pages)]


def train(pages: list[str] | None = None) -> Node:
    """The decision tree of labelled pages (a small table: it is fitted on the driver)."""
    blocks = labelled_blocks(pages)
    x = np.vstack([features(b) for b in blocks])
    y = np.array([b.label for page in blocks for b in page], float)
    return grow(x, y)


def main_text(page: str | None, tree: Node) -> str:
    blocks = read_blocks(page)
    keep = classify(tree, features(blocks))
    return "\n".join(b.text for b, k in zip(blocks, keep) if k)


def extract(pages: DataFrame, tree: Node | None = None, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every page; a narrow pass without shuffle."""
    tree = train() if tree is None else tree
    rows = pages.select(col(id_col).alias("page_id"), col(url_col).cast("string").alias("url"), col(html_col).cast("string").alias("html"))

    def make():
        def one(page_id, url, page):
            text = main_text(page, tree)
            yield page_id, url, text, len(text)

        return one

    kind = rows.schema["page_id"].dataType.simpleString()
    return map_rows(rows, make, f"page_id {kind}, url string, text string, n_chars long", batch_rows=1000)


def block_table(pages: DataFrame, tree: Node | None = None, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Every block of every page with its word count, link density and verdict, to look at or to label."""
    tree = train() if tree is None else tree
    rows = pages.select(col(id_col).alias("page_id"), col(html_col).cast("string").alias("html"))

    def make():
        def one(page_id, page):
            blocks = read_blocks(page)
            for n, (b, main) in enumerate(zip(blocks, classify(tree, features(blocks)))):
                yield page_id, n, b.text, b.words, b.linked / b.words, bool(main)

        return one

    kind = rows.schema["page_id"].dataType.simpleString()
    return map_rows(rows, make, f"page_id {kind}, block int, text string, words int, link_density double, main boolean", 1000)
