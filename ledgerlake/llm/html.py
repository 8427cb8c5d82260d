"""Main text of web pages by minimum-cut labelling.

A page is cut into text blocks. A linear classifier over a block's own
evidence (its containers, class and id names, link share, length) gives the
cost of calling it content or boilerplate: the capacities to the two
terminals. Neighbours in page order, and blocks under the same parent element,
are joined by smoothness edges. The maximum flow's cut labels the blocks.

The classifier's weights are fixed parameters: no table labels blocks.

Edge cases: a null or empty page, and a page without content, give an empty
text; a page cut off in a tag, comment or script ends there; text outside any
element is a block of its own; repeated rows are extracted separately; an empty
table gives an empty table; a block whose cut costs the same on either side is
boilerplate. Pages are read one at a time, whole, in time that grows with the page.
Columns are selected by name, extra ones never clash.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlake.llm.common import prepare

# HTML element names.
RAW = "script|style|title|textarea|noscript|template|iframe|svg|math|select|object|canvas"
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd",
         "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure",
         "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr",
         "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table",
         "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
# A start tag of the key ends an open element of the value (an end tag may be left out).
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
        "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
PROSE = HEADINGS | {"p", "blockquote", "pre", "li", "td", "dd", "figcaption"}
BOILERPLATE_TAGS = {"nav", "footer", "aside", "form", "button", "menu", "dialog", "header",
                    "fieldset", "head"}
CONTENT_TAGS = {"article", "main"}
BOILERPLATE_NAMES = set("""ad ads adv advert advertisement adverts advertising banner breadcrumb
    breadcrumbs byline comment comments consent cookie cookies copyright dialog disclaimer disqus
    footer gdpr header login masthead menu modal nav navbar navigation newsletter notice overlay
    pager pagination popup promo promotion recommended related replies reply rss search share
    sharing sidebar signup social sponsor sponsored subscribe subscription tags toolbar topbar
    widget""".split())
CONTENT_NAMES = {"article", "articlebody", "body", "content", "entry", "main", "post", "story",
                 "text"}
BOILERPLATE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog",
                     "alert", "alertdialog", "menu", "menubar", "toolbar", "form"}

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>",
    re.S | re.I)
ATTR = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass(frozen=True)
class Weights:
    """Of the classifier's evidence, and of the smoothness edges."""

    bias: float = 0.3
    boilerplate_tag: float = -6.0
    boilerplate_name: float = -6.0
    hidden: float = -6.0
    content_tag: float = 3.0
    content_name: float = 1.5
    prose: float = 1.0
    per_words: float = 0.05
    most_words: float = 2.0
    links: float = -4.0
    next_block: float = 0.4
    same_parent: float = 0.4


@dataclass
class Block:
    """A block's text, and the evidence about it."""

    parent: int
    tags: frozenset
    score: float
    text: str = ""
    words: int = 0
    link_words: int = 0
    parts: list[tuple[str, bool]] = field(default_factory=list)


def _element_score(tag: str, attrs: str, inside: frozenset, w: Weights) -> float:
    """Evidence of one container about all blocks inside it."""
    s = 0.0
    if tag in BOILERPLATE_TAGS and not (tag == "header" and inside & CONTENT_TAGS):
        s += w.boilerplate_tag
    if tag in CONTENT_TAGS:
        s += w.content_tag
    if attrs.strip(" \t\n\r\f/"):
        for name, value in ATTR.findall(attrs):
            name, value = name.lower(), value.strip("\"'")
            if name in ("class", "id"):
                parts = {p.lower() for p in NAME.findall(value)}
                if parts & BOILERPLATE_NAMES and not (tag in CONTENT_TAGS or tag in ("body", "html")):
                    s += w.boilerplate_name
                elif parts & CONTENT_NAMES:
                    s += w.content_name
            elif name == "role" and value.lower() in BOILERPLATE_ROLES:
                s += w.boilerplate_name
            elif name == "role" and value.lower() in ("main", "article"):
                s += w.content_tag
            elif (name == "hidden" or name == "aria-hidden" and value.lower() == "true"
                  or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden",
                                                   value, re.I)):
                s += w.hidden
    return s


def blocks(page: str, w: Weights = Weights()) -> list[Block]:
    """The page's text blocks in order."""
    out: list[Block] = []
    # open elements: tag, own number, evidence so far, tags so far, inside a link, and the place
    # in the stack of the innermost block element
    stack: list[tuple[str, int, float, frozenset, bool, int]] = [
        ("", 0, 0.0, frozenset(), False, 0)]
    opened: Counter[str] = Counter()
    number, block = 0, None

    def close(upto: int) -> None:
        opened.subtract(e[0] for e in stack[upto:])
        del stack[upto:]

    def text(s: str) -> None:
        nonlocal block
        if not s:
            return
        if block is None:
            if not s.strip():
                return
            holder = stack[-1][5]
            above = stack[stack[holder - 1][5]] if holder else stack[0]
            block = Block(above[1], stack[-1][3], stack[-1][2])
            out.append(block)
        block.parts.append((s, stack[-1][4]))

    at = 0
    for m in TOKEN.finditer(page):
        text(page[at:m.start()])
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if m["end"]:
            if opened[tag] > 0:
                k = len(stack) - 1
                while stack[k][0] != tag:
                    k -= 1
                close(k)
            if tag in BLOCK:
                block = None
            continue
        if tag == "br":
            text(" ")
            continue
        if tag in BLOCK:
            block = None
            # a block's start ends an open paragraph and what was opened in it
            if stack[stack[-1][5]][0] == "p":
                close(stack[-1][5])
            ended = ENDS.get(tag)
            if ended and stack[-1][0] in ended:
                close(len(stack) - 1)
        if tag in VOID or m["attrs"].endswith("/"):
            continue
        _, _, score, tags, link, holder = stack[-1]
        number += 1
        opened[tag] += 1
        stack.append((tag, number, score + _element_score(tag, m["attrs"], tags, w),
                      tags | {tag}, link or tag == "a",
                      len(stack) if tag in BLOCK else holder))
    rest = page[at:]
    cut = re.search(r"<[a-zA-Z/!?][^>]*\Z", rest)
    text(rest[:cut.start()] if cut else rest)
    for b in out:
        b.text = " ".join(html.unescape("".join(p for p, _ in b.parts)).split())
        b.words = len(b.text.split())
        b.link_words = sum(len(html.unescape(p).split()) for p, link in b.parts if link)
    return [b for b in out if b.text]


def evidence(b: Block, w: Weights) -> float:
    """Log odds that the block is content."""
    return (w.bias + b.score + (w.prose if b.tags & PROSE else 0.0)
            + min(w.most_words, w.per_words * b.words)
            + w.links * min(1.0, b.link_words / max(1, b.words)))


TINY = 1e-9


def min_cut(odds: list[float], edges: dict[tuple[int, int], float]) -> list[bool]:
    """Which nodes stay with the source: capacities are the odds, edges work both ways.

    Blocking flows over level graphs: each round sends flow along all shortest paths at
    once, so there are as many rounds as path lengths, which the small edges keep
    few, not as many as paths. What the source still reaches at the end is content.
    """
    n = len(odds)
    supply, demand = [max(0.0, x) for x in odds], [max(0.0, -x) for x in odds]
    to: list[list[int]] = [[] for _ in range(n)]  # arcs of a node: numbers into the three below
    head, left = [], []
    for (i, j), c in edges.items():
        to[i].append(len(head))
        to[j].append(len(head) + 1)
        head += [j, i]
        left += [c, c]
    while True:
        level, queue, found = [-1] * n, [], -1
        for i in range(n):
            if supply[i] > TINY:
                level[i] = 0
                queue.append(i)
        for i in queue:
            if demand[i] > TINY and found < 0:
                found = level[i]
            if 0 <= found <= level[i]:
                continue  # farther nodes are no part of a shortest path
            for a in to[i]:
                if left[a] > TINY and level[head[a]] < 0:
                    level[head[a]] = level[i] + 1
                    queue.append(head[a])
        if found < 0:
            return [x >= 0 for x in level]
        at = [0] * n
        for source in range(n):
            while supply[source] > TINY:
                path, i = [], source
                while True:
                    if level[i] == found and demand[i] > TINY:
                        break
                    arcs = to[i]
                    while at[i] < len(arcs) and not (
                            left[arcs[at[i]]] > TINY
                            and level[head[arcs[at[i]]]] == level[i] + 1 <= found):
                        at[i] += 1
                    if at[i] < len(arcs):
                        path.append(arcs[at[i]])
                        i = head[arcs[at[i]]]
                    elif path:  # a dead end: step back and past it
                        i = head[path.pop() ^ 1]
                        at[i] += 1
                    else:
                        i = -1
                        break
                if i < 0 or level[source]:
                    break
                flow = min([supply[source], demand[i], *(left[a] for a in path)])
                supply[source] -= flow
                demand[i] -= flow
                for a in path:
                    left[a] -= flow
                    left[a ^ 1] += flow


def extract(page: str, w: Weights = Weights()) -> str:
    """The main text: content blocks in page order, joined by a blank line."""
    found = blocks(page, w)
    odds = [evidence(b, w) for b in found]
    edges: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}
    for i, b in enumerate(found):
        if i:
            edges[(i - 1, i)] = edges.get((i - 1, i), 0.0) + w.next_block
        if b.parent in last:
            edges[(last[b.parent], i)] = edges.get((last[b.parent], i), 0.0) + w.same_parent
        last[b.parent] = i
    keep = min_cut(odds, edges)
    return "\n\n".join(b.text for b, k in zip(found, keep) if k)


def main_text(pages: DataFrame, weights: Weights = Weights()) -> DataFrame:
    """Rows page_id, url, text, n_chars."""
    prepare(pages.sparkSession)
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(h or "", weights) for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
