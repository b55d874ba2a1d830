"""Main text of web pages by minimum-cut labelling of their blocks.

A page is cut into blocks, the runs of text between block-level tags. A classifier of marks in the
ancestors, link density and length gives each block a score. Positive scores become capacities
from the source (content), negative ones to the sink (boilerplate). Edges between neighbours in
page order and between blocks of one parent make different labels cost something, so a short line
between paragraphs goes with them. The blocks that the maximum flow leaves reachable from the
source are the text.

Spark deals out the pages; a page is handled on its own. Each page has about twice as many edges
as blocks, so long ones stay in proportion.

Nulls and edge cases: a null or empty page and one without content have an empty text. Broken
markup is read as far as it goes: unclosed tags end with their parent, stray end tags are ignored.
Rows that repeat give equal rows. Other columns are ignored.
"""

from __future__ import annotations

import re
import sys
from collections import deque
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Executors get the functions of this module by value and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# How tags are read, and the words that mark boilerplate and content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset(
    "script style head title template noscript iframe object svg math canvas audio video "
    "select option textarea button datalist".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter "
    "output progress q rp rt ruby s samp small span strike strong sub sup td th time tt u var wbr".split()
)
CLOSED_BY = {
    "p": frozenset(
        "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr "
        "main nav ol p pre section table ul".split()
    ),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
}
BOILERPLATE_TAGS = frozenset("nav header footer aside form menu dialog fieldset".split())
CONTENT_TAGS = frozenset("article main".split())
BOILERPLATE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu "
    "menubar toolbar".split()
)
BOILERPLATE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner promo promotion sponsor "
    "sponsored menu nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar sidebar "
    "aside rail widget cookie cookies consent gdpr notice notices notification alert popup modal "
    "overlay newsletter subscribe subscription signup signin login register share sharing social "
    "related recommended recommendations comment comments commentlist disqus reply replies respond "
    "discussion pagination pager tags toolbar search copyright legal disclaimer skip hidden "
    "teaser form".split()
)
CONTENT_WORDS = frozenset("article content main post entry story body text page prose".split())
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

# Scores of the classifier. Marks outweigh all edges of a block, lengths do not.
MARKED = -40.0
IN_CONTENT = 8.0
LONG, SHORT, LINKED, HEADING = 2.5, -1.0, -4.0, 0.5
LONG_CHARS, SHORT_CHARS = 60, 25
NEXT, SIBLING = 1.0, 0.6


class Node(NamedTuple):
    tag: str
    marked: bool  # boilerplate by itself or an ancestor
    content: bool  # within an article, and no boilerplate
    unseen: bool
    number: int


class Block(NamedTuple):
    text: str
    linked: int  # characters inside links
    tag: str
    parent: int
    marked: bool
    content: bool


def _words(attrs: list[tuple[str, str | None]]) -> set[str]:
    named = " ".join(v for k, v in attrs if k in ("class", "id") and v)
    return {w.lower() for w in _TOKEN.findall(named)}


class _Blocks(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open = [Node("", False, False, False, 0)]
        self.seen = 0
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked = 0
        self.links = 0

    def flush(self) -> None:
        if text := " ".join("".join(self.parts).split()):
            outer = next(n for n in reversed(self.open) if n.tag not in INLINE)
            parent = self.open[max(self.open.index(outer) - 1, 0)]
            top = self.open[-1]
            self.blocks.append(
                Block(text, self.linked, outer.tag, parent.number, top.marked, top.content)
            )
        self.parts, self.linked = [], 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID:
            self.parts.append(" ") if tag in INLINE else self.flush()
            return
        self._close_implied(tag)
        above = self.open[-1]
        marked, content = above.marked, above.content
        given = dict(attrs)
        words = _words(attrs) if attrs else set()
        plain = tag not in ("html", "body")
        role = (given.get("role") or "").lower()
        bad = (
            tag in BOILERPLATE_TAGS
            or role in BOILERPLATE_ROLES
            or "hidden" in given
            or given.get("aria-hidden") == "true"
            or bool(_HIDDEN.search(given.get("style") or ""))
        )
        if plain and (bad or (words & BOILERPLATE_WORDS and not self._is_article(tag, words))):
            marked = True
        if tag in CONTENT_TAGS or role in ("main", "article") or (plain and words & CONTENT_WORDS):
            content = True
        # A mark splits a block from its surroundings even on an inline tag.
        if tag not in INLINE or marked != above.marked:
            self.flush()
        elif tag in ("td", "th"):
            self.parts.append(" ")
        self.seen += 1
        self.links += tag == "a"
        self.open.append(
            Node(tag, marked, content and not marked, above.unseen or tag in UNSEEN, self.seen)
        )

    @staticmethod
    def _is_article(tag: str, words: set[str]) -> bool:
        return tag in CONTENT_TAGS and not words & {"comment", "comments", "ad", "ads", "reply"}

    def _close_implied(self, tag: str) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            name = self.open[at].tag
            if tag in CLOSED_BY.get(name, ()):
                self._close(at)
                return
            if name not in INLINE and name not in CLOSED_BY:
                return

    def _close(self, at: int) -> None:
        outside = self.open[at - 1]
        gone = self.open[at:]
        if any(n.tag not in INLINE for n in gone) or gone[-1].marked != outside.marked:
            self.flush()
        self.links -= sum(n.tag == "a" for n in gone)
        del self.open[at:]

    def handle_endtag(self, tag: str) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag == tag:
                self._close(at)
                return

    def handle_data(self, data: str) -> None:
        if not self.open[-1].unseen:
            self.parts.append(data)
            if self.links:
                self.linked += len(data.strip())


def page_blocks(html: str) -> list[Block]:
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    parser.flush()
    return parser.blocks


def block_score(block: Block) -> float:
    """Above zero: content."""
    if block.marked:
        return MARKED
    length = len(block.text)
    score = LONG if length >= LONG_CHARS else SHORT if length < SHORT_CHARS else 0.0
    if block.linked > 0.5 * length:
        score += LINKED
    if block.tag in ("h1", "h2", "h3"):
        score += HEADING
    return score + IN_CONTENT * block.content


def neighbour_edges(blocks: list[Block]) -> Iterator[tuple[int, int, float]]:
    """Each block with the next one, and with the next one of the same parent."""
    last: dict[int, int] = {}
    for i, block in enumerate(blocks):
        if i:
            yield i - 1, i, NEXT
        before = last.get(block.parent)
        if before is not None:
            yield before, i, SIBLING
        last[block.parent] = i


def min_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Whether each block is on the source's side of the minimum cut.

    Augments along shortest paths, found level by level from all blocks with capacity left.
    """
    n = len(scores)
    supply = [max(s, 0.0) for s in scores]
    demand = [max(-s, 0.0) for s in scores]
    heads: list[list[int]] = [[] for _ in range(n)]
    to: list[int] = []
    room: list[float] = []
    for a, b, weight in edges:
        heads[a].append(len(to))
        heads[b].append(len(to) + 1)
        to += (b, a)
        room += (weight, weight)
    while True:
        level = [0 if supply[v] > 1e-9 else -1 for v in range(n)]
        queue = deque(v for v in range(n) if not level[v])
        found = False
        while queue:
            v = queue.popleft()
            found = found or demand[v] > 1e-9
            for e in heads[v]:
                if room[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[v] + 1
                    queue.append(to[e])
        if not found:
            return [x >= 0 for x in level]
        tried = [0] * n
        for source in range(n):
            while supply[source] > 1e-9:
                path: list[int] = []
                v = source
                while demand[v] <= 1e-9:
                    while tried[v] < len(heads[v]):
                        e = heads[v][tried[v]]
                        if room[e] > 1e-9 and level[to[e]] == level[v] + 1:
                            break
                        tried[v] += 1
                    if tried[v] < len(heads[v]):
                        path.append(heads[v][tried[v]])
                        v = to[path[-1]]
                    elif path:
                        v = to[path.pop() ^ 1]
                        tried[v] += 1
                    else:
                        break
                if demand[v] <= 1e-9:
                    break
                pushed = min([supply[source], demand[v], *(room[e] for e in path)])
                supply[source] -= pushed
                demand[v] -= pushed
                for e in path:
                    room[e] -= pushed
                    room[e ^ 1] += pushed


def main_text(html: str | None) -> str:
    blocks = page_blocks(html or "")
    kept = min_cut([block_score(b) for b in blocks], list(neighbour_edges(blocks)))
    return "\n".join(block.text for block, keep in zip(blocks, kept, strict=True) if keep)


@F.pandas_udf(StringType())
def _main_texts(pages: pd.Series) -> pd.Series:
    return pages.map(main_text, na_action=None)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    texts = pages.select("page_id", "url", _main_texts("html").alias("text"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def op2_main_text(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
