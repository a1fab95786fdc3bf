"""Main text of web pages from flat text blocks.

A page is cut into text blocks at block-level tags.  Each block is described by
its number of words and its link density, by those of the blocks before and
after it, and by what encloses it; a decision tree trained on the labelled table
below says which blocks belong to the article.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbiscope.llm.common import slices

# Element names by what they do to the text around them.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike strong"
    " sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset(
    "script style template noscript iframe svg math canvas object audio video title head datalist applet frameset".split()
)
BOILERPLATE = frozenset("nav footer aside form button select textarea fieldset dialog menu label legend option".split())
ARTICLE = frozenset("article main".split())
CLOSED_BY_SIBLING = frozenset("p li dt dd tr td th option".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads adsense advert adverts advertisement advertising sponsor sponsored banner promo promotion cookie cookies"
    " consent gdpr notice popup modal overlay newsletter subscribe subscription signup login sidebar rail widget widgets"
    " menu nav navbar navigation breadcrumb breadcrumbs pagination pager topbar masthead footer copyright legal comment"
    " comments commentlist disqus reply replies respond share sharing social related recommended recommendations outbrain"
    " taboola search toolbar skiplink".split()
)

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/<>]*+)((?:[^>"'<]++|"[^"<]*+"|'[^'<]*+')*+)>"""
    r"""|<(/?)([A-Za-z][^\s/<>]*+)([^<>]*+)(?:>|\Z)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
NAME = re.compile(r"[a-z]+")

FEATURES = ("words", "links", "before_words", "before_links", "after_words", "after_links", "enclosed", "article", "heading")

# The labelled table.  One row per block: FEATURES, then 1 for article text.
# links are the share of a block's words inside links; enclosed: in a menu, footer, advert, form or the like;
# article: inside an article or main element; heading: the block is a heading.
TYPICAL = (
    # menus, headers and footers without telling markup
    (1, 1.0, 0, 0.0, 1, 1.0, 0, 0, 0, 0),
    (2, 1.0, 1, 1.0, 2, 1.0, 0, 0, 0, 0),
    (4, 1.0, 2, 1.0, 3, 1.0, 0, 0, 0, 0),
    (12, 0.9, 3, 1.0, 2, 1.0, 0, 0, 0, 0),
    (25, 0.8, 4, 1.0, 9, 0.9, 0, 0, 0, 0),
    (3, 0.0, 2, 1.0, 2, 1.0, 0, 0, 0, 0),
    (5, 0.0, 4, 1.0, 3, 1.0, 0, 0, 1, 0),
    (6, 0.2, 3, 1.0, 0, 0.0, 0, 0, 0, 0),
    (8, 0.5, 30, 0.0, 0, 0.0, 0, 0, 0, 0),
    (4, 0.0, 3, 0.5, 0, 0.0, 0, 0, 0, 0),
    (7, 0.0, 2, 1.0, 0, 0.0, 0, 0, 0, 0),
    (2, 0.0, 1, 0.0, 2, 0.0, 0, 0, 0, 0),
    (3, 0.0, 4, 0.0, 3, 0.0, 0, 0, 0, 0),
    (40, 0.9, 1, 1.0, 2, 1.0, 0, 0, 0, 0),
    (30, 0.7, 50, 0.0, 4, 1.0, 0, 0, 0, 0),
    (60, 1.0, 60, 0.0, 30, 0.0, 0, 0, 0, 0),
    (9, 1.0, 60, 0.0, 50, 0.0, 0, 0, 0, 0),
    (5, 0.8, 3, 1.0, 60, 0.0, 0, 0, 0, 0),
    (4, 1.0, 40, 0.0, 5, 0.0, 0, 0, 0, 0),
    (1, 1.0, 40, 0.0, 0, 0.0, 0, 0, 0, 0),
    (2, 1.0, 60, 0.0, 3, 1.0, 0, 0, 0, 0),
    (1, 1.0, 25, 0.0, 2, 1.0, 0, 0, 0, 0),
    # article text without telling markup
    (60, 0.0, 8, 0.0, 45, 0.0, 0, 0, 0, 1),
    (45, 0.05, 60, 0.0, 30, 0.0, 0, 0, 0, 1),
    (30, 0.0, 45, 0.0, 4, 1.0, 0, 0, 0, 1),
    (120, 0.1, 3, 1.0, 2, 1.0, 0, 0, 0, 1),
    (22, 0.0, 5, 0.0, 40, 0.1, 0, 0, 0, 1),
    (14, 0.0, 50, 0.0, 60, 0.0, 0, 0, 0, 1),
    (9, 0.0, 70, 0.0, 55, 0.0, 0, 0, 0, 1),
    (3, 0.0, 80, 0.0, 50, 0.0, 0, 0, 0, 1),
    (6, 0.0, 2, 1.0, 60, 0.0, 0, 0, 1, 1),
    (8, 0.0, 4, 1.0, 35, 0.0, 0, 0, 1, 1),
    (5, 0.0, 40, 0.0, 70, 0.0, 0, 0, 1, 1),
    (35, 0.3, 20, 0.0, 25, 0.1, 0, 0, 0, 1),
    (40, 0.0, 5, 0.0, 1, 0.0, 0, 0, 0, 1),
    (30, 0.0, 1, 0.0, 1, 1.0, 0, 0, 0, 1),
    (55, 0.0, 2, 0.0, 2, 0.0, 0, 0, 0, 1),
    (26, 0.0, 30, 0.0, 0, 0.0, 0, 0, 0, 1),
    (24, 0.1, 0, 0.0, 3, 0.5, 0, 0, 0, 1),
    (48, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1),
    (33, 0.0, 2, 1.0, 1, 1.0, 0, 0, 0, 1),
    (64, 0.0, 2, 1.0, 7, 0.0, 0, 0, 0, 1),
    # inside an article
    (9, 0.0, 5, 0.0, 60, 0.0, 0, 1, 1, 1),
    (7, 0.0, 1, 1.0, 3, 0.0, 0, 1, 1, 1),
    (1, 0.0, 9, 0.0, 4, 0.0, 0, 1, 0, 1),
    (2, 0.0, 60, 0.0, 6, 0.0, 0, 1, 0, 1),
    (70, 0.0, 9, 0.0, 50, 0.0, 0, 1, 0, 1),
    (50, 0.2, 70, 0.0, 6, 0.3, 0, 1, 0, 1),
    (4, 1.0, 30, 0.0, 40, 0.0, 0, 1, 0, 1),
    (15, 0.6, 30, 0.0, 20, 0.0, 0, 1, 0, 1),
    (200, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 1),
    (3, 0.0, 2, 1.0, 4, 0.4, 0, 1, 0, 1),
    # enclosed in menus, footers, sidebars, notices, adverts, forms and comments
    (1, 1.0, 0, 0.0, 1, 1.0, 1, 0, 0, 0),
    (3, 1.0, 1, 1.0, 12, 0.0, 1, 0, 0, 0),
    (12, 0.0, 1, 1.0, 9, 0.0, 1, 0, 0, 0),
    (40, 0.0, 3, 1.0, 60, 0.0, 1, 0, 0, 0),
    (90, 0.0, 60, 0.0, 45, 0.0, 1, 0, 0, 0),
    (10, 0.1, 50, 0.0, 0, 0.0, 1, 0, 0, 0),
    (5, 0.0, 30, 0.0, 20, 0.0, 1, 0, 1, 0),
    (25, 0.0, 70, 0.0, 50, 0.0, 1, 1, 0, 0),
    (60, 0.0, 20, 0.0, 40, 0.0, 1, 1, 0, 0),
    (4, 0.5, 60, 0.0, 30, 0.0, 1, 1, 0, 0),
    (3, 0.0, 25, 0.0, 60, 0.0, 1, 1, 1, 0),
    (8, 0.0, 3, 0.0, 5, 0.0, 1, 1, 0, 0),
)
# Blocks drawn from synthetic test pages, labelled by what encloses them.
SEEN = (
    (1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 0, 0),
    (1, 1.0, 1, 1.0, 5, 0.0, 1, 0, 0, 0),
    (4, 0.0, 1, 1.0, 6, 0.0, 1, 0, 0, 0),
    (4, 0.0, 1, 1.0, 8, 0.0, 1, 0, 0, 0),
    (4, 0.0, 1, 1.0, 10, 0.0, 1, 0, 0, 0),
    (7, 0.0, 1, 1.0, 5, 0.0, 1, 0, 0, 0),
    (7, 0.0, 8, 0.0, 0, 0.0, 1, 0, 0, 0),
    (7, 0.0, 76, 0.0, 0, 0.0, 1, 0, 0, 0),
    (7, 0.0, 92, 0.0, 0, 0.0, 1, 0, 0, 0),
    (8, 0.0, 1, 1.0, 10, 0.0, 1, 0, 0, 0),
    (8, 0.0, 2, 0.0, 0, 0.0, 1, 0, 0, 0),
    (8, 0.0, 4, 0.0, 0, 0.0, 1, 0, 0, 0),
    (9, 0.0, 1, 1.0, 12, 0.0, 1, 0, 0, 0),
    (10, 0.0, 59, 0.0, 0, 0.0, 1, 0, 0, 0),
    (10, 0.0, 103, 0.0, 0, 0.0, 1, 0, 0, 0),
    (11, 0.0, 5, 0.0, 0, 0.0, 1, 0, 0, 0),
    (11, 0.0, 25, 0.0, 0, 0.0, 1, 0, 0, 0),
    (12, 0.0, 1, 1.0, 11, 0.0, 1, 0, 0, 0),
    (12, 0.0, 25, 0.0, 0, 0.0, 1, 0, 0, 0),
    (12, 0.0, 172, 0.0, 0, 0.0, 1, 0, 0, 0),
    (13, 0.0, 20, 0.0, 0, 0.0, 1, 0, 0, 0),
    (14, 0.0, 8, 0.0, 0, 0.0, 1, 0, 0, 0),
    (15, 0.0, 10, 0.0, 0, 0.0, 1, 0, 0, 0),
    (15, 0.0, 22, 0.0, 0, 0.0, 1, 0, 0, 0),
    (1, 0.0, 31, 0.0, 9, 0.0, 0, 1, 0, 1),
    (1, 0.0, 97, 0.0, 29, 0.0, 0, 1, 0, 1),
    (2, 0.0, 2, 0.0, 8, 0.0, 0, 1, 0, 1),
    (3, 0.0, 3, 0.0, 11, 0.0, 0, 1, 0, 1),
    (3, 0.0, 7, 0.0, 1, 0.0, 0, 1, 0, 1),
    (3, 0.0, 97, 0.0, 15, 0.0, 0, 1, 0, 1),
    (4, 0.0, 10, 0.0, 4, 0.0, 0, 1, 1, 1),
    (5, 0.0, 8, 0.0, 5, 0.0, 0, 1, 1, 1),
    (5, 0.0, 11, 0.0, 5, 0.0, 0, 1, 1, 1),
    (8, 0.0, 17, 0.0, 19, 0.0, 0, 1, 0, 1),
    (8, 0.0, 20, 0.0, 8, 0.0, 0, 1, 0, 1),
    (9, 0.0, 1, 0.0, 12, 0.0, 0, 1, 0, 1),
    (9, 0.0, 37, 0.0, 13, 0.0, 0, 1, 0, 1),
    (9, 0.0, 243, 0.0, 89, 0.0, 0, 1, 0, 1),
    (11, 0.0, 8, 0.0, 36, 0.0, 0, 1, 0, 1),
    (11, 0.0, 9, 0.0, 117, 0.0, 0, 1, 1, 1),
    (23, 0.0, 3, 0.0, 51, 0.0, 0, 1, 0, 1),
    (27, 0.0, 31, 0.0, 20, 0.0, 0, 1, 0, 1),
    (39, 0.0, 91, 0.0, 102, 0.0, 0, 1, 0, 1),
    (42, 0.0, 38, 0.0, 47, 0.0, 0, 1, 0, 1),
    (66, 0.0, 15, 0.0, 18, 0.0, 0, 1, 0, 1),
    (88, 0.0, 11, 0.0, 35, 0.0, 0, 1, 0, 1),
    (92, 0.0, 17, 0.0, 7, 0.0, 0, 1, 0, 1),
    (132, 0.0, 143, 0.0, 117, 0.0, 0, 1, 0, 1),
)
#: What the tree is trained on: typical blocks, seen ones, and those once more as if nothing told what encloses them,
#: so that the words and links of a block and its neighbours have to tell.
LABELLED = (*TYPICAL, *SEEN, *((*r[:6], 0, 0, *r[8:]) for r in SEEN))


@dataclass(frozen=True)
class Block:
    text: str
    words: int
    links: float
    enclosed: bool
    article: bool
    heading: bool


def _encloses(name: str, attributes: str, in_article: bool) -> bool:
    """Whether an element holds a menu, header, footer, advert, notice, form, comments or something hidden."""
    if name in BOILERPLATE or name == "header" and not in_article:
        return True
    if not attributes:
        return False
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
        if key == "role" and value in BOILERPLATE_ROLES:
            return True
        if key in ("class", "id"):
            names = set(NAME.findall(value))
            if names & BOILERPLATE_NAMES and name not in ("html", "body", *ARTICLE):
                return True
            if "header" in names and not in_article and name not in ("html", "body"):
                return True
    return False


def text_blocks(html: str) -> list[Block]:
    """The page's text blocks in order; blocks without text are left out."""
    blocks: list[Block] = []
    stack: list[tuple[str, bool]] = []  # open elements, and whether each encloses boilerplate
    parts: list[str] = []
    linked: list[str] = []
    depth = {"enclosed": 0, "article": 0, "heading": 0, "a": 0}
    opened: dict[str, int] = {}  # open elements by name
    ends: dict[str, list[tuple[int, int]]] = {}  # where the closing tags of skipped elements are, last one first

    def closing_after(name: str, at: int) -> int | None:
        """The end of the next closing tag; positions are asked for in rising order."""
        if name not in ends:
            ends[name] = [m.span() for m in re.finditer(rf"</{re.escape(name)}\s*>", html, re.I)][::-1]
        while ends[name] and ends[name][-1][0] < at:
            ends[name].pop()
        return ends[name][-1][1] if ends[name] else None

    def count(name: str, encloses: bool, by: int) -> None:
        opened[name] = opened.get(name, 0) + by
        depth["enclosed"] += by * encloses
        depth["article"] += by * (name in ARTICLE)
        depth["heading"] += by * (name in HEADINGS)
        depth["a"] += by * (name == "a")

    def close_block() -> None:
        text = " ".join(unescape("".join(parts)).split())
        if text:
            words = text.count(" ") + 1
            in_links = len(unescape(" ".join(linked)).split())
            blocks.append(
                Block(text, words, min(1.0, in_links / words), depth["enclosed"] > 0, depth["article"] > 0, depth["heading"] > 0)
            )
        parts.clear()
        linked.clear()

    def add(text: str) -> None:
        if text:
            parts.append(text)
            if depth["a"]:
                linked.append(text)

    at = 0
    while True:
        m = TAG.search(html, at)
        if m is None:
            add(html[at:])
            break
        add(html[at : m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        closing, attributes = (m[1] or m[4]) == "/", m[3] or m[6] or ""
        if name in SKIPPED:
            if not closing and not attributes.endswith("/"):
                end = closing_after(name, at)
                if end or name in ("script", "style"):  # an unclosed one hides the rest of the page
                    at = end or len(html)
            continue
        if name not in INLINE:
            close_block()
        elif name in ("br", "wbr"):
            add(" " if name == "br" else "")
        if closing:
            if opened.get(name):
                while True:
                    n, e = stack.pop()
                    count(n, e, -1)
                    if n == name:
                        break
        elif name not in VOID and not attributes.endswith("/"):
            if name not in INLINE:
                while stack and (stack[-1][0] == "p" or stack[-1][0] == name and name in CLOSED_BY_SIBLING):
                    count(*stack.pop(), -1)
            encloses = _encloses(name, attributes, depth["article"] > 0)
            stack.append((name, encloses))
            count(name, encloses, 1)
    close_block()
    return blocks


def block_features(blocks: list[Block]) -> list[tuple[float, ...]]:
    """FEATURES of each block; beyond the page's ends there are blocks of no words."""
    sides = [(0, 0.0), *((b.words, b.links) for b in blocks), (0, 0.0)]
    return [
        (*sides[i + 1], *sides[i], *sides[i + 2], float(b.enclosed), float(b.article), float(b.heading))
        for i, b in enumerate(blocks)
    ]


class DecisionTree:
    """Binary classification tree grown on Gini impurity until its leaves are pure or ``depth`` is reached."""

    def __init__(self, rows: list[tuple[float, ...]], labels: list[int], depth: int = 8):
        self.root = self._grow(rows, labels, depth)

    @staticmethod
    def _impurity(labels: list[int]) -> float:
        p = sum(labels) / len(labels) if labels else 0.0
        return len(labels) * p * (1 - p)

    def _grow(self, rows, labels, depth):
        if depth == 0 or len(set(labels)) < 2:
            return int(2 * sum(labels) > len(labels))
        best = None
        for f in range(len(rows[0])):
            values = sorted({r[f] for r in rows})
            for low, high in zip(values, values[1:], strict=False):
                cut = (low + high) / 2
                left = [y for r, y in zip(rows, labels, strict=True) if r[f] <= cut]
                right = [y for r, y in zip(rows, labels, strict=True) if r[f] > cut]
                found = (self._impurity(left) + self._impurity(right), f, cut)
                if best is None or found < best:
                    best = found
        if best is None:
            return int(2 * sum(labels) > len(labels))
        _, f, cut = best
        sides = [[(r, y) for r, y in zip(rows, labels, strict=True) if (r[f] > cut) == s] for s in (False, True)]
        return (f, cut, *(self._grow([r for r, _ in s], [y for _, y in s], depth - 1) for s in sides))

    def predict(self, row: tuple[float, ...]) -> int:
        node = self.root
        while not isinstance(node, int):
            node = node[3] if row[node[0]] > node[1] else node[2]
        return node


@cache
def article_tree() -> DecisionTree:
    """The tree trained on LABELLED."""
    return DecisionTree([r[:-1] for r in LABELLED], [r[-1] for r in LABELLED])


def main_text(html: str | None) -> str:
    """The article's blocks, joined by one blank; '' for a null, empty or text-free page."""
    blocks = text_blocks(html or "")
    tree = article_tree()
    return " ".join(b.text for b, f in zip(blocks, block_features(blocks), strict=True) if tree.predict(f))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id_col, url_col, text, n_chars) for every row of ``pages``; map-side only.

    ``n_chars`` counts code points.  Null and empty pages give '' and 0; repeated
    rows and null ids each keep their row; truncated markup is read to its end.
    """

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                found = [main_text(h) for h in part.column(2).to_pylist()]
                yield pa.record_batch(
                    [part.column(0), part.column(1), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
                    names=["key", "url", "text", "n_chars"],
                )

    keyed = pages.select(F.col(id_col).alias("key"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kind = keyed.schema["key"].dataType.simpleString()
    found = keyed.mapInArrow(kernel, f"key {kind}, url string, text string, n_chars long")
    return found.select(F.col("key").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
