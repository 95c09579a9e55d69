"""Main text of web pages: flat text blocks classified by a decision tree.

A page is read as a sequence of text blocks, in order. A block's statistics are its word count and link
density and those of the blocks before and after it, and what it stands in: an article, a heading, or
something that its tag or class calls a menu, footer, advert and so on. A decision tree, trained on the
small table below, tells text from the rest.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

# What tags and words in class, id and role mean.
_UNREAD = frozenset("script style noscript template svg annotation iframe object select textarea button datalist canvas audio video map title".split())
_TO_THE_END = frozenset("script style title textarea".split())  # without an end tag, these take the rest of the page
_APART = frozenset("nav footer aside form dialog menu".split())
_ARTICLE = frozenset("article main".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_BLOCK = (
    frozenset(
        "address blockquote body caption center dd details div dl dt fieldset figcaption figure head header hgroup hr html li ol option p pre section summary table tbody tfoot thead tr ul".split()
    )
    | _APART
    | _ARTICLE
    | _HEADING
)
_VOID = frozenset("hr br img input meta link wbr area base col embed source track".split())
_APART_WORDS = frozenset(
    """ad ads adsense advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments consent
    cookie cookies copyright disqus footer form login masthead menu modal nav navbar navigation newsletter notice notices notification
    pager pagination popup promo promoted promotion recommended related replies respond search share sharing sidebar signup
    skip social sponsor sponsored subscribe toolbar widget widgets""".split()
)
_HEADER_WORDS = frozenset("header".split())
_ARTICLE_WORDS = frozenset("articlebody".split())
# In a name of several words, such a word says that the element is the text, or holds it, unless the last word says otherwise.
_CONTENT_WORDS = frozenset("article body content entry layout main page post story text".split())
_FORM = 0.5  # how far apart a form is that may be wrapped around a whole page

_OPENING = re.compile(r"<(?:(!--)|([!?])|(/?)([a-z][a-z0-9:-]*)|/)", re.IGNORECASE)
_STEP = re.compile(r"""=\s*(["'])|>""")
_END = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE) for name in _UNREAD}
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
_NAMING = frozenset("class id role itemprop".split())
_HIDING = re.compile(r"display\s*:\s*none", re.IGNORECASE)
# A class that begins so says what the element has or lacks, not what it is.
_MENTIONS = frozenset("has have with without no not hide hides show shows".split())
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

FEATURES = ("words", "density", "words_before", "density_before", "words_after", "density_after", "apart", "article", "heading")

# Labelled blocks: the features in order, then 1 for text and 0 for the rest.
LABELLED = (
    # in an article: long, short and single-word paragraphs, headings, lists, link lists
    (80, 0.0, 60, 0.0, 90, 0.0, 0, 1, 0, 1),
    (40, 0.1, 7, 0.0, 55, 0.0, 0, 1, 0, 1),
    (1, 0.0, 60, 0.0, 45, 0.0, 0, 1, 0, 1),
    (1, 0.0, 1, 0.0, 1, 0.0, 0, 1, 0, 1),
    (2, 0.0, 30, 0.0, 12, 0.0, 0, 1, 0, 1),
    (9, 0.0, 12, 0.0, 11, 0.0, 0, 1, 1, 1),
    (5, 0.0, 80, 0.0, 50, 0.0, 0, 1, 1, 1),
    (6, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 1),
    (12, 0.5, 40, 0.0, 40, 0.0, 0, 1, 0, 1),
    (4, 1.0, 60, 0.0, 50, 0.0, 0, 1, 0, 1),
    (3, 1.0, 2, 1.0, 50, 0.0, 0, 1, 0, 1),
    (120, 0.0, 0, 0.0, 4, 1.0, 0, 1, 0, 1),
    (8, 0.25, 3, 0.0, 2, 0.0, 0, 1, 0, 1),
    (2, 0.0, 8, 0.25, 1, 0.0, 0, 1, 0, 1),
    (1, 0.0, 2, 0.0, 2, 0.0, 0, 1, 0, 1),
    (2, 0.0, 1, 0.0, 1, 1.0, 0, 1, 0, 1),
    (3, 0.0, 1, 1.0, 8, 0.3, 0, 1, 1, 1),
    (11, 0.0, 4, 1.0, 0, 0.0, 0, 1, 0, 1),
    (4, 0.0, 12, 0.0, 11, 0.0, 0, 1, 0, 1),
    (2, 0.5, 3, 0.0, 4, 0.5, 0, 1, 0, 1),
    (7, 0.0, 2, 1.0, 2, 1.0, 0, 1, 0, 1),
    (20, 0.6, 15, 0.7, 12, 0.0, 0, 1, 0, 1),
    (4, 1.0, 6, 0.0, 5, 0.0, 0, 1, 0, 1),
    (5, 1.0, 30, 0.0, 3, 1.0, 0, 1, 0, 1),
    (1, 1.0, 0, 0.0, 9, 0.0, 0, 1, 0, 1),
    (2, 1.0, 2, 1.0, 2, 1.0, 0, 1, 0, 1),
    (4, 1.0, 3, 1.0, 5, 1.0, 0, 1, 0, 1),
    # named as something else, wherever it stands
    (1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 0, 0),
    (2, 1.0, 3, 1.0, 9, 0.0, 1, 0, 0, 0),
    (1, 1.0, 0, 0.0, 2, 1.0, 1, 0, 0, 0),
    (12, 0.0, 80, 0.0, 0, 0.0, 1, 0, 0, 0),
    (9, 0.0, 1, 1.0, 11, 0.0, 1, 0, 0, 0),
    (45, 0.0, 60, 0.0, 70, 0.0, 1, 0, 0, 0),
    (70, 0.0, 12, 0.0, 66, 0.0, 1, 0, 0, 0),
    (60, 0.0, 3, 0.0, 2, 0.0, 1, 0, 0, 0),
    (40, 0.0, 50, 0.0, 0, 0.0, 1, 0, 0, 0),
    (200, 0.0, 0, 0.0, 0, 0.0, 1, 0, 0, 0),
    (30, 0.1, 90, 0.0, 5, 0.5, 1, 0, 0, 0),
    (26, 0.0, 0, 0.0, 1, 1.0, 1, 0, 0, 0),
    (60, 0.1, 30, 0.0, 25, 0.0, 1, 1, 0, 0),
    (28, 0.0, 0, 0.0, 0, 0.0, 1, 1, 0, 0),
    (7, 0.0, 50, 0.0, 40, 0.0, 1, 1, 0, 0),
    (30, 0.0, 90, 0.0, 20, 0.0, 1, 1, 0, 0),
    (5, 0.0, 40, 0.0, 30, 0.0, 1, 0, 1, 0),
    (3, 0.0, 60, 0.0, 12, 0.2, 1, 1, 1, 0),
    # in a form that may be the whole page's
    (40, 0.0, 35, 0.0, 50, 0.0, 0.5, 0, 0, 1),
    (25, 0.05, 30, 0.0, 25, 0.0, 0.5, 0, 0, 1),
    (60, 0.0, 2, 1.0, 45, 0.0, 0.5, 0, 0, 1),
    (45, 0.0, 60, 0.0, 1, 0.0, 0.5, 0, 0, 1),
    (12, 0.0, 2, 0.0, 1, 0.0, 0.5, 0, 0, 0),
    (1, 0.0, 1, 0.0, 1, 0.0, 0.5, 0, 0, 0),
    (3, 0.0, 9, 0.0, 2, 0.0, 0.5, 0, 0, 0),
    (15, 0.0, 1, 0.0, 2, 0.0, 0.5, 0, 0, 0),
    (2, 1.0, 2, 1.0, 40, 0.0, 0.5, 0, 0, 0),
    (4, 0.0, 30, 0.0, 3, 0.0, 0.5, 1, 0, 0),
    (2, 0.0, 0, 0.0, 8, 0.0, 0.5, 1, 0, 0),
    # nothing says what it is: length, links and neighbours decide
    (10, 0.0, 11, 0.0, 9, 0.0, 0, 0, 0, 1),
    (8, 0.0, 9, 0.0, 12, 0.0, 0, 0, 0, 1),
    (14, 0.0, 10, 0.0, 12, 0.0, 0, 0, 0, 1),
    (7, 0.0, 8, 0.0, 7, 0.0, 0, 0, 0, 1),
    (12, 0.0, 11, 0.0, 4, 1.0, 0, 0, 0, 1),
    (9, 0.0, 2, 1.0, 11, 0.0, 0, 0, 0, 1),
    (12, 0.0, 2, 1.0, 14, 0.0, 0, 0, 0, 1),
    (12, 0.0, 14, 0.0, 0, 0.0, 0, 0, 0, 1),
    (9, 0.0, 9, 0.0, 5, 0.0, 0, 0, 0, 1),
    (9, 0.0, 9, 0.0, 1, 1.0, 0, 0, 0, 1),
    (9, 0.0, 10, 0.0, 0, 0.0, 0, 0, 0, 1),
    (10, 0.0, 8, 0.0, 1, 1.0, 0, 0, 0, 1),
    (10, 0.0, 8, 0.0, 5, 0.0, 0, 0, 0, 1),
    (20, 0.0, 20, 0.0, 20, 0.0, 0, 0, 0, 1),
    (20, 0.0, 20, 0.0, 0, 0.0, 0, 0, 0, 1),
    (20, 0.0, 0, 0.0, 20, 0.0, 0, 0, 0, 1),
    (20, 0.0, 20, 0.0, 2, 1.0, 0, 0, 0, 1),
    (20, 0.0, 3, 1.0, 20, 0.0, 0, 0, 0, 1),
    (18, 0.1, 6, 0.0, 5, 0.0, 0, 0, 0, 1),
    (5, 0.0, 35, 0.0, 12, 0.0, 0, 0, 0, 1),
    (6, 0.0, 12, 0.0, 30, 0.0, 0, 0, 0, 1),
    (4, 0.0, 3, 1.0, 12, 0.0, 0, 0, 1, 1),
    (10, 0.0, 3, 1.0, 2, 1.0, 0, 0, 0, 0),
    (9, 0.0, 6, 1.0, 0, 0.0, 0, 0, 0, 0),
    (6, 0.0, 3, 1.0, 4, 1.0, 0, 0, 0, 0),
    (70, 0.0, 50, 0.0, 80, 0.0, 0, 0, 0, 1),
    (35, 0.05, 60, 0.0, 20, 0.0, 0, 0, 0, 1),
    (25, 0.0, 8, 0.0, 60, 0.0, 0, 0, 0, 1),
    (18, 0.1, 45, 0.0, 40, 0.1, 0, 0, 0, 1),
    (60, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1),
    (30, 0.0, 2, 1.0, 3, 1.0, 0, 0, 0, 1),
    (3, 0.0, 40, 0.0, 50, 0.0, 0, 0, 0, 1),
    (1, 0.0, 30, 0.0, 28, 0.0, 0, 0, 0, 1),
    (7, 0.0, 2, 1.0, 60, 0.0, 0, 0, 1, 1),
    (6, 0.0, 50, 0.0, 45, 0.0, 0, 0, 1, 1),
    (8, 0.25, 3, 0.0, 2, 0.0, 0, 0, 0, 0),
    (2, 0.0, 8, 0.25, 1, 0.0, 0, 0, 0, 0),
    (1, 0.0, 2, 0.0, 2, 0.0, 0, 0, 0, 0),
    (1, 0.0, 1, 0.0, 1, 0.0, 0, 0, 0, 0),
    (3, 0.0, 1, 1.0, 8, 0.3, 0, 0, 1, 0),
    (11, 0.0, 4, 1.0, 0, 0.0, 0, 0, 0, 0),
    (4, 0.0, 12, 0.0, 11, 0.0, 0, 0, 0, 1),
    (7, 0.0, 2, 1.0, 2, 1.0, 0, 0, 0, 0),
    (4, 1.0, 6, 0.0, 5, 0.0, 0, 0, 0, 0),
    (5, 1.0, 30, 0.0, 3, 1.0, 0, 0, 0, 0),
    (2, 1.0, 2, 1.0, 3, 1.0, 0, 0, 0, 0),
    (1, 1.0, 0, 0.0, 1, 1.0, 0, 0, 0, 0),
    (3, 1.0, 1, 1.0, 40, 0.0, 0, 0, 0, 0),
    (5, 0.8, 40, 0.0, 3, 1.0, 0, 0, 0, 0),
    (14, 0.9, 9, 0.8, 11, 1.0, 0, 0, 0, 0),
    (20, 0.7, 30, 0.0, 15, 0.8, 0, 0, 0, 0),
    (4, 0.0, 2, 1.0, 2, 1.0, 0, 0, 0, 0),
    (6, 0.0, 40, 0.0, 0, 0.0, 0, 0, 0, 0),
    (5, 0.0, 3, 0.0, 4, 0.0, 0, 0, 0, 0),
    (3, 0.0, 0, 0.0, 2, 1.0, 0, 0, 0, 0),
    (8, 0.0, 2, 1.0, 5, 0.0, 0, 0, 0, 0),
    (2, 0.0, 4, 0.0, 3, 0.5, 0, 0, 1, 0),
)


@dataclass
class Node:
    feature: int = -1
    bound: float = 0.0
    below: Node | None = None
    above: Node | None = None
    text: bool = False


def train_tree(rows: np.ndarray, labels: np.ndarray, depth: int = 8) -> Node:
    """Binary tree by least Gini impurity; of equal splits, that on the earlier feature, then the lower bound."""
    if depth == 0 or len(set(labels.tolist())) < 2:
        return Node(text=bool(labels.mean() > 0.5))
    best = None
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for bound in (values[1:] + values[:-1]) / 2:
            below = rows[:, feature] < bound
            impurity = sum(side.sum() * labels[side].mean() * (1 - labels[side].mean()) for side in (below, ~below))
            if best is None or impurity < best[0] - 1e-12:
                best = impurity, feature, bound, below
    if best is None:
        return Node(text=bool(labels.mean() > 0.5))
    _, feature, bound, below = best
    return Node(feature, float(bound), train_tree(rows[below], labels[below], depth - 1), train_tree(rows[~below], labels[~below], depth - 1))


@lru_cache(maxsize=1)
def default_tree() -> Node:
    table = np.array(LABELLED, np.float64)
    return train_tree(table[:, :-1], table[:, -1])


def is_text(node: Node, features: tuple) -> bool:
    while node.feature >= 0:
        node = node.below if features[node.feature] < node.bound else node.above
    return node.text


@dataclass
class Block:
    text: str
    words: int
    density: float
    apart: float
    article: bool
    heading: bool


def _read_meaning(tag: str, attributes: str) -> tuple[float, bool, bool]:
    """How far an element is something other than text (1, of a form ``_FORM``), whether it is an article, or a header.

    A name of one word, as ``sidebar``, says what the element is. One of several does so by its last word (``main-nav``), or by
    any (``sidebar-left``) if none of them names text (``layout-sidebar-right``) or a lack or possession (``content-with-sidebar``);
    of an article it says nothing.
    """
    words, hidden = set(), False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name.rsplit("-", 1)[-1] in _NAMING:
            for token in value.split():
                found = [w.lower() for w in _WORD.findall(token)]
                if len(found) > 1:
                    joined = "".join(found)
                    if tag in _ARTICLE or not _MENTIONS.isdisjoint(found):
                        found = []
                    elif not _CONTENT_WORDS.isdisjoint(found):
                        found = found[-1:]
                    found.append(joined)
                words.update(found)
        hidden = hidden or name == "hidden" or (name == "aria-hidden" and value.lower().startswith("true")) or (name == "style" and _HIDING.search(value) is not None)
    named = not words.isdisjoint(_APART_WORDS - {"form"}) or hidden
    apart = 1.0 if named or (tag in _APART and tag != "form") else _FORM if tag == "form" or "form" in words else 0.0
    return apart, tag in _ARTICLE or not words.isdisjoint(_ARTICLE_WORDS), tag == "header" or not words.isdisjoint(_HEADER_WORDS)


_kept_meaning = lru_cache(maxsize=4096)(_read_meaning)


def _meaning(tag: str, attributes: str) -> tuple[float, bool, bool]:
    """What :func:`_read_meaning` says; that of long attributes isn't kept."""
    return _kept_meaning(tag, attributes) if len(attributes) < 2000 else _read_meaning(tag, attributes)


class _Reader:
    def __init__(self):
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.in_link = False
        self.link_words = 0
        self.open: list[tuple[str, float, bool]] = []  # tag, apart, article
        self.opened: Counter[str] = Counter()  # of each tag, how many are open

    def end_block(self) -> None:
        if not self.parts:
            return
        words = "".join(self.parts).split()
        if words:
            _, apart, article = self.open[-1] if self.open else ("", 0.0, False)
            heading = any(t in _HEADING for t, _, _ in self.open[-2:])
            self.blocks.append(Block(" ".join(words), len(words), min(1.0, self.link_words / len(words)), apart, article, heading))
        self.parts, self.link_words = [], 0

    def text(self, raw: str) -> None:
        if raw:
            value = html.unescape(raw) if "&" in raw else raw
            self.parts.append(value)
            if self.in_link:
                self.link_words += len(value.split())

    def start(self, tag: str, attributes: str) -> None:
        if tag == "a":
            self.in_link = True
        if tag == "br" or tag in ("td", "th"):
            self.parts.append(" ")
        named = attributes and not attributes.isspace()
        apart, article, header = _meaning(tag, attributes if named else "")
        if tag in _VOID or attributes.endswith("/"):
            if tag in _BLOCK:
                self.end_block()
            return
        if tag not in _BLOCK and not (apart and tag not in ("html", "body")):
            return
        self.end_block()
        if tag in _BLOCK and self.open and self.open[-1][0] == "p":
            self.close(1)
        if tag in ("li", "dt", "dd", "tr", "option") and self.open and self.open[-1][0] == tag:
            self.close(1)
        _, was_apart, was_article = self.open[-1] if self.open else ("", 0.0, False)
        if tag in ("html", "body"):
            apart = 0.0
        if tag in _ARTICLE and was_apart == _FORM:
            was_apart = 0.0  # the form is the page's
        if tag == "head" or (header and not was_article):
            apart = 1.0
        self.open.append((tag, max(was_apart, apart), was_article or article))
        self.opened[tag] += 1

    def close(self, elements: int) -> None:
        for _ in range(elements):
            self.opened[self.open.pop()[0]] -= 1

    def end(self, tag: str) -> None:
        if tag == "a":
            self.in_link = False
        if self.opened[tag]:
            self.end_block()
            while self.open[-1][0] != tag:
                self.close(1)
            self.close(1)
        elif tag in _BLOCK:
            self.end_block()


def _tag_end(page: str, at: int) -> int:
    """Where a tag ends whose name ends at ``at``: behind the next > outside quoted values; -1 if nowhere.

    A quote that isn't closed on the page is part of a value.
    """
    while step := _STEP.search(page, at):
        if not step[1]:
            return step.end()
        at = page.find(step[1], step.end()) + 1 or step.end()
    return -1


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order; scripts, styles, controls, markup and markup's comments are in none.

    Every character is looked at a fixed number of times: what a search that finds no end has shown, that
    the page has none from there on, is kept. A tag without an end is text.
    """
    reader, at, endless, last = _Reader(), 0, set(), page.rfind(">")
    no_tags = False  # a tag has no end, nor have those behind it
    search = 0
    while (m := _OPENING.search(page, search)) and m.start() < last and not no_tags:
        name = (m[4] or "").lower()
        if m[1]:
            end = page.find("-->", m.end())
            end = len(page) if end < 0 else end + 3
        elif name and not m[3]:
            end = _tag_end(page, m.end())
        else:
            end = page.find(">", m.end()) + 1
        if end < 0:
            no_tags = True
            continue
        reader.text(page[at : m.start()])
        at = search = end
        if not name:
            continue
        if m[3]:
            reader.end(name)
        elif name not in _UNREAD:
            reader.start(name, page[m.end() : end - 1])
        elif page[end - 2] != "/":
            close = None if name in endless else _END[name].search(page, at)
            if close:
                at = search = close.end()
            elif name in _TO_THE_END:
                at = search = len(page)
            else:
                endless.add(name)
    reader.text(page[at:])
    reader.end_block()
    return reader.blocks


def main_text(page: str, tree: Node) -> str:
    """The blocks that the tree takes for text, joined by line feeds."""
    found = blocks(page)
    out = []
    for k, b in enumerate(found):
        before, after = (found[k - 1] if k else None), (found[k + 1] if k + 1 < len(found) else None)
        around = [x for n in (before, after) for x in ((n.words, n.density) if n else (0, 0.0))]
        if is_text(tree, (b.words, b.density, *around, b.apart, b.article, b.heading)):
            out.append(b.text)
    return "\n".join(out)


def extract_text(df: DataFrame, html_col: str = "html", to: str = "text") -> DataFrame:
    """``df`` without ``html_col`` and with the page's main text in column ``to``.

    Null and empty pages have an empty text. Rows are independent: repeated rows give a row each, null ids
    and other columns are kept as they are, and a column named as ``to`` is replaced. An empty table gives
    an empty result.
    """
    source = df.drop(to) if to != html_col else df
    at = source.columns.index(html_col)
    tree = default_tree()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(page.as_py() or "", tree) for page in batch.column(at)], pa.string())
            kept = [k for k in range(batch.num_columns) if k != at]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), texts], names=[*(batch.schema.names[k] for k in kept), to])

    fields = [f for k, f in enumerate(source.schema.fields) if k != at]
    return source.mapInArrow(run, StructType([*fields, StructField(to, StringType())]))
