"""Main text of web pages by line-block distribution.

Markup is stripped to lines: one for each block element that holds text, with what surrounds it. A line weighs its length
outside links; lines of parts that are never the article by their element or by a class or id (menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles, comments) weigh nothing. Weights are summed over sliding windows of
lines. The page's own level is the weight of the line that an average character stands in: where the sums surge to
``rise`` of it a run of text begins, where they dive below, it ends. Short lines at either end of a run that are no
headings are taken off again, but up to ``margin`` that end as sentences do. Runs at most ``bridge`` lines apart are one.

The runs decide what is kept. A page with article or main elements keeps those that a run meets, with all their lines;
those that none meets (teasers, cards) go. A page where no run meets such an element keeps what the runs cover.

A class or id that is such a part's name as a whole (``sidebar``), or begins with comments', takes its block out. One that only has such a
word in it (``share-box``) does so unless the block holds at least ``WRAPPER`` of the page's weight, since wrappers of whole articles are
named after what is at their side; and one that begins with has, no, with and the like says nothing.

Edges: null and empty pages and pages without text give an empty text; broken markup (unclosed elements, `<` in text)
never fails and takes time in proportion to the page; a `<` in a tag and outside its quotes ends it as text; equal rows
get equal results; a null page_id or url stays null; a very long page is one task's row; other columns are ignored.
"""

from __future__ import annotations

import functools
import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import full_text, ready

#: Elements whose content is never shown as text; fixed values.
RAW = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "textarea", "title", "head", "canvas", "audio", "video", "select", "button"}
#: Elements that stand beside an article; fixed values.
ASIDE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "fieldset"}
#: Elements that break a line of text; fixed values.
BLOCK = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
#: Elements without content; fixed values.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Words of a class or id that name parts beside an article.
PART = re.compile(r"ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|header|masthead|footer|side-?bar\w*|aside|widget\w*|cookie\w*|consent|notice\w*|gdpr|popup|modal|newsletter|subscribe|signup|login|share|sharing|social|related|recommend\w*|comments?|disqus|replies|respond|pagination|pager|toolbar|copyright|legal|skip", re.I)
REMARKS = {"comment", "comments", "disqus", "replies", "respond"}
WITHOUT = {"has", "no", "not", "with", "without", "is", "show", "hide"}  #: such names tell of a state
WRAPPER = 0.5  #: share of a page's weight
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?+)([a-zA-Z][^\s/><]*+)((?:[^>\"'<]++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
_NAME = re.compile(r"\b(?:class|id|role)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++))", re.I)
_ENDS_P = BLOCK - {"body", "html"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_CLOSING = {name: re.compile(rf"</{name}\s*+>", re.I) for name in RAW} | {"head": re.compile(r"</head\s*+>|(?=<body\b)", re.I)}


class Line(NamedTuple):
    """A line of text, its length outside links, whether it may be article text, the article it stands in (0: none), and whether it is a heading."""

    text: str
    weight: int
    may: bool
    article: int
    heading: bool


@functools.lru_cache(1 << 14)
def names_part(called: str) -> int:
    """Whether a block's class, id and role name a part beside the article: 2 yes, 1 by a word within a name, 0 no."""
    found = 0
    for name in called.lower().split():
        words = re.split(r"[-_]+", name.strip("-_"))
        if words[0] in WITHOUT:
            continue
        if PART.fullmatch(name) or words[0] in REMARKS:
            return 2
        found |= any(PART.fullmatch(w) for w in words)
    return int(found)


class _Open:
    """The open block elements, with what the lines need to know of all of them kept as counts."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, bool, bool, bool]] = []  # element, beside the article, an article, perhaps beside it
        self.names: Counter[str] = Counter()
        self.beside = self.headings = self.made = 0
        self.begun: list[int] = []  # of open blocks that may be parts by a word within a name: their first lines
        self.parts: list[tuple[int, int]] = []  # of the closed ones: their lines
        self.articles: list[int] = []

    def push(self, name: str, beside: bool, article: bool, perhaps: bool, lines: int) -> None:
        self.stack.append((name, beside, article, perhaps))
        if perhaps:
            self.begun.append(lines)
        self.names[name] += 1
        self.beside += beside
        self.headings += name in _HEADINGS
        if article:
            self.made += 1
            self.articles.append(self.made)

    def pop(self, lines: int) -> str:
        name, beside, article, perhaps = self.stack.pop()
        if perhaps:
            self.parts.append((self.begun.pop(), lines))
        self.names[name] -= 1
        self.beside -= beside
        self.headings -= name in _HEADINGS
        if article:
            self.articles.pop()
        return name

    def top(self) -> str:
        return self.stack[-1][0] if self.stack else ""


def lines_of(page: str) -> list[Line]:
    """The page's lines of text, in one pass."""
    lines: list[Line] = []
    piece: list[str] = []
    inside, linked, link = _Open(), 0, None  # link: how many elements were open where it began
    unclosed: set[str] = set()  # raw elements that no longer end

    def add(text: str) -> None:
        nonlocal linked
        piece.append(text)
        if link is not None:
            linked += len(text.strip())

    def flush() -> None:
        nonlocal linked
        text = " ".join(entities.unescape("".join(piece)).split())
        piece.clear()
        if text:
            lines.append(Line(text, max(len(text) - linked, 0), not inside.beside, inside.articles[-1] if inside.articles else 0, bool(inside.headings)))
        linked = 0

    at, n = 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        if not m:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            if name == "a":
                link = None
            elif name in BLOCK:
                flush()
                if inside.names[name]:
                    while inside.pop(len(lines)) != name:
                        pass
                    if link is not None and len(inside.stack) < link:
                        link = None
            continue
        if name == "br":
            piece.append(" ")
            continue
        if name == "a":
            link = len(inside.stack)
            continue
        if name in RAW:
            whole = name in ("script", "style", "textarea", "title", "iframe", "noscript")
            m = None if name in unclosed or (name != "head" and m[3].rstrip().endswith("/")) else _CLOSING[name].search(page, at)
            if m:
                at = m.end()
            else:
                unclosed.add(name)
                at = n if whole else at
            continue
        if name not in BLOCK or name in VOID:
            if name == "hr":
                flush()
            continue
        flush()
        if name in _ENDS_P and inside.top() == "p":
            inside.pop(len(lines))
        if name == "li" and inside.top() == "li":
            inside.pop(len(lines))
        if name in ("article", "main", "body"):  # what an unclosed part beside the article would swallow
            while inside.top() in ("p", "li", "ul", "ol"):
                inside.pop(len(lines))
        called = " ".join(a or b or c for a, b, c in _NAME.findall(m[3]))
        part = 0 if not called or name in ("article", "main", "body", "html") else names_part(called)
        if not m[3].rstrip().endswith("/"):
            inside.push(name, name in ASIDE or part == 2, name in ("article", "main") or "role" in m[3] and "main" in called.split(), part == 1, len(lines))
    flush()
    while inside.stack:
        inside.pop(len(lines))
    return without_parts(lines, inside.parts)


def without_parts(lines: list[Line], parts: list[tuple[int, int]]) -> list[Line]:
    """Lines of blocks that are parts by a word within a name may not be article text, but for wrappers of much of the page."""
    if not parts:
        return lines
    total = np.append(0, np.cumsum([x.weight if x.may else 0 for x in lines]))
    edge = np.zeros(len(lines) + 1, np.int64)
    for a, b in parts:
        if total[b] - total[a] < WRAPPER * total[-1]:
            edge[a] += 1
            edge[b] -= 1
    return [x._replace(may=False) if x.may and k else x for x, k in zip(lines, np.cumsum(edge[:-1]).tolist(), strict=True)]


def runs(weights: np.ndarray, window: int = 3, rise: float = 0.5) -> list[tuple[int, int]]:
    """Surges and dives of the sums of weights over sliding windows: where text begins and ends."""
    if not len(weights) or not weights.any():
        return []
    level = float((weights**2).sum() / weights.sum())
    sums = np.convolve(weights, np.ones(window), "full")[window // 2 : window // 2 + len(weights)]
    on = (sums >= rise * level).astype(int)
    edge = np.diff(np.concatenate(([0], on, [0])))
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True))


def main_text(page: str, window: int = 3, rise: float = 0.5, short: float = 0.25, bridge: int = 8, margin: int = 3) -> str:
    lines = lines_of(page)
    weights = np.array([x.weight if x.may else 0 for x in lines], float)
    found = runs(weights, window, rise)
    least = short * rise * float((weights**2).sum() / weights.sum()) if found else 0.0
    kept = np.zeros(len(lines), bool)
    for a, b in found:
        ends = lambda i: weights[i] < least and not (lines[i].heading and lines[i].may)
        while a < b and ends(a):
            a += 1
        while a < b and weights[b - 1] < least:  # a heading after a text belongs to what follows
            b -= 1
        kept[a:b] = True
    at = np.flatnonzero(kept)  # short lines between two runs that stand near each other belong to the text
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if 1 < b - a <= bridge + 1 and all(x.may for x in lines[a:b]):
            kept[a:b] = True
    for i in [i for i in at.tolist() if not (kept[i - 1] if i else False) or not (kept[i + 1] if i + 1 < len(lines) else False)]:
        for step in (-1, 1):  # so do sentences right before and after it
            for j in range(i + step, i + step * (margin + 1), step):
                if not 0 <= j < len(lines) or kept[j] or not lines[j].may or not lines[j].weight or lines[j].text[-1] not in ".!?":
                    break
                kept[j] = True
    met = {x.article for x, k in zip(lines, kept, strict=True) if k and x.article}
    within = [x.article in met for x in lines]
    return "\n".join(x.text for x, k, w in zip(lines, kept, within, strict=True) if x.may and (w or (k and not met)))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every row."""
    ready(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), full_text(html).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
