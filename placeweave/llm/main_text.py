"""Main text of web pages: parser events, text-to-tag ratios by line, Gaussian smoothing and threshold clustering.

A page is read as a stream of the standard library's HTML parser events. Block elements break it into lines; each line knows its text, how
much of it is not the text of a link, how many tags it took and which elements it lies in. Ratios of such text to tags are smoothed along the
page, two clusters of them give the threshold, and the lines above it vote for the content regions they lie in: their article or main element,
or else the block around them. The page's text is every line of the regions voted for, so a short paragraph between long ones, or a heading, is
not lost; only a list, table or section inside a region that consists of several lines, all links, none of which votes, is left out as a menu.
Lines inside navigation, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments never vote and are
never part of the text, whether an element or its class or id says so. A class or id says so with whole names (``cookie-notice``,
``site-header``; not ``market-share`` or ``with-sidebar``), and is not believed of an element that holds most of a page's text.

Rows: a null or empty page has an empty text. Broken markup (tags left open, a page cut off, a head or a menu that is not closed) is read as
far as it goes. A paragraph left open ends with the next block, wherever that is nested. Repeated rows are read alike. Other columns are
passed on where asked for.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeweave.llm.shared import query, table

RADIUS = 2  # lines either side that smoothing reaches
SIGMA = 1.0

# Elements by what they do to a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q ruby rb rp rt s samp small span strike strong "
                   "sub sup time tt u var wbr img br".split())
UNSEEN = frozenset("head title script style noscript template iframe object svg canvas math audio video map".split())
ASIDE = frozenset("nav header footer aside form button select option textarea label fieldset menu dialog".split())
REGION = frozenset("article main".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
# Words of a class or id that say an element is not part of the article.
NAMES = frozenset("nav navbar navigation menu submenu header masthead footer sidebar aside cookie cookies consent gdpr notice notification alert banner "
                  "popup modal overlay ad ads adv advert adverts advertisement advertising adsense promo promotion sponsor sponsored sponsors share sharing "
                  "social related recommended recommendations breadcrumb breadcrumbs pagination pager toolbar comment comments commentlist reply replies "
                  "respond disqus newsletter subscribe subscription signup login search widget skip copyright disclaimer".split())
# Words that stand beside such a word in a name without changing what it says.
BESIDE = frozenset("site page top bottom main global left right box bar block list item items wrapper wrap container section slot unit link links "
                   "button buttons post posts article articles area widget widgets form content inner outer primary secondary text message panel "
                   "title first last thread user reader inline js the div id".split())
HEAD = frozenset("base link meta title style script template noscript".split())  # what a head may hold
_UNNAMED = frozenset("html body article main".split())  # their classes describe the page or its layout
_REMARK = frozenset("comment comments commentlist reply replies respond disqus".split())
_HOLDERS = frozenset("ul ol dl table section div".split())  # parts of an article that may be a menu
MOST, MOST_REMARKS = 0.5, 0.95  # shares of a page's text beyond which a name is not believed
# An open element that the start of one of these ends: the element, and where the search for it stops.
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
           "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
_WORDS = re.compile(r"[a-z]+")


class Line(NamedTuple):
    """A line of a page: what it says and where it stands."""

    text: str
    tags: int
    spoken: int  # characters of its text, without spaces, that belong to no link
    region: int  # number of the article or main element around it, or 0
    block: int  # number of the block around it
    holder: int  # number of the innermost list, table or section around it
    aside: bool  # whether its elements are no part of an article
    named: tuple[tuple[int, bool], ...]  # elements around it whose names say so, and whether they hold remarks


class _Open(NamedTuple):
    name: str = ""
    unseen: bool = False
    aside: bool = False
    region: int = 0
    block: int = 0
    holder: int = 0
    named: tuple[tuple[int, bool], ...] = ()


def says(words: list[str]) -> bool:
    """Whether the words of one class or id name something beside the article."""
    return any(w in NAMES for w in words) and all(w in NAMES or w in BESIDE for w in words) and not (len(words) > 1 and words[0] == "article")


class _Lines(HTMLParser):
    """Collects the lines of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[_Open] = []
        self.lines: list[Line] = []
        self.parts: list[str] = []
        self.tags = self.number = self.links = self.linked = 0

    def _state(self) -> _Open:
        return self.stack[-1] if self.stack else _Open()

    def break_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        at = self._state()
        if text:
            self.lines.append(Line(text, self.tags, len(text.replace(" ", "")) - self.linked, at.region, at.block, at.holder, at.aside, at.named))
            self.tags = 0
        self.parts, self.linked = [], 0

    def _close_left_open(self, tag: str) -> None:
        """End the elements that ``tag`` cannot stand in, though their own end is missing."""
        if tag not in HEAD and tag not in ("html", "head"):
            self._end("head", set())
        if tag in REGION:
            self._end("nav", set())  # a menu holds no article
        if tag not in INLINE and any(at.name == "p" for at in self.stack):
            self._end("p", stop={"div", "td", "th", "li", "article", "section", "main", "blockquote", "button"})
        if tag in _CLOSES:
            ends, stop = _CLOSES[tag]
            for name in ends:
                self._end(name, stop)

    def handle_starttag(self, tag, attrs):
        self.tags += tag not in UNSEEN
        if tag == "br":
            self.parts.append(" ")
            return
        block = tag not in INLINE
        if block:
            self.break_line()
        self._close_left_open(tag)
        if tag in VOID:
            return
        around = self._state()
        self.number += 1
        given = dict(attrs)
        role = (given.get("role") or "").lower()
        names = [_WORDS.findall(token.lower()) for name in ("class", "id") for token in (given.get(name) or "").split()]
        remark = any(w in _REMARK for words in names if says(words) for w in words)
        named = around.named
        if remark or (tag not in _UNNAMED and any(says(words) for words in names)):
            named += ((self.number, remark),)
        self.stack.append(_Open(
            tag, around.unseen or tag in UNSEEN, around.aside or tag in ASIDE or role in ROLES,
            self.number if tag in REGION or role == "main" else around.region, self.number if block else around.block,
            self.number if tag in _HOLDERS or tag in REGION else around.holder, named))
        self.links += tag == "a"

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += tag not in UNSEEN
        if tag not in VOID:
            self._end(tag, set())

    def _end(self, tag: str, stop: set[str]) -> None:
        """Close the nearest open ``tag`` and all that was opened in it, unless an element of ``stop`` lies between."""
        for at in range(len(self.stack) - 1, -1, -1):
            name = self.stack[at].name
            if name == tag:
                ended = self.stack[at:]
                if any(e.name not in INLINE for e in ended):
                    self.break_line()
                self.links -= sum(e.name == "a" for e in ended)
                del self.stack[at:]
                return
            if name in stop or (tag in INLINE and name not in INLINE):
                return

    def handle_data(self, data):
        if self.stack and self.stack[-1].name == "head" and data.strip():
            self._end("head", set())
        if not self._state().unseen:
            self.parts.append(data)
            if self.links:
                self.linked += len("".join(data.split()))

    def unknown_decl(self, data):
        """Marked sections hold no text."""


def lines_of(html: str) -> list[Line]:
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser.break_line()
    return parser.lines


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """Gaussian smoothing along the page; at its ends the weights that fall outside are left out."""
    reach = np.arange(-RADIUS, RADIUS + 1)
    kernel = np.exp(-reach ** 2 / (2 * SIGMA ** 2))
    middle = slice(RADIUS, RADIUS + len(ratios))
    return np.convolve(ratios, kernel)[middle] / np.convolve(np.ones(len(ratios)), kernel)[middle]


def threshold(values: np.ndarray) -> float:
    """Half-way between the centres of two clusters of log ratios; a hair below it, so that equal ratios all reach it."""
    logs = np.round(np.log1p(values), 9)
    low, high = logs.min(), logs.max()
    for _ in range(20):
        cut = (low + high) / 2
        upper = logs > cut
        if upper.all() or not upper.any():
            break
        low, high = logs[~upper].mean(), logs[upper].mean()
    return float(np.expm1((low + high) / 2 - 1e-8))


def beside(lines: list[Line]) -> list[bool]:
    """Which lines are no part of an article: by their elements, or by names that can be believed.

    Names stand where the page marks an article outside them; elsewhere an element that holds most of the text is not what its name says.
    """
    seen = [line for line in lines if not line.aside]
    weights: dict[tuple[int, bool], int] = {}
    for line in seen:
        for element in line.named:
            weights[element] = weights.get(element, 0) + len(line.text)
    doubted = set()
    if not any(line.region and not line.named for line in seen):
        whole = sum(len(line.text) for line in seen)
        doubted = {e for e, weight in weights.items() if weight > (MOST_REMARKS if e[1] else MOST) * whole}
    return [line.aside or any(e not in doubted for e in line.named) for line in lines]


def main_text(html: str | None) -> str:
    """The article's blocks in page order, one a line."""
    lines = lines_of(html or "")
    if not lines:
        return ""
    own = np.array([line.spoken / max(1, line.tags) for line in lines], dtype=float)
    ratios = smoothed(own)
    cut = threshold(ratios)
    out = beside(lines)
    inside = [i for i in range(len(lines)) if not out[i]]
    marked = [i for i in inside if lines[i].region]
    inside = marked or inside  # where the page marks its article, nothing outside it is content
    if not inside:
        return ""
    # A line at the edge of a cluster that is itself below the threshold was only lifted by its neighbours.
    voters = [i for i in inside if min(ratios[i], own[i]) >= cut] or [max(inside, key=lambda i: (ratios[i], -i))]
    regions = {lines[i].region if marked else lines[i].block for i in voters}
    if marked:
        chosen = [i for i in inside if lines[i].region in regions]
    else:  # a paragraph is a region of its own: its neighbours between two voters belong to the same text
        first, last = min(voters), max(voters)
        chosen = [i for i in inside if first <= i <= last or lines[i].block in regions]
    held = Counter(lines[i].holder for i in chosen)
    content = {lines[i].holder for i in chosen if lines[i].spoken or held[lines[i].holder] == 1} | {lines[i].holder for i in voters}
    return "\n".join(lines[i].text for i in chosen if lines[i].holder in content)


def extract(pages: DataFrame, *, html: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns, text and n_chars of every row of ``pages``."""
    @F.pandas_udf("string")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(page) for page in batch], dtype="object")
    found = pages.select(F.struct(*keep).alias("kept"), read(F.col(html)).alias("text")) if keep else pages.select(read(F.col(html)).alias("text"))
    return found.select(*([f"kept.{k}" for k in keep]), "text", F.length("text").cast("long").alias("n_chars"))


@query()
def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"), keep=("page_id", "url"))
