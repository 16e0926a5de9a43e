"""Main text of web pages by text-to-tag ratio over streaming parser events.

The standard library's parser streams through a page once.  Its events cut the page into
lines, one per block of text; what stands in elements that never hold article text
(menus, headers, footers, sidebars, forms, scripts, styles and the like) or in containers
whose class, id or role names a notice, an advert, comments or a menu is not read, unless
such a name belongs to the layout around the article (``_wrappers``).
Every line has a ratio of text to tags: its characters over its tags, links' text not
counted.  The ratios are smoothed with a Gaussian kernel over neighbouring lines and
clustered by a threshold, their standard deviation within the page: lines at or over it
form the content regions.  The regions take in the rest of their article: the smallest
element (article or main, or else any container, at last the page) that holds all content
lines gives all its lines, so that short paragraphs and headings around and between the
regions stay and no content line is lost.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import append_columns

#: Smoothing radius in lines and the kernel's standard deviation.
RADIUS = 2
SIGMA = 1.0

#: Elements whose text is never article text.
DROPPED = frozenset("head title script style noscript template nav footer aside form button select textarea "
                    "option menu dialog iframe object svg canvas audio video".split())
#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that start and end a line of text.
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section "
                  "summary table tbody td tfoot th thead tr ul".split())
#: Elements that an opening block of the same kind closes (their end tags may be left out).
CLOSES = {"p": BLOCK, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
          "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"])}
#: First or last words of a name in a class, an id or a role that make a container no article text.
NOT_TEXT = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription signup login nav navbar navigation menu breadcrumb breadcrumbs sidebar "
    "sidebars aside widgets footer header masthead toolbar pagination pager share sharing social related recommended recommendations "
    "comment comments commentlist discussion disqus replies reply respond search complementary contentinfo "
    "crumbs topbar teaser teasers side legal disclaimer copyright".split())
#: Names that a part of the article may bear too: they count outside article and main only.
OUTER = frozenset("header masthead banner share search menu side legal disclaimer copyright teaser".split())
#: Names of what may be longer than the article: readers' comments, adverts, notices.
APART = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr "
    "comment comments commentlist discussion disqus replies reply respond".split())
#: Containers that are article text whatever they are called.
ROOTS = frozenset(["html", "body", "article", "main"])
#: Other elements than BLOCK whose names count.
INLINE = frozenset(["span", "a", "ins", "b", "i", "em", "strong"])
_WORDS = re.compile(r"[a-z]+")
_SPACE = re.compile(r"[\s ]+")


class _Open(NamedTuple):
    """An open element: its number, whether its text is read (0), dropped by a name (1) or
    dropped (2), the named element around or at it (0: none), and the one around the outermost
    article that it is in (None: it is in none)."""

    tag: str
    number: int
    away: int
    named: int
    article: int | None


class _Lines(HTMLParser):
    """Lines (text, link characters, tags, innermost block) of one page.

    Elements are numbered in order of their start tags.  Whatever is asked about the open elements is
    kept with each of them or counted as they come and go, so that the
    work grows with the page, not with its depth."""

    def __init__(self, wrappers: frozenset = frozenset()):
        super().__init__(convert_charrefs=True)
        self.wrappers = wrappers  # numbers of elements that are read in spite of their names
        self.named: dict[int, set] = {}  # elements with such names: the words that begin a name
        self.outer: dict[int, int] = {}  # and the named element around each
        self.held: Counter = Counter()  # characters outside links by (named element, named element around the article)
        self.cards: set[int] = set()  # articles with names that begin with such a word
        self.lines: list[tuple[str, int, int, int]] = []
        self.stack: list[_Open] = []
        self.at: dict[str, list[int]] = {}  # places on the stack by element
        self.blocks: list[int] = []  # places of the blocks
        self.block = [("", 0, 0)]  # (tag, number, index of the block around) of all blocks so far; 0: the page
        self.inside = [0]  # indexes of the open blocks
        self.last: dict[int, int] = {}  # by index of a block: the number of its last element
        self.number = 0
        self.parts: list[str] = []
        self.linked = self.tags = 0

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """``<![...`` of any kind is skipped as a comment up to the next ``>``, as browsers do."""
        return self.parse_bogus_comment(i)

    def _flush(self) -> None:
        text = _SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            self.lines.append((text, self.linked, self.tags, self.inside[-1]))
            self.tags = 0
        self.parts, self.linked = [], 0

    def _push(self, e: _Open) -> None:
        self.at.setdefault(e.tag, []).append(len(self.stack))
        if e.tag in BLOCK:
            self.blocks.append(len(self.stack))
            self.block.append((e.tag, e.number, self.inside[-1]))
            self.inside.append(len(self.block) - 1)
        self.stack.append(e)

    def _close(self, place: int) -> None:
        """Close the element at a place of the stack and all in it."""
        while len(self.stack) > place:
            e = self.stack.pop()
            self.at[e.tag].pop()
            if e.tag in BLOCK:
                self.blocks.pop()
                self.last[self.inside.pop()] = self.number

    def _open(self, tag: str) -> bool:
        return bool(self.at.get(tag))

    def _in_article(self) -> bool:
        return self._open("article") or self._open("main")

    def _hidden(self, tag: str, attrs: list) -> bool:
        return tag not in ROOTS and (tag in BLOCK or tag in INLINE) and any(
            name == "hidden" or name == "aria-hidden" and value == "true"
            or name == "style" and value and "display:none" in value.replace(" ", "").lower() for name, value in attrs)

    def _called(self, tag: str, attrs: list) -> tuple[set, set]:
        """The words of NOT_TEXT that begin or end a name of the element, and those that begin one."""
        ends, first = set(), set()
        if tag in BLOCK or tag in INLINE:
            for name, value in attrs:
                if name in ("class", "id", "role") and value:
                    names = [w for w in map(_WORDS.findall, value.lower().split()) if w]
                    called = NOT_TEXT.intersection(x for w in names for x in (w[0], w[-1]))
                    if called and not (called <= OUTER and self._in_article()):
                        ends |= called
                        first |= NOT_TEXT.intersection(w[0] for w in names)
        return ends, first

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.tags += 1
        if tag in BLOCK:
            self._flush()
            while self.stack and tag in CLOSES.get(self.stack[-1].tag, ()):
                self._close(len(self.stack) - 1)
            # a paragraph left open behind inline elements
            if self.stack and self.stack[-1].tag not in BLOCK and self.blocks and self.stack[self.blocks[-1]].tag == "p":
                self._close(self.blocks[-1])
        if tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        self.number += 1
        away, named, article = self.stack[-1][2:] if self.stack else (0, 0, None)
        if tag in DROPPED or tag == "header" and not self._in_article() or self._hidden(tag, attrs):
            away = 2
        elif attrs and away < 2:
            ends, first = self._called(tag, attrs)
            if tag in ROOTS:
                if tag == "article" and first:
                    self.cards.add(self.number)
            elif ends:
                self.named[self.number], self.outer[self.number] = first, named
                named = self.number
                if self.number not in self.wrappers:
                    away = 1
        if article is None and (tag == "main" or tag == "article" and self.number not in self.cards):
            article = named
        self._push(_Open(tag, self.number, away, named, article))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCK:
            self._flush()
        if self._open(tag):
            place = self.at[tag][-1]
            if tag in BLOCK or not self.blocks or place > self.blocks[-1]:  # an inline end tag does not close the block around it
                self._close(place)

    def handle_data(self, data: str) -> None:
        e = self.stack[-1] if self.stack else _Open("", 0, 0, 0, None)
        link = self._open("a")
        if not link and e.away < 2 and not data.isspace():
            self.held[e.named, e.article] += len(data.strip())
        if not e.away:
            self.parts.append(data)
            if link:
                self.linked += len(data.strip())

    def finish(self) -> None:
        self._flush()
        self._close(0)
        self.last[0] = self.number


def _wrappers(page: _Lines) -> frozenset:
    """The named containers that are layout around the article.

    One that holds an article or main is, if its name only ends with such a word
    (with-sidebar); if it begins with one (related-posts), only on a page that has no
    article outside of such containers.  Without articles to go by, and for names that only
    end so, one with over half of the page's text outside links is; one called after
    comments, adverts or notices must have all of it."""
    named, outer = page.named, page.outer
    ends = {article for _, article in page.held if article is not None}  # the named element around each article (0: none)
    above, size, strict = set(ends), Counter(), {0: 0}
    for n, first in named.items():  # outer ones come first
        strict[n] = strict[outer[n]] + bool(first)
    for (n, _), chars in page.held.items():
        size[n] += chars
    for n in reversed(named):  # sums of what is inside
        size[outer[n]] += size[n]
        if n in above:
            above.add(outer[n])
    # of the names that begin with such a word, as many from the outermost one on as it takes to reach one article
    reach = min((strict[n] for n in ends), default=0)
    free = {n for n in above if n and (not named[n] or strict[n] <= reach)}
    total = sum(page.held.values())
    for n, first in named.items():
        if size[n] and not (first and ends):
            if size[n] == total if first & APART else 2 * size[n] > total:
                free.add(n)
    return frozenset(free)


def smooth(x: np.ndarray, radius: int = RADIUS, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; at the ends the kernel's remaining part is normalised."""
    k = np.exp(-np.arange(-radius, radius + 1) ** 2 / (2 * sigma * sigma))
    return np.convolve(x, k, "full")[radius:radius + len(x)] / np.convolve(np.ones(len(x)), k, "full")[radius:radius + len(x)]


def _read(html: str, wrappers: frozenset = frozenset()) -> _Lines:
    parser = _Lines(wrappers)
    parser.feed(html)
    parser.close()
    parser.finish()
    return parser


def blocks_of(html: str) -> list[str]:
    """The text blocks of a page's main text, in page order."""
    parser = _read(html)
    if parser.named and (wrappers := _wrappers(parser)):
        parser = _read(html, wrappers)
    lines = parser.lines
    if not lines:
        return []
    ratio = np.array([max(0, len(text) - linked) / max(1, tags) for text, linked, tags, _ in lines])
    smoothed = smooth(ratio)
    content = np.flatnonzero((smoothed >= smoothed.std()) & (ratio > 0))
    if not len(content):
        content = np.flatnonzero(ratio > 0)
    if not len(content):
        return []
    # the article around the regions: the innermost container of all content lines
    numbers = [parser.block[lines[k][3]][1] for k in content]
    low, high = min(numbers), max(numbers)
    narrow = root = None
    at = lines[content[0]][3]
    while at:
        tag, number, up = parser.block[at]
        if number <= low and high <= parser.last[at]:
            if tag in ("article", "main"):
                root = at
                break
            if narrow is None and tag not in ("p", "li", "td", "th", "tr", "blockquote", "pre"):
                narrow = at
        at = up
    root = root or narrow
    if not root:
        return [text for text, *_ in lines]
    first, end = parser.block[root][1], parser.last[root]
    return [text for text, _, _, block in lines if first <= parser.block[block][1] <= end]


def extract(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with ``out``: the main text (blocks joined by one line break) and n_chars
    (its code points).

    Defined results: null and empty pages and pages without text give the empty text; broken
    or cut markup is read as far as it goes; declarations that are none (``<![...``) are skipped up
    to the next ``>``; elements may be nested to any depth; repeated rows give equal texts; input columns
    named like the new ones are replaced.
    """

    def make():
        def work(texts: list[str]) -> dict:
            found = ["\n".join(blocks_of(t)) for t in texts]
            return {out: found, "n_chars": [len(x) for x in found]}

        return work

    fields = [T.StructField(out, T.StringType()), T.StructField("n_chars", T.LongType())]
    return append_columns(pages, fields, html, make)


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract(pages).select("page_id", "url", F.col("text"), "n_chars")
