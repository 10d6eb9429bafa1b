"""Main text of web pages from text-to-tag ratios.

The standard library's parser streams a page's events. Every block becomes a line with its text, the
tags met in it and the elements it lies in. Lines in menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles and comments are junk by their elements and have no ratio. The ratios
of characters to tags are smoothed with a Gaussian over neighbouring lines; lines at or above the
standard deviation of the page's smoothed ratios form clusters. The element that holds the clusters is
the content region, and all of its lines that are no junk are the text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.bytewords import in_bytes
from wayfare.llm.tables import columns

#: Lines on each side that smoothing takes in, and its standard deviation.
REACH, SIGMA = 2, 1.0
#: Share of a container's weight that keeps the region from growing beyond a part of it.
MOST = 0.5

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody
    tfoot thead tr ul""".split()
)
CELLS = frozenset(["td", "th"])
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
PROSE = HEADINGS | frozenset(["p", "li", "blockquote", "pre", "dt", "dd", "tr", "figcaption"])
#: Elements whose content is never main text.
JUNK = frozenset(
    """head title script style noscript template iframe object svg canvas audio video form button select option textarea
    nav aside footer header menu dialog fieldset search datalist""".split()
)
#: Junk elements that an article or a main part never lies in: one that starts ends them.
ENDED = frozenset(["nav", "header", "footer", "menu", "head"])
#: Words in class, id and role of junk elements, and those of reader comments.
WORDS = frozenset(
    """ad ads advert adverts advertisement advertising adsense adslot adbox banner sponsor sponsored promo promotion cookie cookies
    consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription signup login sidebar aside nav
    navbar navigation menu menubar breadcrumb breadcrumbs pagination pager header masthead topbar footer copyright share sharing
    social related recommended widget toolbar hidden complementary contentinfo dialog alert search""".split()
)
COMMENTS = frozenset("comment comments disqus reply replies respond discussion".split())
#: Words that say what a part has or lacks, so that its other words are no name.
SPOKEN_OF = frozenset("no has with without".split())
#: An open element of the key ends where one of the named elements starts.
CLOSED_BY = {
    "p": BLOCKS - {"body", "html"},
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot", "thead"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot", "thead"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot", "thead"]),
    "option": frozenset(["option"]),
    "head": BLOCKS,
}
#: Elements that an implied end does not reach out of.
BARRIERS = frozenset(["ul", "ol", "dl", "table", "div", "article", "section", "main", "body", "html", "blockquote"])
NAME = re.compile(r"[a-z]+|[A-Z]+[a-z]*")
COMMENT_END, TAG_START, TAG_END = re.compile("--!?>"), re.compile("<[A-Za-z/!?]"), re.compile(">")


class Element:
    """An element of a page that bears on its lines; ``at`` numbers them, parents first."""

    __slots__ = ("at", "tag", "parent", "depth", "inline", "junk", "comment", "soft", "header")

    def __init__(self, at: int, tag: str, parent: Element | None, attributes: list[tuple[str, str | None]]) -> None:
        self.at, self.tag, self.parent = at, tag, parent
        self.depth = 0 if parent is None else parent.depth + 1
        self.inline = parent is not None and tag not in BLOCKS and tag not in CELLS
        words, unseen = set(), False
        for name, value in attributes:
            if name in ("class", "id", "role"):
                words.update(word.lower() for word in NAME.findall(value or ""))
            elif name == "hidden" or (name == "aria-hidden" and value == "true"):
                unseen = True
            elif name == "style" and re.search(r"display\s*:\s*none", value or "", re.I):
                unseen = True
        if tag in ("html", "body", "main") or not words.isdisjoint(SPOKEN_OF):
            words = set()
        self.comment = not words.isdisjoint(COMMENTS)
        self.header = tag == "header" or "header" in words
        # Named junk may turn out to hold the article; junk by its tag or unseen can not.
        self.soft = tag == "form" or not (tag == "article" or tag in HEADINGS or words.isdisjoint(WORDS))
        self.junk = unseen or self.comment or self.soft or tag in JUNK


class Line:
    __slots__ = ("text", "tags", "linked", "element")

    def __init__(self, text: str, tags: int, linked: int, element: Element) -> None:
        self.text, self.tags, self.linked, self.element = text, tags, linked, element


class Lines(HTMLParser):
    """Collects the lines of one page, and the elements they lie in, from parser events.

    Inline elements are kept only where they are junk or lie in such; their text is passed over and
    does not end the line around them.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.elements = [Element(0, "#page", None, [])]
        self.open = self.elements[:]
        self.n_open: Counter[str] = Counter()
        self.parts: list[str] = []
        self.tags = self.linked = 0
        self.in_link = False

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            around = next(element for element in reversed(self.open) if not element.inline)
            self.lines.append(Line(text, self.tags, self.linked, around))
        self.parts, self.tags, self.linked = [], 0, 0

    def push(self, element: Element) -> None:
        self.open.append(element)
        self.elements.append(element)
        self.n_open[element.tag] += 1

    def close_to(self, at: int) -> None:
        if not all(element.inline for element in self.open[at:]):
            self.end_line()
        for element in self.open[at:]:
            self.n_open[element.tag] -= 1
        del self.open[at:]

    def handle_starttag(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.end_line()
        self.tags += 1
        if tag in ("br", "img") or tag in CELLS:
            self.parts.append(" ")
        if tag in VOID:
            return
        if tag == "a":
            self.in_link = True
        if tag in ("article", "main"):
            self.before_article()
        for at in range(len(self.open) - 1, 0, -1):
            inner = self.open[at].tag
            if tag in CLOSED_BY.get(inner, ()):
                self.close_to(at)
                break
            if inner in BARRIERS:
                break
        element = Element(len(self.elements), tag, self.open[-1], attributes)
        if not element.inline or element.junk or self.open[-1].inline:
            self.push(element)

    def before_article(self) -> None:
        """An article ends menus, headers and footers left open and shows that elements around it are no junk."""
        for at in range(1, len(self.open)):
            if self.open[at].tag in ENDED and not self.open[at].comment:
                self.close_to(at)
                break
        for element in self.open:
            if element.soft and not element.comment:
                element.junk = False

    def handle_startendtag(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        # HTML knows no self-closing elements but the void ones.
        self.handle_starttag(tag, attributes)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag == "a":
            self.in_link = False
        if self.n_open[tag]:
            for at in range(len(self.open) - 1, 0, -1):
                if self.open[at].tag == tag:
                    self.close_to(at)
                    return
                # A stray end tag ends nothing outside the block it stands in.
                if tag not in BARRIERS and tag not in JUNK and self.open[at].tag in BARRIERS:
                    break
        if tag in BLOCKS:
            self.end_line()

    def parse_html_declaration(self, i: int) -> int:
        """Comments and declarations say nothing; one that never ends takes the rest of the page.

        The parser's own rules look for every end anew, in time that grows with the square of a page.
        """
        end = COMMENT_END.search(self.rawdata, i + 2) if self.rawdata.startswith("<!--", i) else TAG_END.search(self.rawdata, i)
        return end.end() if end else len(self.rawdata)

    def parse_comment(self, i: int, report: bool = True) -> int:
        """Some parsers meet comments here first; one they find no end of ends by the rule above."""
        end = super().parse_comment(i, report)
        return end if end >= 0 else self.parse_html_declaration(i)

    def handle_data(self, data: str) -> None:
        if not self.open[-1].inline:
            self.parts.append(data)
            if self.in_link:
                self.linked += len(data)


def parsed(html: str) -> Lines:
    page = Lines()
    # A tag that never ends is no text.
    unended = TAG_START.search(html, html.rfind(">") + 1)
    page.feed(html[: unended.start()] if unended else html)
    page.close()
    page.end_line()
    return page


def is_clean(page: Lines) -> np.ndarray:
    """Whether no element around a line is junk; a heading in the own header of an article is clean."""
    junk, header, article, heading = (np.zeros(len(page.elements), bool) for _ in range(4))
    for element in page.elements[1:]:
        at, above = element.at, element.parent.at
        article[at] = article[above] or element.tag in ("article", "main")
        heading[at] = heading[above] or element.tag in HEADINGS
        # Junk by nothing but one header in an article, or junk for good.
        header[at] = header[above] or (element.junk and element.header and article[above] and not junk[above])
        junk[at] = junk[above] or (element.junk and not (element.header and article[above]))
    own = np.array([line.element.at for line in page.lines], int)
    return ~(junk[own] | (header[own] & ~heading[own]))


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """Ratios averaged over neighbouring lines with Gaussian weights; none lie beyond the page."""
    kernel = np.exp(-(np.arange(-REACH, REACH + 1) ** 2) / (2 * SIGMA**2))
    return np.convolve(ratios, kernel / kernel.sum(), "full")[REACH : REACH + len(ratios)]


def _within(page: Lines, best: Element) -> np.ndarray:
    """Whether lines lie in the element ``best``."""
    inside = np.zeros(len(page.elements), bool)
    inside[best.at] = True
    for element in page.elements[best.at + 1 :]:
        inside[element.at] = inside[element.parent.at]
    return inside[np.array([line.element.at for line in page.lines], int)]


def region(page: Lines) -> list[Line]:
    """The lines of the content region, in page order."""
    lines = page.lines
    if not lines or not (clean := is_clean(page)).any():
        return []
    sizes = np.array([len(line.text) for line in lines])
    ratios = sizes / np.maximum(1, [line.tags for line in lines])
    smooth = smoothed(ratios * clean) * clean
    chosen = clean & (smooth >= min(smooth.std(), smooth.max()))
    weight = np.zeros(len(page.elements), np.int64)
    for at in np.flatnonzero(chosen):
        weight[lines[at].element.at] += sizes[at]
    for element in reversed(page.elements[1:]):
        weight[element.parent.at] += weight[element.at]
    # The first of the heaviest.
    heaviest = {
        tag: max((element for element in page.elements if element.tag == tag), key=lambda element: weight[element.at], default=None)
        for tag in ("article", "main")
    }
    best, main = heaviest["article"], heaviest["main"]
    if main is not None and (best is None or weight[best.at] < MOST * weight[main.at]):
        best = main
    if best is not None and weight[best.at] > 0:
        return [line for line, ok in zip(lines, clean & _within(page, best)) if ok]
    # Without an article, the region is the innermost element that holds most of the clusters' text.
    best = max((element for element in page.elements if weight[element.at] > MOST * weight[0]), key=lambda element: element.depth)
    while best.tag in PROSE:
        best = best.parent
    inside = np.flatnonzero(clean & _within(page, best))
    # Its clusters and the prose beside and between them, without lists of links.
    first, last = (np.flatnonzero(chosen[inside])[[0, -1]]).tolist()
    prose = np.array([line.linked < MOST * len(line.text) for line in lines], bool)
    of_prose = prose & np.array([line.element.tag in PROSE for line in lines], bool)
    while first > 0 and of_prose[inside[first - 1]]:
        first -= 1
    while last + 1 < len(inside) and of_prose[inside[last + 1]]:
        last += 1
    return [lines[at] for at in inside[first : last + 1] if chosen[at] or prose[at]]


def text_of_page(html: str | None) -> str:
    """The main text: blocks in page order, joined by line ends; empty if there is none."""
    return "\n".join(line.text for line in region(parsed(html or "")))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html).

    Null and empty pages have an empty text; so have pages of markup alone. Repeated rows are pages of
    their own, null ids and urls stay null. Pages are read whole, however long, one after the other;
    broken markup is read as far as the parser can tell.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_bytes(batches, name="html"):
            texts = [text_of_page(html) for html in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(text) for text in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = columns(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
