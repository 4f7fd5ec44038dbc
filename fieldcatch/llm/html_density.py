"""Main text of web pages from parser events and text-to-tag ratios.

The standard library's parser streams a page's events; they are cut into lines, one per block element.
Each line has a ratio of text to tags; the ratios are smoothed with a Gaussian and split in two
clusters by a threshold. The dense lines select the content region: the innermost container that holds
most of their text, with everything in it, and what belongs to it beside it. Where article or main elements
hold the text, only what is in the outermost of them counts. Menus, headers, footers, sidebars, adverts,
forms and comments are never part of a region; a class or id tells them, unless it names the
layout of an element that holds most of the page's text.

Null, empty and textless pages give an empty text.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of HTML: elements without content, elements that begin a line of their own, elements
#: whose text is never content.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main nav ol p pre section "
    "summary table tbody tfoot thead tr ul".split()
)
DROPPED = frozenset(
    "aside button canvas datalist dialog footer form head iframe input menu nav noscript object script "
    "select style svg template textarea title".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROOTS = frozenset(("article", "main"))
#: Elements that hold lines of any kind, as opposed to a heading, an item or a row.
CONTAINERS = frozenset("article body center div fieldset html main section".split())
#: Words in class, id or role that mark page furniture.
FURNITURE = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies "
    "disclaimer disqus footer header masthead menu modal nav navbar navigation newsletter notice popup promo "
    "related search share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
#: Of these, what is not content even where it is most of the text; and words of classes that say what
#: an element has beside it or lacks, as in has-sidebar.
CERTAIN = frozenset(
    "ad ads advert advertisement advertising comment comments cookie cookies disqus newsletter popup promo "
    "related sponsor sponsored subscribe".split()
)
BESIDE = frozenset("has with no without".split())
SIGMA = 1.0
#: Share of the dense text a region has to hold.
MOST = 0.75


@dataclass
class Line:
    """One line of a page: its text, the tags met in it, and where it stands."""

    text: str
    tags: int
    links: int  # characters of links
    root: int  # number of the outermost enclosing article or main element, 0 outside
    box: int  # number of the innermost enclosing container, 0 outside
    mark: int  # number of the innermost enclosing element whose class marks furniture, 0 outside
    heading: bool


@dataclass
class Element:
    """An open element, and what it has from those around it."""

    tag: str
    dropped: bool  # whether its text is
    root: int
    box: int
    mark: int
    heading: bool
    linked: bool
    header: bool  # in a header of an article
    headline: bool  # a heading in it, or in a heading around it


OUTSIDE = Element("", False, 0, 0, 0, False, False, False, False)


class PageLines(HTMLParser):
    """Collects the lines of a page; those in an element marked by its class are told by `content`.

    What a line needs to know is kept with the open elements, so the work does not grow with their number.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.open: list[Element] = []
        self.places: dict[str, list[int]] = {}  # where in `open` the elements of a tag are
        self.blocks: list[int] = []  # where in `open` the blocks are
        self.breaks: list[int] = []  # where in `open` the blocks and the cells marked by their class are
        self.around: dict[int, int] = {}  # a container's innermost enclosing container
        self.marked: dict[int, bool] = {}  # number of an element marked by its class: whether for certain
        self.marked_in: dict[int, int] = {}  # its innermost enclosing one of these
        self.parts: list[str] = []
        self.tags = self.count = self.links = 0

    def _top(self) -> Element:
        return self.open[-1] if self.open else OUTSIDE

    def _flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            top = self._top()
            self.lines.append(Line(text, self.tags, self.links, top.root, top.box, top.mark, top.heading))
        self.parts, self.tags, self.links = [], 0, 0

    def _words(self, tag: str, attrs) -> frozenset[str]:
        """The words in class, id and role that mark the element as furniture."""
        if tag in ("html", "body", "header"):
            return frozenset()
        found: set[str] = set()
        for name in " ".join(v for k, v in attrs if k in ("class", "id", "role") and v).lower().split():
            words = re.split(r"[^a-z]+", name)
            # the names of an article tell its topics too, as in tag-ad
            if not BESIDE.intersection(words) and (tag not in ROOTS or len(words) == 1):
                found.update(FURNITURE.intersection(words))
        return frozenset(found - {"header"} if tag in HEADINGS else found)

    def _close(self, at: int) -> None:
        for held in self.open[at:]:
            self.places[held.tag].pop()
        del self.open[at:]
        for places in (self.blocks, self.breaks):
            while places and places[-1] >= at:
                places.pop()

    def handle_starttag(self, tag: str, attrs) -> None:
        words = self._words(tag, attrs)
        if tag in BLOCK or words and tag in ("td", "th"):
            self._flush()
        if tag in BLOCK and self.blocks:
            # a block ends an open paragraph, an item the item before it
            held = self.open[self.blocks[-1]].tag
            if held == "p" or held == tag == "li":
                self._close(self.blocks[-1])
        self.tags += 1
        if tag == "br" or tag in ("td", "th"):
            self.parts.append(" ")
        if tag in VOID:
            return
        self.count += 1
        n, top = self.count, self._top()
        dropped = top.dropped or tag in DROPPED or tag == "header" and not top.root
        breaks = tag in BLOCK
        mark = top.mark
        if words and (breaks or tag in ("td", "th")):
            self.marked[n], self.marked_in[n] = bool(words & CERTAIN), mark
            breaks, mark = True, n
        elif words:
            dropped = True
        headline = tag in HEADINGS or top.headline
        if top.header:  # of a header inside an article only its headings are content
            dropped = not headline
        box = top.box
        if tag in CONTAINERS:
            self.around[n], box = box, n
        header = top.header or tag == "header" and not dropped
        at = len(self.open)
        self.open.append(Element(
            tag, dropped, top.root or (n if tag in ROOTS else 0), box, mark, top.heading or tag in HEADINGS,
            top.linked or tag == "a", header, headline and top.header,
        ))
        self.places.setdefault(tag, []).append(at)
        if tag in BLOCK:
            self.blocks.append(at)
        if breaks:
            self.breaks.append(at)

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if self.places.get(tag):
            at = self.places[tag][-1]
            if self.breaks and self.breaks[-1] >= at:
                self._flush()
            self._close(at)
        self.tags += 1

    def handle_data(self, data: str) -> None:
        top = self._top()
        if not (top.dropped or top.tag == "header"):
            self.parts.append(data)
            if top.linked:
                self.links += len(" ".join(data.split()))

    def content(self) -> list[Line]:
        """The lines outside furniture. A class does not make furniture of an element with most of the
        page's text, unless an article or main element elsewhere has text too."""
        if not self.marked:
            return self.lines
        held = dict.fromkeys([0, *self.marked], 0)
        for line in self.lines:
            held[line.mark] += max(0, len(line.text) - line.links)
        total = sum(held.values())
        for n in reversed(self.marked):  # an element comes before those in it
            held[self.marked_in[n]] += held[n]
        chain = [0]  # marked elements with most of the text, each in the one before
        for n, certain in self.marked.items():
            if 2 * held[n] > total and (not certain or held[n] == total):
                if self.marked_in[n] != chain[-1]:
                    break
                chain.append(n)
        depth = {n: i for i, n in enumerate(chain)}
        for n, outer in self.marked_in.items():
            depth.setdefault(n, depth[outer])
        deepest: dict[int, int] = {}  # how far down the chain an article or main element has lines
        for line in self.lines:
            deepest[line.root] = max(deepest.get(line.root, 0), depth[line.mark])
        on_chain = set(chain)
        least = min((deepest[x.root] for x in self.lines if x.root and x.mark in on_chain), default=len(chain))
        return [x for x in self.lines if x.mark in on_chain and depth[x.mark] <= least]

    def finish(self) -> list[Line]:
        self.close()
        self._flush()
        return self.content()


def smoothed(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; near the ends the kernel is cut and scaled."""
    reach = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    over = np.convolve(values, kernel)[reach:reach + len(values)]
    weight = np.convolve(np.ones(len(values)), kernel)[reach:reach + len(values)]
    return over / weight


def dense(ratios: np.ndarray) -> np.ndarray:
    """Which values lie in the upper of two clusters: the threshold is moved to the middle of the
    two means until it stays. All values, if they do not differ."""
    if not len(ratios) or ratios.min() == ratios.max():
        return np.ones(len(ratios), bool)
    threshold = ratios.mean()
    for _ in range(100):
        upper = ratios > threshold
        moved = (ratios[upper].mean() + ratios[~upper].mean()) / 2
        if moved == threshold:
            break
        threshold = moved
        if not (ratios > threshold).any() or (ratios > threshold).all():
            return np.ones(len(ratios), bool)  # they differ by rounding only
    return ratios > threshold


def region(lines: list[Line], size: np.ndarray, chosen: np.ndarray, boxes: list[int],
           around: dict[int, int]) -> list[Line]:
    """The lines in the innermost container with most dense text, and those that belong to it.

    `boxes` has the container of each line, `around` the one around each container, outer ones first. Beside
    the region, a branch of the page belongs to it that has dense lines or is a title, and a line
    that stands in a container around it and is not made of links.
    """
    weight, number = dict.fromkeys([0, *around], 0.0), dict.fromkeys([0, *around], 0)
    for box, n, take in zip(boxes, size, chosen):
        weight[box] += n * take
        number[box] += 1
    for c in reversed(around):
        weight[around[c]] += weight[c]
        number[around[c]] += number[c]
    most = MOST * size[chosen].sum()
    least = min(2, len(lines))  # a container of one line is a paragraph
    depth = {0: 0}  # of the innermost container around that is large enough
    large = {0: 0}  # that container
    for c, outer in around.items():
        grows = large[outer] == outer and weight[c] >= most and number[c] >= least
        depth[c] = depth[outer] + grows
        large[c] = c if grows else large[outer]
    best = large[max(boxes, key=depth.__getitem__)]
    known, inside, branch = {0}, {best}, {0: 0}
    c = best
    while c:
        known.add(c)
        c = around[c]
    for c, outer in around.items():
        if outer in inside:
            inside.add(c)
        branch[c] = 0 if c in known else branch[outer] or c
    if not best:
        inside.add(0)

    titles = {branch[c] for c in boxes} - {branch[c] for x, c in zip(lines, boxes) if not x.heading}
    dense_ones = {branch[c] for c, take in zip(boxes, chosen) if take}
    kept = []
    for line, box, take in zip(lines, boxes, chosen):
        linked = 2 * line.links > len(line.text)
        at = branch[box]
        if box in inside or take or not linked and (not at or at in titles or at in dense_ones):
            kept.append(line)
    return kept


def _unlinked_ends(kept: list[Line], lines: list[Line], chosen: np.ndarray) -> list[Line]:
    """`kept` without the lines of links, in containers without dense lines, before the first
    dense line and behind the last: menus that no class tells."""
    spots = np.flatnonzero(chosen)
    if not len(spots):
        return kept
    text = {x.box for x, take in zip(lines, chosen) if take}
    ends = {id(x) for x in lines[:spots[0]] + lines[spots[-1] + 1:] if x.box not in text and 2 * x.links > len(x.text)}
    return [x for x in kept if id(x) not in ends]


def clusters(lines: list[Line], pick: Callable[[np.ndarray], np.ndarray] = dense) -> np.ndarray:
    """Which lines are dense: the upper cluster of the smoothed ratios, as `pick` splits them."""
    ratios = np.array([len(x.text) / max(1, x.tags) for x in lines])
    smooth = smoothed(ratios)
    chosen = pick(smooth)
    # a long line between short ones is dense, a line of links beside a long one is not
    told = (chosen | (ratios >= smooth[chosen].min())) & np.array([2 * x.links <= len(x.text) for x in lines])
    return told if told.any() else chosen


def main_text(html: str | None, pick: Callable[[np.ndarray], np.ndarray] = dense) -> str:
    """The content lines of a page, joined by line breaks."""
    if not isinstance(html, str) or not html:
        return ""
    page = PageLines()
    page.feed(html)
    lines = page.finish()
    if not lines:
        return ""
    size = np.array([len(x.text) for x in lines], dtype=float)
    chosen = clusters(lines, pick)
    inside = np.array([x.root > 0 for x in lines])
    if inside.any() and size[inside & chosen].sum() >= 0.5 * size[~inside & chosen].sum():
        lines = [x for x in lines if x.root]
        # whole articles: the region is a container of them
        kept = region(lines, size[inside], chosen[inside], [page.around[x.root] for x in lines], page.around)
    else:
        kept = _unlinked_ends(region(lines, size, chosen, [x.box for x in lines], page.around), lines, chosen)
    return "\n".join(x.text for x in kept)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """`pages` without the html, plus `text` (main text) and `n_chars` (its code points)."""
    def read(column: pd.Series) -> pd.Series:
        return column.map(main_text)

    kept = [c for c in pages.columns if c not in (html, "text", "n_chars")]
    return pages.select(*kept, F.pandas_udf(read, "string")(F.col(html)).alias("text")).withColumn(
        "n_chars", F.length("text").cast("bigint")
    )
