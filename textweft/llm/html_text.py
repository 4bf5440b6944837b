"""The main text of web pages, from a stream of parser events.

The standard library's parser reports tags and text as it reads. Block tags and line breaks
end a line; a line has a ratio of text to tags. The ratios are smoothed by a Gaussian along
the page and clustered by a threshold, their standard deviation; a region of the page (an
article, or else the innermost container of a line) is content if one of its smoothed lines
reaches it, or if it lies beside such a region and is no list of links. Elements that are
boilerplate by their tag or role count as lines without text; so do those with such a name
in their class or id, unless they hold the article or most of the text. Within chosen regions
every other line is kept, however short.
"""

import math
import re
from dataclasses import dataclass, replace
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from textweft.llm.common import map_columns

SIGMA = 1.5
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter output progress q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
MAIN = frozenset(("article", "main"))
CONTAINERS = MAIN | frozenset("body div section td th table ul ol dl details center".split())
DROPPED = frozenset(
    "script style noscript template title nav header footer aside form button select option textarea input iframe "
    "object svg math canvas audio video dialog menu datalist fieldset".split()
)
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split()
)
# Names in classes and ids. The first are not content whatever they hold, but for a container of
# the page's article; the others only where most of the text lies elsewhere.
NEVER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements advertising breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies disqus gdpr menu menus modal modals nav navbar navigation newsletter overlay overlays pager "
    "pagination popup popups replies reply respond subscribe signup toolbar".split()
)
SELDOM_NAMES = frozenset(
    "banner banners footer footers header headers hidden login masthead notice notices promo promotion promotions recommended "
    "related share sharing side sidebar sidebars social sponsor sponsored sponsors widget widgets".split()
)
COMMENT_NAMES = frozenset("comment comments commentlist disqus replies reply respond".split())
ABOUT_OTHERS = frozenset("has no not with without".split())  # a name that starts so tells of something else
KEPT, BY_NAME, NEVER_BY_NAME, DROP = range(4)


def name_parts(value: str) -> set[str]:
    """The parts of class names; names such as ``has-sidebar`` say nothing of their own element."""
    found: set[str] = set()
    for name in value.lower().split():
        parts = [x for x in re.split(r"[_-]+", name) if x]
        if parts and parts[0] not in ABOUT_OTHERS:
            found.update(parts)
    return found


def judged(tag: str, attributes: list[tuple[str, str | None]]) -> int:
    """Whether an element is dropped, or may be by its name."""
    if tag in DROPPED:
        return DROP
    found = KEPT
    for name, value in attributes:
        if name in ("hidden", "aria-hidden") and value in (None, "", "hidden", "true"):
            return DROP
        if name == "role" and value and value.lower() in DROPPED_ROLES:
            return DROP
        if name in ("class", "id") and value and tag not in ("html", "body"):
            parts = name_parts(value)
            if tag in MAIN:
                parts &= COMMENT_NAMES
            if parts & NEVER_NAMES:
                found = NEVER_BY_NAME
            elif parts & SELDOM_NAMES:
                found = max(found, BY_NAME)
    return found


@dataclass
class Line:
    text: str
    tags: int
    region: int
    main: bool
    named: int  # the innermost element around it that is dropped for its name, unless spared; -1 for none
    linked: int  # characters of the text that are links


@dataclass
class Open:
    tag: str
    dropped: bool = False
    named: int = -1
    region: int = 0
    main: bool = False


class Lines(HTMLParser):
    """Collects the lines of a page; the text of dropped elements is empty."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.open: list[Open] = []
        self.parts: list[str] = []
        self.tags = self.links = self.linked = 0
        self.parents = [0]  # the region around each region
        self.never: list[bool] = []  # of each element with a telling name
        self.above: list[int] = []  # the next such element around each
        self.around_main: set[int] = set()  # the innermost ones that hold an article

    def place(self) -> Open:
        return self.open[-1] if self.open else Open("")

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text or self.tags:
            at = self.place()
            self.lines.append(Line("" if at.dropped else text, max(self.tags, 1), at.region, at.main, at.named, self.linked))
        self.parts, self.tags, self.linked = [], 0, 0

    def handle_starttag(self, tag, attrs):
        if tag not in INLINE:
            self.end_line()
            if self.open and self.open[-1].tag in ("p", "li", "dt", "dd", "option") and (
                tag == self.open[-1].tag or tag in CONTAINERS | {"p"} and self.open[-1].tag == "p"
            ):
                self.open.pop()  # these end where the next one starts
        self.tags += 1
        if tag in VOID:
            return
        if tag == "a":
            self.links += 1
        at, verdict = self.place(), judged(tag, attrs)
        drops = verdict != KEPT
        if tag in CONTAINERS or drops or at.dropped:
            if (drops or at.dropped) and tag in INLINE:
                self.end_line_kept()
            region, main, named = at.region, at.main, at.named
            if tag in CONTAINERS and not main:
                self.parents.append(region)
                region, main = len(self.parents) - 1, tag in MAIN and not drops
                if main:
                    self.around_main.add(named)
            if verdict in (BY_NAME, NEVER_BY_NAME):
                self.never.append(verdict == NEVER_BY_NAME)
                self.above.append(named)
                named = len(self.never) - 1
            self.open.append(Open(tag, at.dropped or verdict == DROP, named, region, main))

    def end_line_kept(self) -> None:
        """Cut the line before an inline element that is dropped, so that only its text goes."""
        tags = self.tags
        self.tags = 0 if not "".join(self.parts).strip() else tags
        self.end_line()
        self.tags = 1

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self.end_line()
        elif self.open and self.open[-1].tag == tag and (self.open[-1].dropped or self.open[-1].named != (self.open[-2].named if len(self.open) > 1 else -1)):
            self.end_line()
        self.tags += 1
        if tag == "a":
            self.links = max(0, self.links - 1)
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at].tag == tag:
                del self.open[at:]
                return

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # as browsers do, which pass over the slash

    def handle_data(self, data):
        self.parts.append(data)
        if self.links:
            self.linked += len(data.strip())

    def unknown_decl(self, data):
        pass

    def judged_lines(self) -> list[Line]:
        """The lines, without the text of what is dropped for its name.

        A container of the page's article is kept whatever its name. Where no article lies
        outside it, so is one that holds most of the text, unless its name is never content.
        """
        total, outside = 0, 0
        inside, in_main = [0] * len(self.never), [0] * len(self.never)
        for line in self.lines:
            size = len(line.text)
            total += size
            outside += size if line.main else 0
            if line.named >= 0:
                inside[line.named] += size
                in_main[line.named] += size if line.main else 0
        for i in range(len(self.never) - 1, -1, -1):  # an element comes after those around it
            up = self.above[i]
            if up >= 0:
                inside[up] += inside[i]
                in_main[up] += in_main[i]
            if i in self.around_main:
                self.around_main.add(up)
        gone: list[bool] = []
        for i, never in enumerate(self.never):
            most = 2 * inside[i] > total and outside <= in_main[i]
            goes = i not in self.around_main and (never or not most)
            gone.append(goes or self.above[i] >= 0 and gone[self.above[i]])
        return [replace(x, text="") if x.text and x.named >= 0 and gone[x.named] else x for x in self.lines]


def smoothed(values: list[float], sigma: float = SIGMA) -> list[float]:
    """Gaussian smoothing; the kernel is cut and weighted anew at the ends."""
    reach = math.ceil(3 * sigma)
    kernel = [math.exp(-((d / sigma) ** 2) / 2) for d in range(-reach, reach + 1)]
    out = []
    for at in range(len(values)):
        low, high = max(0, at - reach), min(len(values), at + reach + 1)
        weights = kernel[low - at + reach : high - at + reach]
        out.append(sum(w * v for w, v in zip(weights, values[low:high])) / sum(weights))
    return out


def _beside(lines: list[Line], chosen: set[int], parents: list[int]) -> set[int]:
    """Regions of text, not of links, that lie next to a chosen one in the same parent."""
    text: dict[int, int] = {}
    linked: dict[int, int] = {}
    order: dict[int, list[int]] = {}
    for line in lines:
        if line.text:
            if line.region not in text:
                order.setdefault(parents[line.region], []).append(line.region)
            text[line.region] = text.get(line.region, 0) + len(line.text)
            linked[line.region] = linked.get(line.region, 0) + line.linked
    found: set[int] = set()
    for regions in order.values():
        for step in (1, -1):
            near = False
            for region in regions[::step]:
                if region in chosen:
                    near = True
                else:
                    near = near and 2 * linked[region] < text[region]
                    if near:
                        found.add(region)
    return found


def main_text(html: str | None, sigma: float = SIGMA) -> str:
    """The text of the content regions: lines in page order, joined by one space."""
    if not html:
        return ""
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.end_line()
    lines = parser.judged_lines()
    ratios = smoothed([len(line.text) / line.tags for line in lines], sigma)
    best: dict[int, float] = {}
    in_article: set[int] = set()
    for line, ratio in zip(lines, ratios):
        if line.text:
            best[line.region] = max(best.get(line.region, 0.0), ratio)
            if line.main:
                in_article.add(line.region)
    if not best:
        return ""
    if in_article:  # what the page marks as its article outranks unmarked regions
        best = {r: b for r, b in best.items() if r in in_article}
    mean = sum(ratios) / len(ratios)
    spread = math.sqrt(sum((r - mean) ** 2 for r in ratios) / len(ratios))
    threshold = min(spread, max(best.values()))
    chosen = {r for r, b in best.items() if b >= threshold}
    if not in_article:
        chosen |= _beside(lines, chosen, parser.parents)
    return " ".join(line.text for line in lines if line.text and line.region in chosen)


def extract_text(pages: DataFrame, html: str = "html", name: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add the main text of each row's whole page; null, empty and textless pages give ``""``.

    Pages are read one by one: equal pages give equal texts and repeated rows stay repeated.
    A column with the result's name is replaced.
    """

    def work(columns: dict[str, list]) -> dict[str, list]:
        return {name: [main_text(value) for value in columns[html]]}

    return map_columns(pages, [html], T.StructType([T.StructField(name, T.StringType())]), work, keep)
