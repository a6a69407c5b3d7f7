"""Main text of HTML pages from streaming parser events and the text-to-tag ratio of lines.

The standard library's parser streams events. Elements that end a line cut the text into lines; each line knows its text, how
many tags stand in it, how much of it is link text, and which element holds it. Elements that are page furniture by their tag,
role or class mark the lines inside them. The ratio of text outside links to tags per line is smoothed with a Gaussian; lines
above the threshold are content. The region is the element in which the content clusters: an article or main element if the
page marks one and less than half of the content lies outside such elements, otherwise the smallest element with most of the
content. A marked region keeps all its lines that are not furniture, short ones and links too. Of another one the cluster is
kept, from its first to its last line of content, without the link lines in it that are below the threshold.
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

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that start and end a line.
LINES = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody tfoot thead tr ul".split())
# Elements whose text is never content.
SILENT = frozenset(
    "applet audio button canvas datalist head iframe map noframes noscript object script select style svg template "
    "textarea title video".split())
FURNITURE = frozenset("aside dialog fieldset footer form menu nav search".split())
FURNITURE_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
# Words of class and id names that mark furniture.
FURNITURE_NAMES = frozenset(
    "ad ads adv advert advertisement advertising adverts banner banners bottombar breadcrumb breadcrumbs comment comments "
    "consent cookie cookies disqus discussion footer gdpr login masthead menu menus modal nav navbar navigation newsletter "
    "notice notices notification overlay pager pagination popup promo promotion reactions recommended related replies reply "
    "respond search share sharebar sharing sidebar sidenav signup skip social sponsor sponsored subscribe subscription "
    "teaser teasers toolbar topbar widget widgets".split())
# Elements that are one block of text. In an article only a whole class or id makes them furniture, not a word of it.
BLOCKS = frozenset("blockquote caption dd dt figcaption h1 h2 h3 h4 h5 h6 li p pre td th tr".split())
# Furniture whose articles are not the article of the page.
APART = frozenset(
    "aside footer comment comments disqus discussion reactions recommended related replies reply respond teaser teasers "
    "widget widgets".split())
CLOSED_BY = {
    "li": frozenset(["ul", "ol", "menu", "dir"]), "dt": frozenset(["dl"]), "dd": frozenset(["dl"]),
    "tr": frozenset(["table"]), "td": frozenset(["tr", "table"]), "th": frozenset(["tr", "table"]),
    "option": frozenset(["select", "datalist"]),
}
CONTENT_TAGS = frozenset(["article", "main"])
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
# A tag or comment that the end of the page cuts off.
UNFINISHED = re.compile(r"</?[A-Za-z]|<!--|<[!?]")

SIGMA = 1.0
THRESHOLD = 0.5  # of the deviation of the smoothed ratios
MAX_LINK_SHARE = 0.6
WRAPPER = 0.6  # of the text of a page, from which a name alone does not make furniture
RUNNING = frozenset("a b em i li p span strong".split())
MOST = 0.7  # of the content that a region without an article holds
MARKED = 0.5  # of the content, which marked articles have to hold


class Element:
    __slots__ = ("number", "tag", "parent", "silent", "furniture", "named", "apart", "root", "in_root", "holds_root")

    def __init__(self, number: int, tag: str, parent: Element | None) -> None:
        self.number, self.tag, self.parent = number, tag, parent
        self.silent = tag in SILENT or bool(parent and parent.silent)
        self.apart = bool(parent and parent.apart)
        self.in_root = bool(parent and (parent.root or parent.in_root))
        self.furniture = self.named = self.root = self.holds_root = False


class Line:
    __slots__ = ("text", "size", "tags", "linked", "element")

    def __init__(self, text: str, tags: int, linked: int, element: Element) -> None:
        self.text, self.tags, self.linked, self.element = text, tags, linked, element
        self.size = len(text) - text.count(" ")  # without white space, as is ``linked``


class Lines(HTMLParser):
    """Collects the lines of a page from the events of the parser."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.elements: list[Element] = [Element(0, "", None)]  # parents come before what is in them
        self.stack: list[Element] = [self.elements[0]]
        self.open: Counter[str] = Counter()
        self.parts: list[str] = []
        self.tags = self.linked = 0

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append(Line(text, self.tags, self.linked, self.stack[-1]))
        self.parts.clear()
        self.tags = self.linked = 0

    def _pop(self, size: int) -> None:
        for element in self.stack[size:]:
            self.open[element.tag] -= 1
        del self.stack[size:]

    def _close(self, tag: str, limits: frozenset[str] = frozenset()) -> None:
        if not self.open[tag]:
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                self._pop(i)
                return
            if self.stack[i].tag in limits:
                return

    def _open(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        element = Element(len(self.elements), tag, self.stack[-1])
        values = {name: value or "" for name, value in attributes}
        role = values.get("role", "").lower()
        names = {w.lower() for key in ("class", "id") for w in NAME.findall(values.get(key, ""))}
        if tag in BLOCKS and element.in_root:
            names = {w.lower() for key in ("class", "id") for w in values.get(key, "").split()}
        headed = not element.in_root
        element.named = bool(names & FURNITURE_NAMES) or (headed and "header" in names)
        element.furniture = (
            tag in FURNITURE or role in FURNITURE_ROLES or element.named or (headed and tag == "header") or "hidden" in values
            or values.get("aria-hidden", "").lower() == "true"
            or "display:none" in values.get("style", "").replace(" ", "").lower())
        if tag in ("html", "body"):
            element.furniture = element.named = False
        element.apart |= element.furniture and (tag in APART or bool(names & APART))
        element.root = not element.furniture and not element.silent and not element.apart and (
            tag in CONTENT_TAGS or role in CONTENT_TAGS or values.get("itemprop") == "articleBody")
        if element.root:
            for above in reversed(self.stack):
                if above.holds_root:
                    break
                above.holds_root = True
        self.elements.append(element)
        self.stack.append(element)
        self.open[tag] += 1

    def handle_starttag(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        if tag in LINES:
            self.flush()
            self._close("p", LINES - {"p"})
        elif tag == "a":
            self._close("a", LINES)
        if tag in CLOSED_BY:
            self._close(tag, CLOSED_BY[tag])
        if tag in ("br", "td", "th"):
            self.parts.append(" ")
        if not self.stack[-1].silent:
            self.tags += 1
        if tag not in VOID:
            self._open(tag, attributes)

    def handle_startendtag(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attributes)  # a slash closes void elements only

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            return
        if tag in LINES:
            self.flush()
        if not self.stack[-1].silent:
            self.tags += 1
        # An end tag of running text does not reach over the element that holds the line.
        self._close(tag, frozenset() if tag in LINES or tag in SILENT or tag in ("td", "th") else LINES)

    def handle_data(self, data: str) -> None:
        if not self.stack[-1].silent:
            self.parts.append(data)
            if self.open["a"]:
                self.linked += len("".join(data.split()))

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        return self.parse_bogus_comment(i)

    def finish(self) -> list[Line]:
        if UNFINISHED.match(self.rawdata):
            self.rawdata = ""
        self.close()
        self.flush()
        return self.lines

    def held(self, weights: list[int]) -> list[int]:
        """Weights of elements added up over all that is in them."""
        total = list(weights)
        for element in reversed(self.elements[1:]):
            total[element.parent.number] += total[element.number]
        return total

    def below(self, chosen: list[bool]) -> list[bool]:
        """Flags of the chosen elements and all that is in them."""
        out = list(chosen)
        for element in self.elements[1:]:
            out[element.number] = out[element.number] or out[element.parent.number]
        return out


def _furniture(page: Lines) -> list[bool]:
    """Flags of the elements in furniture; what holds the article, or most of the page by its name alone, is a wrapper."""
    weights = [0] * len(page.elements)
    for line in page.lines:
        if not line.element.apart:
            weights[line.element.number] += len(line.text)
    total = page.held(weights)
    return page.below([
        e.furniture and not e.holds_root and (not e.named or e.apart or total[e.number] <= WRAPPER * total[0])
        for e in page.elements])


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian means; at the ends the weights that are left count as the whole."""
    reach = max(1, int(3 * sigma))
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    total = np.convolve(ratios, weights)[reach:-reach]
    return total / np.convolve(np.ones(len(ratios)), weights)[reach:-reach]


def content_lines(ratios: np.ndarray, sigma: float = SIGMA, threshold: float = THRESHOLD) -> np.ndarray:
    """Flags of the lines whose smoothed ratio is above the threshold; the highest line always is."""
    if not len(ratios):
        return np.zeros(0, bool)
    smooth = smoothed(ratios, sigma)
    return smooth >= min(threshold * smooth.std(), smooth.max())


def _region(page: Lines, lines: list[Line], content: np.ndarray) -> Element | None:
    """The element in which the content clusters."""
    weights = [0] * len(page.elements)
    for line, chosen in zip(lines, content, strict=True):
        if chosen:
            weights[line.element.number] += len(line.text)
    credit = page.held(weights)
    roots = [e for e in page.elements if e.root and credit[e.number]]
    if sum(credit[e.number] for e in roots if not e.in_root) >= MARKED * credit[0] > 0:
        best = max(roots, key=lambda e: (credit[e.number], -e.number))
        inside = page.below([e is best for e in page.elements])
        # Further in, as long as most of the content is there; later elements of one line are deeper.
        return [e for e in roots if inside[e.number] and credit[e.number] >= MOST * credit[best.number]][-1]
    holders = [e for e in page.elements if e.tag not in RUNNING and credit[e.number] >= MOST * credit[0] > 0]
    return holders[-1] if holders else None


def _cluster(lines: list[Line], content: list[bool]) -> list[Line]:
    """The lines from the first to the last one of content, without the lines of links that are none.

    A line of links at either end is no content: the mean of its neighbours alone lifts it above the threshold.
    """
    links = [x.linked > MAX_LINK_SHARE * x.size for x in lines]
    own = [i for i, chosen in enumerate(content) if chosen and not links[i]]
    if not own:
        return []
    hull = range(own[0], own[-1] + 1)
    return [lines[i] for i in hull if content[i] or not links[i]]


def main_text(html: str | None) -> str:
    """The article of a page, one line per block; empty if there is none."""
    page = Lines()
    page.feed(html or "")
    page.finish()
    furniture = _furniture(page)
    lines = [line for line in page.lines if not furniture[line.element.number]]
    if not lines:
        return ""
    content = content_lines(np.array([(line.size - line.linked) / max(1, line.tags) for line in lines]))
    region = _region(page, lines, content)
    if region is None:
        return ""
    inside = page.below([e is region for e in page.elements])
    kept = [(line, chosen) for line, chosen in zip(lines, content.tolist(), strict=True) if inside[line.element.number]]
    if region.root:
        return "\n".join(line.text for line, _ in kept)
    return "\n".join(line.text for line in _cluster([line for line, _ in kept], [chosen for _, chosen in kept]))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every row.

    Character references are decoded and white space inside a block is one space. A null or empty page, or one without
    content, has an empty text. Pages are worked on one by one and whole, so ids and urls may be null or repeat. Other columns
    are dropped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = [main_text(page.as_py()) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64()),
            ], names=["page_id", "url", "text", "n_chars"])

    wanted = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
        F.col(html).cast("string").alias("html"))
    return wanted.mapInArrow(run, "page_id long, url string, text string, n_chars long")
