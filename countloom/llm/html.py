"""Main text of web pages.

The standard library's streaming parser gives events; block elements cut the page into lines. Text counts by the state in which it
arrives: that in menus, headers, footers, sidebars, notices, adverts, forms, scripts and reader comments (by element, by role, or by the
tokens of a class or id) is no content. An article or main inside a part that is marked by class or id only is content again, such an
article where the page has no other content region with clusters. Each line has its text, how much of it is links, the number of its tags and the region it stands in.
The text-to-tag ratio of the lines is smoothed by a Gaussian; lines above the threshold form clusters, and these choose the content,
whatever tag holds them: the outermost articles and mains that hold clusters, each whole with all that is nested in it; and the body, where
no article or main holds clusters or the body's own clusters have more text than theirs. Of the body all lines between its first and
last cluster count, lists of links too, and the lines around these up to ``BESIDE`` or more lines that are all links (menus without a mark) or a copyright line. If marks by class or id
leave nothing of a page, they don't count on it.
All lines of the content, in page order, are the text.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Element names by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template head title svg math canvas iframe object select option button textarea".split())
OUTSIDE = frozenset("nav header footer aside form dialog menu".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
REGIONS = frozenset(["article", "main"])
#: An open p ends where one of these begins; li, dd, dt, tr, td and th end their own kind.
ENDS_P = BLOCKS - {"br", "html", "body"}
ENDS_OWN = {"li": ("li",), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "dd": ("dd", "dt"), "dt": ("dd", "dt")}
LISTS = frozenset("ul ol dl table".split())
#: Tokens of a class or id that mark a part as no content, alone or as the first or last word of a token.
MARKS = frozenset(
    "nav navbar navigation footer sidebar aside widget ad ads advert adverts advertisement advertising sponsor sponsored cookie cookies consent notice notices newsletter breadcrumb breadcrumbs comment comments commentlist commentform disqus reply replies respond login signup pagination popup modal cookiebar cookiebanner".split()
)
#: Of these, words that as the first of a token's several words mark it only before one of PARTS (comment-list, but not comments-open).
AMBIGUOUS = frozenset("navigation notice notices modal comment comments reply replies respond popup login signup aside sponsor widget".split())
#: Such tokens that also stand for content: alone, as the first token of several, or joined with one of the words of PARTS.
WEAK = frozenset("share sharing social related recommended search subscribe promo alert menu pager copyright banner".split())
PARTS = frozenset("bar bars box block button buttons links link list icons items item posts articles panel section container wrapper area tools main top bottom left right mobile site page body content text author meta thread form title count inner wrap".split())
#: The same for what heads a page; inside an article or main these are its title.
HEADS = frozenset("header masthead".split())
OUTSIDE_ROLES = frozenset(["navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"])
_WORDS = re.compile(r"[a-z]+")
#: Tokens that say what a page or its layout has, not what the element is.
_ABOUT = re.compile(r"(has|have|no|not|non|with|without|hide|show)[-_]|.*[-_](with|without|has|no)[-_]|.*[-_](free|less)$")
#: Elements that hold running text; in an article or main, weak marks say nothing of them.
RUNNING = frozenset("p h1 h2 h3 h4 h5 h6 b i em strong span a blockquote pre figcaption".split())
#: Lines in a row that are all links, from which on they are a menu: of the body as a whole, and beside its clusters.
LINKS, BESIDE = 3, 2
_COPYRIGHT = re.compile(r"(©|\(c\)|copyright\b)", re.I)


def marked(value: str, inside: bool, running: bool = False) -> bool:
    """Whether a class or id names a part that is no content; inside tells of an article or main around it, running of an element of running text."""
    for k, token in enumerate(value.lower().split()):
        if _ABOUT.match(token):
            continue
        words = _WORDS.findall(token)
        if not words:
            continue
        first, last, alone = words[0], words[-1], len(words) == 1
        if last in MARKS or (first in MARKS and (first not in AMBIGUOUS or last in PARTS)):
            return True
        if not inside and (first in HEADS or last in HEADS):
            return True
        if not (inside and running) and (first in WEAK or last in WEAK) and (k == 0 if alone else first in PARTS or last in PARTS or first in WEAK and last in WEAK):
            return True
    return False


class Lines(HTMLParser):
    """Collects lines (text, link characters, tags, region) from the parser's events."""

    def __init__(self, marks: bool = True) -> None:
        super().__init__(convert_charrefs=True)
        self.marks = marks  # whether classes and ids count
        self.lines: list[tuple[str, int, int, int]] = []
        self.tops: list[int] = [0]  # the outermost article or main around each region; region 0 is the body
        self.articles: list[bool] = [False]
        self.again: set[int] = set()  # articles inside parts marked by class or id
        self.open: list[tuple[str, bool, bool, bool, int, bool]] = [("", False, False, False, 0, False)]  # name, outside, firm (outside by element, role or hidden), silent, region, link
        self.where: dict[str, list[int]] = {}  # places in open, by name
        self.blocks: list[int] = [0]
        self.lists: list[int] = [0]
        self.parts: list[str] = []
        self.region = self.linked = self.tags = 0
        self.closing = False

    def cut(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append((text, self.linked, self.tags, self.region))
            self.tags = 0
        self.parts, self.linked = [], 0

    def drop(self, at: int) -> None:
        """Close the open elements from a place on."""
        while len(self.open) > at:
            name = self.open.pop()[0]
            self.where[name].pop()
        for places in (self.blocks, self.lists):
            while places[-1] >= at:
                places.pop()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.cut()
            if tag in ENDS_P and (p := self.where.get("p")) and p[-1] > self.blocks[-1]:
                self.drop(p[-1])
            if tag in ENDS_OWN and (last := max((x[-1] for n in ENDS_OWN[tag] if (x := self.where.get(n))), default=0)) > self.lists[-1]:
                self.drop(last)
        self.tags += 1
        if tag in VOID:
            return
        _, outside, firm, silent, region, link = self.open[-1]
        silent, link, inside = silent or tag in SILENT, link or tag == "a", region > 0
        again = False
        if tag in REGIONS and outside and not firm and not any(v and k in ("class", "id") and marked(v, True) for k, v in attrs):
            outside, again = False, tag == "article"
        if tag not in ("html", "body", "article", "main"):
            firm = firm or (tag in OUTSIDE and not (tag == "header" and self.articles[region]))
            for name, value in attrs:
                if value and name in ("class", "id"):
                    outside = outside or (self.marks and marked(value, inside, tag in RUNNING))
                elif name == "role" and value:
                    firm = firm or value.lower() in OUTSIDE_ROLES
                elif name == "hidden":
                    firm = True
        outside = outside or firm
        if tag in REGIONS and not outside:
            top, region = self.tops[region], len(self.tops)
            self.tops.append(top or region)
            self.articles.append(tag == "article")
            if again:
                self.again.add(region)
        at = len(self.open)
        self.where.setdefault(tag, []).append(at)
        if tag in BLOCKS and tag != "p":
            self.blocks.append(at)
            if tag in LISTS:
                self.lists.append(at)
        self.open.append((tag, outside, firm, silent, region, link))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.cut()
        self.tags += 1

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.cut()
        self.tags += 1
        if places := self.where.get(tag):
            self.drop(places[-1])

    def parse_comment(self, i: int, report: int = 1) -> int:
        """A comment that nothing ends goes on to the page's end, as in browsers."""
        end = super().parse_comment(i, report)
        return len(self.rawdata) if end < 0 and self.closing else end

    def close(self) -> None:
        self.closing = True
        super().close()

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """An unknown section is a comment up to its next angle bracket, as in browsers; the library raises there."""
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:
            return self.rawdata.find(">", i + 3) + 1 or -1

    def handle_data(self, data: str) -> None:
        _, outside, _, silent, region, link = self.open[-1]
        if outside or silent:
            if data and not data.isspace():
                self.tags = 0  # the tags of other parts are not the next line's
            return
        if not self.parts:
            self.region = region
        self.parts.append(data)
        if link:
            self.linked += len("".join(data.split()))


def smoothed(x: np.ndarray, sigma: float) -> np.ndarray:
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    full = np.convolve(x, kernel)[reach : reach + len(x)]
    return full / np.convolve(np.ones(len(x)), kernel)[reach : reach + len(x)]


def between(chosen: np.ndarray, menu: np.ndarray, beside: np.ndarray) -> np.ndarray:
    """Of the body's lines: all from the first to the last chosen one, and those around them up to what stands beside content (menus, copyright lines)."""
    at = np.flatnonzero(chosen & ~beside)  # smoothing also lifts the link next to a paragraph
    if not len(at):
        return ~menu
    first, last = at[0], at[-1]
    while first > 0 and not beside[first - 1]:
        first -= 1
    while last + 1 < len(menu) and not beside[last + 1]:
        last += 1
    keep = np.zeros(len(menu), bool)
    keep[first : last + 1] = True
    return keep


def runs(x: np.ndarray, least: int) -> np.ndarray:
    """x where it holds so many times in a row."""
    out = x.copy()
    edge = np.flatnonzero(np.diff(np.concatenate([[False], x, [False]]).astype(np.int8)))
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        if b - a < least:
            out[a:b] = False
    return out


def weights(top: np.ndarray, sizes: np.ndarray, chosen: np.ndarray) -> dict[int, float]:
    """The text of the chosen lines of each region."""
    out: dict[int, float] = {}
    for t, n in zip(top[chosen].tolist(), sizes[chosen].tolist(), strict=True):
        out[t] = out.get(t, 0.0) + n
    return out


def parsed(html: str, marks: bool = True) -> Lines:
    """The page's lines. Behind the last angle bracket no tag can end: an open one there is left out, as in browsers, and other text stays."""
    parser, end = Lines(marks), html.rfind(">") + 1
    tail = re.split(r"<(?=[A-Za-z/!?])", html[end:], maxsplit=1)[0]
    parser.feed(html[:end])
    parser.feed(tail.replace("<", "&lt;"))
    parser.close()
    parser.cut()
    return parser


def main_text(html: str | None, sigma: float = 1.0) -> str:
    """The text of the page's content. Where marks by class or id leave nothing, they name what the page is rather than what to leave out, and don't count."""
    text = _chosen_text(parsed(html), sigma) if html else ""
    return text if text or not html else _chosen_text(parsed(html, False), sigma)


def _chosen_text(parser: Lines, sigma: float) -> str:
    lines = parser.lines
    if not lines:
        return ""
    sizes = np.array([len(x[0]) for x in lines], dtype=float)
    ratio = smoothed(sizes / np.maximum(1, [x[2] for x in lines]), sigma)
    chosen = ratio >= min(float(ratio.std()), float(ratio.max()))
    region = np.array([x[3] for x in lines])
    top = np.array(parser.tops)[region]
    again = np.isin(region, list(parser.again))
    own = weights(top, sizes, chosen & ~again & (top > 0))
    if own:
        take = np.isin(top, list(own)) & ~again
    else:  # articles in marked parts only where there is nothing else
        own = weights(top, sizes, chosen & again)
        take = np.isin(top, list(own))
    body = top == 0
    if sizes[chosen & body].sum() > sum(own.values()) or not own:
        full = np.array([len(x[0].replace(" ", "")) for x in lines])
        linked = np.array([x[1] for x in lines])[body] >= 0.9 * full[body]
        rights = np.array([bool(_COPYRIGHT.match(x[0])) for x in lines])[body]
        take[np.flatnonzero(body)[between(chosen[body] & ~rights, runs(linked, LINKS), runs(linked, BESIDE) | rights)]] = True
    return " ".join(x[0] for x, t in zip(lines, take.tolist(), strict=True) if t)


def extract_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) of each page.

    Null and empty pages and pages without content give an empty text. Very long pages are read whole, in time linear in their length. Repeated rows each get a
    row; an empty table gives an empty result; other columns are not read. Of equally heavy regions all count.
    """

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                texts = [main_text(x) for x in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    d = pages.select("page_id", "url", F.col(html).alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in d.schema}
    out = d.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
