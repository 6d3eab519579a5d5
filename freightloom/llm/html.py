"""Main text of web pages by text-to-tag ratios.

The standard library's streaming parser sends its events to a collector that cuts the page into lines, one
for each block (paragraph, heading, list item, cell ...). Elements that never hold main text by their
meaning (menus, page headers and footers, sidebars, notices, adverts, forms, scripts, styles, reader
comments) are left out as their events arrive, also those whose class, id or role says so; a name that merely
contains such a word does not, and a name that may mean something else gives way if it would leave out most of
the page. If the page has articles, or else a main element, their lines are looked at alone.

Every line has a ratio, its characters outside links over its tags; the ratios are smoothed along the page by a
Gaussian and split in two clusters at a threshold, if there is a gap between them. Regions, the containers of
lines in the upper cluster, are kept with all their lines, so that a short paragraph between long ones is not
lost, and so is a region with a heading and text of its own.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Container, Iterator
from functools import lru_cache
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements that start a line of their own.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements that hold lines; a line's region is the innermost one around it.
CONTAINERS = frozenset("article body div main section table".split())
#: Elements left out with all they hold.
LEFT_OUT = frozenset(
    "aside audio button canvas datalist dialog embed fieldset footer form head iframe input label menu nav noscript object option"
    " script select style svg template textarea title video".split()
)
#: The same by an element's class, id or role, if a name is made of such words, ends with one, or has none but
#: such and ``LAYOUT_NAMES``. Within an article an id is mostly an anchor: all its words must be such, and that of a
#: heading says nothing.
LEFT_OUT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment commentlist comments consent contentinfo cookie cookies"
    " copyright disqus footer gdpr header masthead menu modal nav navbar navigation navigator newsletter notice notification overlay"
    " pager pagination popup promo promotion related replies reply respond search share sharing sidebar signup skip social sponsor"
    " sponsored subscribe toolbar widget".split()
)
LAYOUT_NAMES = frozenset(
    "area articles bar block body bottom box btn button buttons card cards center col column container content form group grid heading holder"
    " icon icons inner item items left link links list module outer panel post posts region results right row section slot stories strip text"
    " title tools top unit wrap wrapper zone".split()
)
#: Those of the words that also stand in names of main text. Names that rest on them alone yield to a dense block.
UNSURE_NAMES = frozenset(
    "banner header masthead modal notice notification overlay popup promo promotion related search share sharing signup skip social"
    " sponsor subscribe toolbar widget".split()
)
#: Words that turn a name into a statement about the page or its subject, and such that do so in the first place.
_MODIFIERS, _SUBJECTS = frozenset("has no not with without".split()), frozenset("category format status tag type".split())
#: Names of main text, beside which a compound such as ``right-sidebar`` is one about the page too.
_MAIN_NAMES = frozenset("content entry hentry main page post".split())
#: A compound that has one of the first and ends in one of the second is main text's too.
_MAIN_SUBJECTS, _MAIN_ENDS = frozenset("article entry main page post story".split()), frozenset("article body content entry post story text".split())
#: In an article, the names of these do not count, and those of the second group leave it to their own ratio.
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_NAMELESS, _DOUBTED = _HEADINGS | {"blockquote"}, frozenset(("p", "pre"))
#: Elements without content, which never have an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements of which an open one ends where another of its group starts.
_ENDS_BEFORE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_HOLDS_MAIN = frozenset(("html", "body", "main", "article"))

SIGMA = 1.0
#: The mean ratio of the upper cluster's lines over that of the lower one's from which on there is a gap.
GAP = 4.0
#: Left-out text over kept text from which on a name that may mean something else gives way.
OVERRULED = 3
_NAMES = re.compile(r"[a-z]+")
_STARTS = re.compile(r"<[a-zA-Z/!?]")
_COMMENT_END = re.compile(r"--!?>")


@lru_cache(1 << 14)
def name_evidence(name: str) -> int:
    """2 if a class, id or role is made of left-out words, 1 if it is a compound that means one, else 0."""
    words = _NAMES.findall(name)
    found = LEFT_OUT_NAMES.intersection(words)
    if not found or words[0] in _SUBJECTS or not _MODIFIERS.isdisjoint(words):
        return 0
    if LEFT_OUT_NAMES.issuperset(words):
        return 2
    return int(words[-1] in LEFT_OUT_NAMES or all(w in found or w in LAYOUT_NAMES for w in words))


@lru_cache(1 << 14)
def names_main(name: str) -> bool:
    """Whether a name is one of main text, such as ``content`` or ``widget-post-content``."""
    words = _NAMES.findall(name)
    if name in _MAIN_NAMES:
        return True
    compound = len(words) > 1 and words[-1] in _MAIN_ENDS and not _MAIN_SUBJECTS.isdisjoint(words)
    return compound and LEFT_OUT_NAMES.intersection(words) <= {"widget"}


class Line:
    __slots__ = ("tags", "text", "region", "doubted", "linked", "links", "heading", "article", "main")

    def __init__(self, region: int, article: int = 0, main: bool = False) -> None:
        self.text: list[str] = []
        self.tags = 0
        self.region = region
        self.doubted = False  # its element's name speaks against it
        self.linked = 0  # characters in links
        self.links = 0
        self.heading = False
        self.article = article  # number of the outermost article around it, or 0
        self.main = main


class Parser(HTMLParser):
    """The standard parser in linear time on pages whose comments, tags or quotes never end."""

    def read(self, html: str) -> None:
        # What starts behind the last ">" never ends; a "<" there that starts nothing is text.
        end = html.rfind(">") + 1
        unfinished = _STARTS.search(html, end)
        html = html[: unfinished.start()] if unfinished else html
        self._last_comment_end = max(html.rfind("-->"), html.rfind("--!>"))
        self._unbalanced = False
        self.feed(html)
        self.close()

    def parse_comment(self, i: int, report: bool = True) -> int:
        if self._last_comment_end < i + 2:
            return len(self.rawdata)  # a comment without an end goes on to the page's
        end = _COMMENT_END.search(self.rawdata, i + 2)
        return end.end() if end else len(self.rawdata)

    def parse_html_declaration(self, i: int) -> int:
        if self.rawdata.startswith("<!", i) and not self.rawdata.startswith("<!--", i):
            end = self.rawdata.find(">", i)
            return len(self.rawdata) if end < 0 else end + 1
        return super().parse_html_declaration(i)

    def parse_pi(self, i: int) -> int:
        end = self.rawdata.find(">", i)
        return len(self.rawdata) if end < 0 else end + 1

    def parse_starttag(self, i: int) -> int:
        """A tag with a quote that never ends is passed over up to the next ``>``; later ones are only looked at so far."""
        if not self._unbalanced:
            end = super().parse_starttag(i)
            if end >= 0:
                return end
            self._unbalanced = True
        end = self.rawdata.find(">", i) + 1
        if not end:
            return len(self.rawdata)
        if self.rawdata.count('"', i, end) % 2 or self.rawdata.count("'", i, end) % 2:
            return end
        whole = super().parse_starttag(i)
        return whole if whole >= 0 else end


class Unclosed(Parser):
    """Finds the start tags, by number, that no end tag belongs to."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.starts = 0
        self.unclosed: dict[int, str] = {}
        self._open: list[tuple[str, int]] = []
        self._count: Counter[str] = Counter()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in VOID:
            self._open.append((tag, self.starts))
            self._count[tag] += 1
        self.starts += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.starts += 1

    def handle_endtag(self, tag: str) -> None:
        while self._count[tag]:
            name, number = self._open.pop()
            self._count[name] -= 1
            if name == tag:
                return
            self.unclosed[number] = name

    def close(self) -> None:
        super().close()
        self.unclosed.update((number, name) for name, number in self._open)


class Collector(Parser):
    """Turns parser events into lines.

    ``left_open`` has the start tags, by number, of which a left-out one ends where an article, main or body starts.
    Without ``unsure`` names that may mean something else leave nothing out.
    """

    def __init__(self, left_open: Container[int] = (), unsure: bool = True) -> None:
        super().__init__(convert_charrefs=True)
        self.left_open = left_open
        self.unsure = unsure
        self.doubtful_text = 0  # characters left out by such names
        self.holders: list[tuple[int, str]] = []  # left-out elements that such a start was left out with
        self.found_main = False
        self._starts = 0
        self.lines: list[Line] = []
        self.parents = [0]  # by region: the region around it
        self._open: list[tuple[str, int]] = []  # element, region before it
        self._names: Counter[str] = Counter()  # open elements by name
        self._blocks: list[str] = []  # open ones that start a line
        self._region = 0
        self._article = 0  # open articles or mains
        self._articles = 0  # outermost articles so far
        self._skipped: tuple[str, int] | None = None  # element left out, and how many of its name are open
        self._skipped_start = 0
        self._skipped_unsure = False
        self._line = Line(0)

    def _break(self) -> None:
        if self._line.text:
            self.lines.append(self._line)
        self._line = Line(self._region, self._articles if self._names["article"] else 0, self._names["main"] > 0)

    def _left_out(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if tag in LEFT_OUT or (tag == "header" and not self._article):
            return True
        if tag == "article":
            return self._left_out_by_name(tag, attrs)
        if tag in _HOLDS_MAIN or not attrs:
            return False
        if not (self._article and (tag in _NAMELESS or tag in _DOUBTED)) and self._left_out_by_name(tag, attrs):
            return True
        return any(name == "hidden" or (name == "aria-hidden" and value == "true") for name, value in attrs)

    def _left_out_by_name(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        found = self._named(tag, attrs)
        self._skipped_unsure = bool(found) and found <= UNSURE_NAMES
        return bool(found) and (self.unsure or not self._skipped_unsure)

    def _named(self, tag: str, attrs: list[tuple[str, str | None]]) -> frozenset[str]:
        """Words in the names of an element that say that it is to be left out; none if they do not."""
        words: set[str] = set()
        for name, value in attrs:
            if not value or name not in ("class", "id", "role") or (name == "id" and tag in _HEADINGS):
                continue
            names = value.lower().split()
            if self._article:  # an article's own header holds its title
                names = [n for n in names if LEFT_OUT_NAMES.intersection(_NAMES.findall(n)) != {"header"}]
            whole = (name == "id" and (self._article or tag == "article")) or any(map(names_main, names))
            for n in names:
                if name_evidence(n) > whole:
                    words |= LEFT_OUT_NAMES.intersection(_NAMES.findall(n))
        return frozenset(words)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        number, self._starts = self._starts, self._starts + 1
        if self._skipped:
            name, depth = self._skipped
            ends = tag in ("article", "main", "body") and name not in ("script", "style")
            if ends and (self._skipped_start in self.left_open or (tag, name) == ("body", "head")):
                self._skipped = None  # an element left open does not swallow the article
            else:
                if ends:
                    self.holders.append((self._skipped_start, name))
                if tag == name and tag not in VOID:
                    self._skipped = (name, depth + 1)
                return
        if tag in BLOCKS:
            self._close_before(tag)
            self._break()
        self._skipped_unsure = False
        if self._left_out(tag, attrs):
            if tag not in VOID:  # within a paragraph it does not end the line
                self._skipped, self._skipped_start = (tag, 1), number
            return
        self.found_main |= tag in ("article", "main")
        if tag == "br":
            self._line.text.append(" ")
        self._line.tags += 1
        self._line.links += tag == "a"
        self._line.heading |= tag in _HEADINGS
        if tag in _DOUBTED and attrs:
            self._line.doubted = bool(self._named(tag, attrs))
        if tag in VOID:
            return
        self._open.append((tag, self._region))
        self._articles += tag == "article" and not self._names["article"]
        self._names[tag] += 1
        if tag in BLOCKS:
            self._blocks.append(tag)
        if tag in CONTAINERS:
            if not self._article:  # all that an article holds is one region
                self.parents.append(self._region)
                self._region = len(self.parents) - 1
            self._article += tag in ("article", "main")
            self._break()

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in ("script", "style"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if self._skipped:
            name, depth = self._skipped
            if tag == name:
                self._skipped = (name, depth - 1) if depth > 1 else None
            elif tag in ("body", "html"):
                self._skipped = None
            if not self._skipped and name in BLOCKS:
                self._break()
            return
        self._line.tags += 1
        if self._names[tag]:
            self._leave(tag)
        if tag in BLOCKS:
            self._break()

    def handle_data(self, data: str) -> None:
        if self._skipped:
            if self._skipped_unsure:
                self.doubtful_text += len(data.strip())
        elif self._line.text or not data.isspace():
            self._line.text.append(data)
            if self._names["a"]:
                self._line.linked += len(" ".join(data.split()))

    def close(self) -> None:
        super().close()
        self._break()

    def _leave(self, tag: str) -> None:
        """Close the innermost open ``tag`` and what is open in it."""
        while True:
            name, self._region = self._open.pop()
            self._names[name] -= 1
            self._article -= name in ("article", "main")
            if name in BLOCKS:
                self._blocks.pop()
            if name == tag:
                return

    def _close_before(self, tag: str) -> None:
        """Close what ends where ``tag`` starts though its end tag is missing."""
        if self._blocks and (self._blocks[-1] == "p" or self._blocks[-1] in _ENDS_BEFORE.get(tag, ())):
            self._leave(self._blocks[-1])


def smoothed(ratios: list[float], sigma: float = SIGMA) -> list[float]:
    """Gaussian mean of each value and its neighbours within three sigma."""
    reach = math.ceil(3 * sigma)
    kernel = [math.exp(-(k * k) / (2 * sigma * sigma)) for k in range(-reach, reach + 1)]
    out = []
    for i in range(len(ratios)):
        low, high = max(0, i - reach), min(len(ratios), i + reach + 1)
        weights = kernel[low - i + reach : high - i + reach]
        out.append(sum(w * r for w, r in zip(weights, ratios[low:high])) / sum(weights))
    return out


def threshold(values: list[float]) -> float:
    """Midpoint of two clusters of the values (one-dimensional k-means from the extremes)."""
    low, high = min(values), max(values)
    for _ in range(100):
        cut = (low + high) / 2
        lower = [v for v in values if v < cut]
        upper = [v for v in values if v >= cut]
        means = (sum(lower) / len(lower) if lower else low, sum(upper) / len(upper) if upper else high)
        if means == (low, high):
            break
        low, high = means
    return min((low + high) / 2, max(values))


def _collected(html: str, left_open: Container[int] = (), unsure: bool = True) -> Collector:
    collector = Collector(left_open, unsure)
    collector.read(html)
    return collector


def collected(html: str, unsure: bool = True) -> Collector:
    """The page's lines. What a left-out element holds is left out too, unless it is never closed.

    Of several elements of a name, end tags close the inner ones. A page that has no other article and leaves an
    element around a left-out one of the same name open is taken to have left that one open.
    """
    collector = _collected(html, (), unsure)
    if not collector.holders:
        return collector
    tags = Unclosed()
    tags.read(html)
    left_open = set(tags.unclosed)
    if not left_open:
        return collector
    collector = _collected(html, left_open, unsure)
    if collector.holders and not collector.found_main:
        first: dict[str, int] = {}
        for number, name in sorted(tags.unclosed.items()):
            first.setdefault(name, number)
        taken = {number for number, name in collector.holders if first.get(name, number) < number}
        if taken:
            return _collected(html, left_open | taken, unsure)
    return collector


Held = list[tuple[Line, str]]


def _lines(collector: Collector) -> Held:
    texts = ((line, " ".join("".join(line.text).split())) for line in collector.lines)
    return [(line, text) for line, text in texts if text]


def _decided(held: Held) -> Held:
    """The lines of the articles or the main element if there are any, else all.

    Several articles that hold less of the main element's text than the rest of it are parts of that text.
    """
    articles = [(line, text) for line, text in held if line.article]
    main = [(line, text) for line, text in held if line.main]
    if not articles or (main and len({line.article for line, _ in articles}) > 1):
        inside = sum(len(text) for line, text in main if line.article)
        if not articles or 2 * inside < sum(len(text) for _, text in main):
            return main or articles or held
    return articles


def _content(collector: Collector) -> Held:
    """The lines of the regions that hold the main text."""
    held = _decided(_lines(collector))
    if not held:
        return []
    ratios = [max(0, len(text) - line.linked) / (line.tags + 1) for line, text in held]
    values = smoothed(ratios)
    cut = threshold(values)
    lower, upper = ([r for r, v in zip(ratios, values) if (v >= cut) == side] for side in (False, True))
    if lower and sum(upper) / len(upper) < GAP * (sum(lower) / len(lower)):
        cut = min(values)  # no gap: one cluster
    lines = Counter(line.region for line, _ in held)
    # A container of a single line is a paragraph by another name and belongs to the region around it.
    places = [collector.parents[line.region] if lines[line.region] == 1 else line.region for line, _ in held]
    regions = {place for place, value in zip(places, values) if value >= cut}
    headed = {place for place, (line, _) in zip(places, held) if line.heading}
    regions |= headed & {place for place, (line, text) in zip(places, held) if not line.heading and 2 * line.linked < len(text)}
    found = []
    for (line, text), place, ratio, value in zip(held, places, ratios, values):
        listed = not line.article and line.links > 1 and 5 * line.linked >= 4 * len(text)  # a menu by another name
        if place in regions and not (line.doubted and ratio < cut) and not (listed and ratio < cut):
            found.append((line, text))
    return found


def main_text(html: str | None) -> str:
    """Blocks of the page's main text in page order, joined by an empty line; empty if it has none."""
    if not html:
        return ""
    collector = collected(html)
    content = _content(collector)
    if collector.doubtful_text > OVERRULED * sum(len(text) for line, text in content if not line.heading):
        if not any((line.article or line.main) and not line.heading for line, _ in content):
            content = _content(collected(html, unsure=False))
    return "\n\n".join(text for _, text in content)


def extracted(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep`` of every row, its main ``text`` and ``n_chars``, the text's code points.

    Null and empty pages, and pages without text, give an empty text and 0. Pages are read whole, however
    long or broken. Rows repeated in the input are repeated; an empty table gives no rows.
    """
    rows = pages.select(F.col(html).alias("_html"), *keep)
    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:]] + ["text string", "n_chars long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column(0)]
            lengths = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(texts, pa.string()), lengths], [*keep, "text", "n_chars"])

    return rows.mapInArrow(run, fields)
