"""Main text of web pages from parser events and text-to-tag ratios.

The standard library's parser runs over the page once.  Block elements end lines;
each line keeps its characters, the tags that stood in it and the container it lies
in.  The ratios of characters to tags are smoothed with a Gaussian along the page, and
two-means clustering of their logarithms sets the threshold: lines from it on are
selected.  The content region follows from them: the ``article`` and ``main`` elements
that hold selected lines, if these hold at least half of the selected text; else the smallest container that
holds nearly all of it, and from there outwards while what is added is mostly selected.
All lines of the region are kept, selected or not, but for those in menus, forms,
notices, adverts, comments and the like.

Such parts are known by their element, or by whole names in class, id and role: names
put together (``cookie-notice``) count by their parts, those that say what is not or what
has something (``no-comments``, ``has-sidebar``) do not, and names that a paragraph may
have as well (``related-work``) count only where links make up much of the text.  What
holds most of a page's text is never left out for its name, nor for its element (a form
around the whole page, a menu left open), unless links make up much of it.

Cases: null or empty html gives empty text; a page without any text too; markup that
is cut off or left open is read as far as it goes; white space within a line becomes
one space; very long pages are read whole; of equally small containers the innermost
counts; repeated rows get the same text; further columns are ignored, whatever their
names; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quarrystone.llm.common import small_batches, table, tidied

# Element names of HTML by their part in a page.
BLOCKS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
CONTAINERS = frozenset("article aside blockquote body details dialog div dl fieldset figure footer form header html main menu nav ol section table ul".split())
DROPPED = frozenset("button head iframe noscript script select style svg template textarea title".split())
#: Left out, too, unless one holds most of a page's text, and that is not links, and it is a form around the page or holds an article (as one left open does).
FRAMES = frozenset("aside dialog footer form header menu nav".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

#: Containers that can be the content region; others are parts of a text.
REGIONS = frozenset("article body div html main page section".split())

# Parts of names in class, id or role by which an element is no main text.  Always; as the last
# part; as the first part, where links make up much of the text; and those that turn a name into another thing's.
ALWAYS = frozenset("ad ads advert adverts advertisement advertisements advertising breadcrumb breadcrumbs comment comments complementary contentinfo consent cookie cookies disqus modal nav navbar navigation newsletter pagination popup promo replies sponsor sponsored subscribe toolbar".split())
LAST = frozenset("banner dialog footer header menu notice notices related reply search share sharing sidebar social widget".split())
LINKED = frozenset("footer header menu related share sharing sidebar social search widget".split())
NOT = frozenset("has have hide in is js no not show with without".split())
COMMENTS = frozenset("comment comments disqus replies reply".split())
#: Share of links in the text from which on a name of ``LINKED`` counts, and share of the page that no name takes away.
LINK_SHARE, MOST = 0.3, 0.5
#: Share of the selected text that the content region holds at least.
NEARLY_ALL = 0.8
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


def mark_of(attrs: list[tuple[str, str | None]]) -> str:
    """What the names of an element say of it: comments, always, linked, or nothing."""
    found = ""
    for name, value in attrs:
        if not value or name not in ("class", "id", "role"):
            continue
        for whole in value.split():
            parts = [p.lower() for p in _PART.findall(whole)]
            if not parts or not NOT.isdisjoint(parts[:-1] or parts):
                continue
            if not ALWAYS.isdisjoint(parts) or parts[-1] in LAST:
                if not COMMENTS.isdisjoint(parts):
                    return "comments"
                found = "always"
            elif not found and parts[0] in LINKED:
                found = "linked"
    return found


class Piece:
    """Text of a line under the same elements."""

    def __init__(self, dropped: bool, marks: tuple[int, ...]) -> None:
        self.text, self.links = "", 0
        self.dropped, self.marks = dropped, marks


class PageEvents(HTMLParser):
    """Lines of a page: [pieces, tags, container]; parents and elements of containers; what marked elements are."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[list[Piece], int, int]] = []
        self.parent, self.kind = [-1], ["page"]
        #: tag, container around, whether it is left out whatever it holds, marked elements around
        self.open: list[tuple[str, int, bool, tuple[int, ...]]] = []
        self.marks = [""]
        #: numbers of the marked elements that are open, and those that count in a heading
        self.own: tuple[int, ...] = ()
        self.in_heading: tuple[int, ...] = ()
        #: those around an article
        self.holders: set[int] = set()
        self.container, self.dropped, self.heading = 0, 0, False
        self.held: list[Piece] = []
        self.tags = self.links = 0

    def flush(self) -> None:
        if any(p.text.strip() for p in self.held):
            self.lines.append((self.held, self.tags, self.container))
        self.held = []
        self.tags = 0

    def hold(self, data: str) -> None:
        dropped = self.dropped > 0
        marks = self.in_heading if self.heading else self.own
        if not self.held or (self.held[-1].dropped, self.held[-1].marks) != (dropped, marks):
            self.held.append(Piece(dropped, marks))
        self.held[-1].text += data
        if self.links:
            self.held[-1].links += _size(data)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.flush()
            if self.open and self.open[-1][0] in ("p", "li", "dt", "dd", "td", "th", "tr") and (tag == self.open[-1][0] or self.open[-1][0] == "p"):
                self._close(len(self.open) - 1)
            if tag in HEADINGS:
                self.heading = self._titled()
                if self.heading:
                    self.in_heading = tuple(m for m in self.own if self.marks[m] != "header")
        elif tag == "br":
            self.hold(" ")
        self.tags += 1
        if tag in VOID:
            return
        self.links += tag == "a"
        mark = mark_of(attrs)
        if tag in ("html", "body", "main") or (tag == "article" and mark != "comments"):
            mark = ""
        if tag in FRAMES and mark != "comments":
            mark = tag if tag in ("header", "form") else "frame"
        if tag in ("article", "main"):
            self.holders.update(self.own)
        drop = tag in DROPPED
        if drop or mark or tag in CONTAINERS:
            self.open.append((tag, self.container, drop, self.own))
            if mark:
                self.marks.append(mark)
                self.own = (*self.own, len(self.marks) - 1)
            self.dropped += drop
            if tag in CONTAINERS:
                self.parent.append(self.container)
                self.kind.append(tag)
                self.container = len(self.parent) - 1

    def _titled(self) -> bool:
        """Whether only header elements of an article or main element hide a heading here."""
        hides = [t for t, _, drop, _ in self.open if drop or t in FRAMES]
        return bool(hides) and all(t == "header" for t in hides) and self.open[0][0] != "header" and any(t in ("article", "main") for t, *_ in self.open)

    def _close(self, at: int) -> None:
        while len(self.open) > at:
            _, self.container, drop, self.own = self.open.pop()
            self.dropped -= drop

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
            self.heading = False
        elif tag == "br":
            self.hold(" ")
        self.tags += 1
        self.links = max(0, self.links - (tag == "a"))
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                self._close(at)
                break

    def handle_data(self, data: str) -> None:
        if not self.open or self.open[-1][0] not in ("script", "style"):
            self.hold(data)

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """Marked sections are no text of a page; the base class raises on unknown ones."""
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1

    def finish(self) -> None:
        self.close()
        self.flush()


def _smooth(values: list[float], sigma: float) -> list[float]:
    reach = max(1, math.ceil(2 * sigma))
    kernel = [math.exp(-(k * k) / (2 * sigma * sigma)) for k in range(-reach, reach + 1)]
    out = []
    for at in range(len(values)):
        total = weight = 0.0
        for k, w in zip(range(at - reach, at + reach + 1), kernel):
            if 0 <= k < len(values):
                total += w * values[k]
                weight += w
        out.append(total / weight)
    return out


def _threshold(values: list[float]) -> float:
    """Between the means of two clusters."""
    low, high = min(values), max(values)
    for _ in range(20):
        cut = (low + high) / 2
        below, above = [v for v in values if v < cut], [v for v in values if v >= cut]
        if not below or not above:
            return cut
        moved = (sum(below) / len(below), sum(above) / len(above))
        if moved == (low, high):
            break
        low, high = moved
    return (low + high) / 2


def _size(text: str) -> int:
    return len("".join(text.split()))


def _left_out(page: PageEvents) -> list[bool]:
    """Whether each marked element is left out for its name."""
    chars, linked = [0] * len(page.marks), [0] * len(page.marks)
    whole = 0
    for pieces, _, _ in page.lines:
        for p in pieces:
            if not p.dropped:
                size = _size(p.text)
                whole += size
                for m in p.marks:
                    chars[m] += size
                    linked[m] += p.links
    out = [False]
    for number, (mark, size, links) in enumerate(zip(page.marks[1:], chars[1:], linked[1:]), 1):
        few = size < MOST * whole
        linked_to = links >= LINK_SHARE * size
        if mark in ("form", "frame", "header"):
            out.append(few or linked_to or not (mark == "form" or number in page.holders))
        else:
            out.append(size < whole if mark == "comments" else few if mark == "always" else few and linked_to)
    return out


def _region(page: PageEvents, texts: list[str], selected: list[bool]) -> list[bool]:
    """Whether each container lies in the content region."""
    n = len(page.parent)
    chosen, other = [0] * n, [0] * n
    for text, (_, _, c), is_selected in zip(texts, page.lines, selected):
        if text:
            size = len(text)
            while c >= 0:
                (chosen if is_selected else other)[c] += size
                c = page.parent[c]
    inside = [False] * n
    named = [False] * n
    for c in range(1, n):
        named[c] = named[page.parent[c]] or page.kind[c] in ("article", "main")
    tops = [c for c in range(1, n) if named[c] and not named[page.parent[c]]]
    held = sum(chosen[c] for c in tops)
    if held and held >= chosen[0] / 2:
        # an article without any selected line is a teaser beside one that has some
        top = list(range(n))
        for c in range(1, n):
            top[c] = top[page.parent[c]] if named[page.parent[c]] else c
        return [named[c] and chosen[top[c]] > 0 for c in range(n)]
    fit = [c for c in range(n) if page.kind[c] in REGIONS and chosen[c] >= NEARLY_ALL * chosen[0]]
    best = min(fit, key=lambda c: (chosen[c] + other[c], -c))
    # outwards while what comes along is mostly selected text
    while (up := page.parent[best]) >= 0 and (gain := chosen[up] - chosen[best]) and gain >= other[up] - other[best]:
        best = up
    for c in range(n):
        inside[c] = c == best or (page.parent[c] >= 0 and inside[page.parent[c]])
    return inside


def main_text(html: str | None, sigma: float = 1.0) -> str:
    if not html:
        return ""
    page = PageEvents()
    page.feed(html)
    page.finish()
    out = _left_out(page)
    # white space at the border of two pieces stays one space, in whichever piece it stands
    texts = [" ".join("".join(p.text if not p.dropped and not any(out[m] for m in p.marks) else " " for p in pieces).split()) for pieces, *_ in page.lines]
    if not any(texts):
        return ""
    ratio = _smooth([math.log1p(len(" ".join("".join(p.text for p in pieces).split())) / max(1, tags)) for pieces, tags, _ in page.lines], sigma)
    cut = _threshold([r for r, text in zip(ratio, texts) if text])
    selected = [bool(text) and r >= cut for r, text in zip(ratio, texts)]
    inside = _region(page, texts, selected)
    return "\n\n".join(text for text, (_, _, c) in zip(texts, page.lines) if text and inside[c])


def extract_main_text(df: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The main text of each row beside the ``keep`` columns.  Map-only: no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h.as_py()) for h in b.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(texts, pa.string()), pa.array([*map(len, texts)], pa.int64())], [*keep, "text", "n_chars"])

    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep) + ", text string, n_chars bigint"
    return small_batches(df.select(*keep, html_col)).mapInArrow(tidied(run), schema)


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))
