"""Main text of web pages by text-to-tag ratios.

The standard library's parser streams a page as events.  Block-level tags cut
it into lines; each line has the length of its text and the number of tags
met since the line before.  Lines inside elements that never hold article
text (scripts, menus, footers, adverts, forms, comments, ...) count as having
none.  Where only a class, id or role says so, an element around the article
is not dropped.  The ratio of text to tags is smoothed with a Gaussian kernel over
neighbouring lines, and lines above a threshold taken from the page's own
ratios form the content clusters.  The content region is the outermost
<article> or <main> that holds nearly all clustered text, else the innermost
element that encloses all of it and the heading before it.  The region's lines
are the article, so short paragraphs and headings between long ones are kept.
Where no element encloses the content, lines outside the clusters' span are
left out.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

RADIUS, SIGMA = 2, 1.0    # Gaussian kernel, in lines
THRESHOLD = 0.5           # lines above this share of the page's mean smoothed ratio are content
REGION_SHARE = 0.9        # an <article> or <main> with this share of the clustered text is the region
LINK_SHARE = 0.8          # lines that are links to this share are lists of links

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr img".split())
CONTAINERS = frozenset("html body div section article main td th tr table tbody thead tfoot ul ol dl blockquote "
                       "center figure details fieldset".split())
DROPPED = frozenset("script style noscript template head title svg math iframe object canvas audio video select "
                    "button textarea form nav footer aside dialog menu".split())
ARTICLE = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A class, id or role made of these words, and QUALIFIERS, marks what is not the article.
MARKS = frozenset("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion menu "
                  "nav navbar navigation breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent notice "
                  "notices popup modal overlay newsletter subscribe subscription signup share sharing social related "
                  "recommended recommendations comment comments respond disqus reply replies widget toolbar pagination "
                  "pager login search contentinfo complementary dialog alert form".split())
QUALIFIERS = frozenset("top bottom left right site page main global primary secondary wrapper container box bar block area "
                       "section list item items links inner outer icons buttons posts articles stories body".split())
MOST, NEARLY_ALL = 0.5, 0.9  # shares of the page's text
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
WORD = re.compile(r"[a-z]+")


def _is_marked(attrs) -> bool:
    for name, value in attrs:
        if name in ("class", "id", "role") and value:
            for token in value.lower().split():
                words = set(WORD.findall(token))
                if not MARKS.isdisjoint(words) and words <= MARKS | QUALIFIERS:
                    return True
    return False


class _Events(HTMLParser):
    """Collects lines: (text, characters in links, tags, element), and which of them are headings."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parents = [-1]          # elements by number; 0 is the page
        self.names = [""]
        self.marked = [False]        # by class, id or role
        self.loose = [False]         # marked, and not inside an <article>
        self.anchors: list[int] = []  # elements that are <article> or <main>, or hold an <h1>
        self.titled: list[int] = []  # those that hold an <h1>
        self.open: list[tuple[str, int, bool, bool]] = [("", 0, False, False)]  # tag, element, dropped, marked or inside
        self.lines: list[tuple[str, int, int, int]] = []           # text, link characters, tags, element
        self.parts: list[str] = []
        self.headings: set[int] = set()  # numbers of lines
        self.tags = self.links = self.in_link = self.in_article = 0
        self.in_heading = False

    def _flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            if self.in_heading:
                self.headings.add(len(self.lines))
            self.lines.append((text, self.links, self.tags, self.open[-1][1]))
            self.tags = 0
        self.parts.clear()
        self.links = 0

    def _is_dropped(self, tag: str, attrs) -> bool:
        if tag in DROPPED:
            return True
        if tag == "header":
            return not self.in_article
        if tag in ("html", "body") or tag in ARTICLE:
            return False
        for name, value in attrs:
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return True
            elif name == "style" and value and HIDDEN.search(value):
                return True
        return False

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag not in INLINE:
            self._flush()
            self.in_heading = tag in HEADINGS
        if tag in VOID:
            return
        if tag == "a":
            self.in_link += 1
        _, _, dropped, within = self.open[-1]
        own = not dropped and self._is_dropped(tag, attrs)
        mark = not dropped and not own and _is_marked(attrs)
        anchor = not dropped and not own and (tag == "h1" or (tag in ARTICLE and not mark))
        mark = mark and tag not in ("html", "body", "h1") and tag not in ARTICLE
        nested = (dropped or within) and tag == self.open[-1][0]  # its end tag must not close the outer one
        if tag in CONTAINERS or own or mark or nested or tag in DROPPED or tag == "header":
            if (own or mark) and tag in INLINE:
                self._flush()
            self.parents.append(self.open[-1][1])
            self.names.append(tag)
            self.marked.append(mark)
            self.loose.append(mark and not any(x[0] == "article" for x in self.open))
            self.open.append((tag, len(self.parents) - 1, dropped or own, within or mark))
            self.in_article += tag in ARTICLE
        if anchor:
            self.anchors.append(self.open[-1][1])
            if tag == "h1":
                self.titled.append(self.open[-1][1])

    def handle_endtag(self, tag):
        self.tags += 1
        if tag not in INLINE:
            self._flush()
            self.in_heading = False
        if tag == "a":
            self.in_link = max(0, self.in_link - 1)
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == tag:
                self._flush()
                self.in_article -= sum(x[0] in ARTICLE for x in self.open[i:])
                del self.open[i:]
                return
            if tag in INLINE and self.open[i][0] not in INLINE:
                return  # a stray inline end tag closes no block around it

    def handle_data(self, data):
        if not self.open[-1][2]:
            self.parts.append(data)
            if self.in_link:
                self.links += len(data)

    def close(self):
        super().close()
        self._flush()
        if any(self.marked):
            self._drop_marked()

    def _drop_marked(self) -> None:
        """Marked elements go with their lines, but not those around the article: the clusters decide there."""
        size, holds, titled = ([0] * len(self.parents) for _ in range(3))
        for text, _, _, e in self.lines:
            size[e] += len(text)
        for e in self.anchors:
            holds[e] = 1
        for e in self.titled:
            titled[e] = 1
        for e in range(len(self.parents) - 1, 0, -1):
            size[self.parents[e]] += size[e]
            holds[self.parents[e]] |= holds[e]
            titled[self.parents[e]] |= titled[e]
        gone = [False] * len(self.parents)
        for e in range(1, len(self.parents)):
            spared = titled[e] or size[e] > NEARLY_ALL * size[0] or (
                self.loose[e] and (holds[e] or (not holds[0] and size[e] > MOST * size[0])))
            gone[e] = gone[self.parents[e]] or (self.marked[e] and not spared)
        kept, headings, tags = [], set(), 0
        for i, (text, links, n, e) in enumerate(self.lines):
            tags += n
            if not gone[e]:
                if i in self.headings:
                    headings.add(len(kept))
                kept.append((text, links, tags, e))
                tags = 0
        self.lines, self.headings = kept, headings


def _events(page: str) -> _Events:
    try:
        events = _Events()
        events.feed(page)
        events.close()
    except AssertionError:  # the parser gives up on some malformed declarations: read those as text
        events = _Events()
        events.feed(re.sub(r"<!(?!--)", "&lt;!", page))
        events.close()
    return events


_KERNEL = np.exp(-0.5 * (np.arange(-RADIUS, RADIUS + 1) / SIGMA) ** 2)
_KERNEL /= _KERNEL.sum()


def clusters(sizes: np.ndarray, tags: np.ndarray) -> np.ndarray:
    """Which lines are content: smoothed text-to-tag ratio above the page's threshold."""
    ratios = sizes / np.maximum(tags, 1)
    edged = np.pad(ratios, RADIUS, mode="edge")
    smooth = np.convolve(edged, _KERNEL, mode="valid")
    return smooth >= THRESHOLD * smooth.mean()


def _enclosing(parents: list[int], elements: set[int]) -> int:
    """The innermost element around all ``elements``."""
    while len(elements) > 1:
        last = max(elements)  # parents have smaller numbers
        elements = elements - {last} | {parents[last]}
    return elements.pop()


def main_text(page: str | None) -> str:
    """The article's blocks in page order, joined by one space."""
    if not page:
        return ""
    events = _events(page)
    lines, parents = events.lines, events.parents
    if not lines:
        return ""
    sizes = np.array([max(0, len(t) - k) for t, k, _, _ in lines], dtype=float)
    content = clusters(sizes, np.array([n for _, _, n, _ in lines], dtype=float))
    if not (sizes * content).any():
        content[:] = True
        sizes = np.array([len(t) for t, _, _, _ in lines], dtype=float)

    linkish = [k > LINK_SHARE * len(t) and not yes for (t, k, _, _), yes in zip(lines, content)]
    # Clustered text in each element and below it; elements are numbered parents first.
    weight = [0.0] * len(parents)
    clustered = [i for i, (size, yes) in enumerate(zip(sizes, content)) if yes and size]
    for i in clustered:
        weight[lines[i][3]] += sizes[i]
    for e in range(len(parents) - 1, 0, -1):
        weight[parents[e]] += weight[e]
    region = next((e for e, name in enumerate(events.names) if name in ARTICLE and weight[e] >= REGION_SHARE * weight[0]), 0)
    if not region and clustered:
        for i in range(clustered[0] - 1, -1, -1):  # the headings the content begins with belong to it
            if linkish[i]:
                break
            if i in events.headings:
                clustered.insert(0, i)
        region = _enclosing(parents, {lines[i][3] for i in clustered})
    inside = [True] * len(parents)
    for e in range(1, len(parents)):
        inside[e] = e == region or (inside[parents[e]] and parents[e] >= region)
    inside[0] = region == 0

    chosen = [i for i, line in enumerate(lines) if inside[line[3]]]
    if region == 0:  # nothing encloses the content: from the first clustered line or its heading to the last
        span = [i for i in chosen if content[i] or i in clustered]
        chosen = [i for i in chosen if span[0] <= i <= span[-1]] if span else chosen
    return " ".join(lines[i][0] for i in chosen if not linkish[i])


def extract_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with ``text`` (main text) and ``n_chars`` (its code points) in place of the html.

    Null and empty pages give an empty text; every row is read whole and
    alone, so repeated rows give equal results and nothing is shuffled.
    Columns named text or n_chars are replaced, all others pass unchanged.
    """
    kept = pages.select(*[c for c in pages.columns if c == html or c not in ("text", "n_chars")])
    at = kept.columns.index(html)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(p) for p in b.column(at).to_pylist()]
            rest = [(n, c) for i, (n, c) in enumerate(zip(b.schema.names, b.columns)) if i != at]
            yield pa.RecordBatch.from_arrays(
                [*(c for _, c in rest), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[*(n for n, _ in rest), "text", "n_chars"])

    rest = [f for i, f in enumerate(kept.schema.fields) if i != at]
    schema = StructType([*rest, StructField("text", StringType()), StructField("n_chars", LongType())])
    return kept.mapInArrow(run, schema)
