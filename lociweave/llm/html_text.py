"""Main text of web pages by tag ratios.

The events of the standard library's parser cut a page into lines, one per block-level element. A line's ratio is its characters of
text per tag; ratios are smoothed with a Gaussian over neighbouring lines, so that a short paragraph between long ones counts
as content, and two-means clustering of the smoothed ratios gives the threshold between navigation and prose. Lines above it
select regions: a region is the nearest sectioning element around a line, or the article it belongs to. All lines of a selected
region are kept, in page order, whatever their own ratio.

Two clusters need not be navigation and prose: where no article holds most of the lines above the threshold, the threshold is at most
`DENSE`, so that a region of prose is not lost beside a denser one, and the smallest element inside the body that holds most of those
lines gives its other regions as well, unless most of their text is links.

What a page marks as something else is left out before: elements for navigation, headers, footers, asides, forms and scripts,
hidden elements, and elements whose class, id or role names adverts, notices, menus, sidebars or reader comments. A token of a class or
id counts if all its words are such names or common words of layout: `ad-box` does, `has-sidebar` and `social-science` do not. A form or
named block that holds nearly all text of the page, or most of it with its main element or heading, wraps the page and is kept, unless
an article, main element or first heading stands outside it.

Defined results: a null, empty or text-free page has empty text; an empty table has no rows; unclosed elements end with their parents, however
deep; pages are read whole, whatever their length; pages of equal ratios are kept whole; repeated rows give one result each; other columns
are not read, and names of theirs that the result uses do no harm.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import slices

# Fixed values of the HTML standard and of common practice in page templates.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
SKIPPED = set("head script style template noscript iframe object svg math canvas video audio nav aside footer button select textarea dialog menu".split())
REGION = set("article main section div td body blockquote details".split())
WHOLE = {"article", "main"}
#: An element of the key closes an open element of the value when it starts.
IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
NAMES = set(
    "ad ads adv advert adverts advertisement advertising adsense adbox adslot banner sponsor sponsored promo promoted promotion cookie cookies consent gdpr "
    "notice notices notification alert popup modal overlay newsletter subscribe subscription signup login sidebar widget widgets related recommended "
    "recommendations trending share sharing social comment comments commentlist disqus reply replies respond nav navbar navigation menu menubar breadcrumb "
    "breadcrumbs pagination pager toolbar masthead copyright hidden".split()
)
#: Words of layout that may stand beside such a name, and words that turn it into something else.
LAYOUT = set(
    "area bar block body bottom box button buttons center col column container content entry fixed footer form group header icon icons inner item items left link "
    "links list main new outer page panel post posts primary right row secondary section site small text thread title top tray unit wrap wrapper zone".split()
)
WITHOUT = set("has no non not with off".split())
#: Names that speak of the page as a whole only outside an article.
OUTER_NAMES = {"header", "footer", "top", "bottom", "side"}
ROLES = set("navigation banner contentinfo complementary search dialog alert form menu menubar toolbar".split())
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+(?![a-z])")
#: A region is dense at so many characters per tag. A block wraps the page from the first share of its text on, with a heading from the second.
DENSE, WRAPS, WRAPS_HEADING = 40.0, 0.9, 0.5
#: Share of the text above the threshold that the element around the main text holds.
MOST = 2 / 3


def names_of(value: str) -> set[str]:
    """Names in a class or id value, lower-cased, from those tokens that say nothing else: `ad-box mainNav` has ad and nav."""
    out: set[str] = set()
    for token in value.split():
        words = [x.lower() for x in PARTS.findall(token)]
        names = [w for w in words if w in NAMES or w in OUTER_NAMES]
        if not WITHOUT.intersection(words) and all(w in LAYOUT or len(w) <= 3 for w in words if w not in names):
            out.update(names)
    return out


class Line(NamedTuple):
    text: str
    tags: int
    region: int
    around: tuple[int, ...]  # forms and named blocks
    linked: int  # characters of links


class Lines(HTMLParser):
    """Lines of a page. Region 0 is the page, the others are numbered as they open."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, int]] = []  # name, left out (2) or perhaps (1), region
        self.names: Counter[str] = Counter()  # of the open elements
        self.skipped = 0
        self.parents, self.tags_of = [0], ["html"]  # of the regions
        self.text: list[str] = []
        self.tags = self.linked = 0
        self.around: tuple[int, ...] = ()
        self.blocks: list[list] = []  # forms and named blocks: name, whether their heading speaks for them, marks inside, characters
        self.marks = 0  # articles, main elements and first headings
        self.lines: list[Line] = []

    def inside(self) -> bool:
        return any(self.names[name] for name in WHOLE)

    def region(self) -> int:
        return self.open[-1][2] if self.open else 0

    def end_line(self) -> None:
        if self.text:
            line = " ".join("".join(self.text).split())
            if line:
                self.lines.append(Line(line, self.tags, self.region(), self.around, self.linked))
                for i in self.around:
                    self.blocks[i][3] += len(line)
                self.tags = 0
            self.text, self.linked = [], 0

    def left_out(self, tag: str, attrs: list[tuple[str, str | None]]) -> int:
        """2 for an element that is left out, 1 for one that is unless it wraps the page."""
        inside = self.inside()
        if tag in SKIPPED or tag == "header" and not inside:
            return 2
        out = int(tag == "form")
        for name, value in attrs:
            value = value or ""
            if name in ("class", "id") and tag not in ("html", "body", *WHOLE):
                found = names_of(value)
                if found & NAMES or not inside and found & OUTER_NAMES:
                    if tag not in BLOCK:
                        return 2
                    out = 1
            elif name == "role" and value.lower() in ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
                return 2
            elif name == "style" and UNSEEN.search(value.lower()):
                return 2
        return out

    def close_until(self, position: int) -> None:
        while len(self.open) > position:
            name, out, _ = self.open[-1]
            if name in BLOCK and not self.skipped:
                self.end_line()
            self.open.pop()
            self.names[name] -= 1
            if out == 2:
                self.skipped -= 1
            elif out and not self.skipped:
                self.around = self.around[:-1]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag in BLOCK:
            closes = {"p"} | IMPLIED.get(tag, set())
            for i in range(len(self.open) - 1, -1, -1):
                name = self.open[i][0]
                if name in closes:
                    self.close_until(i)
                    break
                if name in BLOCK and name != "p":
                    break
            if not self.skipped:
                self.end_line()
        elif tag == "br":
            self.text.append(" ")
        if tag in VOID:
            return
        out, region = self.left_out(tag, attrs), self.region()
        if tag in REGION and not self.inside():
            self.parents.append(region)
            self.tags_of.append(tag)
            region = len(self.parents) - 1
        self.open.append((tag, out, region))
        self.names[tag] += 1
        if self.skipped:
            self.skipped += out == 2
            return
        if tag in ("main", "h1", "article"):
            self.marks += 1
            for i in self.around:
                self.blocks[i][1] |= tag != "article" or self.blocks[i][0] == "form"
                self.blocks[i][2] += 1
        if out == 2:
            self.skipped = 1
        elif out:
            self.around += (len(self.blocks),)
            self.blocks.append([tag, False, 0, 0])

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if self.names[tag]:
            self.close_until(next(i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] == tag))

    def handle_data(self, data: str) -> None:
        if not self.skipped:
            self.text.append(data)
            if self.names["a"]:
                self.linked += len(data)

    def finish(self) -> list[Line]:
        """All lines but those of forms and named blocks that do not wrap the page; tags of a line left out go to the next one."""
        self.close()
        self.close_until(0)
        self.end_line()
        total = sum(len(x.text) for x in self.lines)
        out = {i for i, (_, heading, marks, size) in enumerate(self.blocks) if marks < self.marks or size < total * (WRAPS_HEADING if heading else WRAPS)}
        kept, tags = [], 0
        for line in self.lines:
            tags += line.tags
            if out.isdisjoint(line.around):
                kept.append(line._replace(tags=tags))
                tags = 0
        return kept


def smoothed(values: np.ndarray, spread: float) -> np.ndarray:
    """Gaussian smoothing; at the ends the weights that fall outside go to the rest."""
    reach = max(1, int(np.ceil(2 * spread)))
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / spread) ** 2)
    sums = np.convolve(values, weights)[reach : reach + len(values)]
    return sums / np.convolve(np.ones(len(values)), weights)[reach : reach + len(values)]


def threshold(values: np.ndarray) -> float:
    """Border between two clusters of values, by two-means from the extremes. Equal values are one cluster, above the border."""
    low, high = float(values.min()), float(values.max())
    while high > low:
        border = (low + high) / 2
        below, above = values[values <= border], values[values > border]
        means = float(below.mean()), float(above.mean())
        if means == (low, high):
            return border
        low, high = means
    return low - 1.0


def selected(page: Lines, lines: list[Line], near: np.ndarray) -> set[int]:
    """Regions with a line above the threshold and, without an article, the regions beside them."""
    border = threshold(near)
    chars = np.zeros(len(page.parents), np.int64)  # above the threshold, by region
    for line, value in zip(lines, near.tolist()):
        if value > border:
            chars[line.region] += len(line.text)
    whole = np.array([tag in WHOLE for tag in page.tags_of])
    if 2 * chars[whole].sum() >= chars.sum():
        return set(np.flatnonzero(chars).tolist())
    border = min(border, DENSE)
    chars[:], total, linked = 0, np.zeros(len(chars), np.int64), np.zeros(len(chars), np.int64)
    for line, value in zip(lines, near.tolist()):
        total[line.region] += len(line.text)
        linked[line.region] += line.linked
        if value > border:
            chars[line.region] += len(line.text)
    out = set(np.flatnonzero(chars).tolist())
    sums = chars.copy()  # with the regions inside, which have higher numbers
    for i in range(len(sums) - 1, 0, -1):
        sums[page.parents[i]] += sums[i]
    around = [i for i in np.flatnonzero(sums >= MOST * chars.sum()).tolist() if page.tags_of[i] not in ("html", "body")]
    if around:
        inside = np.zeros(len(chars), bool)
        inside[around[-1]] = True  # they are nested, so the last one is the smallest
        for i in range(1, len(chars)):
            inside[i] |= inside[page.parents[i]]
        out.update(np.flatnonzero(inside & (total > 0) & (2 * linked <= total)).tolist())
    return out


def main_text(html: str, spread: float = 1.0) -> str:
    parser = Lines()
    parser.feed(html)
    lines = parser.finish()
    if not lines:
        return ""
    ratios = np.array([len(line.text) / max(1, line.tags) for line in lines])
    regions = selected(parser, lines, smoothed(ratios, spread))
    return "\n\n".join(line.text for line in lines if line.region in regions)


def extract(pages: DataFrame, html: str = "html", keys: tuple[str, ...] = ("page_id", "url"), spread: float = 1.0) -> DataFrame:
    """The key columns, and text and n_chars. One map stage, no shuffle."""
    source = pages.select(*[pages[k] for k in keys], F.coalesce(pages[html].cast("string"), F.lit("")).alias("__html"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, values in slices(batches, "__html"):
            out = [main_text(v, spread) for v in values]
            columns = [c.combine_chunks() for c in rows.columns[:-1]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.string()), pa.array(list(map(len, out)), pa.int64())], names=schema.names)

    return source.mapInArrow(run, schema)
