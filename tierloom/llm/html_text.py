"""Main text of web pages: parser events, text-to-tag ratios per line, smoothing and a threshold.

The standard library's parser streams the page as events, no tree is built. Events cut the visible text into lines,
one per block element, and count for each line its characters, its characters inside links and its tags. Parts
that announce themselves as something else (menus, page headers and footers, sidebars, notices, adverts, forms,
scripts, styles, reader comments, hidden parts) give no lines; lines of a form count only if there are no others. The ratio of a line is its characters outside links
per tag. Ratios are smoothed along the page with a Gaussian; lines whose smoothed ratio reaches the standard
deviation of all of them are the dense cluster. Dense lines vote with their characters for the region they stand
in: an article, else the main part, else the block that holds the line. Regions with at least ``SHARE`` of
the votes of the best one are the content. All lines of such a region belong to the text, so short paragraphs
between long ones stay; where a block was chosen only for its density, thin lines of nothing but links do not.

Defined results: a null, empty or textless page has no blocks. Character references are decoded, also without a
semicolon where HTML allows that. White space, no-break spaces included, becomes one space; a block of nothing else
is no block. Table rows are one block. Elements that are never closed end with their parent, a page cut inside a
tag, comment or script loses that last piece only. Repeated rows are kept as they are, an empty table gives no rows.
Extra columns are ignored unless named in ``keep``, whatever they are called. Pages are read whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

SIGMA = 1.0
RADIUS = 2
SHARE = 0.25
# Pages whose results leave a task together.
ROWS_OUT = 500

# Element and attribute names of HTML, words that sites use in class names and ids.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr html legend li main menu nav ol p pre search section summary table tbody tfoot thead tr ul".split()
)
REGIONS = frozenset("center dd details div fieldset figure form main article section td th".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NO_TEXT = frozenset("audio canvas datalist head iframe math noembed noframes noscript object script select style svg template textarea title video button".split())
NOT_CONTENT = frozenset("aside dialog footer menu nav search".split())
# Elements whose content is text even where it looks like tags.
OPAQUE = frozenset("iframe noembed noframes noscript textarea title".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog menu menubar navigation search".split())
ADVERTS = frozenset(
    "ad adbanner adbox ads adsense adslot adunit advert advertisement advertisements advertising adverts promo promotion sponsor sponsored sponsors teaser teasers".split()
)
COMMENTS = frozenset("comment commentbox commentlist comments commentsection discussion disqus readercomments replies respond responses usercomments".split())
OTHER_PARTS = frozenset(
    "alert alerts banner breadcrumb breadcrumbs colophon consent cookie cookies copyright dropdown footer gdpr login mainnav masthead menu modal nav navbar navigation"
    " newsletter notice notices pager pagination popup recommendations recommended related searchbox searchform share sharing sidebar sidebars sidenav signin signup"
    " social submenu subnav subscribe subscription toast toolbar topnav widget widgets".split()
)
HEADERS = frozenset("header topbar".split())
# Words that make a header the header of the text.
OWN = frozenset("article content entry post story".split())
LAYOUT = frozenset("has no with without".split())
# Start tags that end an open element of the given kinds, unless one of the second group lies between.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}


def _words(name: str) -> set[str]:
    return set(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower()))


def _announces_other(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether an element says by name, role or class that it is no part of the main text."""
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attributes.get("style", "")):
        return True
    if tag in ("html", "body", "main"):
        return False
    if tag == "article" and in_article:
        return True
    if tag in NOT_CONTENT or (tag == "header" and not in_article):
        return True
    role = attributes.get("role", "").lower()
    if role in ROLES and not (role == "banner" and in_article):
        return True
    for name in (attributes.get("class", "") + " " + attributes.get("id", "")).split():
        words = _words(name)
        if words & LAYOUT:
            continue
        if words & (ADVERTS | COMMENTS) or "related" in words:
            return True
        if tag != "article" and (words & OTHER_PARTS or (words & HEADERS and not in_article and not words & OWN)):
            return True
    return False


class Element(NamedTuple):
    """An open element; article, main part and block are the numbers of the first or nearest around it, itself included."""

    tag: str
    left_out: bool = False
    in_form: bool = False
    article: int = 0
    main: int = 0
    block: int = 0


class Line(NamedTuple):
    """Visible text between two block borders, with the numbers of the elements around it."""

    text: str
    linked: int
    tags: int
    in_form: bool
    article: int
    main: int
    block: int


class Lines(HTMLParser):
    """Cuts the events of a page into lines."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.open = [Element("")]
        self.open_tags: Counter[str] = Counter()
        # Block around each block; numbers rise in page order.
        self.around = [0]
        self.opaque = ""
        self.pieces: list[str] = []
        self.linked = 0
        self.tags = 0

    def end_line(self) -> None:
        text = " ".join("".join(self.pieces).split())
        if text:
            inner = self.open[-1]
            self.lines.append(Line(text, self.linked, self.tags, inner.in_form, inner.article, inner.main, inner.block))
            self.tags = 0
        self.pieces, self.linked = [], 0

    def left_out(self) -> bool:
        return self.open[-1].left_out

    def pop_to(self, place: int) -> None:
        self.open_tags.subtract(e.tag for e in self.open[place:])
        del self.open[place:]

    def close_implied(self, kinds: Sequence[str], scopes: Sequence[str]) -> None:
        if not any(self.open_tags[kind] for kind in kinds):
            return
        for place in range(len(self.open) - 1, 0, -1):
            tag = self.open[place].tag
            if tag in kinds:
                self.pop_to(place)
                return
            if tag in scopes or tag in ("article", "main", "section", "div", "td", "th", "body"):
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.opaque:
            return
        self.tags += 1
        if tag in BLOCKS:
            self.end_line()
            # A block inside a paragraph ends the paragraph.
            self.close_implied(("p",), ())
        if tag in CLOSES:
            if tag not in ("td", "th"):
                self.end_line()
            self.close_implied(*CLOSES[tag])
        if tag in ("br", "td", "th"):
            self.pieces.append(" ")
        if tag in VOID:
            return
        inner = self.open[-1]
        out = inner.left_out
        in_article = inner.article > 0 or (inner.main > 0 and tag != "article")
        if not out and (tag in NO_TEXT or _announces_other(tag, {k: v or "" for k, v in attrs}, in_article)):
            self.end_line()
            out = True
        # A form around the whole page does not make the article a part of the form.
        in_form = tag == "form" or (inner.in_form and tag not in ("article", "main"))
        block = inner.block
        if tag in REGIONS:
            block = len(self.around)
            self.around.append(inner.block)
        article, main = inner.article or (block if tag == "article" else 0), inner.main or (block if tag == "main" else 0)
        self.open.append(Element(tag, out, in_form, article, main, block))
        self.open_tags[tag] += 1
        if tag in OPAQUE:
            self.opaque = tag

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # A slash closes nothing in HTML, but drawings use it for elements without content.
        if tag in VOID or tag in BLOCKS or not self.left_out():
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if self.opaque and tag != self.opaque:
            return
        self.opaque = ""
        self.tags += 1
        if tag in BLOCKS:
            self.end_line()
        if not self.open_tags[tag]:
            return
        for place in range(len(self.open) - 1, 0, -1):
            if self.open[place].tag == tag:
                self.pop_to(place)
                return
            # Text-level end tags do not reach out of the block they stand in.
            if tag not in BLOCKS and self.open[place].tag in BLOCKS:
                return

    def handle_data(self, data: str) -> None:
        if not self.left_out():
            self.pieces.append(data)
            if self.open_tags["a"] > 0:
                self.linked += len(data.strip())

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        return self.parse_bogus_comment(i, report)

    def finish(self) -> list[Line]:
        """All lines; an unfinished tag or comment at the end of the page is dropped."""
        if re.match(r"<[A-Za-z/!?]", self.rawdata):
            self.rawdata = ""
        if not self.cdata_elem:
            self.close()
        self.end_line()
        return self.lines


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """Ratios averaged with a Gaussian along the page; at the ends, over the lines there are."""
    kernel = np.exp(-0.5 * (np.arange(-RADIUS, RADIUS + 1) / SIGMA) ** 2)
    total = np.convolve(ratios, kernel, "full")[RADIUS : RADIUS + len(ratios)]
    weight = np.convolve(np.ones(len(ratios)), kernel, "full")[RADIUS : RADIUS + len(ratios)]
    return total / weight


def content(lines: Sequence[Line], around: Sequence[int]) -> list[str]:
    """Texts of the lines that belong to content regions; ``around`` is the block around each block."""
    lines = [line for line in lines if not line.in_form] or lines
    if not lines:
        return []
    plain = np.array([max(len(line.text) - line.linked, 0) for line in lines], np.int64)
    density = smoothed(plain / np.array([max(line.tags, 1) for line in lines]))
    dense = density >= density.std()
    votes = np.where(dense, plain + 1, 0)
    # Articles go before the main part, that before other blocks.
    for kind in ("article", "main"):
        regions = np.array([getattr(line, kind) for line in lines])
        counted = np.bincount(regions, np.where(regions > 0, votes, 0))
        if counted.max() > 0:
            chosen = counted[regions] >= SHARE * counted.max()
            return [line.text for line, c in zip(lines, chosen, strict=True) if c and getattr(line, kind)]
    chosen = _dense_blocks([line.block for line in lines], around, votes)
    return [line.text for line, c, d in zip(lines, chosen, dense, strict=True) if c and (d or line.linked < len(line.text.replace(" ", "")))]


def _dense_blocks(inner: Sequence[int], around: Sequence[int], votes: np.ndarray) -> list[bool]:
    """Lines inside the blocks with most votes; blocks of one line each count for the block around them."""
    size = Counter(inner)
    held = [around[block] if size[block] == 1 else block for block in inner]
    counted: Counter[int] = Counter()
    for block, vote in zip(held, votes.tolist(), strict=True):
        counted[block] += vote
    most = max(counted.values())
    chosen = {block for block, vote in counted.items() if vote >= SHARE * most}
    # Parts of one text stand side by side: what lies between them in a block belongs to it.
    chosen |= {block for block, n in Counter(around[b] for b in chosen).items() if n > 1 and block}
    inside = [False] * len(around)
    for block in range(1, len(around)):
        inside[block] = block in chosen or inside[around[block]]
    return [inside[block] or own in chosen for block, own in zip(inner, held, strict=True)]


def blocks(html: str) -> list[str]:
    """Blocks of the main text of one page."""
    parser = Lines()
    parser.feed(html)
    return content(parser.finish(), parser.around)


def main_text(pages: DataFrame, html: str = "html", keep: Sequence[str] = ("page_id", "url")) -> DataFrame:
    """The ``keep`` columns and ``blocks`` (array of string), the main text of each page in page order."""
    kept = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]
    rows = pages.select(*kept, F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).alias("html"))
    fields = [T.StructField(f"k{i}", pages.schema[c].dataType) for i, c in enumerate(keep)]
    spark_schema = T.StructType([*fields, T.StructField("blocks", T.ArrayType(T.StringType(), False), False)])
    schema = to_arrow_schema(spark_schema)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(start, ROWS_OUT)
                found = [blocks(page) for page in part.column(len(keep)).to_pylist()]
                columns = [part.column(i).cast(schema.field(i).type) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, schema.field(len(keep)).type)], schema=schema)

    extracted = rows.mapInArrow(extract, spark_schema)
    return extracted.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "blocks")
