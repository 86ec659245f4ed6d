"""Main text of web pages: parser events, text-to-tag ratio per line, smoothing, threshold clustering.

The standard library's streaming parser turns a page into lines, one per block of text. Each line
has a ratio: characters of text over the tags met since the line before. The ratios are smoothed by
a Gaussian, and a line is content when its smoothed ratio, or its own, reaches a share of the
standard deviation; runs of content lines are the regions. A line with more tags than half its
characters, as lists of links are, is none, whatever its neighbours. What a page says itself goes before the
ratio: text in menus, headers, footers, sidebars, notices, adverts, forms and reader comments (by
element, role, class or id) is never content, and when there is an ``article`` or ``main``, what it
holds is content and nothing else is.

Null or empty html, and pages with no content, give an empty text. Every row is worked on by itself,
repeated rows too; further columns are ignored. Nothing is cut, however long.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.tables import by_batch, table

SIGMA = 1.0
SHARE = 0.5

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their text never belongs to the article.
DROPPED = frozenset(
    "head title script style noscript template iframe object svg canvas nav aside footer form menu button select "
    "textarea dialog audio video math".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split()
)
#: A part of a class or id, between hyphens, underscores and blanks, that marks what is not the article.
MARKS = re.compile(
    r"(?:ad|ads|adbox|adslot|advert\w*|adsense|adsbygoogle|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|"
    r"alert|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|sidebar|side|aside|widget|menu|submenu|"
    r"nav|navbar|navigation|breadcrumbs?|pagination|pager|footer|masthead|topbar|toolbar|comments?|disqus|replies|"
    r"responses|respond|share|sharing|social|related|recommended|recommendations|tags|skip)"
)
_PARTS = re.compile(r"[^0-9a-z]+")
_SPLIT = re.compile(r"(?<=[a-z])(?=[A-Z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_BLANK = re.compile(r"\s+")


def marked(attributes: list[tuple[str, str | None]], in_article: bool) -> bool:
    """Do the attributes say that the element isn't part of the article?"""
    for name, value in attributes:
        if name in ("class", "id"):
            parts = _PARTS.split(_SPLIT.sub("-", value or "").lower())
            if any(MARKS.fullmatch(part) for part in parts) or ("header" in parts and not in_article):
                return True
        elif name == "role":
            if (value or "").strip().lower() in ROLES:
                return True
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        elif name == "style" and _HIDDEN.search(value or ""):
            return True
    return False


class Lines(HTMLParser):
    """Collects (text, tags, inside the article) per line; dropped parts only count their tags."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, bool]] = []
        self.parts: list[str] = []
        self.tags = 0
        self.articles = 0
        self.dropped: str | None = None
        self.depth = 0
        self.inner = 0

    def close_line(self) -> None:
        text = _BLANK.sub(" ", "".join(self.parts)).strip()
        self.parts.clear()
        if text:
            self.lines.append((text, self.tags, self.articles > 0))
            self.tags = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if self.dropped:
            self.inner += tag in ("article", "main")
            if tag == self.dropped:
                self.depth += 1
                if tag not in ("p", "li"):
                    return
            if self.dropped != "p" or tag not in BLOCKS:
                if self.dropped == "li" and tag == "li":
                    self.depth = 1 if marked(attrs, self.articles > 0) else 0
                    self.dropped = "li" if self.depth else None
                elif self.dropped == "head" and tag == "body":
                    self.dropped = None
                if self.dropped:
                    return
            else:
                self.dropped = None  # a block ends an open paragraph
        if tag in BLOCKS:
            self.close_line()
        elif tag == "br":
            self.parts.append("\n")
        if tag in VOID:
            return
        outer_header = tag == "header" and not self.articles
        if tag in DROPPED or outer_header or (
            tag not in ("html", "body", "article", "main") and marked(attrs, self.articles > 0)
        ):
            self.dropped, self.depth, self.inner = tag, 1, 0
        elif tag in ("article", "main"):
            self.articles += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if self.dropped:
            if tag == self.dropped:
                self.depth -= 1
                if not self.depth:
                    self.dropped = None
            elif tag in ("article", "main") and self.inner:
                self.inner -= 1
            elif tag in ("body", "html", "article", "main"):
                self.dropped = None  # never closed: it ends with what holds it
                self.handle_endtag(tag)
            return
        if tag in BLOCKS:
            self.close_line()
        if tag in ("article", "main"):
            self.articles = max(0, self.articles - 1)

    def handle_data(self, data: str) -> None:
        if not self.dropped:
            self.parts.append(data)


def smooth(values: list[float], sigma: float) -> list[float]:
    """Gaussian smoothing; weights are renewed at the ends."""
    reach = max(1, math.ceil(3 * sigma))
    weights = [math.exp(-(k * k) / (2 * sigma * sigma)) for k in range(reach + 1)]
    out = []
    for i in range(len(values)):
        low, high = max(0, i - reach), min(len(values), i + reach + 1)
        own = [weights[abs(i - j)] for j in range(low, high)]
        out.append(sum(w * v for w, v in zip(own, values[low:high], strict=True)) / sum(own))
    return out


def main_text(html: str | None, sigma: float = SIGMA, share: float = SHARE) -> str:
    """The content lines of a page, joined by line feeds."""
    if not html:
        return ""
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.close_line()
    lines = parser.lines
    inside = [text for text, _, article in lines if article]
    if inside:
        return "\n".join(inside)
    if not lines:
        return ""
    ratios = [len(text) / max(1, tags) for text, tags, _ in lines]
    smoothed = smooth(ratios, sigma)
    mean = sum(smoothed) / len(smoothed)
    limit = share * math.sqrt(sum((x - mean) ** 2 for x in smoothed) / len(smoothed))
    return "\n".join(
        text for (text, tags, _), own, near in zip(lines, ratios, smoothed, strict=True)
        if max(own, near) >= limit and (tags < 4 or own >= 2)
    )


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars."""
    needed = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
        F.col(html).cast("string").alias("html"),
    )

    def make(batch: pa.RecordBatch):
        texts = [main_text(value.as_py()) for value in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )

    return by_batch(needed, "page_id long, url string, text string, n_chars long", make)


def op2_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
