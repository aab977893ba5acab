"""Main text of web pages by text-to-tag ratios.

The page runs once through the standard library's streaming parser. Its events become lines, one per block of
text, each with the tags that stood in it; elements that never hold article text (menus, forms, scripts, and
containers named so) make no line. A line's text-to-tag ratio is its characters by its tags. The ratios are
smoothed with a Gaussian along the page. Neighbouring lines of one container are a region; where the page marks an
article or main element, all that it marks is one region. A region is content if one of its smoothed ratios reaches
the threshold, the standard deviation of all, or the largest ratio where that is lower. Content regions are kept
whole, so short paragraphs, lists and tables of an article stay. Where a marked region is content, it is all the
content; else a region without a heading must also reach the threshold by itself, all its characters by all its tags.

Headings and paragraphs are never left out by their names. Others are by class, role or id, if all its words say
so; inside a marked article only containers are, and by an id only reader comments, as ids there are made of titles.

Defined results: a null, empty or text-free page has the empty text. Character references are decoded; white
space inside a block becomes one space; blocks are joined by one space in page order. Unclosed and stray
tags, and pages cut off anywhere, are read as far as they go. Repeated rows are extracted one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.blocks import text_blocks

SIGMA = 1.5
BLOCK_BYTES = 4_000_000
MARKED = 0  # the region of all that stands in article and main elements

_SILENT = frozenset(
    "script style noscript template head title nav aside footer form button select textarea iframe object svg canvas "
    "dialog menu audio video map".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_CONTAINER = frozenset("article main section div td body blockquote header ul ol table".split())
_MAIN = frozenset(("article", "main"))
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words of class, id and role that name what is no article text.
_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices alert nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar side aside widget widgets "
    "footer foot header masthead topbar toolbar comment comments reply replies respond discussion disqus share sharing "
    "social follow related recommended newsletter subscribe subscription signup login search pagination pager popup modal "
    "overlay hidden skip complementary contentinfo tags toc disclaimer legal copyright".split()
)
#: Those of them that containers inside an article bear.
_INNER_NAMES = _NAMES - frozenset("header masthead side foot toc tags legal copyright disclaimer search skip discussion".split())
_COMMENTS = frozenset("comment comments replies disqus".split())
#: Words that say nothing beside one of these.
_PLAIN_NAMES = frozenset(
    "site page main global top bottom left right box list block area section container wrapper wrap bar inner outer item "
    "items panel post posts link links content user".split()
)
_SPOKEN = _HEADINGS | {"p"}
_INNER_CONTAINERS = frozenset("div section ul ol dl table".split())
#: Unclosed, these end where the next block begins.
_LOOSE = frozenset("p li dt dd td th tr option".split())


def _says(name: str, words: frozenset[str]) -> bool:
    """Whether a class, id or role is made of such words and plain ones only."""
    parts = set(name.lower().replace("-", " ").replace("_", " ").split())
    return not words.isdisjoint(parts) and parts <= words | _PLAIN_NAMES


class _Lines(HTMLParser):
    """Blocks of text as (text, tags, region, heading)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, bool]] = []
        self._heading = False
        self._text: list[str] = []
        self._tags = 0
        self._region = MARKED + 1
        self._main = 0
        self._silent = ""  # the element that makes no line, and how deep the same element is nested in it
        self._depth = 0

    def flush(self) -> None:
        text = " ".join("".join(self._text).split())
        if text:
            self.lines.append((text, self._tags, MARKED if self._main else self._region, self._heading))
        self._text, self._tags, self._heading = [], 0, False

    def _is_silent(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if tag in _SILENT or tag == "header" and not self._main:
            return True
        if tag in _MAIN or tag in _SPOKEN or tag in ("body", "html"):
            return False
        for name, value in attrs:
            if name == "hidden" or name == "aria-hidden" and value == "true":
                return True
            if name in ("class", "role") and value and (not self._main or tag in _INNER_CONTAINERS):
                if any(_says(word, _INNER_NAMES if self._main else _NAMES) for word in value.split()):
                    return True
            elif name == "id" and value and (not self._main or tag in _INNER_CONTAINERS):
                if _says(value, _COMMENTS if self._main else _NAMES):
                    return True
        return False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self._silent:
            if tag == self._silent:
                if tag in _LOOSE:
                    self._silent = ""
                else:
                    self._depth += 1
            elif tag in _MAIN or tag == "h1" and self._silent in ("nav", "menu") or self._silent in _LOOSE and tag in _BLOCK:
                self._silent = ""  # it was left open
        if self._silent:
            return
        if tag not in _VOID and self._is_silent(tag, attrs):
            self.flush()
            self._silent, self._depth = tag, 1
            self._region += 1
            return
        if tag in _BLOCK:
            self.flush()
            self._heading = tag in _HEADINGS
        elif tag == "br":
            self._text.append(" ")
        if tag in _CONTAINER:
            self._region += 1
        if tag in _MAIN:
            self._main += 1
        self._tags += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _VOID:
            self.handle_starttag(tag, attrs)
        else:
            self.handle_starttag(tag, attrs)
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if self._silent:
            if tag == self._silent:
                self._depth -= 1
                if self._depth <= 0:
                    self._silent = ""
            elif tag in _MAIN or tag == "body":
                self._silent = ""
            else:
                return
            if tag not in _MAIN:
                return
        if tag in _BLOCK:
            self._tags += 1
            self.flush()
        else:
            self._tags += 1
        if tag in _CONTAINER:
            self._region += 1
        if tag in _MAIN:
            self._main = max(0, self._main - 1)

    def handle_data(self, data: str) -> None:
        if not self._silent:
            self._text.append(data)


def _smooth(values: np.ndarray) -> np.ndarray:
    reach = int(np.ceil(3 * SIGMA))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / SIGMA) ** 2)
    return np.convolve(np.pad(values, reach, mode="edge"), kernel / kernel.sum(), mode="valid")


def main_text(html: str | None) -> str:
    """The text of the content regions of a page."""
    if not html:
        return ""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser.flush()
    lines = parser.lines
    if not lines:
        return ""
    content = content_regions(lines)
    return " ".join(line[0] for line in lines if line[2] in content)


def content_regions(lines: list[tuple[str, int, int, bool]]) -> set[int]:
    """The regions that text-to-tag ratios choose."""
    ratio = _smooth(np.array([len(text) / max(tags, 1) for text, tags, *_ in lines]))
    threshold = min(float(ratio.std()), float(ratio.max()))
    content = {line[2] for line, r in zip(lines, ratio, strict=True) if r >= threshold}
    if MARKED in content:
        return {MARKED}
    for region in list(content):
        own = [line for line in lines if line[2] == region]
        dense = sum(len(line[0]) for line in own) >= threshold * max(sum(line[1] for line in own), 1)
        if not dense and not any(line[3] for line in own):
            content.discard(region)
    return content


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, BLOCK_BYTES, "html"):
            texts = [main_text(page) for page in block.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [block.column("page_id"), block.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html")
    )
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
