"""Table regions of pages: bands of lines, and the boxes that chains of multi-column bands grow to.

A region's box decides which band joins it next, so a page's bands are walked in order; pages go through Arrow batches
with the lines of a page as one array.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafloom.functions import rules


@dataclass
class Band:
    """Lines that share a height: their box, texts, numbers and how many columns their left edges form."""

    top: float
    bottom: float
    left: float
    right: float
    texts: list[str]
    numbers: list[int]
    lefts: list[float]

    @property
    def columns(self) -> int:
        edges = sorted(self.lefts)
        return 1 + sum(b - a > rules.COLUMN_GAP for a, b in zip(edges, edges[1:]))

    @property
    def text(self) -> str:
        return " ".join(t.strip() for t in self.texts).strip()


def bands(lines: list) -> list[Band]:
    """The bands of a page's lines (index, left, top, right, bottom, text), from the top."""
    out: list[Band] = []
    for line in sorted(lines, key=lambda x: (x["top"], x["left"])):
        if not out or line["top"] > out[-1].bottom + rules.BAND_SLACK:
            out.append(Band(line["top"], line["bottom"], line["left"], line["right"], [], [], []))
        band = out[-1]
        band.bottom, band.left, band.right = max(band.bottom, line["bottom"]), min(band.left, line["left"]), max(band.right, line["right"])
        band.texts.append(line["text"] or "")
        band.lefts.append(line["left"])
        if line["index"] is not None:
            band.numbers.append(int(line["index"]))
    return out


def _edges(some: list[Band]) -> tuple[float, float]:
    return min(b.left for b in some), max(b.right for b in some)


def _short(own: float, width: float, text: str) -> bool:
    return len(text) <= rules.SHORT_BAND and own <= max(rules.SHORT_WIDTH, width * rules.SHORT_SHARE)


def _centered(band: Band, left: float, right: float) -> bool:
    return abs(band.left + band.right - left - right) / 2 <= max(rules.CENTER_OFFSET, max(1.0, right - left) * rules.CENTER_SHARE)


def continues(band: Band, left: float, right: float) -> bool:
    """Whether a single-column band can belong to a table between two edges: it fits a place, or is short and centered."""
    if band.columns != 1:
        return False
    width, own = max(1.0, right - left), max(1.0, band.right - band.left)
    short = _short(own, width, band.text)
    for only_short, share, offset, edge, edge_share, edge_offset, least, most in rules.CONTINUATIONS:
        reach = (left if edge == "left" else right) + width * edge_share + edge_offset
        fits = band.left >= left + width * share + offset and band.right <= reach and own >= width * least
        if fits and (most is None or own <= width * most) and (short or not only_short):
            return True
    return short and _centered(band, left, right)


def _dense(page: list[Band], rich: list[int]) -> tuple[int, int] | None:
    """The one span of a form: many rich bands with nothing but continuations between them."""
    if len(rich) < rules.DENSE_BANDS:
        return None
    first, last = rich[0], rich[-1]
    left, right = _edges(page[first : last + 1])
    between = set(range(first, last)) - set(rich)
    if not all(continues(page[i], left, right) for i in between):
        return None
    while first:
        band = page[first - 1]
        titled = band.text and _short(band.right - band.left, right - left, band.text) and _centered(band, left, right)
        if not titled or page[first].top - band.bottom > rules.DENSE_UP:
            break
        first -= 1
    while last + 1 < len(page) and page[last + 1].top - page[last].bottom <= rules.DENSE_DOWN and continues(page[last + 1], left, right):
        last += 1
    return first, last


def _chains(page: list[Band], rich: list[int]) -> list[tuple[int, int]]:
    """Spans of rich bands that follow each other closely over continuations."""
    spans = [(rich[0], rich[0])]
    for i in rich[1:]:
        first, last = spans[-1]
        near = page[i].top - page[i - 1].bottom <= rules.CHAIN_GAP
        if near and all(continues(b, *_edges(page[first : last + 1])) for b in page[last + 1 : i]):
            spans[-1] = (first, i)
        else:
            spans.append((i, i))
    return spans


def _grown(page: list[Band], first: int, last: int) -> tuple[int, int]:
    """A span with its caption, the narrow bands right above, and the continuations and row tails right below."""
    if first and len(page[first - 1].texts) == 1 and page[first - 1].texts[0].strip().startswith(rules.CAPTION_OPENINGS):
        first -= 1
    while first:
        left, right = _edges(page[first : last + 1])
        band = page[first - 1]
        close = min(b.top for b in page[first : last + 1]) - band.bottom <= rules.GROW_GAP and len(band.texts) <= rules.GROW_LINES
        if not close or band.right - band.left > (right - left) * rules.GROW_SHARE or abs(band.left + band.right - left - right) / 2 > rules.GROW_CENTER:
            break
        first -= 1
    while last + 1 < len(page):
        left, right = _edges(page[first : last + 1])
        band, gap = page[last + 1], page[last + 1].top - page[last].bottom
        tail = band.left >= left + max(1.0, right - left) * rules.TAIL_SHARE and band.right <= right + rules.TAIL_OFFSET
        if not (gap <= rules.GROW_GAP and continues(band, left, right) or gap <= rules.TAIL_GAP and tail):
            break
        last += 1
    return first, last


def page_regions(lines: list, width: float) -> list[dict]:
    """The regions of a page: number, line numbers and padded box."""
    page = bands(lines)
    rich = [i for i, b in enumerate(page) if len(b.texts) >= 2 and b.columns >= 2]
    if not rich:
        return []
    dense = _dense(page, rich)
    spans = [dense] if dense else [_grown(page, a, b) for a, b in _chains(page, rich)]
    out = []
    for n, (a, b) in enumerate(spans, 1):
        some = page[a : b + 1]
        left, right = _edges(some)
        pad = rules.REGION_PAD
        out.append({"region": n, "lines": sorted({i for x in some for i in x.numbers}), "left": max(0.0, left - pad), "top": max(0.0, some[0].top - pad), "right": min(width, right + pad), "bottom": max(x.bottom for x in some) + pad})
    return out


REGION = "array<struct<region: int, lines: array<int>, left: double, top: double, right: double, bottom: double>>"


def regions_of(lines: Column, width: float = 595.0) -> Column:
    """The table regions of an array of lines (index, left, top, right, bottom, text)."""

    def run(pages: pd.Series) -> pd.Series:
        return pd.Series([page_regions(list(p) if p is not None else [], width) for p in pages], dtype=object)

    return F.pandas_udf(run, REGION)(lines)


def table_regions(lines: DataFrame, keys: list[str], width: float = 595.0) -> DataFrame:
    """(keys, region, lines, box) of all pages from their lines; a page's lines are one array.

    Null texts are empty; lines without a number give a box but no number; lines that repeat count each; pages without
    a band of two columns, and empty tables, give no rows. Ties of place go by the left edge.
    """
    line = F.struct("index", *(F.col(c).cast("double").alias(c) for c in ("left", "top", "right", "bottom")), "text")
    pages = lines.groupBy(*keys).agg(F.collect_list(line).alias("lines"))
    return pages.select(*keys, F.inline(regions_of(F.col("lines"), width)))


def crop_path(page: Column, region: Column) -> Column:
    """The name under which a region's picture is published."""
    return F.format_string("images/table-crops/%04d-%d.png", page.cast("long"), region.cast("long"))
