"""The reader's side: chapters' HTML made ready, part introductions, catalogs of sections, and routes of found entries."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafloom.functions import rules, text

_LEAD = re.compile(r"(<section\b[^>]*>\s*<(h2|h3)>(.*?)</\2>\s*<p>)([\s\S]*?)(</p>)")


def _lead(m: re.Match) -> str:
    opening, title, body, closing = m.group(1), m.group(3).strip(), m.group(4), m.group(5)
    at = body.find(title) if title else -1
    if at == 0 and body[len(title) : len(title) + 1] == " ":
        body = body[len(title) + 1 :]
    elif 0 < at <= rules.HEADING_LEAD and not set(body[:at]) & set(rules.HEADING_STOPS):
        body = body[at + len(title) :].lstrip()
    return opening + body + closing


def ready_html(page: Column) -> Column:
    """A chapter's HTML for reading: headings repeated at the start of their first paragraph go, tables can scroll.

    A heading goes from the very start, or from within the first characters if no sentence ends before it. Null stays
    null, an empty page empty.
    """

    def run(pages: pd.Series) -> pd.Series:
        return pd.Series([None if p is None else _LEAD.sub(_lead, p) for p in pages], dtype=object)

    cleared = F.pandas_udf(run, "string")(page)
    opened = F.regexp_replace(cleared, r"<table\b([^>]*)>", '<div class="reader-table-scroll"><table$1>')
    return F.replace(opened, F.lit("</table>"), F.lit("</table></div>"))


def parsed_intro(c: Column) -> tuple[Column, Column]:
    """(description, items) of a part's introduction: the fixed sentence and what it lists; else the text and none."""
    x = F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    lead = rules.INTRO_SENTENCE
    rest = F.split(F.substring(x, len(lead) + 1, 2**31 - 1), r" / ")
    items = F.filter(F.transform(rest, lambda i: F.trim(i)), lambda i: i != "")
    listed = F.startswith(x, F.lit(lead))
    return F.when(listed, lead).otherwise(x), F.when(listed, items).otherwise(F.array().cast("array<string>"))


def without_intro(page: Column) -> Column:
    """A chapter's HTML without its first part introduction."""
    section = r'(?si)^(.*?)<section id="part-intro">.*?</section>'
    return F.when(page.rlike(section), F.regexp_replace(page, section, "$1")).otherwise(page)


def catalog(chapters: DataFrame, entries: DataFrame) -> DataFrame:
    """All entries but aliases, with an overview for chapters that have none, in the order of their chapter's catalog.

    ``chapters`` has (chapter, title, part_title, summary, label_start, page_start, images), ``entries`` (chapter, section,
    entry_type, section_title, chapter_title, part_title, text, page_start, page_end, label, images, ord). ``place`` counts
    from 1: covers, introductions, the overview, then the others by page and their own order. Entries of no chapter go.
    """
    own = entries.where("entry_type <> 'search-alias'").join(chapters.select("chapter"), "chapter", "left_semi")
    lacking = chapters.join(own.where("section = 'overview'").select("chapter").distinct(), "chapter", "left_anti")
    made = lacking.select("chapter", F.lit("overview").alias("section"), F.lit("overview").alias("entry_type"), F.lit(rules.OVERVIEW_TITLE).alias("section_title"), F.col("title").alias("chapter_title"), "part_title", F.col("summary").alias("text"), "page_start", F.col("page_start").alias("page_end"), F.col("label_start").alias("label"), "images", F.lit(-1).cast(entries.schema["ord"].dataType).alias("ord"))
    every = own.select(*made.columns).unionByName(made)
    group = F.when(F.col("entry_type") == "part-cover", 0).when(F.col("entry_type") == "part-intro", 1).when(F.col("section") == "overview", 2).otherwise(3)
    by = W.partitionBy("chapter").orderBy(group, F.coalesce("page_start", F.lit(0)), F.coalesce("page_end", F.lit(0)), "ord", "section")
    return every.withColumn("place", F.row_number().over(by)).withColumn("route", text.route(F.col("chapter"), F.col("section")))


def _key(*columns: str) -> Column:
    return text.composite_key(*(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))


def resolved(found: DataFrame, entries: DataFrame, chapters: DataFrame) -> DataFrame:
    """``found`` rows with the chapter, section, route and images of the entry that they name.

    The whole key (part, chapter, label, pages, title) decides, else part, chapter and title, else the chapter's own key
    (part, chapter, label); of entries with equal keys the last counts. ``found`` and ``entries`` have (part_title,
    chapter_title, label, page_start, page_end, title), ``found`` has_image, ``entries`` (chapter, section, images, ord),
    ``chapters`` (chapter, part_title, chapter_title, label, ord). What nothing names leads to ``/``. The joins are on keys,
    one row each, so no pair is made that does not match.
    """
    whole, loose, owner = ("part_title", "chapter_title", "label", "page_start", "page_end", "title"), ("part_title", "chapter_title", "title"), ("part_title", "chapter_title", "label")
    last = lambda key, name: entries.groupBy(_key(*key).alias(f"_{name}")).agg(F.max_by(F.struct("chapter", "section", "images"), "ord").alias(name))
    chapter = chapters.groupBy(_key(*owner).alias("_owner")).agg(F.max_by("chapter", "ord").alias("owner"))
    keyed = found.withColumns({"_exact": _key(*whole), "_near": _key(*loose), "_owner": _key(*owner)})
    out = keyed.join(last(whole, "exact"), "_exact", "left").join(last(loose, "near"), "_near", "left").join(chapter, "_owner", "left")
    hit = F.coalesce("exact", "near")
    slug, section = F.coalesce(hit["chapter"], F.col("owner")), F.coalesce(hit["section"], F.lit("overview"))
    count = F.coalesce(hit["images"], F.when(F.col("has_image"), 1).otherwise(0).cast(entries.schema["images"].dataType))
    return out.select(*found.columns, slug.alias("chapter"), section.alias("section"), F.coalesce(text.route(slug, section), F.lit("/")).alias("route"), count.alias("images"))


def date_label(c: Column, zone: str = "UTC") -> Column:
    """A time stamp as Korean readers write it; ``미상`` for none, the value itself where it is no time."""
    at = F.from_utc_timestamp(F.try_to_timestamp(c), zone)
    half = F.when(F.hour(at) < 12, "오전").otherwise("오후")
    hour = F.when(F.hour(at) % 12 == 0, 12).otherwise(F.hour(at) % 12)
    said = F.concat(F.date_format(at, "yyyy. M. d. "), half, F.lit(" "), hour, F.lit(":"), F.date_format(at, "mm"))
    return F.when(F.coalesce(c, F.lit("")) == "", rules.UNKNOWN_DATE).otherwise(F.coalesce(said, c))
