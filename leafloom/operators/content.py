"""Content of chapters: the blocks of a page range, sections cut at titles, their HTML and text, and search entries.

Chapters have (doc_id, chapter, page_start, page_end), pages' paragraphs (doc_id, page, index, text, kind, lines,
merge_first), images (doc_id, page, ord, path) and table regions (doc_id, page, region, lines, path). Orders within a
chapter are windows over its pages; nothing is ordered across chapters.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafloom.functions import rules, text
from leafloom.operators import ordered as O
from leafloom.operators import relational as R

KEYS = ["doc_id", "chapter"]
_SEPARATORS = re.compile(r"[\s·ㆍ․]")


def range_blocks(chapters: DataFrame, paragraphs: DataFrame, images: DataFrame, regions: DataFrame) -> DataFrame:
    """(doc_id, chapter, pos, type, text, kind, suppressed, path): the blocks of each chapter's pages in order.

    ``chapters.titles`` are trimmed off the start until a paragraph is left of it. A page's first paragraph continues
    the paragraph before it where the page is so marked. The first paragraph of a table region puts the region's picture
    before it; paragraphs of a region, and further table rows while a later region is to come, count as text only. A
    page's images stand at its end. Blank paragraphs are no blocks; an end before its start, and empty tables, give none.
    """
    pages = R.interval_points(chapters, "page_start", "page_end", "page").select("doc_id", "chapter", "titles", "page")
    own = regions.groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(F.struct("region", "lines", "path"))).alias("regions"))
    stripped = F.regexp_replace("text", r"(?U)^\s+|\s+$", "")
    found = paragraphs.withColumn("text", stripped).where("text <> ''").join(own, ["doc_id", "page"], "left").join(pages, ["doc_id", "page"])
    found = found.withColumn("trimmed", text.trim_headings(F.col("text"), F.col("titles")))
    place = F.struct("page", "index")
    first = F.min(F.when(F.col("trimmed") != "", place)).over(W.partitionBy(*KEYS))
    found = found.withColumn("first", first).where(place >= F.col("first"))
    found = found.withColumn("text", F.when(place == F.col("first"), F.col("trimmed")).otherwise(F.col("text")))
    head = found.select(*KEYS, "page", F.lit(1).alias("slot"), F.col("index").cast("long").alias("at"), F.lit("paragraph").alias("type"), "text", F.coalesce("kind", F.lit("")).alias("kind"), "lines", "regions", (place > F.col("first")).alias("later"), ((F.col("index") == 0) & F.coalesce("merge_first", F.lit(False))).alias("joins"), F.lit(None).cast("string").alias("path"))
    shown = images.join(pages.drop("titles"), ["doc_id", "page"]).select(*KEYS, "page", F.lit(2).alias("slot"), F.col("ord").cast("long").alias("at"), F.lit("image").alias("type"), "path")
    every = head.unionByName(shown, allowMissingColumns=True)
    by = W.partitionBy(*KEYS).orderBy("page", "slot", "at")
    joined = F.coalesce(F.col("joins") & F.col("later") & (F.lag("type").over(by) == "paragraph"), F.lit(False))
    every = every.withColumn("opens", F.when(joined, 0).otherwise(1)).withColumn("block", F.sum("opens").over(by.rowsBetween(W.unboundedPreceding, 0)))
    # a block's first row says what it is; its texts are joined in order
    one = F.struct("page", "slot", "at", "type", "text", "kind", "lines", "regions", "path")
    blocks = every.groupBy(*KEYS, "block").agg(F.array_sort(F.collect_list(F.struct("page", "slot", "at", "text"))).alias("texts"), F.min_by(one, F.struct("page", "slot", "at")).alias("head"))
    blocks = blocks.select(*KEYS, "block", "head.*", F.col("texts.text").alias("texts"))
    merged = F.when(F.size("texts") > 1, text.join_segments(F.col("texts"))).otherwise(F.col("text"))
    blocks = blocks.withColumn("text", merged)
    table = F.col("kind") == "table/form"
    some = F.coalesce(F.col("regions"), F.array().cast("array<struct<region:int,lines:array<int>,path:string>>"))
    lines = F.coalesce(F.col("lines"), F.array().cast("array<int>"))
    hit = F.get(F.filter(some, lambda r: F.arrays_overlap(r["lines"], lines)), F.lit(0))
    alone = F.when((F.size(lines) == 0) & (F.size(some) == 1) & table, F.get(some, F.lit(0)))
    blocks = blocks.withColumn("of", F.when(F.col("type") == "paragraph", F.coalesce(hit, alone)))
    page = W.partitionBy(*KEYS, "page").orderBy("block")
    inserted = F.max("of.region").over(page.rowsBetween(W.unboundedPreceding, 0))
    opened = F.col("of").isNotNull() & (F.row_number().over(W.partitionBy(*KEYS, "page", "of.region").orderBy("block")) == 1)
    blocks = blocks.withColumns({"inserted": inserted, "opened": opened})
    waits = table & F.col("inserted").isNotNull() & F.exists(some, lambda r: r["region"] > F.col("inserted"))
    plain = (F.size(some) > 0) & F.col("of").isNull() & table
    paragraph = F.col("type") == "paragraph"
    block = F.struct(
        F.lit(1).alias("part"), F.col("type"), F.when(paragraph, F.col("text")).alias("text"),
        F.when(paragraph, F.when(plain | (F.col("kind") == ""), "body").otherwise(F.col("kind"))).alias("kind"),
        (paragraph & (F.col("of").isNotNull() | waits)).alias("suppressed"), F.col("path"),
    )
    none = F.lit(None).cast("string")
    picture = F.struct(F.lit(0).alias("part"), F.lit("table-image").alias("type"), none.alias("text"), none.alias("kind"), F.lit(False).alias("suppressed"), F.col("of.path").alias("path"))
    out = blocks.select(*KEYS, "block", F.explode(F.when(F.col("opened"), F.array(picture, block)).otherwise(F.array(block))).alias("b"))
    pos = F.row_number().over(W.partitionBy(*KEYS).orderBy("block", "b.part"))
    return out.select(*KEYS, pos.alias("pos"), "b.type", "b.text", "b.kind", "b.suppressed", "b.path")


@lru_cache(maxsize=512)
def _title_words(titles: tuple[str, ...]) -> tuple[tuple[str, ...], tuple[tuple[str, ...], ...], re.Pattern | None]:
    """(titles, their words, pattern): where titles start together the longest counts, and among equals the first.

    There is a pattern only where a title has blank words or separators in its words; others are found by their words.
    """
    order = tuple(sorted((t for t in titles if t), key=lambda t: -len(t)))
    words = tuple(tuple(t.split(" ")) for t in order)
    if all(w and not _SEPARATORS.search(w) for ws in words for w in ws):
        return order, words, None
    loose = (r"[\s·ㆍ․]*".join(map(re.escape, ws)) for ws in words)
    return order, words, re.compile("|".join(f"({x})" for x in loose))


def _next(paragraph: str, words: tuple[str, ...], at: int) -> tuple[int, int] | None:
    """(start, end) of the first place from ``at`` on that has the words in turn, whatever separators are between them."""
    while (start := paragraph.find(words[0], at)) >= 0:
        end = start + len(words[0])
        for w in words[1:]:
            end = text.behind_separators(paragraph, end)
            if not paragraph.startswith(w, end):
                break
            end += len(w)
        else:
            return start, end
        at = start + 1
    return None


def _found(paragraph: str, titles: tuple[str, ...]):
    """(start, end, title) of the titles in a paragraph from left to right, none within another."""
    order, words, pattern = _title_words(titles)
    if pattern is not None:
        yield from ((m.start(), m.end(), order[m.lastindex - 1]) for m in pattern.finditer(paragraph))
        return
    coming = [(*hit, n) for n, w in enumerate(words) if (hit := _next(paragraph, w, 0))]
    while coming:
        start, end, n = min(coming, key=lambda c: (c[0], c[2]))
        yield start, end, order[n]
        behind = ((c[:2] if c[0] >= end else _next(paragraph, words[c[2]], end), c[2]) for c in coming)
        coming = [(*hit, k) for hit, k in behind if hit]


def _cut(paragraph: str | None, titles) -> list[dict]:
    if not paragraph:
        return []
    out, at = [], 0
    for start, end, title in _found(paragraph, tuple(titles) if titles is not None else ()):
        if lead := paragraph[at:start].strip():
            out.append({"heading": None, "text": lead})
        out.append({"heading": title, "text": None})
        at = end
    if rest := paragraph[at:].strip():
        out.append({"heading": None, "text": rest})
    return out


def cut_at_titles(paragraph: Column, titles: Column) -> Column:
    """A paragraph as an array of (heading, text): cut wherever a title occurs, whatever separates the title's words."""

    def run(paragraphs: pd.Series, titles: pd.Series) -> pd.Series:
        return pd.Series([_cut(p, t) for p, t in zip(paragraphs, titles, strict=True)], dtype=object)

    return F.pandas_udf(run, "array<struct<heading: string, text: string>>")(paragraph, titles)


def segmented(blocks: DataFrame, items: DataFrame) -> DataFrame:
    """Blocks with the ``section`` that they stand in: the last item title before them in the chapter, else ``overview``.

    ``items`` has (doc_id, chapter, ord, section, title); of equal titles the last names the section. Paragraphs are cut
    at titles, which are no text of their own.
    """
    catalog = items.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("ord", "title", "section"))).alias("items"))
    blocks = blocks.join(catalog, KEYS, "left")
    titles = F.when(F.col("type") == "paragraph", F.col("items.title"))
    whole = F.array(F.struct(F.lit(None).cast("string").alias("heading"), F.col("text")))
    parts = F.when(F.col("type") == "paragraph", cut_at_titles(F.col("text"), titles)).otherwise(whole)
    cut = blocks.select(*KEYS, "pos", "type", "kind", "suppressed", "path", "items", F.posexplode(parts).alias("part", "p"))
    named = F.element_at(F.filter("items", lambda i: i["title"] == F.col("p.heading")), -1)["section"]
    by = W.partitionBy(*KEYS).orderBy("pos", "part").rowsBetween(W.unboundedPreceding, 0)
    section = F.coalesce(F.last(F.when(F.col("p.heading").isNotNull(), named), ignorenulls=True).over(by), F.lit("overview"))
    return cut.withColumn("section", section).where("p.heading is null").select(*KEYS, "section", "pos", "part", "type", F.col("p.text").alias("text"), "kind", "suppressed", "path")


def figure_html(path: Column, alt: Column) -> Column:
    return F.concat(F.lit('<figure class="reader-figure"><div class="reader-figure-scroll"><img src="./generated/'), text.escape_html(path), F.lit('" alt="'), text.escape_html(alt), F.lit('" loading="lazy" /></div></figure>'))


def table_html(rows: Column) -> Column:
    """An HTML table of an array of cell arrays, padded to the widest; rows ahead of the first code-like cell are its head.

    A row without a non-blank cell ends the head as well. No rows give an empty text.
    """
    widest = F.array_max(F.transform(rows, F.size))
    lead = lambda r: F.coalesce(F.get(F.filter(r, lambda c: F.trim(c) != ""), F.lit(0)), F.lit(""))
    body = F.transform(rows, lambda r: (lead(r) == "") | F.trim(lead(r)).rlike(rules.BODY_FIRST_CELL))
    heads = F.when(F.array_position(body, True) > 0, F.array_position(body, True) - 1).otherwise(F.size(rows))

    def line(r, tag):
        full = F.concat(r, F.array_repeat(F.lit(""), widest - F.size(r)))
        return F.concat(F.lit("<tr>"), F.array_join(F.transform(full, lambda c: F.concat(F.lit(f"<{tag}>"), text.escape_html(c), F.lit(f"</{tag}>"))), ""), F.lit("</tr>"))

    head = F.array_join(F.transform(F.slice(rows, F.lit(1), heads.cast("int")), lambda r: line(r, "th")), "")
    rest = F.array_join(F.transform(F.slice(rows, (heads + 1).cast("int"), F.greatest(F.size(rows), F.lit(1))), lambda r: line(r, "td")), "")
    made = F.concat(F.lit('<table class="reader-synthetic-table">'), F.when(heads > 0, F.concat(F.lit("<thead>"), head, F.lit("</thead>"))).otherwise(F.lit("")), F.lit("<tbody>"), rest, F.lit("</tbody></table>"))
    return F.when(F.size(rows) > 0, made).otherwise(F.lit(""))


def rendered(blocks: DataFrame, keys: list[str], alt: Column) -> DataFrame:
    """(keys, html, text, images): blocks in order as HTML and as text.

    Table rows with nothing shown between them make one table; bracketed headings become inline headings; suppressed
    paragraphs are text only. ``blocks`` has ``pos`` and ``part``; ``alt`` names the pictures.
    """
    shown = (F.col("type") != "paragraph") | ~F.col("suppressed")
    cells = text.cells(F.col("text"))
    row = (F.col("type") == "paragraph") & (F.col("kind") == "table/form") & (F.size(cells) >= 2)
    heading = (F.col("kind") == "heading") & F.col("text").rlike(rules.SPECIAL_HEADING)
    plain = F.when(F.col("type") != "paragraph", figure_html(F.col("path"), alt)).when(heading, F.concat(F.lit('<h4 class="reader-inline-heading">'), text.escape_html(F.col("text")), F.lit("</h4>"))).otherwise(text.paragraph_html(F.col("text")))
    marked = blocks.withColumns({"_shown": shown, "_row": shown & F.coalesce(row, F.lit(False)), "_cells": cells, "_plain": plain})
    # runs of table rows among the shown blocks: whatever is no row has a run of its own
    by = W.partitionBy(*keys, "_shown").orderBy("pos", "part")
    opens = F.when(F.col("_row") & F.coalesce(F.lag("_row").over(by), F.lit(False)), 0).otherwise(1)
    marked = marked.withColumn("_open", opens).withColumn("_run", F.sum("_open").over(by.rowsBetween(W.unboundedPreceding, 0)))
    at = F.struct("pos", "part")
    runs = marked.groupBy(*keys, "_shown", "_run", "_row").agg(
        F.min(at).alias("at"), F.array_sort(F.collect_list(F.struct(at.alias("at"), F.col("_cells").alias("c")))).alias("rows"), F.min_by("_plain", at).alias("plain"),
        F.array_sort(F.collect_list(F.struct(at.alias("at"), F.when(F.col("type") == "paragraph", F.col("text")).alias("t")))).alias("texts"), F.count_if(F.col("type") == "image").alias("n"),
    )
    piece = F.when(F.col("_shown"), F.when(F.col("_row"), table_html(F.col("rows.c"))).otherwise(F.col("plain")))
    runs = runs.withColumn("piece", piece)
    out = runs.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("at", "piece"))).alias("h"), F.array_sort(F.flatten(F.collect_list("texts"))).alias("t"), F.sum("n").alias("images"),
    )
    return out.select(*keys, F.array_join("h.piece", "").alias("html"), F.array_join("t.t", "\n\n").alias("text"), "images")


def part_intro(title: Column, chapters: Column) -> tuple[Column, Column]:
    """(HTML, text) of a part's introduction from its chapters' lines; the title alone where it has none."""
    lead = F.lit(rules.INTRO_SENTENCE)
    html = F.concat(text.paragraph_html(lead), F.array_join(F.transform(chapters, text.paragraph_html), ""))
    said = F.concat_ws(" ", lead, F.array_join(chapters, " / "))
    empty = F.size(chapters) == 0
    return F.when(empty, text.paragraph_html(title)).otherwise(html), F.when(empty, title).otherwise(said)


def chapter_line(title: Column, label: Column, page: Column) -> Column:
    """A chapter in its part's introduction: title and printed page, else the file's page."""
    place = F.when(F.coalesce(label, F.lit("")) != "", F.concat(F.lit("p."), label)).otherwise(F.concat(F.lit("PDF "), page))
    return F.concat(title, F.lit(" ("), place, F.lit(")"))


def chapter_html(title: Column, overview: Column, sections: Column) -> Column:
    """A chapter's page from its overview and an array of (id, title, html)."""
    each = F.transform(sections, lambda s: F.concat(F.lit('<section id="'), s["id"], F.lit('"><h3>'), s["title"], F.lit("</h3>"), s["html"], F.lit("</section>")))
    return F.concat(F.lit('<section id="overview"><h2>'), title, F.lit("</h2>"), overview, F.lit("</section>"), F.array_join(each, ""))


ENTRY = ["doc_id", "chapter", "ord", "entry_type", "id", "section", "section_title", "chapter_title", "part_title", "text", "excerpt", "page_start", "page_end", "label_start", "label_end", "images", "categories"]


def built(chapters: DataFrame, items: DataFrame, paragraphs: DataFrame, images: DataFrame, regions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(chapters, entries): every chapter with its HTML, summary and images, and the search entries of all.

    ``chapters`` has (doc_id, part, part_title, part_start, part_label, part_label_end, chapter, slug, title, page_start,
    page_end, label_start, label_end), ``items`` (doc_id, chapter, ord, section, title, page_start, page_end, label_start,
    label_end). A part's first chapter that starts behind its part has the part's introduction and, in the appendix, an
    alias entry. An overview ends before the first item. An empty table gives none.
    """
    key = [*KEYS, "section"]
    # written once: each is read for blocks, overviews, items and introductions
    chapters, items = O.written(chapters), O.written(items)
    titled = chapters.withColumn("titles", F.array("title", "part_title"))
    cut = segmented(range_blocks(titled.select(*KEYS, "page_start", "page_end", "titles"), paragraphs, images, regions), items)
    heads = items.select(*KEYS, "section", F.col("title").alias("alt")).groupBy(*key).agg(F.max("alt").alias("alt"))
    heads = heads.unionByName(chapters.select(*KEYS, F.lit("overview").alias("section"), F.col("title").alias("alt")))
    # written once too: the overviews, items, pages and entries below all read it; what a caller leaves out of them is not made
    made = O.written(rendered(cut.join(heads, key), key, F.col("alt")))
    spare = F.coalesce(F.nullif(F.col("text"), F.lit("")), F.col("own_title"))

    def entry(df, kind, own_id, section, title, said, limit, end, labels, categories):
        # columns of their own: each is used more than once, and a plan keeps what it would have to compute again
        df = df.withColumn("_plain", text.normalize(F.coalesce(said, F.lit("")))).withColumn("_text", text.repair(F.col("_plain")))
        return df.select(
            *KEYS, "ord", F.lit(kind).alias("entry_type"), own_id.alias("id"), section.alias("section"), title.alias("section_title"), F.col("chapter_title"), "part_title",
            F.col("_text").alias("text"), text.excerpt(F.col("_text"), limit).alias("excerpt"), "page_start", end.alias("page_end"), labels[0].alias("label_start"), labels[1].alias("label_end"),
            F.coalesce("images", F.lit(0)).alias("images"), categories.alias("categories"),
        )

    none = F.array().cast("array<string>")
    base = chapters.withColumn("chapter_title", F.col("title"))
    first_item = items.groupBy(*KEYS).agg(F.min_by("page_start", "ord").alias("first_item"))
    over = base.join(made.where("section = 'overview'"), KEYS, "left").join(first_item, KEYS, "left").withColumns({"own_title": F.col("title"), "ord": F.lit(0)})
    said = text.trim_headings(spare, F.array("title", "part_title"))
    over = over.withColumn("said", F.coalesce(F.nullif(said, F.lit("")), F.col("title"))).withColumn("cleaned", said)
    end = F.greatest("page_start", F.coalesce(F.col("first_item") - 1, F.col("page_end")))
    entries = entry(over, "overview", F.concat("slug", F.lit("-overview")), F.lit("overview"), F.lit(rules.OVERVIEW_TITLE), F.col("said"), 220, end, (F.col("label_start"), F.col("label_start")), none)
    parent = base.select(*KEYS, "chapter_title", "part_title")
    item = items.join(parent, KEYS).join(made, key, "left").withColumn("own_title", F.col("title"))
    said = text.trim_headings(spare, F.array("title", "chapter_title", "part_title"))
    item = item.withColumn("said", F.coalesce(F.nullif(said, F.lit("")), F.col("title")))
    classes = text.classify(F.concat_ws(" ", "title", "part_title"), part=F.col("part_title"))
    entries = entries.unionByName(entry(item, "item", F.col("section"), F.col("section"), F.col("title"), F.col("said"), 160, F.col("page_end"), (F.col("label_start"), F.col("label_end")), classes))
    by = W.partitionBy("doc_id", "part").orderBy("page_start", "chapter")
    lines = F.array_sort(F.collect_list(F.struct("page_start", "chapter", chapter_line(F.col("title"), F.col("label_start"), F.col("page_start")).alias("line"))))
    listed = base.groupBy("doc_id", "part").agg(lines.alias("lines"))
    lead = base.withColumn("_n", F.row_number().over(by)).where("_n = 1 and page_start > part_start").join(listed, ["doc_id", "part"])
    intro_html, intro_text = part_intro(F.col("part_title"), F.col("lines.line"))
    intro = lead.withColumns({"intro_html": intro_html, "said": intro_text, "own_end": F.col("page_start") - 1}).drop("page_start").withColumnsRenamed({"part_start": "page_start"}).withColumns({"ord": F.lit(-2), "images": F.lit(0).cast("long")})
    labels = (F.col("part_label"), F.col("part_label_end"))
    entries = entries.unionByName(entry(intro, "part-intro", F.concat("slug", F.lit("-part-intro")), F.lit("part-intro"), F.col("part_title"), F.col("said"), 160, F.col("own_end"), labels, none))
    alias = intro.where(F.col("part_title") == rules.APPENDIX_PART).withColumns({"said": F.concat_ws(" ", F.lit(rules.REVISION_TERMS), "said"), "ord": F.lit(-1)})
    entries = entries.unionByName(entry(alias, "search-alias", F.concat("slug", F.lit("-part-intro-alias-revision-history")), F.lit("part-intro"), F.lit(rules.REVISION_TITLE), F.col("said"), 160, F.col("own_end"), labels, F.array(F.lit("appendix"))))
    entries = entries.select(*ENTRY)
    # a chapter's page: introduction, overview, items; its summary from the entries' texts but the introduction's
    sections = item.select(*KEYS, F.struct("ord", F.col("section").alias("id"), "title", F.coalesce("html", F.lit("")).alias("html"), F.coalesce("images", F.lit(0)).alias("n")).alias("s"))
    sections = sections.unionByName(intro.select(*KEYS, F.struct(F.lit(-1).cast(items.schema["ord"].dataType).alias("ord"), F.lit("part-intro").alias("id"), F.col("part_title").alias("title"), F.col("intro_html").alias("html"), F.lit(0).cast("long").alias("n")).alias("s")))
    sections = sections.groupBy(*KEYS).agg(F.array_sort(F.collect_list("s")).alias("sections"))
    texts = entries.where("entry_type <> 'part-intro' and text <> ''").groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("ord", "text"))).alias("t")).select(*KEYS, F.array_join("t.text", "\n\n").alias("all_text"))
    pages = over.join(sections, KEYS, "left").join(texts, KEYS, "left")
    pages = pages.withColumn("_plain", text.normalize(F.coalesce(F.nullif(F.col("all_text"), F.lit("")), F.col("title"), F.lit("")))).withColumn("_text", text.repair(F.col("_plain")))
    fallback = F.when((F.col("cleaned") != "") & (text.clean_title(F.col("cleaned"), True) != F.col("title")), text.paragraph_html(F.col("cleaned"))).otherwise(F.lit(""))
    shown = F.coalesce(F.nullif(F.col("html"), F.lit("")), fallback)
    none_yet = F.array().cast("array<struct<id:string,title:string,html:string>>")
    count = F.coalesce("images", F.lit(0)) + F.coalesce(F.aggregate("sections.n", F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0))
    made_pages = pages.select(
        *KEYS, "part", "part_title", "slug", "title", "page_start", "page_end", "label_start", "label_end", text.excerpt(F.col("_text"), 220).alias("summary"),
        F.coalesce(chapter_html(F.col("title"), shown, F.col("sections")), chapter_html(F.col("title"), shown, none_yet)).alias("html"), count.alias("images"),
        F.coalesce(F.size(F.filter("sections", lambda s: s["ord"] >= 0)), F.lit(0)).alias("headings"),
    )
    return made_pages, entries


def exploration(entries: DataFrame) -> DataFrame:
    """The classified items among the entries, in the fields that exploring shows."""
    return entries.where((F.col("entry_type") == "item") & (F.size("categories") > 0)).select("doc_id", "id", F.col("section_title").alias("title"), "chapter_title", "part_title", "categories", "page_start", "page_end", "label_start", "label_end", (F.col("images") > 0).alias("has_image"), "excerpt")
