"""Tables of contents: contents pages, made-up front and back parts, and parts, chapters and items of an outline.

Everything is per document (``doc_id``); slugs are unique within a document and level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafloom.functions import rules, text
from leafloom.operators import ordered as O
from leafloom.operators import relational as R

CHAPTER = ["doc_id", "part_ord", "part", "part_title", "part_start", "part_end", "ord", "slug", "label", "title", "page_start", "page_end", "label_start", "label_end"]


def contents_pages(pages: DataFrame, limit: int = 40, marker: str = rules.TOC_MARKER) -> DataFrame:
    """(doc_id, page): from the first page up to ``limit`` with the marker, the pages in front matter without a break.

    ``pages`` has (doc_id, page, text, page_kind). Null texts hold no marker; without a marker there are none.
    """
    by = W.partitionBy("doc_id").orderBy("page")
    first = F.min(F.when((F.col("page") <= limit) & F.coalesce(F.col("text").rlike(marker), F.lit(False)), F.col("page"))).over(W.partitionBy("doc_id"))
    behind = pages.withColumn("_first", first).where(F.col("page") >= F.col("_first"))
    ended = F.sum(F.when(F.col("page_kind").eqNullSafe(F.lit("frontmatter")), 0).otherwise(1)).over(by.rowsBetween(W.unboundedPreceding, 0))
    return behind.withColumn("_ended", ended).where("_ended = 0").select("doc_id", "page")


def made_up(documents: DataFrame, level1: DataFrame, contents: DataFrame) -> DataFrame:
    """Chapters of the front part (cover, preface, notes) and, where there are editors, of the back part.

    ``documents`` has (doc_id, page_count), ``level1`` (doc_id, title, page_start, page_end, label_start, label_end); of
    equal titles the last counts. The notes end before the contents pages. Columns are ``CHAPTER``.
    """
    first = contents.groupBy("doc_id").agg(F.min("page").alias("toc"))
    named = level1.groupBy("doc_id", text.clean_title(F.col("title"), True).alias("title")).agg(F.max_by(F.struct("page_start", "page_end", "label_start", "label_end"), "page_start").alias("e"))
    doc = documents.join(first, "doc_id", "left")
    front_end = F.coalesce(F.col("toc") - 1, F.lit(rules.FRONT_END)).cast("long")
    none = F.lit(None).cast("string")

    def chapter(df, part_ord, part, start, end, ord, slug, label, title, own_start, own_end, labels):
        cells = (F.lit(part_ord), F.lit(part[0]), F.lit(part[1]), start, end, F.lit(ord), F.lit(slug), F.lit(label), F.lit(title), own_start, own_end, *labels)
        types = ("int", "string", "string", "long", "long", "int", "string", "string", "string", "long", "long", "string", "string")
        return df.select("doc_id", *(c.cast(t).alias(n) for c, t, n in zip(cells, types, CHAPTER[1:], strict=True)))

    front, one = ("frontmatter", rules.FRONT_PART), F.lit(1)
    (cover, cover_title), preface, notes = rules.FRONT_CHAPTERS
    out = chapter(doc, 0, front, one, front_end, 0, cover, rules.FRONT_PART, cover_title, F.lit(rules.COVER_PAGES[0]), F.lit(rules.COVER_PAGES[1]), (none, none))
    own = (F.col("e.label_start"), F.col("e.label_end"))
    for n, (slug, title) in enumerate((preface, notes), 1):
        end = F.col("e.page_end") if slug == preface[0] else F.least(F.col("e.page_end"), F.col("toc") - 1)
        out = out.unionByName(chapter(doc.join(named.where(F.col("title") == title), "doc_id"), 0, front, one, front_end, n, slug, title, title, F.col("e.page_start"), end, own))
    slug, title, label = rules.BACK_CHAPTER
    back = doc.join(named.where(F.col("title") == title), "doc_id")
    return out.unionByName(chapter(back, 1, ("backmatter", rules.BACK_PART), F.col("e.page_start"), F.col("page_count"), 0, slug, label, title, F.col("e.page_start"), F.col("page_count"), own))


def _named(entries: DataFrame, pattern: str, longest: int) -> DataFrame:
    """Outline entries of one level with label, full and short title and a slug that is unique in the document."""
    raw, rest = text.split_label(F.col("title"), pattern)
    hit = F.col("title").rlike(pattern)
    label = F.when(hit, text.clean_title(raw)).otherwise(F.col("title"))
    full = F.when(hit, F.trim(F.concat_ws(" ", text.clean_title(raw), text.clean_title(rest)))).otherwise(F.col("title"))
    named = entries.withColumns({"label": label, "full_title": full})
    behind = text.clean_title(F.substr("full_title", F.length("label") + 1, F.length("full_title")))
    named = named.withColumn("short", F.when(F.startswith("full_title", F.col("label")), behind).otherwise(F.col("full_title"))).withColumn("base", text.slug(F.col("full_title"), longest))
    return O.unique_slugs(named, "doc_id", "index", "base", longest)


def hierarchy(entries: DataFrame, longest: int = 80) -> tuple[DataFrame, DataFrame]:
    """(chapters, items) of an outline: level 2 are parts, 3 chapters of their parent part, 4 items of their chapter.

    ``entries`` has (doc_id, index, level, title, page_start, page_end, label_start, label_end, parent). Entries without
    a parent of the level above are left out.
    """
    columns = ["doc_id", "index", "title", "page_start", "page_end", "label_start", "label_end", "parent"]
    at = lambda k: entries.where(F.col("level") == k).select(*columns)
    parts = _named(at(2), rules.PART_TITLE, longest)
    upper = lambda df, name: df.select("doc_id", F.col("index").alias("parent"), F.struct("index", F.col("slug").alias("slug"), F.col("full_title").alias("title"), "page_start", "page_end").alias(name))
    chapters = _named(at(3).join(parts.select("doc_id", F.col("index").alias("parent")), ["doc_id", "parent"], "left_semi"), rules.CHAPTER_TITLE, longest)
    items = _named(at(4).join(chapters.select("doc_id", F.col("index").alias("parent")), ["doc_id", "parent"], "left_semi"), rules.SECTION_TITLE, longest)
    of_part = chapters.join(upper(parts, "p"), ["doc_id", "parent"])
    part_ord = F.dense_rank().over(W.partitionBy("doc_id").orderBy("p.index")) + 1
    ord = F.row_number().over(W.partitionBy("doc_id", "p.index").orderBy("index")) - 1
    long = lambda c: F.col(c).cast("long")
    out = of_part.select("doc_id", part_ord.alias("part_ord"), F.col("p.slug").alias("part"), F.col("p.title").alias("part_title"), long("p.page_start").alias("part_start"), long("p.page_end").alias("part_end"), ord.alias("ord"), "slug", "label", F.col("full_title").alias("title"), long("page_start").alias("page_start"), long("page_end").alias("page_end"), "label_start", "label_end")
    below = items.join(upper(chapters, "c"), ["doc_id", "parent"])
    n = F.row_number().over(W.partitionBy("doc_id", "c.index").orderBy("index")) - 1
    return out, below.select("doc_id", F.col("c.slug").alias("chapter"), n.alias("ord"), F.col("slug").alias("section"), "label", F.col("full_title").alias("title"), long("page_start").alias("page_start"), long("page_end").alias("page_end"), "label_start", "label_end")


def built(outline: DataFrame, pages: DataFrame, limit: int = 40, longest: int = 80) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(chapters, items, counts) of documents from their outline and their pages.

    ``outline`` has (doc_id, index, level, title, page_start, label_start), levels from 1 to 4; ``pages`` (doc_id, page,
    page_label, page_kind, text). An entry ends before the next of no deeper level, and its last label is that of the
    last labelled page in its range. Documents without an outline have the front part alone.
    """
    documents = pages.groupBy("doc_id").agg(F.max("page").alias("page_count"))
    ranged = R.range_by_level(outline.join(documents, "doc_id"), ["doc_id"], "index", "level", 4, "page_start", F.col("page_count"), "page_end")
    ranged = R.parent_by_level(ranged, ["doc_id"], "index", "level", 4)
    labelled = pages.where("page_label is not null").select("doc_id", "page", "page_label")
    # the last label in a range is the last one up to its end, if that lies in the range
    last = F.last("page_label", ignorenulls=True).over(W.partitionBy("doc_id").orderBy("page", "kind").rowsBetween(W.unboundedPreceding, 0))
    where = F.last(F.when(F.col("page_label").isNotNull(), F.col("page")), ignorenulls=True).over(W.partitionBy("doc_id").orderBy("page", "kind").rowsBetween(W.unboundedPreceding, 0))
    ends = ranged.select("doc_id", F.col("page_end").alias("page"), F.lit(1).alias("kind"), F.lit(None).cast("string").alias("page_label"), "index")
    points = labelled.withColumns({"kind": F.lit(0), "index": F.lit(None).cast(outline.schema["index"].dataType)}).unionByName(ends)
    found = points.withColumns({"l": last, "at": where}).where("kind = 1").select("doc_id", "index", "l", "at")
    entries = ranged.join(found, ["doc_id", "index"], "left").withColumn("label_end", F.when(F.col("at") >= F.col("page_start"), F.col("l"))).drop("l", "at")
    contents = contents_pages(pages, limit)
    chapters, items = hierarchy(entries, longest)
    front = made_up(documents, entries.where("level = 1"), contents)
    chapters = front.unionByName(chapters)
    per = lambda df, name: df.groupBy("doc_id").agg(F.count("*").alias(name))
    counts = documents.select("doc_id").join(chapters.groupBy("doc_id").agg(F.count_distinct("part_ord").alias("parts"), F.count("*").alias("chapters")), "doc_id", "left")
    counts = counts.join(per(items, "items"), "doc_id", "left").join(per(contents, "contents_pages"), "doc_id", "left")
    return chapters, items, counts.fillna(0, ["parts", "chapters", "items", "contents_pages"])


def opens_contents(c: Column) -> Column:
    """Whether a text begins like a table of contents."""
    x = text.normalize(c)
    return F.startswith(x, F.lit("목 차")) | F.startswith(x, F.lit("목차"))
