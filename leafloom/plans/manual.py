"""Books made of ``documents``: twenty documents a book, each a chapter of twelve pages, five chapters a part.

They give the document operators whole tables to work on: chapters, items, paragraphs, page images and table regions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafloom.functions import rules, text
from leafloom.operators import regions as G
from leafloom.sources.tables import table

PER_BOOK, PAGES, LINES = 20, 12, 4


def chapters(docs: DataFrame) -> DataFrame:
    """The chapters of all books: each begins on the second of its twelve pages, so a part's first leaves a page free."""
    n = F.pmod("doc_id", F.lit(PER_BOOK))
    part = F.floor(n / 5)
    words = text.first_words(F.coalesce("text", F.lit("")), 3)
    return docs.select(
        F.floor(F.col("doc_id") / PER_BOOK).alias("doc_id"), F.col("doc_id").alias("chapter"), n.alias("ord"), F.concat(F.lit("p"), part).alias("part"),
        F.when(part == 3, rules.APPENDIX_PART).otherwise(F.concat(F.lit("제"), part + 1, F.lit("편"))).alias("part_title"), (part * 5 * PAGES + 1).alias("part_start"),
        F.lit(None).cast("string").alias("part_label"), F.lit(None).cast("string").alias("part_label_end"), F.concat(F.lit("c"), "doc_id").alias("slug"),
        text.clean_title(F.coalesce(F.nullif(words, F.lit("")), F.concat(F.lit("chapter "), "doc_id")), True).alias("title"), (n * PAGES + 2).alias("page_start"), (n * PAGES + PAGES - 1).alias("page_end"),
        F.when(n % 2 == 0, (n * PAGES + 2).cast("string")).alias("label_start"), F.when(n % 2 == 0, (n * PAGES + PAGES - 1).cast("string")).alias("label_end"), "source", "lang",
    )


def books(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """chapters, items, paragraphs, images and regions of all books."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source", "lang").where("doc_id is not null")
    heads = chapters(docs)
    n = F.pmod("doc_id", F.lit(PER_BOOK))
    # a page's lines are neighbours in the text, so places follow from the line's number; a line carries a flag a page
    last = PAGES - 3
    before = [F.get("all", F.lit(k * LINES - 1)) for k in range(last + 1)]
    opens = F.array(*(F.coalesce((x != "") & ~x.rlike(r"[.!?]\s*$"), F.lit(False)) for x in before))
    split = docs.withColumn("all", F.split(F.coalesce("text", F.lit("")), "\n")).select("doc_id", "all", opens.alias("opens"))
    lines = split.select("doc_id", "opens", F.posexplode("all").alias("i", "text"))
    block = F.least(F.floor(F.col("i") / LINES), F.lit(last)).cast("int")
    lines = lines.withColumns({"page": n * PAGES + 2 + block.cast("long"), "index": F.col("i") - block * LINES, "first": F.get("opens", block)})
    table_row = F.contains("text", F.lit(" | "))
    kind = F.when(table_row, "table/form").when(F.col("text").rlike(rules.SPECIAL_HEADING), "heading").otherwise("body")
    book = F.floor(F.col("doc_id") / PER_BOOK).alias("doc_id")
    paragraphs = lines.select(book, "page", "index", "text", kind.alias("kind"), F.array("i").alias("lines"), F.col("first").alias("merge_first"))
    rows = paragraphs.where("kind = 'table/form'").withColumn("region", F.pmod(F.floor(F.get("lines", F.lit(0)) / 2), F.lit(2)) + 1)
    regions = rows.groupBy("doc_id", "page", "region").agg(F.array_sort(F.flatten(F.collect_list("lines"))).alias("lines"))
    # every third page shows its tables as pictures
    regions = regions.where("page % 3 = 0").select("doc_id", "page", F.col("region").cast("int").alias("region"), "lines", G.crop_path(F.col("page"), F.col("region")).alias("path"))
    pages = heads.select("doc_id", F.explode(F.sequence("page_start", "page_end")).alias("page")).where("page % 7 = 0")
    images = pages.select("doc_id", "page", F.lit(0).alias("ord"), F.format_string("images/p%04d.png", F.col("page")).alias("path"))
    words = F.split(text.first_words(F.coalesce("text", F.lit("")), 53), " ")
    pair = F.explode(F.array(*(F.struct(F.lit(k).alias("ord"), F.array_join(F.slice("w", 25 * k + 1, 2), " ").alias("title")) for k in (1, 2))))
    titled = docs.withColumn("w", words).where(F.size("w") > 52).select("doc_id", pair.alias("t")).where("t.title <> ''")
    none = F.lit(None).cast("string")
    items = titled.select(book, F.col("doc_id").alias("chapter"), F.col("t.ord").alias("ord"), F.concat(text.slug(F.col("t.title")), F.lit("-"), F.col("t.ord")).alias("section"), text.clean_title(F.col("t.title"), True).alias("title"), (n * PAGES + 2 + F.col("t.ord") * 3).alias("page_start"), (n * PAGES + PAGES - 1).alias("page_end"), none.alias("label_start"), none.alias("label_end"))
    return {"chapters": heads, "items": items, "paragraphs": paragraphs, "images": images, "regions": regions}
