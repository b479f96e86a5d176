"""Flags, risk tiers, priority scores, the review queue and its batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafloom.functions import rules
from leafloom.operators import ordered


def flag_array(*tests: tuple[str, Column]) -> Column:
    """The names of the tests that hold, in order."""
    return F.array_compact(F.array(*(F.when(test, F.lit(name)) for name, test in tests)))


def page_flags(overlap: Column, confidence: Column, override: Column, merged: Column, paragraphs: Column, layout: Column, html: Column, residue: Column) -> Column:
    """The ten flags of a page review in their fixed order; ``paragraphs`` is an array of texts."""
    some = lambda p: F.exists(paragraphs, lambda x: x.rlike(p) & ~F.contains(x, F.lit("|")))
    crop = F.contains(html, F.lit("table-crop"))
    return flag_array(
        ("multi-section-page", overlap >= 2), ("low-confidence", confidence == "low"), ("has-override", override), ("page-merge", merged), ("boxed-heading", some(rules.BOXED_HEADING)),
        ("angle-heading", some(rules.ANGLE_HEADING)), ("korean-linebreak-residue", residue), ("missing-table-crop", (layout == "table/form") & ~crop),
        ("synthetic-table-remains", crop & F.contains(html, F.lit("synthetic-table"))), ("structural-fragment-paragraph", F.exists(paragraphs, lambda x: x.rlike(rules.FRAGMENT_PARAGRAPH))),
    )


def risk_tier(flags: Column, layout: Column, confidence: Column) -> Column:
    """high, medium or low by layout, confidence and flags."""
    some = lambda *names: F.arrays_overlap(flags, F.array(*map(F.lit, names)))
    residue = F.array_contains(flags, "korean-linebreak-residue")
    high = (layout == "table/form") | some("multi-section-page", "low-confidence", "has-override", "page-merge")
    medium = ((layout == "list") & some("boxed-heading", "angle-heading", "korean-linebreak-residue")) | residue
    low = layout.isin("decorative/structural", "list") | (confidence == "high")
    return F.when(high, "high").when(medium, "medium").when(low, "low").otherwise("medium")


def weights(flags: Column, table: dict[str, int] = rules.FLAG_WEIGHTS, unknown: int = 10) -> Column:
    """The sum of the flags' weights."""
    lookup = F.create_map(*(F.lit(x) for pair in table.items() for x in pair))
    return F.aggregate(flags, F.lit(0), lambda a, f: a + F.coalesce(F.element_at(lookup, f), F.lit(unknown)))


def priority(flags: Column, layout: Column, confidence: Column, overlap: Column) -> Column:
    """A page's place in the queue: weights, tables and low confidence, and each section that meets on it."""
    only = (F.size(flags) == 1) & F.array_contains(flags, "multi-section-page")
    return weights(flags) + F.when(layout == "table/form", 12).otherwise(0) + F.when(confidence == "low", 8).otherwise(0) + F.when((overlap >= 2) & ~only, overlap * 4).otherwise(0)


def lane(flags: Column, accuracy=rules.ACCURACY_FLAGS) -> Column:
    return F.when(F.arrays_overlap(flags, F.array(*map(F.lit, accuracy))), "accuracy-critical").otherwise("readability-critical")


def ordered_flags(flags: Column, table: dict[str, int] = rules.FLAG_WEIGHTS) -> Column:
    """Flags by falling weight, then name, joined."""
    lookup = F.create_map(*(F.lit(x) for pair in table.items() for x in pair))
    keyed = F.transform(flags, lambda f: F.struct((-F.coalesce(F.element_at(lookup, f), F.lit(10))).alias("w"), f.alias("f")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda x: x["f"]), ", ")


def queue(pages: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """Pages with a ``score`` and ``lane`` ranked: score, accuracy lane first, key; the first ``limit`` if given."""
    order = [F.desc("score"), F.when(F.col("lane") == "accuracy-critical", 0).otherwise(1), F.col(key)]
    return ordered.top_ranked(pages, order, limit) if limit else ordered.ranked(pages, order)


def batch_summary(batched: DataFrame, key: str) -> DataFrame:
    """Each batch with its number of pages, ranks, pages in order, and counts of lanes, layouts and flags.

    ``batched`` has batch, rank, lane, layout, flags and the key; a batch has a fixed number of rows, so its lists are
    short. ``counts`` is an array of (dimension, value, n), sorted.
    """
    one = lambda d, c: F.struct(F.lit(d).alias("dimension"), F.col(c).alias("value"))
    every = F.concat(F.array(one("lane", "lane"), one("layout", "layout")), F.transform("flags", lambda f: F.struct(F.lit("flag").alias("dimension"), f.alias("value"))))
    counts = batched.select("batch", F.explode(every).alias("d")).groupBy("batch", "d.dimension", "d.value").agg(F.count("*").alias("n")).groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("dimension", "value", "n"))).alias("counts"))
    pages = F.transform(F.array_sort(F.collect_list(F.struct("rank", F.col(key).alias("key")))), lambda x: x["key"])
    return batched.groupBy("batch").agg(F.count("*").alias("page_count"), F.concat_ws("-", F.min("rank"), F.max("rank")).alias("rank_range"), pages.alias("pages")).join(counts, "batch")


def batch_report(rows: DataFrame, size: int) -> DataFrame:
    """One row: the Markdown report of the first batches, a table of pages each; no rows give the head alone."""
    cell = lambda c: F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit("-"))
    shown = ("rank", "page", "label", "layout", "score", "flag_summary", "chapter", "qa_path", "chapter_path")
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *(cell(c) for c in shown)), F.lit(" |"))
    lane = lambda name: F.count_if(F.col("lane") == name).cast("string")
    per = rows.groupBy("batch").agg(F.min("rank").alias("a"), F.max("rank").alias("z"), F.count("*").alias("n"), lane("accuracy-critical").alias("x"), lane("readability-critical").alias("y"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", line.alias("l")))), lambda r: r["l"]), "\n").alias("body"))
    said = lambda lead, *c: F.concat(F.lit(lead), *c)
    block = F.concat_ws("\n", said("## Batch ", "batch"), F.lit(""), said("- rank range: ", "a", F.lit(" - "), "z"), said("- page count: ", "n"), said("- accuracy-critical: ", "x"), said("- readability-critical: ", "y"), F.lit(""), F.lit("| Rank | Page | Label | Layout | Score | Flags | Chapter | QA Path | Chapter Path |"), F.lit("| " + " | ".join(["---"] * len(shown)) + " |"), F.col("body"), F.lit(""))
    made = per.select("batch", "n", block.alias("t"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("batch", "t"))), lambda r: r["t"]), "\n")
    head = F.concat_ws("\n", F.lit("# First Review Batches"), F.lit(""), said("- top pages covered: ", F.coalesce(F.sum("n"), F.lit(0))), said("- batch count: ", F.count("*")), F.lit(f"- batch size: {size}"), F.lit(""))
    return made.agg(F.concat_ws("\n", head, text).alias("markdown"))
