"""The audit bundle: coverage of pages, special sections, the query set, page comparisons, and the ledger's report.

Everything is per document (``doc_id``): pages (page, page_label, page_kind, has_text, image_count), reviews (page,
layout, chapter, section, merge_first, paragraphs), audits (page, tier, flags), entries (id, chapter, section,
section_title, chapter_title, part_title, text, excerpt, entry_type, page_start, page_end) and chapters (chapter, title,
part_title, summary, html, page_start, page_end).
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafloom.functions import rules, text
from leafloom.operators import qa
from leafloom.operators import relational as R


def query_form(c: Column) -> Column:
    """The normal form of the audit's search: lower case, white space as one space, trimmed."""
    return text.normalize(F.lower(F.coalesce(c, F.lit(""))))


def slug_of(chapter: Column, slug: Column) -> Column:
    """A record's chapter: the one that it names, else its own slug; empty ones count as none."""
    return F.coalesce(F.nullif(chapter, F.lit("")), F.nullif(slug, F.lit("")))


def exposure(chapters: Column, entries: Column, layout: Column) -> Column:
    """How a page is delivered, by its numbers of chapters and entries and its layout; null if not at all."""
    return F.when(F.coalesce(chapters, F.lit(0)) > 0, "reader-body").when(F.coalesce(entries, F.lit(0)) > 0, "search-only").when(layout == "toc", "toc-transform")


def coverage(pages: DataFrame, reviews: DataFrame, audits: DataFrame, entries: DataFrame, chapters: DataFrame) -> DataFrame:
    """Every page with its chapters, entries, review, audit and delivery mode.

    Pages without a review or an audit have nulls there; what covers no page of the inventory plays no part.
    """
    key = ["doc_id", "page"]
    on = lambda df, what: R.interval_points(df, "page_start", "page_end", "page").groupBy(*key).agg(F.count("*").alias(f"n_{what}"), F.array_sort(F.collect_list(F.struct("page_start", "page_end", *([F.col("chapter")] if what == "chapters" else [F.col("chapter"), F.col("section"), F.col("section_title"), F.col("entry_type")])))).alias(what))
    out = pages.join(on(chapters, "chapters"), key, "left").join(on(entries, "entries"), key, "left")
    out = out.join(reviews.select(*key, F.col("layout"), F.col("chapter").alias("review_chapter"), F.col("section").alias("review_section")), key, "left").join(audits.select(*key, "tier", "flags"), key, "left")
    return out.withColumns({"n_chapters": F.coalesce("n_chapters", F.lit(0)), "n_entries": F.coalesce("n_entries", F.lit(0))}).withColumn("mode", exposure(F.col("n_chapters"), F.col("n_entries"), F.col("layout")))


def coverage_summary(covered: DataFrame) -> DataFrame:
    """One row a document: pages by mode, text pages that are not shown, body pages that nothing covers, contents span."""
    mode = lambda m: F.count_if(F.col("mode").eqNullSafe(F.lit(m)))
    toc = F.when(F.col("mode") == "toc-transform", F.col("page"))
    listed = lambda test: F.array_sort(F.collect_list(F.when(test, F.col("page"))))
    return covered.groupBy("doc_id").agg(
        F.count("*").alias("pages"), mode("reader-body").alias("reader_body"), mode("search-only").alias("search_only"), mode("toc-transform").alias("toc_transform"), F.count_if("has_text").alias("text_pages"),
        listed(F.col("has_text") & F.col("mode").isNull()).alias("hidden_text_pages"), listed((F.col("page_kind") == "body") & F.col("mode").isNull()).alias("uncovered_body_pages"), listed(F.col("has_text") & F.col("page_label").isNull()).alias("unlabelled_text_pages"),
        F.array_compact(F.array(F.min(toc), F.max(toc))).alias("toc_span"),
    )


def special_sections(entries: DataFrame, chapters: DataFrame) -> DataFrame:
    """(doc_id, group, via, chapter, section, page_start, page_end, term): entries and chapters of the special groups.

    Records are distinct in these fields; the order of a group's report is page_start, chapter, via.
    """
    (preface, preface_title), (notes, notes_title) = rules.FRONT_CHAPTERS[1:]
    record = lambda group, term, test: F.when(F.coalesce(test, F.lit(False)), F.struct(F.lit(group).alias("group"), term.alias("term")))
    has = lambda term, *fields: reduce(lambda a, b: a | b, (F.contains(query_form(F.col(f)), query_form(F.lit(term))) for f in fields))
    column = F.col

    def found(df, via, section, tests, fields):
        tests = [
            record("front_preface", F.lit(preface_title), column("chapter") == preface), record("front_notes", F.lit(notes_title), column("chapter") == notes), *tests,
            record("appendix", F.lit(rules.APPENDIX_PART.replace(" ", "")), column("part_title") == rules.APPENDIX_PART), *(record(g, F.lit(t), has(t, *fields)) for g, t in rules.SPECIAL_TERMS),
        ]
        hits = df.withColumn("r", F.explode(F.array_compact(F.array(*tests))))
        return hits.select("doc_id", "r.group", F.lit(via).alias("via"), "chapter", section.alias("section"), "page_start", "page_end", "r.term")

    of_entries = [record("part_intro", column("section_title"), column("entry_type") == "part-intro"), record("revision_history", column("section_title"), column("section_title") == rules.REVISION_TITLE)]
    revised = F.contains("title", F.lit(rules.CATEGORIES[-1][1][1])) | F.contains("title", F.lit(rules.REVISION_TITLE))
    of_chapters = [record("part_intro", column("part_title"), F.contains("html", F.lit('id="part-intro"'))), record("revision_history", column("title"), revised)]
    out = found(entries, "search-index", F.col("section"), of_entries, ("section_title", "chapter_title", "text", "excerpt"))
    return out.unionByName(found(chapters, "document-data", F.lit(None).cast("string"), of_chapters, ("title", "summary"))).distinct()


def query_set(sections: DataFrame) -> DataFrame:
    """(doc_id, query, ord): the fixed queries, then the terms of the special sections, each once, in order."""
    fixed = F.posexplode(F.array(*map(F.lit, rules.FIXED_QUERIES)))
    given = sections.select("doc_id").distinct().select("doc_id", fixed.alias("n", "query")).select("doc_id", "query", F.struct(F.lit(-1).alias("group"), F.lit(0).cast("long").alias("page"), F.lit("").alias("chapter"), F.lit("").alias("via"), F.col("n").alias("n")).alias("at"))
    place = F.array_position(F.array(*map(F.lit, rules.QUERY_GROUPS)), F.col("group")).cast("int")
    terms = sections.where(F.col("group").isin(*rules.QUERY_GROUPS)).select("doc_id", text.normalize(F.col("term")).alias("query"), F.struct(place.alias("group"), F.col("page_start").cast("long").alias("page"), F.coalesce("chapter", F.lit("")).alias("chapter"), F.col("via"), F.lit(0).alias("n")).alias("at"))
    return given.unionByName(terms.where("query <> ''")).groupBy("doc_id", "query").agg(F.min("at").alias("at"))


def page_texts(reviews: DataFrame) -> DataFrame:
    """(doc_id, page, page_text): a page's non-empty paragraphs, repaired and joined."""
    return reviews.select("doc_id", "page", text.join_segments(F.col("paragraphs"), repair_each=True).alias("page_text"))


def candidates(pages: DataFrame, entries: DataFrame) -> DataFrame:
    """(doc_id, page, candidates, candidate_text): the entries over a page but aliases, by page and name, and their joined text."""
    one = F.struct("page_start", "page_end", F.coalesce("chapter", F.lit("")).alias("chapter"), F.coalesce("section", F.lit("")).alias("section"), text.route(F.col("chapter"), F.col("section")).alias("route"), F.coalesce("text", F.lit("")).alias("text"))
    on = R.interval_points(entries.where("entry_type <> 'search-alias'"), "page_start", "page_end", "page").groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(one)).alias("candidates"))
    none = F.array().cast(on.schema["candidates"].dataType)
    out = pages.select("doc_id", "page").join(on, ["doc_id", "page"], "left").withColumn("candidates", F.coalesce("candidates", none))
    return out.withColumn("candidate_text", text.join_segments(F.col("candidates.text")))


def locator(chapter: Column, section: Column, found: Column) -> Column:
    """(chapter, section, route, source) of a page: its review's, else its first candidate's, else none."""
    first = F.get(found, F.lit(0))
    own = F.struct(chapter.alias("chapter"), section.alias("section"), text.route(chapter, section).alias("route"), F.lit("page-review").alias("source"))
    other = F.struct(first["chapter"].alias("chapter"), first["section"].alias("section"), first["route"].alias("route"), F.lit("search-index-candidate").alias("source"))
    none = F.lit(None).cast("string")
    return F.when(F.coalesce(chapter, F.lit("")) != "", own).when(F.size(found) > 0, other).otherwise(F.struct(none.alias("chapter"), none.alias("section"), none.alias("route"), F.lit("none").alias("source")))


def marked(html: Column, section: Column) -> Column:
    """Whether a chapter's HTML has the section's marker."""
    return F.coalesce(F.contains(html, F.concat(F.lit('id="'), F.nullif(section, F.lit("")), F.lit('"'))), F.lit(False))


def limitations(found: Column, chapter: Column, section: Column, flags: Column, merged: Column) -> Column:
    """What limits a page's comparison: three notes that always hold, then those that its case adds, in order."""
    n = F.size(found)
    flagged = lambda name: F.coalesce(F.array_contains(flags, name), F.lit(False))
    notes = qa.flag_array(
        (rules.LIMIT_NO_CANDIDATE, n == 0), (rules.LIMIT_MANY, n >= 2), (rules.LIMIT_NO_CHAPTER, ~chapter), (rules.LIMIT_NO_SECTION, chapter & ~section),
        (rules.LIMIT_SECTIONS, flagged("multi-section-page")), (rules.LIMIT_MERGED, flagged("page-merge") | F.coalesce(merged, F.lit(False))),
    )
    return F.concat(F.array(*map(F.lit, rules.LIMITS_ALWAYS)), notes)


def status(tokens: Column, other: Column, found: Column, chapter: Column, section: Column, flags: Column, merged: Column) -> Column:
    """How well a page's text is backed by its candidates."""
    unsupported = (F.size(tokens) == 0) | (F.size(other) == 0) | (F.size(found) == 0) | ~chapter
    mixed = F.coalesce(F.arrays_overlap(flags, F.array(F.lit("multi-section-page"), F.lit("page-merge"))), F.lit(False)) | F.coalesce(merged, F.lit(False))
    return F.when(unsupported, "unsupported").when((F.size(found) >= 2) | ~section | mixed, "ambiguous").otherwise("candidate-backed")


def compared(covered: DataFrame, reviews: DataFrame, entries: DataFrame, chapters: DataFrame) -> DataFrame:
    """Every reviewed page's comparison: locator, evidence, token numbers, status and limits."""
    key = ["doc_id", "page"]
    pages = reviews.select(*key, "merge_first").join(page_texts(reviews), key).join(candidates(reviews, entries), key).join(covered.select(*key, "review_chapter", "review_section", "flags"), key, "left")
    pages = pages.withColumn("locator", locator(F.col("review_chapter"), F.col("review_section"), F.col("candidates"))).withColumn("chapter", F.col("locator.chapter"))
    pages = pages.join(chapters.select("doc_id", "chapter", "html"), ["doc_id", "chapter"], "left")
    has, section = F.col("html").isNotNull(), marked(F.col("html"), F.col("locator.section"))
    pages = pages.withColumns({"chapter_found": has, "section_found": section, "tokens": text.tokens(text.for_search(F.col("page_text"))), "others": text.tokens(text.for_search(F.col("candidate_text")))})
    case = (F.col("candidates"), F.col("chapter_found"), F.col("section_found"), F.col("flags"), F.col("merge_first"))
    return pages.select(*key, "locator", F.size("candidates").alias("n_candidates"), "chapter_found", "section_found", F.size("tokens").alias("page_tokens"), F.size("others").alias("candidate_tokens"), status(F.col("tokens"), F.col("others"), *case).alias("status"), limitations(*case).alias("limitations"), "tokens", "others")


def special_report(groups: dict[str, Column]) -> Column:
    """The ledger's lines of special sections from the groups' numbers of records."""
    return F.concat_ws("\n", *(F.concat(F.lit(f"- `{g}`: `"), F.coalesce(groups.get(g, F.lit(0)), F.lit(0)).cast("string"), F.lit("` record(s)")) for g in rules.SPECIAL_GROUPS))


def listed(c: Column) -> Column:
    """An array as the ledger shows it."""
    return F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: x.cast("string")), ", "), F.lit("]"))


def report(values: dict[str, Column]) -> Column:
    """The ledger of a bundle as Markdown: the fixed text with its names filled in; null values read ``None``."""
    files = F.lit("\n".join(f"- `{name}`" for name in rules.ARTIFACTS))
    given = {"baseline": F.lit(""), "files": files} | values
    parts = re.split(r"\{(\w+)\}", rules.LEDGER)
    return F.concat(*(F.lit(x) if n % 2 == 0 else F.coalesce(given[x].cast("string"), F.lit("None")) for n, x in enumerate(parts)))


def baseline_line(bundle: str | None) -> Column:
    """The ledger's line about the bundle that this one is compared with."""
    return F.lit(f"- baseline reference: `data/research/pdf-web-audit/{bundle}/`\n" if bundle else "")


def bundle_ids(today: str, bundle: str | None = None, baseline: str | None = None) -> tuple[str, str | None]:
    """(bundle, baseline) as the command line gives them: a day's bundle by default, against that day's without ``-r2``."""
    bundle = bundle or f"{today}-r2"
    return bundle, baseline or (bundle.removesuffix("-r2") if bundle.endswith("-r2") else None)
