"""Export of chapters as Markdown: sections, policy, chapter and part files, the ledger of what is left out, an index.

Chapters have (doc_id, ord, slug, title, part_title, page_start, page_end, label_start, label_end, html, headings: array of
(id, title)); risky sections (doc_id, slug, section, page, label, flags). A document's files are made beside each other;
a part file gathers its own chapters only.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafloom.functions import rules, text

_SECTION = r'(?s)<section\s+id="([^"]+)">(.*?)</section>'
_LEVELS = {"h2": 0, "h3": 1, "h4": 2}


def split_sections(page: Column) -> Column:
    """A chapter's HTML as an array of (id, html); without sections, one of null id with all of it."""
    ids, bodies = (F.regexp_extract_all(page, F.lit(_SECTION), g) for g in (1, 2))
    whole = F.array(F.struct(F.lit(None).cast("string").alias("id"), page.alias("html")))
    return F.when(F.size(ids) > 0, F.zip_with(ids, bodies, lambda i, b: F.struct(i.alias("id"), b.alias("html")))).otherwise(whole)


class _Blocks(HTMLParser):
    """Headings, paragraphs and images of a fragment, as (tag, text) in order; text outside them is passed over."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, str]] = []
        self.open: str | None = None
        self.said: list[str] = []

    def finish(self):
        if self.open:
            self.found.append((self.open, "".join(self.said)))
        self.open, self.said = None, []

    def handle_starttag(self, tag, attrs):
        if tag == "p" or tag in _LEVELS:
            self.finish()
            self.open = tag
        elif tag == "img":
            self.found.append(("img", dict(attrs).get("alt") or rules.IMAGE_WORD))

    def handle_endtag(self, tag):
        if tag == self.open:
            self.finish()

    def handle_data(self, data):
        if self.open:
            self.said.append(data)


def _markdown(fragment: str | None, title: str | None, level: int) -> str | None:
    if fragment is None:
        return None
    parser = _Blocks()
    parser.feed(fragment)
    parser.close()
    parser.finish()
    own, out = text.bookmark_title(title or ""), []
    for tag, raw in parser.found:
        said = text.repaired(" ".join(raw.replace("\0", " ").split()))
        if tag == "img":
            out.append(rules.IMAGE_NOTE.format(said))
        elif said and tag == "p":
            out.append(said)
        elif said and not (tag == "h2" and text.bookmark_title(said) == own):
            out.append("#" * (level + _LEVELS[tag]) + " " + said)
    return "\n\n".join(out)


def markdown(fragment: Column, title: Column, level: int = 1) -> Column:
    """Headings (h2 to h4), paragraphs and image notes of HTML as Markdown, repaired; other markup and text is dropped.

    ``level`` is that of an h2; an h2 that repeats the title is dropped. Null stays null.
    """

    def run(pages: pd.Series, titles: pd.Series) -> pd.Series:
        return pd.Series([_markdown(p, t, level) for p, t in zip(pages, titles, strict=True)], dtype=object)

    return F.pandas_udf(run, "string")(fragment, title)


def risks(queue: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(by chapter, by section): pages, labels and flags of the review queue, sorted and distinct."""

    def gathered(*keys):
        sets = (F.array_sort(F.collect_set("page")).alias("pages"), F.array_sort(F.collect_set(F.nullif(F.col("label"), F.lit("")))).alias("labels"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("flags")))).alias("flags"))
        info = queue.groupBy("doc_id", *keys).agg(*sets, F.array_sort(F.collect_set("section")).alias("sections"))
        return info.withColumn("details", risk_details(F.col("pages"), F.col("labels"), F.col("flags")))

    return gathered("slug"), gathered("slug", "section")


def risk_details(pages: Column, labels: Column, flags: Column) -> Column:
    """What a note says of reviewed pages; empty for none."""
    part = lambda lead, c: F.when(F.size(c) > 0, F.concat(F.lit(lead), F.array_join(F.transform(c, lambda x: x.cast("string")), ", ")))
    return F.concat_ws("; ", part("인쇄 ", labels), part("PDF ", pages), part("flags: ", flags))


def _with(base: Column, details: Column) -> Column:
    return F.when(F.coalesce(details, F.lit("")) != "", F.concat(base, F.lit(" ("), details, F.lit(")"))).otherwise(base)


def policy(slug: Column, part: Column, headed: Column, risky: Column) -> Column:
    """Whether a chapter goes into the export: include, omit-sections (notes in place of risky ones) or exclude."""
    never = slug.isin(*rules.ALWAYS_EXCLUDED) | part.isin(*rules.EXCLUDED_PARTS)
    return F.when(never, "exclude").when(risky & ~headed & ~slug.isin(*rules.ALWAYS_INCLUDED), "exclude").when(risky & headed, "omit-sections").otherwise("include")


def reason(slug: Column, part: Column, details: Column, name: str = rules.EXPORT_NAME) -> Column:
    """Why a chapter is left out."""
    said = lambda x: F.lit(x.format(name=name))
    return F.when(slug == rules.ALWAYS_EXCLUDED[0], said(rules.EXCLUDED_COVER)).when((slug == rules.ALWAYS_EXCLUDED[1]) | (part == rules.BACK_PART), said(rules.EXCLUDED_BACK)).when(part == rules.APPENDIX_PART, said(rules.EXCLUDED_APPENDIX)).otherwise(_with(said(rules.EXCLUDED_RISKY), details))


def page_range(start: Column, end: Column) -> Column:
    """``start-end``, one of them, or ``-``; empty labels count as none."""
    return text.locator(F.nullif(start.cast("string"), F.lit("")), F.nullif(end.cast("string"), F.lit("")))


def place(row) -> Column:
    """The printed and the file's pages of a chapter."""
    printed, own = page_range(row["label_start"], row["label_end"]), page_range(row["page_start"], row["page_end"])
    return F.when(printed == "-", F.concat(F.lit("PDF "), own)).otherwise(F.concat(F.lit("인쇄 "), printed, F.lit(" / PDF "), own))


def bodies(chapters: DataFrame, queue: DataFrame, name: str = rules.EXPORT_NAME) -> tuple[DataFrame, DataFrame]:
    """(chapters with ``policy``, ``reason``, ``body`` and ``part_body``, omitted sections with their note).

    Risky sections of chapters with headings are replaced by a note; introductions of parts are skipped. Bodies are null
    for chapters that are left out.
    """
    by_chapter, by_section = risks(queue)
    own = chapters.join(by_chapter.select("doc_id", "slug", F.col("sections").alias("risky"), "details"), ["doc_id", "slug"], "left")
    headed = F.coalesce(F.size("headings") > 0, F.lit(False))
    own = own.withColumn("policy", policy(F.col("slug"), F.col("part_title"), headed, F.col("risky").isNotNull())).withColumn("reason", F.when(F.col("policy") == "exclude", reason(F.col("slug"), F.col("part_title"), F.col("details"), name)))
    kept = own.where("policy <> 'exclude'")
    parts = kept.select("doc_id", "slug", "ord", "title", "part_title", "headings", "policy", F.posexplode(split_sections(F.col("html"))).alias("n", "s")).where(f"coalesce(s.id, '') <> '{rules.SKIPPED_SECTIONS[0]}'")
    risky = by_section.select("doc_id", "slug", F.col("section").alias("_section"), F.col("details").alias("_details"), F.lit(True).alias("_risky"))
    parts = parts.withColumn("_section", F.col("s.id")).join(risky, ["doc_id", "slug", "_section"], "left")
    title = F.coalesce(F.get(F.filter("headings", lambda h: h["id"] == F.col("_section")), F.lit(0))["title"], F.when(F.col("_section") == "overview", F.lit(rules.OVERVIEW_TITLE)), F.col("_section"))
    omitted = F.col("_risky").isNotNull() & (F.col("policy") == "omit-sections")
    note = _with(F.concat(title, F.lit(rules.OMITTED_SECTION.format(title="", name=name))), F.col("_details"))
    parts = parts.withColumns({"section_title": title, "omitted": omitted, "note": note})
    said = lambda level: F.when(F.col("omitted"), F.concat(F.lit("> 생략: "), F.col("note"))).otherwise(markdown(F.col("s.html"), F.col("title"), level))
    parts = parts.withColumns({"_own": said(1), "_part": said(2)})
    joined = lambda c: F.array_join(F.filter(F.transform(F.array_sort(F.collect_list(F.struct("n", F.col(c).alias("t")))), lambda x: x["t"]), lambda x: x != ""), "\n\n")
    whole = parts.groupBy("doc_id", "slug").agg(joined("_own").alias("body"), joined("_part").alias("part_body"), F.count_if("omitted").alias("omitted"))
    out = own.join(whole, ["doc_id", "slug"], "left")
    lost = parts.where("omitted").select("doc_id", "ord", "n", "slug", "title", "part_title", F.col("_section").alias("section"), "section_title", F.concat(F.lit("생략: "), F.col("note")).alias("reason"))
    return out, lost


def document(chapter: DataFrame, body: str, level: int, with_part: bool, name: str = rules.EXPORT_NAME) -> Column:
    """A chapter's Markdown document from its body: heading, metadata lines, text."""
    kept = (F.col("policy") == "include") & F.col("risky").isNotNull()
    lines = F.array_compact(F.array(
        F.concat(F.lit("#" * level + " "), text.clean_title(F.col("title"), True)), F.lit(""),
        F.when(F.lit(with_part), F.concat(F.lit("- 편: "), text.clean_title(F.col("part_title"), True))), F.concat(F.lit("- 범위: "), place(chapter)),
        F.when(F.col("omitted") > 0, F.concat(F.lit("- 생략: 위험 section "), F.col("omitted"), F.lit("개"))), F.when(kept, F.concat(F.lit("- 참고: "), F.lit(rules.KEPT_RISKY))),
        F.lit(""), F.coalesce(F.nullif(F.col(body), F.lit("")), F.lit(rules.NO_BODY.format(name=name))),
    ))
    return F.concat(F.rtrim(F.array_join(lines, "\n")), F.lit("\n"))


def words(c: Column) -> Column:
    return F.size(F.filter(F.split(c, r"(?U)\s+"), lambda x: x != "")).cast("long")


def numbered(n: Column, digits: int, slug: Column) -> Column:
    """A file's name by its number, padded but never cut, and its slug."""
    return F.concat(F.format_string(f"%0{digits}d", n.cast("long")), F.lit("__"), slug, F.lit(".md"))


def exported(chapters: DataFrame, queue: DataFrame, title: str = "Sources", longest: int = 80, name: str = rules.EXPORT_NAME) -> DataFrame:
    """(doc_id, path, content, words): chapter files, part files, the ledger of what is left out, and the index.

    Chapters are numbered in order among those that are kept, parts by their first chapter; parts that are never exported
    have no file. Repeated slugs are files of their own number.
    """
    own, lost = bodies(chapters, queue, name)
    kept = own.where("policy <> 'exclude'")
    n = F.row_number().over(W.partitionBy("doc_id").orderBy("ord"))
    kept = kept.withColumns({"file": numbered(n, 3, text.slug(F.col("slug"), longest)), "content": document(kept, "body", 1, True, name), "part_content": document(kept, "part_body", 2, False, name)})
    files = kept.select("doc_id", F.concat(F.lit("chapters/"), "file").alias("path"), "content")
    dash = F.lit("- 없음")
    listed = lambda items: F.when(F.size(items) > 0, F.array_join(items, "\n")).otherwise(dash)
    ordered = lambda at, value: F.transform(F.array_sort(F.collect_list(F.struct(*at, value.alias("v")))), lambda x: x["v"])
    parts = own.where(~F.col("part_title").isin(*rules.EXCLUDED_PARTS)).groupBy("doc_id", "part_title").agg(F.min("ord").alias("first"))
    inside = kept.groupBy("doc_id", "part_title").agg(ordered(["ord"], F.concat(F.lit("- "), text.clean_title(F.col("title"), True), F.lit(" ("), place(kept), F.lit(")"))).alias("listed"), ordered(["ord"], F.rtrim("part_content")).alias("texts"))
    left = own.where("policy = 'exclude'")
    gone = left.groupBy("doc_id", "part_title").agg(ordered(["ord"], F.concat(F.lit("- "), text.clean_title(F.col("title"), True), F.lit(": "), F.col("reason"))).alias("gone"))
    cut = lost.groupBy("doc_id", "part_title").agg(ordered(["ord", "n"], F.concat(F.lit("- "), text.clean_title(F.col("title"), True), F.lit(" > "), F.col("section_title"), F.lit(": "), F.col("reason"))).alias("cut"))
    none = F.array().cast("array<string>")
    parts = parts.join(inside, ["doc_id", "part_title"], "left").join(gone, ["doc_id", "part_title"], "left").join(cut, ["doc_id", "part_title"], "left")
    parts = parts.withColumns({c: F.coalesce(c, none) for c in ("listed", "texts", "gone", "cut")}).withColumn("n", F.row_number().over(W.partitionBy("doc_id").orderBy("first")))
    named = text.clean_title(F.col("part_title"), True)
    content = F.concat_ws("\n", F.concat(F.lit("# "), named), F.lit(""), F.lit("## 포함 장"), listed(F.col("listed")), F.lit(""), F.lit("## 제외/생략"), listed(F.concat("gone", "cut")), F.lit(""), F.lit("## 본문"), F.lit(""), F.when(F.size("texts") > 0, F.array_join("texts", "\n\n---\n\n")).otherwise(F.lit(rules.NO_CHAPTERS.format(name=name))))
    parts = parts.withColumns({"file": numbered(F.col("n"), 2, text.slug(F.col("part_title"), longest)), "content": F.concat(F.rtrim(content), F.lit("\n"))}).withColumn("words", words(F.col("content")))
    files = files.unionByName(parts.select("doc_id", F.concat(F.lit("parts/"), "file").alias("path"), "content"))
    where = F.concat(page_range(F.col("label_start"), F.col("label_end")), F.lit(" / PDF "), F.col("page_start"), F.lit("-"), F.col("page_end"))
    all_gone = left.groupBy("doc_id").agg(ordered(["ord"], F.concat(F.lit("- "), F.col("part_title"), F.lit(" / "), text.clean_title(F.col("title"), True), F.lit(" ("), where, F.lit("): "), F.col("reason"))).alias("gone"))
    all_cut = lost.groupBy("doc_id").agg(ordered(["ord", "n"], F.concat(F.lit("- "), F.col("part_title"), F.lit(" / "), text.clean_title(F.col("title"), True), F.lit(" > "), F.col("section_title"), F.lit(": "), F.col("reason"))).alias("cut"))
    docs = own.groupBy("doc_id").agg(F.count_if(F.col("policy") != "exclude").alias("kept")).join(all_gone, "doc_id", "left").join(all_cut, "doc_id", "left").withColumns({"gone": F.coalesce("gone", none), "cut": F.coalesce("cut", none)})
    ledger = F.concat_ws("\n", F.lit(f"# {title} {name} 제외/생략 내역"), F.lit(""), F.lit("## Chapter 제외"), listed(F.col("gone")), F.lit(""), F.lit("## Section 생략"), listed(F.col("cut")))
    files = files.unionByName(docs.select("doc_id", F.lit("excluded.md").alias("path"), F.concat(F.rtrim(ledger), F.lit("\n")).alias("content")))
    line = F.concat(F.lit("- "), "file", F.lit(": "), named, F.lit(" / 포함 장 "), F.size("listed"), F.lit("개 / 제외 장 "), F.size("gone"), F.lit("개 / 생략 section "), F.size("cut"), F.lit("개 / "), "words", F.lit(" words"))
    summary = parts.groupBy("doc_id").agg(ordered(["n"], line).alias("lines"), F.max("words").alias("most"))
    docs = docs.join(summary, "doc_id", "left").withColumns({"lines": F.coalesce("lines", none), "most": F.coalesce("most", F.lit(0))})
    count = lambda lead, c: F.concat(F.lit(f"- {lead}: "), c.cast("string"))
    index = F.concat_ws("\n", F.lit(f"# {title} {name} Source Index"), F.lit(""), count("업로드용 part 파일 수", F.size("lines")), count("검수용 chapter 파일 수", F.col("kept")), count("chapter 제외 수", F.size("gone")), count("section 생략 수", F.size("cut")), count("최대 part 단어 수", F.col("most")), F.lit(""), F.lit("## 업로드 순서"), F.array_join("lines", "\n"), F.lit(""), F.lit("## 참고"), F.lit("- 제외/생략 ledger: excluded.md"), F.lit(f"- `parts/`는 {name} 업로드용, `chapters/`는 검수/디버깅용입니다."))
    files = files.unionByName(docs.select("doc_id", F.lit("index.md").alias("path"), F.concat(index, F.lit("\n")).alias("content")))
    return files.withColumn("words", words(F.col("content")))
