"""Queries of the audit bundle: coverage, special sections, comparisons, and the ledger.

Books are made of documents: twenty a book, each a page. English ones are search entries of up to three pages, every tenth
is a chapter of three, and rated ones have a review and an audit.
"""

import re

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafloom.functions import rules, text
from leafloom.operators import bundle as B
from leafloom.operators import qa
from leafloom.operators import relational as R
from leafloom.plans.registry import query
from leafloom.sources.tables import table

_NORMAL = "trim(regexp_replace({}, '\\s+', ' ', 'g'))"
_BOOK = f"""d AS (SELECT doc_id, doc_id // 20 AS b, doc_id % 20 + 1 AS page, text, lang, source, CASE WHEN doc_id % 4 <> 0 THEN 'p' || doc_id END AS label, CASE WHEN lang = 'en' THEN 'body' ELSE 'frontmatter' END AS kind, {_NORMAL.format('text')} <> '' AS has_text FROM documents),
l AS (SELECT doc_id, min(quality) AS quality FROM labels GROUP BY 1), r AS (SELECT d.doc_id, b, page, CASE WHEN contains(text, ' | ') THEN 'toc' ELSE 'prose' END AS layout, CASE WHEN quality = 1 THEN 'c' || source END AS chapter, CASE WHEN quality = 1 THEN 's' || doc_id % 3 END AS section, doc_id % 5 = 0 AS merged, text, CASE WHEN doc_id % 3 = 0 THEN 'high' ELSE 'low' END AS tier, CASE WHEN doc_id % 4 = 0 THEN 'multi-section-page' END AS flag FROM d JOIN l USING (doc_id)),
e AS (SELECT doc_id, b, page AS a, page + doc_id % 3 AS z, 'c' || source AS chapter, 's' || doc_id % 3 AS section, CASE doc_id % 7 WHEN 1 THEN 'part-intro' WHEN 2 THEN 'search-alias' ELSE 'item' END AS entry_type, CASE WHEN doc_id % 9 = 0 THEN '개정 연혁' ELSE 'S' || doc_id END AS section_title, CASE WHEN source = 'src3' THEN '부 록' ELSE source END AS part, CASE WHEN doc_id % 30 = 3 THEN 'An fta  Note. ' ELSE '' END || text AS text FROM d WHERE lang = 'en'),
c AS (SELECT doc_id, b, page AS a, page + 2 AS z, 'c' || source AS chapter, CASE WHEN doc_id % 30 = 4 THEN '개정내용 ' ELSE 'Chapter ' END || doc_id AS title, CASE WHEN source = 'src3' THEN '부 록' ELSE source END AS part, CASE WHEN doc_id % 40 = 14 THEN '부칙 그리고 별첨' ELSE 'summary' END AS summary, '<h2>x</h2>' || CASE WHEN doc_id % 20 = 4 THEN '<section id="part-intro">' ELSE '' END || '<section id="s1">' AS html FROM d WHERE doc_id % 10 = 4),
v AS (SELECT d.*, (SELECT count(*) FROM c WHERE c.b = d.b AND d.page BETWEEN a AND z) AS n_chapters, (SELECT count(*) FROM e WHERE e.b = d.b AND d.page BETWEEN a AND z) AS n_entries, r.layout, r.chapter, r.section, r.tier FROM d LEFT JOIN r USING (doc_id)),
m AS (SELECT *, CASE WHEN n_chapters > 0 THEN 'reader-body' WHEN n_entries > 0 THEN 'search-only' WHEN layout = 'toc' THEN 'toc-transform' END AS mode FROM v)"""


def _book(spark, sf_dir):
    """(pages, reviews, audits, entries, chapters) of all books."""
    d = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source").withColumnRenamed("doc_id", "id")
    d = d.withColumns({"doc_id": F.floor(F.col("id") / 20), "page": F.pmod("id", F.lit(20)) + 1, "chapter": F.concat(F.lit("c"), "source"), "section": F.concat(F.lit("s"), F.col("id") % 3), "part_title": F.when(F.col("source") == "src3", rules.APPENDIX_PART).otherwise(F.col("source"))})
    every = lambda n, r: F.col("id") % n == r
    pages = d.select("doc_id", "page", F.when(~every(4, 0), F.concat(F.lit("p"), "id")).alias("page_label"), F.when(F.col("lang") == "en", "body").otherwise("frontmatter").alias("page_kind"), (text.normalize(F.col("text")) != "").alias("has_text"))
    rated = d.join(table(spark, sf_dir, "labels", "doc_id", "quality").groupBy(F.col("doc_id").alias("id")).agg(F.min("quality").alias("quality")), "id")
    own = lambda c: F.when(F.col("quality") == 1, F.col(c)).alias(c)
    reviews = rated.select("doc_id", "page", F.when(F.contains("text", F.lit(" | ")), "toc").otherwise("prose").alias("layout"), own("chapter"), own("section"), every(5, 0).alias("merge_first"), F.split("text", "\n").alias("paragraphs"))
    audits = rated.select("doc_id", "page", F.when(every(3, 0), "high").otherwise("low").alias("tier"), F.array_compact(F.array(F.when(every(4, 0), "multi-section-page"))).alias("flags"))
    kind = F.when(every(7, 1), "part-intro").when(every(7, 2), "search-alias").otherwise("item")
    entries = d.where("lang = 'en'").select("doc_id", F.col("id").cast("string").alias("id"), "chapter", "section", F.when(every(9, 0), rules.REVISION_TITLE).otherwise(F.concat(F.lit("S"), "id")).alias("section_title"), F.lit("chapter").alias("chapter_title"), "part_title", F.concat(F.when(every(30, 3), "An fta  Note. ").otherwise(""), "text").alias("text"), F.lit("").alias("excerpt"), kind.alias("entry_type"), F.col("page").alias("page_start"), (F.col("page") + F.col("id") % 3).alias("page_end"))
    page = F.concat(F.lit("<h2>x</h2>"), F.when(every(20, 4), '<section id="part-intro">').otherwise(""), F.lit('<section id="s1">'))
    chapters = d.where(every(10, 4)).select("doc_id", "chapter", F.concat(F.when(every(30, 4), "개정내용 ").otherwise("Chapter "), "id").alias("title"), "part_title", F.when(every(40, 14), "부칙 그리고 별첨").otherwise("summary").alias("summary"), page.alias("html"), F.col("page").alias("page_start"), (F.col("page") + 2).alias("page_end"))
    return pages, reviews, audits, entries, chapters


def _covered(spark, sf_dir):
    return B.coverage(*_book(spark, sf_dir))


@query(f"WITH {_BOOK} SELECT b AS doc_id, page, mode, n_chapters, n_entries, chapter AS review_chapter, tier FROM m")
def b01_coverage_ledger(spark, sf_dir):
    return _covered(spark, sf_dir).select("doc_id", "page", "mode", "n_chapters", "n_entries", "review_chapter", "tier")


_LIST = "'[' || coalesce(string_agg(page, ', ' ORDER BY page) FILTER (WHERE {}), '') || ']'"
_SUMMARY = f"""s AS (SELECT b, count(*) AS pages, count(*) FILTER (WHERE mode = 'reader-body') AS reader_body, count(*) FILTER (WHERE mode = 'search-only') AS search_only, count(*) FILTER (WHERE mode = 'toc-transform') AS toc_transform, {_LIST.format("has_text AND mode IS NULL")} AS hidden, {_LIST.format("kind = 'body' AND mode IS NULL")} AS uncovered,
 '[' || coalesce(min(page) FILTER (WHERE mode = 'toc-transform') || ', ' || max(page) FILTER (WHERE mode = 'toc-transform'), '') || ']' AS span FROM m GROUP BY 1)"""


@query(f"WITH {_BOOK}, {_SUMMARY} SELECT b AS doc_id, pages, reader_body, search_only, toc_transform, hidden, uncovered, span FROM s")
def a08_coverage_summary(spark, sf_dir):
    c = B.coverage_summary(_covered(spark, sf_dir))
    return c.select("doc_id", "pages", "reader_body", "search_only", "toc_transform", B.listed(F.col("hidden_text_pages")).alias("hidden"), B.listed(F.col("uncovered_body_pages")).alias("uncovered"), B.listed(F.col("toc_span")).alias("span"))


_SPECIAL = """p AS (SELECT b, 'search-index' AS via, chapter, section, a, z, unnest(list_filter([CASE WHEN entry_type = 'part-intro' THEN {'g': 'part_intro', 't': section_title} END, CASE WHEN section_title = '개정 연혁' THEN {'g': 'revision_history', 't': section_title} END, CASE WHEN part = '부 록' THEN {'g': 'appendix', 't': '부록'} END, CASE WHEN contains(lower(text), 'fta') THEN {'g': 'fta_gi', 't': 'FTA'} END], lambda x: x IS NOT NULL)) AS r FROM e
UNION ALL SELECT b, 'document-data', chapter, NULL, a, z, unnest(list_filter([CASE WHEN contains(html, 'part-intro') THEN {'g': 'part_intro', 't': part} END, CASE WHEN contains(title, '개정내용') THEN {'g': 'revision_history', 't': title} END, CASE WHEN part = '부 록' THEN {'g': 'appendix', 't': '부록'} END, CASE WHEN contains(summary, '부칙') THEN {'g': 'appendix', 't': '부칙'} END, CASE WHEN contains(summary, '별첨') THEN {'g': 'appendix', 't': '별첨'} END], lambda x: x IS NOT NULL)) FROM c),
g AS (SELECT DISTINCT b, r.g AS "group", via, chapter, section, a, z, r.t AS term FROM p)"""


@query(f"WITH {_BOOK}, {_SPECIAL} SELECT b AS doc_id, \"group\", via, chapter, section, a AS page_start, z AS page_end, term FROM g")
def b02_special_sections(spark, sf_dir):
    _, _, _, entries, chapters = _book(spark, sf_dir)
    return B.special_sections(entries, chapters)


@query(f"""WITH {_BOOK}, {_SPECIAL}, f AS (SELECT unnest(['머리말', '일러두기', '부 록', '부칙', '별첨', '개정 연혁', '지리적 표시', 'FTA', '재검토기한']) AS q), a AS (SELECT DISTINCT b, q AS query FROM g, f UNION SELECT b, term FROM g WHERE "group" IN ('part_intro', 'revision_history', 'appendix')) SELECT b AS doc_id, query FROM a""")
def q05_query_set(spark, sf_dir):
    return B.query_set(b02_special_sections(spark, sf_dir)).select("doc_id", "query")


_LINES = "array_to_string(list_filter(list_transform(string_split({}, chr(10)), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: x <> ''), ' ')"
_TEXTS = f"""t AS (SELECT r.*, {_LINES.format('r.text')} AS page_text, (SELECT string_agg(nullif({_NORMAL.format('e.text')}, ''), ' ' ORDER BY a, z, chapter, section, e.text) FROM e WHERE e.b = r.b AND r.page BETWEEN a AND z AND entry_type <> 'search-alias') AS other_text,
 (SELECT count(*) FROM e WHERE e.b = r.b AND r.page BETWEEN a AND z AND entry_type <> 'search-alias') AS n, (SELECT min_by({{'c': e.chapter, 's': e.section}}, (a, z, e.chapter, e.section, e.text)) FROM e WHERE e.b = r.b AND r.page BETWEEN a AND z AND entry_type <> 'search-alias') AS first FROM r)"""


@query(f"WITH {_BOOK}, {_TEXTS} SELECT b AS doc_id, page, page_text, coalesce(other_text, '') AS candidate_text, n AS candidates FROM t")
def b03_b04_page_texts(spark, sf_dir):
    _, reviews, _, entries, _ = _book(spark, sf_dir)
    return B.page_texts(reviews).join(B.candidates(reviews, entries), ["doc_id", "page"]).select("doc_id", "page", "page_text", "candidate_text", F.size("candidates").cast("long").alias("candidates"))


_WHERE = f"""{_TEXTS}, w AS (SELECT *, coalesce(chapter, CASE WHEN n > 0 THEN first.c END) AS lc, CASE WHEN chapter IS NOT NULL THEN section WHEN n > 0 THEN first.s END AS ls, CASE WHEN chapter IS NOT NULL THEN 'page-review' WHEN n > 0 THEN 'search-index-candidate' ELSE 'none' END AS src FROM t), h AS (SELECT b, chapter, max(html) AS html FROM c GROUP BY 1, 2), x AS (SELECT w.*, h.html IS NOT NULL AS found, coalesce(contains(h.html, 'id="' || ls || '"'), false) AS marked FROM w LEFT JOIN h ON h.b = w.b AND h.chapter = w.lc)"""


def _compared(spark, sf_dir):
    pages, reviews, audits, entries, chapters = _book(spark, sf_dir)
    one = chapters.groupBy("doc_id", "chapter").agg(F.max("html").alias("html"))
    return B.compared(B.coverage(pages, reviews, audits, entries, chapters), reviews, entries, one)


@query(f"WITH {_BOOK}, {_WHERE} SELECT b AS doc_id, page, lc AS chapter, ls AS section, src AS source, '#/chapter/' || lc || '/' || ls AS route, found AS chapter_found, marked AS section_found FROM x")
def b05_locators(spark, sf_dir):
    return _compared(spark, sf_dir).select("doc_id", "page", "locator.chapter", "locator.section", "locator.source", "locator.route", "chapter_found", "section_found")


_STATUS = "CASE WHEN page_text = '' OR coalesce(other_text, '') = '' OR n = 0 OR NOT found THEN 'unsupported' WHEN n >= 2 OR NOT marked OR flag IS NOT NULL OR merged THEN 'ambiguous' ELSE 'candidate-backed' END"


@query(f"""WITH {_BOOK}, {_WHERE} SELECT b AS doc_id, page, {_STATUS} AS status, 3 + CASE WHEN n <> 1 THEN 1 ELSE 0 END + CASE WHEN found AND marked THEN 0 ELSE 1 END + CASE WHEN flag IS NULL THEN 0 ELSE 1 END + CASE WHEN merged THEN 1 ELSE 0 END AS notes FROM x""")
def b07_b08_statuses(spark, sf_dir):
    return _compared(spark, sf_dir).select("doc_id", "page", "status", F.size("limitations").cast("long").alias("notes"))


def _ledger_sql():
    """The ledger's text with the books' columns in its places."""
    given = {"bundle": "b", "baseline": "''", "pages": "pages", "reader_body": "reader_body", "toc_transform": "toc_transform", "search_only": "search_only", "hidden_text_pages": "hidden", "uncovered_body_pages": "uncovered", "toc_span": "span", "entries": "entries", "compared": "compared", "backed": "backed", "ambiguous": "ambiguous", "unsupported": "unsupported"}
    given["special_sections"] = " || chr(10) || ".join(f"'- `{g}`: `' || coalesce(\"{g}\", 0) || '` record(s)'" for g in rules.SPECIAL_GROUPS)
    given["files"] = " || chr(10) || ".join(f"'- `{x}`'" for x in rules.ARTIFACTS)
    parts = re.split(r"\{(\w+)\}", rules.LEDGER)
    return " || ".join("'" + x.replace("'", "''") + "'" if n % 2 == 0 else f"({given.get(x, chr(39) + 'None' + chr(39))})" for n, x in enumerate(parts))


_COUNTS = ", ".join(f"count(*) FILTER (WHERE \"group\" = '{g}') AS \"{g}\"" for g in rules.SPECIAL_GROUPS)


@query(f"""WITH {_BOOK}, {_SUMMARY}, {_SPECIAL}, {_WHERE}, k AS (SELECT b, {_COUNTS} FROM g GROUP BY 1), n AS (SELECT b, count(*) AS entries FROM e GROUP BY 1), y AS (SELECT b, {_STATUS} AS status FROM x), z AS (SELECT b, count(*) AS compared, count(*) FILTER (WHERE status = 'candidate-backed') AS backed, count(*) FILTER (WHERE status = 'ambiguous') AS ambiguous, count(*) FILTER (WHERE status = 'unsupported') AS unsupported FROM y GROUP BY 1),
u AS (SELECT s.*, k.* EXCLUDE (b), coalesce(entries, 0) AS entries, coalesce(compared, 0) AS compared, coalesce(backed, 0) AS backed, coalesce(ambiguous, 0) AS ambiguous, coalesce(unsupported, 0) AS unsupported FROM s LEFT JOIN k USING (b) LEFT JOIN n USING (b) LEFT JOIN z USING (b)) SELECT b AS doc_id, {_ledger_sql()} AS ledger FROM u""")
def b11_ledgers(spark, sf_dir):
    """The ledger of every book's bundle; figures that are not compared here read None."""
    pages, reviews, audits, entries, chapters = _book(spark, sf_dir)
    summary = B.coverage_summary(B.coverage(pages, reviews, audits, entries, chapters))
    groups = B.special_sections(entries, chapters).groupBy("doc_id").agg(*(F.count_if(F.col("group") == g).alias(g) for g in rules.SPECIAL_GROUPS))
    status = lambda name: F.count_if(F.col("status") == name).alias(name.removeprefix("candidate-"))
    compared = _compared(spark, sf_dir).groupBy("doc_id").agg(F.count("*").alias("compared"), status("candidate-backed"), status("ambiguous"), status("unsupported"))
    own = summary.join(groups, "doc_id", "left").join(entries.groupBy("doc_id").agg(F.count("*").alias("entries")), "doc_id", "left").join(compared, "doc_id", "left").fillna(0)
    named = {c: F.col(c) for c in ("pages", "reader_body", "toc_transform", "search_only", "entries", "compared", "backed", "ambiguous", "unsupported")}
    lists = {c: B.listed(F.col(c)) for c in ("hidden_text_pages", "uncovered_body_pages", "toc_span")}
    none = dict.fromkeys(("queries", "matched", "empty", "residue", "sampled", "loss", "changed", "unchanged", "missing"), F.lit(None))
    return own.select("doc_id", B.report({"bundle": F.col("doc_id"), **named, **lists, **none, "special_sections": B.special_report({g: F.col(g) for g in rules.SPECIAL_GROUPS})}).alias("ledger"))


@query("""SELECT page_id, contains(html, 'class="ad"') AS has_ad, contains(html, 'id="overview"') AS has_marker, len(regexp_extract_all(html, '<section')) AS sections FROM pages""")
def b06_section_markers(spark, sf_dir):
    p = table(spark, sf_dir, "pages", "page_id", "html")
    return p.select("page_id", F.contains("html", F.lit('class="ad"')).alias("has_ad"), F.contains("html", F.lit('id="overview"')).alias("has_marker"), F.regexp_count("html", F.lit("<section")).cast("long").alias("sections"))


_FID = """WITH t AS (SELECT conv_id, turn, regexp_extract_all(text, '[0-9A-Za-z().~-]+') AS toks FROM conversations), p AS (SELECT a.conv_id, a.turn, a.toks AS src, b.toks AS cmp FROM t a LEFT JOIN t b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1),
s AS (SELECT conv_id, turn, len(src) AS source_tokens, len(cmp) AS candidate_tokens, len(list_filter(list_distinct(src), lambda x: NOT list_contains(coalesce(cmp, []), x))) AS missing FROM p)"""


@query(_FID + """SELECT conv_id, turn, source_tokens, coalesce(candidate_tokens, 0) AS candidate_tokens, missing, CASE WHEN candidate_tokens IS NULL OR candidate_tokens = 0 THEN 'unsupported' WHEN missing > source_tokens / 2 THEN 'ambiguous' ELSE 'candidate-backed' END AS status,
 array_to_string(list_filter(['tokens-only', CASE WHEN candidate_tokens IS NULL THEN 'no-candidate' END, CASE WHEN missing > 0 THEN 'missing-tokens' END], lambda x: x IS NOT NULL), ',') AS limitations FROM s""")
def b07_b08_b10_fidelity(spark, sf_dir):
    t = table(spark, sf_dir, "conversations", "conv_id", "turn", "text").withColumn("toks", text.tokens(F.col("text"), "[0-9A-Za-z().~-]+"))
    t = t.withColumns({"_next": F.lead("toks").over(W.partitionBy("conv_id").orderBy("turn")), "_turn": F.lead("turn").over(W.partitionBy("conv_id").orderBy("turn"))})
    other = F.when(F.col("_turn") == F.col("turn") + 1, F.col("_next"))
    missing = F.size(F.array_except("toks", F.coalesce(other, F.array().cast("array<string>")))).cast("long")
    n = F.size(F.coalesce(other, F.array().cast("array<string>"))).cast("long")
    out = t.select("conv_id", "turn", F.size("toks").cast("long").alias("source_tokens"), n.alias("candidate_tokens"), missing.alias("missing"), other.isNull().alias("_none"))
    status = F.when(F.col("candidate_tokens") == 0, "unsupported").when(F.col("missing") > F.col("source_tokens") / 2, "ambiguous").otherwise("candidate-backed")
    notes = qa.flag_array(("tokens-only", F.lit(True)), ("no-candidate", F.col("_none")), ("missing-tokens", F.col("missing") > 0))
    return out.withColumns({"status": status, "limitations": F.array_join(notes, ",")}).drop("_none")
