"""Queries of search, flags, risk, queue and batches."""

from pyspark.sql import functions as F

from leafloom.functions import rules, text
from leafloom.operators import bundle as B
from leafloom.operators import ordered as O
from leafloom.operators import qa
from leafloom.operators import relational as R
from leafloom.operators import search as S
from leafloom.plans.registry import query
from leafloom.sources.tables import table

_PART = "SELECT p_partkey, p_size, lower(replace(p_name, ' ', '')) AS name, lower(replace(p_type, ' ', '')) AS typ, lower(replace(p_brand, ' ', '')) AS brand FROM part"
_ADD = "CASE WHEN name = q THEN 120 WHEN starts_with(name, q) THEN 90 WHEN contains(name, q) THEN 60 ELSE 0 END + CASE WHEN typ = q THEN 72 WHEN starts_with(typ, q) THEN 48 WHEN contains(typ, q) THEN 30 ELSE 0 END"


def _warm(spark, sf_dir):
    return S.warmed(table(spark, sf_dir, "part", "p_partkey", "p_size", "p_name", "p_type", "p_brand"), ["p_name", "p_type", "p_brand"])


def _queries(spark):
    return spark.createDataFrame([("red",), ("small",), ("economy",), ("brand#1",), ("zzz",)], "query string")


@query(f"SELECT p_partkey, name AS n_p_name, name || typ || brand AS haystack FROM ({_PART})")
def q01_warm_index(spark, sf_dir):
    return _warm(spark, sf_dir).select("p_partkey", "n_p_name", "haystack")


@query(f"""WITH q AS (SELECT unnest(['red', 'small', 'economy', 'brand#1', 'zzz']) AS q), s AS (SELECT q AS query, p_partkey, {_ADD} AS score, p_size FROM ({_PART}), q),
r AS (SELECT query, p_partkey, score, row_number() OVER (PARTITION BY query ORDER BY score DESC, p_size, p_partkey) AS rank FROM s WHERE score > 0) SELECT * FROM r WHERE rank <= 10""")
def q02_t02_additive_search(spark, sf_dir):
    q = text.for_matching(F.col("query"))
    score = S.additive(q, {"p_name": S.FIELD_SCORES["section"], "p_type": S.FIELD_SCORES["part"]})
    return S.batch(_warm(spark, sf_dir), _queries(spark), score, [F.desc("score"), F.col("p_size"), F.col("p_partkey")], 10).select("query", "p_partkey", "score", "rank")


# the audit's ranker keeps single spaces
_AUDIT = "SELECT p_partkey, p_size, lower(p_name) AS name, lower(p_type) AS typ, lower(p_brand) AS brand FROM part"
_TIER = """CASE WHEN NOT contains(name || ' ' || typ || ' ' || brand, q) THEN 0 WHEN name = q OR brand = q THEN 400 WHEN typ = q THEN 350 WHEN starts_with(name, q) OR starts_with(brand, q) THEN 300
 WHEN starts_with(typ, q) THEN 250 WHEN contains(name, q) OR contains(brand, q) THEN 220 ELSE 100 END"""
_ASKED = ("red", "Small  Widget", "economy", "brand#1", "widget economy", "ASIA", "nation_1", "zzz")
_ASKED_SQL = "SELECT query, lower(replace(query, '  ', ' ')) AS q FROM (SELECT unnest([" + ", ".join(f"'{x}'" for x in _ASKED) + "]) AS query)"


def _asked(spark):
    return spark.createDataFrame([(x,) for x in _ASKED], "query string")


def _tiered(spark, sf_dir):
    entries = S.audited(table(spark, sf_dir, "part", "p_partkey", "p_size", "p_name", "p_type", "p_brand"), ["p_name", "p_type", "p_brand"])
    score = S.tiered(B.query_form(F.col("query")), ["n_p_name", "n_p_brand"], "n_p_type", "haystack")
    return S.batch(entries, _asked(spark), score, [F.desc("score"), F.col("p_size"), F.col("p_partkey")], 5)


_RANKED = f"""q AS ({_ASKED_SQL}), s AS (SELECT query, p_partkey, {_TIER} AS score, p_size FROM ({_AUDIT}), q), r AS (SELECT query, p_partkey, score, row_number() OVER (PARTITION BY query ORDER BY score DESC, p_size, p_partkey) AS rank FROM s WHERE score > 0)"""


@query(f"WITH {_RANKED} SELECT query, p_partkey, score, rank FROM r WHERE rank <= 5")
def q03_q05_tiered_search(spark, sf_dir):
    return _tiered(spark, sf_dir).select("query", "p_partkey", "score", "rank")


@query(f"""WITH {_RANKED}, t AS (SELECT query, count(*) AS n, min_by(p_partkey, rank) AS top FROM r WHERE rank <= 5 GROUP BY 1)
SELECT q.query, coalesce(n, 0) AS matches, CASE WHEN n > 0 THEN 'match' ELSE 'empty' END AS result, '#/chapter/' || top AS route FROM q LEFT JOIN t USING (query)""")
def q05_search_checks(spark, sf_dir):
    return S.checks(_asked(spark), _tiered(spark, sf_dir).withColumn("route", text.route(F.col("p_partkey").cast("string")))).select("query", "matches", "result", "route")


@query(f"""WITH {_RANKED}, t AS (SELECT query, least(count(*), 5) AS n FROM r GROUP BY 1) SELECT (SELECT count(*) FROM q) AS queries, (SELECT count(*) FROM t) AS matched, (SELECT count(*) FROM q) - (SELECT count(*) FROM t) AS empty""")
def a24_search_summary(spark, sf_dir):
    return S.run_totals(S.checks(_asked(spark), _tiered(spark, sf_dir).withColumn("route", F.lit(None).cast("string"))))


@query(f"""WITH {_RANKED}, a AS (SELECT query, coalesce(max(p_partkey) FILTER (WHERE rank = 2), max(p_partkey) FILTER (WHERE rank = 1)) AS top FROM r GROUP BY 1),
n AS (SELECT n_nationkey, lower(replace(n_name, ' ', '')) AS t, lower(replace(r_name, ' ', '')) AS p FROM nation JOIN region ON r_regionkey = n_regionkey), m AS (SELECT query, replace(q, ' ', '') AS q FROM q),
c AS (SELECT query, n_nationkey, CASE WHEN t = q THEN 120 WHEN starts_with(t, q) THEN 90 WHEN contains(t, q) THEN 60 ELSE 0 END + CASE WHEN p = q THEN 80 WHEN starts_with(p, q) THEN 56 WHEN contains(p, q) THEN 32 ELSE 0 END AS score FROM m, n),
b AS (SELECT query, min_by(n_nationkey, (-score, n_nationkey)) AS best FROM c WHERE score > 0 GROUP BY 1)
SELECT q.query, coalesce('#/chapter/' || top, '#/chapter/n' || best) AS route FROM q LEFT JOIN a USING (query) LEFT JOIN b USING (query)""")
def q04_navigation(spark, sf_dir):
    """The second result's route, else the first's, else the best nation's by its own and its region's name."""
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    chapters = n.select(F.col("n_nationkey").cast("string").alias("chapter"), F.col("n_name").alias("title"), F.col("r_name").alias("part_title"), F.col("n_nationkey").alias("page_start"), F.concat(F.lit("#/chapter/n"), "n_nationkey").alias("first_route"))
    results = _tiered(spark, sf_dir).select("query", "rank", text.route(F.col("p_partkey").cast("string")).alias("route"))
    return S.navigation(_asked(spark), results, chapters, 1)


@query("SELECT doc_id FROM documents WHERE contains(lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))), 'license')")
def p12_query_predicate(spark, sf_dir):
    d = table(spark, sf_dir, "documents", "doc_id", "text")
    return d.where(F.contains(F.lower(text.normalize(F.col("text"))), F.lower(text.normalize(F.lit(" License "))))).select("doc_id")


@query("""SELECT d.doc_id, CASE WHEN l.n > 0 THEN 'reader-body' WHEN d.lang = 'en' THEN 'search-only' WHEN contains(d.text, ' | ') THEN 'toc-transform' END AS mode FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n FROM labels GROUP BY 1) l USING (doc_id)""")
def p13_exposure(spark, sf_dir):
    n = table(spark, sf_dir, "labels", "doc_id").groupBy("doc_id").agg(F.count("*").alias("n"))
    mode = B.exposure(F.col("n"), (F.col("lang") == "en").cast("int"), F.when(F.contains("text", F.lit(" | ")), "toc"))
    return table(spark, sf_dir, "documents", "doc_id", "lang", "text").join(n, "doc_id", "left").select("doc_id", mode.alias("mode"))


_F = """WITH d AS (SELECT *, string_split(text, chr(10)) AS ls FROM documents), f AS (SELECT doc_id, source, lang, list_filter([CASE WHEN n_chars >= 5000 THEN 'oversize' END, CASE WHEN regexp_matches(text, '[0-9]{3,}') THEN 'digit-run' END,
 CASE WHEN NOT regexp_matches(text, '[.]\\s*$') THEN 'unterminated' END, CASE WHEN len(ls) >= 20 THEN 'many-lines' END], lambda x: x IS NOT NULL) AS flags, CASE WHEN contains(text, ' | ') THEN 'table/form' WHEN len(ls) < 3 THEN 'list' ELSE 'prose' END AS layout,
 CASE WHEN n_chars < 100 THEN 'low' WHEN lang = 'en' THEN 'high' ELSE 'medium' END AS confidence FROM d),
s AS (SELECT *, CAST(list_sum(list_transform(flags, lambda x: CASE x WHEN 'oversize' THEN 80 WHEN 'digit-run' THEN 67 WHEN 'unterminated' THEN 70 WHEN 'many-lines' THEN 50 ELSE 10 END)) AS INTEGER) + CASE WHEN lang <> 'en' THEN 12 ELSE 0 END AS score,
 CASE WHEN list_has_any(flags, ['oversize', 'unterminated']) THEN 'accuracy-critical' ELSE 'readability-critical' END AS lane FROM f WHERE len(flags) > 0)"""
WEIGHTS = {"oversize": 80, "digit-run": 67, "unterminated": 70, "many-lines": 50}


def _flagged(spark, sf_dir):
    d = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source", "n_chars").withColumn("n_lines", F.size(F.split("text", "\n")))
    flags = qa.flag_array(("oversize", F.col("n_chars") >= 5000), ("digit-run", F.col("text").rlike("[0-9]{3,}")), ("unterminated", ~F.col("text").rlike(r"[.]\s*$")), ("many-lines", F.col("n_lines") >= 20))
    layout = F.when(F.contains("text", F.lit(" | ")), "table/form").when(F.col("n_lines") < 3, "list").otherwise("prose")
    confidence = F.when(F.col("n_chars") < 100, "low").when(F.col("lang") == "en", "high").otherwise("medium")
    return d.select("doc_id", "lang", "source", flags.alias("flags"), layout.alias("layout"), confidence.alias("confidence"))


def _scored(spark, sf_dir):
    score = qa.weights(F.col("flags"), WEIGHTS) + F.when(F.col("lang") != "en", 12).otherwise(0)
    return _flagged(spark, sf_dir).where(F.size("flags") > 0).withColumns({"score": score, "lane": qa.lane(F.col("flags"), ("oversize", "unterminated"))})


@query(_F + """SELECT doc_id, array_to_string(flags, ',') AS flags, layout, confidence FROM f""")
def f01_flags(spark, sf_dir):
    return _flagged(spark, sf_dir).select("doc_id", F.array_join("flags", ",").alias("flags"), "layout", "confidence")


@query(_F + """SELECT doc_id, CASE WHEN layout = 'table/form' OR list_contains(flags, 'oversize') AND confidence = 'low' THEN 'high' WHEN layout = 'decorative/structural' OR layout = 'list' OR confidence = 'high' THEN 'low' ELSE 'medium' END AS tier FROM f""")
def f02_risk_tiers(spark, sf_dir):
    return _flagged(spark, sf_dir).select("doc_id", qa.risk_tier(F.col("flags"), F.col("layout"), F.col("confidence")).alias("tier"))


@query(_F + """SELECT doc_id, score, lane FROM s""")
def f04_scores_lanes(spark, sf_dir):
    return _scored(spark, sf_dir).select("doc_id", "score", "lane")


# page reviews: a document is a page; which paragraphs and marks it has follows from its number
_FLAGS = ("multi-section-page", "low-confidence", "has-override", "page-merge", "boxed-heading", "angle-heading", "korean-linebreak-residue", "missing-table-crop", "synthetic-table-remains", "structural-fragment-paragraph")
_CASE = """WITH d AS (SELECT doc_id, doc_id % 4 AS o, n_chars < 400 AS low, doc_id % 9 = 0 AS override, doc_id % 5 = 0 AS merged, doc_id % 6 AS k, contains(text, ' | ') AS tab, doc_id % 7 AS h FROM documents),
f AS (SELECT *, list_filter([CASE WHEN o >= 2 THEN 'multi-section-page' END, CASE WHEN low THEN 'low-confidence' END, CASE WHEN override THEN 'has-override' END, CASE WHEN merged THEN 'page-merge' END, CASE WHEN k = 1 THEN 'boxed-heading' END, CASE WHEN k = 2 THEN 'angle-heading' END,
 CASE WHEN k = 4 THEN 'korean-linebreak-residue' END, CASE WHEN tab AND h NOT IN (1, 2) THEN 'missing-table-crop' END, CASE WHEN h = 2 THEN 'synthetic-table-remains' END, CASE WHEN k = 5 THEN 'structural-fragment-paragraph' END], lambda x: x IS NOT NULL) AS flags FROM d)"""


def _reviewed(spark, sf_dir):
    d = table(spark, sf_dir, "documents", "doc_id", "text", "n_chars")
    k, h = F.col("doc_id") % 6, F.col("doc_id") % 7
    said = F.when(k == 1, F.array(F.lit("【기재례】"))).when(k == 2, F.array(F.lit("< 직무와 권한 >"))).when(k == 3, F.array(F.lit("[a | b]"))).when(k == 4, F.array(F.lit("심판청구 인은 이를"))).when(k == 5, F.array(F.lit("편"), F.lit("x"))).otherwise(F.array(F.lit("plain text")))
    page = F.when(h == 1, '<img src="images/table-crops/1.png">').when(h == 2, '<img src="images/table-crops/1.png"><table class="reader-synthetic-table">').otherwise("<p>x</p>")
    residue = F.exists("said", lambda p: text.linebreak_residue(p))
    d = d.select("doc_id", (F.col("doc_id") % 4).alias("overlap"), F.when(F.col("n_chars") < 400, "low").otherwise("high").alias("confidence"), (F.col("doc_id") % 9 == 0).alias("override"), (F.col("doc_id") % 5 == 0).alias("merged"), said.alias("said"), F.when(F.contains("text", F.lit(" | ")), "table/form").otherwise("prose").alias("layout"), page.alias("html"))
    return d.withColumn("flags", qa.page_flags(F.col("overlap"), F.col("confidence"), F.col("override"), F.col("merged"), F.col("said"), F.col("layout"), F.col("html"), residue))


@query(_CASE + "SELECT doc_id, array_to_string(flags, ',') AS flags FROM f")
def f01_page_flags(spark, sf_dir):
    return _reviewed(spark, sf_dir).select("doc_id", F.array_join("flags", ",").alias("flags"))


@query(_CASE + f"""SELECT doc_id, CAST(coalesce(list_sum(list_transform(flags, lambda x: CASE x {' '.join(f"WHEN '{k}' THEN {v}" for k, v in rules.FLAG_WEIGHTS.items())} ELSE 10 END)), 0) AS BIGINT) + CASE WHEN tab THEN 12 ELSE 0 END + CASE WHEN low THEN 8 ELSE 0 END + CASE WHEN o >= 2 AND flags <> ['multi-section-page'] THEN o * 4 ELSE 0 END AS score FROM f""")
def f03_priorities(spark, sf_dir):
    r = _reviewed(spark, sf_dir)
    return r.select("doc_id", qa.priority(F.col("flags"), F.col("layout"), F.col("confidence"), F.col("overlap")).cast("long").alias("score"))


@query(_F + """SELECT doc_id, lane, '/qa/' || doc_id AS qa_path, '/chapter/' || source AS chapter_path, array_to_string(list_transform(list_sort(list_transform(flags, lambda x: {'w': -CASE x WHEN 'oversize' THEN 80 WHEN 'digit-run' THEN 67 WHEN 'unterminated' THEN 70 ELSE 50 END, 'f': x})), lambda x: x.f), ', ') AS flag_summary FROM s""")
def f05_t08_queue_entries(spark, sf_dir):
    s = _scored(spark, sf_dir)
    return s.select("doc_id", "lane", F.concat(F.lit("/qa/"), "doc_id").alias("qa_path"), F.concat(F.lit("/chapter/"), "source").alias("chapter_path"), qa.ordered_flags(F.col("flags"), WEIGHTS).alias("flag_summary"))


@query(_F + """, r AS (SELECT doc_id, array_to_string(flags, ',') AS flags, score, lane, row_number() OVER (ORDER BY score DESC, lane, doc_id) AS rank FROM s) SELECT doc_id, flags, score, lane, rank, chr(CAST(65 + (rank - 1) // 10 AS INTEGER)) AS batch FROM r WHERE rank <= 20""")
def f06_review_queue(spark, sf_dir):
    """The ranked review queue: flags, scores, lanes and the two batches of its first twenty rows."""
    top = qa.queue(_scored(spark, sf_dir), "doc_id", 20)
    return O.batches(top, "rank", 10).select("doc_id", F.array_join("flags", ",").alias("flags"), "score", "lane", "rank", "batch")


@query(_F + """SELECT doc_id, row_number() OVER (ORDER BY score DESC, lane, doc_id) AS rank FROM s""")
def t01_full_queue(spark, sf_dir):
    return qa.queue(_scored(spark, sf_dir).select("doc_id", "score", "lane"), "doc_id").select("doc_id", "rank")


_BATCHES = _F + """, r AS (SELECT *, row_number() OVER (ORDER BY score DESC, lane, doc_id) AS rank FROM s), b AS (SELECT *, chr(CAST(65 + (rank - 1) // 10 AS INTEGER)) AS batch FROM r WHERE rank <= 20)"""


def _batched(spark, sf_dir):
    return O.batches(qa.queue(_scored(spark, sf_dir), "doc_id", 20), "rank", 10)


@query(_BATCHES + """, c AS (SELECT batch, 'lane' AS dimension, lane AS value, count(*) AS n FROM b GROUP BY 1, 3 UNION ALL SELECT batch, 'layout', layout, count(*) FROM b GROUP BY 1, 3 UNION ALL SELECT batch, 'flag', flag, count(*) FROM (SELECT batch, unnest(flags) AS flag FROM b) GROUP BY 1, 3)
SELECT b.batch, count(*) AS page_count, min(rank) || '-' || max(rank) AS rank_range, string_agg(doc_id, ',' ORDER BY rank) AS pages, (SELECT string_agg(dimension || ':' || value || '=' || n, ',' ORDER BY dimension, value) FROM c WHERE c.batch = b.batch) AS counts FROM b GROUP BY 1""")
def f07_a05_w02_batches(spark, sf_dir):
    return qa.batch_summary(_batched(spark, sf_dir), "doc_id").select("batch", "page_count", "rank_range", F.array_join(F.transform("pages", lambda x: x.cast("string")), ",").alias("pages"), F.array_join(F.transform("counts", lambda c: F.concat(c["dimension"], F.lit(":"), c["value"], F.lit("="), c["n"])), ",").alias("counts"))


@query(_BATCHES + """, t AS (SELECT batch, min(rank) AS a, max(rank) AS z, count(*) AS n, count(*) FILTER (WHERE lane = 'accuracy-critical') AS x, count(*) FILTER (WHERE lane = 'readability-critical') AS y, string_agg('| ' || rank || ' | ' || doc_id || ' | - | ' || layout || ' | ' || score || ' | ' || array_to_string(flags, ', ') || ' | ' || source || ' | - | - |', chr(10) ORDER BY rank) AS body FROM b GROUP BY 1)
SELECT '# First Review Batches' || chr(10) || chr(10) || '- top pages covered: ' || sum(n) || chr(10) || '- batch count: ' || count(*) || chr(10) || '- batch size: 10' || chr(10) || chr(10) || string_agg('## Batch ' || batch || chr(10) || chr(10) || '- rank range: ' || a || ' - ' || z || chr(10) || '- page count: ' || n || chr(10) || '- accuracy-critical: ' || x || chr(10) || '- readability-critical: ' || y || chr(10) || chr(10) || '| Rank | Page | Label | Layout | Score | Flags | Chapter | QA Path | Chapter Path |' || chr(10) || '| --- | --- | --- | --- | --- | --- | --- | --- | --- |' || chr(10) || body || chr(10), chr(10) ORDER BY batch) AS markdown FROM t""")
def f07_batch_report(spark, sf_dir):
    b = _batched(spark, sf_dir)
    none = F.lit(None).cast("string")
    rows = b.select("batch", "rank", "lane", F.col("doc_id").alias("page"), none.alias("label"), "layout", "score", F.array_join("flags", ", ").alias("flag_summary"), F.col("source").alias("chapter"), none.alias("qa_path"), none.alias("chapter_path"))
    return qa.batch_report(rows, 10)


@query(_CASE + """, t AS (SELECT *, CASE WHEN tab OR list_has_any(flags, ['multi-section-page', 'low-confidence', 'has-override', 'page-merge']) THEN 'high' WHEN list_contains(flags, 'korean-linebreak-residue') THEN 'medium' ELSE 'low' END AS tier FROM f)
SELECT 'tier' AS dimension, tier AS value, count(*) AS n FROM t GROUP BY 2 UNION ALL SELECT 'flag', flag, count(*) FROM (SELECT unnest(flags) AS flag FROM t) GROUP BY 2 UNION ALL SELECT 'confidence', CASE WHEN low THEN 'low' ELSE 'high' END, count(*) FROM t GROUP BY 2""")
def f08_page_audit(spark, sf_dir):
    """The audit of all pages: how many have each tier, confidence and flag."""
    r = _reviewed(spark, sf_dir)
    audit = r.withColumn("tier", qa.risk_tier(F.col("flags"), F.col("layout"), F.col("confidence")))
    flags = audit.select(F.explode("flags").alias("value")).groupBy("value").agg(F.count("*").alias("n")).select(F.lit("flag").alias("dimension"), "value", "n")
    return R.counters(audit, ["tier", "confidence"]).unionByName(flags)
