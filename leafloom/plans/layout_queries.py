"""Queries of layout analysis over lines with made-up boxes."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafloom.operators import layout as L
from leafloom.operators import ordered as O
from leafloom.plans.registry import query
from leafloom.sources.tables import table

_LINES = """WITH x AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: x <> '') AS ls FROM documents),
y AS (SELECT doc_id, unnest(ls) AS text, unnest(range(len(ls))) AS pos FROM x), l AS (SELECT doc_id, CAST(pos // 40 + 1 AS INTEGER) AS page, CAST(pos % 40 AS INTEGER) AS line, text, 70.0::DOUBLE AS l, least(525.0, 70.0 + 8.0 * length(text))::DOUBLE AS r FROM y),
c AS (SELECT *, abs((l + r) / 2 - 297.5) <= 59.5 AND abs(l - (595 - r)) <= 71.4 AND r - l <= 357 AS mid, regexp_matches(text, '(?:[·.]\\s*){5,}') AS leader,
 regexp_matches(text, '^(?:\\d+[.)]|[가-힣][.)]|[(（]\\d+[)）]|[(（][가-힣IVXLC]{1,3}[)）]|[A-Za-z][.)]|[oO])(?:\\s+|$)') OR starts_with(text, '§') OR regexp_matches(text, '(?:[·.]\\s*){5,}') AS marker FROM l)"""


def _lines(spark, sf_dir):
    return L.synthetic(table(spark, sf_dir, "documents", "doc_id", "text"))


@query(_LINES + """SELECT doc_id, page, line, text, l AS "left", r AS "right" FROM l""")
def s06_synthetic_lines(spark, sf_dir):
    return _lines(spark, sf_dir).select("doc_id", "page", "line", "text", "left", "right")


@query(_LINES + """SELECT doc_id, page, line, mid AS is_centered, CASE WHEN mid AND length(text) <= 20 THEN 'heading' ELSE 'body' END AS kind, marker FROM c""")
def g01_g02_x25_line_kinds(spark, sf_dir):
    return L.described(_lines(spark, sf_dir)).select("doc_id", "page", "line", "is_centered", "kind", "marker")


@query(_LINES + """SELECT doc_id, page, count(*) AS n_lines, round(avg(mid::INT), 6) AS centered_ratio, round(avg(leader::INT), 6) AS leader_ratio, count(*) FILTER (WHERE marker) AS markers FROM c GROUP BY 1, 2""")
def a14_page_features(spark, sf_dir):
    f = L.features(L.described(_lines(spark, sf_dir)))
    return f.select("doc_id", "page", "n_lines", F.round("centered_ratio", 6).alias("centered_ratio"), F.round("leader_ratio", 6).alias("leader_ratio"), "markers")


@query(_LINES + """, b AS (SELECT *, NOT mid AND r - l >= 267.75 AND NOT leader AND length(text) >= 8 AS body FROM c), g AS (SELECT *, line - row_number() OVER (PARTITION BY doc_id, page, body ORDER BY line) AS run FROM b),
r AS (SELECT doc_id, page, run, count(*) AS n FROM g WHERE body GROUP BY ALL), m AS (SELECT doc_id, page, max(n) AS n FROM r GROUP BY ALL), p AS (SELECT doc_id, page, count(*) AS n FROM c GROUP BY ALL) SELECT p.doc_id, p.page, coalesce(m.n, 0) AS body_run FROM p LEFT JOIN m USING (doc_id, page)""")
def w03_body_runs(spark, sf_dir):
    return L.features(L.described(_lines(spark, sf_dir))).select("doc_id", "page", "body_run")


@query()
def l01_page_layouts(spark, sf_dir):
    """Layouts with the evidence they follow from; checked on made-up pages of every layout in the tests."""
    f = L.features(O.written(L.described(L.cleaned(_lines(spark, sf_dir)))))
    return f.select("doc_id", "page", "layout", "n_lines", "body_run", "table_bands", "anchor_grid", F.round("anchor", 3).alias("anchor"), F.round("line_gap", 3).alias("line_gap"))


@query()
def l02_l13_paragraphs(spark, sf_dir):
    """Paragraphs of all pages; they depend on what was open before, which SQL has no fold for."""
    told = O.written(L.described(L.cleaned(_lines(spark, sf_dir))))
    return L.paragraphs(L.boundaries(told, L.features(told))).select("doc_id", "page", "paragraph", "layout", "kind", "reason", F.size("lines").alias("n_lines"), "text")


@query()
def l10_l16_page_review(spark, sf_dir):
    """The review of all pages, with manual starts on the first page of documents rated low."""
    rated = table(spark, sf_dir, "labels", "doc_id", "quality").where("quality = 0")
    overrides = rated.select("doc_id", F.lit(1).alias("page"), F.lit(2).alias("index"))
    return L.reviewed(_lines(spark, sf_dir), overrides).select("doc_id", "page", "layout", "confidence", "n_paragraphs", "has_override", "merge_first")


_GRID = """WITH x AS (SELECT l_orderkey % 500 AS page, CAST(l_linenumber AS DOUBLE) * 20 AS top, 70.0 + (l_partkey % 5) * 90 AS l, l_quantity * 4.0 AS w, l_orderkey, l_partkey, l_suppkey, l_extendedprice FROM lineitem), s AS (SELECT * FROM x WHERE w <= 208.25)"""


@query(_GRID + """, c AS (SELECT page, l, count(*) AS n FROM s GROUP BY ALL) SELECT page, CAST(sum(n) AS BIGINT) AS short, count(*) AS clusters, count(*) FILTER (WHERE n >= 5) AS strong, sum(n) >= 15 AND count(*) FILTER (WHERE n >= 5) >= 3 AS anchor_grid FROM c GROUP BY 1""")
def a15_anchor_grids(spark, sf_dir):
    """Pages whose short lines stand at a few repeated left edges; edges closer than the tolerance count as one."""
    x = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity").select((F.col("l_orderkey") % 500).alias("page"), (70.0 + (F.col("l_partkey") % 5) * 90).alias("left"), (F.col("l_quantity") * 4).alias("width"), "l_partkey")
    c = O.clusters(x.where("width <= 208.25"), ["page"], "left", 18.0, ["left", "l_partkey"]).groupBy("page", "cluster").agg(F.count("*").alias("n"))
    strong = F.count_if(F.col("n") >= 5)
    return c.groupBy("page").agg(F.sum("n").alias("short"), F.count("*").alias("clusters"), strong.alias("strong"), ((F.sum("n") >= 15) & (strong >= 3)).alias("anchor_grid"))


@query(_GRID + """, b AS (SELECT page, top, count(DISTINCT l) AS columns FROM s GROUP BY ALL) SELECT page, count(*) FILTER (WHERE columns >= 3) AS table_bands, max(columns) AS most FROM b GROUP BY 1""")
def a16_table_bands(spark, sf_dir):
    x = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity").select((F.col("l_orderkey") % 500).alias("page"), (F.col("l_linenumber") * 20.0).alias("top"), (70.0 + (F.col("l_partkey") % 5) * 90).alias("left"), (F.col("l_quantity") * 4).alias("width"), "l_partkey", "l_orderkey")
    b = O.bands(x.where("width <= 208.25").withColumn("bottom", F.col("top") + 11), ["page"], "top", "bottom", 3.0, ["top", "left", "l_partkey", "l_orderkey"])
    c = O.clusters(b, ["page", "band"], "left", 18.0, ["left", "l_partkey", "l_orderkey"]).groupBy("page", "band").agg(F.max("cluster").alias("columns"))
    return c.groupBy("page").agg(F.count_if(F.col("columns") >= 3).alias("table_bands"), F.max("columns").alias("most"))


@query(_LINES + """, f AS (SELECT doc_id, page, CASE WHEN count(*) FILTER (WHERE NOT mid AND length(text) >= 8 AND NOT leader) > 0 THEN 10.0::DOUBLE END AS body_font FROM c GROUP BY ALL) SELECT doc_id, page, body_font, coalesce(abs(10.0 - body_font), 0.0)::DOUBLE AS off FROM f""")
def g03_body_fonts(spark, sf_dir):
    d = L.described(_lines(spark, sf_dir)).groupBy("doc_id", "page").agg(F.first("body_font").alias("body_font"), F.max(F.coalesce(F.abs(F.col("font_size") - F.col("body_font")), F.lit(0.0))).alias("off"))
    return d


@query("""WITH p AS (SELECT p_size AS doc_id, p_partkey, p_size % 4 AS k, row_number() OVER (PARTITION BY p_size ORDER BY p_partkey) - 1 AS line FROM part),
s AS (SELECT *, CASE WHEN line = 0 THEN 'page-start' WHEN k = 0 AND p_partkey % 3 <> 0 THEN 'toc-entry' WHEN k = 1 AND p_partkey % 3 = 0 THEN 'list-marker' WHEN k = 2 THEN 'style-change' WHEN k = 3 AND line % 3 = 0 THEN 'table-row' ELSE '' END AS reason FROM p)
SELECT doc_id, line, reason, CAST(sum(CASE WHEN reason <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line ROWS UNBOUNDED PRECEDING) - 1 AS BIGINT) AS paragraph FROM s""")
def l04_l05_l06_l07_l08_groupings(spark, sf_dir):
    """Lines of contents, lists, title pages and tables, each split by its layout's own rule."""
    p = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_size")
    line = F.row_number().over(W.partitionBy("p_size").orderBy("p_partkey")) - 1
    k, third, plain = F.col("p_size") % 4, F.col("p_partkey") % 3 == 0, F.concat("p_name", F.lit(" zz"))
    t = F.when((k == 0) & ~third, F.concat("p_name", F.lit(" ........ 12"))).when((k == 1) & third, F.concat(F.lit("1. "), plain)).otherwise(plain)
    p = p.select(F.col("p_size").alias("doc_id"), F.lit(1).alias("page"), line.alias("line"), t.alias("text"), k.alias("k"))
    row = F.when(F.col("k") == 3, F.floor(F.col("line") / 3)).otherwise(F.col("line"))
    p = p.withColumns({"top": 150.0 + 16.0 * row, "bottom": 161.0 + 16.0 * row, "left": F.when(F.col("k") == 3, 70.0 + 100.0 * (F.col("line") % 3)).otherwise(70.0), "font_size": F.lit(10.0)}).withColumn("right", F.col("left") + 80.0)
    kind = F.element_at(F.array(*map(F.lit, (L.TOC, L.LIST, L.DECORATIVE, L.TABLE))), (F.col("doc_id") % 4 + 1).cast("int"))
    pages = p.select("doc_id", "page").distinct().withColumns({"layout": kind, "anchor": F.lit(70.0), "line_gap": F.lit(5.0)})
    split = L.boundaries(O.written(L.described(p.drop("k"))), pages)
    return split.select("doc_id", F.col("line").cast("long").alias("line"), "reason", F.col("paragraph").cast("long").alias("paragraph"))


@query("""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 4 WHEN doc_id % 3 = 1 THEN 6 ELSE 7 END AS kept FROM documents""")
def w05_margin_fragments(spark, sf_dir):
    """Stacked fragments at the right margin: a whole running title goes, an incomplete or scattered one stays."""
    d = table(spark, sf_dir, "documents", "doc_id")
    k = F.col("doc_id") % 3
    body = F.array(*(F.struct(F.lit(i).alias("line"), F.lit("본문 줄").alias("text"), F.lit(70.0).alias("left"), F.lit(300.0).alias("right"), F.lit(200.0 + 16 * i).alias("top"), F.lit(10.0).alias("font_size")) for i in range(4)))
    margin = lambda *words, step=12.0: F.array(*(F.struct(F.lit(10 + i).alias("line"), F.lit(w).alias("text"), F.lit(550.0).alias("left"), F.lit(566.0).alias("right"), F.lit(300.0 + step * i).alias("top"), F.lit(8.0).alias("font_size")) for i, w in enumerate(words)))
    lines = F.concat(body, F.when(k == 0, margin("제", "1", "편")).when(k == 1, margin("제", "1")).otherwise(margin("제", "1", "편", step=60.0)))
    lines = d.select("doc_id", F.lit(1).alias("page"), F.inline(lines))
    return L.margin_pruned(lines).groupBy("doc_id").agg(F.count("*").cast("int").alias("kept"))


_REASONS = "('page-start', 'gap', 'indent', 'style-change', 'list-marker', 'toc-entry', 'table-row', 'override', 'page-merge')"


@query(f"""WITH r AS (SELECT conv_id, turn, CASE role WHEN 'system' THEN 'page-start' WHEN 'user' THEN 'gap' ELSE role END AS given, length(text) AS n FROM conversations)
SELECT conv_id, turn, CASE WHEN given IN {_REASONS} THEN given ELSE 'style-change' END AS reason, CASE WHEN turn % 5 = 0 OR n = 0 THEN 'low' WHEN n % 3 = 0 OR given = 'gap' THEN 'medium' ELSE 'high' END AS confidence FROM r""")
def l09_l14_reasons_confidence(spark, sf_dir):
    c = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    given = F.when(F.col("role") == "system", "page-start").when(F.col("role") == "user", "gap").otherwise(F.col("role"))
    n = F.length("text")
    conf = L.confidence(F.when(given == "gap", L.LIST).otherwise(L.PROSE), F.when(n % 3 != 0, F.lit(10.0)), F.col("turn") % 5 == 0, n)
    return c.select("conv_id", "turn", L.coerced(given).alias("reason"), conf.alias("confidence"))


@query("""WITH b AS (SELECT item_id, unnest(['  ' || text || ' ', '', 'second']) AS text, unnest([0, 1, 2]) AS i FROM benchmark)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY i) - 1 AS paragraph, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text, CASE WHEN i = 0 THEN 'page-start' ELSE 'override' END AS reason FROM b WHERE trim(text) <> ''""")
def l11_override_paragraphs(spark, sf_dir):
    spec = lambda c: F.struct(c.alias("text"), F.lit(None).cast("string").alias("kind"), F.lit(None).cast("string").alias("reason"))
    b = table(spark, sf_dir, "benchmark", "item_id", "text").withColumn("specs", F.array(*map(spec, (F.concat(F.lit("  "), "text", F.lit(" ")), F.lit(""), F.lit("second")))))
    p = L.override_paragraphs(b, ["item_id"], F.col("specs"), F.lit(L.PROSE))
    return p.select("item_id", F.col("paragraph").cast("long").alias("paragraph"), "text", "reason")


@query()
def l03_oversize_split(spark, sf_dir):
    """Paragraphs of full prose pages: none of several lines is over 900 characters where a sentence ends inside."""
    lines = _lines(spark, sf_dir).withColumn("text", F.concat(F.rtrim("text"), F.lit("."))).withColumn("right", F.lit(525.0))
    told = O.written(L.described(lines))
    pages = told.select("doc_id", "page").distinct().withColumns({"layout": F.lit(L.PROSE), "anchor": F.lit(70.0), "line_gap": F.lit(5.0)})
    split = L.boundaries(told, pages)
    return split.groupBy("doc_id", "page", "paragraph").agg(F.sum(F.length("text") + 1).alias("n_chars"), F.count("*").alias("n_lines"))
