"""Queries of scans, projections and scalar functions."""

from pyspark.sql import functions as F

from leafloom.functions import rules, text
from leafloom.operators import bundle as B
from leafloom.operators import images as I
from leafloom.operators import reader as Q
from leafloom.operators import toc as T
from leafloom.plans.registry import query
from leafloom.sources.tables import table

_LINES = "list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: x <> '')"


@query(f"""SELECT doc_id, CAST(NULL AS VARCHAR) AS page_label, 'unlabeled' AS page_kind, length(trim(text, ' ' || chr(10))) AS char_count,
  len(string_split(text, chr(10))) AS line_count, trim(text, ' ' || chr(10)) <> '' AS has_text, array_to_string(({_LINES})[1:12], ' / ') AS top_lines FROM documents""")
def p02_page_inventory(spark, sf_dir):
    d = table(spark, sf_dir, "documents", "doc_id", "text").withColumn("top", text.first_lines(F.col("text")))
    label = text.first_label(F.col("top"))
    kind = F.when(label.isNull(), "unlabeled").when(label.rlike(r"^\d+$"), "body").otherwise("frontmatter")
    body = F.trim(F.col("text"), F.lit(" \n"))
    return d.select("doc_id", label.alias("page_label"), kind.alias("page_kind"), F.length(body).cast("long").alias("char_count"), F.size(F.split("text", "\n")).cast("long").alias("line_count"), (body != "").alias("has_text"), F.array_join("top", " / ").alias("top_lines"))


@query("""WITH l AS (SELECT doc_id, unnest(['- ' || doc_id || ' -', '-xii-', 'Page ' || doc_id, '- IV -']) AS line FROM documents),
p AS (SELECT doc_id, line, nullif(lower(regexp_extract(line, '^-\\s*([ivxlcdmIVXLCDM]+|\\d{1,4})\\s*-$', 1)), '') AS label FROM l)
SELECT doc_id, line, label, CASE WHEN label IS NULL THEN 'unlabeled' WHEN regexp_matches(label, '^\\d+$') THEN 'body' ELSE 'frontmatter' END AS page_kind FROM p""")
def p01_x04_page_labels(spark, sf_dir):
    d = table(spark, sf_dir, "documents", "doc_id")
    made = F.array(F.concat(F.lit("- "), F.col("doc_id"), F.lit(" -")), F.lit("-xii-"), F.concat(F.lit("Page "), F.col("doc_id")), F.lit("- IV -"))
    d = d.withColumn("line", F.explode(made)).withColumn("label", text.page_label(F.col("line")))
    return d.withColumn("page_kind", F.when(F.col("label").isNull(), "unlabeled").when(F.col("label").rlike(r"^\d+$"), "body").otherwise("frontmatter"))


@query("""WITH b AS (SELECT doc_id, list_filter(string_split(text, chr(10) || chr(10)), lambda x: trim(x) <> '') AS blocks, string_split(text, chr(10)) AS ls FROM documents)
SELECT doc_id, len(blocks) AS n_blocks, len(list_filter(ls, lambda x: contains(x, ' | '))) AS table_lines, len(list_filter(ls, lambda x: trim(x) <> '')) AS text_lines FROM b""")
def s03_s04_page_blocks(spark, sf_dir):
    d = table(spark, sf_dir, "documents", "doc_id", "text")
    count = lambda array, test: F.size(F.filter(array, test)).cast("long")
    ls = F.split("text", "\n")
    return d.select("doc_id", count(F.split("text", "\n\n"), lambda x: F.trim(x) != "").alias("n_blocks"), count(ls, lambda x: F.contains(x, F.lit(" | "))).alias("table_lines"), count(ls, lambda x: F.trim(x) != "").alias("text_lines"))


@query("""WITH d AS (SELECT doc_id, n_chars, doc_id % 5 AS images FROM documents)
SELECT doc_id, n_chars <= 400 AND images >= 2 AS decorative, (n_chars <= 400 AND images >= 2) OR doc_id <= 3 OR doc_id IN (SELECT doc_id FROM labels WHERE quality = 0) AS skipped FROM d""")
def p04_p05_page_skips(spark, sf_dir):
    contents = table(spark, sf_dir, "labels", "doc_id", "quality").where("quality = 0").select("doc_id")
    d = table(spark, sf_dir, "documents", "doc_id", "n_chars").withColumn("images", F.col("doc_id") % 5)
    return I.skipped(d, "doc_id", contents, (0, 1, 2, 3), I.decorative(F.col("n_chars"), F.col("images"), 400)).select("doc_id", "decorative", "skipped")


@query("SELECT p_partkey, p_size, p_size < 20 OR p_partkey % 60 < 20 AS small, greatest(p_size, 20) AS at_least, coalesce(nullif(p_size % 7, 0), 12) AS repetitions FROM part")
def p06_p07_small_images(spark, sf_dir):
    p = table(spark, sf_dir, "part", "p_partkey", "p_size")
    return p.select("p_partkey", "p_size", I.too_small(F.col("p_size"), F.col("p_partkey") % 60).alias("small"), F.greatest("p_size", F.lit(20)).alias("at_least"), F.coalesce(F.nullif(F.col("p_size") % 7, F.lit(0)), F.lit(12)).alias("repetitions"))


@query("""WITH p AS (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/]+/([^?#]*)', 1) AS path FROM pages)
SELECT page_id, host, coalesce(nullif(path, ''), nullif(host, '')) AS slug, page_id % 3 < 2 AS leaks FROM p""")
def p09_p10_reduced_rows(spark, sf_dir):
    p = table(spark, sf_dir, "pages", "page_id", "url")
    host, path = F.regexp_extract("url", "^[a-z]+://([^/]+)", 1), F.regexp_extract("url", "^[a-z]+://[^/]+/([^?#]*)", 1)
    way = F.col("page_id") % 3
    said = F.concat(F.when(way == 0, " 목\n차 ").when(way == 1, "목차").otherwise("the 목차 "), host)
    return p.select("page_id", host.alias("host"), B.slug_of(path, host).alias("slug"), T.opens_contents(said).alias("leaks"))


@query("""SELECT 'empty-text' AS rule, CAST(doc_id AS BIGINT) AS key FROM documents WHERE trim(text) = ''
UNION ALL SELECT 'long-order', o_orderkey FROM orders WHERE o_totalprice > 400000
UNION ALL SELECT 'range', l_orderkey FROM lineitem WHERE l_quantity NOT BETWEEN 1 AND 45
UNION ALL SELECT 'low-quality', doc_id FROM labels WHERE quality = 0""")
def p11_rule_violations(spark, sf_dir):
    row = lambda df, rule, key: df.select(F.lit(rule).alias("rule"), F.col(key).cast("long").alias("key"))
    out = row(table(spark, sf_dir, "documents", "doc_id", "text").where(F.trim("text") == ""), "empty-text", "doc_id")
    out = out.unionByName(row(table(spark, sf_dir, "orders", "o_orderkey", "o_totalprice").where("o_totalprice > 400000"), "long-order", "o_orderkey"))
    out = out.unionByName(row(table(spark, sf_dir, "lineitem", "l_orderkey", "l_quantity").where("l_quantity not between 1 and 45"), "range", "l_orderkey"))
    return out.unionByName(row(table(spark, sf_dir, "labels", "doc_id", "quality").where("quality = 0"), "low-quality", "doc_id"))


@query("""SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS normal, lower(regexp_replace(text, '[·․\\s]+', '', 'g')) AS matching FROM documents""")
def x01_x11_normal_forms(spark, sf_dir):
    return table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", text.normalize(F.col("text")).alias("normal"), text.for_matching(F.col("text")).alias("matching"))


@query("""WITH t AS (SELECT p_partkey, trim(regexp_replace(replace(p_name, ' ', '·'), '[․ㆍ·\\s]+', ' ', 'g')) AS title FROM part),
s AS (SELECT p_partkey, title, lower(regexp_replace(regexp_replace(regexp_replace(replace(title, '/', '-'), '[^0-9A-Za-z가-힣-]+', '-', 'g'), '-{2,}', '-', 'g'), '^-+|-+$', '', 'g'))[1:80] AS s FROM t)
SELECT p_partkey, title, coalesce(nullif(s, ''), 'entry') AS slug FROM s""")
def x02_x03_titles_slugs(spark, sf_dir):
    p = table(spark, sf_dir, "part", "p_partkey", "p_name").withColumn("title", F.replace("p_name", F.lit(" "), F.lit("·")))
    return p.select("p_partkey", text.clean_title(F.col("title")).alias("title"), text.slug(F.col("title")).alias("slug"))


@query(f"""WITH l AS (SELECT doc_id, {_LINES} AS ls FROM documents), k AS (SELECT doc_id, len(ls) AS before, list_filter(ls, lambda x: NOT regexp_matches(x, '(?i)^Licensed under|^Stlich|^[A-Za-z]{{1,2}}\\.$')) AS ls FROM l)
SELECT doc_id, before, len(ls) AS after, ls[1] AS first_line FROM k""")
def x05_x06_header_strip(spark, sf_dir):
    d = table(spark, sf_dir, "documents", "doc_id", "text").withColumn("ls", text.lines(F.col("text")))
    kept = text.strip_headers(text.strip_labels(F.col("ls")), (r"(?i)^Licensed under|^Stlich|^[A-Za-z]{1,2}\.$",), heading="^제")
    return d.select("doc_id", F.size("ls").cast("long").alias("before"), F.size(kept).cast("long").alias("after"), F.get(kept, F.lit(0)).alias("first_line"))


@query("""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, 'th\\s+e\\b', 'the', 'g'), 'o\\s+f\\b', 'of', 'g'), 'an\\s+d\\b', 'and', 'g') AS repaired FROM (SELECT doc_id, replace(replace(replace(text, ' the ', ' th e '), ' of ', ' o f '), ' and ', ' an d ') AS text FROM documents)""")
def x07_x10_repair(spark, sf_dir):
    d = table(spark, sf_dir, "documents", "doc_id", "text")
    broken = F.col("text")
    for a, b in ((" the ", " th e "), (" of ", " o f "), (" and ", " an d ")):
        broken = F.replace(broken, F.lit(a), F.lit(b))
    return d.select("doc_id", text.repair(broken, ((r"th\s+e\b", "the"), (r"o\s+f\b", "of"), (r"an\s+d\b", "and"))).alias("repaired"))


_PAIRS = (("특허", "심판", "특허심판"), ("심판청구", "인은", "심판청구인은"), ("그", "사건", "그 사건"), ("민법", "§12", "민법§12"), ("권리자 및", "대리인", "권리자 및 대리인"), ("것으", "로", "것으로"), ("행정", "심판", "행정심판"))


@query(f"""SELECT p_partkey, CASE p_partkey % {len(_PAIRS)} {' '.join(f"WHEN {i} THEN '{j}'" for i, (_, _, j) in enumerate(_PAIRS))} END || ' ' || p_name AS joined, p_partkey % {len(_PAIRS)} IN (1, 5) AS residue FROM part""")
def x08_x09_line_joins(spark, sf_dir):
    p = table(spark, sf_dir, "part", "p_partkey", "p_name")
    pairs = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b, _ in _PAIRS))
    p = p.withColumn("s", F.get(pairs, (F.col("p_partkey") % len(_PAIRS)).cast("int")))
    return p.select("p_partkey", text.join_segments(F.array("s.a", F.lit(None), "s.b", F.lit(" "), "p_name")).alias("joined"), text.residue_pair(F.col("s.a"), F.col("s.b")).alias("residue"))


@query("""WITH n AS (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS x FROM documents)
SELECT doc_id, CASE WHEN length(x) <= 160 THEN x ELSE rtrim(x[1:159]) || '…' END AS excerpt, CASE WHEN length(x) <= 220 THEN x ELSE rtrim(x[1:219]) || '…' END AS summary FROM n""")
def x12_excerpts(spark, sf_dir):
    d = table(spark, sf_dir, "documents", "doc_id", "text").withColumn("x", text.normalize(F.col("text")))
    return d.select("doc_id", text.excerpt(F.col("x")).alias("excerpt"), text.excerpt(F.col("x"), 220).alias("summary"))


@query("""WITH n AS (SELECT doc_id, trim(regexp_replace(regexp_replace(text, '[·․]+', ' ', 'g'), '\\s+', ' ', 'g')) AS x FROM documents), h AS (SELECT *, x[1:120] AS head FROM n),
s AS (SELECT *, length(regexp_extract(x, '^(.*?)(?:[.!?]\\s|[다요]\\.\\s)', 1)) AS ahead, instr(reverse(head), ' ') AS back FROM h)
SELECT doc_id, CASE WHEN length(x) <= 120 THEN x WHEN ahead > 0 AND ahead < 120 THEN x[1:ahead + 1] ELSE rtrim(CASE WHEN back > 0 AND length(head) - back >= 72 THEN head[1:length(head) - back] ELSE head END) || '…' END AS compact FROM s""")
def x13_compact(spark, sf_dir):
    return table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", text.compact(F.col("text")).alias("compact"))


@query()
def x14_paragraphs(spark, sf_dir):
    """Lines gathered to paragraphs; a fold over a text's lines that has no SQL of its own."""
    d = table(spark, sf_dir, "documents", "doc_id", "text").withColumn("p", text.paragraphs(text.lines(F.col("text"))))
    return d.select("doc_id", F.size("p").cast("long").alias("n_paragraphs"), F.array_max(F.transform("p", F.length)).cast("long").alias("longest"))


@query("""SELECT page_id, '<p>' || replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') || '</p>' AS escaped FROM pages""")
def x15_escaped(spark, sf_dir):
    return table(spark, sf_dir, "pages", "page_id", "html").select("page_id", text.paragraph_html(F.col("html")).alias("escaped"))


@query("""SELECT c_custkey, CASE WHEN regexp_matches(c_name, '^(\\S+)#(.+)$') THEN regexp_extract(c_name, '^(\\S+)#(.+)$', 1) ELSE c_name END AS label, CASE WHEN regexp_matches(c_name, '^(\\S+)#(.+)$') THEN regexp_extract(c_name, '^(\\S+)#(.+)$', 2) ELSE c_name END AS rest FROM customer""")
def x16_split_labels(spark, sf_dir):
    label, rest = text.split_label(F.col("c_name"), r"^(\S+)#(.+)$")
    return table(spark, sf_dir, "customer", "c_custkey", "c_name").select("c_custkey", label.alias("label"), rest.alias("rest"))


@query("""WITH p AS (SELECT page_id, trim(regexp_replace(regexp_extract(html, '<h1>([^<]*)</h1>', 1), '\\s+', ' ', 'g')) AS h, regexp_extract(html, '<p>([^<]+)</p>', 1) AS t FROM pages) SELECT page_id, t AS trimmed FROM p WHERE h <> '' AND t <> '' AND NOT starts_with(replace(t, ' ', ''), replace(h, ' ', '')) AND trim(t) = t""")
def x17_heading_trim(spark, sf_dir):
    """Paragraphs behind their heading, which is repeated with other separators; those that begin with it anyway are the tests'."""
    p = table(spark, sf_dir, "pages", "page_id", "html").select("page_id", text.normalize(F.regexp_extract("html", "<h1>([^<]*)</h1>", 1)).alias("h"), F.regexp_extract("html", "<p>([^<]+)</p>", 1).alias("t"))
    p = p.where((F.col("h") != "") & (F.col("t") != "") & ~F.startswith(F.replace("t", F.lit(" ")), F.replace("h", F.lit(" "))) & (F.trim("t") == F.col("t")))
    return p.select("page_id", text.trim_headings(F.concat_ws(" ", "h", F.replace("h", F.lit(" "), F.lit("ㆍ")), F.replace("h", F.lit(" "), F.lit("  ")), "t"), F.array(F.lit("unlike"), F.col("h"))).alias("trimmed"))


_CLASSES = (("insult", ("disgusting", "pathetic", "clown")), ("license", ("Licensed", "License")), ("contact", ("@", "+1 (")), ("table", (" | ",)))


@query("""SELECT doc_id, array_to_string(list_filter([CASE WHEN contains(text, 'disgusting') OR contains(text, 'pathetic') OR contains(text, 'clown') THEN 'insult' END,
 CASE WHEN contains(text, 'Licensed') OR contains(text, 'License') THEN 'license' END, CASE WHEN contains(text, '@') OR contains(text, '+1 (') THEN 'contact' END,
 CASE WHEN contains(text, ' | ') THEN 'table' END], lambda x: x IS NOT NULL), ',') AS categories FROM documents""")
def x19_classes(spark, sf_dir):
    return table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.array_join(text.classify(F.col("text"), _CLASSES), ",").alias("categories"))


@query("""SELECT conv_id, turn, len(regexp_extract_all(text, '[0-9A-Za-z().~-]+')) AS n_tokens, array_to_string(regexp_extract_all(text, '[0-9A-Za-z().~-]+'), ' ') AS tokens FROM conversations""")
def x20_tokens(spark, sf_dir):
    t = text.tokens(F.col("text"), "[0-9A-Za-z().~-]+")
    return table(spark, sf_dir, "conversations", "conv_id", "turn", "text").select("conv_id", "turn", F.size(t).cast("long").alias("n_tokens"), F.array_join(t, " ").alias("tokens"))


@query("""WITH r AS (SELECT l_orderkey, min(l_linenumber) AS a, max(l_linenumber) AS b FROM lineitem GROUP BY 1)
SELECT l_orderkey, CASE WHEN a = b THEN CAST(a AS VARCHAR) ELSE a || '-' || b END AS locator, '#/chapter/o' || l_orderkey || CASE WHEN a = 1 THEN '' ELSE '/s' || a END AS route,
 'o' || l_orderkey || '::' || 'pages' || b AS key FROM r""")
def x21_x22_x23_locators(spark, sf_dir):
    r = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber").groupBy("l_orderkey").agg(F.min("l_linenumber").alias("a"), F.max("l_linenumber").alias("b"))
    section = F.when(F.col("a") == 1, "overview").otherwise(F.concat(F.lit("s"), F.col("a")))
    chapter = F.concat(F.lit("o"), F.col("l_orderkey"))
    return r.select("l_orderkey", text.locator(F.col("a"), F.col("b")).alias("locator"), text.route(chapter, section).alias("route"), text.composite_key(F.upper(chapter), F.concat(F.lit("Pages "), F.col("b"))).alias("key"))


@query(f"""WITH l AS (SELECT doc_id, unnest({_LINES}) AS line FROM documents), c AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(line, '\\s+\\|\\s+'), lambda x: trim(x)), lambda x: x <> '') AS cells FROM l)
SELECT doc_id, count(*) AS table_rows, max(len(cells)) AS widest, sum(len(cells)) AS cells FROM c WHERE len(cells) >= 2 GROUP BY 1""")
def x24_table_cells(spark, sf_dir):
    d = table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.explode(text.lines(F.col("text"))).alias("line"))
    c = d.select("doc_id", F.size(text.cells(F.col("line"))).cast("long").alias("n")).where("n >= 2")
    return c.groupBy("doc_id").agg(F.count("*").alias("table_rows"), F.max("n").alias("widest"), F.sum("n").alias("cells"))


@query(f"""WITH l AS (SELECT doc_id, unnest({_LINES}) AS line FROM documents)
SELECT doc_id, count(*) AS lines, count(*) FILTER (WHERE regexp_matches(line, '^(?:\\d+[.)]|[A-Za-z][.)]|[oO])(?:\\s+|$)')) AS markers, count(*) FILTER (WHERE regexp_matches(line, '[.!?…:]$')) AS ended,
 count(*) FILTER (WHERE regexp_matches(line, '(?:[·.]\\s*){{5,}}')) AS leaders, count(*) FILTER (WHERE regexp_matches(line, '[0-9]$')) AS numbered FROM l GROUP BY 1""")
def x25_line_tests(spark, sf_dir):
    d = table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.explode(text.lines(F.col("text"))).alias("line"))
    hits = lambda p: F.count_if(F.col("line").rlike(p))
    return d.groupBy("doc_id").agg(F.count("*").alias("lines"), hits(rules.LIST_MARKER).alias("markers"), hits(rules.SENTENCE_END).alias("ended"), hits(rules.LEADER_DOTS).alias("leaders"), hits("[0-9]$").alias("numbered"))


@query("""SELECT event_id, CASE event_type WHEN 'click' THEN '절차' WHEN 'view' THEN '사례·예시' ELSE event_type END AS label,
CASE WHEN event_id % 10 = 0 THEN '미상' WHEN event_id % 10 = 1 THEN 'no time' ELSE strftime(ts, '%Y. ') || month(ts) || '. ' || day(ts) || '. ' || CASE WHEN hour(ts) < 12 THEN '오전 ' ELSE '오후 ' END || CASE WHEN hour(ts) % 12 = 0 THEN 12 ELSE hour(ts) % 12 END || strftime(ts, ':%M') END AS said FROM events""")
def x26_labels_dates(spark, sf_dir):
    e = table(spark, sf_dir, "events", "event_id", "event_type", "ts")
    code = F.when(F.col("event_type") == "click", "procedure").when(F.col("event_type") == "view", "case").otherwise(F.col("event_type"))
    way = F.col("event_id") % 10
    stamp = F.when(way == 0, F.lit(None)).when(way == 1, "no time").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return e.select("event_id", text.display(code, rules.CATEGORY_LABELS).alias("label"), Q.date_label(stamp).alias("said"))


@query(f"""SELECT doc_id, array_to_string(({_LINES})[1:12], chr(10)) AS top FROM documents""")
def t06_first_lines(spark, sf_dir):
    return table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.array_join(text.first_lines(F.col("text")), "\n").alias("top"))


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, '{"event_type":"' || event_type || '","props":{"k":' || CAST(json_extract(props, '$.k') AS BIGINT) || ',"note":null},"text":"새"}' AS encoded FROM events""")
def c03_json_columns(spark, sf_dir):
    """Nested rows as JSON with nulls kept and no escapes, and what JSON text holds as columns."""
    e = table(spark, sf_dir, "events", "event_id", "event_type", "props")
    e = e.withColumn("props", F.from_json("props", "k bigint, note string"))
    return e.select("event_id", "props.k", text.encoded(F.struct("event_type", "props", F.lit("새").alias("text"))).alias("encoded"))


@query("""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(trim(text), '\\s+'), lambda x: x <> '') AS w FROM documents)
SELECT doc_id, len(w) AS words, len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1])) > 0 AS repeats FROM w""")
def w09_c01_adjacent_words(spark, sf_dir):
    d = table(spark, sf_dir, "documents", "doc_id", "text").withColumn("w", F.filter(F.split(F.trim("text"), r"\s+"), lambda x: x != ""))
    return d.select("doc_id", F.size("w").cast("long").alias("words"), text.has_residue(F.col("w"), lambda a, b: a == b).alias("repeats"))
