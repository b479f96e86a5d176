"""Queries of joins, aggregations and set operations."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafloom.functions import text
from leafloom.operators import relational as R
from leafloom.plans.registry import query
from leafloom.sources.tables import table

def role_level():
    return F.when(F.col("role") == "system", 1).when(F.col("role") == "user", 2).otherwise(3)

_LEVELS = "SELECT conv_id, turn, CASE role WHEN 'system' THEN 1 WHEN 'user' THEN 2 ELSE 3 END AS level FROM conversations"


@query("""WITH l AS (SELECT doc_id, max_by(quality, toxic) AS quality FROM labels GROUP BY 1) SELECT d.doc_id, l.quality, coalesce(l.quality, -1) AS quality_or FROM documents d LEFT JOIN l USING (doc_id)""")
def j01_last_wins_lookup(spark, sf_dir):
    labels = R.last_wins(table(spark, sf_dir, "labels"), "doc_id", "quality", "toxic")
    return table(spark, sf_dir, "documents", "doc_id").join(labels, "doc_id", "left").select("doc_id", "quality", F.coalesce("quality", F.lit(-1)).alias("quality_or"))


@query("SELECT event_type, min(event_id) AS event_id FROM events GROUP BY 1")
def j02_first_wins(spark, sf_dir):
    return R.first_wins(table(spark, sf_dir, "events", "event_id", "event_type"), "event_type", "event_id", "event_id")


@query("""WITH r AS (SELECT conv_id, min(turn) AS a, max(turn) AS b FROM conversations GROUP BY 1) SELECT r.conv_id, CAST(p.p AS BIGINT) AS point, c.n FROM r, unnest(generate_series(a, b)) AS p(p) LEFT JOIN (SELECT conv_id, turn, count(*) AS n FROM conversations GROUP BY 1, 2) c ON c.conv_id = r.conv_id AND c.turn = p.p""")
def j03_interval_points(spark, sf_dir):
    c = table(spark, sf_dir, "conversations", "conv_id", "turn")
    spans = c.groupBy("conv_id").agg(F.min("turn").alias("a"), F.max("turn").alias("b"))
    per = c.groupBy("conv_id", F.col("turn").alias("point")).agg(F.count("*").alias("n"))
    return R.interval_points(spans, "a", "b", "point").join(per, ["conv_id", "point"], "left").select("conv_id", "point", "n")


@query("""WITH s AS (SELECT conv_id, role, min(turn) AS a, max(turn) AS b FROM conversations WHERE role <> 'system' GROUP BY 1, 2)
SELECT conv_id, CAST(p.p AS BIGINT) AS point, count(DISTINCT role) AS overlap FROM s, unnest(generate_series(a, b)) AS p(p) GROUP BY 1, 2""")
def j04_overlap_count(spark, sf_dir):
    c = table(spark, sf_dir, "conversations", "conv_id", "turn", "role").where("role <> 'system'")
    spans = c.groupBy("conv_id", "role").agg(F.min("turn").alias("a"), F.max("turn").alias("b"))
    return R.interval_points(spans, "a", "b", "point").groupBy("conv_id", "point").agg(F.count_distinct("role").alias("overlap"))


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents), a AS (SELECT sha1(line) AS h, list_sort(list_distinct(list(doc_id))) AS docs FROM l WHERE line <> '' GROUP BY 1),
p AS (SELECT h, unnest(docs) AS doc_id FROM a) SELECT doc_id, count(*) AS assets, min(h) AS first_asset FROM p GROUP BY 1""")
def j05_assets_per_page(spark, sf_dir):
    lines = table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.explode(F.split("text", "\n")).alias("line")).where("line <> ''")
    return R.holders(lines, "line", "doc_id").groupBy("doc_id").agg(F.count("*").alias("assets"), F.min("hash").alias("first_asset"))


@query("""WITH s AS (SELECT user_id, event_type, CAST(min(ts) AS DATE) AS a, CAST(max(ts) AS DATE) AS b FROM events GROUP BY 1, 2), p AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
r AS (SELECT p.user_id, p.day, s.event_type, row_number() OVER (PARTITION BY p.user_id, p.day ORDER BY date_diff('day', s.a, s.b), s.event_type) AS rn FROM p JOIN s ON s.user_id = p.user_id AND p.day BETWEEN s.a AND s.b)
SELECT user_id, strftime(day, '%Y-%m-%d') AS day, event_type FROM r WHERE rn = 1""")
def j06_stabbing(spark, sf_dir):
    e = table(spark, sf_dir, "events", "user_id", "event_type", "ts").withColumn("day", F.unix_date(F.to_date("ts")))
    spans = e.groupBy("user_id", "event_type").agg(F.min("day").alias("a"), F.max("day").alias("b"))
    got = R.stabbing_best(e.select("user_id", "day").distinct(), spans, ["user_id"], "day", "a", "b", [F.col("b") - F.col("a"), F.col("event_type")], ["event_type"])
    return got.select("user_id", F.date_format(F.date_from_unix_date("day"), "yyyy-MM-dd").alias("day"), "event_type")


@query("""SELECT l_orderkey, max_by(l_returnflag, (l_linenumber, l_partkey, l_extendedprice, l_returnflag)) FILTER (WHERE l_returnflag <> 'N') AS last_label FROM lineitem GROUP BY 1""")
def j07_last_label(spark, sf_dir):
    ordinal = F.when(F.col("l_returnflag") != "N", F.struct("l_linenumber", "l_partkey", "l_extendedprice", "l_returnflag"))
    return table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_returnflag").groupBy("l_orderkey").agg(F.max_by("l_returnflag", ordinal).alias("last_label"))


@query("""SELECT 'documents' AS side, doc_id AS key FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT 'orders', o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def j08_u05_uncovered(spark, sf_dir):
    d = table(spark, sf_dir, "documents", "doc_id").join(table(spark, sf_dir, "labels", "doc_id"), "doc_id", "left_anti").select(F.lit("documents").alias("side"), F.col("doc_id").alias("key"))
    o = table(spark, sf_dir, "orders", "o_orderkey").join(table(spark, sf_dir, "lineitem", "l_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left_anti")
    return d.unionByName(o.select(F.lit("orders").alias("side"), F.col("o_orderkey").cast("long").alias("key")))


@query("""WITH s AS (SELECT s_nationkey, string_agg(s_name, ',' ORDER BY s_suppkey) AS items, count(*) AS n FROM supplier GROUP BY 1)
SELECT r.r_name, string_agg(n.n_name || '[' || coalesce(s.items, '') || ']', ';' ORDER BY n.n_nationkey) AS chapters, CAST(sum(coalesce(s.n, 0)) AS BIGINT) AS n_items FROM region r JOIN nation n ON n.n_regionkey = r.r_regionkey LEFT JOIN s ON s.s_nationkey = n.n_nationkey GROUP BY 1""")
def j09_d02_hierarchy(spark, sf_dir):
    s = table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey").groupBy("s_nationkey").agg(F.array_sort(F.collect_list(F.struct("s_suppkey", "s_name"))).alias("items"))
    n = table(spark, sf_dir, "nation").join(s, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    item = F.concat("n_name", F.lit("["), F.coalesce(F.array_join("items.s_name", ","), F.lit("")), F.lit("]"))
    n = n.select("n_regionkey", F.struct("n_nationkey", item.alias("text"), F.coalesce(F.size("items"), F.lit(0)).alias("n")).alias("c"))
    parts = table(spark, sf_dir, "region").join(n, F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name").agg(F.array_sort(F.collect_list("c")).alias("c"))
    return parts.select("r_name", F.array_join("c.text", ";").alias("chapters"), F.aggregate("c.n", F.lit(0).cast("long"), lambda a, x: a + x).alias("n_items"))


@query(f"""WITH l AS ({_LEVELS}) SELECT a.conv_id, a.turn, a.level, (SELECT max(b.turn) FROM l b WHERE b.conv_id = a.conv_id AND b.turn < a.turn AND b.level < a.level) AS parent FROM l a""")
def j10_parents(spark, sf_dir):
    c = table(spark, sf_dir, "conversations", "conv_id", "turn", "role").withColumn("level", role_level()).drop("role")
    return R.parent_by_level(c, ["conv_id"], "turn", "level", 3)


@query(f"""WITH l AS ({_LEVELS}), m AS (SELECT conv_id, max(turn) AS last FROM l GROUP BY 1) SELECT a.conv_id, a.turn, a.level, greatest(a.turn, coalesce((SELECT min(b.turn) - 1 FROM l b WHERE b.conv_id = a.conv_id AND b.turn > a.turn AND b.level <= a.level), m.last)) AS range_end FROM l a JOIN m USING (conv_id)""")
def j11_range_ends(spark, sf_dir):
    c = table(spark, sf_dir, "conversations", "conv_id", "turn", "role").withColumn("level", role_level()).drop("role").withColumn("start", F.col("turn"))
    last = F.max("turn").over(W.partitionBy("conv_id"))
    return R.range_by_level(c, ["conv_id"], "turn", "level", 3, "start", last).drop("start")


@query("""SELECT a.c_custkey, n.n_name, coalesce(o.n, 0) AS orders FROM customer a JOIN nation n ON n.n_nationkey = a.c_nationkey LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) o ON o.o_custkey = a.c_custkey""")
def j14_j15_mandatory_join(spark, sf_dir):
    c = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey").join(table(spark, sf_dir, "nation", "n_nationkey", "n_name"), F.col("n_nationkey") == F.col("c_nationkey"), "left")
    named = F.when(F.col("n_name").isNull(), F.raise_error(F.concat(F.lit("no nation for customer "), F.col("c_custkey")))).otherwise(F.col("n_name"))
    o = table(spark, sf_dir, "orders", "o_custkey").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return c.join(o, F.col("o_custkey") == F.col("c_custkey"), "left").select("c_custkey", named.alias("n_name"), F.coalesce("n", F.lit(0)).alias("orders"))


@query("""WITH t AS (SELECT conv_id, turn, list_distinct(regexp_extract_all(text, '[0-9A-Za-z]+')) AS words FROM conversations),
r AS (SELECT a.conv_id, a.turn, min(b.turn) AS first_region FROM t a JOIN t b ON a.conv_id = b.conv_id AND b.turn > a.turn AND list_has_any(a.words, b.words) GROUP BY 1, 2)
SELECT t.conv_id, t.turn, r.first_region FROM t LEFT JOIN r USING (conv_id, turn)""")
def j13_overlapping_sets(spark, sf_dir):
    t = table(spark, sf_dir, "conversations", "conv_id", "turn", "text").select("conv_id", "turn", F.array_distinct(text.tokens(F.col("text"), "[0-9A-Za-z]+")).alias("words"))
    # the next turn with each of a turn's words: a window by word, so that no pairs of turns are made
    w = t.select("conv_id", "turn", F.explode("words").alias("word"))
    after = w.withColumn("region", F.lead("turn").over(W.partitionBy("conv_id", "word").orderBy("turn")))
    first = after.groupBy("conv_id", "turn").agg(F.min("region").alias("first_region"))
    return t.select("conv_id", "turn").join(first, ["conv_id", "turn"], "left")


_TOKENS = "SELECT conv_id, turn, unnest(regexp_extract_all(text, '[0-9A-Za-z().~-]+')) AS token FROM conversations"


@query(f"""WITH t AS ({_TOKENS}), a AS (SELECT conv_id, turn + 1 AS turn, token, count(*) AS n FROM t GROUP BY ALL), b AS (SELECT conv_id, turn, token, count(*) AS n FROM t GROUP BY ALL)
SELECT coalesce(a.conv_id, b.conv_id) AS conv_id, coalesce(a.turn, b.turn) AS turn, coalesce(a.token, b.token) AS token, greatest(coalesce(a.n, 0) - coalesce(b.n, 0), 0) AS missing, greatest(coalesce(b.n, 0) - coalesce(a.n, 0), 0) AS added
FROM a FULL JOIN b ON a.conv_id = b.conv_id AND a.turn = b.turn AND a.token = b.token WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)""")
def j16_token_diff(spark, sf_dir):
    t = table(spark, sf_dir, "conversations", "conv_id", "turn", "text").select("conv_id", "turn", F.explode(text.tokens(F.col("text"), "[0-9A-Za-z().~-]+")).alias("token"))
    return R.multiset_diff(t.withColumn("turn", F.col("turn") + 1), t, ["conv_id", "turn"], "token")


@query("""WITH a AS (SELECT user_id, count(*) AS n FROM events WHERE event_id % 2 = 0 GROUP BY 1), b AS (SELECT user_id, count(*) AS n FROM events WHERE event_id % 2 = 1 GROUP BY 1)
SELECT user_id, a.n AS baseline_value, b.n AS current_value, CASE WHEN a.n IS NULL THEN 'added' WHEN b.n IS NULL THEN 'removed' WHEN a.n = b.n THEN 'unchanged' ELSE 'changed' END AS status FROM a FULL JOIN b USING (user_id)""")
def j17_u06_snapshot_diff(spark, sf_dir):
    e = table(spark, sf_dir, "events", "event_id", "user_id")
    half = lambda r: e.where(F.col("event_id") % 2 == r).groupBy("user_id").agg(F.count("*").alias("n"))
    return R.snapshot_diff(half(0), half(1), "user_id", "n")


@query("""SELECT conv_id, turn, lag(role) OVER w AS before_role, length(lag(text) OVER w) AS before_chars FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def j18_previous_context(spark, sf_dir):
    by = W.partitionBy("conv_id").orderBy("turn")
    c = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text").withColumn("before", F.lag(F.struct("role", F.length("text").cast("long").alias("n"))).over(by))
    return c.select("conv_id", "turn", F.col("before.role").alias("before_role"), F.col("before.n").alias("before_chars"))


@query("""SELECT r_regionkey, 'overview=개요;' || string_agg(n_nationkey || '=' || n_name, ';' ORDER BY n_nationkey) AS titles FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY 1""")
def j19_titles(spark, sf_dir):
    n = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", F.concat_ws("=", "n_nationkey", "n_name").alias("t")))).alias("t"))
    return table(spark, sf_dir, "region", "r_regionkey").join(n, F.col("n_regionkey") == F.col("r_regionkey")).select("r_regionkey", F.concat(F.lit("overview=개요;"), F.array_join("t.t", ";")).alias("titles"))


@query("""SELECT d.source, count(*) AS docs, count(l.doc_id) AS rated, array_to_string(list_sort(list_distinct(list(CASE WHEN l.toxic = 1 THEN d.lang END) FILTER (WHERE l.toxic = 1))), ',') AS toxic_langs FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1""")
def j20_queue_by_chapter(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", F.lit(1).alias("rated"), "toxic")
    d = table(spark, sf_dir, "documents", "doc_id", "source", "lang").join(labels, "doc_id", "left")
    langs = F.array_sort(F.collect_set(F.when(F.col("toxic") == 1, F.col("lang"))))
    got = d.groupBy("source").agg(F.count("*").alias("docs"), F.count("rated").alias("rated"), langs.alias("l"))
    return got.select("source", "docs", "rated", F.when(F.size("l") > 0, F.array_join("l", ",")).alias("toxic_langs"))


@query(f"""WITH l AS ({_LEVELS}) SELECT 'level' || level || 'Count' AS name, count(*) AS n FROM l GROUP BY 1""")
def a01_level_histogram(spark, sf_dir):
    c = table(spark, sf_dir, "conversations", "role").withColumn("level", role_level())
    return c.groupBy(F.concat(F.lit("level"), "level", F.lit("Count")).alias("name")).agg(F.count("*").alias("n"))


@query("""SELECT 'lang' AS dimension, lang AS value, count(*) AS n FROM documents GROUP BY 2 UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY 2 UNION ALL SELECT 'long', CASE WHEN n_chars >= 5000 THEN 'true' ELSE 'false' END, count(*) FROM documents GROUP BY 2""")
def a02_a04_counters(spark, sf_dir):
    d = table(spark, sf_dir, "documents", "lang", "source", "n_chars").withColumn("long", F.col("n_chars") >= 5000)
    return R.counters(d, ["lang", "source", "long"])


@query("""WITH f AS (SELECT doc_id, unnest(list_filter([CASE WHEN n_chars >= 5000 THEN 'oversize' END, CASE WHEN regexp_matches(text, '[0-9]{3,}') THEN 'digit-run' END], lambda x: x IS NOT NULL)) AS flag FROM documents)
SELECT flag, doc_id // 100 AS block, count(*) AS n, string_agg(doc_id, ',' ORDER BY doc_id) AS pages FROM f GROUP BY 1, 2""")
def a03_flag_pages(spark, sf_dir):
    """The pages of each flag, a row for each hundred of them, so that no list grows with the table."""
    d = table(spark, sf_dir, "documents", "doc_id", "text", "n_chars")
    flags = F.array_compact(F.array(F.when(F.col("n_chars") >= 5000, "oversize"), F.when(F.col("text").rlike("[0-9]{3,}"), "digit-run")))
    f = d.select("doc_id", F.explode(flags).alias("flag")).groupBy("flag", F.floor(F.col("doc_id") / 100).alias("block")).agg(F.count("*").alias("n"), F.array_sort(F.collect_list("doc_id")).alias("p"))
    return f.select("flag", "block", "n", F.array_join(F.col("p").cast("array<string>"), ",").alias("pages"))


@query("""WITH c AS (SELECT unnest(list_filter([CASE WHEN contains(text, ' | ') THEN 'table' END, CASE WHEN contains(text, '@') THEN 'contact' END, CASE WHEN contains(text, 'License') THEN 'license' END], lambda x: x IS NOT NULL)) AS category FROM documents) SELECT category, count(*) AS n FROM c GROUP BY 1""")
def a06_facets(spark, sf_dir):
    classes = (("table", (" | ",)), ("contact", ("@",)), ("license", ("License",)))
    return table(spark, sf_dir, "documents", "text").select(F.explode(text.classify(F.col("text"), classes)).alias("category")).groupBy("category").agg(F.count("*").alias("n"))


@query("SELECT count(*) AS rows, count(DISTINCT source) AS chapters, count(DISTINCT lang || '/' || source) AS routes, count(*) FILTER (WHERE lang = 'en') AS items FROM documents")
def a07_corpus_summary(spark, sf_dir):
    d = table(spark, sf_dir, "documents", "lang", "source")
    return d.agg(F.count("*").alias("rows"), F.count_distinct("source").alias("chapters"), F.count_distinct(F.concat_ws("/", "lang", "source")).alias("routes"), F.count_if(F.col("lang") == "en").alias("items"))


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents), a AS (SELECT sha1(line) AS hash, min_by(length(line), doc_id) AS n_chars, count(DISTINCT doc_id) AS n_holders, count(*) AS occurrences FROM l WHERE line <> '' GROUP BY 1)
SELECT hash[1:12] AS asset_id, n_chars, n_holders, occurrences, n_holders <= 12 AS kept FROM a""")
def a09_a10_c05_assets(spark, sf_dir):
    lines = table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.explode(F.split("text", "\n")).alias("line")).where("line <> ''")
    a = R.content_assets(lines, "line", "doc_id", F.col("doc_id"), 12)
    return a.select("asset_id", F.col("n_chars").cast("long").alias("n_chars"), "n_holders", "occurrences", "kept")


@query("""WITH c AS (SELECT l_orderkey, l_quantity, count(*) AS n, min((l_linenumber, l_partkey, l_extendedprice)) AS f FROM lineitem GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY n DESC, f) AS rn FROM c)
SELECT l_orderkey, l_quantity, n AS occurrences FROM r WHERE rn = 1""")
def a11_dominant(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem", "l_orderkey", "l_quantity", "l_linenumber", "l_partkey", "l_extendedprice")
    return R.dominant(l, ["l_orderkey"], "l_quantity", F.struct("l_linenumber", "l_partkey", "l_extendedprice"))


@query("SELECT l_orderkey, round(median(l_extendedprice), 4) AS middle FROM lineitem GROUP BY 1")
def a12_median(spark, sf_dir):
    return table(spark, sf_dir, "lineitem", "l_orderkey", "l_extendedprice").groupBy("l_orderkey").agg(F.round(F.median("l_extendedprice"), 4).alias("middle"))


@query("""SELECT l_orderkey, min(l_extendedprice) AS low, max(l_extendedprice) AS high, strftime(min(l_shipdate), '%Y-%m-%d') AS first_day, strftime(max(l_shipdate), '%Y-%m-%d') AS last_day, bool_and(l_quantity >= 10) AS all_large, string_agg(l_linestatus, '' ORDER BY l_linenumber, l_partkey, l_extendedprice, l_linestatus) AS marks FROM lineitem GROUP BY 1""")
def a17_bounding_box(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem", "l_orderkey", "l_extendedprice", "l_shipdate", "l_quantity", "l_linestatus", "l_linenumber", "l_partkey")
    marks = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_extendedprice", "l_linestatus")))
    day = lambda f: F.date_format(f("l_shipdate"), "yyyy-MM-dd")
    out = l.groupBy("l_orderkey").agg(F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("high"), day(F.min).alias("first_day"), day(F.max).alias("last_day"), F.bool_and(F.col("l_quantity") >= 10).alias("all_large"), marks.alias("m"))
    return out.withColumn("marks", F.array_join("m.l_linestatus", "")).drop("m")


@query(f"""WITH t AS ({_TOKENS}), a AS (SELECT conv_id, turn + 1 AS turn, token, count(*) AS n FROM t GROUP BY ALL), b AS (SELECT conv_id, turn, token, count(*) AS n FROM t GROUP BY ALL)
SELECT a.conv_id, CAST(sum(a.n) AS BIGINT) AS tokens, CAST(sum(greatest(a.n - coalesce(b.n, 0), 0)) AS BIGINT) AS missing, round(sum(greatest(a.n - coalesce(b.n, 0), 0)) / sum(a.n), 6) AS loss_rate FROM a LEFT JOIN b ON a.conv_id = b.conv_id AND a.turn = b.turn AND a.token = b.token GROUP BY 1""")
def a18_loss_rate(spark, sf_dir):
    t = table(spark, sf_dir, "conversations", "conv_id", "turn", "text").select("conv_id", "turn", F.explode(text.tokens(F.col("text"), "[0-9A-Za-z().~-]+")).alias("token"))
    before = t.withColumn("turn", F.col("turn") + 1)
    missing = R.multiset_diff(before, t, ["conv_id", "turn"], "token").groupBy("conv_id").agg(F.sum("missing").alias("missing"))
    total = before.groupBy("conv_id").agg(F.count("*").alias("tokens"))
    return total.join(missing, "conv_id", "left").select("conv_id", "tokens", F.coalesce("missing", F.lit(0)).alias("missing"), F.round(F.try_divide(F.coalesce("missing", F.lit(0)), F.col("tokens")), 6).alias("loss_rate"))


@query("""WITH s AS (SELECT l_orderkey, l_returnflag, string_agg(DISTINCT CAST(l_suppkey AS VARCHAR), ',' ORDER BY CAST(l_suppkey AS VARCHAR)) AS suppliers FROM lineitem GROUP BY 1, 2) SELECT l_orderkey, string_agg(l_returnflag || ':' || suppliers, ';' ORDER BY l_returnflag) AS sections FROM s GROUP BY 1""")
def a19_nested_sets(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem", "l_orderkey", "l_returnflag", "l_suppkey")
    s = l.groupBy("l_orderkey", "l_returnflag").agg(F.array_join(F.array_sort(F.collect_set(F.col("l_suppkey").cast("string"))), ",").alias("s"))
    one = F.array_sort(F.collect_list(F.struct("l_returnflag", F.concat_ws(":", "l_returnflag", "s").alias("t"))))
    return s.groupBy("l_orderkey").agg(one.alias("t")).select("l_orderkey", F.array_join("t.t", ";").alias("sections"))


@query("SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS text FROM conversations WHERE role <> 'system' AND text <> '' GROUP BY 1")
def a20_ordered_text(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").where("role <> 'system' and text <> ''")
    c = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("t"))
    return c.select("conv_id", F.array_join("t.text", "\n\n").alias("text"))


@query("""WITH p AS (SELECT regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host, len(regexp_extract_all(html, '<a ')) AS links, len(regexp_extract_all(html, '<p>')) AS paragraphs FROM pages)
SELECT host, CAST(sum(links) AS BIGINT) AS links, CAST(sum(paragraphs) AS BIGINT) AS paragraphs, bool_or(links > 5) AS has_many, count(*) AS pages FROM p GROUP BY 1""")
def a21_rollup_counts(spark, sf_dir):
    p = table(spark, sf_dir, "pages", "url", "html").select(F.regexp_extract("url", "^[a-z]+://([^/]+)", 1).alias("host"), F.regexp_count("html", F.lit("<a ")).alias("links"), F.regexp_count("html", F.lit("<p>")).alias("paragraphs"))
    return p.groupBy("host").agg(F.sum("links").alias("links"), F.sum("paragraphs").alias("paragraphs"), F.bool_or(F.col("links") > 5).alias("has_many"), F.count("*").alias("pages"))


@query("""WITH w AS (SELECT source, lang, doc_id, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS w FROM documents)
SELECT source, CAST(sum(w) AS BIGINT) AS words, max(w) AS longest, count(*) FILTER (WHERE lang = 'en') AS included, count(*) FILTER (WHERE lang <> 'en') AS excluded, min(doc_id) AS first_doc FROM w GROUP BY 1""")
def a22_a23_part_rollup(spark, sf_dir):
    words = F.size(F.filter(F.split("text", r"\s+"), lambda x: x != "")).cast("long")
    d = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source").withColumn("w", words)
    return d.groupBy("source").agg(F.sum("w").alias("words"), F.max("w").alias("longest"), F.count_if(F.col("lang") == "en").alias("included"), F.count_if(F.col("lang") != "en").alias("excluded"), F.min("doc_id").alias("first_doc"))


@query("""WITH a AS (SELECT doc_id, 'residue' AS reason FROM documents WHERE n_chars < 200 UNION ALL SELECT doc_id, 'sample' FROM documents WHERE lang = 'de' AND n_chars < 1000) SELECT doc_id, array_to_string(list_sort(list_distinct(list(reason))), '+') AS reasons FROM a GROUP BY 1""")
def u01_u04_union_reasons(spark, sf_dir):
    d = table(spark, sf_dir, "documents", "doc_id", "lang", "n_chars")
    both = d.where("n_chars < 200").select("doc_id", F.lit("residue").alias("reason")).unionByName(d.where("lang = 'de' and n_chars < 1000").select("doc_id", F.lit("sample").alias("reason")))
    return both.groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_set("reason")), "+").alias("reasons"))


@query("""WITH p AS (SELECT lower(p_type) AS k, p_type, p_partkey FROM part) SELECT min_by(p_type, p_partkey) AS p_type, min(p_partkey) AS first FROM p GROUP BY k""")
def u02_distinct_in_order(spark, sf_dir):
    return R.distinct_in_order(table(spark, sf_dir, "part", "p_type", "p_partkey"), F.lower("p_type"), "p_type", "p_partkey")


@query("SELECT l_orderkey, l_returnflag, l_linestatus, min(l_partkey) AS first_part FROM lineitem GROUP BY ALL")
def u03_distinct_records(spark, sf_dir):
    return table(spark, sf_dir, "lineitem", "l_orderkey", "l_returnflag", "l_linestatus", "l_partkey").groupBy("l_orderkey", "l_returnflag", "l_linestatus").agg(F.min("l_partkey").alias("first_part"))
