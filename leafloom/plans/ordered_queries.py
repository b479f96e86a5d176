"""Queries of windows, ordered sequences, sorts and top-k."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafloom.functions import text
from leafloom.operators import export as E
from leafloom.operators import ordered as O
from leafloom.operators import relational as R
from leafloom.plans.registry import query
from leafloom.sources.tables import table


@query("""WITH g AS (SELECT user_id, event_id, ts, epoch_us(ts) / 3600000000.0 AS h FROM events), b AS (SELECT *, CASE WHEN h - lag(h) OVER (PARTITION BY user_id ORDER BY h, event_id) > 24 THEN 1 ELSE 0 END AS brk FROM g),
c AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY h, event_id ROWS UNBOUNDED PRECEDING) + 1 AS cluster FROM b)
SELECT user_id, CAST(cluster AS BIGINT) AS cluster, count(*) AS n, round(avg(h), 3) AS mean, round(median(h), 3) AS middle FROM c GROUP BY 1, 2""")
def a13_clusters(spark, sf_dir):
    e = table(spark, sf_dir, "events", "user_id", "event_id", "ts").withColumn("h", F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(3600000000.0))
    c = O.clusters(e, ["user_id"], "h", 24, ["h", "event_id"])
    return c.groupBy("user_id", "cluster").agg(F.count("*").alias("n"), F.round(F.avg("h"), 3).alias("mean"), F.round(F.median("h"), 3).alias("middle"))


@query("""WITH r AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS g FROM events),
n AS (SELECT user_id, event_type, g, count(*) AS n FROM r GROUP BY ALL) SELECT user_id, max(n) AS longest_run FROM n GROUP BY 1""")
def w03_longest_run(spark, sf_dir):
    return O.longest_run(table(spark, sf_dir, "events", "user_id", "event_id", "ts", "event_type"), ["user_id"], ["ts", "event_id"], "event_type")


@query("""WITH s AS (SELECT user_id, event_id, epoch_us(ts) / 60000000.0 AS a, epoch_us(ts) / 60000000.0 + abs(value) AS z FROM events), m AS (SELECT *, max(z) OVER (PARTITION BY user_id ORDER BY a, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s),
b AS (SELECT *, sum(CASE WHEN reach IS NULL OR a > reach + 3 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY a, event_id ROWS UNBOUNDED PRECEDING) AS band FROM m)
SELECT user_id, CAST(band AS BIGINT) AS band, count(*) AS n FROM b GROUP BY 1, 2""")
def w04_bands(spark, sf_dir):
    e = table(spark, sf_dir, "events", "user_id", "event_id", "ts", "value").withColumn("a", F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(60000000.0)).withColumn("z", F.col("a") + F.abs("value"))
    return O.bands(e, ["user_id"], "a", "z", 3, ["a", "event_id"]).groupBy("user_id", "band").agg(F.count("*").alias("n"))


_L = "SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS ord FROM documents"


def _lines(spark, sf_dir):
    return table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.posexplode(F.split("text", "\n")).alias("ord", "line"))


@query(f"""WITH l AS ({_L}) SELECT doc_id, CAST(ord AS BIGINT) AS ord, line FROM (SELECT *, coalesce(lead(line, 1) OVER w = line, false) OR coalesce(lead(line, 2) OVER w = line, false) OR coalesce(lead(line, 3) OVER w = line, false) AS again FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY ord)) WHERE again""")
def w06_repeated_ahead(spark, sf_dir):
    return O.repeated_ahead(_lines(spark, sf_dir), ["doc_id"], "ord", "line").where("repeated").select("doc_id", F.col("ord").cast("long").alias("ord"), "line")


@query(f"""WITH l AS ({_L}), p AS (SELECT doc_id, ord, line, lag(line) OVER (PARTITION BY doc_id ORDER BY ord) AS prev FROM l)
SELECT doc_id, CAST(ord AS BIGINT) AS ord FROM p WHERE prev IS NOT NULL AND prev <> '' AND line <> '' AND NOT regexp_matches(prev, '[.!?…:]$') AND NOT regexp_matches(line, '^(?:\\d+[.)]|[A-Za-z][.)])(?:\\s+|$)') AND length(prev) + length(line) <= 900""")
def w07_merge_flags(spark, sf_dir):
    l = _lines(spark, sf_dir).withColumn("prev", F.lag("line").over(W.partitionBy("doc_id").orderBy("ord")))
    ok = (F.col("prev") != "") & (F.col("line") != "") & ~F.col("prev").rlike("[.!?…:]$") & ~F.col("line").rlike(r"^(?:\d+[.)]|[A-Za-z][.)])(?:\s+|$)") & (F.length("prev") + F.length("line") <= 900)
    return l.where(ok).select("doc_id", F.col("ord").cast("long").alias("ord"))


@query("""SELECT conv_id, turn, coalesce(last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING), -1) AS bucket FROM conversations""")
def w08_carry_forward(spark, sf_dir):
    c = table(spark, sf_dir, "conversations", "conv_id", "turn", "role")
    return O.carry_forward(c, ["conv_id"], "turn", F.when(F.col("role") == "user", F.col("turn")), -1).drop("role")


@query()
def w10_unique_slugs(spark, sf_dir):
    """Slugs of all parts, unique within a size: a fold along each group's rows, tested against brute force."""
    p = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_size").withColumn("base", text.slug(F.col("p_name")))
    return O.unique_slugs(p.select("p_partkey", "p_size", "base"), "p_size", "p_partkey", "base")


@query("""SELECT o_orderkey, lag(o_orderkey) OVER w AS previous, lead(o_orderkey) OVER w AS next, row_number() OVER w AS position, count(*) OVER (PARTITION BY o_custkey) AS total FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def w11_navigation(spark, sf_dir):
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    return O.navigation(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderkey").drop("o_custkey", "o_orderdate")


@query("""SELECT s_suppkey, printf('%03d', row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey)) || '__' || lower(replace(s_name, '#', '-')) || '.md' AS file FROM supplier WHERE s_acctbal > 0""")
def w12_file_numbers(spark, sf_dir):
    s = table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey", "s_acctbal").where("s_acctbal > 0")
    n = F.row_number().over(W.partitionBy("s_nationkey").orderBy("s_suppkey"))
    return s.select("s_suppkey", E.numbered(n, 3, text.slug(F.col("s_name"))).alias("file"))


_SCORE = "CASE WHEN p_name = 'red' THEN 120 WHEN starts_with(p_name, 'red') THEN 90 WHEN contains(p_name, 'red') THEN 60 ELSE 0 END + CASE WHEN contains(p_type, 'STEEL') THEN 30 ELSE 0 END"


@query(f"""SELECT p_partkey, {_SCORE} AS score, CAST(row_number() OVER (ORDER BY {_SCORE} DESC, p_size, p_partkey) AS BIGINT) AS rank FROM part WHERE {_SCORE} > 0 ORDER BY rank LIMIT 10""")
def t02_t03_top_ranked(spark, sf_dir):
    name = F.when(F.col("p_name") == "red", 120).when(F.startswith("p_name", F.lit("red")), 90).when(F.contains("p_name", F.lit("red")), 60).otherwise(0)
    p = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type", "p_size").withColumn("score", name + F.when(F.contains("p_type", F.lit("STEEL")), 30).otherwise(0))
    return O.top_ranked(p.where("score > 0"), [F.desc("score"), F.col("p_size"), F.col("p_partkey")], 10).select("p_partkey", "score", "rank")


@query("""SELECT doc_id, CAST(row_number() OVER (ORDER BY n_chars DESC, doc_id) AS BIGINT) AS rank FROM documents""")
def w01_full_ranking(spark, sf_dir):
    d = table(spark, sf_dir, "documents", "doc_id", "n_chars")
    return O.ranked(d, [F.desc("n_chars"), F.col("doc_id")]).select("doc_id", "rank")


@query("""WITH f AS (SELECT doc_id, n_chars, CASE WHEN lang <> 'en' THEN 'non-english' WHEN source IN ('src0', 'src1') THEN 'bulk-source' END AS reason FROM documents WHERE n_chars >= 3000),
r AS (SELECT *, CASE WHEN reason IS NULL THEN row_number() OVER (PARTITION BY reason ORDER BY n_chars DESC, doc_id) END AS rn FROM f) SELECT doc_id, CASE WHEN reason IS NULL AND rn > 30 THEN 'sample-cap' ELSE coalesce(reason, 'sample') END AS reason FROM r""")
def t04_b09_sample(spark, sf_dir):
    d = table(spark, sf_dir, "documents", "doc_id", "n_chars", "lang", "source").where("n_chars >= 3000")
    d = d.withColumn("reason", F.when(F.col("lang") != "en", "non-english").when(F.col("source").isin("src0", "src1"), "bulk-source"))
    top = O.top_ranked(d.where("reason is null").select("doc_id", "n_chars"), [F.desc("n_chars"), F.col("doc_id")], 30).select("doc_id", F.lit("sample").alias("picked"))
    return d.join(F.broadcast(top), "doc_id", "left").select("doc_id", F.coalesce("reason", "picked", F.lit("sample-cap")).alias("reason"))


@query("""SELECT l_orderkey, string_agg(l_partkey || '@' || l_shipmode, ';' ORDER BY l_partkey, l_shipmode) AS records FROM (SELECT l_orderkey, l_partkey, l_returnflag || l_linestatus AS l_shipmode FROM lineitem) GROUP BY 1""")
def t07_manifest_order(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_returnflag", "l_linestatus")
    record = F.array_sort(F.collect_list(F.struct(F.col("l_partkey"), F.concat("l_returnflag", "l_linestatus").alias("m"))))
    l = l.groupBy("l_orderkey").agg(record.alias("r"))
    return l.select("l_orderkey", F.array_join(F.transform("r", lambda x: F.concat_ws("@", x["l_partkey"], x["m"])), ";").alias("records"))


@query("""SELECT conv_id, string_agg(turn || role, ',' ORDER BY CASE role WHEN 'system' THEN 0 WHEN 'user' THEN 1 ELSE 3 END, turn) AS catalog FROM conversations GROUP BY 1""")
def t09_q06_catalog_order(spark, sf_dir):
    place = F.when(F.col("role") == "system", 0).when(F.col("role") == "user", 1).otherwise(3)
    c = table(spark, sf_dir, "conversations", "conv_id", "turn", "role").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(place.alias("p"), "turn", "role"))).alias("c"))
    return c.select("conv_id", F.array_join(F.transform("c", lambda x: F.concat(x["turn"], x["role"])), ",").alias("catalog"))


@query("""WITH n AS (SELECT r_regionkey AS r, CAST(-1 AS INT) AS n, CAST(-1 AS BIGINT) AS s, 1 AS level, r_name AS title FROM region UNION ALL SELECT n_regionkey, n_nationkey, -1, 2, n_name FROM nation UNION ALL SELECT n_regionkey, n_nationkey, s_suppkey, 3, s_name FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT r AS doc, row_number() OVER (PARTITION BY r ORDER BY n, s) AS index, level, title FROM n""")
def s05_outline(spark, sf_dir):
    r, n, s = (table(spark, sf_dir, t) for t in ("region", "nation", "supplier"))
    rows = r.select(F.col("r_regionkey").alias("doc"), F.lit(-1).alias("n"), F.lit(-1).cast("long").alias("s"), F.lit(1).alias("level"), F.col("r_name").alias("title"))
    rows = rows.unionByName(n.select(F.col("n_regionkey").alias("doc"), F.col("n_nationkey").alias("n"), F.lit(-1).cast("long").alias("s"), F.lit(2).alias("level"), F.col("n_name").alias("title")))
    rows = rows.unionByName(s.join(n, F.col("n_nationkey") == F.col("s_nationkey")).select(F.col("n_regionkey").alias("doc"), F.col("n_nationkey").alias("n"), F.col("s_suppkey").alias("s"), F.lit(3).alias("level"), F.col("s_name").alias("title")))
    return rows.select("doc", F.row_number().over(W.partitionBy("doc").orderBy("n", "s")).cast("long").alias("index"), "level", text.clean_title(F.col("title"), True).alias("title"))


@query("""WITH f AS (SELECT source, count(*) AS n FROM documents WHERE contains(text, ' | ') GROUP BY 1) SELECT source, n, CAST(row_number() OVER (ORDER BY n DESC, source) AS BIGINT) AS rank FROM f ORDER BY rank LIMIT 8""")
def t05_report_limit(spark, sf_dir):
    f = table(spark, sf_dir, "documents", "source", "text").where(F.contains("text", F.lit(" | "))).groupBy("source").agg(F.count("*").alias("n"))
    return O.top_ranked(f, [F.desc("n"), F.col("source")], 8)


@query()
def g04_python_rounding(spark, sf_dir):
    """Prices rounded by their exact binary value, which SQL's decimal casts do not see; tested against Python."""
    l = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return l.withColumn("rounded", text.python_round(F.col("l_extendedprice") / 7))


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents), a AS (SELECT sha1(line) AS h, min(doc_id) AS first, count(DISTINCT doc_id) AS n FROM l WHERE length(line) >= 20 GROUP BY 1)
SELECT h[1:12] AS id, first AS first_page, n AS pages, row_number() OVER (PARTITION BY first ORDER BY h) AS position FROM a WHERE n <= 12""")
def m06_t07_manifest(spark, sf_dir):
    """The manifest of assets that are not too small and not repeated on too many pages, in order of first page and id."""
    l = table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.explode(F.split("text", "\n")).alias("line")).where(F.length("line") >= 20)
    a = R.content_assets(l, "line", "doc_id", F.col("doc_id"), 12).where("kept").withColumnRenamed("first_holder", "first_page")
    return a.select(F.col("asset_id").alias("id"), "first_page", F.col("n_holders").alias("pages"), F.row_number().over(W.partitionBy("first_page").orderBy("hash")).cast("long").alias("position"))
