"""Queries of sources, sinks and the streaming inventory."""

from pyspark.sql import functions as F

from leafloom.operators import images
from leafloom.plans.registry import query
from leafloom.sources import sinks, tables
from leafloom.sources.tables import table


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, 80 AS slug_limit, 12 AS repetitions FROM events")
def s01_p07_settings(spark, sf_dir):
    """Settings as JSON objects, each default filled in where an object has no integer."""
    given = table(spark, sf_dir, "events", "event_id", "props").select("event_id", F.from_json("props", "k string, slug_limit string").alias("p")).select("event_id", "p.*")
    return tables.with_defaults(given, {"k": 30, "slug_limit": 80, "repetitions": 12})


@query("SELECT d.doc_id, l.quality AS override FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id AND l.quality = 0")
def s09_s10_overrides(spark, sf_dir):
    own = table(spark, sf_dir, "labels", "doc_id", "quality").where("quality = 0 and doc_id is not null").withColumnRenamed("quality", "override")
    none = tables.optional(spark, f"{sf_dir}/no-such-table.parquet", "doc_id long, override int")
    return table(spark, sf_dir, "documents", "doc_id").join(own.unionByName(none), "doc_id", "left")


@query("SELECT c_custkey, json_object('name', c_name, 'segment', c_mktsegment, 'note', NULL) AS json FROM customer")
def k01_c02_json_rows(spark, sf_dir):
    c = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment")
    row = F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.lit(None).cast("string").alias("note"))
    return c.select("c_custkey", F.to_json(row, {"ignoreNullFields": "false"}).alias("json"))


@query("SELECT event_type, string_agg(k || '=' || n, ',' ORDER BY k) AS histogram FROM (SELECT event_type, user_id % 3 AS k, count(*) AS n FROM events GROUP BY ALL) GROUP BY 1")
def c02_maps(spark, sf_dir):
    e = table(spark, sf_dir, "events", "event_type", "user_id").groupBy("event_type", (F.col("user_id") % 3).alias("k")).agg(F.count("*").alias("n"))
    m = e.groupBy("event_type").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "n")))).alias("m"))
    return m.select("event_type", F.array_join(F.transform(F.map_entries("m"), lambda x: F.concat_ws("=", x["key"], x["value"])), ",").alias("histogram"))


@query("SELECT strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS built_at, count(*) AS n FROM events GROUP BY 1")
def c04_utc_stamps(spark, sf_dir):
    return table(spark, sf_dir, "events", "ts").groupBy(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("built_at")).agg(F.count("*").alias("n"))


@query("""SELECT doc_id, CASE WHEN n_chars >= 0 THEN 'ok' END AS checked, 'images/' || printf('%04d', doc_id) || '.jpg' AS raster FROM documents""")
def k04_k08_rasters(spark, sf_dir):
    """Every page's raster, drawn by a plug-in (here its name alone), of pages that meet a requirement."""
    d = sinks.required(table(spark, sf_dir, "documents", "doc_id", "n_chars"), F.col("n_chars") >= 0, "a page without a size")
    own = F.col("doc_id").cast("string").alias("doc_id")
    files = d.select(own, F.lit("%PDF").cast("binary").alias("content"))
    made = images.drawn(files, d.select(own, F.col("doc_id").cast("int").alias("page")), lambda data, page, width: data + str(page).encode())
    return made.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit("ok").alias("checked"), F.concat(F.lit("images/"), "path").alias("raster"))
