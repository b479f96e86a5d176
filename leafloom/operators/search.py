"""Ranked, tiered and faceted search over an entries table, and routes of results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafloom.functions import text
from leafloom.operators import bundle

#: A field's scores for an equal, leading and inner match.
FIELD_SCORES = {"section": (120, 90, 60), "chapter": (100, 75, 48), "part": (72, 48, 30), "excerpt": (24, 14, 8), "text": (18, 10, 6)}
CHAPTER_SCORES = {"title": (120, 90, 60), "part": (80, 56, 32)}
#: Tiers of the audit's ranker.
TIERS = {"equal_title": 400, "equal_part": 350, "leading_title": 300, "leading_part": 250, "inner_title": 220, "text": 100}
#: Queries in a block.
QUERY_BLOCK = 1000


def warmed(entries: DataFrame, fields: list[str]) -> DataFrame:
    """Entries with their normal forms (``n_<field>``) and that of all fields together, joined before it is made."""
    out = entries.withColumns({f"n_{f}": text.for_matching(F.col(f)) for f in fields})
    return out.withColumn("haystack", text.for_matching(F.concat_ws(" ", *(F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields))))


def audited(entries: DataFrame, fields: list[str]) -> DataFrame:
    """Entries with the audit's normal forms (``n_<field>``), which keep single spaces, and that of all fields together."""
    out = entries.withColumns({f"n_{f}": bundle.query_form(F.col(f)) for f in fields})
    return out.withColumn("haystack", bundle.query_form(F.concat_ws(" ", *(F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields))))


def match_score(field: Column, q: Column, equal: int, leading: int, inner: int) -> Column:
    return F.when(q == "", 0).when(field == q, equal).when(F.startswith(field, q), leading).when(F.contains(field, q), inner).otherwise(0)


def additive(q: Column, fields: dict[str, tuple[int, int, int]]) -> Column:
    """The sum of the fields' scores; the fields are normal forms named ``n_<field>``."""
    return reduce(lambda a, b: a + b, (match_score(F.col(f"n_{f}"), q, *s) for f, s in fields.items()))


def tiered(q: Column, titles: list[str], part: str, body: str) -> Column:
    """The best tier of an entry whose body holds the query, else 0."""
    some = lambda test: reduce(lambda a, b: a | b, (test(F.col(t)) for t in titles))
    t = TIERS
    tier = F.when(some(lambda c: c == q), t["equal_title"]).when(F.col(part) == q, t["equal_part"]).when(some(lambda c: F.startswith(c, q)), t["leading_title"]).when(F.startswith(F.col(part), q), t["leading_part"]).when(some(lambda c: F.contains(c, q)), t["inner_title"]).otherwise(t["text"])
    return F.when((q != "") & F.contains(F.col(body), q), tier).otherwise(0)


def batch(entries: DataFrame, queries: DataFrame, score: Column, order: list[Column], limit: int) -> DataFrame:
    """The ``limit`` best entries of each query (column ``query``), ranked from 1.

    The stated query set meets all entries in blocks of ``QUERY_BLOCK`` queries, a row a block: an entry goes through a
    block's queries as an array, so no entry is shuffled and a task keeps its best per query before anything moves.
    Repeated queries are one; null queries find nothing.
    """
    given = queries.where("query is not null").select("query").distinct()
    blocks = given.withColumn("_block", F.floor((F.row_number().over(W.orderBy("query")) - 1) / QUERY_BLOCK)).groupBy("_block").agg(F.collect_list("query").alias("_queries"))
    # a row of blocks holds QUERY_BLOCK queries: the stated query set against all entries, in blocks
    hits = entries.join(F.broadcast(blocks.drop("_block")))
    hits = hits.withColumn("query", F.explode("_queries")).drop("_queries").withColumn("score", score).where("score > 0")
    return hits.withColumn("rank", F.row_number().over(W.partitionBy("query").orderBy(*order)).cast("long")).where(F.col("rank") <= limit)


def fallback(chapters: DataFrame, queries: DataFrame, limit: int = 1) -> DataFrame:
    """The best chapter of each query by its title and part: (query, chapter, route); for queries that found no entry.

    ``chapters`` has (chapter, title, part_title, page_start, first_route), the route of its catalog's first entry.
    """
    warm = chapters.withColumns({"n_title": text.for_matching(F.col("title")), "n_part": text.for_matching(F.col("part_title"))})
    q = text.for_matching(F.col("query"))
    best = batch(warm, queries, additive(q, CHAPTER_SCORES), [F.desc("score"), F.coalesce("page_start", F.lit(0)), F.col("chapter")], limit)
    return best.select("query", "chapter", F.col("first_route").alias("route"))


def navigation(queries: DataFrame, results: DataFrame, chapters: DataFrame, active: int | None = None) -> DataFrame:
    """(query, route): the active result's, else the first result's, else the best chapter's; null for none.

    ``results`` has (query, rank, route), ranks from 1; ``active`` counts from 0.
    """
    at = F.min_by("route", F.when(F.lit(-1 if active is None else active) == F.col("rank") - 1, F.col("rank")))
    got = results.groupBy("query").agg(at.alias("_active"), F.min_by("route", "rank").alias("_first"))
    asked = queries.select("query").distinct()
    lost = asked.join(got, "query", "left_anti")
    out = asked.join(got, "query", "left").join(fallback(chapters, lost).select("query", F.col("route").alias("_other")), "query", "left")
    return out.select("query", F.coalesce("_active", "_first", "_other").alias("route"))


def checks(queries: DataFrame, results: DataFrame) -> DataFrame:
    """(query, matches, result, route, evidence): each asked query with its number of results and its best one's route."""
    best = results.groupBy("query").agg(F.count("*").alias("_n"), F.min_by("route", "rank").alias("route"))
    out = queries.select("query").distinct().join(best, "query", "left").withColumn("matches", F.coalesce("_n", F.lit(0))).drop("_n")
    hit = F.col("matches") > 0
    return out.withColumns({"result": F.when(hit, "match").otherwise("empty"), "evidence": F.when(hit, "offline expected runtime route from top match").otherwise("offline search corpus produced no match")})


def run_totals(checked: DataFrame) -> DataFrame:
    """One row: the numbers of queries, of those that matched and of those that did not."""
    return checked.agg(F.count("*").alias("queries"), F.count_if(F.col("matches") > 0).alias("matched"), F.count_if(F.col("matches") == 0).alias("empty"))
