"""Joins, aggregations and set operations of document tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def last_wins(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """One row per key with the value of its last row."""
    return df.groupBy(key).agg(F.max_by(value, order).alias(value))


def first_wins(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """One row per non-null key with the value of its first row."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(value, order).alias(value))


def interval_points(df: DataFrame, start: str, end: str, point: str) -> DataFrame:
    """A row for each point of each closed interval; none where the end is before the start or either is null."""
    return df.where(F.col(start) <= F.col(end)).withColumn(point, F.explode(F.sequence(start, end)))


def stabbing_best(points: DataFrame, intervals: DataFrame, keys: list[str], point: str, start: str, end: str, order: list[Column], keep: list[str]) -> DataFrame:
    """Each point with the ``keep`` columns of the first, by ``order``, of its group's intervals that hold it; else null."""
    at = interval_points(intervals, start, end, "_point")
    best = at.groupBy(*keys, "_point").agg(F.min_by(F.struct(*keep), F.struct(*order)).alias("_best")).withColumnRenamed("_point", point)
    return points.join(best, [*keys, point], "left").select(*points.columns, *(F.col(f"_best.{c}").alias(c) for c in keep))


def parent_by_level(df: DataFrame, keys: list[str], order: str, level: str, levels: int, into: str = "parent") -> DataFrame:
    """The nearest earlier row of a smaller level: for each level the last one before, and the latest of those below.

    Null for rows of the first level and of no level; levels beyond ``levels`` are no parents; rows that tie in the order
    are not before each other in any fixed way, so the order should be unique in a group.
    """
    before = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    last = [F.max(F.when(F.col(level) == k, F.col(order))).over(before) for k in range(1, levels)]
    marks = [F.when(F.col(level) > k, x) for k, x in enumerate(last, 1)]
    return df.withColumn(into, F.greatest(*marks, F.lit(None)) if len(marks) == 1 else F.greatest(*marks))


def range_by_level(df: DataFrame, keys: list[str], order: str, level: str, levels: int, start: str, last: Column, into: str = "range_end") -> DataFrame:
    """Where a row's range ends: before the start of the next row of no deeper level, else at ``last``; not before its start.

    A row of no level ends at ``last``; a null start has a null end where nothing follows; the order should be unique.
    """
    after = W.partitionBy(*keys).orderBy(order).rowsBetween(1, W.unboundedFollowing)
    nxt = [F.min(F.when(F.col(level) == k, F.struct(order, start))).over(after) for k in range(1, levels + 1)]
    marks = [F.when(F.col(level) >= k, x) for k, x in enumerate(nxt, 1)]
    end = F.coalesce(F.least(*marks)[start] - 1, last)
    return df.withColumn(into, F.greatest(F.col(start), end))


def multiset_diff(left: DataFrame, right: DataFrame, keys: list[str], token: str) -> DataFrame:
    """(keys, token, missing, added): how often a token is more on the left, and on the right; equal counts give no row."""
    a = left.groupBy(*keys, token).agg(F.count("*").alias("_a"))
    b = right.groupBy(*keys, token).agg(F.count("*").alias("_b"))
    n, m = F.coalesce("_a", F.lit(0)), F.coalesce("_b", F.lit(0))
    both = a.join(b, [*keys, token], "full_outer")
    return both.where(n != m).select(*keys, token, F.greatest(n - m, F.lit(0)).alias("missing"), F.greatest(m - n, F.lit(0)).alias("added"))


def snapshot_diff(baseline: DataFrame, current: DataFrame, key: str, value: str) -> DataFrame:
    """(key, baseline, current, status) over the union of keys: added, removed, changed or unchanged."""
    a = baseline.select(key, F.col(value).alias("baseline_value"))
    b = current.select(key, F.col(value).alias("current_value"))
    status = F.when(F.col("baseline_value").isNull(), "added").when(F.col("current_value").isNull(), "removed").when(F.col("baseline_value").eqNullSafe(F.col("current_value")), "unchanged").otherwise("changed")
    return a.join(b, key, "full_outer").select(key, "baseline_value", "current_value", status.alias("status"))


def dominant(df: DataFrame, keys: list[str], value: str, order: Column) -> DataFrame:
    """The most frequent value per group, the first met among equals."""
    per = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"), F.min(order).alias("_first"))
    return per.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("_n"), F.col("_first"))).alias(value), F.max("_n").alias("occurrences"))


def counters(df: DataFrame, dimensions: list[str]) -> DataFrame:
    """(dimension, value, n): independent histograms of several columns in one pass."""
    pairs = F.explode(F.array(*(F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dimensions)))
    return df.select(pairs.alias("p")).groupBy("p.dimension", "p.value").agg(F.count("*").alias("n"))


def distinct_in_order(df: DataFrame, key: Column, value: str, order: str) -> DataFrame:
    """The first value of each key with its place: (value, first)."""
    return df.withColumn("_key", key).groupBy("_key").agg(F.min_by(value, order).alias(value), F.min(order).alias("first")).drop("_key")


def content_assets(df: DataFrame, content: str, holder: str, order: Column, most_holders: int | None = None) -> DataFrame:
    """Assets by the SHA-1 of their content: id, size of the first occurrence, occurrences, number of distinct holders, the
    first of them, and whether there are at most ``most_holders``.

    Holders are counted by (asset, holder) first, so content that a large part of all holders share is in no one task,
    and no list of holders is made. Null content is an asset of null hash; an empty table gives none.
    """
    hashed = df.withColumn("hash", F.sha1(F.col(content).cast("binary")))
    per = hashed.groupBy("hash", holder).agg(F.min(F.struct(order.alias("at"), F.length(content).alias("n_chars"))).alias("first"), F.count("*").alias("occurrences"))
    assets = per.groupBy("hash").agg(F.min("first")["n_chars"].alias("n_chars"), F.sum("occurrences").alias("occurrences"), F.count(holder).alias("n_holders"), F.min(holder).alias("first_holder"))
    kept = F.lit(True) if most_holders is None else F.col("n_holders") <= most_holders
    return assets.withColumns({"asset_id": F.substring("hash", 1, 12), "kept": kept})


def holders(df: DataFrame, content: str, holder: str) -> DataFrame:
    """(hash, holder): each asset with each of its holders once."""
    return df.select(F.sha1(F.col(content).cast("binary")).alias("hash"), holder).distinct()