"""Operators over ordered rows: runs, islands, bands, clusters, carry-forward, navigation, batches and slugs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def islands(df: DataFrame, keys: list[str], order: list[str], breaks: Column, into: str = "island") -> DataFrame:
    """Numbers the runs of each group from 1; a row with ``breaks`` opens one.

    A null test opens none; null keys are a group; rows that tie in the order are numbered in either order; an empty
    table stays empty.
    """
    by = W.partitionBy(*keys).orderBy(*order)
    flag = F.when(F.row_number().over(by) == 1, 1).otherwise(F.coalesce(breaks.cast("int"), F.lit(0)))
    return df.withColumn("_break", flag).withColumn(into, F.sum("_break").over(by.rowsBetween(W.unboundedPreceding, 0))).drop("_break")


def longest_run(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """The length of the longest run of equal neighbours per group."""
    by = W.partitionBy(*keys).orderBy(*order)
    marked = df.withColumn("_same", F.lag(value).over(by).eqNullSafe(F.col(value)))
    runs = islands(marked, keys, order, ~F.col("_same")).groupBy(*keys, "island").agg(F.count("*").alias("n"))
    return runs.groupBy(*keys).agg(F.max("n").alias("longest_run"))


def bands(df: DataFrame, keys: list[str], start: str, end: str, slack: float, order: list[str]) -> DataFrame:
    """Numbers the bands of overlapping intervals: a row that starts beyond all ends so far and the slack opens one.

    A null start stays in the band before it, a null end reaches nowhere; ties as in ``islands``.
    """
    by = W.partitionBy(*keys).orderBy(*order)
    reach = F.max(end).over(by.rowsBetween(W.unboundedPreceding, -1))
    marked = df.withColumn("_beyond", F.col(start) > reach + slack)
    return islands(marked, keys, order, F.col("_beyond"), "band").drop("_beyond")


def clusters(df: DataFrame, keys: list[str], value: str, gap: float, order: list[str]) -> DataFrame:
    """Numbers the clusters of sorted values: a gap to the one before of more than ``gap`` opens one.

    Next to a null value there is no gap; equal values share a cluster; ties as in ``islands``.
    """
    by = W.partitionBy(*keys).orderBy(*order)
    marked = df.withColumn("_gap", F.col(value) - F.lag(value).over(by))
    return islands(marked, keys, order, F.col("_gap") > gap, "cluster").drop("_gap")


def carry_forward(df: DataFrame, keys: list[str], order: str, marker: Column, default, into: str = "bucket") -> DataFrame:
    """The last marker at or before each row of its group, else the default; null markers are none."""
    by = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn(into, F.coalesce(F.last(marker, ignorenulls=True).over(by), F.lit(default)))


def repeated_ahead(df: DataFrame, keys: list[str], order: str, value: str, ahead: int = 3, into: str = "repeated") -> DataFrame:
    """Whether a row's value comes again within the next ``ahead`` rows."""
    by = W.partitionBy(*keys).orderBy(order)
    hits = [F.coalesce(F.lead(value, k).over(by) == F.col(value), F.lit(False)) for k in range(1, ahead + 1)]
    out = hits[0]
    for h in hits[1:]:
        out = out | h
    return df.withColumn(into, out)


def navigation(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Previous and next value, position from 1, and count within the group."""
    by = W.partitionBy(*keys).orderBy(*order)
    return df.withColumns({"previous": F.lag(value).over(by), "next": F.lead(value).over(by), "position": F.row_number().over(by).cast("long"), "total": F.count("*").over(W.partitionBy(*keys))})


def top_ranked(df: DataFrame, order: list[Column], n: int, into: str = "rank") -> DataFrame:
    """The first ``n`` rows by an order, numbered from 1: only these rows meet in one task."""
    return df.orderBy(*order).limit(n).withColumn(into, F.row_number().over(W.orderBy(*order)).cast("long"))


def ranked(df: DataFrame, order: list[Column], into: str = "rank", parts: int | None = None) -> DataFrame:
    """All rows numbered from 1 by an order without one task for all: ranges are counted, then rows within ranges.

    There are as many ranges as the session shuffles to. Rows of equal order have any order among each other.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id())
    # written once: the ranges of a rerun could differ
    spread = written(spread)
    sizes = spread.groupBy("_part").agg(F.count("*").alias("_n"))
    ahead = sizes.withColumn("_ahead", F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select("_part", "_ahead")
    within = F.row_number().over(W.partitionBy("_part").orderBy(*order))
    return spread.withColumn("_within", within).join(F.broadcast(ahead), "_part").withColumn(into, (F.col("_ahead") + F.col("_within")).cast("long")).drop("_part", "_within", "_ahead")  # ahead: a row per range


def written(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder, for plans that read it many times.

    Where the session names no folder, one machine's runs use a temporary one; on a cluster that is an error.
    """
    import tempfile

    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local") or sc.master.startswith("local-cluster") and not named:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="leafloom-"))
    return df.checkpoint()


def batches(df: DataFrame, rank: str, size: int) -> DataFrame:
    """Batches A, B, … of ``size`` ranked rows."""
    return df.withColumn("batch", F.char(F.lit(65) + F.floor((F.col(rank) - 1) / size)))


def unique_slugs(df: DataFrame, key: str, order: str, base: str, longest: int = 80) -> DataFrame:
    """Slugs that no two rows of a group share, in order: the base, else the first free ``base-2``, ``base-3``, ….

    A made slug can meet a later base, so the names in use are carried along a group's rows. A null base counts as
    ``entry``; rows of equal order are taken as they come. A group, such as a document's outline, is in one task.
    """

    def fold(f: pd.DataFrame) -> pd.DataFrame:
        used, following, out = set(), {}, []
        f = f.sort_values(order, kind="stable")
        for name in f[base].fillna("entry"):
            got, n = name, following.get(name, 2)
            while got in used:
                tail = f"-{n}"
                got, n = name[: longest - len(tail)] + tail, n + 1
            following[name] = n
            used.add(got)
            out.append(got)
        return f.assign(slug=out)

    return df.groupBy(key).applyInPandas(fold, ", ".join(f"`{n}` {t}" for n, t in df.dtypes) + ", slug string")
