"""Texts cut to sections, blocks that continue each other, and boxes matched to boxes."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def sections(df: DataFrame, key: str, content: str, pattern: str, title: int = 1) -> DataFrame:
    """(key, ord, title, body): a text cut where a heading pattern occurs; what is before the first is the overview.

    The pattern must match some text. Null texts give no rows, empty ones an empty overview.
    """
    titles = F.concat(F.array(F.lit("overview")), F.regexp_extract_all(content, F.lit(pattern), title))
    parts = F.arrays_zip(titles.alias("title"), F.split(content, pattern).alias("body"))
    return df.where(F.col(content).isNotNull()).select(key, F.posexplode(parts).alias("ord", "p")).select(key, "ord", "p.title", "p.body")


def merged_blocks(df: DataFrame, keys: list[str], order: str, content: str, joins: Column) -> DataFrame:
    """Blocks of a range in order; a block with ``joins`` continues the one before."""
    by = W.partitionBy(*keys).orderBy(order)
    numbered = df.withColumn("_n", F.row_number().over(by)).withColumn("_new", F.when(F.coalesce(joins, F.lit(False)) & (F.col("_n") > 1), 0).otherwise(1))
    numbered = numbered.withColumn("block", F.sum("_new").over(by.rowsBetween(W.unboundedPreceding, 0)))
    g = numbered.groupBy(*keys, "block").agg(F.array_sort(F.collect_list(F.struct(order, content))).alias("t"), F.count("*").alias("n_parts"))
    return g.select(*keys, "block", "n_parts", F.array_join(F.col(f"t.{content}"), " ").alias(content))


def nearest_unused(df: DataFrame, other: DataFrame, keys: list[str], id_col: str, other_id: str, vector: str) -> DataFrame:
    """Each row with the nearest of the other rows of equal ``keys`` by L1 distance, each used once: greedy in order of ids.

    ``keys`` name a page and what must be equal, such as width and height: a group is matched in one task. Distances
    that tie go to the smaller id. Rows without a vector, or of another length, match nothing; null keys match none.
    """

    def match(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        a, b = a.sort_values(id_col), b[b[vector].notna()].sort_values(other_id)
        free, out = {i: np.asarray(v, float) for i, v in zip(b[other_id], b[vector], strict=True)}, []
        for i, v in zip(a[id_col], a[vector], strict=True):
            near = [] if v is None else [(np.abs(x - np.asarray(v, float)).sum(), o) for o, x in free.items() if len(x) == len(v)]
            best = min((n for n in near if n[0] == n[0]), default=(None, None))[1]
            free.pop(best, None)
            out.append((i, best))
        return pd.DataFrame(out, columns=[id_col, other_id]).astype({other_id: "Int64"})

    return df.groupBy(*keys).cogroup(other.groupBy(*keys)).applyInPandas(match, f"{id_col} long, {other_id} long")
