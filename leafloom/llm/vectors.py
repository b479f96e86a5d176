"""Vectors in shards: the shared part of the two searches over ``embeddings``-like tables.

Rows are dealt evenly to shards of bounded size, whatever their ids and values, and a shard is one row that holds its
index as bytes. Shards are written once and stay in their lanes; each lane gets every block of queries once.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafloom.llm import common

def usable(df: DataFrame, id_col: str, vector_col: str, nonzero: bool) -> DataFrame:
    """(id, vector as doubles) of the rows that take part: id and vector not null, every component finite.

    ``nonzero`` also leaves out zero vectors, empty ones among them. Rows that repeat an id are rows of their own.
    """
    v = F.col(vector_col).cast("array<double>")
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    keep = F.col("id").isNotNull() & F.col("vector").isNotNull() & ~odd
    if nonzero:
        keep &= F.exists("vector", lambda x: x != 0)
    return df.select(F.col(id_col).cast("long").alias("id"), v.alias("vector")).where(keep)


def one_each(df: DataFrame) -> DataFrame:
    """The smallest vector of each id, for queries."""
    return df.groupBy("id").agg(F.min("vector").alias("vector"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column without nulls, of lists of one width, as a 2-D array of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def _by_width(batches, rows: int):
    """Batches of (id, vector) as (width, ids, matrix), each of up to ``rows`` rows of one width."""
    held: dict[int, list] = {}
    sizes: dict[int, int] = {}

    def out(width):
        ids, x = (np.concatenate(y) for y in zip(*held.pop(width), strict=True))
        sizes.pop(width)
        return width, ids, x

    for batch in batches:
        lengths = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
        for width in np.unique(lengths).tolist():
            own = batch.filter(pa.array(lengths == width))
            for a in range(0, len(own), rows):
                part = own.slice(a, rows)
                if sizes.get(width, 0) + len(part) > rows:
                    yield out(width)
                held.setdefault(width, []).append((part.column(0).to_numpy().astype(np.int64), matrix(part.column(1), width)))
                sizes[width] = sizes.get(width, 0) + len(part)
    for width in list(held):
        yield out(width)


def packed(df: DataFrame, rows: int, name: str, parts: int, make: Callable[[np.ndarray, np.ndarray], list[bytes]], fields: tuple[str, ...]) -> DataFrame:
    """(``name``, width, ``fields`` as bytes): the rows of ``df`` in groups of up to ``rows``, each made to bytes.

    Rows are dealt to ``parts`` tasks in turn, so neither an id nor a vector that many rows share makes a large group.
    """

    def run(batches):
        for width, ids, x in _by_width(batches, rows):
            yield pa.RecordBatch.from_arrays([pa.array([width], pa.int32()), *(pa.array([b], pa.binary()) for b in make(ids, x))], names=["width", *fields])

    made = df.repartition(parts).mapInArrow(run, "width int, " + ", ".join(f"{f} binary" for f in fields))
    return common.cut(made).withColumn(name, F.monotonically_increasing_id())


def plain(ids: np.ndarray, x: np.ndarray) -> list[bytes]:
    """Ids and vectors as little-endian bytes."""
    return [ids.tobytes(), x.tobytes()]


def unpack(ids: bytes, vectors: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and the matrix of a packed group."""
    i = np.frombuffer(ids, np.int64)
    return i, np.frombuffer(vectors, np.float64).reshape(len(i), width)


def met(shards: DataFrame, blocks: DataFrame, lanes: int) -> DataFrame:
    """Each shard with each block of queries of its width; a lane has some shards and gets every block once."""
    dealt = shards.withColumn("lane", F.pmod(F.xxhash64("shard"), F.lit(lanes)).cast("int"))
    asking = blocks.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    return dealt.join(asking, ["lane", "width"])


def best_rows(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` largest scores, ties to the smaller id, best first."""
    if len(scores) > 4 * k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= edge)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))[:k]]


def merge(found: DataFrame, k: int) -> DataFrame:
    """The shards' best of each query as one ranked list."""
    by = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def found_rows(query_ids: np.ndarray, found: list[np.ndarray], scores: list[np.ndarray], kind) -> pa.RecordBatch:
    """The searches' results as (query_id, vec_id, score)."""
    sizes = [len(x) for x in found]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.repeat(query_ids, sizes)), pa.array(np.concatenate([*found, np.zeros(0, np.int64)])), pa.array(np.concatenate([*scores, np.zeros(0, kind)]).astype(kind))],
        names=["query_id", "vec_id", "score"],
    )
