"""Exact top-k search by MaxScore over integer vectors.

A term is a dimension. Its postings in a shard are the rows of non-zero weight there, in row order; where most rows are in
a list, it is kept as a column and its row numbers are implied. A query's weight times a term's least and largest weight
bounds what the term can add to a score. Terms are split by these bounds: the smallest ones that together stay under the
threshold, the score of the k-th best row known so far, are non-essential, for a row that has nothing but them cannot get
into the result. The postings of the essential terms are traversed and give partial scores; the rows that are still
competitive are probed in the non-essential terms, largest bound first, and leave as soon as what is left cannot lift
them to the threshold.

Shards are searched apart and merged. The first shard gives each query a threshold, which goes as a floor into the rest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafloom.llm import common, vectors

#: Vectors in a shard and queries in a block.
SHARD_ROWS, BLOCK_QUERIES = 8192, 1024
#: Sums of doubles are exact integers under this.
EXACT = 2.0**53


class Postings:
    """A shard: its row ids, and for each dimension the rows (None: all) and weights of its postings, with their bounds."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, rows: np.ndarray, weights: np.ndarray):
        self.ids, self.lists, n = ids, [], len(ids)
        at = at_row = 0
        self.low, self.high = np.zeros(len(sizes)), np.zeros(len(sizes))
        for d, size in enumerate(sizes.tolist()):
            own = weights[at : at + size]
            at += size
            some = None if size == n else rows[at_row : at_row + size]
            at_row += 0 if some is None else size
            self.lists.append((some, own))
            if size:
                self.low[d], self.high[d] = own.min(), own.max()
            if some is not None:
                self.low[d], self.high[d] = min(self.low[d], 0.0), max(self.high[d], 0.0)

    def traverse(self, dim: int, factor: float, score: np.ndarray) -> None:
        """Adds a term to the scores of all rows in its postings."""
        rows, weights = self.lists[dim]
        if rows is None:
            score += factor * weights
        else:
            score[rows] += factor * weights

    def probe(self, dim: int, at: np.ndarray) -> np.ndarray:
        """The weights of rows in a term, 0 for those that its postings do not have."""
        rows, weights = self.lists[dim]
        if rows is None:
            return weights.take(at)
        if not len(rows):
            return np.zeros(len(at))
        i = np.minimum(np.searchsorted(rows, at), len(rows) - 1)
        return np.where(rows[i] == at, weights[i], 0.0)

    def matrix(self) -> np.ndarray:
        """All rows' weights."""
        every = np.arange(len(self.ids))
        return np.stack([self.probe(d, every) for d in range(len(self.lists))], axis=1) if self.lists else np.zeros((len(every), 0))


def posted(ids: np.ndarray, x: np.ndarray) -> list[bytes]:
    """A shard's row ids in order, and the sizes, rows and weights of its postings, as bytes."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    sizes, rows, weights = [], [np.zeros(0, np.int32)], [np.zeros(0)]
    for column in x.T:
        own = np.flatnonzero(column)
        if 2 * len(own) >= len(ids):
            sizes.append(len(ids))
            weights.append(column)
        else:
            sizes.append(len(own))
            rows.append(own.astype(np.int32))
            weights.append(column[own])
    return [ids.tobytes(), np.array(sizes, np.int64).tobytes(), np.concatenate(rows).tobytes(), np.concatenate(weights).tobytes()]


def opened(ids: bytes, sizes: bytes, rows: bytes, weights: bytes) -> Postings:
    """A shard from its bytes."""
    return Postings(np.frombuffer(ids, np.int64), np.frombuffer(sizes, np.int64), np.frombuffer(rows, np.int32), np.frombuffer(weights, np.float64))


def _kth(scores: np.ndarray, k: int) -> float:
    return np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) >= k else -np.inf


def maxscore(query: np.ndarray, own: int | None, shard: Postings, k: int, floor: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the ``k`` best rows for one query, best first, ties to the smaller id; never a row of ``own``.

    ``floor`` is a score that a row must reach to matter, known from other shards.
    """
    ids = shard.ids
    bound = np.maximum(np.maximum(query * shard.low, query * shard.high), 0.0)
    if (np.abs(query) * np.maximum(np.abs(shard.low), np.abs(shard.high))).sum() >= EXACT:
        return _by_hand(query, own, ids, shard.matrix(), k)
    order = np.argsort(bound, kind="stable")
    threshold = floor
    if floor == -np.inf and len(order) and bound[order[-1]] > 0:
        # a first threshold: what the rows of the strongest term's largest weights reach
        rows, weights = shard.lists[order[-1]]
        n = min(16 * k, len(weights))
        some = np.argpartition(-query[order[-1]] * weights, n - 1)[:n]
        some = some if rows is None else rows[some]
        some = some[ids[some] != own]
        threshold = _kth(sum(query[d] * shard.probe(d, some) for d in range(len(query))), k)
    reach = np.cumsum(bound[order])  # what the terms up to here can add
    split = int(np.searchsorted(reach, threshold, "left"))  # the terms before it are non-essential
    left = float(reach[split - 1]) if split else 0.0
    partial = np.zeros(len(ids))
    for d in order[split:].tolist():
        shard.traverse(d, query[d], partial)
    alive = np.flatnonzero((partial + left >= threshold) & (ids != own))
    score = partial[alive]
    for at, d in enumerate(order[:split][::-1].tolist()):
        if at % 4 == 0 and len(alive) > k:
            threshold = max(threshold, _kth(score, k) - _sink(query, shard, order[: split - at]))
            stay = np.flatnonzero(score + left >= threshold)
            alive, score = alive[stay], score[stay]
        score += query[d] * shard.probe(d, alive)
        left -= bound[d]
    best = vectors.best_rows(score, ids[alive], k)
    return ids[alive][best], score[best]


def _sink(query: np.ndarray, shard: Postings, terms: np.ndarray) -> float:
    """How far these terms can lower a score."""
    return -float(np.minimum(np.minimum(query[terms] * shard.low[terms], query[terms] * shard.high[terms]), 0.0).sum())


def _by_hand(query: np.ndarray, own: int | None, ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for weights whose sums doubles may round: all rows by whole numbers of any size."""
    weights = [int(a) for a in query]
    scores = sorted((-sum(a * int(b) for a, b in zip(weights, row, strict=True)), int(i)) for i, row in zip(ids, x.tolist(), strict=True) if i != own)[:k]
    if any(abs(s) >= 2**63 for s, _ in scores):
        raise ValueError("a score is too large for a long")
    return np.array([i for _, i in scores], np.int64), np.array([-s for s, _ in scores], object)


def search(rows: DataFrame, queries: DataFrame, k: int, id_col: str = "id", vector_col: str = "vector", shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """For each query vector its ``k`` rows of the largest integer inner product, other than rows of the query's own id.

    ``rows`` and ``queries`` have an id and an integer-valued vector (any numeric array). Returns query_id long, rank
    int (from 1), vec_id long, score long; ties go to the smaller vec_id. Null ids, null vectors and vectors with null
    or non-finite components take no part; rows that repeat an id are candidates each, and of a repeated query id the
    smallest vector counts. Vectors of another length than the query's are no candidates. A query without candidates,
    and empty tables, give no rows. Scores are exact; one that no long can hold is an error.
    """
    base = vectors.usable(rows, id_col, vector_col, nonzero=False)
    asked = vectors.one_each(vectors.usable(queries, id_col, vector_col, nonzero=False))
    n_shards, n_blocks = max(1, -(-base.count() // shard_rows)), max(1, -(-asked.count() // block_queries))
    shards = vectors.packed(base, shard_rows, "shard", n_shards, posted, ("ids", "sizes", "rows", "weights"))
    blocks = vectors.packed(asked, block_queries, "block", n_blocks, vectors.plain, ("q_ids", "q_vectors"))
    lanes = min(n_shards, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def searched(row):
        q_ids, asking = vectors.unpack(row["q_ids"], row["q_vectors"], row["width"])
        floors = np.frombuffer(row["floors"], np.float64) if row.get("floors") else np.full(len(q_ids), -np.inf)
        if row["ids"] is None:
            return q_ids, [(np.zeros(0, np.int64), np.zeros(0))] * len(q_ids)
        shard = opened(row["ids"], row["sizes"], row["rows"], row["weights"])
        return q_ids, [maxscore(q, own, shard, k, floor) for own, q, floor in zip(q_ids.tolist(), asking, floors, strict=True)]

    def early(batches):
        """Each block with its best rows of the first shard, and the k-th of them as each query's floor."""
        for batch in batches:
            for row in batch.to_pylist():
                q_ids, got = searched(row)
                floors = np.array([float(s[k - 1]) if len(s) >= k else -np.inf for _, s in got])
                best = vectors.found_rows(q_ids, [a for a, _ in got], [b for _, b in got], np.int64)
                best = pa.array([best.to_pylist()], pa.list_(pa.struct([(c, pa.int64()) for c in best.schema.names])))
                yield pa.RecordBatch.from_arrays([pa.array([row["width"]], pa.int32()), *(pa.array([x], pa.binary()) for x in (row["q_ids"], row["q_vectors"], floors.tobytes())), best], names=["width", "q_ids", "q_vectors", "floors", "best"])

    def late(batches):
        for batch in batches:
            for row in batch.to_pylist():
                q_ids, got = searched(row)
                yield vectors.found_rows(q_ids, [a for a, _ in got], [b for _, b in got], np.int64)

    first = shards.where("shard = 0").drop("shard")  # one shard: its rows are bounded by shard_rows
    begun = blocks.join(F.broadcast(first), "width", "left").select("width", "ids", "sizes", "rows", "weights", "q_ids", "q_vectors")
    begun = common.cut(begun.mapInArrow(early, "width int, q_ids binary, q_vectors binary, floors binary, best array<struct<query_id: long, vec_id: long, score: long>>"))
    rest = vectors.met(shards.where("shard != 0"), begun.drop("best"), lanes)
    rest = rest.select("width", "ids", "sizes", "rows", "weights", "q_ids", "q_vectors", "floors").mapInArrow(late, "query_id long, vec_id long, score long")
    return vectors.merge(begun.select(F.inline("best")).unionByName(rest), k)


def op7_maxscore_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest integer inner products for each vector whose vec_id is divisible by 50, over all vectors."""
    df = common.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    whole = df.withColumn("vector", F.transform(F.col("embedding").cast("array<double>"), lambda x: F.when(F.isnan(x) | (F.abs(x) == float("inf")), x).otherwise(F.floor(x * 256).cast("double"))))
    return search(whole, whole.where(F.col("vec_id") % 50 == 0), 5, "vec_id")


OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CASE WHEN len(q.vec) = 0 THEN 0 ELSE CAST(list_inner_product(q.vec, c.vec) AS BIGINT) END AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.vec) = len(c.vec)
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rn FROM s
)
SELECT query_id, CAST(rn AS INTEGER) AS rank, vec_id, score FROM r WHERE rn <= 5
"""
