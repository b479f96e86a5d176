"""Approximate nearest neighbours: an inverted file with product-quantised residuals (IVF-PQ).

Coarse centroids and the codebooks of residuals are fitted on a bounded sample, in one task. Every row is then encoded
once: rows are dealt to shards of bounded size, and a shard stores its inverted lists (row ids, a byte of code per part
and row, the original vectors, sorted by list) in a table that all searches use. A query computes one asymmetric
distance table per shard, scans the codes of the lists that it probes, and reranks the best codes exactly on the original
vectors. The shards' results are merged per query.

How many lists a query probes is measured on the sample: as few as hold the wanted share of the sample's own exact
neighbours. Clustered vectors need few lists, vectors without structure many. A sample is thinner than the whole, so its
neighbours lie farther from the query and in more lists than those of all rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafloom.llm import common, vectors

#: Rows that centroids and codebooks are fitted on, at most, and sample rows whose neighbours are sought to set the probes.
FIT_ROWS, PROBE_ROWS = 20_000, 400
#: Rows a shard, queries that are served together, and the most lists.
SHARD_ROWS, BLOCK_QUERIES, MOST_LISTS = 1 << 15, 2048, 512


@dataclass
class Quantizer:
    """Coarse centroids (lists x width), codebooks (parts x 256 x width/parts) of residuals, and lists to probe."""

    centroids: np.ndarray
    codebooks: np.ndarray
    n_probe: int = 1

    def lists_of(self, x: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` lists to probe for each row: those whose centroids have the largest inner product with it."""
        scores = x @ self.centroids.T
        n = min(n, scores.shape[1])
        return np.argpartition(-scores, n - 1, axis=1)[:, :n]

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Each row's list: the nearest centroid."""
        return _nearest(x, self.centroids)

    def encode(self, x: np.ndarray, lists: np.ndarray) -> np.ndarray:
        """Codes of the residuals: a row per part, a byte per vector."""
        rest = (x - self.centroids[lists]).reshape(len(x), len(self.codebooks), -1)
        return np.stack([_nearest(rest[:, m], b) for m, b in enumerate(self.codebooks)]).astype(np.uint8)

    def tables(self, q: np.ndarray) -> np.ndarray:
        """The asymmetric table (part x code) of a query: each code word's part of the inner product."""
        return np.einsum("md,mcd->mc", q.reshape(len(self.codebooks), -1), self.codebooks)


def _nearest(x: np.ndarray, centers: np.ndarray, rows: int = 4096) -> np.ndarray:
    norms = (centers**2).sum(1)
    return np.concatenate([np.zeros(0, np.int64), *(np.argmin(norms - 2 * (x[a : a + rows] @ centers.T), axis=1) for a in range(0, len(x), rows))])


def _kmeans(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """Centroids from different rows; one that loses all its rows is left out at the end."""
    start = np.unique(x, axis=0)
    centers = start[rng.choice(len(start), min(k, len(start)), replace=False)].copy()
    for last in [*[False] * rounds, True]:
        near = _nearest(x, centers)
        counts = np.bincount(near, minlength=len(centers))
        full = counts > 0
        if last:
            return centers[full]
        sums = np.stack([np.bincount(near, x[:, d], len(centers)) for d in range(x.shape[1])], axis=1)
        centers[full] = sums[full] / counts[full, None]


def fit(sample: np.ndarray, n_lists: int, parts: int, reach: float, k: int, seed: int = 11) -> Quantizer:
    """Centroids by k-means on the sample's different rows, a codebook of 256 words per part of the residuals, and the
    least number of lists that hold a share ``reach`` of the ``k`` nearest of sample rows among the sample."""
    rng = np.random.default_rng(seed)
    x = np.unique(sample, axis=0)
    width = x.shape[1]
    while width % parts:
        parts -= 1
    q = Quantizer(_kmeans(x, n_lists, 12, rng), np.zeros((parts, 1, width // parts)))
    rest = (x - q.centroids[q.assign(x)]).reshape(len(x), parts, -1)
    words = [_kmeans(np.ascontiguousarray(rest[:, m]), 256, 10, rng) for m in range(parts)]
    most = max(map(len, words))
    q.codebooks = np.stack([np.concatenate([w, np.repeat(w[:1], most - len(w), axis=0)]) for w in words])
    asking = rng.choice(len(x), min(PROBE_ROWS, len(x)), replace=False)
    scores = x[asking] @ x.T
    scores[np.arange(len(asking)), asking] = -np.inf
    k = min(k, len(x) - 1)
    if k:
        near = np.argpartition(-scores, k - 1, axis=1)[:, :k]
        order = np.argsort(-(x[asking] @ q.centroids.T), axis=1)
        place = np.empty_like(order)
        np.put_along_axis(place, order, np.arange(order.shape[1])[None, :].repeat(len(order), 0), 1)
        need = np.sort(np.take_along_axis(place, q.assign(x)[near], 1).ravel()) + 1
        q.n_probe = int(need[math.ceil(reach * len(need)) - 1])
    return q


@dataclass
class Index:
    """The quantizer, and the table of shards: their lists' ends, ids, codes and vectors, sorted by list and id."""

    quantizer: Quantizer
    width: int
    shards: DataFrame
    lanes: int

    def search(self, queries: DataFrame, k: int, id_col: str = "id", vector_col: str = "vector", rerank: int = 400, n_probe: int | None = None) -> DataFrame:
        """For each query the ``k`` rows found with the largest inner product, other than rows of its own id.

        Queries without a usable vector, or of another width, have no rows; of a repeated query id the smallest vector
        counts. ``rerank`` is the number of best codes of a shard that are scored exactly; ``n_probe`` replaces the
        fitted number of lists.
        """
        spark, width = self.shards.sparkSession, self.width
        asked = vectors.one_each(vectors.usable(queries, id_col, vector_col, nonzero=True).where(F.size("vector") == width))
        n_blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
        blocks = vectors.packed(asked, BLOCK_QUERIES, "block", n_blocks, vectors.plain, ("q_ids", "q_vectors"))
        shared = spark.sparkContext.broadcast(self.quantizer)  # MOST_LISTS + 256 vectors: of one size for any input
        n_probe = n_probe or self.quantizer.n_probe

        def run(batches):
            q = shared.value
            for batch in batches:
                for row in batch.to_pylist():
                    q_ids, asking = vectors.unpack(row["q_ids"], row["q_vectors"], width)
                    ids, x = vectors.unpack(row["ids"], row["vectors"], width)
                    ends, codes = np.frombuffer(row["ends"], np.int64), np.frombuffer(row["codes"], np.uint8).reshape(-1, len(ids))
                    got = [scan(q, own, v, lists, ids, x, ends, codes, k, rerank) for own, v, lists in zip(q_ids, asking, q.lists_of(asking, n_probe), strict=True)]
                    yield vectors.found_rows(q_ids, [a for a, _ in got], [b for _, b in got], np.float64)

        pairs = vectors.met(self.shards, blocks, self.lanes).select("ids", "vectors", "ends", "codes", "q_ids", "q_vectors")
        return vectors.merge(pairs.mapInArrow(run, "query_id long, vec_id long, score double"), k)


def scan(q: Quantizer, own: int, query: np.ndarray, lists: np.ndarray, ids: np.ndarray, x: np.ndarray, ends: np.ndarray, codes: np.ndarray, k: int, rerank: int) -> tuple[np.ndarray, np.ndarray]:
    """A query's best rows of a shard: the probed lists' codes by the table, then the best of them exactly."""
    lists = np.sort(lists)
    begins = np.where(lists > 0, ends[lists - 1], 0)
    sizes = ends[lists] - begins
    rows = np.arange(int(sizes.sum())) + np.repeat(begins - (np.cumsum(sizes) - sizes), sizes)
    guess = np.repeat(q.centroids[lists] @ query, sizes)
    for part, table in zip(codes, q.tables(query), strict=True):
        guess += table.take(part.take(rows))
    other = ids[rows] != own
    rows, guess = rows[other], guess[other]
    near = rows[vectors.best_rows(guess, ids[rows], max(rerank, k))]
    exact = (x[near] * query).sum(1)
    best = vectors.best_rows(exact, ids[near], k)
    return ids[near][best], exact[best]


def build(rows: DataFrame, id_col: str = "id", vector_col: str = "vector", n_lists: int | None = None, parts: int = 16, reach: float = 0.96, k: int = 20, fit_rows: int = FIT_ROWS) -> Index | None:
    """The index of all usable ``rows``, written once; None if there are none.

    ``n_lists`` follows the rows (twice their square root) up to ``MOST_LISTS``. The fitting sample is up to ``fit_rows``
    different vectors, those of the smallest hashes. Null ids, null, empty or zero vectors and vectors with null or non-finite components
    take no part, nor do vectors of other lengths than the most common one.
    """
    base = vectors.usable(rows, id_col, vector_col, nonzero=True)
    widths = base.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), "width").first()
    if widths is None:
        return None
    width, n = widths["width"], widths["count"]
    base = base.where(F.size("vector") == width)
    wanted = n_lists or 2 * math.isqrt(n)

    def learn(sample: list[tuple]) -> Quantizer:
        x = np.array([v for _, v in sample], np.float64)
        return fit(x, max(1, min(wanted, MOST_LISTS, len(np.unique(x, axis=0)) // 8)), parts, reach, k)

    # equal vectors are one candidate for the sample, so that copies do not take its places; a share of all hashes that
    # four times the sample can be expected in is enough to choose from
    hashed = base.select(F.xxhash64("vector").alias("_h"), "vector").where(F.pmod("_h", F.lit(1 << 30)) < min(1 << 30, (4 * fit_rows << 30) // n))
    hashed = hashed.dropDuplicates(["_h"]).orderBy(F.pmod("_h", F.lit(1 << 30)), "_h").limit(fit_rows)
    quantizer = common.fitted(hashed, learn)
    shared = base.sparkSession.sparkContext.broadcast(quantizer)  # MOST_LISTS + 256 vectors

    def make(ids: np.ndarray, x: np.ndarray) -> list[bytes]:
        q = shared.value
        lists = q.assign(x)
        order = np.lexsort((ids, lists))
        ids, x, lists = ids[order], x[order], lists[order]
        ends = np.cumsum(np.bincount(lists, minlength=len(q.centroids)))
        return [ids.tobytes(), x.tobytes(), ends.astype(np.int64).tobytes(), q.encode(x, lists).tobytes()]

    n_shards = max(1, -(-n // SHARD_ROWS))
    shards = vectors.packed(base, SHARD_ROWS, "shard", n_shards, make, ("ids", "vectors", "ends", "codes"))
    return Index(quantizer, width, shards, min(n_shards, int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def search(rows: DataFrame, queries: DataFrame, k: int, id_col: str = "id", vector_col: str = "vector", rerank: int = 400, **how) -> DataFrame:
    """For each query the ``k`` rows found with the largest inner product, other than rows of its own id.

    Returns query_id long, rank int (from 1), vec_id long, score double: the inner product of the original vectors in
    double precision. Ties go to the smaller vec_id; rows that repeat an id are found each. What takes no part, and
    ``how`` (the options of ``build``): see there. Empty tables give no rows.
    """
    index = build(rows, id_col, vector_col, k=k, **how)
    if index is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return index.search(queries, k, id_col, vector_col, rerank)


def op1_ivf_pq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found for each vector whose vec_id is divisible by 20, all vectors indexed."""
    df = common.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return search(df, df.where(F.col("vec_id") % 20 == 0), 20, "vec_id", "embedding")
