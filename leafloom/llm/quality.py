"""Quality by ordinal cumulative-link regression on graded ratings.

All grades share one set of hashed-text weights; ordered thresholds cut the line into grades:
P(grade <= k) = logistic(threshold_k - x.w). A text gives an expected grade and the probability of reaching a grade.
Features are the hashed distinct words and word beginnings, weighted by 1 + log of their counts, and hashed bins of the
text's shape.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafloom.llm import common

#: Hashed weights; rated documents, in whole, that the model is fitted on, at most; steps and penalty.
BUCKETS, FIT_ROWS, STEPS, PENALTY = 1 << 18, 8_000, 60, 2.0
#: Rated documents that a feature must be in, and lengths in bytes of word beginnings.
LEAST_ROWS, BEGINNINGS = 5, (4, 5)
#: Text bytes that are turned into features at once.
CHUNK_BYTES = 1 << 20
#: Bins of each shape figure.
BINS = 12
_UPPER = np.zeros(256, np.int64)
_UPPER[65:91] = 1
_PUNCT = np.zeros(256, np.int64)
_PUNCT[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 1
_DIGIT = np.zeros(256, np.int64)
_DIGIT[48:58] = 1
_LETTER = np.zeros(256, np.int64)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[offsets[1:]] - total[offsets[:-1]]


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, value) of each row's hashed features, in order of rows."""
    rows = len(offsets) - 1
    lower = common.lower_ascii(data)
    starts, ends, firsts = common.word_spans(lower, offsets)
    n = np.diff(firsts)
    row = np.repeat(np.arange(rows), n)
    # words without the punctuation at their ends
    s, e = starts.copy(), ends.copy()
    for _ in range(3):
        s += (e - s > 1) & (_PUNCT[lower[np.minimum(s, len(lower) - 1)]] > 0) if len(s) else 0
        e -= (e - s > 1) & (_PUNCT[lower[np.maximum(e - 1, 0)]] > 0) if len(e) else 0
    words = common.word_hashes(lower, s, e)
    mask = np.uint64(BUCKETS - 1)
    key, counts = np.unique(row * BUCKETS + (words & mask).astype(np.int64), return_counts=True)
    row_w, bucket_w = key // BUCKETS, key % BUCKETS
    parts = [(row_w, bucket_w, 1 + np.log(counts))]
    for length in BEGINNINGS:
        long = np.flatnonzero(e - s >= length)
        begun = common.stable_hash(common.word_hashes(lower, s[long], s[long] + length), length) & mask
        k, n_k = np.unique(row[long] * BUCKETS + begun.astype(np.int64), return_counts=True)
        parts.append((k // BUCKETS, k % BUCKETS, 1 + np.log(n_k)))
    distinct = np.bincount(row_w, minlength=rows)
    size = np.maximum(np.diff(offsets), 1)
    letters = np.maximum(_sums(_LETTER[data], offsets), 1)
    shape = [
        np.log2(n + 1) / 15,
        _sums(_UPPER[data], offsets) / letters,
        np.minimum(_sums(_PUNCT[data], offsets) / size * 4, 1),
        np.minimum(_sums(_DIGIT[data], offsets) / size * 4, 1),
        distinct / np.maximum(n, 1),
        np.minimum(_sums(_LETTER[data], offsets) / np.maximum(n, 1) / 20, 1),
        np.bincount(row_w, counts.astype(float) ** 2, rows) / np.maximum(n, 1) ** 2,
        np.bincount(row, _PUNCT[lower[ends - 1]] if len(ends) else np.zeros(0), rows) / np.maximum(n, 1),
    ]
    for k, x in enumerate(shape):
        bin_ = np.minimum((np.clip(x, 0, 1) * BINS).astype(np.int64), BINS - 1)
        b = (common.stable_hash((bin_ + 1000 * (k + 1)).astype(np.uint64), 31) & np.uint64(BUCKETS - 1)).astype(np.int64)
        parts.append((np.arange(rows), b, np.full(rows, 3.0)))
    out = [np.concatenate(x) for x in zip(*parts, strict=True)]
    order = np.argsort(out[0], kind="stable")
    return out[0][order], out[1][order], out[2][order]


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


@dataclass
class Ordinal:
    """Weights of the buckets and the ordered thresholds between the grades."""

    weights: np.ndarray
    cuts: np.ndarray

    def position(self, rows: int, row: np.ndarray, bucket: np.ndarray, value: np.ndarray) -> np.ndarray:
        return np.bincount(row, self.weights[bucket] * value, rows)

    def tails(self, position: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k from 1 up, a column each."""
        return _logistic(position[:, None] - self.cuts[None, :])


def fit(texts: list[str], grades: list[int], levels: int) -> Ordinal:
    """A model of grades 0 to ``levels - 1``: maximum likelihood with an L2 penalty, by limited-memory BFGS."""
    if not texts:
        return Ordinal(np.zeros(BUCKETS, np.float32), np.arange(2.0 - levels, 1.0))
    parts = []
    for first, _, data, offsets in common.byte_chunks(pa.array(texts, pa.string()), CHUNK_BYTES):
        row, bucket, value = features(data, offsets)
        parts.append(((row + first).astype(np.int32), bucket.astype(np.int32), value.astype(np.float32)))
    row, bucket, value = (np.concatenate(x) for x in zip(*parts, strict=True))
    del parts
    y, m = np.array(grades), len(texts)
    often = np.bincount(bucket, minlength=BUCKETS) >= LEAST_ROWS
    keep = often[bucket]
    row, bucket, value = row[keep], bucket[keep], value[keep]
    used = np.flatnonzero(often)
    n = len(used)
    place = np.zeros(BUCKETS, np.int32)
    place[used] = np.arange(n)
    compact = place[bucket]
    del bucket, keep
    share = np.array([(y >= k).mean() for k in range(1, levels)]).clip(0.01, 0.99)
    first = -np.log(share / (1 - share))

    def cuts_of(x):  # the first threshold and the logarithms of the gaps: always in order
        return np.concatenate([x[n : n + 1], x[n] + np.cumsum(np.exp(x[n + 1 :]))])

    def loss(x):
        cuts, eta = cuts_of(x), np.bincount(row, x[compact] * value, m)
        edges = np.concatenate([[-np.inf], cuts, [np.inf]])
        hi, lo = _logistic(edges[y + 1] - eta), _logistic(edges[y] - eta)
        p = np.maximum(hi - lo, 1e-12)
        d_hi, d_lo = hi * (1 - hi) / p, lo * (1 - lo) / p
        g_cut = np.array([d_lo[y == k + 1].sum() - d_hi[y == k].sum() for k in range(levels - 1)])
        gaps = np.cumsum(g_cut[::-1])[::-1][1:] * np.exp(x[n + 1 :])
        grad = np.concatenate([np.bincount(compact, (d_hi - d_lo)[row] * value, n) + PENALTY * x[:n], [g_cut.sum()], gaps])
        return -np.log(p).sum() + PENALTY / 2 * (x[:n] ** 2).sum(), grad

    x = _lbfgs(loss, np.concatenate([np.zeros(n), first[:1], np.log(np.diff(first).clip(0.05))]))
    weights = np.zeros(BUCKETS, np.float32)
    weights[used] = x[:n]
    return Ordinal(weights, cuts_of(x))


def _lbfgs(loss, x: np.ndarray, memory: int = 8) -> np.ndarray:
    value, grad = loss(x)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(STEPS):
        q, back = grad.copy(), []
        for s, d, r in reversed(past):
            back.append(r * (s @ q))
            q -= back[-1] * d
        q *= past[-1][0] @ past[-1][1] / (past[-1][1] @ past[-1][1]) if past else 1 / max(np.abs(grad).sum(), 1e-12)
        for (s, d, r), a in zip(past, reversed(back), strict=True):
            q += s * (a - r * (d @ q))
        slope, rate = grad @ q, 1.0
        while rate > 1e-8:
            new_value, new_grad = loss(x - rate * q)
            if new_value <= value - 1e-4 * rate * slope:
                break
            rate /= 2
        else:
            break
        s, d = -rate * q, new_grad - grad
        done = value - new_value < 1e-5 * abs(value)
        x, value, grad = x + s, new_value, new_grad
        if s @ d > 1e-12:
            past = [*past, (s, d, 1 / (s @ d))][-memory:]
        if done:
            break
    return x


def ratings(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): 0 for low quality, 1 for good but toxic, 2 for good and clean.

    A null toxic rating counts as not toxic; rows without a doc_id or a quality rating are no ratings; of repeated
    ratings of a document the lowest counts.
    """
    grade = F.when(F.col("quality") < 1, 0).when(F.coalesce(F.col("toxic"), F.lit(0)) > 0, 1).otherwise(2)
    return labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min(grade).alias("grade"))


def rated(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, grade) of the documents that have a text and a rating."""
    return docs.where("text is not null").select("doc_id", F.col("text").cast("string").alias("text")).join(ratings(labels), "doc_id").select("doc_id", "text", "grade")


def learn(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Ordinal:
    """A model of the ratings, fitted on the whole texts of up to ``rows`` rated documents, those of the smallest hashes."""
    # the sample is chosen by ids among the ratings of documents that are there, so only its texts are moved
    there = docs.where("text is not null").select("doc_id").distinct()
    some = ratings(labels).join(there, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.where("text is not null").select("doc_id", F.col("text").cast("string").alias("text"))
    chosen = texts.join(F.broadcast(some), "doc_id").groupBy("doc_id").agg(F.min(F.struct("grade", "text")).alias("_")).select("_.grade", "_.text")  # some: ``rows`` rows
    return common.fitted(chosen, lambda got: fit([t for _, t in got], [g for g, _ in got], 3))


def grade(docs: DataFrame, model: Ordinal) -> DataFrame:
    """``docs`` with expected_grade double (0 to 2), p_good (a grade of 1 or more) and p_clean (a grade of 2) double.

    Columns of these names are replaced. A null text is graded like an empty one; whole texts are read; rows that
    repeat get the same grades; without ratings nothing speaks against any text and p_clean is 0.5; an empty table stays
    empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS weights
    new = ["expected_grade", "p_good", "p_clean"]
    kept = [c for c in docs.columns if c not in new]

    def run(batches):
        model = shared.value
        for batch in batches:
            for first, end, data, offsets in common.byte_chunks(batch.column(0), CHUNK_BYTES):
                tails = model.tails(model.position(end - first, *features(data, offsets)))
                yield pa.RecordBatch.from_arrays([c.slice(first, end - first) for c in batch.columns[1:]] + [pa.array(tails.sum(1)), pa.array(tails[:, 0].copy()), pa.array(tails[:, -1].copy())], names=[*kept, *new])

    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept] + [f"{c} double" for c in new])
    return docs.select(F.col("text").cast("string").alias("_read"), *kept).mapInArrow(run, schema)


#: A document is selected if it is likelier than not to be good and clean.
SELECT_AT = 0.5


def op3_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's expected grade and tail probabilities, learned from ``labels``, and whether it is kept."""
    docs = common.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = learn(docs, common.table(spark, sf_dir, "labels"))
    return grade(docs, model).select("doc_id", "expected_grade", "p_good", "p_clean", (F.col("p_clean") >= SELECT_AT).alias("keep"))
