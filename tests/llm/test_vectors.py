import numpy as np
from pyspark.sql import functions as F

from leafloom.llm import ann, topk

NAN, INF = float("nan"), float("inf")


def brute(rows, queries, k):
    out = []
    for q, v in queries:
        near = sorted((-float(np.dot(v, x)), i) for i, x in rows if i != q)[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(near, 1)]
    return sorted(out)


def frame(spark, rows):
    # extra columns with the names of results
    return spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "id long, vector array<double>, rank int, score double")


def test_maxscore_equals_brute_force_with_ties_and_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-4, 5, 6)]) for i in range(300)]
    odd = [(400, None), (401, [1.0, None, 2.0, 0.0, 0.0, 0.0]), (402, [NAN] * 6), (403, [INF] * 6), (404, []), (None, [1.0] * 6)]
    queries = rows[::7] + [(9, [0.0] * 6), (10, [0.0, 0.0, -3.0, 0.0, 0.0, 0.0]), (11, [-1.0] * 6)]
    queries = [next(x for x in queries if x[0] == i) for i in sorted({i for i, _ in queries})]
    got = topk.search(frame(spark, rows + odd), frame(spark, queries + odd), 5, shard_rows=64, block_queries=10)
    assert sorted(map(tuple, got.collect())) == [(a, b, c, int(d)) for a, b, c, d in brute(rows, queries, 5)]
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]


def test_maxscore_small_and_empty_tables(spark):
    none = frame(spark, [])
    assert topk.search(none, none, 5).collect() == []
    two = frame(spark, [(1, [1.0, 2.0]), (2, [3.0, 1.0]), (2, [3.0, 1.0])])  # rows of one id are candidates each
    assert [tuple(r) for r in topk.search(two, two, 5).orderBy("query_id", "rank").collect()] == [(1, 1, 2, 5), (1, 2, 2, 5), (2, 1, 1, 5)]
    empty = frame(spark, [(1, []), (2, []), (3, [1.0])])
    assert [tuple(r) for r in topk.search(empty, empty, 5).orderBy("query_id").collect()] == [(1, 1, 2, 0), (2, 1, 1, 0)]
    big = frame(spark, [(1, [2.0**31, 3.0]), (2, [2.0**31, 1.0]), (3, [2.0**31, 0.0])])
    assert [r.score for r in topk.search(big, big.where("id = 1"), 5).orderBy("rank").collect()] == [2**62 + 3, 2**62]


def test_a_floor_and_the_split_lose_no_row():
    rng = np.random.default_rng(3)
    for trial in range(60):
        width, n = int(rng.integers(1, 9)), int(rng.integers(1, 200))
        x = rng.integers(-5, 6, (n, width)).astype(float) * (rng.random((n, width)) < 0.6)
        ids, query = rng.permutation(n).astype(np.int64) // 2, rng.integers(-5, 6, width).astype(float)
        shard = topk.opened(*topk.posted(ids, x))
        assert sorted(zip(shard.ids.tolist(), shard.matrix().tolist())) == sorted(zip(ids.tolist(), x.tolist()))
        for d, (rows, weights) in enumerate(shard.lists):  # a term has the rows of non-zero weight, or all if most have one
            assert rows is None or (weights != 0).all() and 2 * len(rows) < n
            assert shard.low[d] == shard.matrix()[:, d].min() and shard.high[d] == shard.matrix()[:, d].max()
        want = sorted((-float(query @ v), j) for j, v in zip(ids.tolist(), x) if j != 3)
        for floor in (-np.inf, -want[4][0] if len(want) > 4 else -np.inf):
            found, scores = topk.maxscore(query, 3, shard, 5, floor)
            assert [(-s, j) for s, j in zip(scores.tolist(), found.tolist())] == want[:5]


def test_maxscore_zero_query_and_other_widths(spark):
    rows = frame(spark, [(1, [0.0, 0.0]), (2, [1.0, 1.0]), (3, [5.0]), (4, [2.0, 0.0])])
    got = [tuple(r) for r in topk.search(rows, rows.where("id in (1, 3)"), 2).orderBy("rank").collect()]
    assert got == [(1, 1, 2, 0), (1, 2, 4, 0)]


def test_ivf_recall_exact_scores_and_order(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, np.array(r.embedding, np.float64)) for r in df.collect()]
    got = ann.op1_ivf_pq(spark, sf).collect()
    want = {}
    for q, _, i, _ in brute(rows, [r for r in rows if r[0] % 20 == 0], 20):
        want.setdefault(q, set()).add(i)
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append(r)
    assert set(found) == set(want)
    hit = sum(len(want[q] & {r.vec_id for r in rs}) for q, rs in found.items())
    assert hit >= 0.9 * sum(map(len, want.values()))
    by_id = dict(rows)
    for q, rs in found.items():
        rs.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rs] == list(range(1, 21)) and q not in {r.vec_id for r in rs}
        assert all(abs(r.score - by_id[q] @ by_id[r.vec_id]) < 1e-12 for r in rs)
        assert [(-r.score, r.vec_id) for r in rs] == sorted((-r.score, r.vec_id) for r in rs)


def recall(found, rows, queries, k):
    want = {}
    for q, _, i, _ in brute(rows, queries, k):
        want.setdefault(q, set()).add(i)
    got = {}
    for r in found:
        got.setdefault(r.query_id, set()).add(r.vec_id)
    return sum(len(want[q] & got.get(q, set())) for q in want) / sum(map(len, want.values()))


def test_ivf_recall_where_codes_decide(spark):
    """6,000 vectors without structure and 6,000 in clusters, two shards, a hundredth of the rows reranked."""
    rng = np.random.default_rng(7)
    loose = rng.normal(size=(6000, 32))
    centers = rng.normal(size=(60, 32)) * 3
    tight = centers[rng.integers(0, 60, 6000)] + rng.normal(size=(6000, 32))
    probes = {}
    for name, x in (("loose", loose), ("tight", tight)):
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        rows = [(i, v.tolist()) for i, v in enumerate(x)]
        index = ann.build(frame(spark, rows), "id", "vector")
        queries = rows[::50]
        found = index.search(frame(spark, queries), 20, "id", "vector", rerank=120).collect()
        assert recall(found, rows, queries, 20) >= 0.9, name
        probes[name] = index.quantizer.n_probe / len(index.quantizer.centroids)
    assert probes["tight"] < 0.1 < probes["loose"]


def test_ivf_index_holds_every_row_once_in_its_list(spark):
    rng = np.random.default_rng(9)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(500, 8)))] + [(1000 + i, [1.0] * 8) for i in range(300)]
    index = ann.build(frame(spark, rows), "id", "vector", parts=4)
    q, seen = index.quantizer, []
    assert len(np.unique(q.centroids, axis=0)) == len(q.centroids)
    for r in index.shards.collect():
        ids, x = ann.vectors.unpack(r.ids, r.vectors, 8)
        ends, codes = np.frombuffer(r.ends, np.int64), np.frombuffer(r.codes, np.uint8).reshape(-1, len(ids))
        lists = np.searchsorted(ends, np.arange(len(ids)), "right")
        assert (lists == q.assign(x)).all() and (codes == q.encode(x, lists)).all()
        seen += ids.tolist()
        # a table's sum is the inner product with what the codes stand for
        query = rng.normal(size=8)
        restored = q.centroids[lists] + np.concatenate([b[c] for b, c in zip(q.codebooks, codes)], axis=1)
        by_table = q.centroids[lists] @ query + sum(t[c] for t, c in zip(q.tables(query), codes))
        assert np.allclose(by_table, restored @ query)
    assert sorted(seen) == sorted(i for i, _ in rows)


def test_ivf_odd_rows_and_few_vectors(spark):
    none = frame(spark, [])
    assert ann.search(none, none, 5).collect() == []
    rows = frame(spark, [(1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, [0.0, 0.0]), (4, None), (5, [NAN, 1.0]), (6, [-1.0, 0.0]), (6, [-1.0, 0.0]), (7, [1.0])])
    got = [tuple(r) for r in ann.search(rows, rows.where("id in (1, 3, 4, 5)"), 20, reach=1.0).orderBy("rank").collect()]
    assert got == [(1, 1, 2, 0.5), (1, 2, 6, -1.0), (1, 3, 6, -1.0)]


def test_ivf_splits_equal_vectors_over_shards(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD_ROWS", 16)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 2)
    rows = frame(spark, [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(100)])
    assert ann.build(rows).shards.count() >= 7
    got = ann.search(rows, rows.where(F.col("id") < 5), 3).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id) for r in got if r.query_id < 2] == [(0, 1), (0, 2), (0, 3), (1, 0), (1, 2), (1, 3)]
