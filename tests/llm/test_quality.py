import numpy as np

from leafloom.llm import quality


def test_likelihood_separates_grades_and_orders_thresholds():
    rng = np.random.default_rng(1)
    filler = [f"word{i}" for i in range(50)]
    texts, grades = [], []
    for i in range(300):
        g = i % 3
        texts.append(" ".join([*rng.choice(filler, 30), *(["awful junk"] if g == 0 else ["rude"] if g == 1 else [])]))
        grades.append(g)
    model = quality.fit(texts, grades, 3)
    assert model.cuts[0] < model.cuts[1]
    data = [t.encode() for t in (" ".join(filler[:30]) + x for x in (" awful junk", " rude", ""))]
    at = np.cumsum([0] + [len(d) for d in data]).astype(np.int64)
    tails = model.tails(model.position(3, *quality.features(np.frombuffer(b"".join(data), np.uint8), at)))
    assert (tails[:, 0] >= tails[:, 1]).all() and tails.sum(1).argsort().tolist() == [0, 1, 2]


def _plain(texts):
    """A dense matrix of the hashed features of texts."""
    at = np.cumsum([0] + [len(t.encode()) for t in texts]).astype(np.int64)
    row, bucket, value = quality.features(np.frombuffer("".join(texts).encode(), np.uint8), at)
    x = np.zeros((len(texts), quality.BUCKETS))
    np.add.at(x, (row, bucket), value)
    return x


def test_the_fit_is_the_optimum_of_the_penalised_likelihood():
    """Against the likelihood by its definition: its numeric gradient vanishes at the fit, and no step lowers it."""
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(8)]
    texts, grades = [], []
    for i in range(60):
        g = int(rng.integers(0, 3))
        texts.append(" ".join([*rng.choice(words, 6), *(["bad"] * (2 - g)), *(["fine"] * g)]))
        grades.append(g)
    model = quality.fit(texts, grades, 3)
    x = _plain(texts)
    used = np.flatnonzero((x != 0).sum(0) >= quality.LEAST_ROWS)
    assert not model.weights[np.setdiff1d(np.arange(quality.BUCKETS), used)].any()
    x = x[:, used]

    def negative(w, cuts):
        total = quality.PENALTY / 2 * (w**2).sum()
        for row, g in zip(x, grades):
            below = [0.0, *(1 / (1 + np.exp(-(c - row @ w))) for c in cuts), 1.0]
            total -= np.log(below[g + 1] - below[g])
        return total

    w, cuts = model.weights[used].astype(float), np.array(model.cuts, float)
    best, step = negative(w, cuts), 1e-4
    for i in rng.choice(len(used), 12, replace=False):
        e = np.zeros(len(used))
        e[i] = step
        assert abs(negative(w + e, cuts) - negative(w - e, cuts)) / (2 * step) < 0.02 * len(texts)
    for _ in range(20):
        assert negative(w + rng.normal(0, 0.05, len(w)), cuts + rng.normal(0, 0.05, 2)) > best - 1e-3 * best
    # tail probabilities and the expected grade by their definition
    tails = model.tails(x @ w)
    assert np.allclose(tails, 1 / (1 + np.exp(-(x @ w)[:, None] + cuts[None, :])))


def test_absent_and_null_documents_take_no_place_of_the_sample(spark):
    docs = spark.createDataFrame([(i, f"good text {i}") for i in range(10)] + [(50, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(500)] + [(None, 1, 0)] * 50, "doc_id long, quality int, toxic int")
    seen = []
    real, quality.common.fitted = quality.common.fitted, lambda df, f: seen.append(df.count()) or real(df, f)
    try:
        quality.learn(docs, labels, rows=8)
    finally:
        quality.common.fitted = real
    assert seen == [8]


def test_odd_rows_and_tables(spark):
    docs = spark.createDataFrame([(1, None, 5.0), (2, "", 5.0), (3, "good text here " * 50_000, 5.0), (3, "good text here " * 50_000, 5.0), (None, "bad", None)], "doc_id long, text string, p_clean double")
    labels = spark.createDataFrame([(3, 1, 0), (3, 1, None), (None, 1, 0), (2, None, 1), (1, 0, 0)], "doc_id long, quality int, toxic int")
    model = quality.learn(docs, labels)
    got = quality.grade(docs, model).collect()
    assert len(got) == 5 and all(0 <= r.p_clean <= r.p_good <= 1 and abs(r.expected_grade - r.p_good - r.p_clean) < 1e-12 for r in got)
    assert got[0][1:] == got[1][1:] or got[0].p_clean == got[1].p_clean  # null like empty
    unlearned = quality.learn(docs, labels.limit(0))
    assert all(abs(r.p_clean - 0.5) < 1e-9 for r in quality.grade(docs, unlearned).collect())
    assert quality.grade(docs.limit(0), model).collect() == []


def test_lowest_of_repeated_ratings_counts(spark):
    docs = spark.createDataFrame([(1, "a", 7), (2, "b", 7), (3, "c", 7)], "doc_id long, text string, grade int")
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (2, 0, 0), (2, 1, 0), (3, 1, None)], "doc_id long, quality int, toxic int")
    assert sorted((r.doc_id, r.grade) for r in quality.rated(docs, labels).collect()) == [(1, 1), (2, 0), (3, 2)]


def test_selection_keeps_clean_and_drops_rated_down(spark, sf):
    rows = {r.doc_id: r.keep for r in quality.op3_ordinal_quality(spark, sf).collect()}
    labels = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.doc_id in rows]
    clean = [rows[r.doc_id] for r in labels if r.quality == 1 and r.toxic == 0]
    bad = [rows[r.doc_id] for r in labels if r.quality == 0 or r.toxic == 1]
    assert np.mean(clean) >= 0.97 and np.mean(bad) <= 0.1
