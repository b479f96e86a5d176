import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from leafloom.llm import jaccard

SCHEMA = "doc_id long, text string, grams array<string>, size int, component_id long"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def shingles(text, n):
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)}


def brute(rows, n, num, den):
    sets = [(i, shingles(t, n)) for i, t in rows]
    up = {i: i for i, _ in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for (i, a), (j, b) in combinations(sets, 2):
        if a and b and den * len(a & b) >= num * len(a | b):
            x, y = sorted((root(i), root(j)))
            up[y] = x
    return sorted((i, len(s), root(i)) for i, s in sets)


def corpus(seed, docs=60):
    rng = random.Random(seed)
    vocabulary = [f"W{i}" for i in range(40)]
    shared = " ".join(rng.choices(vocabulary, k=12))
    out = []
    for g in range(docs // 6):
        base = rng.choices(vocabulary, k=rng.randint(1, 60))
        for _ in range(6):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            out.append(" ".join(w) + (" " + shared if rng.random() < 0.3 else ""))
    return list(enumerate(out, 10))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, ["x"], 3, 7) for i, t in rows], SCHEMA)


@pytest.mark.parametrize("seed,n,num,den", [(1, 3, 9, 10), (2, 5, 4, 5), (3, 2, 1, 2)])
def test_components_equal_brute_force(spark, seed, n, num, den):
    rows = corpus(seed) + [(1000, None), (1001, ""), (1002, " \n\t "), (1003, "One TWO"), (1004, "one two"), (1005, "É é")]
    assert sorted(map(tuple, jaccard.near_duplicates(frame(spark, rows), n, num, den).collect())) == brute(rows, n, num, den)


def test_shards_of_long_lists_and_large_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "LIST_ROWS", 4)
    rows = corpus(4)
    got = jaccard.near_duplicates(frame(spark, rows), 3, 4, 5, task_grams=60)
    assert sorted(map(tuple, got.collect())) == brute(rows, 3, 4, 5)


def test_empty_table_repeats_and_null_ids(spark):
    assert jaccard.near_duplicates(frame(spark, [])).collect() == []
    text = "a b c d e f g h"
    got = jaccard.near_duplicates(frame(spark, [(5, text), (5, text), (3, text), (None, text), (None, "other words")])).collect()
    assert Counter(map(tuple, got)) == Counter([(5, 4, 3), (5, 4, 3), (3, 4, 3), (None, 4, 3), (None, 1, None)])


def test_one_of_each_group_stays(spark):
    rows = corpus(5) + [(2000, None), (2001, ""), (None, "x y z")]
    kept = {r.doc_id for r in jaccard.keep_one(frame(spark, rows), 3, 4, 5).collect()}
    assert kept == {c for i, _, c in brute([r for r in rows if r[0] is not None], 3, 4, 5)} | {None}


def test_a_very_long_text(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, long), (2, long + " tail"), (3, long[:100_000])]
    assert sorted(map(tuple, jaccard.near_duplicates(frame(spark, rows), 3, 9, 10).collect())) == brute(rows, 3, 9, 10)


def test_merge_skip_counts_like_a_counter():
    rng = random.Random(7)
    for _ in range(200):
        lists = [sorted(rng.sample(range(30), rng.randint(1, 15))) for _ in range(rng.randint(1, 8))]
        need = rng.randint(1, 6)
        counts = Counter(x for one in lists for x in one)
        got = jaccard.merge_skip([(len(x), 0, len(x), x) for x in lists], need)
        assert got == sorted((x, c) for x, c in counts.items() if c >= need)


def test_bitmaps_never_overstate_the_difference():
    rng = np.random.default_rng(3)
    for _ in range(100):
        a = np.unique(rng.integers(0, 2**63, rng.integers(1, 400), dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.8], rng.integers(0, 2**63, 20, dtype=np.uint64)]))
        x, y = (np.frombuffer(jaccard.parity(s), np.uint64)[None] for s in (a, b))
        w = min(x.shape[1], y.shape[1])
        assert np.bitwise_count(jaccard.folded(x, w) ^ jaccard.folded(y, w)).sum() <= len(np.setxor1d(a, b))


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (500, 500)], "a long, b long")
    got = {r.id: r.root for r in jaccard.components(edges).collect()}
    assert got == {i: 0 for i in range(201)} | {500: 500, 501: 500}


def test_keep_one_takes_columns_of_any_type(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(3, text, {"a": 1}, [1.0]), (2, text, {"b": 2}, None), (2, text, {"a": 2}, [2.0]), (None, text, None, None), (None, None, None, None), (9, None, {}, [])]
    df = spark.createDataFrame(rows, "doc_id long, text string, m map<string,int>, _row array<double>")
    got = sorted(map(tuple, jaccard.keep_one(df).collect()), key=str)
    same = [(None, text, None, None), (None, None, None, None), (9, None, {}, [])]
    assert got in [sorted([two, *same], key=str) for two in ((2, text, {"a": 2}, [2.0]), (2, text, {"b": 2}, None))]
    assert got == sorted(map(tuple, jaccard.keep_one(df.repartition(5)).collect()), key=str)
    assert jaccard.keep_one(df.limit(0)).collect() == []
