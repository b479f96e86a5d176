import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from leafloom.llm import mix


@pytest.fixture(autouse=True)
def short_blocks(monkeypatch):
    """Blocks that suit these small tables."""
    for f in (mix.mix_counts, mix.mix_documents, mix.taken):
        monkeypatch.setattr(f, "__defaults__", (17, 16))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, len(t or ""), "k", 1) for i, t, s in rows], "doc_id long, text string, source string, n_chars long, key string, size int")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_targets(sizes):
    """The excess of full sources, reshared by weight until none is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] >= 2 * sizes[s]}
        if not full:
            return out | share
        for s in full:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def corpus():
    out = []
    for i in range(300):
        s = [None, "a", "b", "é", "Z", "big", "big", "big"][i % 8]
        out.append((i, " ".join(f"w{i}x{j}" for j in range(5 + i * 7 % 90)), s))
    return out + [(900, None, "a"), (901, "", "only-empty"), (902, " \n\t", None), (None, "one two three", "a"), (5, "x y", "b"), (5, "x y", "b")]


def test_targets_taken_and_limits(spark):
    rows = corpus()
    got = mix.mix_counts(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(words(t))
    want = brute_targets(sizes)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(2, 0.01 * want[s])
    assert sorted((str(r.doc_id), r["size"]) for r in got) == sorted((str(i), len(words(t))) for i, t, _ in rows)


def test_reruns_agree_whatever_the_partitions(spark):
    df = frame(spark, corpus())
    a = Counter(map(tuple, mix.mix_counts(df).collect()))
    assert a == Counter(map(tuple, mix.mix_counts(df.repartition(7)).collect()))
    assert a != Counter(map(tuple, mix.mix_counts(df, seed=99).collect()))


def test_permutations_are_bijections(spark):
    df = spark.range(1000).select("id", F.lit(1000).cast("long").alias("n"), F.lit("k").alias("key"), F.lit(0).alias("turn"))
    got = [r.p for r in df.select(mix.permuted(F.col("id"), F.col("n"), mix.rounds(3, "key", "turn")).alias("p")).collect()]
    assert sorted(got) == list(range(1000)) and got != list(range(1000))


def test_documents_hold_what_was_counted(spark):
    df = frame(spark, corpus())
    counts, texts = Counter(), Counter()
    for r in mix.mix_counts(df).collect():
        counts[r.doc_id, r.source] += r.taken
    out = mix.mix_documents(df)
    assert out.columns == df.columns
    source = {}
    for i, t, _ in corpus():
        source.setdefault(i, set()).update(words(t))
    for r in out.collect():
        texts[r.doc_id, r.source] += len(words(r.text))
        assert set(words(r.text)) <= source[r.doc_id] and r.n_chars == len(r.text)
    assert texts == +counts


def test_extra_columns_may_have_any_name_and_type(spark):
    rows = [(i, f"a{i} b c d e f g h", "s", {"k": i}, i, i, i, i, i) for i in range(40)] + [(None, "x y z", "s", None, 1, 1, 1, 1, 1)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, words map<string,int>, parts int, turn int, row int, n int, `all` int")
    out = mix.mix_documents(df)
    assert out.dtypes == df.dtypes
    taken = {r.doc_id: r.taken for r in mix.mix_counts(df).collect() if r.doc_id is not None}
    got = Counter()
    for r in out.collect():
        got[r.doc_id] += len(words(r.text))
        assert (r.words is None and r.parts == 1) if r.doc_id is None else r.words == {"k": r.parts} and r["all"] == r.n == r.row == r.turn == r.doc_id
    assert {k: v for k, v in got.items() if k is not None} == {k: v for k, v in taken.items() if v}


def test_blocks_have_one_length(spark):
    sized = mix.sizes(frame(spark, [(i, " ".join(["w"] * (50 + i)), "ab"[i % 3 == 0]) for i in range(90)]))
    sources = mix.targets(sized, block_words=64)
    parts = mix.pieces(mix.places(sized), sources).groupBy("key", "block").agg(F.sum("words").alias("n")).collect()
    last = {r.key: r.blocks - 1 for r in sources.collect()}
    assert all(r.n == 64 for r in parts if r.block < last[r.key]) and len(parts) == sum(last.values()) + len(last)


def test_long_texts_span_blocks_and_empty_tables(spark):
    rows = [(1, "w " * 20_000, "a"), (2, "v " * 10, "a")]
    got = {r.doc_id: r for r in mix.mix_counts(frame(spark, rows)).collect()}
    assert sum(r.taken for r in got.values()) == pytest.approx(got[1].target, rel=0.01)
    none = frame(spark, [])
    assert mix.mix_counts(none).collect() == [] and mix.mix_documents(none).collect() == []
    blank = frame(spark, [(1, None, None), (2, "", "a")])
    assert [r.taken for r in mix.mix_counts(blank).collect()] == [0, 0] and mix.mix_documents(blank).collect() == []


def test_shard_counts_are_spread(spark):
    sources = spark.createDataFrame([("va", 20_000, 10_000, 5), ("vb", 4_000, 3_000, 5)], "key string, slots long, blocks long, shards long")
    got = mix.draw(sources, 1).collect()
    by = Counter()
    for r in got:
        by[r.key] += r.drawn
    assert by == {"va": 20_000, "vb": 4_000} and len(got) == 10
    assert all(3_600 < r.drawn < 4_400 for r in got if r.key == "va")
