from itertools import product

import numpy as np
import pytest

from leafloom.llm import langid


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(2)
    scores, start, moves = rng.normal(size=(7, 3)), rng.normal(size=3), rng.normal(size=(3, 3))
    opens = np.array([0, 3])
    want = np.zeros((7, 3))
    for a, b in ((0, 3), (3, 7)):
        for path in product(range(3), repeat=b - a):
            s = start[path[0]] + sum(moves[x, y] for x, y in zip(path, path[1:])) + sum(scores[a + t, c] for t, c in enumerate(path))
            for t, c in enumerate(path):
                want[a + t, c] += np.exp(s)
    want /= want.sum(1, keepdims=True)
    for pieces in (1, 2, 3, 7):
        assert np.allclose(langid.forward_backward(scores, opens, start, moves, pieces), want)


TRAIN = [("en", "the cat and the dog are on the mat with that thing " * 4), ("de", "der hund und die katze sind auf der matte mit dem ding " * 4)] * 20


def test_code_switching_is_labelled_word_by_word(spark):
    train = spark.createDataFrame(TRAIN, "lang string, text string")
    docs = spark.createDataFrame([(1, "the cat and the dog der hund und die katze")], "doc_id long, text string")
    row = langid.identify(docs, train, with_spans=True).first()
    assert [(s.first_word, s.words, s.lang) for s in row.spans] == [(0, 5, "en"), (5, 5, "de")]
    assert 0.3 < row.score < 0.7


def test_odd_rows_have_defined_answers(spark):
    train = spark.createDataFrame(TRAIN + [(None, "x"), ("fr", None)], "lang string, text string")
    long = "die katze und der hund " * 20_000
    docs = spark.createDataFrame([(1, None, "q", 9.0), (2, "", "q", 9.0), (3, "12 34 !!", "q", 9.0), (4, long, "q", 9.0), (4, long, "q", 9.0), (None, "the dog", None, None)], "doc_id long, text string, lang_pred string, score double")
    got = [(r.doc_id, r.lang_pred, r.score) for r in langid.identify(docs, train).collect()]
    assert sorted(got[:3]) == [(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)]
    assert got[3] == got[4] and got[3][1] == "de" and got[5][:2] == (None, "en")
    assert all(0 <= s <= 1 for _, _, s in got)
    none = spark.createDataFrame([], "lang string, text string")
    assert [r.lang_pred for r in langid.identify(docs, none).collect()] == ["und"] * 6
    assert langid.identify(docs.limit(0), train).collect() == []


@pytest.mark.parametrize("least", [0.97])
def test_held_out_accuracy(spark, sf, least):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = [r for r in langid.op2_crf_language(spark, sf).collect() if r.held_out]
    assert rows and sum(r.lang_pred == truth[r.doc_id] for r in rows) >= least * len(rows)


def test_copies_take_one_place_of_the_sample(spark):
    rows = [(f"text {i}", "en") for i in range(10) for _ in range(20)]
    got = langid.training_rows(spark.createDataFrame(rows, "text string, lang string"), per_lang=8).collect()
    assert len({r.text for r in got}) == len(got) == 8
