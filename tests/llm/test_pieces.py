import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from leafloom.llm import common, pieces

TEXTS = ["Hello  world\n\tabc é ñ 漢字  ", " lead", "a" * 300, "   ", "", "x ▁ y▁z", "tab\tend ", "🙂🙂 emoji" * 30, "abcdefghij" * 40, "\x00 nul", "The quick brown fox " * 50]


def run(texts, rate, seed=1):
    v, out = pieces.load(pieces.MODEL), []
    for first, end, data, offsets in common.byte_chunks(pa.array(texts, pa.string())):
        tokens, at = pieces.encode(v, data, offsets, np.zeros(end - first, np.int64), rate, seed)
        back, back_at = pieces.decode(v, tokens, at)
        out += [(tokens[at[i] : at[i + 1]].tolist(), back[back_at[i] : back_at[i + 1]].tobytes().decode()) for i in range(end - first)]
    return out


def test_without_dropout_it_is_the_library_s_segmentation():
    sp = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=pieces.MODEL)
    for text, (tokens, back) in zip(TEXTS, run(TEXTS, 0.0), strict=True):
        assert back == text
        if "▁" not in text and "\x00" not in text:
            assert tokens == sp.encode(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=80), max_size=6), st.sampled_from([0.0, 0.1, 0.5, 1.0]), st.integers(0, 5))
def test_any_text_comes_back(texts, rate, seed):
    assert [back for _, back in run(texts, rate, seed)] == texts


def test_the_heap_and_the_rounds_agree(monkeypatch):
    a = run(TEXTS, 0.2)
    monkeypatch.setattr(pieces, "HEAP_FROM", 0)
    assert run(TEXTS, 0.2) == a


def test_brute_force_agenda():
    v, seed, rate = pieces.load(pieces.MODEL), 3, 0.3
    names = {p: i for i, p in enumerate(v.pieces) if v.rank[i] < 31741}
    for text in ("international", "segmentation of words", "zzz unhappiness"):
        got = run([text], rate, seed)[0][0]
        want = []
        for word in text.split(" "):
            data = (" " + word).encode()
            key = common.word_hashes(np.frombuffer(data, np.uint8), np.array([0]), np.array([len(data)])) ^ common.stable_hash(np.zeros(1, np.uint64), seed)
            spans = [(i, i + 1) for i in range(len(data))]
            while True:
                options = []
                for (a, b), (_, c) in zip(spans, spans[1:]):
                    piece = names.get(data[a:c])
                    if piece is not None and not pieces.dropped(key, np.array([a]), np.array([b]), np.array([c]), pieces._limit(rate))[0]:
                        options.append((int(v.rank[piece]), a, b, c))
                if not options:
                    break
                _, a, b, c = min(options)
                spans = sorted([s for s in spans if s not in ((a, b), (b, c))] + [(a, c)])
            want += [names[data[a:b]] for a, b in spans]
        assert got == want


def test_frames_vary_by_document_and_handle_odd_rows(spark):
    rows = [(i, "international segmentation of considerable unhappiness", [1], 5) for i in range(40)] + [(100, None, None, 5), (101, "", None, 5), (None, "x", None, 5), (7, "long text " * 100_000, None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tokens array<int>, n_tokens int")
    out = pieces.encoded(docs)
    got = out.collect()
    assert len({tuple(r.tokens) for r in got[:40]}) > 1
    assert all(r.round_trip for r in got if r.doc_id != 100)
    assert [(r.tokens, r.n_tokens, r.round_trip) for r in got if r.doc_id in (100, 101)] == [(None, 0, None), ([], 0, True)]
    assert [r.text for r in pieces.decoded(out.drop("text")).collect()] == [r[1] for r in rows]
    assert [r.tokens for r in pieces.encoded(docs).collect()] == [r.tokens for r in got]
    assert pieces.encoded(docs.limit(0)).collect() == []


def test_every_document_and_every_place_has_its_own_draws(spark):
    rows = [(i, " unhappiness international" * 20) for i in range(60)]
    got = pieces.encoded(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.round_trip for r in got)
    assert len({tuple(r.tokens) for r in got}) == 60
    assert all(len(r.tokens) % 20 or r.tokens != r.tokens[: len(r.tokens) // 20] * 20 for r in got)


def test_repeats_of_a_word_are_drawn_at_the_rate():
    v, n = pieces.load(pieces.MODEL), 4000
    for rate in (0.1, 0.4):
        data = np.frombuffer(b"a" + b" a" * (n - 1), np.uint8)  # each is one candidate: the space with the letter
        tokens, at = pieces.encode(v, data, np.array([0, len(data)]), np.array([5]), rate, 23, by_place=True)
        split = len(tokens) - n
        assert abs(split / n - rate) < 4 * (rate * (1 - rate) / n) ** 0.5
    word = np.frombuffer(b" unhappiness" * 400, np.uint8)
    tokens, _ = pieces.encode(v, word, np.array([0, len(word)]), np.array([5]), 0.1, 23, by_place=True)
    text = " ".join(map(str, tokens.tolist()))
    plain, _ = pieces.encode(v, word, np.array([0, len(word)]), np.array([5]), 0.0, 23)
    assert len(plain) < len(tokens)
    one = " ".join(map(str, plain[len(plain) // 400 : 2 * len(plain) // 400].tolist()))
    assert 0 < text.count(one) < 300
