"""Language identification by a linear-chain conditional random field over the words of a text.

A word's emission scores are sums of hashed weights of its affixes (n-grams that touch the word's ends), inner n-grams
and, for words of the training lexicon, the word itself. Learned transitions join neighbouring words; forward-backward
gives each word's label distribution, so a text may switch languages. A document's language is the one with the
largest expected number of words.

Inference runs whole batches as one chain that starts anew at every document: the chain is cut into equal pieces whose
transfer matrices are multiplied in step, so documents of any length cost the same per word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafloom.llm import common

#: Hashed weights; labelled documents per language, in whole, that the model is fitted on, at most.
BUCKETS, FIT_DOCS = 1 << 18, 400
#: Words in a training sequence, sequences, passes, and occurrences that put a word into the lexicon.
SEQUENCE, SEQUENCES, EPOCHS, LEXICON_LEAST = 40, 4000, 30, 3
#: Text bytes at once; every byte takes some hundred bytes of work arrays.
CHUNK_BYTES = 1 << 20
#: Sizes of byte n-grams with the word's ends marked.
GRAMS = (2, 3, 4, 5)


def _lower(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(texts, ""))


def features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed feature ids of words, one after the other, and where each word's begin (one more at the end)."""
    n = len(starts)
    lengths = ends - starts
    firsts = np.cumsum(lengths + 2) - (lengths + 2)
    buffer = np.zeros(int((lengths + 2).sum()) + max(GRAMS), np.uint64)
    within = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    buffer[np.repeat(firsts + 1, lengths) + within] = data[np.repeat(starts, lengths) + within] + 1
    counts = [np.maximum(lengths + 2 - g + 1, 0) for g in GRAMS]
    in_lexicon = np.isin(hashes, lexicon)
    per_word = sum(counts) + 1
    begins = np.concatenate([[0], np.cumsum(per_word)])
    out = np.zeros(int(begins[-1]), np.int64)
    at = begins[:-1].copy()
    for g, m in zip(GRAMS, counts, strict=True):
        code = np.zeros(len(buffer) - g + 1, np.uint64)
        for k in range(g):
            code = code * np.uint64(257) + buffer[k : len(buffer) - g + 1 + k]
        step = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
        grams = common.stable_hash(code[np.repeat(firsts, m) + step], g)
        if g > 4:  # the longest n-grams count as affixes only: those that touch an end
            inner = (step > 0) & (step < np.repeat(m, m) - 1)
            grams[inner] = common.stable_hash(np.zeros(1, np.uint64), 99)
        out[np.repeat(at, m) + step] = (grams & np.uint64(BUCKETS - 1)).astype(np.int64)
        at += m
    word = common.stable_hash(hashes, 77)
    word[~in_lexicon] = common.stable_hash(np.zeros(1, np.uint64), 98)  # all words outside share a feature
    out[at] = (word & np.uint64(BUCKETS - 1)).astype(np.int64)
    return out, begins if n else np.zeros(1, np.int64)


_LETTER = np.zeros(256, np.int64)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1


@dataclass
class Crf:
    """Labels, emission weights (buckets x labels), start and transition scores, and the lexicon's word hashes."""

    labels: list[str]
    weights: np.ndarray
    start: np.ndarray
    moves: np.ndarray
    lexicon: np.ndarray

    def emissions(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Emission scores of each word, and whether it has a letter; words without get even scores."""
        if not len(starts):
            return np.zeros((0, len(self.labels))), np.zeros(0, bool)
        hashes, one, inverse = np.unique(common.word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        s, e = starts[one], ends[one]
        ids, begins = features(data, s, e, hashes, self.lexicon)
        score = np.add.reduceat(self.weights[ids], begins[:-1], axis=0).astype(np.float64)
        letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
        has = letters[e] > letters[s]
        score[~has] = 0
        return score[inverse], has[inverse]

    def marginals(self, scores: np.ndarray, opens: np.ndarray, pieces: int | None = None) -> np.ndarray:
        """Label distributions of the words of a chain that starts anew at the positions ``opens``."""
        return forward_backward(scores, opens, self.start, self.moves, pieces)


def forward_backward(scores: np.ndarray, opens: np.ndarray, start: np.ndarray, moves: np.ndarray, pieces: int | None = None) -> np.ndarray:
    """Exact posteriors of a chain by transfer matrices: pieces of it advance side by side, then are linked up."""
    n, k = scores.shape
    if not n:
        return scores
    step = max(1, int(np.ceil(n / (pieces or max(1, int(np.sqrt(n) * 2))))))
    m = -(-n // step)
    emit = np.ones((m * step, k))
    emit[:n] = np.exp(scores - scores.max(1, keepdims=True))
    fresh = np.zeros(m * step, bool)
    fresh[opens[opens < n]] = True
    fresh[0] = True
    fresh[n:] = True  # what fills the last piece says nothing about the words before it
    emit, fresh = emit.reshape(m, step, k), fresh.reshape(m, step)
    go, begin = np.exp(moves - moves.max()), np.exp(start - start.max())
    # each piece's matrix: rows are the label before the piece, columns the label at its end
    total = np.broadcast_to(np.eye(k), (m, k, k)).copy()
    for t in range(step):
        moved = total @ go
        f = fresh[:, t]
        moved[f] = total[f].sum(2, keepdims=True) * begin
        total = moved * emit[:, t, None, :]
        total /= total.max((1, 2), keepdims=True)
    before = np.zeros((m, k))
    v = np.full(k, 1.0 / k)
    for b in range(m):
        before[b] = v
        v = v @ total[b]
        v /= v.sum()
    after = np.zeros((m, k))
    v = np.ones(k)
    for b in range(m - 1, -1, -1):
        after[b] = v
        v = total[b] @ v
        v /= v.sum()
    alpha = np.zeros((m, step, k))
    v = before
    for t in range(step):
        moved = np.where(fresh[:, t, None], begin, v @ go)
        v = moved * emit[:, t]
        v /= v.sum(1, keepdims=True)
        alpha[:, t] = v
    beta = after
    for t in range(step - 1, -1, -1):
        alpha[:, t] *= beta
        beta = beta * emit[:, t]
        beta = np.where(fresh[:, t, None], (beta @ begin)[:, None], beta @ go.T)
        beta = beta / beta.sum(1, keepdims=True)
    out = alpha.reshape(m * step, k)[:n]
    return out / out.sum(1, keepdims=True)


def _pairwise(scores: np.ndarray, start: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors (sequences x steps x labels) of equal sequences, and the expected transition counts."""
    s, t, k = scores.shape
    emit = np.exp(scores - scores.max(2, keepdims=True))
    go = np.exp(moves)
    alpha, beta = np.zeros((s, t, k)), np.ones((s, t, k))
    alpha[:, 0] = np.exp(start) * emit[:, 0]
    alpha[:, 0] /= alpha[:, 0].sum(1, keepdims=True)
    for i in range(1, t):
        alpha[:, i] = (alpha[:, i - 1] @ go) * emit[:, i]
        alpha[:, i] /= alpha[:, i].sum(1, keepdims=True)
    for i in range(t - 2, -1, -1):
        beta[:, i] = (beta[:, i + 1] * emit[:, i + 1]) @ go.T
        beta[:, i] /= beta[:, i].sum(1, keepdims=True)
    gamma = alpha * beta
    gamma /= gamma.sum(2, keepdims=True)
    pair = np.zeros((k, k))
    for i in range(1, t):
        x = alpha[:, i - 1, :, None] * go * (beta[:, i] * emit[:, i])[:, None, :]
        pair += (x / x.sum((1, 2), keepdims=True)).sum(0)
    return gamma, pair


def fit(texts: list[str], langs: list[str], seed: int = 5) -> Crf:
    """A model from texts of one language each: training sequences switch between them at random."""
    labels = sorted(set(langs))
    k = len(labels)
    if not k:
        return Crf([], np.zeros((BUCKETS, 1), np.float32), np.zeros(1), np.zeros((1, 1)), np.zeros(0, np.uint64))
    rng = np.random.default_rng(seed)
    array = _lower(pa.array(texts, pa.string())).cast(pa.large_binary())
    data = np.frombuffer(b"".join(array.to_pylist()), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in array.to_pylist()])]).astype(np.int64)
    starts, ends, firsts = common.word_spans(data, offsets)
    if not len(starts):
        return Crf(labels, np.zeros((BUCKETS, k), np.float32), np.zeros(k), np.zeros((k, k)), np.zeros(0, np.uint64))
    hashes, one, word, seen = np.unique(common.word_hashes(data, starts, ends), return_index=True, return_inverse=True, return_counts=True)
    lexicon = hashes[seen >= LEXICON_LEAST]
    label_of = np.array([labels.index(x) for x in langs])
    by_label = [np.flatnonzero((label_of == c) & (np.diff(firsts) > 0)) for c in range(k)]
    usable = [c for c in range(k) if len(by_label[c])]
    x, y = np.zeros((SEQUENCES, SEQUENCE), np.int64), np.zeros((SEQUENCES, SEQUENCE), np.int64)
    for s in range(SEQUENCES):
        at = 0
        while at < SEQUENCE:  # a stretch of a document, then of another; half of the sequences hold one language
            c = usable[rng.integers(len(usable))]
            d = by_label[c][rng.integers(len(by_label[c]))]
            run = SEQUENCE if s % 2 else int(rng.integers(3, 20))
            a = int(rng.integers(firsts[d], firsts[d + 1]))
            got = word[a : min(a + run, int(firsts[d + 1]), a + SEQUENCE - at)]
            x[s, at : at + len(got)], y[s, at : at + len(got)] = got, c
            at += len(got)
    # features of the words in the sequences, so that very long texts cost no more
    drawn, x = np.unique(x, return_inverse=True)
    x, hashes, one = x.reshape(y.shape), hashes[drawn], one[drawn]
    ids, begins = features(data, starts[one], ends[one], hashes, lexicon)
    owner = np.repeat(np.arange(len(hashes), dtype=np.int32), np.diff(begins))
    weights, start, moves = np.zeros((BUCKETS, k)), np.zeros(k), np.zeros((k, k))
    used = np.flatnonzero(np.bincount(ids, minlength=BUCKETS))
    place = np.zeros(BUCKETS, np.int32)
    place[used] = np.arange(len(used))
    compact = place[ids]
    del ids
    w = np.zeros((len(used), k))
    params = [w, start, moves]
    squares = [np.full(p.shape, 1e-6) for p in params]
    truth = np.eye(k)[y]
    true_pairs = np.zeros((k, k))
    np.add.at(true_pairs, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
    for _ in range(EPOCHS):
        # a label at a time, so that no array holds all features of all labels
        emission = np.stack([np.add.reduceat(w[:, c].astype(np.float32)[compact], begins[:-1]) for c in range(k)], 1).astype(np.float64)
        gamma, pair = _pairwise(emission[x], start, moves)
        rest = truth - gamma
        per_word = np.stack([np.bincount(x.ravel(), rest[..., c].ravel(), len(hashes)) for c in range(k)], 1)
        grads = [np.stack([np.bincount(compact, per_word[:, c].astype(np.float32)[owner], len(used)) for c in range(k)], 1) - 1.0 * w, rest[:, 0].sum(0) - start, true_pairs - pair - moves]
        for p, g, q in zip(params, grads, squares, strict=True):
            q += g * g
            p += 0.3 * g / np.sqrt(q)
    weights[used] = w
    return Crf(labels, weights.astype(np.float32), start, moves, lexicon)


def training_rows(docs: DataFrame, per_lang: int = FIT_DOCS) -> DataFrame:
    """(lang, text): up to ``per_lang`` different labelled texts of each language, those of the smallest hashes.

    The hashes are chosen without the texts: only a share of all hashes in which four times the sample can be expected
    is ranked, so the ranked rows do not grow with the table, whatever a language's share of it.
    """
    rows = docs.where("lang is not null and text is not null").select(F.col("lang").cast("string").alias("lang"), F.xxhash64("text").alias("_h"), "text")
    place = F.pmod("_h", F.lit(1 << 40))
    hashes = rows.select("lang", "_h")
    different = hashes.groupBy("lang").agg(F.approx_count_distinct("_h").alias("_d"))  # a row a language
    near = hashes.join(common.small(different), "lang").where(place * F.col("_d") < 4.0 * per_lang * (1 << 40)).select("lang", "_h").distinct()
    by = W.partitionBy("lang").orderBy(place, "_h")
    chosen = near.withColumn("_n", F.row_number().over(by)).where(F.col("_n") <= per_lang).select("lang", "_h")
    found = rows.join(common.small(chosen), ["lang", "_h"])
    return found.groupBy("lang", "_h").agg(F.min("text").alias("text")).select("lang", "text")


def identify(docs: DataFrame, train: DataFrame, with_spans: bool = False) -> DataFrame:
    """``docs`` with lang_pred string and score double (and spans), by a model fitted on ``train`` (text, lang).

    lang_pred is a language of ``train``, or ``und`` where the text is null or has no letter, or nothing was learned.
    score is the expected share of its words among the words with letters, 0 for ``und``. ``spans`` lists the runs of
    words by their likeliest label: (first word, words, lang). Only the text takes part in a prediction; whole texts are
    read. Columns of ``docs`` named like the new ones are replaced. Rows that repeat get the same answer; an empty
    table stays empty.
    """
    spark = docs.sparkSession
    # FIT_DOCS texts of each language
    model = common.fitted(training_rows(train), lambda rows: fit([t for _, t in rows], [c for c, _ in rows]))
    shared = spark.sparkContext.broadcast(model)
    span = "array<struct<first_word:long,words:long,lang:string>>"
    new = {"lang_pred": "string", "score": "double"} | ({"spans": span} if with_spans else {})
    kept = [c for c in docs.columns if c not in new]

    def run(batches):
        crf = shared.value
        for batch in batches:
            texts = _lower(batch.column(0))
            for first, end, data, offsets in common.byte_chunks(texts, CHUNK_BYTES):
                rows = end - first
                starts, ends, firsts = common.word_spans(data, offsets)
                names, best, share, runs = ["und"] * rows, np.zeros(rows), None, [[] for _ in range(rows)]
                if crf.labels and len(starts):
                    scores, has = crf.emissions(data, starts, ends)
                    got = crf.marginals(scores, firsts[:-1])
                    row_of = np.repeat(np.arange(rows), np.diff(firsts))
                    share = np.stack([np.bincount(row_of, got[:, c] * has, rows) for c in range(len(crf.labels))], 1)
                    total = share.sum(1)
                    top = share.argmax(1)
                    best = np.where(total > 0, share[np.arange(rows), top] / np.maximum(total, 1e-300), 0.0)
                    best = np.clip(best, 0, 1)
                    names = [crf.labels[i] if t > 0 else "und" for i, t in zip(top.tolist(), total.tolist(), strict=True)]
                    if with_spans:
                        likely = got.argmax(1)
                        for r in range(rows):
                            own = likely[firsts[r] : firsts[r + 1]]
                            cuts = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)] if len(own) else []
                            runs[r] = [{"first_word": a, "words": b - a, "lang": crf.labels[own[a]]} for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                columns = [c.slice(first, rows) for c in batch.columns[1:]] + [pa.array(names, pa.string()), pa.array(best)]
                if with_spans:
                    columns.append(pa.array(runs, pa.list_(pa.struct([("first_word", pa.int64()), ("words", pa.int64()), ("lang", pa.string())]))))
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *new])

    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept] + [f"{c} {t}" for c, t in new.items()])
    read = F.when(F.col("text").rlike(r"\p{L}"), F.col("text")).alias("_read")
    return docs.select(read, *kept).mapInArrow(run, schema)


def op2_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the folds other than 2 of 4."""
    docs = common.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    held = F.coalesce(common.crc_fold(F.col("doc_id"), 4) == 2, F.lit(False))
    out = identify(docs.select("doc_id", held.alias("held_out"), "text"), docs.where(~held))
    return out.select("doc_id", "held_out", "lang_pred", "score")
