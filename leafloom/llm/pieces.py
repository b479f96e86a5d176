"""SentencePiece BPE encoding with seeded merge-dropout, and decoding.

Encoding starts from characters and works off an agenda of candidate merges, best piece first, leftmost first among
equals. A candidate is the pair of neighbouring symbols over a span; it is skipped for good if a hash keyed by seed,
document, the segment's place in it, segment and span falls under the dropout rate. Skipping gives other segmentations
of the same text from the same merges, and decoding gives the text back byte for byte: bytes outside the vocabulary fall
back to byte pieces, and so does a literal U+2581, which would else read as a space.

No piece of the vocabulary joins a word to the space after it, so a run of spaces with the word behind it is a segment
that is merged by itself. Characters and first pairs are found once for each distinct segment of a batch; every
occurrence then has its own draws. Occurrences advance together in numpy, a column each and one merge each per round;
segments of many symbols use a heap.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafloom.llm import common

#: The vocabulary, dropout rate and seed.
MODEL, RATE, SEED = "/opt/tokenizers/piece_bpe_32k.model", 0.1, 23
#: Text bytes at once; every byte takes some hundred bytes of work arrays.
CHUNK_BYTES = 1 << 20
#: Symbols of a segment from which on a heap is used, and symbols that are merged in one grid.
HEAP_FROM, GRID = 64, 1 << 18
_MARK = "▁"
_NONE = np.int64(1) << 62


@dataclass
class Vocabulary:
    """Pieces as bytes (spaces for the space mark), merge ranks, byte pieces, characters and pairs that merge."""

    pieces: list[bytes]
    rank: np.ndarray
    byte_ids: np.ndarray
    char_codes: np.ndarray
    char_ids: np.ndarray
    pair_keys: np.ndarray
    pair_ids: np.ndarray
    prefix: bool

    def __post_init__(self):
        self.by_rank = np.argsort(self.rank).astype(np.int32)
        # pairs in slots by their hash; those that share a slot with another are looked up in a short sorted list
        self.bits = max(4, 3 + len(self.pair_keys).bit_length())
        slot = self._slot(self.pair_keys)
        self.slot_keys, self.slot_ids = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, -1, np.int64)
        self.slot_keys[slot], self.slot_ids[slot] = self.pair_keys, self.pair_ids
        rest = self.slot_keys[slot] != self.pair_keys
        self.rest_keys, self.rest_ids = np.append(self.pair_keys[rest], _NONE), np.append(self.pair_ids[rest], -1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    @property
    def other(self) -> int:
        """The symbol of a character that is no piece."""
        return len(self.pieces)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that two symbols merge to, -1 if none."""
        key = left.astype(np.int64) * (self.other + 1) + right
        slot = self._slot(key)
        there = self.slot_keys.take(slot)
        out = np.where(there == key, self.slot_ids.take(slot), -1)
        clash = np.flatnonzero((there >= 0) & (there != key))
        i = np.searchsorted(self.rest_keys, key[clash])
        out[clash] = np.where(self.rest_keys[i] == key[clash], self.rest_ids[i], -1)
        return out


def _code(char: bytes) -> int:
    return int.from_bytes(char, "little")


@cache
def load(path: str) -> Vocabulary:
    """The vocabulary of a SentencePiece BPE model with an identity normaliser and byte pieces."""
    from sentencepiece import sentencepiece_model_pb2 as schema

    model = schema.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    pieces, scores, byte_ids, names = [], [], np.full(256, -1, np.int64), {}
    for i, p in enumerate(model.pieces):
        normal = p.type in (schema.ModelProto.SentencePiece.NORMAL, schema.ModelProto.SentencePiece.USER_DEFINED)
        if p.type == schema.ModelProto.SentencePiece.BYTE:
            byte = int(p.piece[3:5], 16)
            byte_ids[byte] = i
            pieces.append(bytes([byte]))
        else:
            pieces.append(p.piece.replace(_MARK, " ").encode() if normal else b"")
        scores.append(p.score if normal else -np.inf)
        if normal:
            names[p.piece] = i
    if (byte_ids < 0).any():
        raise ValueError("the vocabulary has no piece for some byte, so decoding could lose text")
    if any(_MARK in x.lstrip(_MARK) for x in names):
        raise ValueError("pieces with a space behind a word are not supported")
    order = np.argsort(-np.array(scores), kind="stable")
    rank = np.empty(len(pieces), np.int64)
    rank[order] = np.arange(len(pieces))
    pairs = {}
    for text, i in names.items():
        for at in range(1, len(text)):
            if (a := names.get(text[:at])) is not None and (b := names.get(text[at:])) is not None:
                pairs[a * (len(pieces) + 1) + b] = i
    keys = np.array(sorted(pairs), np.int64)
    chars = sorted((_code(t.replace(_MARK, " ").encode()), i) for t, i in names.items() if len(t) == 1)
    return Vocabulary(pieces, rank, byte_ids, np.array([c for c, _ in chars], np.int64), np.array([i for _, i in chars], np.int64), keys, np.array([pairs[k] for k in keys.tolist()], np.int64), model.normalizer_spec.add_dummy_prefix)


def dropped(key: np.ndarray, a: np.ndarray, b: np.ndarray, c: np.ndarray, limit: np.uint64) -> np.ndarray:
    """Whether the candidates over bytes a to b and b to c of segments with hash ``key`` are skipped."""
    span = (a.astype(np.uint64) << np.uint64(42)) ^ (b.astype(np.uint64) << np.uint64(21)) ^ c.astype(np.uint64)
    return common.mix64(key ^ common.mix64(span + np.uint64(0x632BE59BD9B4E019))) < limit


def _limit(rate: float) -> np.uint64:
    return np.uint64(min(max(rate, 0.0), 1.0) * (2**64 - 2**11))


@dataclass
class Forms:
    """Distinct segments: where each one's symbols begin (one more at the end), its bytes, and per symbol the character's
    piece, its first byte in the segment, and what it merges to with the next symbol of the segment (-1: nothing)."""

    first: np.ndarray
    start: np.ndarray
    size: np.ndarray
    symbol: np.ndarray
    at: np.ndarray
    pair: np.ndarray


def _forms(v: Vocabulary, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Forms:
    """The characters of segments and the pairs that they begin with."""
    lengths = ends - starts
    within = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    segment = np.repeat(np.arange(len(starts)), lengths)
    flat = data[np.repeat(starts, lengths) + within]
    first = np.flatnonzero((flat & 0xC0) != 0x80)
    size = np.diff(np.append(first, len(flat)))
    code = np.zeros(len(first), np.int64)
    for k in range(4):
        has = size > k
        code[has] |= flat[first[has] + k].astype(np.int64) << (8 * k)
    i = np.searchsorted(v.char_codes, code)
    i[i == len(v.char_codes)] = 0
    symbol = np.where(v.char_codes[i] == code, v.char_ids[i], v.other)
    symbol[code == _code(_MARK.encode())] = v.other
    own = segment[first]
    pair = np.full(len(symbol), -1, np.int64)
    inner = np.flatnonzero(own[:-1] == own[1:])
    pair[inner] = v.merged(symbol[inner], symbol[inner + 1])
    return Forms(np.searchsorted(own, np.arange(len(starts) + 1)), starts, lengths, symbol, within[first], pair)


def encode_segments(v: Vocabulary, data: np.ndarray, forms: Forms, form: np.ndarray, keys: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of the segments that are of these forms, with their keys, and where each one's begin (one more at the end)."""
    limit = _limit(rate)
    many = np.diff(forms.first)[form]
    done: list[tuple] = []
    low = -1
    for width in (4, 8, 12, 16, 24, 32, HEAP_FROM):
        own = np.flatnonzero((many > low) & (many <= min(width, HEAP_FROM)))
        step = max(1, GRID // (width + 2))
        for x in range(0, len(own), step):
            done += _by_rounds(v, data, forms, own[x : x + step], form, keys, limit, min(width, HEAP_FROM))
        low = min(width, HEAP_FROM)
    for s in np.flatnonzero(many > HEAP_FROM).tolist():
        f = form[s]
        own = slice(forms.first[f], forms.first[f + 1])
        a = forms.at[own]
        sym, a, b = _by_heap(v, forms.symbol[own], a, np.append(a[1:], forms.size[f]), keys[s], limit)
        done.append((np.array([s]), *_with_bytes(v, data, np.array([len(sym)]), sym, forms.start[f] + a, b - a)))
    counts = np.zeros(len(form), np.int64)
    for own, size, _ in done:
        counts[own] = size
    begins = np.concatenate([[0], np.cumsum(counts)])
    tokens = np.empty(int(begins[-1]), np.int32)
    for own, size, got in done:
        tokens[np.repeat(begins[own] - (np.cumsum(size) - size), size) + np.arange(len(got))] = got
    return tokens, begins


def _with_bytes(v: Vocabulary, data: np.ndarray, counts: np.ndarray, sym: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens a segment and the tokens, from symbols: those that are no piece fall back to their bytes."""
    other = sym == v.other
    if not other.any():
        return counts, sym
    size = np.where(other, size, 1)
    tokens = np.repeat(sym, size)
    byte = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(len(tokens))
    fallback = np.repeat(other, size)
    tokens[fallback] = v.byte_ids[data[byte[fallback]]]
    ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(counts)])]
    return np.diff(ends), tokens


def _by_rounds(v: Vocabulary, data: np.ndarray, forms: Forms, own: np.ndarray, form: np.ndarray, keys: np.ndarray, limit: np.uint64, width: int) -> list[tuple]:
    """Segments of up to ``width`` symbols, a column each: a round merges the best candidate of every column.

    A row is a symbol's place; ``following`` and ``before`` link the symbols that are left. Gives (segments, tokens a
    segment, tokens) of the columns as they come to their end. Cells are addressed by row * columns + column.
    """
    f, key = form[own], keys[own]
    count = np.diff(forms.first)[f]
    rows = np.arange(width + 2)[:, None]
    grid = np.minimum(forms.first[f][None, :] + rows, len(forms.symbol) - 1)
    real = rows < count[None, :]
    symbol = np.where(real, forms.symbol[grid], -1)[: width + 1].astype(np.int32)
    at = np.where(real, forms.at[grid], forms.size[f][None, :]).astype(np.int32)
    pair = np.where(rows[:width] < count[None, :] - 1, forms.pair[grid[:width]], -1)
    following = np.broadcast_to(rows[: width + 1] + 1, (width + 1, len(own))).astype(np.int32)
    before = following - 2
    agenda = np.full((width, len(own)), _NONE, np.int64)

    def propose(row, column, nxt, piece, m):
        """Puts merges on the agenda that are not skipped: the symbols in these rows and columns with the next ones."""
        if limit and len(row):
            spans = at.ravel()
            end = following.take(nxt * m + column)
            stay = np.flatnonzero(~dropped(key[column], spans.take(row * m + column), spans.take(nxt * m + column), spans.take(end * m + column), limit))
            row, column, piece = row[stay], column[stay], piece[stay]
        agenda.ravel()[row * m + column] = (v.rank[piece] << np.int64(16)) | row

    cell = np.flatnonzero(pair >= 0)
    row, column = np.divmod(cell, max(len(own), 1))
    propose(row, column, row + 1, pair.take(cell), len(own))
    done = []
    while True:
        best = agenda.min(axis=0) if len(own) else np.zeros(0, np.int64)
        column = np.flatnonzero(best < _NONE)
        left = len(column)
        if not left or 3 * left < 2 * len(own):
            out = np.flatnonzero(best == _NONE)
            sym = symbol[:width].take(out, axis=1).T
            has = sym >= 0
            n = has.sum(axis=1)
            place = at[:width].take(out, axis=1).T[has]
            done.append((own[out], *_with_bytes(v, data, n, sym[has], np.repeat(forms.start[f[out]], n) + place, at[1 : width + 1].take(out, axis=1).T[has] - place)))
            if not left:
                return done
            own, f, key, best = own[column], f[column], key[column], best[column]
            symbol, at, following, before, agenda = (x.take(column, axis=1) for x in (symbol, at, following, before, agenda))
            column = np.arange(left)
        else:
            best = best[column]
        m = len(own)
        links, back, cells = following.ravel(), before.ravel(), symbol.ravel()
        row = best & np.int64(0xFFFF)
        here = row * m + column
        gone = links.take(here) * m + column
        then = links.take(gone).astype(np.int64)
        merged = v.by_rank.take(best >> np.int64(16))
        cells[here] = merged
        cells[gone] = -2
        agenda.ravel()[gone] = _NONE
        agenda.ravel()[here] = _NONE
        links[here] = then
        back[then * m + column] = row
        # the merged symbol with the next, and the one before with the merged
        after = cells.take(then * m + column)
        prior = back.take(here)
        has = np.flatnonzero(prior >= 0)
        prior, beside = prior[has].astype(np.int64), column[has]
        agenda.ravel()[prior * m + beside] = _NONE
        more = np.flatnonzero(after >= 0)
        row, column, nxt = np.concatenate([row[more], prior]), np.concatenate([column[more], beside]), np.concatenate([then[more], row[has]])
        piece = v.merged(np.concatenate([merged[more], cells.take(prior * m + beside)]), np.concatenate([after[more], merged[has]]))
        ok = np.flatnonzero(piece >= 0)
        propose(row[ok], column[ok], nxt[ok], piece[ok], m)


def _by_heap(v: Vocabulary, sym: np.ndarray, a: np.ndarray, b: np.ndarray, key: np.uint64, limit: np.uint64):
    """One segment with an agenda as a heap."""
    n = len(sym)
    sym, b = sym.copy(), b.copy()
    left, right, alive = list(range(-1, n - 1)), [*range(1, n), -1], [True] * n
    agenda: list[tuple[int, ...]] = []

    def push(i: np.ndarray):
        j = np.array([right[x] for x in i.tolist()], np.int64)
        got = v.merged(sym[i], sym[j])
        ok = (got >= 0) & ~(dropped(np.full(len(i), key), a[i], b[i], b[j], limit) if limit else np.zeros(len(i), bool))
        for x, y, p in zip(i[ok].tolist(), j[ok].tolist(), got[ok].tolist(), strict=True):
            heapq.heappush(agenda, (int(v.rank[p]), x, y, int(b[x]), int(b[y]), p))

    push(np.arange(n - 1))
    while agenda:
        _, x, y, bx, by, p = heapq.heappop(agenda)
        if not alive[x] or not alive[y] or b[x] != bx or b[y] != by or right[x] != y:
            continue
        sym[x], b[x], alive[y], right[x] = p, b[y], False, right[y]
        if right[y] >= 0:
            left[right[y]] = x
        around = [i for i in (left[x], x) if i >= 0 and right[i] >= 0]
        if around:
            push(np.array(around, np.int64))
    keep = np.flatnonzero(alive)
    return sym[keep], a[keep], b[keep]


def _prefixed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row that has bytes led by a space."""
    full = np.diff(offsets) > 0
    ahead = np.concatenate([[0], np.cumsum(full)])
    at = offsets + ahead
    out = np.full(int(at[-1]), 0x20, np.uint8)
    out[np.arange(len(data)) + np.repeat(ahead[1:], np.diff(offsets))] = data
    return out, at


def encode(v: Vocabulary, data: np.ndarray, offsets: np.ndarray, variants: np.ndarray, rate: float, seed: int, by_place: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all rows and where each row's begin (one more at the end).

    Skips are keyed by a row's variant and, if ``by_place``, by the segment's number in its row.
    """
    if v.prefix:
        data, offsets = _prefixed(data, offsets)
    space = data == 0x20
    opens = space.copy()
    opens[1:] &= ~space[:-1]
    inner = offsets[:-1][offsets[:-1] < len(data)]
    opens[inner] = True
    starts = np.flatnonzero(opens)
    if not len(starts):
        return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
    ends = np.append(starts[1:], len(data))
    firsts = np.searchsorted(starts, offsets, "left")
    words = common.word_hashes(data, starts, ends)
    _, one, form = np.unique(words, return_index=True, return_inverse=True)
    forms = _forms(v, data, starts[one], ends[one])
    keys = words ^ common.stable_hash(np.repeat(variants.astype(np.uint64), np.diff(firsts)), seed)
    if by_place and rate > 0:
        place = np.arange(len(starts)) - np.repeat(firsts[:-1], np.diff(firsts))
        tokens, begins = encode_segments(v, data, forms, form, common.mix64(keys + common.stable_hash(place, seed + 1)), rate)
        return tokens, begins[firsts]
    keys, one, inverse = np.unique(keys, return_index=True, return_inverse=True)
    tokens, begins = encode_segments(v, data, forms, form[one], keys, rate)
    sizes = np.diff(begins)[inverse]
    total = np.concatenate([[0], np.cumsum(sizes)])
    take = np.arange(int(total[-1])) - np.repeat(total[:-1], sizes) + np.repeat(begins[:-1][inverse], sizes)
    return tokens[take], total[firsts]


def decode(v: Vocabulary, tokens: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows of tokens and where each row's begin (one more at the end)."""
    lengths = np.array([len(p) for p in v.pieces], np.int64)
    at = np.concatenate([[0], np.cumsum(lengths)])
    flat = np.frombuffer(b"".join(v.pieces), np.uint8)
    size = lengths[tokens]
    total = np.concatenate([[0], np.cumsum(size)])
    take = np.arange(int(total[-1])) - np.repeat(total[:-1], size) + np.repeat(at[tokens], size)
    out, rows = flat[take], total[offsets]
    if v.prefix:
        lead = rows[:-1][np.diff(rows) > 0]
        keep = np.ones(len(out), bool)
        keep[lead] = False
        return out[keep], rows - np.concatenate([[0], np.cumsum(np.diff(rows) > 0)])
    return out, rows


def encoded(docs: DataFrame, model: str = MODEL, rate: float = RATE, seed: int = SEED, variants: int | None = None, key_col: str = "doc_id") -> DataFrame:
    """``docs`` with tokens array<int>, n_tokens long and round_trip boolean: whether the tokens decode to the text.

    The dropout is drawn anew for each document key and each place in a text, so copies under other keys and repeats of
    a word are segmented other ways, and reruns agree; with ``variants``, documents are dealt to so many draws. A null text has null tokens and round_trip, and 0 tokens; an empty one has none. Columns of these
    names are replaced; whole texts are read; an empty table stays empty. ``model`` is a path that executors can read.
    """
    new = ["tokens", "n_tokens", "round_trip"]
    kept = [c for c in docs.columns if c not in new]

    def run(batches):
        v = load(model)
        for batch in batches:
            choice = batch.column(1).to_numpy(zero_copy_only=False)
            for first, end, data, offsets in common.byte_chunks(batch.column(0), CHUNK_BYTES):
                tokens, begins = encode(v, data, offsets, choice[first:end], rate, seed, variants is None)
                back, back_at = decode(v, tokens, begins)
                same = np.diff(back_at) == np.diff(offsets)
                if len(back) == len(data) and same.all():
                    wrong = np.flatnonzero(back != data)
                    same[np.searchsorted(offsets, wrong, "right") - 1] = False
                else:
                    same = np.array([np.array_equal(back[back_at[i] : back_at[i + 1]], data[offsets[i] : offsets[i + 1]]) for i in range(end - first)])
                null = np.asarray(batch.column(0).slice(first, end - first).is_null())
                lists = pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), pa.array(tokens), mask=pa.array(null))
                yield pa.RecordBatch.from_arrays([c.slice(first, end - first) for c in batch.columns[2:]] + [lists, pa.array(np.diff(begins)), pa.array(same, mask=null)], names=[*kept, *new])

    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept] + ["tokens array<int>", "n_tokens long", "round_trip boolean"])
    drawn = F.xxhash64(F.lit(seed), key_col)
    variant = (drawn if variants is None else F.pmod(drawn, F.lit(variants)).cast("long")).alias("_variant")
    return docs.select(F.col("text").cast("string").alias("_read"), variant, *kept).mapInArrow(run, schema)


def decoded(rows: DataFrame, model: str = MODEL, tokens_col: str = "tokens", into: str = "text") -> DataFrame:
    """``rows`` with the text that their tokens stand for; null for null tokens. Bytes that are no UTF-8 are replaced."""
    kept = [c for c in rows.columns if c != into]

    def run(batches):
        v = load(model)
        for batch in batches:
            column = batch.column(0)
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            sizes = np.nan_to_num(np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), np.float64)).astype(np.int64)
            data, at = decode(v, flat, np.concatenate([[0], np.cumsum(sizes)]))
            blob = data.tobytes()
            null = column.is_null().to_pylist()
            texts = [None if x else blob[a:b].decode("utf-8", "replace") for x, a, b in zip(null, at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(texts, pa.string())], names=[*kept, into])

    schema = ", ".join([f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept] + [f"{into} string"])
    return rows.select(F.col(tokens_col).alias("_read"), *kept).mapInArrow(run, schema)


def op9_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of every document under merge-dropout, and whether they decode to its text."""
    docs = common.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return encoded(docs).select("doc_id", "n_tokens", "tokens", "round_trip")
