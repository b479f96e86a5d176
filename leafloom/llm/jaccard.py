"""N-gram Jaccard join by T-occurrence search with DivideSkip.

A document is the set of its distinct word n-grams, held as 64-bit hashes. Two documents link when their sets'
Jaccard similarity reaches the threshold, which is an overlap of at least T shared n-grams that follows from the two
sizes. The join runs in four steps.

1. Documents with the same set become one class (a grouped minimum), so copies never meet as pairs.
2. Blocks: every class lists its rarest n-grams, as many as any linked class must share one of (rarity is an order by
   counters of hashed n-grams, of one size for any corpus; every total order is exact). Lists with the same members
   count once. Two members of a list are plausible if their parity bitmaps, a bit or two per n-gram, allow the overlap:
   a differing bit needs an n-gram that only one of the sets has, so no link is lost. The components of the plausible
   pairs are the blocks. No link leaves a block.
3. T-occurrence search inside blocks: inverted lists of the block's sets; for each set the long lists are put aside, the
   short ones are heap-merged with skips for documents that occur T - L times, and those are probed in the long lists
   by binary search. A block beyond a task's size is dealt to shards, and each pair of shards is one task.
4. Each task returns a spanning forest of its links; the components of all forests are the result.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafloom.llm import common

#: Counters of hashed n-grams that order them by rarity, and slices that they are summed in.
COUNTERS, SLICES = 1 << 20, 64
#: N-grams of the sets in one search task, about; a larger block is dealt to pairs of shards.
TASK_GRAMS = 1 << 20
#: Members of a list that one task compares; the shards of a longer list meet pair by pair.
LIST_ROWS = 4096
#: Members of short lists in one task.
BIN_ROWS = 50_000
#: DivideSkip's weight of a probe against a merge step: L = T / (MU * log2(longest list) + 1).
MU = 0.0085


def gram_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each row's word n-grams; with fewer words the whole sequence is the one gram."""
    data = common.lower_ascii(data)
    starts, ends, firsts = common.word_spans(data, offsets)
    words = common.word_hashes(data, starts, ends)
    k = max(len(words) - n + 1, 0)
    grams = np.zeros(k, np.uint64)
    for i in range(n):
        grams = common.mix64(grams + words[i : i + k] * np.uint64(2 * i + 0x9E3779B97F4A7C15))
    out = []
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
        if b - a >= n:
            row = np.sort(grams[a : b - n + 1])
            out.append(row[np.concatenate(([True], row[1:] != row[:-1]))])
        elif b > a:
            short = np.zeros(1, np.uint64)
            for i in range(a, b):
                short = common.mix64(short + words[i : i + 1] * np.uint64(2 * (i - a) + 3))
            out.append(short)
        else:
            out.append(words[:0])
    return out


def _digest(row: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    a = common.stable_hash(row, 1).sum(dtype=np.uint64)
    b = common.stable_hash(row, 2)
    b = (b ^ (b >> np.uint64(29))).sum(dtype=np.uint64)
    return tuple(np.array([a, b], np.uint64).view(np.int64).tolist())


def least_overlap(a: int, b: int, num: int, den: int) -> int:
    """The smallest overlap of sets of sizes a and b whose Jaccard similarity is at least num/den."""
    return -(-num * (a + b) // (num + den))


def class_rows(docs: DataFrame, n: int) -> DataFrame:
    """kind 0: (doc_id, size, d1, d2) of each document; kind 1: (slice, counts) of hashed n-grams, summed per task."""

    def run(batches):
        counts = np.zeros(COUNTERS, np.uint32)
        for batch in batches:
            ids = batch.column(0)
            for first, end, data, offsets in common.byte_chunks(batch.column(1)):
                sets = gram_sets(data, offsets, n)
                whole = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                np.add(counts, np.bincount((whole >> np.uint64(44)).astype(np.int64), minlength=COUNTERS).astype(np.uint32), out=counts)
                names = [_digest(s) for s in sets]
                m = end - first
                yield _rows(np.zeros(m, np.int8), ids.slice(first, m), [len(s) for s in sets], [x for x, _ in names], [x for _, x in names], pa.nulls(m, pa.binary()))
        if counts.any():
            width = COUNTERS // SLICES
            blobs = pa.array([np.minimum(counts[k * width : (k + 1) * width], 65535).astype(np.uint16).tobytes() for k in range(SLICES)], pa.binary())
            zero = np.zeros(SLICES, np.int64)
            yield _rows(np.ones(SLICES, np.int8), pa.array(np.arange(SLICES)), zero, zero, zero, blobs)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "kind byte, doc_id long, size long, d1 long, d2 long, counts binary")


def _rows(kind, ids, size, d1, d2, counts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.int8()), ids, pa.array(size, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), counts], names=["kind", "doc_id", "size", "d1", "d2", "counts"])


def _rarity(rows: DataFrame) -> np.ndarray:
    """A byte per hashed n-gram: the logarithm of its count over all documents. COUNTERS bytes for any corpus."""
    width = COUNTERS // SLICES

    def add(f: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(width, np.float64)
        for x in f["counts"]:
            total += np.frombuffer(x, np.uint16)
        return pd.DataFrame({"slice": [f["doc_id"].iloc[0]], "level": [np.minimum(np.log2(total + 1) * 8, 255).astype(np.uint8).tobytes()]})

    levels = np.zeros(COUNTERS, np.uint8)
    for r in rows.where("kind = 1").select("doc_id", "counts").groupBy("doc_id").applyInPandas(add, "slice long, level binary").collect():
        levels[r.slice * width : (r.slice + 1) * width] = np.frombuffer(r.level, np.uint8)
    return levels


def listed(docs: DataFrame, levels, n: int, num: int, den: int) -> DataFrame:
    """(doc_id, size, d1, d2, grams, bits): the rarest n-grams of each set, one of which every linked set shares, and its
    parity bitmap."""

    def run(batches):
        rarity = levels.value
        for batch in batches:
            ids = batch.column(0)
            for first, end, data, offsets in common.byte_chunks(batch.column(1)):
                sets, out = gram_sets(data, offsets, n), []
                for s in sets:
                    keep = len(s) - -(-num * len(s) // den) + 1 if len(s) else 0
                    order = np.argsort(rarity[(s >> np.uint64(44)).astype(np.int64)], kind="stable")[:keep]
                    out.append(s[order].view(np.int64))
                names = [_digest(s) for s in sets]
                at = np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int32)
                flat = np.concatenate(out) if out else np.zeros(0, np.int64)
                m = end - first
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, m), pa.array([len(s) for s in sets], pa.int64()), pa.array([x for x, _ in names], pa.int64()), pa.array([x for _, x in names], pa.int64()), pa.ListArray.from_arrays(pa.array(at), pa.array(flat)), pa.array([parity(s) for s in sets], pa.binary())],
                    names=["doc_id", "size", "d1", "d2", "grams", "bits"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, size long, d1 long, d2 long, grams array<long>, bits binary")


def parity(row: np.ndarray) -> bytes:
    """Bit i: whether an odd number of the set's n-grams hash to i; 64 bits, or the power of two from the size up."""
    width = max(64, 1 << max(len(row) - 1, 0).bit_length())
    odd = np.bincount((common.stable_hash(row, 3) & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(bits: np.ndarray, width: int) -> np.ndarray:
    """Rows of bitmaps (as 64-bit words) of a larger width as they are at the smaller one."""
    while bits.shape[1] > width:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def plausible_forest(ids: np.ndarray, sizes: np.ndarray, bitmaps: list[bytes], num: int, den: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs whose sizes and bitmaps allow a link. Sizes ascend."""
    joined, out = _Joined(len(ids)), []
    words = [len(b) // 8 for b in bitmaps]
    at_width: dict[int, tuple[int, np.ndarray]] = {}  # bitmaps of ascending sizes: runs of one width
    for w in dict.fromkeys(words):
        a = words.index(w)
        rows = [b for b, x in zip(bitmaps, words, strict=True) if x == w]
        at_width[w] = (a, np.frombuffer(b"".join(rows), np.uint64).reshape(len(rows), w))
    for x in range(1, len(ids)):
        low = int(np.searchsorted(sizes[:x], -(-num * sizes[x] // den)))
        if low >= x:
            continue
        own_at, own_rows = at_width[words[x]]
        own = own_rows[x - own_at : x - own_at + 1]
        for w, (a, rows) in at_width.items():
            b = a + len(rows)
            lo, hi = max(low, a), min(x, b)
            if lo >= hi:
                continue
            todo = np.arange(lo, hi)
            while len(todo):  # rows that one link has joined with x need no look any more
                some, todo = todo[-256:], todo[:-256]
                differ = np.bitwise_count(rows[some - a] ^ folded(own, w)).sum(1, dtype=np.int64)
                need = -(-num * (sizes[x] + sizes[some]) // (num + den))
                for y in some[differ <= sizes[x] + sizes[some] - 2 * need].tolist():
                    if not joined(x, y):
                        out.append((int(ids[x]), int(ids[y])))
                        joined.join(x, y)
                if len(todo):
                    root = joined.root(x)
                    todo = np.array([y for y in todo.tolist() if joined.root(y) != root], np.int64)
    return out


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for every id of (a, b) edges: the smallest id that it is connected with.

    Rounds of large-star and small-star (Kiveris et al. 2014): their number grows with the logarithm of a component's
    size, and no step gathers a component in one task.
    """
    now = common.cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # small-star: the smaller neighbours of an id, and the id itself, hang on the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(low.select("a", F.col("m").alias("b")))
        now = common.cut(small.distinct())
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            ends = now.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct()
            return now.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(ends)
        before = state


class DivideSkip:
    """Inverted lists over sets in order of size, searched for earlier sets that reach the overlap."""

    def __init__(self, sets: list[np.ndarray], num: int, den: int):
        self.sets, self.num, self.den = sets, num, den
        self.sizes = [len(s) for s in sets]
        whole = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(whole, kind="stable")
        ordered = whole[order]
        cuts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        ends = np.append(cuts[1:], len(ordered))
        name = np.repeat(np.arange(len(cuts)), ends - cuts)
        of = np.empty(len(whole), np.int64)
        of[order] = name
        shared = (ends - cuts) > 1  # an n-gram of one set alone links nothing
        postings = owner[order]
        self.lists = {int(k): postings[cuts[k] : ends[k]].tolist() for k in np.flatnonzero(shared)}
        at = np.concatenate([[0], np.cumsum(self.sizes)])
        self.keys = [[k for k in of[at[i] : at[i + 1]].tolist() if shared[k]] for i in range(len(sets))]

    def links(self, skip) -> list[tuple[int, int]]:
        """(earlier, later) sets that reach the overlap; pairs that ``skip`` holds for are left out."""
        out = []
        for x in range(len(self.sets)):
            for y in self.search(x, skip):
                out.append((y, x))
                skip.join(x, y)
        return out

    def search(self, x: int, skip) -> list[int]:
        size = self.sizes[x]
        least = -(-self.num * size // self.den)  # of the smallest set that can link
        low = bisect_left(self.sizes, least)
        if low >= x:
            return []
        need = least_overlap(size, max(self.sizes[low], least), self.num, self.den)
        lists = []
        for k in self.keys[x]:
            one = self.lists[k]
            a = bisect_left(one, low)
            b = bisect_left(one, x, a)
            if b > a:
                lists.append((b - a, a, b, one))
        if len(lists) < need:
            return []
        lists.sort(key=lambda v: v[0])
        n_long = min(need - 1, int(need / (MU * math.log2(lists[-1][0] + 1) + 1)))
        short, long = lists[: len(lists) - n_long], lists[len(lists) - n_long :]
        found = []
        for y, count in merge_skip(short, need - n_long):
            if skip(x, y):
                continue
            wanted = least_overlap(size, self.sizes[y], self.num, self.den)
            for left, (_, a, b, one) in zip(range(len(long), 0, -1), long, strict=True):
                if count + left < wanted or count >= wanted:
                    break
                at = bisect_left(one, y, a, b)
                count += at < b and one[at] == y
            if count >= wanted:
                found.append(y)
                skip.join(x, y)
        return found


def merge_skip(lists: list[tuple[int, int, int, list[int]]], need: int) -> list[tuple[int, int]]:
    """(member, count) of the members of at least ``need`` of the sorted lists (length, from, to, values): a heap merge
    that jumps over what cannot reach the count."""
    if need <= 0:
        raise ValueError("need must be positive")
    if len(lists) < need:
        return []
    heap = [(one[a], i, a) for i, (_, a, _, one) in enumerate(lists)]
    heapq.heapify(heap)
    out = []
    while len(heap) >= need:
        top = heap[0][0]
        popped = []
        while heap and heap[0][0] == top:
            popped.append(heapq.heappop(heap))
        if len(popped) >= need:
            out.append((top, len(popped)))
            target = top + 1
        else:
            # need - 1 lists in all may pass the rest: the others jump to the next candidate
            while heap and len(popped) < need - 1:
                popped.append(heapq.heappop(heap))
            if not heap:
                break
            target = heap[0][0]
        for _, i, at in popped:
            _, _, b, one = lists[i]
            at = bisect_left(one, target, at, b)
            if at < b:
                heapq.heappush(heap, (one[at], i, at))
    return out


class _Joined:
    """Union-find over the sets of a task; asks whether two are connected by links found before."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def __call__(self, x: int, y: int) -> bool:
        return self.root(x) == self.root(y)

    def join(self, x: int, y: int) -> None:
        self.up[self.root(x)] = self.root(y)


def _blocks(listing: DataFrame, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """The classes (id, size, d1, d2), and (id, block) of those that have a plausible partner."""
    classes = listing.where("size > 0").groupBy("d1", "d2", "size").agg(F.min("doc_id").alias("id"), F.min("grams").alias("grams"), F.min("bits").alias("bits"))
    classes = common.cut(classes)
    posts = classes.select("id", F.explode("grams").alias("gram"))
    lists = posts.groupBy("gram").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("id")).alias("x1"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("x2")).where("n > 1")
    lists = lists.groupBy("n", "x1", "x2").agg(F.min("gram").alias("gram")).withColumn("shards", F.ceil(F.col("n") / LIST_ROWS).cast("int"))
    lists = common.cut(lists)
    bins = max(1, -(-(lists.agg(F.sum("n")).first()[0] or 0) // BIN_ROWS))
    own = F.pmod(F.xxhash64("id"), F.col("shards")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("shards") - 1), lambda s: (s != own) | (F.col("shards") == 1))
    members = posts.join(lists.select("gram", "shards"), "gram").withColumn("other", F.explode(others))
    # short lists share a task, each pair of a long list's shards is one
    pair = F.concat_ws("-", F.lit("l"), "gram", F.least(own, "other"), F.greatest(own, "other"))
    task = F.when(F.col("shards") == 1, F.concat_ws("-", F.lit("s"), F.pmod(F.xxhash64("gram"), F.lit(bins)))).otherwise(pair)
    members = members.select(task.alias("task"), "gram", "id")
    members = members.join(classes.select("id", "size", "bits"), "id")

    def compare(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(["gram", "size", "id"])
        ids, sizes, bits, gram = f["id"].to_numpy(np.int64), f["size"].to_numpy(np.int64), list(map(bytes, f["bits"])), f["gram"].to_numpy()
        cuts = [0, *(np.flatnonzero(gram[1:] != gram[:-1]) + 1).tolist(), len(f)]
        pairs = [p for a, b in zip(cuts[:-1], cuts[1:], strict=True) for p in plausible_forest(ids[a:b], sizes[a:b], bits[a:b], num, den)]
        return pd.DataFrame(pairs, columns=["a", "b"], dtype=np.int64)

    edges = members.groupBy("task").applyInPandas(compare, "a long, b long")
    return classes.drop("grams", "bits"), components(edges).withColumnRenamed("root", "block")


def near_duplicates(docs: DataFrame, n: int = 5, num: int = 4, den: int = 5, task_grams: int = TASK_GRAMS) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs`` (doc_id, text; other columns play no part).

    Documents link when the Jaccard similarity of their word ``n``-gram sets is at least ``num/den``; component_id is
    the smallest doc_id that is reachable. A-Z count as lower case. Fewer words than ``n`` are one gram. Null, empty and
    word-free texts have no grams and are components of their own. A null doc_id keeps its row: its component is its
    copies' or links' smallest id, null if it has none. Repeated ids give a row each. An empty table gives none. Texts
    of any length are whole.
    """
    spark = docs.sparkSession
    first = common.cut(class_rows(docs, n))
    named = first.where("kind = 0").select("doc_id", "size", "d1", "d2")
    levels = spark.sparkContext.broadcast(_rarity(first))  # COUNTERS bytes
    classes, blocks = _blocks(listed(docs.where("doc_id is not null"), levels, n, num, den), num, den)
    blocks = common.cut(blocks.join(classes.select("id", "size"), "id"))

    totals = blocks.groupBy("block").agg(F.sum("size").alias("grams"))
    shards = F.ceil(F.col("grams") / task_grams).cast("int")
    bins = max(1, -(-(blocks.agg(F.sum("size")).first()[0] or 0) // task_grams))
    dealt = blocks.join(totals.withColumn("shards", shards), "block")
    # small blocks share a bin; a large one is dealt to shards, and a document goes to the tasks of its shard's pairs
    own = F.pmod(F.xxhash64("id"), F.col("shards")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("shards") - 1), lambda s: s != own)
    pair = lambda s: F.concat_ws("-", F.lit("b"), F.col("block"), F.least(own, s), F.greatest(own, s))
    tasks = F.when(F.col("shards") == 1, F.array(F.concat_ws("-", F.lit("s"), F.pmod(F.xxhash64("block"), F.lit(bins))))).otherwise(F.transform(others, pair))
    dealt = dealt.select("id", tasks.alias("tasks"))
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    work = texts.join(dealt, "id").select("tasks", "id", "text")

    def sets(batches):
        for batch in batches:
            for at, end, data, offsets in common.byte_chunks(batch.column(2)):
                blobs = pa.array([s.tobytes() for s in gram_sets(data, offsets, n)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), batch.column(1).slice(at, end - at), blobs], names=["tasks", "id", "grams"])

    def search(f: pd.DataFrame) -> pd.DataFrame:
        rows = sorted({(len(g), int(i), bytes(g)) for i, g in zip(f["id"], f["grams"], strict=True) if len(g)})
        ids = [i for _, i, _ in rows]
        if len(ids) < 2:
            return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        links = DivideSkip([np.frombuffer(g, np.uint64) for _, _, g in rows], num, den).links(_Joined(len(ids)))
        return pd.DataFrame({"a": [ids[i] for i, _ in links], "b": [ids[j] for _, j in links]}, dtype=np.int64)

    made = work.mapInArrow(sets, "tasks array<string>, id long, grams binary").select(F.explode("tasks").alias("task"), "id", "grams")
    links = made.groupBy("task").applyInPandas(search, "a long, b long")
    roots = components(links)
    result = classes.join(roots, "id", "left").select("d1", "d2", "size", F.coalesce("root", "id").alias("component"))
    out = named.join(result, ["d1", "d2", "size"], "left")
    return out.select("doc_id", F.col("size").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, n: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """``docs`` with one document of each group of near duplicates: the one with the smallest doc_id.

    Rows that repeat a kept doc_id stay one row, the one whose text has the smallest hash, among equal texts the one whose
    other columns have it as JSON, whatever their types; rows with a null doc_id stay. Cases as in ``near_duplicates``.
    """
    found = near_duplicates(docs, n, num, den)
    kept = found.where("doc_id = component_id").select("doc_id").distinct()
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    row = docs.where("doc_id is not null").select("doc_id", F.struct(F.xxhash64("text").alias("text"), (F.xxhash64(F.to_json(F.struct(*others))) if others else F.lit(0)).alias("rest")).alias("_by"), F.struct(*docs.columns).alias("_row"))
    whole = row.join(kept, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by("_row", "_by").alias("_row"))
    return whole.select("_row.*").unionByName(docs.where("doc_id is null"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word shingles at a similarity of 0.9 or more over all documents."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs, n=3, num=9, den=10)


OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) END AS grams
  FROM w
), n AS (SELECT doc_id, len(grams) AS n FROM s),
g AS (SELECT doc_id, unnest(grams) AS gram FROM s),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM g a JOIN g b USING (gram) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 90 * (x.n + y.n - shared)),
r AS (SELECT doc_id, doc_id AS seen FROM n UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.seen)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, min(r.seen) AS component_id FROM n JOIN r USING (doc_id) GROUP BY 1, 2
"""
