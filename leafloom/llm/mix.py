"""Mixing sources to target weights, in DataFrame functions only.

The words of a source are packed, document after document, into blocks of one length. Each source has a number of
block slots that follows from its target. The slots are thrown into output shards by a keyed hash: the counts of a
source over the shards are a multinomial draw, and the counts of a shard are multinomial over the sources given the
exact total of each, so no source strays from its target. A slot's index goes through a pseudorandom permutation of the
source's blocks, another one for each pass over them, and the picked blocks are joined by index. With two passes at
most, no block is taken more than twice.

Window and offset computations run within (source, bucket of documents), so a source that holds a third of all rows is
spread over many tasks; nothing but the table of sources is ever in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafloom.llm import common

WORDS = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
#: Weights of the sources in order, repeating; what the targets add up to, as a share of all sizes; passes at most.
WEIGHTS, SHARE, PASSES = (5, 2, 1), 1.5, 2
#: Length of a block in words; the last one of a source may be shorter.
BLOCK_WORDS = 128
BUCKETS, SHARD_SLOTS, CHUNK_SLOTS, ROUNDS = 4096, 65_536, 65_536, 24


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, key, text_hash, size, bucket) per row; ``key`` sorts as the source by code point, null last."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long")
    key = F.coalesce(F.concat(F.lit("v"), F.col("source").cast("string")), F.lit("z"))
    hashed = docs.select("doc_id", key.alias("key"), F.xxhash64("text").alias("text_hash"), size.alias("size"))
    return hashed.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(BUCKETS)).cast("int"))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per source: its size, weight, target, block length, number of blocks and slots, and the number of shards.

    The sources are ordered in one task: their table has a row each, and goes into no task but as that.
    Targets are ``least(PASSES * size, level * weight)`` with the level at which they add up to the share of all sizes:
    the end of resharing the excess of full sources by weight until no target is above its limit.
    """
    per = sized.groupBy("key").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.orderBy("key"))  # the table of sources, a row each
    cases = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("weight", cases.cast("double"))
    by = W.orderBy(F.col("source_size") / F.col("weight"), "key").rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    before = lambda c: F.coalesce(F.sum(c).over(by), F.lit(0))
    level = (F.lit(share) * F.sum("source_size").over(everything) - PASSES * before("source_size")) / (F.sum("weight").over(everything) - before("weight"))
    per = per.withColumn("level", level).withColumn("full", PASSES * F.col("source_size") <= F.col("level") * F.col("weight"))
    at = F.min_by(F.when(~F.col("full"), F.col("level")), F.when(~F.col("full"), F.struct(F.col("source_size") / F.col("weight"), F.col("key")))).over(everything)
    limit = (PASSES * F.col("source_size")).cast("double")
    per = per.withColumn("target", F.coalesce(F.least(limit, at * F.col("weight")), limit))
    per = per.withColumn("block_words", F.lit(block_words).cast("long")).withColumn("blocks", F.ceil(F.col("source_size") / F.col("block_words")).cast("long"))
    slots = F.least(PASSES * F.col("blocks"), F.round(F.col("target") * F.col("blocks") / F.col("source_size")).cast("long"))
    per = per.withColumn("slots", F.when(F.col("source_size") > 0, slots).otherwise(0).cast("long"))
    per = per.withColumn("shards", F.greatest(F.lit(1), F.ceil(F.sum("slots").over(everything) / SHARD_SLOTS)).cast("long"))
    return per.select("key", "source_size", "weight", "target", "block_words", "blocks", "slots", "shards")


def draw(sources: DataFrame, seed: int) -> DataFrame:
    """(shard, key, slots drawn, first slot) from throwing each source's slots into the shards."""
    chunks = sources.where("slots > 0").select("key", "slots", "shards", F.explode(F.sequence(F.lit(0), F.floor((F.col("slots") - 1) / CHUNK_SLOTS))).alias("chunk"))
    first = F.col("chunk") * CHUNK_SLOTS
    tasks = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    thrown = chunks.repartition(tasks, "key", "chunk").select("key", "shards", F.explode(F.sequence(first, F.least(first + CHUNK_SLOTS, F.col("slots")) - 1)).alias("throw"))
    drawn = thrown.groupBy(F.pmod(F.xxhash64(F.lit(seed), "key", "throw"), F.col("shards")).alias("shard"), "key").agg(F.count("*").alias("drawn"))
    by = W.partitionBy("key").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    return drawn.withColumn("first", F.coalesce(F.sum("drawn").over(by), F.lit(0)))


def rounds(seed: int, *names):
    """The keys of the rounds of the permutation that these names and the seed choose."""
    return F.transform(F.sequence(F.lit(1), F.lit(ROUNDS)), lambda r: F.xxhash64(F.lit(seed), *names, r))


def permuted(index, blocks, keys):
    """``index`` under the permutation of [0, blocks) with these round keys (a swap-or-not shuffle)."""

    def step(x, key):
        other = F.pmod(F.pmod(key, blocks) - x, blocks)
        return F.when(F.xxhash64(key, F.greatest(x, other)).bitwiseAND(F.lit(1)) == 1, other).otherwise(x)

    return F.aggregate(keys, index, step)


def slots(sources: DataFrame, seed: int = 17) -> DataFrame:
    """The mix: (shard, key, slot, turn, block) per output slot."""
    drawn = draw(sources, seed).join(common.small(sources.select("key", "blocks")), "key")
    drawn = drawn.withColumn("rounds", F.array(*(rounds(seed, "key", F.lit(turn)) for turn in range(PASSES))))
    each = drawn.select("shard", "key", "blocks", "rounds", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("drawn") - 1)).alias("slot"))
    each = each.withColumn("turn", F.floor(F.col("slot") / F.col("blocks")).cast("long"))
    block = permuted(F.pmod(F.col("slot"), F.col("blocks")), F.col("blocks"), F.get("rounds", F.col("turn").cast("int")))
    return each.select("shard", "key", "slot", "turn", block.alias("block"))


def places(sized: DataFrame) -> DataFrame:
    """(doc_id, key, text_hash, size, start) of the rows with words: where each begins among its source's words.

    Rows are placed within a bucket by id and text, so rows that tie are equal in all columns here.
    """
    per = sized.groupBy("key", "bucket").agg(F.sum("size").alias("n"))
    ahead = W.partitionBy("key").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)  # BUCKETS rows a source at most
    per = per.select("key", "bucket", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    within = W.partitionBy("key", "bucket").orderBy("doc_id", "text_hash").rowsBetween(W.unboundedPreceding, -1)
    placed = sized.where("size > 0").withColumn("within", F.coalesce(F.sum("size").over(within), F.lit(0))).join(per, ["key", "bucket"])
    return placed.select("doc_id", "key", "text_hash", "size", (F.col("ahead") + F.col("within")).alias("start"))


def pieces(placed: DataFrame, sources: DataFrame) -> DataFrame:
    """The part of each placed row in each block: (key, start, block, first word, words)."""
    placed = placed.join(common.small(sources.select("key", "block_words")), "key")
    ends, length = F.col("start") + F.col("size"), F.col("block_words")
    split = placed.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / length), F.floor((ends - 1) / length))))
    opens = F.greatest(F.col("start"), F.col("block") * length)
    return split.select("key", "start", "block", (opens - F.col("start")).alias("first_word"), (F.least(ends, (F.col("block") + 1) * length) - opens).alias("words"))


def taken(docs: DataFrame, seed: int = 17, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The sized rows, the table of sources, the places of rows, and each row's pieces with how often the mix uses them."""
    sized = common.cut(sizes(docs))
    sources = common.cut(targets(sized, block_words=block_words))
    placed = places(sized)
    uses = slots(sources, seed).groupBy("key", "block").agg(F.count("*").alias("uses"))
    return sized, sources, placed, pieces(placed, sources).join(uses, ["key", "block"]).select("key", "start", "first_word", "words", "uses")


def mix_counts(docs: DataFrame, seed: int = 17, block_words: int = BLOCK_WORDS) -> DataFrame:
    """How many words of each document the mix takes, repeats counted.

    ``docs`` has doc_id, text and source; other columns play no part. Null and word-free texts have size 0 and are
    never taken; a null source is a source of its own, the last one; null and repeated ids are rows like others, and
    each repeated row gets a place of its own. An empty table gives no rows. Returns doc_id, source, size, source_size,
    target, taken; a source's taken words differ from its target by less than two blocks.
    """
    sized, sources, placed, used = taken(docs, seed, block_words)
    per = used.groupBy("key", "start").agg(F.sum(F.col("words") * F.col("uses")).alias("taken"))
    rest = placed.join(per, ["key", "start"], "left").select("key", "doc_id", "size", F.coalesce("taken", F.lit(0)).alias("taken"))
    none = sized.where("size = 0").select("key", "doc_id", "size", F.lit(0).cast("long").alias("taken"))
    out = rest.unionByName(none).join(common.small(sources.select("key", "source_size", "target")), "key")
    source = F.when(F.col("key") != "z", F.expr("substring(key, 2)"))
    return out.select("doc_id", source.alias("source"), "size", "source_size", "target", "taken")


def mix_documents(docs: DataFrame, seed: int = 17, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: a row for each document and pass, with the words that pass takes.

    A document whose blocks are all taken in a pass keeps its text as it is; else the taken words are joined by one
    space. Documents that are not taken at all go. ``n_chars``, if there is one, is made new. Columns of any other name
    or type are carried as they are. Cases as in ``mix_counts``.
    """
    _, _, placed, used = taken(docs, seed, block_words)
    parts = used.groupBy("key", "start").agg(F.array_sort(F.collect_list(F.struct("first_word", "words", "uses"))).alias("parts"))  # of one text
    found = placed.join(parts, ["key", "start"])
    # rows that repeat id, source and text are numbered on both sides: each takes its own place
    name = ["key", "doc_id", "text_hash"]
    found = found.withColumn("n", F.row_number().over(W.partitionBy(*name).orderBy("start"))).select(F.struct(*name, "n").alias("of"), "size", "parts")
    key = F.coalesce(F.concat(F.lit("v"), F.col("source").cast("string")), F.lit("z"))
    rows = docs.select(key.alias("key"), F.col("doc_id"), F.xxhash64("text").alias("text_hash"), F.struct(*docs.columns).alias("row"))
    # a row without a place was not taken; equal rows are alike, so it does not matter which of them that is
    rows = rows.withColumn("all", F.row_number().over(W.partitionBy(*name).orderBy(F.lit(1))))
    joined = rows.join(found, F.struct(*name, F.col("all").alias("n")).eqNullSafe(F.col("of")))
    turned = joined.withColumn("turn", F.explode(F.array(*map(F.lit, range(1, PASSES + 1)))))
    turned = turned.withColumn("parts", F.filter("parts", lambda p: p["uses"] >= F.col("turn"))).where(F.size("parts") > 0)
    got = F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + p["words"])
    words = F.filter(F.split("row.text", SPACES), lambda w: w != "")
    # the words are a lambda's variable, so that they are split once for all parts
    chosen = lambda ws: F.array_join(F.flatten(F.transform("parts", lambda p: F.slice(ws, (p["first_word"] + 1).cast("int"), p["words"].cast("int")))), " ")
    cut = F.get(F.transform(F.array(words), chosen), F.lit(0))
    whole = got == F.col("size")
    turned = turned.withColumn("text", F.when(whole, F.col("row.text")).otherwise(cut))
    length = {"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return turned.select(*(F.col("text") if c == "text" else length[c].alias(c) if c in length else F.col("row").getField(c).alias(c) for c in docs.columns))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that the mix takes of every document."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix_counts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "size", "source_size", "target", "taken")
