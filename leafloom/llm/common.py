"""Shared helpers of the training-data operators: tables, shared storage and byte-level text in numpy.

Texts are held as one byte buffer per batch with document offsets. Words are runs of bytes other than
0x20 and 0x09-0x0D, so all steps below work on any UTF-8 text without decoding it.
"""

from __future__ import annotations

import pickle
import re
import tempfile
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes handled at once by one task; bounds its memory, not what it reads.
CHUNK_BYTES = 4 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A table of up to this many rows is broadcast, after it was counted.
SMALL_ROWS = 100_000


def small(df: DataFrame) -> DataFrame:
    """A broadcast of ``df`` if it is counted to be small, else ``df``, for a shuffled join."""
    return F.broadcast(df) if df.count() <= SMALL_ROWS else df


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``; on one machine, a temporary one where that is unset."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not named and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="leafloom-"))
    return named or sc._jsc.sc().getCheckpointDir().get()


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder in any store that Spark writes to."""
    to = spark._jvm.org.apache.hadoop.fs.Path(path)
    to.getFileSystem(spark._jsc.hadoopConfiguration()).delete(to, True)


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder once, with its lineage cut."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def fitted(sample: DataFrame, fit: Callable[[list[tuple]], object]):
    """What ``fit`` makes of a bounded sample's sorted rows, computed by one task: the driver holds the model alone."""

    def run(batches):
        rows = sorted(r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(rows))], pa.binary())], names=["model"])

    made = sample.repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(made[0].model) if made else fit([])


def crc_fold(column, parts: int):
    """crc32 of the value as text, mod ``parts``; null stays null."""
    return F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(parts))


def crc_fold_py(value, parts: int) -> int:
    """The same fold outside Spark."""
    return zlib.crc32(str(value).encode()) % parts


def byte_chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive runs of rows of about ``limit`` bytes: first row, end row, bytes, offsets from 0. Null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes as they are."""
    return _LOWER[data]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the index of the first word of each row (one more at the end)."""
    solid = ~_SPACE[data]
    if not solid.any():
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    opens, closes = solid.copy(), solid.copy()
    opens[1:] &= ~solid[:-1]
    closes[:-1] &= ~solid[1:]
    inner = offsets[1:-1]
    cuts = inner[(inner > 0) & (inner < len(data))]
    opens[cuts] = solid[cuts]
    closes[cuts - 1] = solid[cuts - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets, "left")


_rng = np.random.default_rng(20240607)
_BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_POWERS = np.array([pow(_BASE, k, 2**64) for k in range(64)], np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> np.ndarray:
    global _POWERS
    while len(_POWERS) < n:
        step = np.uint64(pow(_BASE, len(_POWERS), 2**64))
        _POWERS = np.concatenate([_POWERS, _POWERS * step])
    return _POWERS


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, equal in every batch and on every machine."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    firsts = np.zeros(len(starts), np.int64)
    np.cumsum(lengths[:-1], out=firsts[1:])
    at = np.arange(int(lengths.sum())) - np.repeat(firsts, lengths)
    codes = _BYTE_CODE[data[np.repeat(starts, lengths) + at]] * _powers(int(lengths.max()))[at]
    return mix64(np.add.reduceat(codes, firsts) + lengths.astype(np.uint64))


def stable_hash(values: np.ndarray, seed: int) -> np.ndarray:
    """A keyed 64-bit hash of 64-bit values."""
    return mix64(values.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64))
