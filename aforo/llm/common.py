"""Pieces that several operators share: words, hashes, staged tables and packed arrays."""

from __future__ import annotations

import contextlib
import ctypes
import functools
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aforo.session import drop_path, new_path

# Words are runs of other characters than ASCII white space. The same set is what bytes.split() splits at.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
CACHE_WORDS = 60_000
MIX = np.uint64(0x9E3779B97F4A7C15)
MIX_2 = np.uint64(0xBF58476D1CE4E5B9)
MIX_3 = np.uint64(0x94D049BB133111EB)


class Staging:
    """Tables written below the shared folder and read back."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.paths = spark, name, []

    def table(self, df: DataFrame, part: str) -> DataFrame:
        path = new_path(self.spark, f"{self.name}-{part}")
        df.write.parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def result(self, df: DataFrame) -> DataFrame:
        """Stage the last table and drop all that it was made from."""
        made, self.paths = self.paths, []
        out = self.table(df, "result")
        for path in made:
            drop_path(self.spark, path)
        return out

    def drop(self) -> None:
        """Remove all staged tables."""
        while self.paths:
            drop_path(self.spark, self.paths.pop())


# Batches that Spark hands to Python: a few hundred documents, or fewer long ones.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


def id_and_text(df: DataFrame, key: str, text: str, *more: Column) -> DataFrame:
    """The key as a long and the text's UTF-8 bytes, NULL kept, then more columns."""
    for name, value in BATCHES.items():
        df.sparkSession.conf.set(name, value)
    return df.select(
        F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").cast("binary").alias("text"), *more
    )


def text_md5(text: str) -> Column:
    """Digest that tells texts under a repeated or NULL key apart."""
    return F.md5(F.col(f"`{text}`").cast("binary"))


class WordHashes(dict):
    """Word -> 64-bit hash, kept for the words met lately so that memory stays bounded."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = value
        return value

    def of(self, words: Sequence[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit values that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * MIX_2
    x = (x ^ (x >> np.uint64(27))) * MIX_3
    return x ^ (x >> np.uint64(31))


def windows(hashes: np.ndarray, size: int, multiplier: np.uint64 = MIX) -> np.ndarray:
    """A hash of each run of ``size`` consecutive values; empty when there are fewer."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out = out * multiplier + hashes[j : j + n]
    return mixed(out)


def give_back() -> None:
    """Return freed memory to the system: Python workers live on from task to task beside the JVM."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def tidied(fn: Callable) -> Callable:
    """A function on batches that gives memory back when it has yielded its last batch."""

    @functools.wraps(fn)
    def run(*args, **kwargs):
        yield from fn(*args, **kwargs)
        give_back()

    return run


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def unsqueeze(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def pack_ints(values: np.ndarray) -> bytes:
    """Unsigned 32-bit values, compressed byte plane by byte plane."""
    planes = np.ascontiguousarray(values.astype("<u4")).view(np.uint8).reshape(-1, 4).T
    return squeeze(np.ascontiguousarray(planes).tobytes())


def unpack_ints(data: bytes) -> np.ndarray:
    planes = np.frombuffer(unsqueeze(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


def pack_strings(items: Sequence[bytes]) -> bytes:
    sizes = pack_ints(np.fromiter(map(len, items), np.uint32, len(items)))
    return len(sizes).to_bytes(4, "little") + sizes + squeeze(b"".join(items))


def unpack_strings(data: bytes) -> list[bytes]:
    cut = 4 + int.from_bytes(data[:4], "little")
    ends = np.cumsum(unpack_ints(data[4:cut]), dtype=np.int64).tolist()
    body = unsqueeze(data[cut:])
    return [body[a:b] for a, b in zip([0, *ends[:-1]], ends)] if ends else []
