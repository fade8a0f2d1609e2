"""Small helpers the text operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: ASCII white space, as Java and Python patterns; ``bytes.split()`` uses the same set.
SPACE = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"
#: Words that a hash cache remembers before it starts anew; bounds a worker's memory.
CACHE_WORDS = 400_000

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def whole(text: str | Column) -> Column:
    """The text, null as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE + "+"), lambda w: w != "")


class WordHashes(dict):
    """Word -> 64-bit hash; computed once per word while it is remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of ``n`` words; fewer words give one for the whole sequence."""
    if len(hashes) == 0:
        return hashes
    n_here = min(n, len(hashes))
    out = np.full(len(hashes) - n_here + 1, n_here, np.uint64)
    for i in range(n_here):
        out = mixed(out * GOLDEN + hashes[i:i + len(out)])
    return out


def texts_of(batch: pa.RecordBatch, column: str = "text") -> Iterator[str]:
    """Texts one at a time, null as the empty text."""
    for value in batch.column(column):
        yield value.as_py() or ""


def like(batch_schema: str):
    """Arrow schema for a list of ``name type`` pairs."""
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(),
             "boolean": pa.bool_(), "double": pa.float64(), "array<bigint>": pa.list_(pa.int64())}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in batch_schema.split(", "))])
