"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, ship_package
from .tokens import by_size

__all__ = ["materialize", "table", "fresh", "keyed", "crc_mod", "in_chunks", "U64", "mix64", "span_hashes",
           "lower_words"]

#: Characters of text whose results a worker holds at once.
CHUNK_CHARS = 1 << 20

U64 = np.uint64
# any odd 64-bit constant serves as the base of the rolling hash
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
# longest span that is hashed by the polynomial alone
_ROLLED = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of a data folder (any path Spark can read)."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keyed(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``df`` written once with a key of its own for each row (from 0, below
    2^61), and the key's column name. The written keys don't change any more."""
    key = fresh(df, "_row")
    return materialize(df.withColumn(key, F.monotonically_increasing_id()), label), key


def crc_mod(col: str, m: int) -> Column:
    """crc32 of a column's text, modulo ``m`` (null stays null)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % m


def in_chunks(batches: Iterator[pd.DataFrame], text: str = "text", limit: int = CHUNK_CHARS) -> Iterator[pd.DataFrame]:
    """All rows of ``batches`` in order, in frames of about ``limit``
    characters of text or one row. What is made of a frame goes before the
    next one comes, so a worker's memory does not grow with Spark's batches."""
    for pdf in batches:
        for i, j in by_size(pdf[text].str.len().fillna(0).tolist(), limit):
            yield pdf.iloc[i:j]
        pa.default_memory_pool().release_unused()


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every output bit depends on every input bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class _Powers:
    """Powers of the base and of its inverse, grown as longer texts come."""

    def __init__(self):
        self.up = np.ones(1, U64)
        self.down = np.ones(1, U64)
        # each byte value stands for a random word, so that bytes that differ
        # in one bit do not give nearly equal sums
        self.byte = np.random.default_rng(20240229).integers(0, 1 << 63, 256, dtype=np.uint64) | U64(1)

    def upto(self, n: int):
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            for name, base in (("up", _BASE), ("down", _BASE_INV)):
                a = np.full(size, U64(base), U64)
                a[0] = 1
                setattr(self, name, np.multiply.accumulate(a))
        return self.up, self.down


_POWERS = _Powers()


def span_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``data[s:e]`` for all spans at once.

    A rolling polynomial over the bytes: prefix sums, then one difference a
    span, brought to position 0 by the inverse power. Equal bytes give equal
    hashes wherever they stand. Spans of more than ``_ROLLED`` bytes are
    hashed one by one: there are unlike byte strings of 1,024 bytes and more
    whose polynomials agree modulo 2^64 for every base.
    """
    if not len(starts):
        return np.empty(0, U64)
    up, down = _POWERS.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, U64)
    codes = _POWERS.byte[np.frombuffer(data, np.uint8)]
    np.cumsum(codes * up[:len(data)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    h = mix64(h + (ends - starts).astype(U64))
    for i in np.flatnonzero(ends - starts > _ROLLED):
        h[i] = xxhash.xxh3_64_intdigest(data[starts[i]:ends[i]])
    return h


#: ASCII bytes that are no part of a word become spaces; bytes from 0x80 stay.
_WORD_TABLE = bytes(
    c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else (c + 32 if 0x41 <= c <= 0x5A else 0x20)
    for c in range(256))


def lower_words(text: str | None) -> list[bytes]:
    """A-Z lower-cased, then the runs of a-z, 0-9 and non-ASCII characters."""
    return [] if not text else text.encode("utf-8", "surrogatepass").translate(_WORD_TABLE).split()
