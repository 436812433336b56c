"""Operator 4: best-fit decreasing packing of token sequences.

Best-fit decreasing looks at lengths only, and there are no more lengths
than the capacity. So the corpus is first counted: pieces by length, one
bounded table whatever the number of documents. The packing is then planned
on whole classes: all open bins with the same free space stand at one leaf of
a segment tree over remaining capacities, which names the tightest leaf that
takes the next length in logarithmic time. One step serves as many equal
pieces and equal bins as there are, and the outcome is the one of placing
piece after piece. Spark numbers the pieces of each length and looks up
their bins in the plan; no document passes through the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, ship_package, table
from .tokens import by_size, encoder

CAPACITY, END_ID = 2048, 0
VOCABULARY = "word_bpe_49k.json"
#: Words of a worker's cache and bytes of text that are encoded at once: small,
#: as packing ends a pipeline whose workers hold memory of earlier stages.
CACHE_WORDS, CHUNK = 100_000, 1 << 20
#: Pieces of one length that are numbered together, parts that are added up together.
PART_PIECES, BLOCK_PARTS = 500, 1024


class SegmentTree:
    """Which free capacities 0..size have open bins."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.any = [False] * (2 * self.leaves)

    def set(self, at: int, present: bool) -> None:
        i = at + self.leaves
        self.any[i] = present
        while i > 1:
            i //= 2
            self.any[i] = self.any[2 * i] or self.any[2 * i + 1]

    def first_from(self, at: int) -> int | None:
        """The smallest present capacity >= ``at``."""
        i = at + self.leaves
        if self.any[i]:
            return at
        while i > 1:
            if i % 2 == 0 and self.any[i + 1]:
                i += 1
                break
            i //= 2
        else:
            return None
        while i < self.leaves:
            i = 2 * i if self.any[2 * i] else 2 * i + 1
        return i - self.leaves


def best_fit_plan(counts: dict[int, int], capacity: int) -> pd.DataFrame:
    """Places for ``counts[length]`` pieces of each length, longest first.

    A row says: pieces ``first`` up to the next row's ``first`` of this
    length go to the bins from ``bin`` on, ``each`` to a bin, the first of a
    bin at ``offset``.
    """
    tree = SegmentTree(capacity)
    open_: dict[int, list[tuple[int, int]]] = {}
    rows, bins = [], 0

    def put(free: int, start: int, n: int) -> None:
        if n and free:
            open_.setdefault(free, []).append((start, n))
            tree.set(free, True)

    for length in sorted(counts, reverse=True):
        left, k = counts[length], 0
        while left:
            free = tree.first_from(length)
            if free is None:
                free, start = capacity, bins
                n = -(-left // (capacity // length))
                bins += n
            else:
                start, n = open_[free].pop()
                if not open_[free]:
                    tree.set(free, False)
            each = free // length
            rows.append((length, k, start, each, capacity - free))
            full = min(n, left // each)
            put(free - each * length, start, full)
            k, left = k + full * each, left - full * each
            if full < n and left:  # the last pieces of this length, fewer than fit
                put(free - left * length, start + full, 1)
                k, left, full = k + left, 0, full + 1
            put(free, start + full, n - full)
    return pd.DataFrame(rows, columns=["length", "first", "bin", "each", "offset"])


def pieces(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY, end_id: int = END_ID,
           spaces: bool = False, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of ``docs`` (doc_id, text).

    A document's ids with the end id, cut where they exceed the capacity."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(vocabulary, spaces, CACHE_WORDS, CHUNK)
        end = np.uint32(end_id).astype("<u4").tobytes()
        for pdf in (b.iloc[i:j] for b in batches for i, j in by_size(
                b["text"].str.len().fillna(0).tolist(), CHUNK)):
            rows = []
            for doc_id, ids in zip(pdf["doc_id"], enc.encode(list(pdf["text"]))):
                ids += end
                for p, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    rows.append((doc_id, p, at // 4, len(part) // 4, zlib.crc32(part),
                                 *([np.frombuffer(part, "<i4")] if with_ids else [])))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32",
                                              *(["ids"] if with_ids else [])]).astype({"doc_id": "Int64"})

    ids = ", ids array<int>" if with_ids else ""
    return docs.select("doc_id", "text").mapInPandas(
        run, f"doc_id long, piece int, start long, length long, ids_crc32 long{ids}")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
         capacity: int = CAPACITY, end_id: int = END_ID, spaces: bool = False, with_ids: bool = False) -> DataFrame:
    """One row per piece: (doc_id, piece, start, length, ids_crc32,
    sequence_id, offset[, ids]).

    Null and empty texts are the end id alone. Every row is packed, also rows
    that repeat an id or have none. A document longer than the capacity is
    cut into full pieces and a last one. An empty table gives no rows. Other
    columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    cut = materialize(pieces(docs, vocabulary, capacity, end_id, spaces, with_ids), "pieces")
    counts = {r[0]: r[1] for r in cut.groupBy("length").agg(F.count(F.lit(1))).collect()}  # capacity rows at most
    # number the pieces of each length: dealt by hash over parts of about
    # PART_PIECES, rows in any order; the parts' counts give each its first number
    parts = spark.createDataFrame([(n, -(-c // PART_PIECES)) for n, c in counts.items()], "length long, parts long")
    key = F.xxhash64("_metadata.file_name", "_metadata.row_index")
    dealt = (cut.withColumn("key", key).join(F.broadcast(parts), "length")  # capacity rows at most
             .withColumn("part", F.pmod(F.col("key"), F.col("parts"))))

    def earlier(window):
        return F.coalesce(F.sum("n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    sizes = dealt.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "block", F.floor(F.col("part") / BLOCK_PARTS))
    blocks = sizes.groupBy("length", "block").agg(F.sum("n").alias("n")).select(
        "length", "block", earlier(Window.partitionBy("length").orderBy("block")).alias("blocks"))
    first = (sizes.withColumn("within", earlier(Window.partitionBy("length", "block").orderBy("part")))
             .join(blocks, ["length", "block"])
             .select("length", "part", (F.col("blocks") + F.col("within")).alias("before")))
    rank = Window.partitionBy("length", "part").orderBy("key")
    numbered = (dealt.withColumn("k", F.row_number().over(rank) - 1).join(first, ["length", "part"])
                .withColumn("k", F.col("k") + F.col("before")))
    plan = best_fit_plan(counts, capacity)
    plan = spark.sparkContext.broadcast({n: g.drop(columns="length").to_numpy() for n, g in plan.groupby("length")})

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            pdf = pdf.reset_index(drop=True)
            out = np.zeros((2, len(pdf)), np.int64)
            k = pdf["k"].to_numpy()
            for length, at in pdf.groupby("length").indices.items():
                steps = plan.value[length]
                step = steps[np.searchsorted(steps[:, 0], k[at], side="right") - 1]
                past = k[at] - step[:, 0]
                out[0, at] = step[:, 1] + past // step[:, 2]
                out[1, at] = step[:, 3] + past % step[:, 2] * length
            yield pdf.drop(columns="k").assign(sequence_id=out[0], offset=out[1])

    kept = ["doc_id", "piece", "start", "length", "ids_crc32"] + (["ids"] if with_ids else [])
    ids = ", ids array<int>" if with_ids else ""
    return numbered.select(*kept, "k").mapInPandas(
        place, f"doc_id long, piece int, start long, length long, ids_crc32 long{ids}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids) of a packing made ``with_ids``; a group
    holds ``capacity`` ids at most."""
    held = packed.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id"))).alias("parts"))
    return held.select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
