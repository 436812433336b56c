"""Operator 5: token ids as Parquet list columns.

Documents are sorted by id over the whole table, encoded, and written as
(doc_id, n_tokens, ids): ids as a list column with dictionary or delta
encoding, with row groups and pages of a set size. Parquet's page indexes
and the order let a reader take some documents' pages, or counts without
ids. File names follow the order, so a document's place in the whole stream
is the sum of the counts before it.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .common import ship_package, table
from .tokens import by_size, encoder

VOCABULARY, END_ID = "byte_bpe_50k.json", 0
#: Sizes of row groups and pages, documents of a page at most, files of a group of starts.
ROW_GROUP_BYTES, PAGE_BYTES, PAGE_ROWS, GROUP_FILES = 32 << 20, 256 << 10, 512, 1024


def token_rows(docs: DataFrame, vocabulary: str = VOCABULARY, end_id: int = END_ID,
               spaces: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids) of ``docs`` (doc_id, text), in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary, spaces)
        end = np.uint32(end_id).astype("<u4").tobytes()
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            for at, stop in by_size(sizes):  # bounds the ids held at once
                part = batch.slice(at, stop - at)
                ids = [x + end for x in enc.encode(part.column(1).to_pylist())]
                size = np.array([len(x) // 4 for x in ids], np.int64)
                values = pa.array(np.frombuffer(b"".join(ids), "<i4"), pa.int32())
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()), values)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(size), lists],
                                                 names=["doc_id", "n_tokens", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids array<int>")


def write_token_files(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                      vocabulary: str = VOCABULARY, end_id: int = END_ID, spaces: bool = True,
                      encoding: str = "dictionary", row_group_bytes: int = ROW_GROUP_BYTES,
                      page_bytes: int = PAGE_BYTES, page_rows: int = PAGE_ROWS) -> None:
    """Write the token ids of ``docs`` to ``path``, in ascending id order.

    ``encoding``: "dictionary" (ids as references to the ids of a row group)
    or "delta" (differences, bit-packed). Null and empty texts are the end id
    alone; rows without an id come first, rows that repeat one stay together,
    ordered by text. An empty table gives a table without rows.
    """
    ship_package(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    in_order = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    delta = encoding == "delta"
    (token_rows(in_order, vocabulary, end_id, spaces).write.mode("overwrite")
     .option("compression", "zstd")
     .option("parquet.block.size", row_group_bytes).option("parquet.page.size", page_bytes)
     .option("parquet.page.row.count.limit", page_rows)
     .option("parquet.writer.version", "PARQUET_2_0" if delta else "PARQUET_1_0")
     .option("parquet.enable.dictionary", str(not delta).lower())
     .parquet(path))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from files of ``write_token_files``.

    ``start`` is the number of ids in the documents before; both it and the
    counts come from the ids as read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            values = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4").view(np.uint8)
            at = lists.offsets.to_numpy()
            crc = [zlib.crc32(values[4 * a:4 * b]) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("row"), batch.column("doc_id"),
                 pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())],
                names=["file", "row", "doc_id", "n_tokens", "ids_crc32"])

    number = F.regexp_extract(F.col("_metadata.file_name"), r"part-([0-9]+)", 1).cast("long")
    rows = spark.read.schema("doc_id long, n_tokens long, ids array<int>").parquet(path).select(
        number.alias("file"), F.col("_metadata.row_index").alias("row"), "doc_id", "ids")
    read = rows.mapInArrow(run, "file long, row long, doc_id long, n_tokens long, ids_crc32 long")
    # counts by file, from the count column alone; files go by their number,
    # added up in groups so that no task holds all of them
    group = F.col("file") - F.pmod("file", F.lit(GROUP_FILES))
    totals = (spark.read.schema("n_tokens long").parquet(path).groupBy(number.alias("file"))
              .agg(F.sum("n_tokens").alias("n")).withColumn("group", group))

    def earlier(window):
        return F.coalesce(F.sum("n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    groups = totals.groupBy("group").agg(F.sum("n").alias("n")).select(
        "group", earlier(Window.orderBy("group")).alias("before"))
    totals = totals.withColumn("within", earlier(Window.partitionBy("group").orderBy("file"))).join(groups, "group")
    totals = totals.select("file", (F.col("before") + F.col("within")).alias("first"))
    inside = Window.partitionBy("file").orderBy("row")
    return (read.withColumn("n", F.col("n_tokens")).withColumn("inside", earlier(inside))
            .join(totals, "file")
            .select("doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"))


def read_documents(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    """(doc_id, n_tokens, ids) of the documents ``ids``.

    Files lie in id order with page indexes, so only the pages that can hold
    one of the ids are read, of the token column as well."""
    rows = spark.read.schema("doc_id long, n_tokens long, ids array<int>").parquet(path)
    return rows.where(F.col("doc_id").isin([int(i) for i in ids]))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{checkpoint_dir(spark).rstrip('/')}/barwise/tokens-{uuid.uuid4().hex}"
    write_token_files(table(spark, sf_dir, "documents"), path)
    return read_token_files(spark, path)
