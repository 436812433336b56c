"""Reading and writing tables through a configured source.

A Spark data source in Python, named ``barwise``, that takes the options of
``tables.table_options``: ``path`` (the store, any address that Arrow's file
systems know), the schema override (``sfSchema``, a folder of the store) and
``dbtable`` (a folder of the schema). A table is a set of Parquet files.

A reader has one partition a file and gives Arrow batches; columns that are not
asked for are not read. A writer's tasks stage one file each; the commit moves
all of them into the table (and, overwriting, takes the old ones away), so a
failed job leaves the table as it was.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition,
                                    WriterCommitMessage)
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

from ..session import ship_package

FORMAT, SCHEMA_OPTION, STAGING = "barwise", "sfSchema", "_staging"
#: Columns (as JSON) of a table that is about to be written first.
COLUMNS_OPTION = "columns"


def _folder(options) -> tuple[fs.FileSystem, str]:
    options = {k.lower(): v for k, v in options.items()}  # Spark does not keep their case
    missing = [k for k in ("path", "dbtable") if not options.get(k)]
    if missing:
        raise ValueError(f"the source needs the options {missing}")
    store, root = fs.FileSystem.from_uri(options["path"])
    return store, posixpath.join(root, options.get(SCHEMA_OPTION.lower()) or "default", options["dbtable"])


def _files(store: fs.FileSystem, folder: str) -> list[str]:
    found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted(f.path for f in found if f.is_file and f.path.endswith(".parquet"))


@dataclass
class OneFile(InputPartition):
    path: str

    def __init__(self, path: str):
        self.path = path


@dataclass
class Staged(WriterCommitMessage):
    path: str | None


class TableReader(DataSourceReader):
    def __init__(self, options, schema: StructType):
        self.options, self.columns = dict(options), schema.fieldNames()

    def partitions(self) -> list[InputPartition]:
        return [OneFile(p) for p in _files(*_folder(self.options))] or [OneFile("")]

    def read(self, partition: OneFile) -> Iterator[pa.RecordBatch]:
        if partition.path:
            store, _ = _folder(self.options)
            with store.open_input_file(partition.path) as f:
                yield from pq.ParquetFile(f).iter_batches(columns=self.columns)


class TableWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.options, self.overwrite, self.run = dict(options), overwrite, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        store, folder = _folder(self.options)
        staging = posixpath.join(folder, STAGING, self.run)
        path, out = posixpath.join(staging, f"{uuid.uuid4().hex}.parquet"), None
        for batch in iterator:
            if out is None:
                store.create_dir(staging, recursive=True)
                out = pq.ParquetWriter(path, batch.schema, filesystem=store)
            out.write_batch(batch)
        if out is None:
            return Staged(None)
        out.close()
        return Staged(path)

    def commit(self, messages: list[Staged | None]) -> None:
        store, folder = _folder(self.options)
        old = _files(store, folder) if self.overwrite else []
        store.create_dir(folder, recursive=True)
        for m in messages:
            if m is not None and m.path:
                store.move(m.path, posixpath.join(folder, f"part-{posixpath.basename(m.path)}"))
        for path in old:
            store.delete_file(path)
        self._clear(store, folder)

    def abort(self, messages: list[Staged | None]) -> None:
        self._clear(*_folder(self.options))

    def _clear(self, store: fs.FileSystem, folder: str) -> None:
        staging = posixpath.join(folder, STAGING, self.run)
        if store.get_file_info(staging).type != fs.FileType.NotFound:
            store.delete_dir(staging)


class TableSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        store, folder = _folder(self.options)
        files = _files(store, folder)
        if not files and self.options.get(COLUMNS_OPTION):
            return StructType.fromJson(json.loads(self.options[COLUMNS_OPTION]))
        if not files:
            raise ValueError(f"no table at {folder}: give its schema, or write it first")
        with store.open_input_file(files[0]) as f:
            return from_arrow_schema(pq.read_schema(f))

    def reader(self, schema: StructType) -> TableReader:
        return TableReader(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> TableWriter:
        return TableWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Make the source known to a session (once is enough)."""
    ship_package(spark)
    spark.dataSource.register(TableSource)


def read_source(spark: SparkSession, options: dict, schema: StructType | None = None) -> DataFrame:
    """The table that ``options`` name; without a table, rows of ``schema``."""
    register(spark)
    reader = spark.read.format(FORMAT).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load()


def write_source(df: DataFrame, options: dict, mode: str = "append") -> None:
    """Append to the table that ``options`` name, or ``overwrite`` it."""
    register(df.sparkSession)
    df.write.format(FORMAT).options(**options, **{COLUMNS_OPTION: df.schema.json()}).mode(mode).save()
