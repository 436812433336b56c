"""From raw documents to packed training sequences, in five stages.

Each stage takes the session, the documents that its predecessor kept and
the data folder, and returns a DataFrame; ``run`` writes each stage's result
as Parquet to the shared folder and reads it back, which also cuts lineage.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barwise.llm.common import materialize, table
from barwise.llm.minhash import drop_near_duplicate_rows
from barwise.llm.packing import pack
from barwise.llm.pii import redact
from barwise.llm.quality import filter_quality, train
from barwise.llm.suffix import decontaminate


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return filter_quality(docs, train(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return drop_near_duplicate_rows(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage of weight."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the training sequences."""
    return pack(docs)


STAGES = [
    ("quality_classifier", quality),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("pii", personal_data),
    ("best_fit_packing", packing),
]

#: No stage can be written in SQL (trained model, hashing, tokenizer): the
#: tests compare each with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
