"""Table lifecycle, sinks and checks.

Writes go through the DataFrame writer only (no SQL text built from
values). The raw table is Parquet partitioned by ``batch_id``. A new batch is
appended and must bring an id that the table does not have; a retry of a
batch (the same id, on purpose) replaces its own partition.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ENRICHED_COLUMNS, RAW_BARS, RUN_LOG
from ..session import path_exists
from .ingest import PRICES

CONF_PREFIX = "spark.barwise.source."


RAW_KEY = ("symbol", "date", "batch_id")


def enforce_key(df: DataFrame, key: tuple[str, ...] = RAW_KEY) -> DataFrame:
    """``df`` with its key enforced while it is computed: a row whose key
    is null in part, or a key that is given twice, fails the job that writes
    the frame, and Spark's commit protocol then leaves nothing of it.

    One aggregation by key; rows of a key meet in one task, so copies of one
    key are counted map-side and never gathered."""
    others = [c for c in df.columns if c not in key]
    names = ", ".join(key)
    whole = F.lit(True)
    for c in key:
        whole = whole & F.col(c).isNotNull()
    found = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_copies"), F.any_value(F.struct(*others)).alias("_row"))
    shown = F.concat_ws(", ", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in key])
    error = F.raise_error(F.concat(F.lit(f"key ({names}) is null or repeated: "), shown))
    # the error takes the place of a value of the row, so no plan can leave it out
    row = F.when(whole & (F.col("_copies") == 1), F.col("_row")).otherwise(error)
    checked = found.select(*key, row.alias("_row"))
    return checked.select(*[F.col(c) if c in key else F.col("_row")[c].alias(c) for c in df.columns])


def append_raw(df: DataFrame, path: str, retry: bool = False, batch_ids: list[str] | None = None,
               keyed: bool = True) -> None:
    """Append a batch to the raw table (one partition per batch id).

    An id that the table already has is an error, unless ``retry`` says that
    this is the same batch again: its partition is then replaced. ``batch_ids``
    names the ids of ``df`` if the caller knows them; else they are looked up.
    The table's key (symbol, date, batch_id) is enforced (S14) unless ``keyed``
    is off: a null or repeated key fails the append and nothing is written.
    """
    rows = df.select(*[f.name for f in RAW_BARS.fields])
    if retry:
        writer = (enforce_key(rows) if keyed else rows).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic")
    else:
        spark = df.sparkSession
        own = rows.select("batch_id").distinct() if batch_ids is None else spark.createDataFrame(
            [(b,) for b in batch_ids], "batch_id string")
        stored = read_or_empty(spark, path, RAW_BARS).select("batch_id").distinct()
        again = own.join(stored, "batch_id", "left_semi")
        ids = [r[0] for r in again.limit(10).collect()]
        if ids:
            raise ValueError(f"{path} already has the batches {ids} (10 are named at most); a retry must say so")
        writer = (enforce_key(rows) if keyed else rows).write.mode("append")
    writer.partitionBy("batch_id").parquet(path)


def verify_batch(source, batch_id: str, spark: SparkSession | None = None) -> DataFrame:
    """``(batch_id, verified)`` = rows stored for the batch.

    ``source`` is a DataFrame or a table path; on a path the filter prunes
    to the batch's partition.
    """
    df = read_or_empty(spark, source, RAW_BARS) if isinstance(source, str) else source
    return (df.where(F.col("batch_id") == F.lit(batch_id))
            .agg(F.count(F.lit(1)).alias("verified"))
            .select(F.lit(batch_id).alias("batch_id"), "verified"))


def run_log(good: DataFrame, rejects: DataFrame, verified: DataFrame, batch_id: str,
            name: str = "daily_bars", logged_at: dt.datetime | None = None) -> DataFrame:
    """One log row for a batch.

    ``data_source`` is the source of the stored rows (``MIXED`` when they
    disagree); status is ``SUCCESS`` only when nothing was rejected and the
    stored count equals the inserted one, else ``PARTIAL``. The reject and
    verified counts enter as scalar subqueries (no join of one-row frames).
    """
    errors = rejects.select(F.count(F.lit(1))).scalar()
    stored = verified.select(F.sum("verified")).scalar()
    inserted = F.count(F.lit(1))
    source = F.when(F.min("data_source") == F.max("data_source"), F.min("data_source")) \
        .when(F.count("data_source") > 0, F.lit("MIXED")).otherwise(F.lit("UNKNOWN"))
    row = good.agg(inserted.alias("inserted"), source.alias("data_source"))
    ok = (F.lit(0) == errors) & (F.col("inserted") == stored)
    out = row.select(
        F.lit(name).alias("pipeline_name"),
        F.lit(batch_id).alias("batch_id"),
        "data_source",
        F.col("inserted").alias("rows_processed"),
        F.when(ok, F.lit("SUCCESS")).otherwise(F.lit("PARTIAL")).alias("status"),
        F.format_string("Inserted: %d, Errors: %d, Verified: %d",
                        F.col("inserted"), errors, F.coalesce(stored, F.lit(0))).alias("details"))
    if logged_at is not None:
        out = out.withColumn("logged_at", F.lit(logged_at).cast("timestamp"))
    return out


def log_row(spark: SparkSession, batch_id: str, inserted: int, errors: int, verified: int,
            source: str | None, name: str = "daily_bars", logged_at: dt.datetime | None = None) -> DataFrame:
    """S10 from numbers that a run has gathered; columns and rules as
    ``run_log``."""
    status = "SUCCESS" if errors == 0 and inserted == verified else "PARTIAL"
    details = f"Inserted: {inserted}, Errors: {errors}, Verified: {verified}"
    return spark.createDataFrame([(name, batch_id, source or "UNKNOWN", inserted, status, details, logged_at)],
                                 RUN_LOG)


def write_with_backup(df: DataFrame, path: str, backup: str, retry: bool = False,
                      batch_ids: list[str] | None = None) -> None:
    """Write the batch; on failure dump it as JSON to ``backup`` and
    re-raise. If the dump fails too, both errors are raised together."""
    try:
        append_raw(df, path, retry, batch_ids)
    except Exception as first:
        try:
            df.write.mode("overwrite").json(backup)
        except Exception as second:
            raise ExceptionGroup("the batch and its backup could not be written", [first, second])
        raise


def scan_enriched(df: DataFrame) -> DataFrame:
    """S12 on a frame: names lower-cased, the 21 named columns, date typed,
    ordered by (symbol, date)."""
    df = df.toDF(*[c.lower() for c in df.columns]).select(*ENRICHED_COLUMNS)
    return df.withColumn("date_trading", F.to_date("date_trading")).orderBy(
        "symbole", "date_trading")


def write_enriched(df: DataFrame, path: str) -> None:
    """Store the enriched table partitioned by year of ``date_trading``, so a
    served date filter prunes whole years; re-written years are replaced."""
    (df.withColumn("annee", F.year("date_trading"))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("annee").parquet(path))


def serve_enriched(spark: SparkSession, path: str, days: int | None = None) -> DataFrame:
    """The stored enriched table for a view: with ``days``, only the year
    partitions that the last ``days`` days reach are read. The latest date
    comes from the newest year partition alone."""
    table = spark.read.parquet(path)
    if days is not None:
        last = as_of(spark, path)
        if last is not None:
            table = table.where(F.col("annee") >= (last - dt.timedelta(days=days)).year)
    return table.drop("annee")


def as_of(spark: SparkSession, path: str):
    """The latest ``date_trading`` of a stored enriched table, or None."""
    table = spark.read.parquet(path)
    year = table.select(F.max("annee")).first()[0]  # partition values, no data column
    return None if year is None else table.where(F.col("annee") == year).select(
        F.max("date_trading")).first()[0]


def enriched_scan(spark: SparkSession, path: str) -> DataFrame:
    """Read the stored enriched table (only the named columns are read)."""
    return scan_enriched(spark.read.parquet(path))


def table_options(spark: SparkSession, name: str | None = None,
                  schema: str | None = None, schema_key: str = "sfSchema") -> dict:
    """reader/writer options of the configured source; ``schema``
    overrides the option named ``schema_key``.

    Base options come from Spark conf keys ``spark.barwise.source.<opt>``
    (set by the deployment, never in code); ``name`` becomes ``dbtable``.
    """
    opts = {}
    for k, v in spark.sparkContext.getConf().getAll():
        if k.startswith(CONF_PREFIX):
            opts[k[len(CONF_PREFIX):]] = v
    if schema:
        opts[schema_key] = schema
    if name:
        opts["dbtable"] = name
    return opts


def create_table(spark: SparkSession, name: str, schema: T.StructType = RAW_BARS,
                 path: str | None = None, partition_by: list[str] | None = None) -> None:
    """Create (or replace) a Parquet table from a StructType."""
    writer = spark.createDataFrame([], schema).write.format("parquet").mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """The whole table."""
    return spark.table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """S15. The name is quoted part by part, never taken as SQL."""
    quoted = ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))
    spark.sql(f"DROP TABLE IF EXISTS {quoted}")


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, rows, nulls, min, max.

    One aggregate job for all columns (min and max as text)."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(df.columns):
        aggs += [F.count(F.col(c)).alias(f"_c{i}"),
                 F.min(c).cast("string").alias(f"_lo{i}"),
                 F.max(c).cast("string").alias(f"_hi{i}")]
    wide = df.agg(*aggs)
    entries = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"),
                        F.lit(t).alias("data_type"),
                        F.col("_n").alias("n_rows"),
                        (F.col("_n") - F.col(f"_c{i}")).alias("n_nulls"),
                        F.col(f"_lo{i}").alias("min_value"),
                        F.col(f"_hi{i}").alias("max_value"))
               for i, (c, t) in enumerate(df.dtypes)]
    return wide.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def table_sample(df: DataFrame, order_by: list[str], k: int = 5) -> DataFrame:
    """``k`` sample rows, deterministic (first k in ``order_by``)."""
    return df.orderBy(*order_by).limit(k)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The table at ``path``, or an empty frame when the path is missing.

    Any read error is raised."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


__all__ = ["PRICES", "append_raw", "enforce_key", "verify_batch", "run_log", "log_row", "write_with_backup",
           "scan_enriched", "write_enriched", "serve_enriched", "as_of", "enriched_scan", "table_options", "create_table", "read_table", "drop_table",
           "table_profile", "table_sample", "read_or_empty"]
