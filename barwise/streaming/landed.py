"""Incremental ingest of landed reply files with Structured Streaming.

The reference runs its ingest as a scheduled batch job. Here a file-source
stream picks up each newly landed reply file exactly once (the stream
checkpoint records which files were read), and every micro-batch runs the
same batch operators: parse (S1) -> stamp (S3) -> reject split (S6) -> one row
a day -> latest days (S2) -> append (S7) -> verify (S8) -> run log (S10).

``trigger(availableNow=True)`` processes everything landed so far and
stops, which is the scheduled-run behaviour; a processing-time trigger
keeps it running. A batch id is made of the stream's own id, which is kept in
its checkpoint folder, and the micro-batch's epoch: a retried micro-batch
rewrites its own partition, and no other stream or later checkpoint folder
makes the same id. The checkpoint folder must be named by the caller and stay
the same from run to run: without it a restart would begin anew.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schemas import BATCH_PREFIX, RAW_BARS, REPLIES
from ..sources.ingest import (dedupe_latest_batch, latest_n, parse_landed, stamp_batch, tag_rejects,
                              with_fallback)
from ..sources.tables import log_row, read_or_empty, verify_batch, write_with_backup

#: Where the rows of a run went: landed = stored + repeated + older + rejected.
ACCOUNTING = ("batch_id string, landed long, stored long, repeated long, older long, rejected long, "
              "lost_replies long, verified long")


def epoch_batch_id(stream_id: str, epoch_id: int) -> str:
    return f"{BATCH_PREFIX}{stream_id}_{epoch_id:08d}"


def stream_id(spark: SparkSession, checkpoint_location: str) -> str:
    """The id of the stream that owns a checkpoint folder, made on first use."""
    path = f"{checkpoint_location.rstrip('/')}/barwise_stream"
    try:
        rows = spark.read.schema("value string").text(path).collect()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        rows = []
    if rows:
        return rows[0][0]
    new = uuid.uuid4().hex[:12]
    spark.createDataFrame([(new,)], "value string").coalesce(1).write.text(path)
    return new


def ingest_batch(replies: DataFrame, raw_path: str, rejects_path: str, log_path: str,
                 batch_id: str, source: str = "PRIMARY",
                 load_ts: dt.datetime | None = None, keep_days: int | None = None,
                 fallback: DataFrame | None = None, api_key: str | None = None,
                 backup_path: str | None = None, retry: bool = False,
                 accounting_path: str | None = None) -> dict:
    """One complete ingest run over a frame of replies ``(symbol, body)``.

    Parse (S1), stamp (S3, with the key masked, S4), tag rejects (S6; replies
    without a series are rejects too), take ``fallback`` rows if no reply has a
    good day (S5), one row a day and symbol, keep the latest ``keep_days`` days
    of each symbol (S2), append (S7, S11: with ``backup_path`` a batch that
    can't be stored is dumped there), verify (S8) and log (S10).

    Bodies are parsed once: the tagged rows are kept for the run. The counts
    are observed while the batch and its rejects are written, and every landed
    row ends in one of them: stored, repeated (another copy of its day was
    taken), older (than the days kept) or rejected. The returned counts
    (``ACCOUNTING``) are appended to ``accounting_path``, if given.
    """
    spark = replies.sparkSession
    load_ts = load_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)

    def stamped(df: DataFrame) -> DataFrame:  # rows that name their source keep it
        own = F.col("data_source") if "data_source" in df.columns else F.lit(None).cast("string")
        out = stamp_batch(df.withColumn("_source", own), batch_id, source, load_ts, api_key)
        return out.withColumn("data_source", F.coalesce("_source", F.lit(source))).drop("_source")

    tagged = tag_rejects(stamped(parse_landed(replies, batch_id, source)))
    tagged = tagged.withColumn("reject_reason", F.when(F.col("kind") != "quote", F.col("reject_reason")))
    tagged = tagged.persist()
    try:
        rows = tagged.where(F.col("kind") != "quote").drop("kind", "price")
        good = F.col("reject_reason").isNull()
        if fallback is not None:
            rows = with_fallback(rows, tag_rejects(stamped(fallback)), good)
        count = F.count(F.lit(1)).alias("n")
        seen, days, kept, lost = (Observation() for _ in range(4))
        clean = dedupe_latest_batch(rows.where(good).drop("reject_reason").observe(seen, count)).observe(days, count)
        if keep_days is not None:
            clean = latest_n(clean, keep_days)
        clean = clean.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_BARS.fields]).observe(
            kept, count, F.min("data_source").alias("first"), F.max("data_source").alias("last"))
        write_with_backup(clean, raw_path, backup_path or f"{rejects_path}-backup", retry, [batch_id])
        bad = rows.where(~good).observe(lost, count, F.count_if(F.col("date").isNull() & F.col("reject_reason").isin(
            "BAD_JSON", "NO_SERIES", "EMPTY_SERIES")).alias("replies"))
        (bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(rejects_path))
        verified = verify_batch(read_or_empty(spark, raw_path, RAW_BARS), batch_id).first()["verified"]
    finally:
        tagged.unpersist()
    n, m, k, r = (x.get for x in (seen, days, kept, lost))
    one = k["first"] if k["first"] == k["last"] else "MIXED"
    account = {"batch_id": batch_id, "landed": n["n"] + r["n"], "stored": k["n"], "repeated": n["n"] - m["n"],
               "older": m["n"] - k["n"], "rejected": r["n"], "lost_replies": r["replies"], "verified": verified}
    log = log_row(spark, batch_id, k["n"], r["n"], verified, one, logged_at=load_ts)
    tables = [(log, log_path)]
    if accounting_path:
        tables.append((spark.createDataFrame([account], ACCOUNTING), accounting_path))
    for table, path in tables:
        (table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(path))
    return account


def ingest_landed(spark: SparkSession, landing_dir: str, raw_path: str, rejects_path: str,
                  log_path: str, checkpoint_location: str,
                  source: str = "PRIMARY", available_now: bool = True,
                  processing_time: str | None = None, **how) -> StreamingQuery:
    """Start the incremental ingest of JSON-lines reply files in ``landing_dir``.

    Each line is ``{"symbol": ..., "body": "<reply JSON text>"}``.
    ``checkpoint_location`` is a shared folder of this stream's own; further
    arguments go to ``ingest_batch``.
    """
    if not checkpoint_location:
        raise ValueError("a stream needs a checkpoint folder that outlives its runs")
    own = stream_id(spark, checkpoint_location)
    stream = spark.readStream.schema(REPLIES).json(landing_dir).select(
        "symbol", "body", F.col("_metadata.file_modification_time").alias("landed_at"),
        F.col("_metadata.file_path").alias("landed_file"))

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        ingest_batch(batch, raw_path, rejects_path, log_path, epoch_batch_id(own, epoch_id), source,
                     retry=True, **how)

    writer = (stream.writeStream.foreachBatch(per_batch)
              .option("checkpointLocation", checkpoint_location))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
