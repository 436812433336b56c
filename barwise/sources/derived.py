"""Inputs derived from the bars by fixed rules (FIXTURES.md section 3).

They exercise the ingest operators on data that grows with the driver's
tables: a two-batch raw table, landed replies, and order-level candidates.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import (PRICE, QUOTE_KEY, QUOTE_PRICE, REPLY_CLOSE, REPLY_HIGH, REPLY_LOW, REPLY_OPEN, REPLY_SERIES_KEY,
                       REPLY_VOLUME)
from .bars import _orders_by_segment
from ..session import materialize
from .ingest import stamp_batch

FIRST_BATCH = "BATCH_20200101_2100"
SECOND_BATCH = "BATCH_20200102_2100"
RESENT_DAYS = 30


def two_batch_raw(bars: DataFrame) -> DataFrame:
    """The bars as a first batch, plus the last 30 distinct dates re-sent in
    a second batch with close raised by 0.01 (exact in decimal).

    The 30 latest dates are a top-k (no global window); that 30-row table is
    the only broadcast side.
    """
    bars = materialize(bars, "two_batch_bars")  # used by both batches
    first = stamp_batch(bars, FIRST_BATCH, "PRIMARY", dt.datetime(2020, 1, 1, 21, 0), "KEY0000001")
    recent = bars.select("date").distinct().orderBy(F.col("date").desc()).limit(RESENT_DAYS)
    resent = (bars.join(F.broadcast(recent), "date", "left_semi")
              .withColumn("close", (F.col("close") + F.lit(0.01).cast("decimal(3,2)")).cast(PRICE)))
    second = stamp_batch(resent, SECOND_BATCH, "PRIMARY", dt.datetime(2020, 1, 2, 21, 0),
                         "KEY0000001")
    return first.unionByName(second)


def replies_from_bars(bars: DataFrame) -> DataFrame:
    """Landed daily replies ``(symbol, body)``, one per symbol and month, so
    no reply grows with the length of a series."""
    day = F.create_map(
        F.lit(REPLY_OPEN), F.col("open").cast("string"),
        F.lit(REPLY_HIGH), F.col("high").cast("string"),
        F.lit(REPLY_LOW), F.col("low").cast("string"),
        F.lit(REPLY_CLOSE), F.col("close").cast("string"),
        F.lit(REPLY_VOLUME), F.col("volume").cast("string"))
    entry = F.struct(F.date_format("date", "yyyy-MM-dd").alias("k"), day.alias("v"))
    series = F.map_from_entries(F.collect_list(entry))
    return (bars.groupBy("symbol", F.date_format("date", "yyyy-MM").alias("_m"))
            .agg(F.to_json(F.struct(series.alias(REPLY_SERIES_KEY))).alias("body"))
            .select("symbol", "body"))


def order_candidates(spark: SparkSession, sf_dir: str, scale: float = 2.5) -> DataFrame:
    """Order-level raw candidates: one row per order, every price =
    ``scale`` x order total (doubles, before any range check)."""
    src = _orders_by_segment(spark, sf_dir)
    p = F.col("o_totalprice") * scale
    return src.select("symbol", "date", p.alias("open"), p.alias("high"), p.alias("low"),
                      p.alias("close"), F.lit(1).cast("bigint").alias("volume"),
                      F.lit("BATCH_ORDERS").alias("batch_id"),
                      F.lit("PRIMARY").alias("data_source"))


def quotes_from_bars(bars: DataFrame) -> DataFrame:
    """Latest-price replies ``(symbol, body)``: each symbol's latest close."""
    latest = bars.groupBy("symbol").agg(F.max_by("close", "date").alias("close"))
    body = F.to_json(F.struct(F.create_map(
        F.lit(QUOTE_PRICE), F.col("close").cast("string")).alias(QUOTE_KEY)))
    return latest.select("symbol", body.alias("body"))


def awkward_replies(bars: DataFrame) -> DataFrame:
    """Landed replies of every kind: the bars' own, each of them once more cut
    off in the middle, and for each symbol a quote, a rate-limit notice and an
    empty series."""
    own = replies_from_bars(bars)
    symbols = bars.select("symbol").distinct()
    cut = own.withColumn("body", F.expr("substring(body, 1, length(body) div 2)"))
    notice = symbols.withColumn("body", F.lit('{"Note": "rate limited"}'))
    empty = symbols.withColumn("body", F.to_json(F.create_map(F.lit(REPLY_SERIES_KEY), F.create_map())))
    return own.unionByName(cut).unionByName(quotes_from_bars(bars)).unionByName(notice).unionByName(empty)


def bad_days(bars: DataFrame) -> DataFrame:
    """A reply for each symbol with two days that are no dates, one price that
    is no number and one day without a volume, all after its last bar's day."""
    def day(price: F.Column, *more: F.Column) -> F.Column:
        keys = (REPLY_OPEN, REPLY_HIGH, REPLY_LOW, REPLY_CLOSE)
        return F.create_map(*[x for k in keys for x in (F.lit(k), price)], *more)
    price, volume = F.col("close").cast("string"), (F.lit(REPLY_VOLUME), F.lit("1"))
    last = bars.groupBy("symbol").agg(F.max("date").alias("date"), F.max_by("close", "date").alias("close"))
    series = F.create_map(
        F.lit("not a day"), day(price, *volume), F.lit("2024-13-45"), day(price, *volume),
        F.date_add("date", 1).cast("string"), day(F.lit("x"), *volume),
        F.date_add("date", 2).cast("string"), day(price))
    return last.select("symbol", F.to_json(F.create_map(F.lit(REPLY_SERIES_KEY), series)).alias("body"))
