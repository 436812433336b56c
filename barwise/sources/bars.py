"""Daily bars built from the driver's TPC-H-like tables.

The driver's tables hold no prices, so every query and its DuckDB oracle
build bars from them by the same rule (FIXTURES.md section 3):

* ``order_bars``: symbol = customer market segment, date = order date,
  price p = 1% of the order total as decimal(10,4); open/close = p of the
  lowest/highest order key of the day, high/low = max/min p, volume = orders.
* ``walk_bars``: same rows, but close is a random walk: 4000 + running sum of
  a daily step, open = previous close (4000 on the first day).
* ``brand_bars``: symbol = part brand, date = ship date, price = extended
  price / quantity, ordered by a five-column line key; volume = quantity.

All three are single aggregates (partial aggregation before the shuffle, so a
hot segment or brand costs no more than a cold one). Joins use Spark's own
size-checked broadcast (``autoBroadcastJoinThreshold``, and AQE at run time)
and fall back to a shuffle join, with AQE splitting skewed join partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.series import running_sums
from ..session import materialize
from ..schemas import PRICE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _order_price() -> F.Column:
    # exact in Spark and DuckDB: decimal multiply, no division
    return (F.col("o_totalprice").cast("decimal(12,2)")
            * F.lit(0.01).cast("decimal(3,2)")).cast(PRICE)


def _walk_step() -> F.Column:
    return ((F.floor(F.col("o_totalprice") / 100).cast("decimal(6,0)") - 2500)
            * F.lit(0.01).cast("decimal(3,2)"))


def _orders_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return (orders.join(customers, orders.o_custkey == customers.c_custkey)
            .select(F.col("c_mktsegment").alias("symbol"),
                    F.to_date("o_orderdate").alias("date"),
                    "o_orderkey", "o_totalprice"))


def order_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(symbol, date, open, high, low, close, volume), prices decimal(10,4)."""
    src = _orders_by_segment(spark, sf_dir).withColumn("p", _order_price())
    return src.groupBy("symbol", "date").agg(
        F.min_by("p", "o_orderkey").alias("open"),
        F.max("p").alias("high"),
        F.min("p").alias("low"),
        F.max_by("p", "o_orderkey").alias("close"),
        F.count(F.lit(1)).alias("volume"))


def walk_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random-walk bars on the order_bars days; they reach every signal."""
    src = _orders_by_segment(spark, sf_dir).withColumn("s", _walk_step())
    days = src.groupBy("symbol", "date").agg(
        F.max_by("s", "o_orderkey").alias("step"),
        F.count(F.lit(1)).alias("volume"))
    # the running sum joins days back to its monthly totals: write days once
    walked = running_sums(materialize(days, "walk_days"), "symbol", "date",
                          {"walk": F.col("step")})
    close = (F.lit(4000) + F.col("walk")).cast(PRICE)
    # open is the previous close: close minus today's step (4000 on day one)
    open_ = (F.lit(4000) + F.col("walk") - F.col("step")).cast(PRICE)
    return walked.select(
        "symbol", "date",
        open_.alias("open"),
        F.greatest(open_, close).alias("high"),
        F.least(open_, close).alias("low"),
        close.alias("close"),
        "volume")


def brand_bars(spark: SparkSession, sf_dir: str, exact: bool = False) -> DataFrame:
    """Bars per part brand and ship date (the bench input).

    Prices are doubles; ``exact=True`` casts them to decimal(10,4) so the
    indicator kernels can use exact window sums.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "l_extendedprice", "l_quantity", "l_shipdate")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    src = (li.join(parts, li.l_partkey == parts.p_partkey)
           .select(F.col("p_brand").alias("symbol"),
                   F.to_date("l_shipdate").alias("date"),
                   (F.col("l_extendedprice") / F.col("l_quantity")).alias("p"),
                   F.struct("l_orderkey", "l_linenumber", "l_partkey",
                            "l_suppkey", "l_extendedprice").alias("k"),
                   "l_quantity"))
    bars = src.groupBy("symbol", "date").agg(
        F.min_by("p", "k").alias("open"),
        F.max("p").alias("high"),
        F.min("p").alias("low"),
        F.max_by("p", "k").alias("close"),
        F.sum("l_quantity").cast("bigint").alias("volume"))
    if exact:
        bars = bars.select("symbol", "date",
                           *[F.col(c).cast(PRICE).alias(c)
                             for c in ("open", "high", "low", "close")],
                           "volume")
    return bars
