"""G11 kept up to date: Gram sums by date block, stored and put together.

The correlation of two symbols over any window of days is a function of sums
over the days that both have. These sums are stored per block of
``block_days`` days and pair (one of the two orders of a pair), so

* a new, late or corrected day recomputes its block alone,
* a window adds up the stored blocks that lie inside it, and computes sums
  anew only for the days of the two blocks that it cuts.

Values are taken relative to a centre per symbol, which keeps the sums well
conditioned. A centre is fixed when a symbol is first met (any constant gives
the same correlations), so stored blocks stay valid.
"""

from __future__ import annotations

import datetime as dt
import math

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, scratch, ship_package
from ..sources.tables import read_or_empty
from .aggregates import exact_mean
from .correlation import _PARTIAL_SCHEMA, _gram
from .filters import DATE, KEY

BLOCK_DAYS, TILE = 64, 256
BLOCK = "bloc"
BLOCKS = f"{_PARTIAL_SCHEMA}, {BLOCK} int"
CENTRES = "s string, centre double"
_EPOCH = dt.date(1970, 1, 1)
_SUMS, _LOW, _HIGH = ("n", "sa", "sb", "saa", "sbb", "sab"), ("lo_a", "lo_b"), ("hi_a", "hi_b")


def block_of(day: str, block_days: int = BLOCK_DAYS) -> F.Column:
    return F.floor(F.datediff(F.col(day), F.lit(_EPOCH)) / block_days).cast("int")


def daily_closes(bars: DataFrame, key: str = KEY, date: str = DATE, close: str = "prix_fermeture") -> DataFrame:
    """(s, d, x): the mean close of each symbol and day."""
    base = bars.where(F.col(key).isNotNull() & F.col(close).isNotNull() & F.col(date).isNotNull())
    return base.groupBy(F.col(key).alias("s"), F.col(date).alias("d")).agg(exact_mean(base, close).alias("x"))


def _upper(pdf: pd.DataFrame) -> pd.DataFrame:
    """Gram sums of one date block and tile pair, each pair once."""
    both = _gram(pdf)
    return both[both["symbol_a"] <= both["symbol_b"]]


def block_sums(daily: DataFrame, centres: DataFrame, block_days: int = BLOCK_DAYS, tile: int = TILE) -> DataFrame:
    """The pairs' sums of every date block of ``daily`` (s, d, x). A task
    holds ``block_days`` days of two tiles of about ``tile`` symbols."""
    ship_package(daily.sparkSession)
    tiles = max(1, math.ceil((centres.agg(F.countDistinct("s")).first()[0] or 0) / tile))
    own = F.pmod(F.xxhash64("s"), F.lit(tiles)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("_o")
    # a symbol that no refresh has met yet stands as it is
    centred = daily.join(centres, "s", "left").select(
        "s", "d", (F.col("x") - F.coalesce("centre", F.lit(0.0))).alias("x"), own.alias("_t"), block_of("d", block_days).alias(BLOCK))
    spread = centred.select("*", other).select("s", "d", "x", "_t", BLOCK, F.least("_t", "_o").alias("_ta"),
                                               F.greatest("_t", "_o").alias("_tb"))
    return spread.groupBy(BLOCK, "_ta", "_tb").applyInPandas(
        lambda key, pdf: _upper(pdf).assign(**{BLOCK: key[0]}), f"{_PARTIAL_SCHEMA}, {BLOCK} int")


def correlations(sums: DataFrame, key: str = KEY, digits: int | None = 2) -> DataFrame:
    """Both orders of every pair from sums of one order, added up."""
    total = sums.groupBy("symbol_a", "symbol_b").agg(
        *[F.sum(c).alias(c) for c in _SUMS], *[F.min(c).alias(c) for c in _LOW], *[F.max(c).alias(c) for c in _HIGH])
    n, sa, sb = F.col("n"), F.col("sa"), F.col("sb")
    var_a, var_b = n * F.col("saa") - sa * sa, n * F.col("sbb") - sb * sb
    moves = (F.col("hi_a") > F.col("lo_a")) & (F.col("hi_b") > F.col("lo_b"))
    r = F.when((n >= 2) & moves & (var_a > 0) & (var_b > 0),
               (n * F.col("sab") - sa * sb) / F.sqrt(var_a * var_b))
    r = F.when(r.isNotNull(), F.least(F.greatest(r, F.lit(-1.0)), F.lit(1.0)))
    if digits is not None:
        r = F.bround(r, digits)
    pair = total.select("symbol_a", "symbol_b", r.alias("correlation"))
    orders = F.array(F.struct(F.col("symbol_a").alias("a"), F.col("symbol_b").alias("b")),
                     F.struct(F.col("symbol_b").alias("a"), F.col("symbol_a").alias("b")))
    both = pair.select(F.explode(F.array_distinct(orders)).alias("p"), "correlation")
    return both.select(F.col("p.a").alias(f"{key}_a"), F.col("p.b").alias(f"{key}_b"), "correlation")


def refresh_corr(spark: SparkSession, bars: DataFrame, path: str, changed: DataFrame | None = None,
                 block_days: int = BLOCK_DAYS, tile: int = TILE, **columns) -> int:
    """Bring the stored blocks under ``path`` up to ``bars``: those of the
    days of ``changed`` (one date column) are computed anew, all if it is not
    given. Gives the number of blocks computed. Blocks that lost all their
    rows become empty."""
    with scratch(spark):
        daily = daily_closes(bars, **columns)
        wanted = None
        if changed is not None:
            day = changed.columns[0]
            wanted = materialize(changed.select(block_of(day, block_days).alias(BLOCK)).distinct(), "corr_wanted")
            # the days of a block lie between the first and the last wanted one: partitions are pruned
            low, high = wanted.agg(F.min(BLOCK), F.max(BLOCK)).first()
            if low is None:
                return 0
            first = _EPOCH + dt.timedelta(days=low * block_days)
            last = _EPOCH + dt.timedelta(days=(high + 1) * block_days - 1)
            daily = daily.where(F.col("d").between(F.lit(first), F.lit(last))).where(
                block_of("d", block_days).isin([r[0] for r in wanted.collect()]))
        daily = materialize(daily, "corr_days")
        known = read_or_empty(spark, f"{path}/centres", CENTRES)
        met = daily.groupBy("s").agg(F.avg("x").alias("centre")).join(known, "s", "left_anti")
        met = materialize(met, "corr_centres")
        met.coalesce(1).write.mode("append").parquet(f"{path}/centres")
        centres = read_or_empty(spark, f"{path}/centres", CENTRES)
        sums = materialize(block_sums(daily, centres, block_days, tile), "corr_sums")
        (sums.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BLOCK)
         .parquet(f"{path}/blocks"))
        done = {r[0] for r in sums.select(BLOCK).distinct().collect()}
        gone = {r[0] for r in wanted.collect()} - done if wanted is not None else set()
        for block in gone:
            sums.drop(BLOCK).limit(0).write.mode("overwrite").parquet(f"{path}/blocks/{BLOCK}={block}")
        return len(done | gone)


def corr_window(spark: SparkSession, bars: DataFrame, path: str, start: dt.date, end: dt.date,
                digits: int | None = 2, block_days: int = BLOCK_DAYS, tile: int = TILE, **columns) -> DataFrame:
    """Correlations over the days from ``start`` to ``end``: the stored blocks
    inside, and ``bars`` for the days of a block that the window cuts."""
    if start > end:
        raise ValueError("the window ends before it starts")
    first, last = ((d - _EPOCH).days for d in (start, end))
    whole = range(-(-first // block_days), (last + 1) // block_days)  # blocks that lie inside
    stored = read_or_empty(spark, f"{path}/blocks", BLOCKS)
    parts = [stored.where(F.col(BLOCK).between(whole.start, whole.stop - 1)).drop(BLOCK)] if whole else []
    edges = [(first, last)] if not whole else [(first, whole.start * block_days - 1), (whole.stop * block_days, last)]
    days = [F.col("d").between(F.lit(_EPOCH + dt.timedelta(days=a)), F.lit(_EPOCH + dt.timedelta(days=b)))
            for a, b in edges if a <= b]
    if days:
        centres = read_or_empty(spark, f"{path}/centres", CENTRES)
        cut = days[0] if len(days) == 1 else days[0] | days[1]
        daily = materialize(daily_closes(bars, **columns).where(cut), "corr_edges")
        parts.append(block_sums(daily, centres, block_days, tile).drop(BLOCK))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return correlations(out, columns.get("key", KEY), digits)
