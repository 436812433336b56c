"""Aggregates over bars.

Every aggregate here is algebraic (sum, count, min, max, max_by), so Spark
runs it as partial aggregation in each map task, a shuffle of one row per
group and task, then a final merge: a symbol holding a third of all rows
costs no more than any other.

Means and spreads of decimal prices are taken from exact decimal sums, so
the results do not depend on partitioning or row order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import SIGNAL_BB_BUY, SIGNAL_BB_SELL, SIGNAL_BUY, SIGNAL_SELL
from .filters import DATE, KEY, filter_symbols_in

GRAINS = ("month", "quarter", "half", "year")


def _is_decimal(df: DataFrame, col: str) -> bool:
    return dict(df.dtypes)[col].startswith("decimal")


def exact_mean(df: DataFrame, col: str) -> F.Column:
    """Mean as a double: decimal sum / count, or plain avg for doubles."""
    if _is_decimal(df, col):
        return F.sum(col).cast("double") / F.count(col)
    return F.avg(col)


def mean_2dp(df: DataFrame, col: str) -> F.Column:
    """Mean rounded half-even to 2 places (exact for decimal input)."""
    if _is_decimal(df, col):
        return F.bround(F.sum(col) / F.count(col), 2).cast("double")
    return F.bround(F.avg(col), 2)


def shifted_sample_std(df: DataFrame, col: str) -> F.Column:
    """Sample standard deviation of a decimal column from exact sums about a
    centre c near the mean: ``sqrt((sum((x-c)^2) - sum(x-c)^2/n) / (n-1))``.
    Only the last step is in doubles, and there hardly anything cancels."""
    x, n = F.col(col), F.count(col)
    sx, sxx, rows = F.sum(x), F.sum(x * x), n.cast("decimal(16,0)")
    c = F.try_divide(sx, rows).cast("decimal(10,4)")
    s1 = (sx - rows * c).cast("double")
    q1 = (sxx - F.lit(2).cast("decimal(1,0)") * c * sx + rows * c * c).cast("double")
    spread = F.greatest(q1 - F.try_divide(s1 * s1, n.cast("double")), F.lit(0.0))
    return F.when(n > 1, F.sqrt(F.try_divide(spread, (n - 1).cast("double"))))


def exact_sample_std(df: DataFrame, col: str) -> F.Column:
    """Sample standard deviation; NULL for fewer than two rows.

    For decimals up to decimal(10,4): ``sqrt(n*sum(x^2) - sum(x)^2) /
    sqrt(n*(n-1))`` with the numerator in exact decimal arithmetic. Where its
    38 digits don't hold the numerator (from 1e8 rows a group), it is taken
    about the mean from the same exact sums, which differs in the last digit of
    a double at most. Doubles and wider decimals take Spark's own deviation.
    """
    t = df.schema[col].dataType
    if not _is_decimal(df, col) or t.scale > 4 or t.precision - t.scale > 6:
        return F.stddev_samp(F.col(col).cast("double"))
    x = F.col(col)
    n = F.count(col)
    sx = F.sum(x).try_cast("decimal(17,4)")
    sxx = F.sum(x * x).try_cast("decimal(28,8)")
    spread = n.try_cast("decimal(8,0)") * sxx - sx * sx
    exact = F.sqrt(spread.cast("double")) / F.sqrt((n * (n - 1)).cast("double"))
    return F.when(n > 1, F.coalesce(exact, shifted_sample_std(df, col)))


def avg_price_volume(df: DataFrame, key: str = "symbol", price: str = "close",
                     volume: str = "volume") -> DataFrame:
    """G1: average close and total volume per symbol."""
    return df.groupBy(key).agg(
        exact_mean(df, price).alias("avg_price"),
        F.sum(volume).alias("total_volume"))


def table_stats(df: DataFrame, key: str = KEY, date: str = DATE) -> DataFrame:
    """Rows, distinct symbols, first and last date."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.countDistinct(key).alias("n_symbols"),
                  F.min(date).alias("first_date"),
                  F.max(date).alias("last_date"))


def period_key(grain: str, date=DATE) -> F.Column:
    """``YYYY-MM``, ``YYYYQn``, ``YYYY-Sn`` or ``YYYY`` (name or Column)."""
    d = F.col(date) if isinstance(date, str) else date
    if grain == "month":
        return F.date_format(d, "yyyy-MM")
    if grain == "quarter":
        return F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string"))
    if grain == "half":
        half = F.floor((F.month(d) - 1) / 6) + 1
        return F.concat(F.year(d).cast("string"), F.lit("-S"), half.cast("string"))
    if grain == "year":
        return F.year(d).cast("string")
    raise ValueError(f"grain must be one of {GRAINS}: {grain}")


def with_period(df: DataFrame, grain: str, date: str = DATE, out: str = "periode") -> DataFrame:
    return df.withColumn(out, period_key(grain, date))


def _by_period(df: DataFrame, grain: str, symbols, key: str, date: str):
    if symbols is not None:
        df = filter_symbols_in(df, symbols, key)
    return with_period(df.where(F.col(key).isNotNull() & F.col(date).isNotNull()), grain, date)


def perf_price(df: DataFrame, grain: str, symbols=None, key: str = KEY,
               date: str = DATE, close: str = "prix_fermeture",
               high: str = "prix_haut", low: str = "prix_bas") -> DataFrame:
    """Mean close, max high, min low per symbol and period, 2 places."""
    p = _by_period(df, grain, symbols, key, date)

    def r2(c):
        return F.bround(c, 2).cast("double") if _is_decimal(df, high) else F.bround(c, 2)
    return p.groupBy(key, "periode").agg(
        mean_2dp(p, close).alias(close),
        r2(F.max(high)).alias(high),
        r2(F.min(low)).alias(low))


def perf_volume(df: DataFrame, grain: str, symbols=None, key: str = KEY,
                date: str = DATE, volume: str = "volume") -> DataFrame:
    """Total volume per symbol and period (0 when all volumes are null)."""
    p = _by_period(df, grain, symbols, key, date)
    return p.groupBy(key, "periode").agg(
        F.coalesce(F.sum(volume), F.lit(0)).cast("bigint").alias(volume))


def perf_buy_signals(df: DataFrame, grain: str, symbols=None, key: str = KEY,
                     date: str = DATE, signal: str = "signal_trading") -> DataFrame:
    """Count of SIGNAL_ACHAT only, per symbol and period."""
    p = _by_period(df, grain, symbols, key, date)
    return p.groupBy(key, "periode").agg(
        F.count_if(F.col(signal) == SIGNAL_BUY).alias("signaux_achat"))


def perf_volatility(df: DataFrame, grain: str, symbols=None, key: str = KEY,
                    date: str = DATE, close: str = "prix_fermeture") -> DataFrame:
    """Sample std / mean * 100 of the close; NULL for a single row."""
    p = _by_period(df, grain, symbols, key, date)
    return p.groupBy(key, "periode").agg(
        (F.try_divide(exact_sample_std(p, close), exact_mean(p, close)) * 100)
        .alias("volatilite_pourcent"))


def signal_counts(df: DataFrame, signal: str = "signal_trading",
                  key: str | None = None) -> DataFrame:
    """Rows per signal value, nulls left out (optionally per symbol)."""
    groups = ([key] if key else []) + [signal]
    return (df.where(F.col(signal).isNotNull()).groupBy(*groups)
            .agg(F.count(F.lit(1)).alias("n")))


def signal_share_columns(signal: str = "signal_trading") -> list[F.Column]:
    """G9 aggregate columns: buy and sell counts (the band signals included)
    and their share (%) of all non-null signals; an empty denominator is 1."""
    s = F.col(signal)
    total = F.greatest(F.count(s), F.lit(1)).cast("double")
    buy = F.count_if(s.isin(SIGNAL_BUY, SIGNAL_BB_BUY))
    sell = F.count_if(s.isin(SIGNAL_SELL, SIGNAL_BB_SELL))
    return [buy.alias("signaux_achat"), sell.alias("signaux_vente"),
            (buy.cast("double") * 100 / total).alias("pct_achat"),
            (sell.cast("double") * 100 / total).alias("pct_vente")]


def signal_share(df: DataFrame, key: str = KEY, signal: str = "signal_trading") -> DataFrame:
    """Per symbol, see ``signal_share_columns``."""
    return df.groupBy(key).agg(*signal_share_columns(signal))


def pivot_close(df: DataFrame, symbols: list[str], key: str = KEY, date: str = DATE,
                close: str = "prix_fermeture") -> DataFrame:
    """One row per date, one column of mean close per listed symbol.

    The value list is required: without it Spark runs an extra job to find
    the symbols, and the width of the result must be bounded anyway.
    """
    return (df.where(F.col(key).isin(list(symbols)))
            .groupBy(date).pivot(key, list(symbols))
            .agg(exact_mean(df, close)))
