"""Technical indicators, each adding columns to a bar frame.

All of them run on the halo-block layout of ``series.py``: windows are
``PARTITION BY symbol, _blk ORDER BY _i``, so one long symbol is spread over
many tasks, and every indicator of ``enrich`` shares one shuffle and one
sort. Called on a plain frame, an indicator lays it out and cleans up itself.

Rules shared by all: rows are ordered by date within the symbol; a value is
NULL until its window is full (position ``_i >= n - 1``). Rows without a key,
a date or a finite price are left out before the windows. With decimal
prices (up to decimal(10,4)), finite windows use exact decimal sums, so SMA,
bands and simple RSI are bit-identical whatever the partitioning. Other
prices use sliding frames, as differences of running double sums would
cancel. EMA-based outputs are doubles rounded to 4 places before any
comparison.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..schemas import (MACD_DOWN, MACD_UP, NEUTRAL, RSI_HIGH, RSI_LOW, RSI_OVERBOUGHT,
                       RSI_OVERSOLD, SIGNAL_BB_BUY, SIGNAL_BB_SELL, SIGNAL_BUY, SIGNAL_SELL,
                       TREND_DOWN, TREND_UNKNOWN, TREND_UP)
from .filters import DATE, KEY
from .series import IDX, block_window, ema_columns, geometric_columns, geometric_halo, geometric_layout, on_series

CLOSE = "prix_fermeture"
EMA_DIGITS = 4


def exact_prices(df: DataFrame, col: str) -> bool:
    """Whether a column's window sums are exact: decimal(10,4) or narrower."""
    t = df.schema[col].dataType
    return isinstance(t, DecimalType) and t.scale <= 4 and t.precision - t.scale <= 6


def sliding(key: str, n: int):
    return block_window(key).rowsBetween(1 - n, 0)


def _full(n: int) -> F.Column:
    return F.col(IDX) >= n - 1


def with_trailing(d: DataFrame, sums: dict[str, tuple[F.Column, int]], key: str,
                  outputs, exact: bool = True) -> DataFrame:
    """Add the columns ``outputs(trailing)`` where ``trailing[name]`` is the
    sum of ``expr`` over the last ``n`` rows, for ``sums = {name: (expr, n)}``.

    Exact values: two selects, the running sums (one window node), then the
    lagged differences and the outputs (a second node on the same sort).
    Others: sliding frames, which add the n values anew.
    """
    if not exact:
        base = d.columns
        d = d.select("*", *[F.sum(x.cast("double")).over(sliding(key, n)).alias(f"_sum_{name}")
                            for name, (x, n) in sums.items()])
        return d.select(*base, *outputs({name: F.col(f"_sum_{name}") for name in sums}))
    run = block_window(key).rowsBetween(Window.unboundedPreceding, 0)
    base = d.columns
    d = d.select("*", *[F.sum(x).over(run).alias(f"_run_{name}") for name, (x, n) in sums.items()])
    trailing = {name: F.col(f"_run_{name}")
                - F.coalesce(F.lag(f"_run_{name}", n).over(block_window(key)), F.lit(0))
                for name, (x, n) in sums.items()}
    return d.select(*base, *outputs(trailing))


def sma_value(total: F.Column, n: int) -> F.Column:
    """SMA from the trailing sum of the last ``n`` prices."""
    return F.when(_full(n), total.cast("double") / n)


def sma(df: DataFrame, n: int, price: str = CLOSE, out: str | None = None,
        key: str = KEY, order: str = DATE) -> DataFrame:
    """Mean of the last ``n`` prices."""
    out = out or f"sma_{n}"
    exact = exact_prices(df, price)

    def fn(d, k):
        return with_trailing(d, {"sum": (F.col(price), n)}, k, lambda t: [
            sma_value(t["sum"], n).alias(out)], exact)
    return on_series(df, key, order, n, fn, value=price)


def band_values(sx: F.Column, sxx: F.Column, n: int, k: float = 2, ddof: int = 0,
                prefix: str = "bollinger") -> list[F.Column]:
    """Middle, upper and lower band from exact trailing sums of x and x^2."""
    sx4 = sx.cast("decimal(14,4)")
    spread = (F.lit(n).cast("decimal(5,0)") * sxx.cast("decimal(24,8)")
              - sx4 * sx4).cast("double")
    sd = F.sqrt(spread) / math.sqrt(n * (n - ddof))
    return _bands(sx.cast("double") / n, sd, n, k, prefix)


def sliding_bands(d: DataFrame, key: str, n: int, k: float = 2, ddof: int = 0, price: str = CLOSE,
                  prefix: str = "bollinger") -> DataFrame:
    """The bands of prices without exact sums: mean and deviation of each
    frame itself, so a flat stretch has a flat band."""
    x = F.col(price).cast("double")
    frame = sliding(key, n)
    base = d.columns
    spread = F.stddev_pop(x) if ddof == 0 else F.stddev_samp(x)
    # a flat frame's own value: the mean of equal doubles may be off in the last place
    flat = F.min(x).over(frame) == F.max(x).over(frame)
    d = d.select("*", F.when(flat, x).otherwise(F.avg(x).over(frame)).alias("_mid"),
                 F.when(flat, F.lit(0.0)).otherwise(spread.over(frame)).alias("_sd"))
    scale = math.sqrt((n - 1) / (n - ddof)) if ddof > 1 else 1.0
    return d.select(*base, *_bands(F.col("_mid"), F.col("_sd") * scale, n, k, prefix))


def _bands(middle: F.Column, sd: F.Column, n: int, k: float, prefix: str) -> list[F.Column]:
    return [F.when(_full(n), middle).alias(f"{prefix}_middle"),
            F.when(_full(n), middle + F.lit(k) * sd).alias(f"{prefix}_upper"),
            F.when(_full(n), middle - F.lit(k) * sd).alias(f"{prefix}_lower")]


def bollinger(df: DataFrame, n: int = 20, k: float = 2, ddof: int = 0,
              price: str = CLOSE, prefix: str = "bollinger",
              key: str = KEY, order: str = DATE) -> DataFrame:
    """I8: middle = SMA(n), upper/lower = middle +/- k standard deviations.

    The deviation is ``sqrt(n*sum(x^2) - sum(x)^2) / sqrt(n*(n-ddof))``
    (population for ddof=0); for decimals the numerator is exact.
    """
    exact = exact_prices(df, price)

    def fn(d, key_):
        x = F.col(price)
        if not exact:
            return sliding_bands(d, key_, n, k, ddof, price, prefix)
        return with_trailing(d, {"sx": (x, n), "sxx": (x * x, n)}, key_,
                             lambda t: band_values(t["sx"], t["sxx"], n, k, ddof, prefix))
    return on_series(df, key, order, n, fn, value=price)


def bollinger_percent_value(price: str = CLOSE, prefix: str = "bollinger") -> F.Column:
    lower, upper = F.col(f"{prefix}_lower"), F.col(f"{prefix}_upper")
    return F.try_divide(F.col(price).cast("double") - lower, upper - lower)


def bollinger_percent(df: DataFrame, price: str = CLOSE, prefix: str = "bollinger") -> DataFrame:
    """(close - lower) / (upper - lower) as a 0-1 fraction; flat band -> NULL."""
    return df.withColumn(f"{prefix}_percent", bollinger_percent_value(price, prefix))


def with_delta(d: DataFrame, price: str, key: str) -> DataFrame:
    """Add ``_delta`` = price - previous price (NULL on the first row)."""
    return d.select("*", (F.col(price) - F.lag(price, 1).over(block_window(key))).alias("_delta"))


def gain_value() -> F.Column:
    dl = F.col("_delta")
    return F.when(dl > 0, dl).when(dl.isNotNull(), F.lit(0))


def loss_value() -> F.Column:
    dl = F.col("_delta")
    return F.when(dl < 0, -dl).when(dl.isNotNull(), F.lit(0))


def rsi_value(g: F.Column, l: F.Column, n: int) -> F.Column:
    total = g + l
    value = F.when(total == 0, F.lit(50.0)).otherwise(
        F.lit(100.0) * g.cast("double") / total.cast("double"))
    return F.when(F.col(IDX) >= n, value)


def rsi(df: DataFrame, n: int = 14, method: str = "simple", price: str = CLOSE,
        out: str | None = None, key: str = KEY, order: str = DATE) -> DataFrame:
    """RSI = 100 * gains / (gains + losses) over the last ``n`` deltas.

    ``simple``: plain sums of the last n gains and losses (exact for
    decimals). ``wilder``: exponential averages with alpha = 1/n from the
    first delta, rounded to 4 places. NULL before row n+1; 50 when flat.
    """
    out = out or f"rsi_{n}"
    if method not in ("simple", "wilder"):
        raise ValueError(f"method must be 'simple' or 'wilder': {method}")
    exact = exact_prices(df, price)

    def fn(d, k):
        base = d.columns
        d = with_delta(d, price, k)
        if method == "simple":
            d = with_trailing(d, {"g": (gain_value(), n), "l": (loss_value(), n)}, k, lambda t: [
                rsi_value(t["g"], t["l"], n).alias(out)], exact)
        else:
            d = d.select("*", gain_value().alias("gain_value"), loss_value().alias("loss_value"))
            d = ema_columns(d, [("gain_value", 1.0 / n, "_g", 1), ("loss_value", 1.0 / n, "_l", 1)])
            d = d.withColumn(out, F.round(rsi_value(F.col("_g"), F.col("_l"), n), EMA_DIGITS))
        return d.select(*base, out)
    if method == "simple":
        return on_series(df, key, order, n + 1, fn, value=price)
    # the first delta needs one earlier row
    block, halo = geometric_layout([1.0 - 1.0 / n])
    return on_series(df, key, order, 1, fn, want=halo + 1 if halo else 1, block=block, value=price)


def ema(df: DataFrame, col: str, span: float | None = None, alpha: float | None = None,
        out: str | None = None, key: str = KEY, order: str = DATE,
        digits: int | None = None) -> DataFrame:
    """I4: ``e_1 = x_1; e_t = alpha*x_t + (1-alpha)*e_(t-1)``, alpha = 2/(span+1)."""
    if (span is None) == (alpha is None):
        raise ValueError("give exactly one of span, alpha")
    alpha = alpha if alpha is not None else 2.0 / (span + 1)
    out = out or f"ema_{col}"

    def fn(d, k):
        d = ema_columns(d, [(col, alpha, out, 0)])
        return d.withColumn(out, F.round(out, digits)) if digits is not None else d
    block, halo = geometric_layout([1.0 - alpha])
    return on_series(df, key, order, 0, fn, want=halo, block=block, value=col)


def macd_terms(fast: int, slow: int, signal: int, price: str):
    """Geometric-sum terms and output weights of the MACD line and signal.

    Every EMA here is linear in the closes, and an EMA of an EMA is a sum of
    two geometric kernels: with ``a = 2/(span+1)``, ``q = 1 - a`` and
    ``G_q`` the geometric sum of the closes,
    ``line = a_f G_f - a_s G_s`` and
    ``signal = a_9 a_f (q_f G_f - q_9 G_9)/(q_f - q_9)
             - a_9 a_s (q_s G_s - q_9 G_9)/(q_s - q_9)``.
    Returns None when two spans coincide (the kernel is then not a plain
    geometric sum).
    """
    if len({fast, slow, signal}) < 3:
        return None
    a = {n: 2.0 / (n + 1) for n in (fast, slow, signal)}
    q = {n: 1.0 - a[n] for n in a}
    af, as_, a9 = a[fast], a[slow], a[signal]
    qf, qs, q9 = q[fast], q[slow], q[signal]
    terms = {"_gf": (price, qf, 0), "_gs": (price, qs, 0), "_g9": (price, q9, 0)}
    cf = a9 * af * qf / (qf - q9)
    cs = -a9 * as_ * qs / (qs - q9)
    c9 = -a9 * af * q9 / (qf - q9) + a9 * as_ * q9 / (qs - q9)
    outputs = {"_line": [("_gf", af), ("_gs", -as_)],
               "_sig": [("_gf", cf), ("_gs", cs), ("_g9", c9)]}
    return terms, outputs


def macd_halo(fast: int = 12, slow: int = 26, signal: int = 9) -> int:
    """Halo rows for an in-partition MACD (the slowest kernel decides)."""
    return max(geometric_halo(1.0 - 2.0 / (n + 1)) for n in (fast, slow, signal))


def macd(df: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9,
         price: str = CLOSE, key: str = KEY, order: str = DATE, starts: DataFrame | None = None,
         sums: bool = False) -> DataFrame:
    """line = EMA(fast) - EMA(slow); signal = EMA(signal) of the line.

    Both EMAs start at the first row; the line is shown from row ``slow``,
    the signal from row ``slow + signal - 1``; both rounded to 4 places.
    Line and signal come from one pass over three geometric sums; ``sums``
    keeps these as well (the state of the series after each row), and
    ``starts`` goes on from stored ones.
    """
    def fn(d, k):
        plan = macd_terms(fast, slow, signal, price)
        if plan is not None:
            terms, outputs = plan
            own = {f"{name[1:]}_sum": [(name, 1.0)] for name in terms} if sums else {}
            d = geometric_columns(d, terms, outputs | own, starts)
        else:
            d = ema_columns(d, [(price, 2.0 / (fast + 1), "_ef", 0),
                                (price, 2.0 / (slow + 1), "_es", 0)])
            d = d.withColumn("_line", F.col("_ef") - F.col("_es")).drop("_ef", "_es")
            d = ema_columns(d, [("_line", 2.0 / (signal + 1), "_sig", 0)])
        keep = [c for c in d.columns if c not in ("_line", "_sig")]
        return d.select(*keep,
                        F.when(_full(slow), F.round("_line", EMA_DIGITS)).alias("macd_line"),
                        F.when(_full(slow + signal - 1),
                               F.round("_sig", EMA_DIGITS)).alias("macd_signal"))
    block, halo = geometric_layout([1.0 - 2.0 / (n + 1) for n in (fast, slow, signal)])
    if macd_terms(fast, slow, signal, price) is None:
        halo = 0  # the second average needs the first on every row: carried, not copied
    return on_series(df, key, order, 0, fn, want=halo, block=block, value=price)


def macd_histogram(df: DataFrame) -> DataFrame:
    """Line - signal (4 places) and its sign; null counts as negative."""
    h = F.round(F.col("macd_line") - F.col("macd_signal"), EMA_DIGITS)
    return (df.withColumn("macd_histogram", h)
            .withColumn("histogram_positive", F.coalesce(h >= 0, F.lit(False))))


def macd_direction(df: DataFrame) -> DataFrame:
    """HAUSSE when line > signal, else BAISSE (ties and nulls too)."""
    up = F.coalesce(F.col("macd_line") > F.col("macd_signal"), F.lit(False))
    return (df.withColumn("macd_direction", F.when(up, F.lit(MACD_UP)).otherwise(F.lit(MACD_DOWN)))
            .withColumn("macd_gap", F.round(F.col("macd_line") - F.col("macd_signal"), EMA_DIGITS)))


def rsi_level_value(hi: float = RSI_HIGH, lo: float = RSI_LOW, col: str = "rsi_14") -> F.Column:
    r = F.col(col)
    return (F.when(r > hi, F.lit(RSI_OVERBOUGHT)).when(r < lo, F.lit(RSI_OVERSOLD))
            .when(r.isNotNull(), F.lit(NEUTRAL)))


def rsi_level(df: DataFrame, hi: float = RSI_HIGH, lo: float = RSI_LOW,
              col: str = "rsi_14", out: str = "niveau_rsi") -> DataFrame:
    """SURACHAT above ``hi``, SURVENTE below ``lo``, else NEUTRE; NULL stays NULL."""
    return df.withColumn(out, rsi_level_value(hi, lo, col))


def trend_value(price: str = CLOSE, mid: str = "moyenne_mobile_50j",
                long: str = "moyenne_mobile_200j") -> F.Column:
    c, m, lg = F.col(price).cast("double"), F.col(mid), F.col(long)
    return (F.when(c.isNull() | m.isNull() | lg.isNull(), F.lit(TREND_UNKNOWN))
            .when((c > m) & (m > lg), F.lit(TREND_UP))
            .when((c < m) & (m < lg), F.lit(TREND_DOWN))
            .otherwise(F.lit(NEUTRAL)))


def trend(df: DataFrame, price: str = CLOSE, mid: str = "moyenne_mobile_50j",
          long: str = "moyenne_mobile_200j", out: str = "tendance_globale") -> DataFrame:
    """Close > SMA50 > SMA200 up, close < SMA50 < SMA200 down, else
    neutral; unknown while any of the three is NULL."""
    return df.withColumn(out, trend_value(price, mid, long))


def trading_signal_value(price: str = CLOSE, rsi_col: str = "rsi_14", hi: float = RSI_HIGH,
                         lo: float = RSI_LOW, prefix: str = "bollinger") -> F.Column:
    r, line, sig = F.col(rsi_col), F.col("macd_line"), F.col("macd_signal")
    c = F.col(price).cast("double")

    def true(cond):
        return F.coalesce(cond, F.lit(False))
    return (F.when(true((r < lo) & (line > sig)), F.lit(SIGNAL_BUY))
            .when(true((r > hi) & (line < sig)), F.lit(SIGNAL_SELL))
            .when(true(c < F.col(f"{prefix}_lower")), F.lit(SIGNAL_BB_BUY))
            .when(true(c > F.col(f"{prefix}_upper")), F.lit(SIGNAL_BB_SELL))
            .otherwise(F.lit(NEUTRAL)))


def trading_signal(df: DataFrame, price: str = CLOSE, rsi_col: str = "rsi_14",
                   out: str = "signal_trading", hi: float = RSI_HIGH,
                   lo: float = RSI_LOW, prefix: str = "bollinger") -> DataFrame:
    """First match of: RSI < lo and line > signal -> buy; RSI > hi and
    line < signal -> sell; close < lower band -> band buy; close > upper band
    -> band sell; otherwise neutral."""
    return df.withColumn(out, trading_signal_value(price, rsi_col, hi, lo, prefix))
