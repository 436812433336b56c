"""Serving views: the data behind each dashboard panel.

Views read the enriched table. ``symbol=None`` serves every symbol at once
(the panel's symbol choice is then a filter of the result). Period filters
apply after the indicators, never before: a date filter under a window
would change its values. ``as_of`` defaults to the latest date of the
table; pass it in (e.g. the latest raw date) to avoid a second pass.

``days``, the panel's period, is a number of trailing days, the name of one
of ``TRAILING_DAY_PRESETS``, a pair (first day, last day), both inclusive, or
None for the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import signal_share_columns, table_stats
from ..operators.filters import (DATE, KEY, TRAILING_DAY_PRESETS, filter_date_range, filter_symbol, last_n_rows,
                                 trailing_days)
from ..operators.indicators import macd_direction, macd_histogram
from ..schemas import RSI_HIGH, RSI_LOW

CANDLE_COLUMNS = ["date_trading", "prix_ouverture", "prix_haut", "prix_bas", "prix_fermeture",
                  "bollinger_upper", "bollinger_middle", "bollinger_lower"]
Period = int | str | tuple | None
SIGNAL_COLUMNS = ["date_trading", "prix_fermeture", "rsi_14", "macd_line", "niveau_rsi",
                  "signal_trading", "tendance_globale"]


def _scope(df: DataFrame, symbol, days, as_of) -> DataFrame:
    if symbol is not None:
        df = filter_symbol(df, symbol)
    if isinstance(days, str):
        days = TRAILING_DAY_PRESETS[days]
    if isinstance(days, (tuple, list)):
        return filter_date_range(df, *days)
    return trailing_days(df, days, as_of)


def view_candlestick(df: DataFrame, symbol: str | None = None, days: Period = None,
                     as_of=None) -> DataFrame:
    """V1 chart: date, OHLC and the three bands."""
    return _scope(df, symbol, days, as_of).select(KEY, *CANDLE_COLUMNS)


def view_candlestick_table(df: DataFrame, symbol: str | None = None, days: Period = None,
                           as_of=None, n: int = 20) -> DataFrame:
    """V1 table: the last ``n`` rows of the chart data, ascending."""
    return last_n_rows(view_candlestick(df, symbol, days, as_of), n)


def view_rsi(df: DataFrame, symbol: str | None = None, days: Period = None,
             as_of=None) -> DataFrame:
    """V2 chart: date, RSI and the two limits."""
    return _scope(df, symbol, days, as_of).select(
        KEY, DATE, "rsi_14", F.lit(RSI_HIGH).alias("limite_haute"),
        F.lit(RSI_LOW).alias("limite_basse"))


def _latest(df: DataFrame, cols: list[str]) -> DataFrame:
    """The latest value of each column per symbol (one aggregate, no window)."""
    return df.groupBy(KEY).agg(
        F.max(DATE).alias(DATE),
        *[F.max_by(c, DATE).alias(c) for c in cols])


def view_rsi_latest(df: DataFrame, symbol: str | None = None, days: Period = None,
                    as_of=None) -> DataFrame:
    """V2 metric: latest RSI and its level per symbol."""
    return _latest(_scope(df, symbol, days, as_of), ["rsi_14", "niveau_rsi"])


def view_macd(df: DataFrame, symbol: str | None = None, days: Period = None,
              as_of=None) -> DataFrame:
    """V3 chart: line, signal, histogram and its sign."""
    d = _scope(df, symbol, days, as_of).select(KEY, DATE, "macd_line", "macd_signal")
    return macd_histogram(d)


def view_macd_latest(df: DataFrame, symbol: str | None = None, days: Period = None,
                     as_of=None) -> DataFrame:
    """V3 metric: latest direction and signed gap per symbol."""
    latest = _latest(_scope(df, symbol, days, as_of), ["macd_line", "macd_signal"])
    return macd_direction(latest)


def view_signal_board(df: DataFrame, symbol: str | None = None, days: Period = None,
                      as_of=None) -> DataFrame:
    """V6 metrics: buy/sell counts and shares, current trend and last signal
    (one aggregate per symbol)."""
    d = _scope(df, symbol, days, as_of)
    return d.groupBy(KEY).agg(
        *signal_share_columns(),
        F.max_by("tendance_globale", DATE).alias("tendance_actuelle"),
        F.max_by("signal_trading", DATE).alias("dernier_signal"))


def view_signal_table(df: DataFrame, symbol: str | None = None, days: Period = None,
                      as_of=None, n: int = 10) -> DataFrame:
    """V6 table: the last ``n`` signal rows per symbol."""
    return last_n_rows(_scope(df, symbol, days, as_of).select(KEY, *SIGNAL_COLUMNS), n)


def view_sidebar(df: DataFrame) -> DataFrame:
    """V7: table statistics."""
    return table_stats(df)
