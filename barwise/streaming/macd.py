"""MACD and Wilder's RSI over a stream of bars, one state a symbol.

A symbol's state is a handful of numbers: how many bars it has had, the last
day and close, the three averages of MACD and the two of the RSI. Each new
bar moves them by one step of their recursions, so a micro-batch costs what it
holds, however long the series are, and the stream's checkpoint keeps them.

Bars of a micro-batch are taken in the order of their days. A bar that is not
newer than its symbol's last one is late: it comes out with ``late`` set and
no values, moves nothing, and is left to the refresh of the stored table,
which takes a series up again before its earliest late day.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.filters import DATE, KEY
from ..operators.indicators import CLOSE, EMA_DIGITS
from ..session import ship_package

STATE = "n long, last int, close double, fast double, slow double, signal double, gain double, loss double"
OUTPUT = T.StructType([
    T.StructField(KEY, T.StringType()), T.StructField(DATE, T.DateType()), T.StructField(CLOSE, T.DoubleType()),
    T.StructField("macd_line", T.DoubleType()), T.StructField("macd_signal", T.DoubleType()),
    T.StructField("rsi", T.DoubleType()), T.StructField("late", T.BooleanType())])
_START = dt.date(1970, 1, 1)


def half_up(x: float, digits: int = EMA_DIGITS) -> float:
    """As Spark's ``round``: halves of the shortest decimal go away from zero."""
    from decimal import ROUND_HALF_UP, Decimal
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)) + 0.0


def step(state: tuple, day: int, close: float, alphas: tuple[float, ...], wilder: float) -> tuple:
    """The state after one more bar."""
    n, _, before, fast, slow, signal, gain, loss = state
    if n == 0:
        return (1, day, close, close, close, 0.0, 0.0, 0.0)
    a, b, c = alphas
    fast, slow = a * close + (1 - a) * fast, b * close + (1 - b) * slow
    signal = c * (fast - slow) + (1 - c) * signal
    up, down = max(close - before, 0.0), max(before - close, 0.0)
    if n == 1:
        gain, loss = up, down
    else:
        gain, loss = wilder * up + (1 - wilder) * gain, wilder * down + (1 - wilder) * loss
    return (n + 1, day, close, fast, slow, signal, gain, loss)


def streamed_macd(bars: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9, rsi: int = 14) -> DataFrame:
    """``bars`` (a stream of symbole, date_trading, prix_fermeture) with
    ``macd_line``, ``macd_signal`` and Wilder's ``rsi`` as ``indicators.macd``
    and ``indicators.rsi`` give them, and ``late``.

    Bars without a symbol, a day or a finite close are left out. Of a day that
    a micro-batch holds twice, the first in the order of closes counts; the
    others are late. Append mode; a micro-batch's bars of one symbol meet in
    one task, so bound it (``maxFilesPerTrigger``) for a first load.
    """
    ship_package(bars.sparkSession)
    alphas, wilder = tuple(2.0 / (n + 1) for n in (fast, slow, signal)), 1.0 / rsi

    def run(key: tuple, parts: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        state = held.get if held.exists else (0, -(10 ** 9), 0.0, 0.0, 0.0, 0.0, 0.0, 0.0)
        rows = pd.concat(list(parts)).sort_values(["day", CLOSE])
        out = []
        for day, close in zip(rows["day"].tolist(), rows[CLOSE].tolist()):
            line = sig = strength = None
            late = day <= state[1]
            if not late:
                state = step(state, day, close, alphas, wilder)
                n, gain, loss = state[0], state[6], state[7]
                line = half_up(state[3] - state[4]) if n >= slow else None
                sig = half_up(state[5]) if n >= slow + signal - 1 else None
                if n > rsi:
                    strength = half_up(50.0 if gain + loss == 0 else 100.0 * gain / (gain + loss))
            out.append((key[0], _START + dt.timedelta(days=day), close, line, sig, strength, late))
        held.update(tuple(state))
        yield pd.DataFrame(out, columns=OUTPUT.fieldNames())

    close = F.col(CLOSE).cast("double")
    clean = bars.select(KEY, F.datediff(F.col(DATE), F.lit(_START)).alias("day"), close.alias(CLOSE)).where(
        F.col(KEY).isNotNull() & F.col("day").isNotNull() & F.col(CLOSE).isNotNull()
        & ~F.isnan(CLOSE) & (F.abs(F.col(CLOSE)) != float("inf")))
    return clean.groupBy(KEY).applyInPandasWithState(run, OUTPUT, STATE, "append", GroupStateTimeout.NoTimeout)
