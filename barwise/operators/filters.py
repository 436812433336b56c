"""Projection, filter, order and top-N operators.

Column defaults follow the served (enriched) table: ``symbole`` and
``date_trading``. Filters are plain predicates, so Catalyst pushes them into
the Parquet scan and, for the symbol key, through the indicator windows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY = "symbole"
DATE = "date_trading"

# --- fixed values: the dashboard's period choices ----------------------------
# trailing calendar days (P6); None keeps everything
TRAILING_DAY_PRESETS = {"1 mois": 30, "3 mois": 90, "6 mois": 180, "1 an": 365,
                        "Toutes les données": None}
# chart range buttons (P7): (count, unit); None keeps everything
RANGE_BUTTONS = {"1w": (7, "day"), "1m": (1, "month"), "3m": (3, "month"),
                 "6m": (6, "month"), "all": None}


def lowercase_columns(df: DataFrame) -> DataFrame:
    """Every column name in lower case."""
    return df.toDF(*[c.lower() for c in df.columns])


def select_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """A column subset, in the given order."""
    return df.select(*names)


def filter_symbol(df: DataFrame, symbol: str, key: str = KEY) -> DataFrame:
    """Rows of one symbol."""
    return df.where(F.col(key) == F.lit(symbol))


def _date_lit(value) -> F.Column:
    if isinstance(value, F.Column):
        return value
    if isinstance(value, (dt.date, dt.datetime)):
        value = value.isoformat()[:10]
    return F.to_date(F.lit(value))


def filter_date_range(df: DataFrame, start, end, date: str = DATE) -> DataFrame:
    """P5: ``start <= date <= end`` (both inclusive)."""
    return df.where(F.col(date).between(_date_lit(start), _date_lit(end)))


def _as_of(df: DataFrame, as_of, date: str) -> F.Column:
    if as_of is not None:
        return _date_lit(as_of)
    # the latest date of the table, as a scalar subquery (one small job)
    return df.select(F.max(date)).scalar()


def trailing_days(df: DataFrame, n: int | None, as_of=None, date: str = DATE) -> DataFrame:
    """The last ``n`` calendar days up to ``as_of`` (default: latest date).

    The day exactly ``n`` days back is excluded; ``n=None`` keeps everything.
    """
    if n is None:
        return df
    return df.where(F.col(date) > F.date_sub(_as_of(df, as_of, date), n))


def trailing_months(df: DataFrame, n: int | None, as_of=None, date: str = DATE,
                    unit: str = "month") -> DataFrame:
    """Rows on or after ``as_of`` minus ``n`` months (or days)."""
    if n is None:
        return df
    ref = _as_of(df, as_of, date)
    start = F.add_months(ref, -n) if unit == "month" else F.date_sub(ref, n)
    return df.where(F.col(date) >= start)


def range_button(df: DataFrame, button: str, as_of=None, date: str = DATE) -> DataFrame:
    """P7 by button name (``1w``, ``1m``, ``3m``, ``6m``, ``all``)."""
    spec = RANGE_BUTTONS[button]
    if spec is None:
        return df
    n, unit = spec
    return trailing_months(df, n, as_of, date, unit=unit)


def filter_symbols_in(df: DataFrame, symbols, key: str = KEY) -> DataFrame:
    """Rows whose symbol is in ``symbols``; an empty list gives no rows.

    ``symbols`` may be a DataFrame with a ``key`` column (a long list): that
    is a left-semi join, which never duplicates rows.
    """
    if isinstance(symbols, DataFrame):
        return df.join(symbols.select(key), key, "left_semi")
    symbols = list(symbols)
    if not symbols:
        return df.where(F.lit(False))
    return df.where(F.col(key).isin(symbols))


def distinct_symbols(df: DataFrame, key: str = KEY) -> DataFrame:
    """The sorted distinct symbols."""
    return df.select(key).where(F.col(key).isNotNull()).distinct().orderBy(key)


def is_empty(df: DataFrame) -> bool:
    """P10: true when the frame has no row (an action)."""
    return df.isEmpty()


def order_symbol_date(df: DataFrame, key: str = KEY, date: str = DATE) -> DataFrame:
    """Global order by (symbol, date)."""
    return df.orderBy(key, date)


def last_n_rows(df: DataFrame, n: int, key: str = KEY, date: str = DATE) -> DataFrame:
    """The last ``n`` rows of every symbol, in ascending date order.

    ``row_number() <= n`` becomes a WindowGroupLimit: each map task keeps only
    its ``n`` newest rows per symbol before the shuffle.
    """
    w = Window.partitionBy(key).orderBy(F.col(date).desc())
    return (df.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") <= n).drop("_rn")
            .orderBy(key, date))


def last_row(df: DataFrame, key: str = KEY, date: str = DATE) -> DataFrame:
    """The latest row of every symbol (partial aggregation, no window)."""
    others = [c for c in df.columns if c != key]
    latest = F.max_by(F.struct(*others), F.col(date)).alias("_last")
    return df.groupBy(key).agg(latest).select(key, "_last.*")


def first_k(df: DataFrame, order_by: list[str], k: int) -> DataFrame:
    """The first ``k`` rows in a total order (top-k, not a full sort)."""
    return df.orderBy(*order_by).limit(k)
