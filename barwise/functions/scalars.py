"""Scalar column functions, all built-in Spark expressions.

Display formats round first (half-even) and then print, so the printed
digits do not depend on how a double happens to be stored.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators.aggregates import period_key

# --- fixed values: date formats ---------------------------------------------
MONTH_FORMAT = "yyyy-MM"
DAY_FORMAT = "yyyy-MM-dd"
STAMP_FORMAT = "yyyyMMdd_HHmm"
DISPLAY_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def fmt_date(col, pattern: str) -> Column:
    """date or timestamp as text."""
    return F.date_format(F.col(col) if isinstance(col, str) else col, pattern)


def quarter_key(col) -> Column:
    """``YYYYQn``."""
    return period_key("quarter", col)


def half_key(col) -> Column:
    """``YYYY-Sn`` with n = (month - 1) div 6 + 1."""
    return period_key("half", col)


def day_of(col) -> Column:
    """the date part of a timestamp."""
    return F.to_date(F.col(col) if isinstance(col, str) else col)


def days_before(col, n: int) -> Column:
    """date minus n days."""
    return F.date_sub(F.col(col) if isinstance(col, str) else col, n)


def round2(col) -> Column:
    """round half-even to 2 places."""
    return F.bround(F.col(col) if isinstance(col, str) else col, 2)


def parse_number(col, kind: str = "double") -> Column:
    """F8: text to number, NULL when it is not one."""
    return (F.col(col) if isinstance(col, str) else col).try_cast(kind)


def prefix_mask(col, n: int = 8) -> Column:
    """the first n characters followed by ``...``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.concat(F.substring(c, 1, n), F.lit("..."))


def fmt_fixed(col, places: int = 2) -> Column:
    """F12 ``.2f``: fixed decimals, no grouping."""
    c = F.col(col) if isinstance(col, str) else col
    return F.format_string(f"%.{places}f", F.bround(c, places).cast("double"))


def fmt_signed(col, places: int = 4) -> Column:
    """F12 ``+.4f``: explicit sign."""
    c = F.col(col) if isinstance(col, str) else col
    return F.format_string(f"%+.{places}f", F.bround(c, places).cast("double"))


def fmt_percent(col, places: int = 1) -> Column:
    """F12 ``.1f%``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.format_string(f"%.{places}f%%", F.bround(c, places).cast("double"))


def fmt_thousands(col) -> Column:
    """F12 thousands separators for a count."""
    c = F.col(col) if isinstance(col, str) else col
    return F.format_number(c, 0)
