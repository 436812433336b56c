"""Pearson correlation of closes between symbols, over common dates.

pandas' ``pivot_table(...).corr()`` semantics: the mean close per (symbol,
date), then for every pair of symbols the correlation over the dates where
both have a value. A series that is constant over the common dates, and a
single common date, give NULL.

No per-date pair rows are made. This is a blocked matrix product: dates
are cut into blocks of ``block_days`` and symbols into tiles; one pandas
task per (date block, tile pair) forms the dense date x symbol matrices of
the two tiles and their masked Gram sums (n, sum x, sum y, sum x^2,
sum y^2, sum xy and both ranges for every pair), one row per pair and
block. Spark then adds these partial sums per pair (partial aggregation before the shuffle).
Values are centred per symbol first, which keeps the sums well conditioned.
The output itself has one row per pair of symbols.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, ship_package
from .aggregates import exact_mean
from .filters import DATE, KEY, filter_symbols_in

_PARTIAL_SCHEMA = ("symbol_a string, symbol_b string, n double, sa double, sb double, "
                   "saa double, sbb double, sab double, lo_a double, hi_a double, "
                   "lo_b double, hi_b double")


def _ranges(x: np.ndarray, present: np.ndarray, other: np.ndarray):
    """Least and greatest value of each column of ``x`` on the days that a
    column of ``other`` has, for all pairs; day by day, so a task holds a few
    matrices of pairs only."""
    lo = np.full((x.shape[1], other.shape[1]), np.inf)
    hi = np.full_like(lo, -np.inf)
    for day in range(len(x)):
        both = present[day][:, None] & other[day][None, :]
        np.minimum(lo, np.where(both, x[day][:, None], np.inf), out=lo)
        np.maximum(hi, np.where(both, x[day][:, None], -np.inf), out=hi)
    return lo, hi


def _gram(pdf: pd.DataFrame) -> pd.DataFrame:
    """Masked Gram sums between the symbols of tile ``_ta`` and tile ``_tb``
    over the dates of one block (one row per ordered pair)."""
    wide = pdf.pivot(index="d", columns="s", values="x")
    names = np.asarray(wide.columns)
    x = wide.to_numpy(dtype=float)
    present = ~np.isnan(x)
    m = present.astype(float)
    x0 = np.where(present, x, 0.0)
    tiles = pdf.drop_duplicates("s").set_index("s")["_t"].reindex(names).to_numpy()
    ta, tb = pdf["_ta"].iloc[0], pdf["_tb"].iloc[0]
    left = np.flatnonzero(tiles == ta)
    right = np.flatnonzero(tiles == tb)
    xl, ml, xr, mr = x0[:, left], m[:, left], x0[:, right], m[:, right]
    n = ml.T @ mr
    sa = xl.T @ mr          # sum of a over dates where b is present
    sb = ml.T @ xr          # sum of b over dates where a is present
    saa = (xl * xl).T @ mr
    sbb = ml.T @ (xr * xr)
    sab = xl.T @ xr
    lo_a, hi_a = _ranges(xl, present[:, left], present[:, right])
    lo_b, hi_b = _ranges(xr, present[:, right], present[:, left])
    i, j = np.nonzero(n)
    a_names, b_names = names[left][i], names[right][j]
    out = pd.DataFrame({"symbol_a": a_names, "symbol_b": b_names, "n": n[i, j],
                        "sa": sa[i, j], "sb": sb[i, j], "saa": saa[i, j], "sbb": sbb[i, j],
                        "sab": sab[i, j], "lo_a": lo_a[i, j], "hi_a": hi_a[i, j],
                        "lo_b": lo_b[j, i], "hi_b": hi_b[j, i]})
    if ta != tb:  # the mirrored pairs of an off-diagonal tile
        mirror = out.rename(columns={"symbol_a": "symbol_b", "symbol_b": "symbol_a",
                                     "sa": "sb", "sb": "sa", "saa": "sbb", "sbb": "saa",
                                     "lo_a": "lo_b", "lo_b": "lo_a", "hi_a": "hi_b", "hi_b": "hi_a"})
        out = pd.concat([out, mirror[out.columns]], ignore_index=True)
    return out


def corr_matrix(df: DataFrame, symbols=None, key: str = KEY, date: str = DATE,
                close: str = "prix_fermeture", digits: int | None = 2,
                block_days: int = 64, symbols_per_tile: int = 256) -> DataFrame:
    """``(symbol_a, symbol_b, correlation)`` for every pair with a common date.

    Work is cut into (date block, symbol tile pair) groups: each holds at
    most ``block_days`` dates of two tiles of about ``symbols_per_tile``
    symbols, whatever the size of the universe. Each daily value is sent to
    the tile pairs its symbol belongs to (as many copies as there are tiles).
    """
    ship_package(df.sparkSession)
    if symbols is not None:
        df = filter_symbols_in(df, symbols, key)
    base = df.where(F.col(key).isNotNull() & F.col(close).isNotNull() & F.col(date).isNotNull())
    daily = materialize(base.groupBy(key, date).agg(exact_mean(base, close).alias("x")),
                        "corr_daily")
    centres = daily.groupBy(key).agg(F.avg("x").alias("_m"))
    # one number to the driver: how many tiles the symbol axis needs
    n_symbols = daily.select(F.countDistinct(key)).first()[0] or 0
    tiles = max(1, math.ceil(n_symbols / symbols_per_tile))
    tile = F.pmod(F.xxhash64(F.col(key)), F.lit(tiles))
    other = F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("_o")
    centred = (daily.join(centres, key)
               .select(F.col(key).alias("s"), F.col(date).alias("d"),
                       (F.col("x") - F.col("_m")).alias("x"), tile.alias("_t"),
                       F.floor(F.datediff(F.col(date), F.lit("1970-01-01").cast("date"))
                               / block_days).alias("_db")))
    spread = (centred.select("*", other)
              .select("s", "d", "x", "_t", "_db",
                      F.least("_t", "_o").alias("_ta"), F.greatest("_t", "_o").alias("_tb")))
    partial = spread.groupBy("_db", "_ta", "_tb").applyInPandas(
        lambda pdf: _gram(pdf), _PARTIAL_SCHEMA)
    sums = partial.groupBy("symbol_a", "symbol_b").agg(
        *[F.sum(c).alias(c) for c in ("n", "sa", "sb", "saa", "sbb", "sab")],
        *[F.min(c).alias(c) for c in ("lo_a", "lo_b")], *[F.max(c).alias(c) for c in ("hi_a", "hi_b")])
    n, sa, sb = F.col("n"), F.col("sa"), F.col("sb")
    var_a = n * F.col("saa") - sa * sa
    var_b = n * F.col("sbb") - sb * sb
    denom = F.sqrt(var_a * var_b)
    # whether a series moves is told by its range, not by the rounding of its variance
    moves = (F.col("hi_a") > F.col("lo_a")) & (F.col("hi_b") > F.col("lo_b"))
    r = F.when((n >= 2) & moves & (var_a > 0) & (var_b > 0), (n * F.col("sab") - sa * sb) / denom)
    # clamp rounding overshoot; greatest/least skip NULLs, so guard them
    r = F.when(r.isNotNull(), F.least(F.greatest(r, F.lit(-1.0)), F.lit(1.0)))
    if digits is not None:
        r = F.bround(r, digits)
    return sums.select(F.col("symbol_a").alias(f"{key}_a"), F.col("symbol_b").alias(f"{key}_b"),
                       r.alias("correlation"))
