"""Aggregates, period keys, correlation and filters on small literal frames."""

import datetime as dt

import pytest

from barwise.operators import aggregates as G
from barwise.operators import filters as P
from barwise.operators.correlation import corr_matrix
from tests.helpers import bars


def test_period_keys_at_edges(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 6, 30),), (dt.date(2024, 7, 1),), (dt.date(2023, 12, 31),),
         (dt.date(2024, 1, 1),)], "date_trading date")
    got = {r.date_trading: r for r in df.select(
        "date_trading", *[G.period_key(g).alias(g) for g in G.GRAINS]).collect()}
    assert got[dt.date(2024, 6, 30)].half == "2024-S1"
    assert got[dt.date(2024, 7, 1)].half == "2024-S2"
    assert got[dt.date(2024, 6, 30)].quarter == "2024Q2"
    assert got[dt.date(2024, 7, 1)].quarter == "2024Q3"
    assert got[dt.date(2023, 12, 31)].month == "2023-12"
    assert got[dt.date(2024, 1, 1)].year == "2024"


def test_volatility_single_row_is_null_and_constant_is_zero(spark):
    one = G.perf_volatility(bars(spark, [10.0]), "month").collect()
    assert one[0].volatilite_pourcent is None
    flat = G.perf_volatility(bars(spark, [10.0] * 5), "month").collect()
    assert flat[0].volatilite_pourcent == 0.0


def test_mean_rounds_half_even_exactly(spark):
    # mean 10.125 -> 10.12 ; 10.135 -> 10.14 (half-even on the exact mean)
    a = G.perf_price(bars(spark, [10.12, 10.13]), "month").collect()[0]
    b = G.perf_price(bars(spark, [10.13, 10.14]), "month").collect()[0]
    assert a.prix_fermeture == 10.12 and b.prix_fermeture == 10.14


def test_signal_share_empty_denominator(spark):
    df = spark.createDataFrame([("S", None)], "symbole string, signal_trading string")
    r = G.signal_share(df).collect()[0]
    assert (r.signaux_achat, r.signaux_vente, r.pct_achat, r.pct_vente) == (0, 0, 0.0, 0.0)


def test_perf_volume_sums_nothing_to_zero(spark):
    df = spark.createDataFrame([("S", dt.date(2024, 1, 2), None)],
                               "symbole string, date_trading date, volume bigint")
    assert G.perf_volume(df, "month").collect()[0].volume == 0


def test_corr_common_dates_only_and_constant_is_null(spark):
    a = bars(spark, [1, 2, 3, 4, 5, 6], symbol="A")
    b = bars(spark, [2, 4, 6, 8], symbol="B", start=dt.date(2024, 1, 3))  # dates 3..6
    c = bars(spark, [7, 7, 7, 7, 7, 7], symbol="C")
    df = a.unionByName(b).unionByName(c)
    got = {(r.symbole_a, r.symbole_b): r.correlation
           for r in corr_matrix(df, digits=6, block_days=2).collect()}
    assert got[("A", "B")] == pytest.approx(1.0)
    assert got[("B", "A")] == pytest.approx(1.0)
    assert got[("A", "A")] == pytest.approx(1.0)
    assert got[("A", "C")] is None and got[("C", "C")] is None


def test_corr_matches_pandas_pairwise(spark):
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(7)
    rows = []
    for s in "XYZ":
        for d in range(120):
            if rng.random() < 0.8:
                rows.append((s, dt.date(2024, 1, 1) + dt.timedelta(days=d),
                             float(round(100 + rng.normal() * 5, 4))))
    df = spark.createDataFrame(rows, "symbole string, date_trading date, prix_fermeture double")
    want = pd.DataFrame(rows, columns=["s", "d", "x"]).pivot_table(
        values="x", index="d", columns="s").corr()
    for per_tile in (256, 2, 1):  # one tile; several tiles, so off-diagonal tile pairs
        got = corr_matrix(df, digits=None, block_days=16, symbols_per_tile=per_tile).collect()
        assert len(got) == 9
        for r in got:
            assert r.correlation == pytest.approx(want.loc[r.symbole_a, r.symbole_b], abs=1e-12)


def test_trailing_days_excludes_day_exactly_n_back(spark):
    df = bars(spark, [1.0] * 11)  # 2024-01-01 .. 2024-01-11
    got = P.trailing_days(df, 10).collect()
    assert min(r.date_trading for r in got) == dt.date(2024, 1, 2)
    got = P.trailing_days(df, 10, as_of="2024-01-11").count()
    assert got == 10


def test_symbols_in_empty_gives_nothing(spark):
    assert P.filter_symbols_in(bars(spark, [1.0, 2.0]), []).count() == 0


def test_last_n_rows_and_last_row(spark):
    df = bars(spark, [1.0, 2.0, 3.0, 4.0], symbol="A").unionByName(bars(spark, [5.0], symbol="B"))
    got = [(r.symbole, float(r.prix_fermeture)) for r in P.last_n_rows(df, 2).collect()]
    assert got == [("A", 3.0), ("A", 4.0), ("B", 5.0)]
    last = {r.symbole: float(r.prix_fermeture) for r in P.last_row(df).collect()}
    assert last == {"A": 4.0, "B": 5.0}


def test_permuting_rows_changes_nothing(spark):
    from barwise.plans.enrich import enrich
    from barwise.sources.bars import walk_bars
    wb = walk_bars(spark, "/root/testdata/sf0.001")
    a = enrich(wb, dt.datetime(2024, 1, 1)).orderBy("symbole", "date_trading").collect()
    shuffled = wb.repartition(7).orderBy("volume", "close")
    b = enrich(shuffled, dt.datetime(2024, 1, 1)).orderBy("symbole", "date_trading").collect()
    assert a == b


def test_is_empty_and_global_order(spark):
    df = bars(spark, [3.0, 1.0, 2.0], symbol="B").unionByName(bars(spark, [5.0], symbol="A"))
    assert not P.is_empty(df) and P.is_empty(df.where("false"))
    got = [(r.symbole, r.date_trading) for r in P.order_symbol_date(df.repartition(3)).collect()]
    assert got == sorted(got)
    assert [r.symbole for r in P.distinct_symbols(df).collect()] == ["A", "B"]


def test_trailing_months_clamps_to_month_end(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 2, 28),), (dt.date(2024, 2, 29),), (dt.date(2024, 3, 31),)],
        "date_trading date")
    got = sorted(r.date_trading.day for r in P.trailing_months(df, 1).collect())
    assert got == [29, 31]  # 31 Mar minus one month is 29 Feb, kept (>=)
    assert P.range_button(df, "1w").count() == 1
    assert P.range_button(df, "all").count() == 3


def test_correlation_is_null_where_a_series_is_flat_on_common_dates(spark):
    import datetime as dt
    import math

    from pyspark.sql import functions as F
    from barwise.operators.correlation import corr_matrix
    rows = []
    for i in range(120):
        day = dt.date(2024, 1, 1) + dt.timedelta(days=i)
        rows.append(("MOVES", day, 100 + math.sin(i)))
        # flat on the first 60 days, where FLAT2 is missing afterwards
        rows.append(("FLAT", day, 33.3 if i < 60 else 33.3 + i))
        if i < 60:
            rows.append(("SHORT", day, 10 + (i % 7) * 0.1))
    df = spark.createDataFrame(rows, "symbole string, date_trading date, prix_fermeture double")
    got = {(r.symbole_a, r.symbole_b): r.correlation for r in corr_matrix(df, symbols_per_tile=1).collect()}
    assert got["FLAT", "SHORT"] is None and got["SHORT", "FLAT"] is None
    assert got["FLAT", "MOVES"] is not None and got["SHORT", "SHORT"] == 1.0


def test_periods_leave_out_null_dates(spark):
    from barwise.operators.aggregates import perf_volume
    df = spark.createDataFrame([("A", None, 5)], "symbole string, date_trading date, volume bigint")
    assert perf_volume(df, "month").count() == 0


def test_the_deviation_about_the_mean_is_the_exact_one(spark):
    import math

    from pyspark.sql import functions as F

    from barwise.operators.aggregates import exact_sample_std, shifted_sample_std
    df = spark.range(3000).select(
        (F.col("id") % 4).alias("g"),
        F.when(F.col("id") % 4 == 0, F.lit(123456.7891)).when(F.col("id") % 4 == 1, 999999 - F.col("id") % 7 * 0.0001)
        .otherwise(F.rand(5) * 900000).cast("decimal(10,4)").alias("x")).unionByName(
        spark.sql("SELECT 9L AS g, CAST(5 AS decimal(10,4)) AS x"))
    got = df.groupBy("g").agg(exact_sample_std(df, "x").alias("a"), shifted_sample_std(df, "x").alias("b")).collect()
    assert len(got) == 5
    for r in got:
        assert (r.a is None and r.b is None and r.g == 9) or math.isclose(r.a, r.b, rel_tol=1e-12)
        assert r.g != 0 or r.a == r.b == 0.0
