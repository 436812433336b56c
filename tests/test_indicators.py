"""Hand-computed goldens for the indicator operators (FIXTURES.md section 4)."""

import math

import pandas as pd
import pytest

from barwise.operators import indicators as I
from barwise.plans.enrich import enrich, indicators
from tests.helpers import bars, by_date


def test_constant_close_collapses_bands_and_rsi_is_50(spark):
    df = I.bollinger_percent(I.rsi(I.bollinger(bars(spark, [100] * 40), 20, 2), 14))
    rows = df.orderBy("date_trading").collect()
    assert all(r.bollinger_upper == r.bollinger_lower == 100.0 for r in rows[19:])
    assert all(r.bollinger_percent is None for r in rows)
    assert all(r.rsi_14 == 50.0 for r in rows[14:])


def test_rising_and_falling_rsi(spark):
    up = I.rsi_level(I.rsi(bars(spark, list(range(100, 140))), 14))
    down = I.rsi_level(I.rsi(bars(spark, list(range(140, 100, -1))), 14))
    assert set(by_date(up, "rsi_14")[14:]) == {100.0}
    assert set(by_date(down, "rsi_14")[14:]) == {0.0}
    assert set(by_date(up, "niveau_rsi")[14:]) == {"SURACHAT"}
    assert set(by_date(down, "niveau_rsi")[14:]) == {"SURVENTE"}


@pytest.mark.parametrize("n_rows", [13, 14, 15, 19, 20])
def test_null_until_window_full(spark, n_rows):
    df = I.rsi(I.sma(bars(spark, [float(i % 7 + 10) for i in range(n_rows)]), 20), 14)
    sma = by_date(df, "sma_20")
    rsi = by_date(df, "rsi_14")
    assert sma[:19] == [None] * min(19, n_rows)
    assert rsi[:14] == [None] * min(14, n_rows)
    if n_rows >= 20:
        assert sma[19] == pytest.approx(sum(i % 7 + 10 for i in range(20)) / 20)
    if n_rows >= 15:
        assert rsi[14] is not None


def test_sma_matches_hand_mean(spark):
    closes = [10.5, 11.25, 9.75, 12.0, 13.5, 8.0]
    df = I.sma(bars(spark, closes), 3)
    got = by_date(df, "sma_3")
    assert got[:2] == [None, None]
    for i in range(2, len(closes)):
        assert got[i] == pytest.approx(sum(closes[i - 2:i + 1]) / 3, abs=1e-12)


def _pandas_macd(closes):
    s = pd.Series(closes, dtype=float)
    line = s.ewm(span=12, adjust=False).mean() - s.ewm(span=26, adjust=False).mean()
    return line, line.ewm(span=9, adjust=False).mean()


def test_macd_matches_pandas_across_many_blocks(spark):
    closes = [round(100 + 10 * math.sin(i / 7.0) + (i % 5), 4) for i in range(700)]
    from barwise.operators.series import finish_series, prepare_series
    line, sig = _pandas_macd(closes)
    # halo 0: carry-table join; halo 509 over 64-row blocks: in-partition sums
    for halo in (0, I.macd_halo()):
        p = prepare_series(bars(spark, closes), "symbole", "date_trading", halo=halo, block=64)
        got = finish_series(I.macd(p)).orderBy("date_trading").toPandas()
        assert len(got) == len(closes)
        assert got.macd_line[25:].round(4).tolist() == line[25:].round(4).tolist()
        assert got.macd_signal[33:].round(4).tolist() == sig[33:].round(4).tolist()
        assert got.macd_line[:25].isna().all() and got.macd_signal[:33].isna().all()


def test_ema_of_constant_is_constant(spark):
    df = I.ema(bars(spark, [42.5] * 50), "prix_fermeture", span=10, out="e")
    assert all(abs(v - 42.5) < 1e-12 for v in by_date(df, "e"))


def test_wilder_rsi_bounds(spark):
    closes = [100 + ((i * 37) % 11) - 5 for i in range(60)]
    vals = [v for v in by_date(I.rsi(bars(spark, closes), 14, method="wilder"), "rsi_14") if v is not None]
    assert len(vals) == 60 - 14 and all(0 <= v <= 100 for v in vals)


def test_trend_labels(spark):
    up = I.trend(I.sma(I.sma(bars(spark, list(range(1, 221))), 50, out="moyenne_mobile_50j"),
                       200, out="moyenne_mobile_200j"))
    labels = by_date(up, "tendance_globale")
    assert labels[0] == "INDETERMINE" and labels[-1] == "HAUSSIERE"


def test_null_close_dropped_before_windows(spark):
    closes = [10, 11, None, 12, 13]
    out = enrich(bars(spark, closes, raw=True))
    assert out.count() == 4


def test_null_keys_dropped_before_windows(spark):
    from pyspark.sql import functions as F
    raw = bars(spark, [10, 11, 12, 13], raw=True)
    raw = raw.withColumn("symbol", F.when(F.col("date") == "2024-01-02", None)
                         .otherwise(F.col("symbol")))
    raw = raw.withColumn("date", F.when(F.col("close") == 13, None).otherwise(F.col("date")))
    assert enrich(raw).count() == 2


def test_all_five_signals_occur_on_walk_bars(spark):
    from barwise.sources.bars import walk_bars
    out = enrich(walk_bars(spark, "/root/testdata/sf0.01"))
    got = {r.signal_trading for r in out.select("signal_trading").distinct().collect()}
    assert got == {"SIGNAL_ACHAT", "SIGNAL_VENTE", "POTENTIEL_ACHAT_BB", "POTENTIEL_VENTE_BB",
                   "NEUTRE"}
    levels = {r.niveau_rsi for r in out.select("niveau_rsi").distinct().collect()}
    assert {"SURACHAT", "SURVENTE"} <= levels


def test_enriched_schema_is_the_contract(spark):
    from barwise.schemas import ENRICHED
    out = enrich(bars(spark, [10 + i for i in range(30)], raw=True))
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in ENRICHED]


def test_block_size_does_not_change_results(spark):
    from barwise.sources.bars import walk_bars
    from barwise.plans.enrich import to_served
    served = to_served(walk_bars(spark, "/root/testdata/sf0.001"))
    a = indicators(served, block=2048).orderBy("symbole", "date_trading").collect()
    b = indicators(served, block=256).orderBy("symbole", "date_trading").collect()
    assert a == b


def test_hot_symbol_is_spread_over_blocks(spark):
    """A symbol holding most rows is cut into many (symbol, block) groups,
    none larger than a block plus its halo."""
    import datetime as dt
    from pyspark.sql import functions as F
    from barwise.operators.series import BLK, prepare_series
    hot = bars(spark, [100 + (i % 17) for i in range(3000)], symbol="HOT",
               start=dt.date(2000, 1, 1))
    cold = bars(spark, [50.0] * 40, symbol="COLD")
    p = prepare_series(hot.unionByName(cold), "symbole", "date_trading", halo=20, block=256)
    sizes = {(r.symbole, r[BLK]): r["n"] for r in
             p.groupBy("symbole", BLK).agg(F.count("*").alias("n")).collect()}
    assert sum(1 for s, _ in sizes if s == "HOT") == 12
    assert max(sizes.values()) <= 256 + 20


def test_windows_count_rows_across_a_date_gap(spark):
    import datetime as dt
    a = bars(spark, [10.0, 11.0], start=dt.date(2024, 1, 1))
    b = bars(spark, [12.0, 13.0], start=dt.date(2024, 3, 1))  # two months later
    got = by_date(I.sma(a.unionByName(b), 3), "sma_3")
    assert got == [None, None, 11.0, 12.0]


@pytest.mark.parametrize("span", [2, 3, 5, 300])
def test_ema_of_any_span_matches_pandas(spark, span):
    closes = [round(100 + 10 * math.sin(i / 7.0) + (i % 5), 4) for i in range(1500)]
    got = by_date(I.ema(bars(spark, closes), "prix_fermeture", span=span, out="e"), "e")
    want = pd.Series(closes).ewm(span=span, adjust=False).mean().tolist()
    assert got == pytest.approx(want, abs=1e-8)


@pytest.mark.parametrize("spans", [(6, 13, 5), (3, 8, 3), (2, 200, 9)])
def test_macd_of_any_spans_matches_pandas(spark, spans):
    fast, slow, signal = spans
    closes = [round(100 + 10 * math.sin(i / 7.0) + (i % 5), 4) for i in range(900)]
    s = pd.Series(closes)
    line = s.ewm(span=fast, adjust=False).mean() - s.ewm(span=slow, adjust=False).mean()
    sig = line.ewm(span=signal, adjust=False).mean()
    got = I.macd(bars(spark, closes), *spans).orderBy("date_trading").toPandas()
    assert got.macd_line[slow - 1:].tolist() == pytest.approx(line[slow - 1:].tolist(), abs=1e-4)
    start = slow + signal - 2
    assert got.macd_signal[start:].tolist() == pytest.approx(sig[start:].tolist(), abs=1e-4)


def test_wilder_of_three(spark):
    vals = by_date(I.rsi(bars(spark, [100 + ((i * 37) % 11) for i in range(40)]), 3, method="wilder"), "rsi_3")
    assert vals[:3] == [None] * 3 and all(0 <= v <= 100 for v in vals[3:])


def test_null_and_nan_prices_are_left_out_of_every_indicator(spark):
    from pyspark.sql import functions as F
    df = bars(spark, [10.0] * 30).withColumn("prix_fermeture", F.col("prix_fermeture").cast("double"))
    day = F.dayofmonth("date_trading")
    df = df.withColumn("prix_fermeture", F.when(day == 12, F.lit(float("nan")))
                       .when(day != 15, F.col("prix_fermeture")))
    for got, col in ((I.sma(df, 20), "sma_20"), (I.ema(df, "prix_fermeture", span=12, out="e"), "e"),
                     (I.bollinger(df), "bollinger_upper"), (I.rsi(df, 14), "rsi_14")):
        values = by_date(got, col)
        assert len(values) == 28
        assert set(values) <= {None, 10.0, 50.0} or max(abs(v - 10) for v in values if v) < 1e-9


def test_flat_stretch_of_doubles_has_a_flat_band(spark):
    from pyspark.sql import functions as F
    closes = [100 + 7.3 * math.sin(i) for i in range(80)] + [123.4567] * 60
    df = bars(spark, closes).withColumn("prix_fermeture", F.col("prix_fermeture").cast("double"))
    rows = I.bollinger_percent(I.bollinger(df)).orderBy("date_trading").collect()
    for r in rows[-40:]:
        assert r.bollinger_upper == r.bollinger_lower == 123.4567 and r.bollinger_percent is None


def test_enrich_without_batches_keeps_one_row_a_day(spark):
    raw = bars(spark, [10 + i for i in range(25)], raw=True)
    assert enrich(raw.unionByName(raw)).count() == 25
