"""Serving views on a hand-built enriched frame."""

import datetime as dt

from barwise.plans import views as V

COLS = ("symbole string, date_trading date, prix_fermeture double, rsi_14 double, "
        "macd_line double, macd_signal double, niveau_rsi string, signal_trading string, "
        "tendance_globale string")


def _frame(spark):
    d = dt.date(2024, 3, 1)
    rows = [
        ("A", d, 10.0, 25.0, 1.0, 0.5, "SURVENTE", "SIGNAL_ACHAT", "NEUTRE"),
        ("A", d + dt.timedelta(days=1), 11.0, 75.0, 0.5, 1.0, "SURACHAT", "SIGNAL_VENTE", "HAUSSIERE"),
        ("A", d + dt.timedelta(days=2), 12.0, 50.0, 0.2, 0.2, "NEUTRE", "POTENTIEL_ACHAT_BB", "HAUSSIERE"),
        ("A", d + dt.timedelta(days=3), 12.5, None, None, None, None, None, "INDETERMINE"),
        ("B", d, 5.0, 50.0, -0.1, 0.0, "NEUTRE", "NEUTRE", "BAISSIERE"),
    ]
    return spark.createDataFrame(rows, COLS)


def test_signal_board(spark):
    got = {r.symbole: r for r in V.view_signal_board(_frame(spark)).collect()}
    a = got["A"]
    assert (a.signaux_achat, a.signaux_vente) == (2, 1)
    assert a.pct_achat == 2 * 100 / 3 and a.pct_vente == 100 / 3
    assert a.tendance_actuelle == "INDETERMINE" and a.dernier_signal is None
    assert (got["B"].signaux_achat, got["B"].pct_achat) == (0, 0.0)


def test_macd_latest_and_histogram(spark):
    latest = {r.symbole: r for r in V.view_macd_latest(_frame(spark)).collect()}
    assert latest["A"].macd_direction == "BAISSE"  # latest line is NULL
    assert latest["B"].macd_direction == "BAISSE" and latest["B"].macd_gap == -0.1
    hist = {(r.symbole, r.date_trading.day): r for r in V.view_macd(_frame(spark)).collect()}
    assert hist[("A", 1)].histogram_positive and hist[("A", 1)].macd_histogram == 0.5
    assert hist[("A", 3)].histogram_positive  # tie counts as non-negative
    assert not hist[("A", 4)].histogram_positive  # NULL counts as negative


def test_trailing_views_and_tables(spark):
    df = _frame(spark)
    assert V.view_rsi(df, "A", days=2).count() == 2
    assert [r.date_trading.day for r in V.view_signal_table(df, "A", n=2).collect()] == [3, 4]
    assert V.view_rsi_latest(df).count() == 2
