
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from barwise.operators import aggregates as G
from barwise.plans.enrich import enrich
from tests.helpers import bars

steps = st.lists(st.integers(min_value=-300, max_value=300), min_size=30, max_size=260)


def _walk(deltas, start=1000.0):
    out, x = [], start
    for d in deltas:
        x = max(1.0, round(x + d / 100.0, 2))
        out.append(x)
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(a=steps, b=steps)
def test_indicator_invariants(spark, a, b):
    raw = bars(spark, _walk(a), symbol="A", raw=True).unionByName(
        bars(spark, _walk(b), symbol="B", raw=True))
    out = enrich(raw, dt.datetime(2024, 1, 1)).collect()
    assert len(out) == len(a) + len(b)
    for r in out:
        if r.rsi_14 is not None:
            assert 0.0 <= r.rsi_14 <= 100.0
        if r.bollinger_middle is not None:
            assert r.bollinger_lower <= r.bollinger_middle <= r.bollinger_upper
        if r.moyenne_mobile_20j is not None:
            assert r.prix_bas - 1e-9 <= r.prix_fermeture
        if r.bollinger_percent is not None:
            assert r.bollinger_upper > r.bollinger_lower
    by_symbol = {}
    for r in out:
        by_symbol.setdefault(r.symbole, []).append(r)
    for rows in by_symbol.values():
        rows.sort(key=lambda r: r.date_trading)
        closes = [r.prix_fermeture for r in rows]
        for i, r in enumerate(rows):
            if r.moyenne_mobile_20j is not None:
                window = closes[i - 19:i + 1]
                assert min(window) - 1e-9 <= r.moyenne_mobile_20j <= max(window) + 1e-9


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(a=steps)
def test_shares_bounded_and_corr_symmetric(spark, a):
    from barwise.operators.correlation import corr_matrix
    raw = bars(spark, _walk(a), symbol="A", raw=True).unionByName(
        bars(spark, _walk(list(reversed(a))), symbol="B", raw=True))
    out = enrich(raw, dt.datetime(2024, 1, 1))
    for r in G.signal_share(out).collect():
        assert 0 <= r.pct_achat + r.pct_vente <= 100.0 + 1e-9
    corr = {(r.symbole_a, r.symbole_b): r.correlation
            for r in corr_matrix(out, digits=None).collect()}
    assert corr[("A", "B")] == corr[("B", "A")] or (
        abs(corr[("A", "B")] - corr[("B", "A")]) < 1e-12)
    for s in "AB":
        assert corr[(s, s)] is None or abs(corr[(s, s)] - 1.0) < 1e-12
