"""DuckDB oracle SQL, written independently of the Spark operators.

Each query of ``catalog.py`` has a SQL twin here with the same output
columns. The SQL follows the textbook definitions: plain windows over whole
symbols, and the EMA as a recursive CTE (``e_t = a*x_t + (1-a)*e_(t-1)``),
so it checks the blocked Spark kernels rather than repeating them.
Signed values rounded in SQL get ``+ 0.0``: DuckDB's ``round`` keeps the
sign of a tiny negative (``-0.0``), Spark's rounds through a decimal and
gives ``0.0``; zero has no sign in this data model.
Tables ``orders``, ``customer`` ... are the driver's views.
"""

from __future__ import annotations

# -- bars (FIXTURES.md section 3) --------------------------------------------------------
ORDER_SRC = """SELECT c.c_mktsegment AS symbol, CAST(o.o_orderdate AS DATE) AS date,
       o.o_orderkey, o.o_totalprice
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"""

ORDER_BARS = f"""SELECT symbol, date, min_by(p, o_orderkey) AS open, max(p) AS high,
       min(p) AS low, max_by(p, o_orderkey) AS close, count(*) AS volume
  FROM (SELECT s.*, CAST(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.01 AS DECIMAL(3,2))
                         AS DECIMAL(10,4)) AS p
          FROM ({ORDER_SRC}) s) t
 GROUP BY symbol, date"""

WALK_BARS = f"""SELECT symbol, date,
       CAST(4000 + walk - step AS DECIMAL(10,4)) AS open,
       greatest(CAST(4000 + walk - step AS DECIMAL(10,4)), CAST(4000 + walk AS DECIMAL(10,4))) AS high,
       least(CAST(4000 + walk - step AS DECIMAL(10,4)), CAST(4000 + walk AS DECIMAL(10,4))) AS low,
       CAST(4000 + walk AS DECIMAL(10,4)) AS close, volume
  FROM (SELECT d.*, sum(step) OVER (PARTITION BY symbol ORDER BY date
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS walk
          FROM (SELECT symbol, date, max_by(s, o_orderkey) AS step, count(*) AS volume
                  FROM (SELECT x.*, (CAST(floor(o_totalprice / 100) AS DECIMAL(6,0)) - 2500)
                                    * CAST(0.01 AS DECIMAL(3,2)) AS s
                          FROM ({ORDER_SRC}) x) y
                 GROUP BY symbol, date) d) w"""


def served(bars: str, double: bool = False) -> str:
    """Raw bar names -> served names; ``double`` casts prices to DOUBLE."""
    def p(c):
        return f"CAST({c} AS DOUBLE)" if double else c
    return f"""SELECT symbol AS symbole, date AS date_trading, {p('open')} AS prix_ouverture,
       {p('high')} AS prix_haut, {p('low')} AS prix_bas, {p('close')} AS prix_fermeture,
       volume FROM ({bars}) sb"""


def _d(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def _ema_terms(span: int) -> tuple[str, str]:
    a = 2.0 / (span + 1)
    return _d(a), _d(1.0 - a)


def enriched_ctes(bars: str = WALK_BARS) -> str:
    """``WITH RECURSIVE ... enriched AS (...)``: the 20 data columns."""
    a12, q12 = _ema_terms(12)
    a26, q26 = _ema_terms(26)
    a9, q9 = _ema_terms(9)
    x = "CAST(b.c AS DOUBLE)"
    f12 = f"({a12} * {x} + {q12} * r.e12)"
    f26 = f"({a26} * {x} + {q26} * r.e26)"
    return f"""WITH RECURSIVE
b AS (SELECT symbol AS symbole, date AS date_trading, open AS o, high AS h, low AS l,
             close AS c, volume,
             row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS i
        FROM ({bars}) rb WHERE close IS NOT NULL),
r(symbole, i, e12, e26, sig) AS (
    SELECT symbole, i, CAST(c AS DOUBLE), CAST(c AS DOUBLE), CAST(0 AS DOUBLE) FROM b WHERE i = 0
    UNION ALL
    SELECT b.symbole, b.i, {f12}, {f26}, {a9} * ({f12} - {f26}) + {q9} * r.sig
      FROM r JOIN b ON b.symbole = r.symbole AND b.i = r.i + 1),
dl AS (SELECT b.*, c - lag(c) OVER (PARTITION BY symbole ORDER BY i) AS delta FROM b),
gl AS (SELECT dl.*,
              CASE WHEN delta > 0 THEN delta WHEN delta IS NOT NULL THEN 0 END AS gain,
              CASE WHEN delta < 0 THEN -delta WHEN delta IS NOT NULL THEN 0 END AS loss
         FROM dl),
ws AS (SELECT gl.*,
              sum(c) OVER (PARTITION BY symbole ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS s20,
              sum(c * c) OVER (PARTITION BY symbole ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS q20,
              sum(c) OVER (PARTITION BY symbole ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS s50,
              sum(c) OVER (PARTITION BY symbole ORDER BY i ROWS BETWEEN 199 PRECEDING AND CURRENT ROW) AS s200,
              sum(gain) OVER (PARTITION BY symbole ORDER BY i ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS g14,
              sum(loss) OVER (PARTITION BY symbole ORDER BY i ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS l14
         FROM gl),
ind AS (SELECT ws.symbole, date_trading, CAST(o AS DOUBLE) AS prix_ouverture,
               CAST(h AS DOUBLE) AS prix_haut, CAST(l AS DOUBLE) AS prix_bas,
               CAST(c AS DOUBLE) AS prix_fermeture, volume, ws.i,
               CASE WHEN ws.i >= 19 THEN CAST(s20 AS DOUBLE) / 20 END AS moyenne_mobile_20j,
               CASE WHEN ws.i >= 49 THEN CAST(s50 AS DOUBLE) / 50 END AS moyenne_mobile_50j,
               CASE WHEN ws.i >= 199 THEN CAST(s200 AS DOUBLE) / 200 END AS moyenne_mobile_200j,
               CASE WHEN ws.i >= 14 THEN CASE WHEN g14 + l14 = 0 THEN CAST(50 AS DOUBLE)
                    ELSE CAST(100 AS DOUBLE) * CAST(g14 AS DOUBLE) / CAST(g14 + l14 AS DOUBLE) END
               END AS rsi_14,
               CASE WHEN ws.i >= 25 THEN (round(r.e12 - r.e26, 4) + CAST(0 AS DOUBLE)) END AS macd_line,
               CASE WHEN ws.i >= 33 THEN (round(r.sig, 4) + CAST(0 AS DOUBLE)) END AS macd_signal,
               CASE WHEN ws.i >= 19 THEN CAST(s20 AS DOUBLE) / 20 END AS bollinger_middle,
               CASE WHEN ws.i >= 19 THEN sqrt(CAST(CAST(20 AS DECIMAL(5,0)) * CAST(q20 AS DECIMAL(24,8))
                    - CAST(s20 AS DECIMAL(19,4)) * CAST(s20 AS DECIMAL(19,4)) AS DOUBLE))
                    / CAST(20 AS DOUBLE) END AS sd20
          FROM ws JOIN r ON ws.symbole = r.symbole AND ws.i = r.i),
bands AS (SELECT ind.*, bollinger_middle + CAST(2 AS DOUBLE) * sd20 AS bollinger_upper,
                 bollinger_middle - CAST(2 AS DOUBLE) * sd20 AS bollinger_lower FROM ind),
enriched AS (
  SELECT symbole, date_trading, prix_ouverture, prix_haut, prix_bas, prix_fermeture, volume,
         moyenne_mobile_20j, moyenne_mobile_50j, moyenne_mobile_200j, rsi_14, macd_line,
         macd_signal, bollinger_middle, bollinger_upper, bollinger_lower,
         (prix_fermeture - bollinger_lower) / nullif(bollinger_upper - bollinger_lower, 0)
             AS bollinger_percent,
         CASE WHEN prix_fermeture IS NULL OR moyenne_mobile_50j IS NULL
                   OR moyenne_mobile_200j IS NULL THEN 'INDETERMINE'
              WHEN prix_fermeture > moyenne_mobile_50j AND moyenne_mobile_50j > moyenne_mobile_200j
                   THEN 'HAUSSIERE'
              WHEN prix_fermeture < moyenne_mobile_50j AND moyenne_mobile_50j < moyenne_mobile_200j
                   THEN 'BAISSIERE'
              ELSE 'NEUTRE' END AS tendance_globale,
         CASE WHEN rsi_14 > 70 THEN 'SURACHAT' WHEN rsi_14 < 30 THEN 'SURVENTE'
              WHEN rsi_14 IS NOT NULL THEN 'NEUTRE' END AS niveau_rsi,
         CASE WHEN coalesce(rsi_14 < 30 AND macd_line > macd_signal, false) THEN 'SIGNAL_ACHAT'
              WHEN coalesce(rsi_14 > 70 AND macd_line < macd_signal, false) THEN 'SIGNAL_VENTE'
              WHEN coalesce(prix_fermeture < bollinger_lower, false) THEN 'POTENTIEL_ACHAT_BB'
              WHEN coalesce(prix_fermeture > bollinger_upper, false) THEN 'POTENTIEL_VENTE_BB'
              ELSE 'NEUTRE' END AS signal_trading,
         i
    FROM bands)
"""


ENRICHED_DATA_COLUMNS = (
    "symbole, date_trading, prix_ouverture, prix_haut, prix_bas, prix_fermeture, volume, "
    "moyenne_mobile_20j, moyenne_mobile_50j, moyenne_mobile_200j, rsi_14, macd_line, "
    "macd_signal, bollinger_middle, bollinger_upper, bollinger_lower, bollinger_percent, "
    "tendance_globale, niveau_rsi, signal_trading")


def on_enriched(body: str, bars: str = WALK_BARS) -> str:
    """A query over the ``enriched`` CTE."""
    return enriched_ctes(bars) + body


def on(cte_sql: str, body: str, name: str = "bars") -> str:
    return f"WITH {name} AS ({cte_sql})\n{body}"


def round_half_even_mean(sum_expr: str, n_expr: str, places: int = 2) -> str:
    """Exact half-even rounding of a decimal(·,4) sum / n to ``places``,
    in integer arithmetic (DuckDB divides decimals in double)."""
    scale = 10 ** (4 - places)
    num = f"CAST(({sum_expr}) * 10000 AS HUGEINT)"
    den = f"(CAST({n_expr} AS HUGEINT) * {scale})"
    q = f"(({num}) // {den})"
    rem = f"(({num}) - {q} * {den})"
    up = (f"CASE WHEN 2 * {rem} > {den} THEN 1 WHEN 2 * {rem} = {den} "
          f"THEN {q} % 2 ELSE 0 END")
    return f"CAST(({q} + {up}) AS DOUBLE) / {10 ** places}"
