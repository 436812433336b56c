"""``SQL``: the DuckDB twin of every registered query (same names, same columns)."""

from __future__ import annotations

from .oracle import (ENRICHED_DATA_COLUMNS, ORDER_BARS, WALK_BARS, on, on_enriched,
                     round_half_even_mean, served)

SQL: dict[str, str] = {}

SQL["avg_price_volume"] = on(ORDER_BARS, """
SELECT symbol, CAST(sum(close) AS DOUBLE) / count(close) AS avg_price,
       CAST(sum(volume) AS BIGINT) AS total_volume
  FROM bars GROUP BY symbol""")

SQL["enrich"] = on_enriched(f"SELECT {ENRICHED_DATA_COLUMNS} FROM enriched")

SO = served(ORDER_BARS)             # served order bars, decimal prices
SOD = served(ORDER_BARS, double=True)
SW = served(WALK_BARS)
SEG = "('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')"
BATCH1, BATCH2 = "BATCH_20200101_2100", "BATCH_20200102_2100"


def _dbl(cols):
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)


# -- S ----------------------------------------------------------------------------------
SQL["parse_daily"] = on(WALK_BARS, f"""
SELECT symbol, date, {_dbl(['open', 'high', 'low', 'close'])}, CAST(volume AS BIGINT) AS volume
  FROM bars""")

SQL["streamed_ingest"] = on(WALK_BARS, f"""
SELECT symbol, date, {_dbl(['open', 'high', 'low', 'close'])}, volume FROM bars""")

SQL["parse_quote"] = on(WALK_BARS, """
SELECT symbol, CAST(max_by(close, date) AS DOUBLE) AS price FROM bars GROUP BY symbol""")

SQL["range_button_1w"] = on(SOD, """SELECT * FROM bars
 WHERE date_trading >= (SELECT max(date_trading) FROM bars) - 7""")

SQL["latest_30_bars"] = on(ORDER_BARS, f"""
SELECT symbol, date, {_dbl(['open', 'high', 'low', 'close'])}, volume FROM bars
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) <= 30""")

SQL["mask_column"] = """
SELECT c_custkey, CASE WHEN c_name IS NOT NULL THEN '...' || right(c_name, 2) END AS c_name
  FROM customer"""

_FALLBACK = f"""WITH ob AS ({ORDER_BARS}),
p AS (SELECT symbol, date, CAST(close AS DOUBLE) AS close, 'PRIMARY' AS data_source
        FROM ob {{where}}),
f AS (SELECT symbol, date, CAST(close AS DOUBLE) AS close, 'FALLBACK' AS data_source
        FROM ({WALK_BARS}) w)
SELECT * FROM p UNION ALL SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM p)"""
SQL["fallback_source"] = _FALLBACK.format(where="WHERE date > (SELECT max(date) FROM ob)")
SQL["fallback_unused"] = _FALLBACK.format(where="")

_CANDIDATES = """SELECT c.c_mktsegment AS symbol, CAST(o.o_orderdate AS DATE) AS date,
       o.o_totalprice * 2.5 AS close
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"""
_REASON = """CASE WHEN symbol IS NULL THEN 'NULL_SYMBOL' WHEN date IS NULL THEN 'NULL_DATE'
     WHEN length(symbol) > 10 THEN 'TEXT_TOO_LONG'
     WHEN abs(close) >= 1000000 THEN 'OUT_OF_RANGE' END"""
SQL["reject_rows"] = f"""
SELECT symbol, date, close, reject_reason
  FROM (SELECT *, {_REASON} AS reject_reason FROM ({_CANDIDATES}) c) t
 WHERE reject_reason IS NOT NULL"""
SQL["reject_summary"] = f"""
SELECT coalesce({_REASON}, 'OK') AS outcome, count(*) AS n FROM ({_CANDIDATES}) c GROUP BY 1"""

_TWO_BATCH = f"""WITH ob AS ({ORDER_BARS}),
recent AS (SELECT DISTINCT date FROM ob ORDER BY date DESC LIMIT 30),
raw AS (SELECT symbol, date, close, '{BATCH1}' AS batch_id,
               TIMESTAMP '2020-01-01 21:00:00' AS load_timestamp FROM ob
        UNION ALL
        SELECT symbol, date, CAST(close + CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,4)),
               '{BATCH2}', TIMESTAMP '2020-01-02 21:00:00'
          FROM ob WHERE date IN (SELECT date FROM recent))
"""
SQL["batch_verify"] = _TWO_BATCH + f"""
SELECT '{BATCH2}' AS batch_id, count(*) AS verified FROM raw WHERE batch_id = '{BATCH2}'"""

SQL["table_profile_sketch"] = f"""WITH ob AS ({ORDER_BARS}),
recent AS (SELECT DISTINCT date FROM ob ORDER BY date DESC LIMIT 30),
raw AS (SELECT * FROM ob UNION ALL
        SELECT symbol, date, open, high, low, CAST(close + CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,4)), volume
          FROM ob WHERE date IN (SELECT date FROM recent))
""" + "\nUNION ALL\n".join(
    f"""SELECT {i} AS position, '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls,
       CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value,
       TRUE AS distinct_within_5pct FROM raw"""
    for i, c in enumerate(("symbol", "date", "open", "high", "low", "close", "volume")))

SQL["dedupe_latest_batch"] = _TWO_BATCH + """
SELECT symbol, date, CAST(close AS DOUBLE) AS close, batch_id FROM raw
QUALIFY row_number() OVER (PARTITION BY symbol, date
                           ORDER BY batch_id DESC, load_timestamp DESC) = 1"""

SQL["run_log"] = _TWO_BATCH + f"""
SELECT 'daily_bars' AS pipeline_name, '{BATCH2}' AS batch_id, 'PRIMARY' AS data_source,
       count(*) AS rows_processed, 'SUCCESS' AS status,
       'Inserted: ' || count(*) || ', Errors: 0, Verified: ' || count(*) AS details
  FROM raw WHERE batch_id = '{BATCH2}'"""

_RUNS = f"""WITH raw AS (
  SELECT symbol, date, CAST(close AS DOUBLE) AS close, 21 AS load_hour
    FROM ({ORDER_BARS}) a
  UNION ALL
  SELECT symbol, date, CAST(CAST(close + 1 AS DECIMAL(10,4)) AS DOUBLE), 22
    FROM ({ORDER_BARS}) b)
"""
SQL["append_two_runs"] = _RUNS + "SELECT symbol, date, close, CAST(load_hour AS INTEGER) AS load_hour FROM raw"
SQL["dedupe_mixed_batches"] = _RUNS + """
SELECT symbol, date, close, 'BATCH_20200101_210005_00000000' AS batch_id FROM raw
 WHERE load_hour = 22"""
SQL["dedupe_same_batch"] = on(ORDER_BARS, """
SELECT symbol, date, CAST(CAST(close - 1 AS DECIMAL(10,4)) AS DOUBLE) AS close FROM bars""")
SQL["daily_ingest"] = on(WALK_BARS, """, kept AS (
  SELECT * FROM bars QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) <= 30),
n AS (SELECT (SELECT count(*) FROM kept) AS good, (SELECT count(DISTINCT symbol) FROM bars) AS lost)
SELECT 'daily_bars' AS pipeline_name, 'BATCH_20240102_210000_daily' AS batch_id, 'PRIMARY' AS data_source,
       good AS rows_processed, CASE WHEN lost = 0 THEN 'SUCCESS' ELSE 'PARTIAL' END AS status,
       'Inserted: ' || good || ', Errors: ' || lost || ', Verified: ' || good AS details FROM n""")

SQL["parse_variant"] = SQL["parse_daily"]

# the bars, their number, that of their symbols and of their (symbol, month) replies
_REPLY_COUNTS = on(WALK_BARS, """, c AS (
  SELECT count(*) AS n, count(DISTINCT symbol) AS s, count(DISTINCT symbol || strftime(date, '%Y-%m')) AS m FROM bars)
""")
SQL["reply_outcomes"] = _REPLY_COUNTS + """
SELECT 'day' AS kind, 'OK' AS outcome, n, 0 AS n_prices FROM c
UNION ALL SELECT 'quote', 'OK', s, s FROM c
UNION ALL SELECT 'lost', 'BAD_JSON', m, 0 FROM c
UNION ALL SELECT 'lost', 'NO_SERIES', s, 0 FROM c
UNION ALL SELECT 'lost', 'EMPTY_SERIES', s, 0 FROM c"""
SQL["ingest_accounting"] = _REPLY_COUNTS + """, k AS (
  SELECT count(*) AS kept FROM (SELECT * FROM bars
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) <= 30) t)
SELECT 'BATCH_20240102_210000_account' AS batch_id, 2 * n + m + 2 * s + 4 * s AS landed, kept AS stored,
       n AS repeated, n - kept AS older, m + 2 * s + 4 * s AS rejected, m + 2 * s AS lost_replies,
       kept AS verified, 'PARTIAL' AS status FROM c, k"""

_BATCH_A = on(ORDER_BARS, """SELECT symbol, date, CAST(close AS DOUBLE) AS close, volume, 'BATCH_A' AS batch_id
  FROM bars""")
SQL["backup_sink"] = SQL["table_lifecycle"] = SQL["read_through_source"] = _BATCH_A
SQL["string_dates"] = on_enriched("SELECT symbole, date_trading, prix_fermeture FROM enriched")
SQL["computation_time"] = on_enriched("SELECT '2024-01-02 21:00:00' AS horodatage, count(*) AS n FROM enriched")
SQL["emptiness"] = on(SO, """, y AS (SELECT max(year(date_trading)) AS last FROM bars)
SELECT symbole, CAST(y.last + k AS INTEGER) AS annee,
       count(*) FILTER (WHERE year(date_trading) = y.last + k) = 0 AS vide
  FROM bars, y, (VALUES (0), (1)) t(k) GROUP BY symbole, y.last, k""")

SQL["enriched_scan"] = on_enriched(f"SELECT {ENRICHED_DATA_COLUMNS} FROM enriched")

_PROFILE_COLS = ["symbol", "date", "open", "high", "low", "close", "volume"]
SQL["table_profile"] = on(ORDER_BARS, "\nUNION ALL\n".join(
    f"""SELECT {i} AS position, '{c}' AS column_name, count(*) AS n_rows,
       count(*) - count({c}) AS n_nulls, CAST(min({c}) AS VARCHAR) AS min_value,
       CAST(max({c}) AS VARCHAR) AS max_value FROM bars"""
    for i, c in enumerate(_PROFILE_COLS)))

# -- P ----------------------------------------------------------------------------------
SQL["lowercase_columns"] = SOD
SQL["filter_symbol"] = on(SOD, "SELECT * FROM bars WHERE symbole = 'BUILDING'")
SQL["filter_date_range"] = on(SOD, """SELECT * FROM bars
 WHERE date_trading BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'""")
SQL["trailing_days"] = on(SOD, """SELECT * FROM bars
 WHERE date_trading > (SELECT max(date_trading) FROM bars) - 365""")
SQL["trailing_months"] = on(SOD, """SELECT * FROM bars
 WHERE date_trading >= (SELECT max(date_trading) FROM bars) - INTERVAL 6 MONTH""")
SQL["filter_symbols_in"] = on(SOD, "SELECT * FROM bars WHERE symbole IN ('BUILDING', 'MACHINERY')")
SQL["distinct_symbols"] = on(SOD, "SELECT DISTINCT symbole FROM bars WHERE symbole IS NOT NULL")
SQL["order_symbol_date"] = on(SOD, "SELECT * FROM bars ORDER BY symbole, date_trading")
SQL["last_n_rows"] = on(SOD, """SELECT * FROM bars
QUALIFY row_number() OVER (PARTITION BY symbole ORDER BY date_trading DESC) <= 20""")
SQL["last_row"] = on(SOD, """SELECT * FROM bars
QUALIFY row_number() OVER (PARTITION BY symbole ORDER BY date_trading DESC) = 1""")
SQL["first_k"] = on(SOD, "SELECT * FROM bars ORDER BY symbole, date_trading LIMIT 5")

# -- G ----------------------------------------------------------------------------------
SQL["table_stats"] = on(SO, """SELECT count(*) AS n_rows, count(DISTINCT symbole) AS n_symbols,
       min(date_trading) AS first_date, max(date_trading) AS last_date FROM bars""")

PERIOD = {
    "month": "strftime(date_trading, '%Y-%m')",
    "quarter": "CAST(year(date_trading) AS VARCHAR) || 'Q' || CAST(quarter(date_trading) AS VARCHAR)",
    "half": "CAST(year(date_trading) AS VARCHAR) || '-S' || CAST((month(date_trading) - 1) // 6 + 1 AS VARCHAR)",
    "year": "CAST(year(date_trading) AS VARCHAR)",
}
SQL["period_keys"] = on(SO, "SELECT symbole, date_trading, " + ", ".join(
    f"{expr} AS periode_{g}" for g, expr in PERIOD.items()) + " FROM bars")

for _g, _expr in PERIOD.items():
    SQL[f"perf_price_{_g}"] = on(SO, f"""
SELECT symbole, {_expr} AS periode,
       {round_half_even_mean('sum(prix_fermeture)', 'count(prix_fermeture)')} AS prix_fermeture,
       CAST(round_even(max(prix_haut), 2) AS DOUBLE) AS prix_haut,
       CAST(round_even(min(prix_bas), 2) AS DOUBLE) AS prix_bas
  FROM bars WHERE symbole IS NOT NULL GROUP BY 1, 2""")

_VOL = """CASE WHEN count(prix_fermeture) > 1 THEN
       sqrt(CAST(CAST(count(prix_fermeture) AS DECIMAL(8,0))
                 * CAST(sum(prix_fermeture * prix_fermeture) AS DECIMAL(28,8))
                 - CAST(sum(prix_fermeture) AS DECIMAL(19,4)) * CAST(sum(prix_fermeture) AS DECIMAL(19,4))
                 AS DOUBLE))
       / sqrt(CAST(count(prix_fermeture) * (count(prix_fermeture) - 1) AS DOUBLE)) END
     / nullif(CAST(sum(prix_fermeture) AS DOUBLE) / count(prix_fermeture), 0) * 100"""
_PLAIN = {"perf_volume": "month", "perf_buy_signals": "quarter", "perf_volatility": "month"}


def _grain(metric: str, g: str) -> str:
    return metric if _PLAIN[metric] == g else f"{metric}_{g}"


for _g, _expr in PERIOD.items():
    SQL[_grain("perf_volume", _g)] = on(SO, f"""
SELECT symbole, {_expr} AS periode, CAST(coalesce(sum(volume), 0) AS BIGINT) AS volume
  FROM bars WHERE symbole IS NOT NULL GROUP BY 1, 2""")
    SQL[_grain("perf_volatility", _g)] = on(SO, f"""
SELECT symbole, {_expr} AS periode, {_VOL} AS volatilite_pourcent
  FROM bars WHERE symbole IS NOT NULL GROUP BY 1, 2""")
    SQL[_grain("perf_buy_signals", _g)] = on_enriched(f"""
SELECT symbole, {_expr} AS periode,
       count(*) FILTER (WHERE signal_trading = 'SIGNAL_ACHAT') AS signaux_achat
  FROM enriched WHERE symbole IS NOT NULL GROUP BY 1, 2""")
SQL["perf_volatility_symbols"] = on(SO, f"""
SELECT symbole, {PERIOD['year']} AS periode, {_VOL} AS volatilite_pourcent
  FROM bars WHERE symbole IN ('AUTOMOBILE', 'HOUSEHOLD') GROUP BY 1, 2""")

SQL["signal_counts"] = on_enriched("""
SELECT symbole, signal_trading, count(*) AS n FROM enriched
 WHERE signal_trading IS NOT NULL GROUP BY 1, 2""")

_SHARE = """count(*) FILTER (WHERE signal_trading IN ('SIGNAL_ACHAT', 'POTENTIEL_ACHAT_BB')) AS signaux_achat,
       count(*) FILTER (WHERE signal_trading IN ('SIGNAL_VENTE', 'POTENTIEL_VENTE_BB')) AS signaux_vente,
       CAST(count(*) FILTER (WHERE signal_trading IN ('SIGNAL_ACHAT', 'POTENTIEL_ACHAT_BB')) AS DOUBLE) * 100
         / CAST(greatest(count(signal_trading), 1) AS DOUBLE) AS pct_achat,
       CAST(count(*) FILTER (WHERE signal_trading IN ('SIGNAL_VENTE', 'POTENTIEL_VENTE_BB')) AS DOUBLE) * 100
         / CAST(greatest(count(signal_trading), 1) AS DOUBLE) AS pct_vente"""
SQL["signal_share"] = on_enriched(f"SELECT symbole, {_SHARE} FROM enriched GROUP BY symbole")

SQL["pivot_close"] = on(SO, "SELECT date_trading, " + ", ".join(
    f"CAST(sum(prix_fermeture) FILTER (WHERE symbole = '{s}') AS DOUBLE)"
    f" / count(prix_fermeture) FILTER (WHERE symbole = '{s}') AS {s}"
    for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"))
    + f" FROM bars WHERE symbole IN {SEG} GROUP BY date_trading")

SQL["corr_matrix"] = on(SW, """
, daily AS (SELECT symbole, date_trading, CAST(sum(prix_fermeture) AS DOUBLE) / count(prix_fermeture) AS x
              FROM bars WHERE symbole IS NOT NULL AND prix_fermeture IS NOT NULL GROUP BY 1, 2)
SELECT a.symbole AS symbole_a, b.symbole AS symbole_b,
       (round(covar_samp(a.x, b.x) / nullif(stddev_samp(a.x) * stddev_samp(b.x), 0), 2) + CAST(0 AS DOUBLE)) AS correlation
  FROM daily a JOIN daily b ON a.date_trading = b.date_trading
 GROUP BY 1, 2""")

BRAND_BARS = """SELECT symbol, date, CAST(close AS DECIMAL(10,4)) AS close
  FROM (SELECT p.p_brand AS symbol, CAST(l.l_shipdate AS DATE) AS date,
               arg_max(l.l_extendedprice / l.l_quantity,
                       (l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice)) AS close
          FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1, 2) t"""
# centred closes keep the sums small; pairs that do not move on common dates give NULL
SQL["corr_matrix_brands"] = f"""WITH bars AS ({BRAND_BARS}),
daily AS (SELECT symbol, date, CAST(close AS DOUBLE)
                 - avg(CAST(close AS DOUBLE)) OVER (PARTITION BY symbol) AS x
            FROM bars WHERE symbol IS NOT NULL AND close IS NOT NULL)
SELECT a.symbol AS symbole_a, b.symbol AS symbole_b,
       CASE WHEN count(*) >= 2 AND max(a.x) > min(a.x) AND max(b.x) > min(b.x)
            THEN round_even(least(1, greatest(-1, covar_samp(a.x, b.x)
                 / (stddev_samp(a.x) * stddev_samp(b.x)))), 6) + CAST(0 AS DOUBLE) END AS correlation
  FROM daily a JOIN daily b ON a.date = b.date GROUP BY 1, 2"""

SQL["corr_window"] = f"""WITH bars AS ({BRAND_BARS}),
days AS (SELECT date, row_number() OVER (ORDER BY date DESC) AS k FROM (SELECT DISTINCT date FROM bars) d),
e AS (SELECT min(date) AS last FROM days WHERE k <= 41 AND k <= 300),
daily AS (SELECT symbol, date, CAST(close AS DOUBLE)
                 - avg(CAST(close AS DOUBLE)) OVER (PARTITION BY symbol) AS x
            FROM bars, e WHERE symbol IS NOT NULL AND close IS NOT NULL AND date BETWEEN e.last - 730 AND e.last)
SELECT a.symbol AS symbole_a, b.symbol AS symbole_b,
       CASE WHEN count(*) >= 2 AND max(a.x) > min(a.x) AND max(b.x) > min(b.x)
            THEN round_even(least(1, greatest(-1, covar_samp(a.x, b.x)
                 / (stddev_samp(a.x) * stddev_samp(b.x)))), 6) + CAST(0 AS DOUBLE) END AS correlation
  FROM daily a JOIN daily b ON a.date = b.date GROUP BY 1, 2"""

# -- I ----------------------------------------------------------------------------------
SQL["sma"] = on_enriched("""
SELECT symbole, date_trading, moyenne_mobile_20j AS sma_20, moyenne_mobile_50j AS sma_50,
       moyenne_mobile_200j AS sma_200 FROM enriched""")
SQL["rsi_14"] = on_enriched("SELECT symbole, date_trading, rsi_14 FROM enriched")
SQL["rsi_level"] = on_enriched("SELECT symbole, date_trading, rsi_14, niveau_rsi FROM enriched")
SQL["macd"] = on_enriched("SELECT symbole, date_trading, macd_line, macd_signal FROM enriched")
SQL["macd_histogram"] = on_enriched("""
SELECT symbole, date_trading, macd_line, macd_signal,
       (round(macd_line - macd_signal, 4) + CAST(0 AS DOUBLE)) AS macd_histogram,
       coalesce(round(macd_line - macd_signal, 4) >= 0, false) AS histogram_positive
  FROM enriched""")
SQL["macd_direction"] = on_enriched("""
SELECT symbole, date_trading, macd_line, macd_signal,
       CASE WHEN coalesce(macd_line > macd_signal, false) THEN 'HAUSSE' ELSE 'BAISSE' END
           AS macd_direction,
       (round(macd_line - macd_signal, 4) + CAST(0 AS DOUBLE)) AS macd_gap
  FROM enriched""")
SQL["bollinger"] = on_enriched("""
SELECT symbole, date_trading, bollinger_middle, bollinger_upper, bollinger_lower FROM enriched""")
SQL["bollinger_percent"] = on_enriched(
    "SELECT symbole, date_trading, bollinger_percent FROM enriched")
SQL["trend"] = on_enriched("SELECT symbole, date_trading, tendance_globale FROM enriched")
SQL["trading_signal"] = on_enriched("SELECT symbole, date_trading, signal_trading FROM enriched")


def _d(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"

def _ema_sql(span: int, x: str = "CAST(prix_fermeture AS DOUBLE)") -> str:
    a, q = _d(2.0 / (span + 1)), _d(1.0 - 2.0 / (span + 1))
    return f"""WITH RECURSIVE
b AS (SELECT symbole, date_trading, {x} AS x,
             row_number() OVER (PARTITION BY symbole ORDER BY date_trading) - 1 AS i
        FROM ({SW}) s WHERE prix_fermeture IS NOT NULL),
r(symbole, i, e) AS (
    SELECT symbole, i, x FROM b WHERE i = 0
    UNION ALL
    SELECT b.symbole, b.i, {a} * b.x + {q} * r.e
      FROM r JOIN b ON b.symbole = r.symbole AND b.i = r.i + 1)
SELECT b.symbole, b.date_trading, round(r.e, 4) AS ema_{span}
  FROM b JOIN r ON b.symbole = r.symbole AND b.i = r.i"""


def _wilder_sql(n: int) -> str:
    a, q = _d(1.0 / n), _d(1.0 - 1.0 / n)
    return f"""WITH RECURSIVE
b0 AS (SELECT symbole, date_trading, prix_fermeture AS c,
              row_number() OVER (PARTITION BY symbole ORDER BY date_trading) - 1 AS i
         FROM ({SW}) s WHERE prix_fermeture IS NOT NULL),
b AS (SELECT b0.*, c - lag(c) OVER (PARTITION BY symbole ORDER BY i) AS delta FROM b0),
gl AS (SELECT symbole, date_trading, i,
              CAST(CASE WHEN delta > 0 THEN delta ELSE 0 END AS DOUBLE) AS gain,
              CAST(CASE WHEN delta < 0 THEN -delta ELSE 0 END AS DOUBLE) AS loss
         FROM b WHERE i >= 1),
r(symbole, i, g, l) AS (
    SELECT symbole, i, gain, loss FROM gl WHERE i = 1
    UNION ALL
    SELECT gl.symbole, gl.i, {a} * gl.gain + {q} * r.g, {a} * gl.loss + {q} * r.l
      FROM r JOIN gl ON gl.symbole = r.symbole AND gl.i = r.i + 1)
SELECT b0.symbole, b0.date_trading,
       CASE WHEN b0.i >= {n} THEN round(CASE WHEN r.g + r.l = 0 THEN CAST(50 AS DOUBLE)
            ELSE CAST(100 AS DOUBLE) * r.g / (r.g + r.l) END, 4) END AS rsi_{n}
  FROM b0 LEFT JOIN r ON b0.symbole = r.symbole AND b0.i = r.i"""


SQL["ema_12"], SQL["ema_3"] = _ema_sql(12), _ema_sql(3, "CAST(prix_fermeture AS DOUBLE) / 3")
SQL["rsi_14_wilder"], SQL["rsi_3_wilder"] = _wilder_sql(14), _wilder_sql(3)

_F, _S, _N = (2.0 / (span + 1) for span in (6, 13, 5))
SQL["macd_6_13_5"] = f"""WITH RECURSIVE
b AS (SELECT symbole, date_trading, CAST(prix_fermeture AS DOUBLE) AS x,
             row_number() OVER (PARTITION BY symbole ORDER BY date_trading) - 1 AS i
        FROM ({SW}) s WHERE prix_fermeture IS NOT NULL),
r(symbole, i, f, s, g) AS (
    SELECT symbole, i, x, x, CAST(0 AS DOUBLE) FROM b WHERE i = 0
    UNION ALL
    SELECT b.symbole, b.i, {_d(_F)} * b.x + {_d(1 - _F)} * r.f, {_d(_S)} * b.x + {_d(1 - _S)} * r.s,
           {_d(_N)} * (({_d(_F)} * b.x + {_d(1 - _F)} * r.f) - ({_d(_S)} * b.x + {_d(1 - _S)} * r.s))
           + {_d(1 - _N)} * r.g
      FROM r JOIN b ON b.symbole = r.symbole AND b.i = r.i + 1)
SELECT b.symbole, b.date_trading,
       CASE WHEN b.i >= 12 THEN round(r.f - r.s, 4) + CAST(0 AS DOUBLE) END AS macd_line,
       CASE WHEN b.i >= 16 THEN round(r.g, 4) + CAST(0 AS DOUBLE) END AS macd_signal
  FROM b JOIN r ON b.symbole = r.symbole AND b.i = r.i"""

SQL["sma_with_gaps"] = f"""
SELECT symbole, date_trading,
       CASE WHEN count(*) OVER w = 20 THEN CAST(sum(prix_fermeture) OVER w AS DOUBLE) / 20 END AS sma_20
  FROM ({SW}) s WHERE day(date_trading) % 7 <> 0 AND prix_fermeture IS NOT NULL
WINDOW w AS (PARTITION BY symbole ORDER BY date_trading ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"""

SQL["bollinger_double"] = f"""WITH b AS (
  SELECT symbole, date_trading, floor(CAST(prix_fermeture AS DOUBLE) / 100) * 100 AS c FROM ({SW}) s),
w AS (SELECT b.*, count(*) OVER win AS n, avg(c) OVER win AS m, stddev_pop(c) OVER win AS sd FROM b
      WINDOW win AS (PARTITION BY symbole ORDER BY date_trading ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
o AS (SELECT *, CASE WHEN n = 20 THEN m END AS mid, CASE WHEN n = 20 THEN m + 2 * sd END AS up,
             CASE WHEN n = 20 THEN m - 2 * sd END AS low FROM w)
SELECT symbole, date_trading, round(mid, 6) AS bollinger_middle, round(up, 6) AS bollinger_upper,
       round(low, 6) AS bollinger_lower,
       round((c - low) / nullif(up - low, 0), 6) + CAST(0 AS DOUBLE) AS bollinger_percent FROM o"""

SQL["enrich_duplicates"] = SQL["refresh_increment"] = SQL["refresh_late_day"] = SQL["enrich"]
SQL["streamed_macd"] = f"""SELECT m.symbole, m.date_trading, m.macd_line, m.macd_signal, w.rsi_14
  FROM ({SQL["macd"]}) m JOIN ({SQL["rsi_14_wilder"]}) w ON m.symbole = w.symbole AND m.date_trading = w.date_trading"""



def _cents(c: str, wide: str = "DECIMAL(10,4)") -> str:
    return f"CAST(CAST(floor({c} * 100) AS DECIMAL(12,0)) * CAST(0.01 AS DECIMAL(3,2)) AS {wide}) AS {c}"


CENT_BRAND_BARS = f"""SELECT symbol, date, {_cents('open')}, {_cents('high')}, {_cents('low')},
       {_cents('close', 'DECIMAL(19,4)')}, volume
  FROM (SELECT p_brand AS symbol, CAST(l_shipdate AS DATE) AS date, arg_min(x, k) AS open, max(x) AS high,
               min(x) AS low, arg_max(x, k) AS close, CAST(sum(l_quantity) AS BIGINT) AS volume
          FROM (SELECT p.p_brand, l.l_shipdate, l.l_quantity, l.l_extendedprice / l.l_quantity AS x,
                       (l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice) AS k
                  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey) y GROUP BY 1, 2) t"""
SQL["brand_enrich"] = on_enriched(f"SELECT {ENRICHED_DATA_COLUMNS} FROM enriched", CENT_BRAND_BARS)

# -- F ----------------------------------------------------------------------------------
SQL["date_scalars"] = """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS jour,
       strftime(o_orderdate, '%Y-%m') AS mois,
       strftime(o_orderdate, '%Y-%m-%d') AS jour_texte,
       strftime(o_orderdate, '%Y%m%d_%H%M') AS horodatage_lot,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS horodatage_affiche,
       CAST(year(o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS trimestre,
       CAST(year(o_orderdate) AS VARCHAR) || '-S' || CAST((month(o_orderdate) - 1) // 6 + 1 AS VARCHAR)
           AS semestre,
       CAST(year(o_orderdate) AS INTEGER) AS annee,
       CAST(month(o_orderdate) AS INTEGER) AS mois_num,
       CAST(o_orderdate AS DATE) - 30 AS moins_30j
  FROM orders"""

SQL["number_string_scalars"] = on(SO, """
SELECT symbole, date_trading,
       CAST(round_even(prix_fermeture, 2) AS DOUBLE) AS prix_arrondi,
       TRY_CAST(CAST(prix_fermeture AS VARCHAR) AS DOUBLE) AS prix_relu,
       substring(symbole, 1, 8) || '...' AS symbole_masque,
       printf('%.2f', CAST(round_even(prix_fermeture, 2) AS DOUBLE)) AS prix_texte,
       printf('%+.4f', CAST(prix_fermeture - prix_ouverture AS DOUBLE)) AS ecart_texte,
       printf('%.1f%%', CAST(round_even(prix_fermeture * CAST(0.01 AS DECIMAL(3,2)), 1) AS DOUBLE))
           AS pct_texte,
       format('{:,}', volume) AS volume_texte
  FROM bars""")

# -- V ----------------------------------------------------------------------------------
_LATEST_DATE = "(SELECT max(date_trading) FROM enriched)"
SQL["view_candlestick"] = on_enriched(f"""
SELECT symbole, date_trading, prix_ouverture, prix_haut, prix_bas, prix_fermeture,
       bollinger_upper, bollinger_middle, bollinger_lower
  FROM enriched WHERE date_trading > {_LATEST_DATE} - 365""")
SQL["view_candlestick_table"] = on_enriched("""
SELECT symbole, date_trading, prix_ouverture, prix_haut, prix_bas, prix_fermeture,
       bollinger_upper, bollinger_middle, bollinger_lower
  FROM enriched QUALIFY row_number() OVER (PARTITION BY symbole ORDER BY date_trading DESC) <= 20""")
SQL["view_rsi"] = on_enriched(f"""
SELECT symbole, date_trading, rsi_14, 70 AS limite_haute, 30 AS limite_basse
  FROM enriched WHERE date_trading > {_LATEST_DATE} - 180""")
SQL["view_candlestick_range"] = on_enriched("""
SELECT symbole, date_trading, prix_ouverture, prix_haut, prix_bas, prix_fermeture,
       bollinger_upper, bollinger_middle, bollinger_lower
  FROM enriched WHERE date_trading BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'""")
SQL["view_rsi_preset"] = on_enriched(f"""
SELECT symbole, date_trading, rsi_14, 70 AS limite_haute, 30 AS limite_basse
  FROM enriched WHERE date_trading > {_LATEST_DATE} - 90""")
SQL["view_rsi_latest"] = on_enriched("""
SELECT symbole, date_trading, rsi_14, niveau_rsi FROM enriched
QUALIFY row_number() OVER (PARTITION BY symbole ORDER BY date_trading DESC) = 1""")
SQL["view_macd"] = on_enriched(f"""
SELECT symbole, date_trading, macd_line, macd_signal,
       (round(macd_line - macd_signal, 4) + CAST(0 AS DOUBLE)) AS macd_histogram,
       coalesce(round(macd_line - macd_signal, 4) >= 0, false) AS histogram_positive
  FROM enriched WHERE date_trading > {_LATEST_DATE} - 90""")
SQL["view_macd_latest"] = on_enriched("""
SELECT symbole, date_trading, macd_line, macd_signal,
       CASE WHEN coalesce(macd_line > macd_signal, false) THEN 'HAUSSE' ELSE 'BAISSE' END
           AS macd_direction,
       (round(macd_line - macd_signal, 4) + CAST(0 AS DOUBLE)) AS macd_gap
  FROM enriched
QUALIFY row_number() OVER (PARTITION BY symbole ORDER BY date_trading DESC) = 1""")
SQL["view_signal_board"] = on_enriched(f"""
SELECT symbole, {_SHARE},
       max_by(tendance_globale, date_trading) AS tendance_actuelle,
       max_by(signal_trading, date_trading) AS dernier_signal
  FROM enriched GROUP BY symbole""")
SQL["view_signal_table"] = on_enriched("""
SELECT symbole, date_trading, prix_fermeture, rsi_14, macd_line, niveau_rsi, signal_trading,
       tendance_globale
  FROM enriched QUALIFY row_number() OVER (PARTITION BY symbole ORDER BY date_trading DESC) <= 10""")
SQL["view_sidebar"] = on_enriched("""
SELECT count(*) AS n_rows, count(DISTINCT symbole) AS n_symbols,
       min(date_trading) AS first_date, max(date_trading) AS last_date FROM enriched""")
