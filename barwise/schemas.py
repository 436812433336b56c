"""Table schemas, column names and the fixed label values.

Column names of the enriched table and every label below are a contract
with the dashboards that read the table; they are fixed values and must not
change.
"""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = T.DecimalType(10, 4)

# --- fixed values: enriched-table column names, in table order -------------
ENRICHED_COLUMNS = [
    "symbole", "date_trading", "prix_ouverture", "prix_haut", "prix_bas",
    "prix_fermeture", "volume", "moyenne_mobile_20j", "moyenne_mobile_50j",
    "moyenne_mobile_200j", "rsi_14", "macd_line", "macd_signal",
    "bollinger_middle", "bollinger_upper", "bollinger_lower",
    "bollinger_percent", "tendance_globale", "niveau_rsi", "signal_trading",
    "horodatage_calcul",
]

# raw bar name -> served (enriched) name
RAW_TO_SERVED = {
    "symbol": "symbole",
    "date": "date_trading",
    "open": "prix_ouverture",
    "high": "prix_haut",
    "low": "prix_bas",
    "close": "prix_fermeture",
    "volume": "volume",
}

# --- fixed values: labels ---------------------------------------------------
SIGNAL_BUY = "SIGNAL_ACHAT"
SIGNAL_SELL = "SIGNAL_VENTE"
SIGNAL_BB_BUY = "POTENTIEL_ACHAT_BB"
SIGNAL_BB_SELL = "POTENTIEL_VENTE_BB"
NEUTRAL = "NEUTRE"
RSI_OVERBOUGHT = "SURACHAT"
RSI_OVERSOLD = "SURVENTE"
TREND_UP = "HAUSSIERE"
TREND_DOWN = "BAISSIERE"
TREND_UNKNOWN = "INDETERMINE"
MACD_UP = "HAUSSE"
MACD_DOWN = "BAISSE"
RSI_HIGH = 70
RSI_LOW = 30

# --- fixed values: daily reply format ---------------------------------------
REPLY_SERIES_KEY = "Time Series (Daily)"
REPLY_OPEN = "1. open"
REPLY_HIGH = "2. high"
REPLY_LOW = "3. low"
REPLY_CLOSE = "4. close"
REPLY_VOLUME = "5. volume"
QUOTE_KEY = "Global Quote"
QUOTE_PRICE = "05. price"
BATCH_PREFIX = "BATCH_"
FALLBACK_SOURCE = "FALLBACK"

# --- schemas -----------------------------------------------------------------
RAW_BARS = T.StructType([
    T.StructField("symbol", T.StringType(), False),
    T.StructField("date", T.DateType(), False),
    T.StructField("open", PRICE),
    T.StructField("high", PRICE),
    T.StructField("low", PRICE),
    T.StructField("close", PRICE),
    T.StructField("volume", T.LongType()),
    T.StructField("dividends", PRICE),
    T.StructField("stock_splits", PRICE),
    T.StructField("batch_id", T.StringType()),
    T.StructField("data_source", T.StringType()),
    T.StructField("api_key_used", T.StringType()),
    T.StructField("load_timestamp", T.TimestampType()),
])

# string-length limits of the raw table (VARCHAR sizes)
RAW_STRING_LIMITS = {"symbol": 10, "batch_id": 50, "data_source": 50,
                     "api_key_used": 20}

RUN_LOG = T.StructType([
    T.StructField("pipeline_name", T.StringType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("data_source", T.StringType()),
    T.StructField("rows_processed", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("details", T.StringType()),
    T.StructField("logged_at", T.TimestampType()),
])

ENRICHED = T.StructType(
    [T.StructField("symbole", T.StringType()),
     T.StructField("date_trading", T.DateType())]
    + [T.StructField(c, T.DoubleType()) for c in
       ("prix_ouverture", "prix_haut", "prix_bas", "prix_fermeture")]
    + [T.StructField("volume", T.LongType())]
    + [T.StructField(c, T.DoubleType()) for c in ENRICHED_COLUMNS[7:17]]
    + [T.StructField(c, T.StringType()) for c in ENRICHED_COLUMNS[17:20]]
    + [T.StructField("horodatage_calcul", T.TimestampType())]
)

# Reply bodies as landed: one row per symbol.
REPLIES = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("body", T.StringType()),
])
