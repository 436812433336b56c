import datetime as dt
from decimal import Decimal

from pyspark.sql import types as T

BAR_SCHEMA = T.StructType([
    T.StructField("symbole", T.StringType()),
    T.StructField("date_trading", T.DateType()),
    T.StructField("prix_ouverture", T.DecimalType(10, 4)),
    T.StructField("prix_haut", T.DecimalType(10, 4)),
    T.StructField("prix_bas", T.DecimalType(10, 4)),
    T.StructField("prix_fermeture", T.DecimalType(10, 4)),
    T.StructField("volume", T.LongType()),
])

RAW_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("open", T.DecimalType(10, 4)),
    T.StructField("high", T.DecimalType(10, 4)),
    T.StructField("low", T.DecimalType(10, 4)),
    T.StructField("close", T.DecimalType(10, 4)),
    T.StructField("volume", T.LongType()),
])

START = dt.date(2024, 1, 1)


def bars(spark, closes, symbol="S", start=START, raw=False):
    """One bar per calendar day from ``start`` with the given closes."""
    rows = []
    for i, c in enumerate(closes):
        d = start + dt.timedelta(days=i)
        v = None if c is None else Decimal(str(c)).quantize(Decimal("0.0001"))
        rows.append((symbol, d, v, v, v, v, 100))
    return spark.createDataFrame(rows, RAW_SCHEMA if raw else BAR_SCHEMA)


def by_date(df, col):
    return [r[col] for r in df.orderBy("date_trading").collect()]
