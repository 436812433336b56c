"""Ingest operators: landed replies to clean raw bars.

The fetch itself (HTTP, rate limits) is not part of the engine: replies are
landed as files (one JSON body per symbol) and read by Spark. Every step is
a DataFrame transformation; the batch id and timestamp are made once on the
driver and added as literals, so a re-run of a task gives the same rows.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import (BATCH_PREFIX, PRICE, QUOTE_KEY, QUOTE_PRICE, RAW_BARS, RAW_STRING_LIMITS,
                       REPLY_CLOSE, REPLY_HIGH, REPLY_LOW, REPLY_OPEN, REPLY_SERIES_KEY,
                       REPLY_VOLUME)

PRICES = ("open", "high", "low", "close")
# where a row came from, if known: they order copies inside one batch
LANDED_COLUMNS = ("landed_at", "landed_file")

_REPLY = T.StructType([T.StructField(
    REPLY_SERIES_KEY, T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType())))])


def make_batch_id(now: dt.datetime | None = None, suffix: str | None = None) -> str:
    """S3: ``BATCH_yyyyMMdd_HHmmss_<suffix>``, made on the driver.

    The suffix (random unless given) keeps the ids of runs in the same
    second apart: an id names one batch only."""
    now = now or dt.datetime.now(dt.timezone.utc)
    return f"{BATCH_PREFIX}{now.strftime('%Y%m%d_%H%M%S')}_{suffix or uuid.uuid4().hex[:8]}"


def _finite(x: F.Column) -> F.Column:
    return F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)


def parse_daily(df: DataFrame, batch_id: str, source: str) -> DataFrame:
    """Explode landed replies ``(symbol, body)`` into one row per day.

    A reply without the daily series gives no rows (``lost_replies`` lists
    them). Values are parsed with ``try_cast``. ``reject_reason`` is
    ``BAD_DATE`` for a day that is no date, ``BAD_NUMBER`` for a value that is
    present but not a number, ``MISSING_VALUE`` for a field that is not there
    (S6 keeps the other days). Columns of ``LANDED_COLUMNS`` pass through.
    """
    series = F.from_json(F.col("body"), _REPLY).getField(REPLY_SERIES_KEY)
    landed = [c for c in LANDED_COLUMNS if c in df.columns]
    days = df.select("symbol", *landed, F.explode(series).alias("day", "v"))
    fields = {"open": REPLY_OPEN, "high": REPLY_HIGH, "low": REPLY_LOW, "close": REPLY_CLOSE}
    text = {name: F.col("v").getItem(k) for name, k in fields.items()}
    text["volume"] = F.col("v").getItem(REPLY_VOLUME)
    # NaN and infinities are not prices: NULL, so the day is flagged below
    # (NaN would otherwise compare greater than every threshold)
    parsed = {name: _finite(t.try_cast("double")) for name, t in text.items() if name != "volume"}
    parsed["volume"] = text["volume"].try_cast("bigint")
    bad, missing = F.lit(False), F.lit(False)
    for name, t in text.items():
        bad = bad | (t.isNotNull() & parsed[name].isNull())
        missing = missing | t.isNull()
    return days.select(
        "symbol",
        F.col("day").try_cast("date").alias("date"),
        *[parsed[c].alias(c) for c in PRICES],
        parsed["volume"].alias("volume"),
        F.lit(0.0).alias("dividends"),
        F.lit(0.0).alias("stock_splits"),
        F.lit(batch_id).alias("batch_id"),
        F.lit(source).alias("data_source"),
        F.when(F.col("day").try_cast("date").isNull(), F.lit("BAD_DATE"))
         .when(bad, F.lit("BAD_NUMBER"))
         .when(missing, F.lit("MISSING_VALUE")).alias("reject_reason"),
        *landed)


def lost_replies(df: DataFrame, batch_id: str, source: str) -> DataFrame:
    """Replies without the daily series (an error or rate-limit notice), as
    rejected rows ``NO_SERIES`` without a day, so that a run log counts them."""
    series = F.from_json(F.col("body"), _REPLY).getField(REPLY_SERIES_KEY)
    landed = [c for c in LANDED_COLUMNS if c in df.columns]
    return df.where(series.isNull()).select(
        "symbol", F.lit(None).cast("date").alias("date"),
        *[F.lit(None).cast("double").alias(c) for c in PRICES],
        F.lit(None).cast("bigint").alias("volume"),
        F.lit(0.0).alias("dividends"), F.lit(0.0).alias("stock_splits"),
        F.lit(batch_id).alias("batch_id"), F.lit(source).alias("data_source"),
        F.lit("NO_SERIES").alias("reject_reason"), *landed)


def parse_landed(df: DataFrame, batch_id: str, source: str) -> DataFrame:
    """S1, F14 for replies of any kind ``(symbol, body)`` in one parse: one row
    a day, a quote, or a reply that holds neither.

    The body is parsed once, as a variant; fields are taken from it by path.
    ``kind`` is ``day`` (columns as ``parse_daily``), ``quote`` (``price``) or
    ``lost``; ``reject_reason`` of a day is as in ``parse_daily``, of a lost
    reply ``BAD_JSON`` (no body, truncated, no JSON), ``NO_SERIES`` (an error or
    rate-limit notice) or ``EMPTY_SERIES``. Every reply gives a row at least.
    """
    landed = [c for c in LANDED_COLUMNS if c in df.columns]

    def part(column: str, key: str, kind: str) -> F.Column:
        return F.try_variant_get(column, f"$['{key}']", kind)
    whole = df.select("symbol", *landed, F.try_parse_json(F.col("body")).alias("_v"))
    whole = whole.select("symbol", *landed, F.col("_v").isNull().alias("_bad"),
                         part("_v", REPLY_SERIES_KEY, "map<string,variant>").alias("_series"),
                         part("_v", QUOTE_KEY, "map<string,variant>").alias("_quote"))
    days = whole.select("*", F.explode_outer("_series").alias("_day", "_fields"))
    keys = {"open": REPLY_OPEN, "high": REPLY_HIGH, "low": REPLY_LOW, "close": REPLY_CLOSE, "volume": REPLY_VOLUME}
    text = {name: part("_fields", k, "string") for name, k in keys.items()}
    days = days.select("*", *[t.alias(f"_{name}") for name, t in text.items()])
    value = {name: _finite(F.col(f"_{name}").try_cast("double")) for name in PRICES}
    value["volume"] = F.col("_volume").try_cast("bigint")
    bad, missing = F.lit(False), F.lit(False)
    for name in keys:
        bad = bad | (F.col(f"_{name}").isNotNull() & value[name].isNull())
        missing = missing | F.col(f"_{name}").isNull()
    day = F.col("_day").try_cast("date")
    kind = F.when(F.col("_day").isNotNull(), "day").when(
        F.col("_series").isNull() & F.col("_quote").isNotNull(), "quote").otherwise("lost")
    reason = (F.when(kind == "quote", F.lit(None).cast("string"))
              .when(F.col("_bad"), "BAD_JSON").when(F.col("_series").isNull(), "NO_SERIES")
              .when(F.col("_day").isNull(), "EMPTY_SERIES")
              .when(day.isNull(), "BAD_DATE").when(bad, "BAD_NUMBER").when(missing, "MISSING_VALUE"))
    return days.select(
        "symbol", day.alias("date"), *[value[c].alias(c) for c in PRICES], value["volume"].alias("volume"),
        F.lit(0.0).alias("dividends"), F.lit(0.0).alias("stock_splits"),
        F.lit(batch_id).alias("batch_id"), F.lit(source).alias("data_source"),
        reason.alias("reject_reason"), *landed, kind.alias("kind"),
        F.try_variant_get(F.element_at("_quote", F.lit(QUOTE_PRICE)), "$", "string").try_cast("double").alias("price"))


_QUOTE = T.StructType([T.StructField(
    QUOTE_KEY, T.MapType(T.StringType(), T.StringType()))])


def parse_quote(df: DataFrame) -> DataFrame:
    """Latest-price replies ``(symbol, body)`` -> ``(symbol, price)``.

    A reply without the quote object gives no row; a price that is not a
    number gives NULL."""
    quote = F.from_json(F.col("body"), _QUOTE).getField(QUOTE_KEY)
    return (df.select("symbol", quote.alias("_q")).where(F.col("_q").isNotNull())
            .select("symbol", F.col("_q").getItem(QUOTE_PRICE).try_cast("double").alias("price")))


def latest_n(df: DataFrame, n: int = 30, key: str = "symbol", date: str = "date") -> DataFrame:
    """The rows of the ``n`` most recent days of every symbol.

    Days are counted, not rows: a day that is given twice takes one place.
    Rows without a date are no days and are left out (a run rejects them
    first). A per-key top-n: each map task keeps its n newest days per symbol
    before the shuffle."""
    from pyspark.sql import Window
    w = Window.partitionBy(key).orderBy(F.col(date).desc())
    return (df.where(F.col(date).isNotNull()).withColumn("_rn", F.dense_rank().over(w))
            .where(F.col("_rn") <= n).drop("_rn"))


def mask_column(df: DataFrame, col: str, keep: int = 2, out: str | None = None) -> DataFrame:
    """Replace a secret by ``...`` and its last ``keep`` characters
    (``keep=0`` keeps only the marker). NULL stays NULL."""
    c = F.col(col)
    tail = F.substring(c, -keep, keep) if keep > 0 else F.lit("")
    return df.withColumn(out or col, F.when(c.isNotNull(), F.concat(F.lit("..."), tail)))


def stamp_batch(df: DataFrame, batch_id: str, source: str, load_ts: dt.datetime | None = None,
                api_key: str | None = None, keep: int = 2) -> DataFrame:
    """S3: add batch id, data source, masked key and load time as literals."""
    load_ts = load_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    out = (df.withColumn("batch_id", F.lit(batch_id))
           .withColumn("data_source", F.lit(source))
           .withColumn("api_key_used", F.lit(api_key).cast("string"))
           .withColumn("load_timestamp", F.lit(load_ts).cast("timestamp")))
    return mask_column(out, "api_key_used", keep)


def with_fallback(primary: DataFrame, fallback: DataFrame, usable: F.Column | None = None) -> DataFrame:
    """The primary rows, and the fallback rows too when the primary has
    none for which ``usable`` holds (any row at all, if not given).

    One plan: the fallback side is guarded by ``NOT EXISTS(primary)``, an
    uncorrelated subquery that stops at the first primary row.
    """
    some = primary if usable is None else primary.where(usable)
    return primary.unionByName(fallback.where(~some.exists()), allowMissingColumns=True)


def reject_reason() -> F.Column:
    """The first raw-table constraint a row breaks, or NULL."""
    price_bad = None
    for c in PRICES + ("dividends", "stock_splits"):
        # the cast itself decides: it rounds to 4 places first
        cond = F.col(c).isNotNull() & F.col(c).try_cast(PRICE).isNull()
        price_bad = cond if price_bad is None else price_bad | cond
    long_text = None
    for c, limit in RAW_STRING_LIMITS.items():
        cond = F.length(F.col(c)) > limit
        long_text = cond if long_text is None else long_text | cond
    return (F.when(F.col("symbol").isNull(), F.lit("NULL_SYMBOL"))
            .when(F.col("date").isNull(), F.lit("NULL_DATE"))
            .when(F.coalesce(long_text, F.lit(False)), F.lit("TEXT_TOO_LONG"))
            .when(F.coalesce(price_bad, F.lit(False)), F.lit("OUT_OF_RANGE")))


def _with_raw_columns(df: DataFrame) -> DataFrame:
    defaults = {"dividends": F.lit(0.0), "stock_splits": F.lit(0.0),
                "batch_id": F.lit(None).cast("string"),
                "data_source": F.lit(None).cast("string"),
                "api_key_used": F.lit(None).cast("string"),
                "load_timestamp": F.lit(None).cast("timestamp")}
    for c, v in defaults.items():
        if c not in df.columns:
            df = df.withColumn(c, v)
    return df


def tag_rejects(df: DataFrame) -> DataFrame:
    """Add the missing raw columns and ``reject_reason`` (NULL for a good row).

    Constraints come from the raw table: NOT NULL keys, text lengths and
    the decimal(10,4) range; a parse failure from S1 is kept as the reason.
    """
    df = _with_raw_columns(df)
    earlier = F.col("reject_reason") if "reject_reason" in df.columns else F.lit(None)
    return df.withColumn("reject_reason", F.coalesce(earlier.cast("string"), reject_reason()))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows in the raw schema, rejected rows with ``reject_reason``).

    Both outputs are filters of one tagged frame (no action here).
    """
    tagged = tag_rejects(df)
    good = tagged.where(F.col("reject_reason").isNull()).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_BARS.fields])
    rejects = tagged.where(F.col("reject_reason").isNotNull())
    return good, rejects


def dedupe_latest_batch(df: DataFrame, key=("symbol", "date"),
                        order=("load_timestamp", "batch_id", *LANDED_COLUMNS)) -> DataFrame:
    """One row per (symbol, date), from the batch loaded last.

    Copies are ordered by load time, then batch id, then the landed file's
    time and name, then all their values: the winner never depends on the
    order of the input. Columns that are not there are left out, so a frame
    without batches is brought to one row a key as well.

    An aggregate (max_by over a struct), not a window: each map task keeps
    its own latest copy per key before the shuffle, so a key with many
    re-sent copies is cheap.
    """
    others = [c for c in df.columns if c not in key]
    order_cols = [c for c in order if c in df.columns]
    rest = [c for c in others if c not in order_cols]
    latest = F.max_by(F.struct(*others), F.struct(*order_cols, *rest)).alias("_row")
    return df.groupBy(*key).agg(latest).select(*key, "_row.*")
