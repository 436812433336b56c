"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each query reads the driver's tables in ``sf_dir`` (through the bar
builders) and runs one operator or view over all of it. Output columns are
aliased to match the DuckDB twin in ``oracle.SQL``. Decimal prices are
cast to double at the output only, after all exact arithmetic.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import aggregates as G
from ..operators import filters as P
from ..functions import scalars as X
from ..operators import corr_blocks as CB
from ..operators import correlation as C
from ..operators import indicators as I
from ..operators.series import finish_series, prepare_series
from ..sources import bars as B
from ..sources import derived as D
from ..sources import ingest as S
from ..sources import tables as T
from ..schemas import FALLBACK_SOURCE, PRICE, RAW_BARS, RUN_LOG
from ..session import checkpoint_dir, materialize
from . import enrich as E
from . import refresh as R
from . import views as V

QUERIES: dict = {}

RUN_TS = dt.datetime(2024, 1, 2, 21, 0, 0)


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn
    return register


def doubles(df: DataFrame) -> DataFrame:
    """Cast decimal columns to double (output layer only)."""
    return df.select(*[F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c)
                       for c, t in df.dtypes])


def served_orders(spark: SparkSession, sf: str) -> DataFrame:
    return E.to_served(B.order_bars(spark, sf))


def enriched_walk(spark: SparkSession, sf: str) -> DataFrame:
    """The enriched table over walk bars, without the run timestamp."""
    return E.enrich(B.walk_bars(spark, sf), RUN_TS).drop("horodatage_calcul")


_STORED: dict = {}


def _files_of(spark: SparkSession, sf: str) -> tuple:
    """Names, sizes and times of the files that bars are made of."""
    meta = [F.col(f"_metadata.{c}") for c in ("file_path", "file_size", "file_modification_time")]
    return tuple(sorted(tuple(map(str, r)) for name in ("orders", "customer")
                        for r in B.table(spark, sf, name).select(*meta).distinct().collect()))


def stored_path(spark: SparkSession, sf: str) -> str:
    """The stored enriched table (by year) of a data folder: written once per
    application and state of its files, as the daily job does, then read by
    every view."""
    key = (spark.sparkContext.applicationId, sf, _files_of(spark, sf))
    if key not in _STORED:
        path = f"{checkpoint_dir(spark).rstrip('/')}/barwise/enriched-{uuid.uuid4().hex}"
        T.write_enriched(E.enrich(B.walk_bars(spark, sf), RUN_TS), path)
        _STORED[key] = path
    return _STORED[key]


def served(spark: SparkSession, sf: str, days: int | None = None) -> DataFrame:
    """The stored enriched table as views read it."""
    return T.serve_enriched(spark, stored_path(spark, sf), days).drop("horodatage_calcul")


_PANELS: dict = {}


def panels(spark: SparkSession, sf: str) -> DataFrame:
    """The last rows of every symbol, as a refresh over the folder's bars
    keeps them (made once per application and state of the input files)."""
    key = (spark.sparkContext.applicationId, sf, _files_of(spark, sf))
    if key not in _PANELS:
        base = f"{checkpoint_dir(spark).rstrip('/')}/barwise/panels-{uuid.uuid4().hex}"
        T.append_raw(S.split_valid(S.stamp_batch(B.walk_bars(spark, sf), "BATCH_0", "PRIMARY", RUN_TS))[0], f"{base}/raw")
        R.refresh_increment(spark, f"{base}/raw", f"{base}/enriched", f"{base}/state", RUN_TS)
        _PANELS[key] = f"{base}/state"
    return R.read_panels(spark, _PANELS[key]).drop("horodatage_calcul")


# -- G1: the reference's one Spark query -------------------------------------------------
@query("avg_price_volume")
def q_avg_price_volume(spark, sf):
    return G.avg_price_volume(B.order_bars(spark, sf))


# -- I13: the flagship ------------------------------------------------------------------
@query("enrich")
def q_enrich(spark, sf):
    return enriched_walk(spark, sf)


@query("brand_enrich")
def q_brand_enrich(spark, sf):
    """The flagship over the bars of every brand, prices in whole cents."""
    def cents(c: str) -> F.Column:
        return (F.floor(F.col(c) * 100).cast("decimal(12,0)") * F.lit(0.01).cast("decimal(3,2)")).cast(PRICE).alias(c)
    bars = B.brand_bars(spark, sf).select("symbol", "date", *[cents(c) for c in S.PRICES], "volume")
    return E.enrich(bars, RUN_TS).drop("horodatage_calcul")


def refreshed(spark: SparkSession, batches: list[DataFrame]) -> tuple[DataFrame, list[dict]]:
    """The enriched table after landing and refreshing one batch after the
    other, and the runs' counts."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/barwise/refresh-{uuid.uuid4().hex}"
    counts = []
    for i, bars in enumerate(batches):
        loaded = RUN_TS + dt.timedelta(days=i)
        T.append_raw(S.split_valid(S.stamp_batch(bars, f"BATCH_{i}", "PRIMARY", loaded))[0], f"{base}/raw")
        counts.append(R.refresh_increment(spark, f"{base}/raw", f"{base}/enriched", f"{base}/state", loaded))
    return T.serve_enriched(spark, f"{base}/enriched").drop("horodatage_calcul"), counts


def _nth_day(bars: DataFrame, n: int) -> F.Column:
    """The day that ``n`` distinct days follow, or the first one."""
    days = bars.select("date").distinct().orderBy(F.col("date").desc()).limit(n + 1)
    return days.select(F.min("date")).scalar()


@query("refresh_increment")
def q_refresh_increment(spark, sf):
    """Three daily runs: the history, then twice new days with the thirty days
    before them sent again."""
    bars = materialize(B.walk_bars(spark, sf), "refresh_bars")
    cut = [_nth_day(bars, n) for n in (20, 10)]
    again = [_nth_day(bars, n) for n in (50, 40)]
    day = F.col("date")
    return refreshed(spark, [bars.where(day <= cut[0]), bars.where((day > again[0]) & (day <= cut[1])),
                             bars.where(day > again[1])])[0]


@query("refresh_late_day")
def q_refresh_late_day(spark, sf):
    """A run without the day 400 days back, then that day (with an earlier
    close of every second symbol corrected) and a wrong day put right."""
    bars = materialize(B.walk_bars(spark, sf), "late_bars")
    day, late, wrong = F.col("date"), _nth_day(bars, 400), _nth_day(bars, 150)
    first = bars.where(day != late).withColumn(
        "close", F.when(day == wrong, F.col("close") + 3).otherwise(F.col("close")).cast("decimal(10,4)"))
    return refreshed(spark, [first, bars.where((day == late) | (day == wrong))])[0]


def served_walk(spark: SparkSession, sf: str) -> DataFrame:
    return E.to_served(B.walk_bars(spark, sf))


# -- S: sources, sinks, table lifecycle ----------------------------------------------
@query("parse_daily")
def q_parse_daily(spark, sf):
    replies = D.replies_from_bars(B.walk_bars(spark, sf))
    parsed = S.parse_daily(replies, D.SECOND_BATCH, "PRIMARY")
    return parsed.select("symbol", "date", "open", "high", "low", "close", "volume")


@query("parse_quote")
def q_parse_quote(spark, sf):
    return S.parse_quote(D.quotes_from_bars(B.walk_bars(spark, sf)))


@query("range_button_1w")
def q_range_button_1w(spark, sf):
    return doubles(P.range_button(served_orders(spark, sf), "1w"))


@query("streamed_ingest")
def q_streamed_ingest(spark, sf):
    """Land replies (one JSON-lines file set) under the shared checkpoint
    folder, run the incremental ingest once, return the stored raw bars."""
    from ..streaming import ingest_landed
    base = f"{checkpoint_dir(spark).rstrip('/')}/barwise/stream-{uuid.uuid4().hex}"
    D.replies_from_bars(B.walk_bars(spark, sf)).write.json(f"{base}/landing")
    run = ingest_landed(spark, f"{base}/landing", f"{base}/raw", f"{base}/rejects",
                        f"{base}/log", f"{base}/checkpoint")
    run.awaitTermination()
    stored = spark.read.parquet(f"{base}/raw")
    return doubles(stored.select("symbol", "date", "open", "high", "low", "close", "volume"))


def _two_runs(spark, sf):
    """The raw table after two append runs in the same minute."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/barwise/runs-{uuid.uuid4().hex}"
    bars = materialize(B.order_bars(spark, sf), "run_bars")
    for hour, shift in ((21, 0), (22, 1)):
        now = dt.datetime(2020, 1, 1, 21, 0, 5)
        batch = S.stamp_batch(bars.withColumn("close", (F.col("close") + shift).cast("decimal(10,4)")),
                              S.make_batch_id(now), "PRIMARY", dt.datetime(2020, 1, 1, hour))
        T.append_raw(S.split_valid(batch)[0], f"{base}/raw")
    return T.read_or_empty(spark, f"{base}/raw", RAW_BARS)


@query("append_two_runs")
def q_append_two_runs(spark, sf):
    return _two_runs(spark, sf).select("symbol", "date", F.col("close").cast("double").alias("close"),
                                       F.hour("load_timestamp").alias("load_hour"))


@query("dedupe_mixed_batches")
def q_dedupe_mixed_batches(spark, sf):
    """Batch ids of several styles: the load time decides, not the id's text."""
    raw = _two_runs(spark, sf)
    raw = raw.withColumn("batch_id", F.when(F.hour("load_timestamp") == 21, F.lit("BATCH_z_00000007"))
                         .otherwise(F.lit("BATCH_20200101_210005_00000000")))
    return S.dedupe_latest_batch(raw).select("symbol", "date", F.col("close").cast("double").alias("close"),
                                             "batch_id")


@query("dedupe_same_batch")
def q_dedupe_same_batch(spark, sf):
    """Two replies for a day in one batch: the file landed last wins."""
    bars = B.order_bars(spark, sf)
    one = S.stamp_batch(bars, "BATCH_A", "PRIMARY", dt.datetime(2020, 1, 1))
    later = one.withColumn("close", (F.col("close") - 1).cast("decimal(10,4)"))
    both = one.withColumn("landed_file", F.lit("a.json")).unionByName(
        later.withColumn("landed_file", F.lit("b.json")))
    return S.dedupe_latest_batch(both).select("symbol", "date", F.col("close").cast("double").alias("close"))


@query("daily_ingest")
def q_daily_ingest(spark, sf):
    """A complete run over landed replies, a lost one among them: 30 days kept
    of each symbol; the run's log row."""
    from ..streaming import ingest_batch
    base = f"{checkpoint_dir(spark).rstrip('/')}/barwise/daily-{uuid.uuid4().hex}"
    replies = D.replies_from_bars(B.walk_bars(spark, sf))
    lost = replies.select("symbol").distinct().withColumn("body", F.lit('{"Note": "rate limited"}'))
    ingest_batch(replies.unionByName(lost), f"{base}/raw", f"{base}/rejects", f"{base}/log",
                 S.make_batch_id(RUN_TS, "daily"), load_ts=RUN_TS, keep_days=30, api_key="KEY0000001")
    return spark.read.schema(RUN_LOG).parquet(f"{base}/log").drop("logged_at")


@query("latest_30_bars")
def q_latest_30_bars(spark, sf):
    return doubles(S.latest_n(B.order_bars(spark, sf), 30))


@query("mask_column")
def q_mask_column(spark, sf):
    customers = B.table(spark, sf, "customer").select("c_custkey", "c_name")
    return S.mask_column(customers, "c_name", keep=2)


def _tagged(df: DataFrame, tag: str) -> DataFrame:
    return df.select("symbol", "date", F.col("close").cast("double").alias("close"),
                     F.lit(tag).alias("data_source"))


@query("fallback_source")
def q_fallback_source(spark, sf):
    ob = B.order_bars(spark, sf)
    newer = ob.where(F.col("date") > ob.select(F.max("date")).scalar())
    return S.with_fallback(_tagged(newer, "PRIMARY"),
                           _tagged(B.walk_bars(spark, sf), FALLBACK_SOURCE))


@query("fallback_unused")
def q_fallback_unused(spark, sf):
    return S.with_fallback(_tagged(B.order_bars(spark, sf), "PRIMARY"),
                           _tagged(B.walk_bars(spark, sf), FALLBACK_SOURCE))


@query("reject_rows")
def q_reject_rows(spark, sf):
    good, rejects = S.split_valid(D.order_candidates(spark, sf))
    return rejects.select("symbol", "date", "close", "reject_reason")


@query("reject_summary")
def q_reject_summary(spark, sf):
    cands = D.order_candidates(spark, sf)
    tagged = S.tag_rejects(cands)
    return tagged.groupBy(F.coalesce("reject_reason", F.lit("OK")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n"))


@query("batch_verify")
def q_batch_verify(spark, sf):
    return T.verify_batch(D.two_batch_raw(B.order_bars(spark, sf)), D.SECOND_BATCH)


@query("dedupe_latest_batch")
def q_dedupe_latest_batch(spark, sf):
    deduped = S.dedupe_latest_batch(D.two_batch_raw(B.order_bars(spark, sf)))
    return deduped.select("symbol", "date", F.col("close").cast("double").alias("close"),
                          "batch_id")


@query("run_log")
def q_run_log(spark, sf):
    raw = D.two_batch_raw(B.order_bars(spark, sf))
    batch = raw.where(F.col("batch_id") == D.SECOND_BATCH)
    good, rejects = S.split_valid(batch)
    return T.run_log(good, rejects, T.verify_batch(raw, D.SECOND_BATCH), D.SECOND_BATCH)


@query("enriched_scan")
def q_enriched_scan(spark, sf):
    path = stored_path(spark, sf)
    return T.enriched_scan(spark, path).drop("horodatage_calcul")


@query("table_profile")
def q_table_profile(spark, sf):
    return T.table_profile(B.order_bars(spark, sf)).drop("data_type")


@query("parse_variant")
def q_parse_variant(spark, sf):
    """The days of landed replies, each body parsed once as a variant."""
    replies = D.replies_from_bars(B.walk_bars(spark, sf))
    days = S.parse_landed(replies, D.SECOND_BATCH, "PRIMARY").where(F.col("kind") == "day")
    return days.select("symbol", "date", "open", "high", "low", "close", "volume")


@query("reply_outcomes")
def q_reply_outcomes(spark, sf):
    """What became of days, quotes, truncated bodies, notices and empty series."""
    found = S.parse_landed(D.awkward_replies(B.walk_bars(spark, sf)), D.SECOND_BATCH, "PRIMARY")
    return found.groupBy("kind", F.coalesce("reject_reason", F.lit("OK")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n"), F.count("price").alias("n_prices"))


@query("ingest_accounting")
def q_ingest_accounting(spark, sf):
    """A run over replies of which every day comes twice, and bad days, lost
    replies and quotes: every landed row is stored, repeated, older or rejected."""
    from ..streaming import ingest_batch
    base = f"{checkpoint_dir(spark).rstrip('/')}/barwise/account-{uuid.uuid4().hex}"
    bars = materialize(B.walk_bars(spark, sf), "account_bars")
    replies = D.awkward_replies(bars).unionByName(D.replies_from_bars(bars)).unionByName(D.bad_days(bars))
    ingest_batch(replies, f"{base}/raw", f"{base}/rejects", f"{base}/log", S.make_batch_id(RUN_TS, "account"),
                 load_ts=RUN_TS, keep_days=30, accounting_path=f"{base}/accounting")
    log = spark.read.schema(RUN_LOG).parquet(f"{base}/log").select("batch_id", "status")
    return spark.read.parquet(f"{base}/accounting").join(log, "batch_id")


@query("backup_sink")
def q_backup_sink(spark, sf):
    """A batch whose id is stored already fails and is dumped as JSON."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/barwise/backup-{uuid.uuid4().hex}"
    good = S.split_valid(S.stamp_batch(B.order_bars(spark, sf), "BATCH_A", "PRIMARY", RUN_TS))[0]
    T.write_with_backup(good.where("date < '1990-01-01'").unionByName(good.limit(1)), f"{base}/raw", f"{base}/dump")
    try:
        T.write_with_backup(good, f"{base}/raw", f"{base}/dump")
    except ValueError:
        return spark.read.schema(RAW_BARS).json(f"{base}/dump").select(
            "symbol", "date", F.col("close").cast("double").alias("close"), "volume", "batch_id")
    raise RuntimeError("a batch id was stored twice")


@query("table_lifecycle")
def q_table_lifecycle(spark, sf):
    """Create a table, append to it, read it whole, drop it."""
    name = f"barwise_{uuid.uuid4().hex}"
    T.create_table(spark, name, RAW_BARS, f"{checkpoint_dir(spark).rstrip('/')}/barwise/{name}", ["batch_id"])
    good = S.split_valid(S.stamp_batch(B.order_bars(spark, sf), "BATCH_A", "PRIMARY", RUN_TS))[0]
    T.enforce_key(good).write.mode("append").partitionBy("batch_id").saveAsTable(name)
    rows = materialize(T.read_table(spark, name), "lifecycle")
    T.drop_table(spark, name)
    if spark.catalog.tableExists(name):
        raise RuntimeError("the table was not dropped")
    return rows.select("symbol", "date", F.col("close").cast("double").alias("close"), "volume", "batch_id")


@query("read_through_source")
def q_read_through_source(spark, sf):
    """The raw table through the configured source, in two schemas."""
    from ..sources.connector import read_source, write_source
    path = f"{checkpoint_dir(spark).rstrip('/')}/barwise/source-{uuid.uuid4().hex}"
    good = S.split_valid(S.stamp_batch(B.order_bars(spark, sf), "BATCH_A", "PRIMARY", RUN_TS))[0]
    for schema, part in (("FIRST", F.year("date") < 1996), ("SECOND", F.year("date") >= 1996)):
        write_source(good.where(part), T.table_options(spark, "raw_bars", schema) | {"path": path})
    both = [read_source(spark, T.table_options(spark, "raw_bars", schema) | {"path": path}, RAW_BARS)
            for schema in ("FIRST", "SECOND")]
    return both[0].unionByName(both[1]).select("symbol", "date", F.col("close").cast("double").alias("close"),
                                               "volume", "batch_id")


@query("string_dates")
def q_string_dates(spark, sf):
    """Days stored as text come back as dates."""
    text = spark.read.parquet(stored_path(spark, sf)).withColumn("date_trading", F.col("date_trading").cast("string"))
    return T.scan_enriched(text).select("symbole", "date_trading", "prix_fermeture")


@query("emptiness")
def q_emptiness(spark, sf):
    """P10 for each symbol's bars of the latest year and of the year after it."""
    bars = materialize(served_orders(spark, sf), "emptiness")
    last = bars.agg(F.max(F.year("date_trading"))).first()[0]
    rows = [(s, y, P.is_empty(P.filter_symbol(bars, s).where(F.year("date_trading") == y)))
            for (s,) in P.distinct_symbols(bars).collect() for y in (last, last + 1)]
    return spark.createDataFrame(rows, "symbole string, annee int, vide boolean")


@query("computation_time")
def q_computation_time(spark, sf):
    """One time of computation on every row of a run."""
    return T.serve_enriched(spark, stored_path(spark, sf)).groupBy(
        F.date_format("horodatage_calcul", "yyyy-MM-dd HH:mm:ss").alias("horodatage")).agg(
        F.count(F.lit(1)).alias("n"))


@query("table_profile_sketch")
def q_table_profile_sketch(spark, sf):
    """The profile of a table of two batches from their sketches, added one
    after the other; estimates are held against exact ones."""
    from ..sources import profile
    path = f"{checkpoint_dir(spark).rstrip('/')}/barwise/sketch-{uuid.uuid4().hex}"
    raw = materialize(D.two_batch_raw(B.order_bars(spark, sf)).select(
        "symbol", "date", "open", "high", "low", "close", "volume", "batch_id"), "sketched")
    profile.add_sketches(raw.where(F.col("batch_id") == D.FIRST_BATCH), path)
    profile.add_sketches(raw, path)
    columns = [c for c in raw.dtypes if c[0] != "batch_id"]
    found = profile.sketch_profile(spark, path, columns)
    exact = raw.agg(*[F.countDistinct(c).alias(c) for c, _ in columns]).unpivot(
        [], [c for c, _ in columns], "column_name", "exact")
    near = F.abs(F.col("n_distinct") - F.col("exact")) <= 0.05 * F.col("exact") + 1
    return found.join(exact, "column_name").select(
        "position", "column_name", "n_rows", "n_nulls", "min_value", "max_value", near.alias("distinct_within_5pct"))


# -- P: projections, filters, order ---------------------------------------------------
@query("lowercase_columns")
def q_lowercase_columns(spark, sf):
    so = doubles(served_orders(spark, sf))
    return P.lowercase_columns(so.toDF(*[c.upper() for c in so.columns]))


@query("filter_symbol")
def q_filter_symbol(spark, sf):
    return doubles(P.filter_symbol(served_orders(spark, sf), "BUILDING"))


@query("filter_date_range")
def q_filter_date_range(spark, sf):
    return doubles(P.filter_date_range(served_orders(spark, sf), "1996-01-01", "1997-12-31"))


@query("trailing_days")
def q_trailing_days(spark, sf):
    return doubles(P.trailing_days(served_orders(spark, sf), 365))


@query("trailing_months")
def q_trailing_months(spark, sf):
    return doubles(P.trailing_months(served_orders(spark, sf), 6))


@query("filter_symbols_in")
def q_filter_symbols_in(spark, sf):
    return doubles(P.filter_symbols_in(served_orders(spark, sf), ["BUILDING", "MACHINERY"]))


@query("distinct_symbols")
def q_distinct_symbols(spark, sf):
    return P.distinct_symbols(served_orders(spark, sf))


@query("order_symbol_date")
def q_order_symbol_date(spark, sf):
    return doubles(P.order_symbol_date(served_orders(spark, sf)))


@query("last_n_rows")
def q_last_n_rows(spark, sf):
    return doubles(P.last_n_rows(served_orders(spark, sf), 20))


@query("last_row")
def q_last_row(spark, sf):
    return doubles(P.last_row(served_orders(spark, sf)))


@query("first_k")
def q_first_k(spark, sf):
    return doubles(P.first_k(served_orders(spark, sf), ["symbole", "date_trading"], 5))


# -- G: aggregates --------------------------------------------------------------------
@query("table_stats")
def q_table_stats(spark, sf):
    return G.table_stats(served_orders(spark, sf))


@query("period_keys")
def q_period_keys(spark, sf):
    so = served_orders(spark, sf)
    return so.select("symbole", "date_trading",
                     *[G.period_key(g).alias(f"periode_{g}") for g in G.GRAINS])


for _grain in G.GRAINS:
    def _perf(spark, sf, grain=_grain):
        return G.perf_price(served_orders(spark, sf), grain)
    query(f"perf_price_{_grain}")(_perf)


# each metric by each grain; one grain keeps the metric's plain name
PLAIN_GRAIN = {"perf_volume": "month", "perf_buy_signals": "quarter", "perf_volatility": "month"}


def grain_name(metric: str, grain: str) -> str:
    return metric if PLAIN_GRAIN[metric] == grain else f"{metric}_{grain}"


for _grain in G.GRAINS:
    def _volume(spark, sf, grain=_grain):
        return G.perf_volume(served_orders(spark, sf), grain)

    def _buys(spark, sf, grain=_grain):
        return G.perf_buy_signals(served(spark, sf), grain)

    def _volatility(spark, sf, grain=_grain):
        return G.perf_volatility(served_orders(spark, sf), grain)
    query(grain_name("perf_volume", _grain))(_volume)
    query(grain_name("perf_buy_signals", _grain))(_buys)
    query(grain_name("perf_volatility", _grain))(_volatility)


@query("perf_volatility_symbols")
def q_perf_volatility_symbols(spark, sf):
    return G.perf_volatility(served_orders(spark, sf), "year",
                             symbols=["AUTOMOBILE", "HOUSEHOLD"])


@query("signal_counts")
def q_signal_counts(spark, sf):
    return G.signal_counts(served(spark, sf), key="symbole")


@query("signal_share")
def q_signal_share(spark, sf):
    return G.signal_share(served(spark, sf))


@query("pivot_close")
def q_pivot_close(spark, sf):
    bars = served_orders(spark, sf)
    # the symbols of the data; their number bounds the width of the result
    symbols = [r[0] for r in P.distinct_symbols(B.table(spark, sf, "customer"), "c_mktsegment").collect()]
    return G.pivot_close(bars, symbols)


@query("corr_matrix")
def q_corr_matrix(spark, sf):
    return C.corr_matrix(served_walk(spark, sf))


@query("corr_matrix_brands")
def q_corr_matrix_brands(spark, sf):
    """25 symbols in several tiles, 6 places."""
    return C.corr_matrix(E.to_served(B.brand_bars(spark, sf, exact=True)), digits=6, symbols_per_tile=8)


@query("corr_window")
def q_corr_window(spark, sf):
    """Stored Gram blocks of all but the last days, brought up to date by the
    days that came and one that was corrected; then two years up to the 40th
    last day, 6 places."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/barwise/corr-{uuid.uuid4().hex}"
    bars = materialize(E.to_served(B.brand_bars(spark, sf, exact=True)), "corr_bars")
    days = [r[0] for r in bars.select("date_trading").distinct().orderBy(F.col("date_trading").desc()).limit(300).collect()]
    cut, wrong = days[min(20, len(days) - 1)], days[-1]
    day, close = F.col("date_trading"), F.col("prix_fermeture")
    first = bars.where(day <= F.lit(cut)).withColumn(
        "prix_fermeture", F.when(day == F.lit(wrong), close + 5).otherwise(close).cast("decimal(10,4)"))
    CB.refresh_corr(spark, first, path)
    CB.refresh_corr(spark, bars, path, bars.where((day > F.lit(cut)) | (day == F.lit(wrong))).select("date_trading"))
    end = days[min(40, len(days) - 1)]
    return CB.corr_window(spark, bars, path, end - dt.timedelta(days=730), end, digits=6)


# -- I: indicators ----------------------------------------------------------------------
@query("sma")
def q_sma(spark, sf):
    p = prepare_series(served_walk(spark, sf), "symbole", "date_trading", halo=200)
    for n in (20, 50, 200):
        p = I.sma(p, n)
    return finish_series(p).select("symbole", "date_trading", "sma_20", "sma_50", "sma_200")


@query("rsi_14")
def q_rsi_14(spark, sf):
    return I.rsi(served_walk(spark, sf), 14).select("symbole", "date_trading", "rsi_14")


@query("rsi_14_wilder")
def q_rsi_14_wilder(spark, sf):
    return I.rsi(served_walk(spark, sf), 14, method="wilder").select(
        "symbole", "date_trading", "rsi_14")


@query("rsi_level")
def q_rsi_level(spark, sf):
    return served(spark, sf).select("symbole", "date_trading", "rsi_14", "niveau_rsi")


@query("ema_12")
def q_ema_12(spark, sf):
    return I.ema(served_walk(spark, sf), "prix_fermeture", span=12, out="ema_12",
                 digits=4).select("symbole", "date_trading", "ema_12")


@query("ema_3")
def q_ema_3(spark, sf):
    # thirds of the closes: halving cents would give exact ties in the 5th place
    third = served_walk(spark, sf).withColumn("tiers", F.col("prix_fermeture").cast("double") / 3)
    return I.ema(third, "tiers", span=3, out="ema_3", digits=4).select("symbole", "date_trading", "ema_3")


@query("macd_6_13_5")
def q_macd_6_13_5(spark, sf):
    return I.macd(served_walk(spark, sf), 6, 13, 5).select(
        "symbole", "date_trading", "macd_line", "macd_signal")


@query("rsi_3_wilder")
def q_rsi_3_wilder(spark, sf):
    return I.rsi(served_walk(spark, sf), 3, method="wilder").select(
        "symbole", "date_trading", "rsi_3")


def walk_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Walk bars whose close is missing on every 7th of a month."""
    gap = F.dayofmonth("date_trading") % 7 == 0
    return served_walk(spark, sf).withColumn(
        "prix_fermeture", F.when(~gap, F.col("prix_fermeture")))


@query("sma_with_gaps")
def q_sma_with_gaps(spark, sf):
    return I.sma(walk_with_gaps(spark, sf), 20).select("symbole", "date_trading", "sma_20")


@query("bollinger_double")
def q_bollinger_double(spark, sf):
    """Double prices with flat stretches (whole hundreds of the walk), 6 places."""
    flat = (F.floor(F.col("prix_fermeture").cast("double") / 100) * 100).cast("double")
    b = I.bollinger_percent(I.bollinger(served_walk(spark, sf).withColumn("prix_fermeture", flat), 20, 2))
    return b.select("symbole", "date_trading", *[F.round(c, 6).alias(c) for c in (
        "bollinger_middle", "bollinger_upper", "bollinger_lower", "bollinger_percent")])


@query("enrich_duplicates")
def q_enrich_duplicates(spark, sf):
    """Every bar given twice, without batches: as if given once."""
    bars = B.walk_bars(spark, sf)
    return E.enrich(bars.unionByName(bars), RUN_TS).drop("horodatage_calcul")


@query("macd")
def q_macd(spark, sf):
    return I.macd(served_walk(spark, sf)).select(
        "symbole", "date_trading", "macd_line", "macd_signal")


@query("streamed_macd")
def q_streamed_macd(spark, sf):
    """Bars landed in three parts, taken up by a stream that is started anew
    for each of them from its checkpoint."""
    from ..streaming.macd import streamed_macd
    base = f"{checkpoint_dir(spark).rstrip('/')}/barwise/macd-{uuid.uuid4().hex}"
    bars = materialize(served_walk(spark, sf), "macd_bars")
    cuts = [_nth_day(bars.withColumnRenamed("date_trading", "date"), n) for n in (300, 50)]
    day = F.col("date_trading")
    for part in (day <= cuts[0], (day > cuts[0]) & (day <= cuts[1]), day > cuts[1]):
        bars.where(part).write.mode("append").parquet(f"{base}/landing")
        stream = spark.readStream.schema(bars.schema).parquet(f"{base}/landing")
        (streamed_macd(stream).writeStream.option("checkpointLocation", f"{base}/checkpoint")
         .trigger(availableNow=True).format("parquet").start(f"{base}/out").awaitTermination())
    found = spark.read.parquet(f"{base}/out").where(~F.col("late"))
    return found.select("symbole", "date_trading", "macd_line", "macd_signal", F.col("rsi").alias("rsi_14"))


@query("macd_histogram")
def q_macd_histogram(spark, sf):
    return I.macd_histogram(served(spark, sf).select(
        "symbole", "date_trading", "macd_line", "macd_signal"))


@query("macd_direction")
def q_macd_direction(spark, sf):
    return I.macd_direction(served(spark, sf).select(
        "symbole", "date_trading", "macd_line", "macd_signal"))


@query("bollinger")
def q_bollinger(spark, sf):
    b = I.bollinger(served_walk(spark, sf), 20, 2)
    return b.select("symbole", "date_trading", "bollinger_middle", "bollinger_upper",
                    "bollinger_lower")


@query("bollinger_percent")
def q_bollinger_percent(spark, sf):
    b = I.bollinger_percent(I.bollinger(served_walk(spark, sf), 20, 2))
    return b.select("symbole", "date_trading", "bollinger_percent")


@query("trend")
def q_trend(spark, sf):
    return served(spark, sf).select("symbole", "date_trading", "tendance_globale")


@query("trading_signal")
def q_trading_signal(spark, sf):
    return served(spark, sf).select("symbole", "date_trading", "signal_trading")


# -- F: scalar functions ----------------------------------------------------------------
@query("date_scalars")
def q_date_scalars(spark, sf):
    o = B.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    day = X.day_of("o_orderdate")
    return o.select(
        "o_orderkey",
        day.alias("jour"),
        X.fmt_date("o_orderdate", X.MONTH_FORMAT).alias("mois"),
        X.fmt_date("o_orderdate", X.DAY_FORMAT).alias("jour_texte"),
        X.fmt_date("o_orderdate", X.STAMP_FORMAT).alias("horodatage_lot"),
        X.fmt_date("o_orderdate", X.DISPLAY_TIME_FORMAT).alias("horodatage_affiche"),
        X.quarter_key(day).alias("trimestre"),
        X.half_key(day).alias("semestre"),
        F.year(day).alias("annee"),
        F.month(day).alias("mois_num"),
        X.days_before(day, 30).alias("moins_30j"))


@query("number_string_scalars")
def q_number_string_scalars(spark, sf):
    so = served_orders(spark, sf)
    close = F.col("prix_fermeture")
    return so.select(
        "symbole", "date_trading",
        X.round2(close).cast("double").alias("prix_arrondi"),
        X.parse_number(close.cast("string")).alias("prix_relu"),
        X.prefix_mask("symbole", 8).alias("symbole_masque"),
        X.fmt_fixed(close, 2).alias("prix_texte"),
        X.fmt_signed(close - F.col("prix_ouverture"), 4).alias("ecart_texte"),
        X.fmt_percent(close * F.lit(0.01).cast("decimal(3,2)"), 1).alias("pct_texte"),
        X.fmt_thousands("volume").alias("volume_texte"))


# -- V: serving views -------------------------------------------------------------------
@query("view_candlestick")
def q_view_candlestick(spark, sf):
    return V.view_candlestick(served(spark, sf, 365), days=365, as_of=T.as_of(spark, stored_path(spark, sf)))


@query("view_candlestick_table")
def q_view_candlestick_table(spark, sf):
    return V.view_candlestick_table(panels(spark, sf), n=20)


@query("view_rsi")
def q_view_rsi(spark, sf):
    return V.view_rsi(served(spark, sf, 180), days=180, as_of=T.as_of(spark, stored_path(spark, sf)))


@query("view_rsi_latest")
def q_view_rsi_latest(spark, sf):
    return V.view_rsi_latest(panels(spark, sf))


@query("view_candlestick_range")
def q_view_candlestick_range(spark, sf):
    """The panel for a chosen range of days."""
    return V.view_candlestick(served(spark, sf), days=("1996-01-01", "1997-12-31"))


@query("view_rsi_preset")
def q_view_rsi_preset(spark, sf):
    """The panel for a named period."""
    return V.view_rsi(served(spark, sf, 90), days="3 mois", as_of=T.as_of(spark, stored_path(spark, sf)))


@query("view_macd")
def q_view_macd(spark, sf):
    return V.view_macd(served(spark, sf, 90), days=90, as_of=T.as_of(spark, stored_path(spark, sf)))


@query("view_macd_latest")
def q_view_macd_latest(spark, sf):
    return V.view_macd_latest(panels(spark, sf))


@query("view_signal_board")
def q_view_signal_board(spark, sf):
    return V.view_signal_board(served(spark, sf))


@query("view_signal_table")
def q_view_signal_table(spark, sf):
    return V.view_signal_table(panels(spark, sf), n=10)


@query("view_sidebar")
def q_view_sidebar(spark, sf):
    return V.view_sidebar(served(spark, sf))
