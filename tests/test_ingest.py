"""Ingest, sinks and table lifecycle: round trips in a fresh scratch folder."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from barwise.schemas import RAW_BARS
from barwise.sources import ingest as S
from barwise.sources import tables as T
from tests.helpers import bars


def _reply(days):
    return json.dumps({"Meta Data": {"1. Information": "x"},
                       "Time Series (Daily)": {d: {"1. open": o, "2. high": o, "3. low": o,
                                                   "4. close": o, "5. volume": v}
                                               for d, o, v in days}})


def test_parse_daily_keeps_good_days_and_flags_bad_ones(spark):
    replies = spark.createDataFrame([
        ("AAA", _reply([("2024-01-02", "10.5", "100"), ("2024-01-03", "oops", "100"),
                        ("2024-01-04", "NaN", "100"), ("2024-01-05", "Infinity", "100")])),
        ("BBB", json.dumps({"Note": "rate limited"})),
    ], "symbol string, body string")
    rows = {r.date.isoformat(): r for r in S.parse_daily(replies, "B1", "SRC").collect()}
    assert set(rows) == {"2024-01-02", "2024-01-03", "2024-01-04", "2024-01-05"}
    assert rows["2024-01-02"].close == 10.5 and rows["2024-01-02"].reject_reason is None
    for day in ("2024-01-03", "2024-01-04", "2024-01-05"):
        assert rows[day].reject_reason == "BAD_NUMBER" and rows[day].close is None


def test_split_valid_reasons(spark):
    rows = [(None, dt.date(2024, 1, 1), 1.0), ("A", None, 1.0), ("ELEVENCHARS", dt.date(2024, 1, 1), 1.0),
            ("A", dt.date(2024, 1, 1), 2_000_000.0), ("A", dt.date(2024, 1, 2), 12.5)]
    df = spark.createDataFrame(rows, "symbol string, date date, close double").select(
        "symbol", "date", *[F.col("close").alias(c) for c in ("open", "high", "low", "close")],
        F.lit(1).cast("bigint").alias("volume"))
    good, rejects = S.split_valid(df)
    assert sorted(r.reject_reason for r in rejects.collect()) == [
        "NULL_DATE", "NULL_SYMBOL", "OUT_OF_RANGE", "TEXT_TOO_LONG"]
    g = good.collect()
    assert len(g) == 1
    assert [(f.name, f.dataType) for f in good.schema] == [(f.name, f.dataType) for f in RAW_BARS]


def test_dedupe_latest_batch(spark):
    base = bars(spark, [10.0, 11.0], raw=True)
    first = S.stamp_batch(base, "BATCH_1", "P", dt.datetime(2024, 1, 1))
    second = S.stamp_batch(base.where("date = '2024-01-02'").withColumn("close", F.col("close") + 1),
                           "BATCH_2", "P", dt.datetime(2024, 1, 2))
    got = {r.date.day: (float(r.close), r.batch_id)
           for r in S.dedupe_latest_batch(first.unionByName(second)).collect()}
    assert got == {1: (10.0, "BATCH_1"), 2: (12.0, "BATCH_2")}


def test_fallback_only_when_primary_empty(spark):
    p = bars(spark, [1.0], raw=True).withColumn("data_source", F.lit("P"))
    f = bars(spark, [2.0, 3.0], raw=True).withColumn("data_source", F.lit("FALLBACK"))
    assert {r.data_source for r in S.with_fallback(p, f).collect()} == {"P"}
    assert S.with_fallback(p.where("false"), f).count() == 2


def test_mask_and_batch_id(spark):
    df = spark.createDataFrame([("ABCDEFGHIJ",), (None,)], "k string")
    assert [r.k for r in S.mask_column(df, "k").collect()] == ["...IJ", None]
    now = dt.datetime(2024, 5, 6, 21, 7, 3)
    assert S.make_batch_id(now, "x") == "BATCH_20240506_210703_x"
    assert S.make_batch_id(now) != S.make_batch_id(now)


def test_latest_n(spark):
    df = bars(spark, list(range(50)), raw=True)
    got = S.latest_n(df, 30).agg(F.min("date"), F.count("*")).collect()[0]
    assert got[1] == 30 and got[0] == dt.date(2024, 1, 21)


def test_append_of_many_batches_finds_a_stored_id(spark, scratch):
    path = os.path.join(scratch, "raw")
    row = S.split_valid(S.stamp_batch(bars(spark, [1.0], raw=True), "B0", "P", dt.datetime(2024, 1, 1)))[0]
    ids = spark.range(0, 1300).select(F.concat(F.lit("B"), "id").alias("batch_id"))
    many = row.drop("batch_id").crossJoin(ids)
    # one that is not among the first 1,000 distinct ids
    first = {r[0] for r in many.select("batch_id").distinct().limit(1000).collect()}
    kept = min({r[0] for r in ids.collect()} - first)
    T.append_raw(many.where(F.col("batch_id") == kept), path)
    with pytest.raises(ValueError, match=kept):
        T.append_raw(many, path)
    assert T.read_or_empty(spark, path, RAW_BARS).count() == 1


def test_append_verify_is_idempotent_and_logged(spark, scratch):
    path = os.path.join(scratch, "raw")
    raw = S.stamp_batch(bars(spark, [10.0, 11.0, 12.0], raw=True), "BATCH_A", "P",
                        dt.datetime(2024, 1, 1), "SECRETKEY1")
    good, rejects = S.split_valid(raw)
    T.append_raw(good, path)
    with pytest.raises(ValueError):
        T.append_raw(good, path)  # an id names one batch
    T.append_raw(good, path, retry=True)  # a retried batch replaces its own partition
    other = S.stamp_batch(bars(spark, [5.0], raw=True), "BATCH_B", "P", dt.datetime(2024, 1, 2))
    T.append_raw(S.split_valid(other)[0], path)
    verified = T.verify_batch(path, "BATCH_A", spark)
    assert verified.collect()[0].verified == 3
    log = T.run_log(good, rejects, verified, "BATCH_A").collect()[0]
    assert (log.rows_processed, log.status, log.data_source) == (3, "SUCCESS", "P")
    assert log.details == "Inserted: 3, Errors: 0, Verified: 3"
    stored = spark.read.parquet(path)
    assert stored.where("batch_id = 'BATCH_A'").select("api_key_used").first()[0] == "...Y1"


def test_write_with_backup_dumps_and_raises(spark, scratch):
    bad = spark.createDataFrame([(1,)], "x int")  # not the raw schema
    backup = os.path.join(scratch, "backup")
    with pytest.raises(Exception):
        T.write_with_backup(bad, os.path.join(scratch, "raw"), backup)
    assert spark.read.json(backup).count() == 1


def test_read_or_empty(spark, scratch):
    df = T.read_or_empty(spark, os.path.join(scratch, "missing"), RAW_BARS)
    assert df.count() == 0
    assert [f.name for f in df.schema] == [f.name for f in RAW_BARS]


def test_table_profile_and_sample(spark):
    df = bars(spark, [1.0, None, 3.0], raw=True)
    prof = {r.column_name: r for r in T.table_profile(df).collect()}
    assert prof["close"].n_nulls == 1 and prof["close"].n_rows == 3
    assert prof["close"].min_value == "1.0000" and prof["close"].max_value == "3.0000"
    assert T.table_sample(df, ["date"], 2).count() == 2


def test_create_and_drop_table(spark, scratch):
    T.create_table(spark, "raw_bars_t", RAW_BARS, path=os.path.join(scratch, "t"),
                   partition_by=["batch_id"])
    assert T.read_table(spark, "raw_bars_t").count() == 0
    T.drop_table(spark, "raw_bars_t")
    assert not spark.catalog.tableExists("raw_bars_t")


def test_enriched_scan_round_trip(spark, scratch):
    from barwise.plans.enrich import enrich
    out = enrich(bars(spark, [10 + i for i in range(25)], raw=True), dt.datetime(2024, 1, 1))
    path = os.path.join(scratch, "enriched")
    out.toDF(*[c.upper() for c in out.columns]).write.parquet(path)
    back = T.enriched_scan(spark, path)
    assert back.columns == out.columns and back.count() == 25


def test_average_price_and_volume_by_hand(spark):
    from barwise.operators.aggregates import avg_price_volume
    df = spark.createDataFrame([("X", 2.0, 30), ("X", 4.0, 50), ("X", 6.0, None), ("Y", 7.5, 8)],
                               "symbol string, close double, volume bigint")
    got = {r.symbol: (r.avg_price, r.total_volume) for r in avg_price_volume(df).collect()}
    assert got == {"X": (4.0, 80), "Y": (7.5, 8)}


def test_missing_fields_and_bad_dates_are_rejects(spark):
    body = json.dumps({"Time Series (Daily)": {
        "2024-01-02": {"1. open": "1", "2. high": "1", "3. low": "1", "5. volume": "1"},
        "soon": {"1. open": "1", "2. high": "1", "3. low": "1", "4. close": "1", "5. volume": "1"}}})
    replies = spark.createDataFrame([("A", body), ("B", "{}"), ("C", "no json"), ("D", None)],
                                    "symbol string, body string")
    got = sorted(r.reject_reason for r in S.parse_daily(replies, "B1", "P").collect())
    assert got == ["BAD_DATE", "MISSING_VALUE"]
    lost = S.lost_replies(replies, "B1", "P").collect()
    assert sorted(r.symbol for r in lost) == ["B", "C", "D"]
    assert {r.reject_reason for r in lost} == {"NO_SERIES"}


def test_price_at_the_decimal_edge_is_rejected_not_fatal(spark):
    df = spark.createDataFrame([("A", dt.date(2024, 1, d), p) for d, p in
                                ((1, 999999.99994), (2, 999999.99996), (3, 1000000.0))],
                               "symbol string, date date, close double")
    df = df.select("symbol", "date", *[F.col("close").alias(c) for c in S.PRICES],
                   F.lit(1).cast("bigint").alias("volume"))
    good, rejects = S.split_valid(df)
    assert [str(r.close) for r in good.collect()] == ["999999.9999"]
    assert [r.reject_reason for r in rejects.collect()] == ["OUT_OF_RANGE"] * 2


def test_dedupe_orders_by_load_time_then_file_then_values(spark):
    row = bars(spark, [1.0], raw=True)
    old = S.stamp_batch(row, "BATCH_z", "P", dt.datetime(2020, 1, 1))
    new = S.stamp_batch(row.withColumn("close", F.lit(2).cast("decimal(10,4)")), "BATCH_2025", "P",
                        dt.datetime(2025, 1, 1))
    for a, b in ((old, new), (new, old)):
        assert float(S.dedupe_latest_batch(a.unionByName(b)).first().close) == 2.0
    twins = old.unionByName(old.withColumn("close", F.lit(3).cast("decimal(10,4)")))
    assert float(S.dedupe_latest_batch(twins).first().close) == 3.0
    assert float(S.dedupe_latest_batch(twins.orderBy("close")).first().close) == 3.0


def test_verify_on_a_missing_table(spark, scratch):
    assert T.verify_batch(os.path.join(scratch, "none"), "B", spark).first().verified == 0


def test_ingest_run_with_no_good_row(spark, scratch):
    from barwise.streaming import ingest_batch
    raw, rej, log = (os.path.join(scratch, x) for x in ("raw", "rejects", "log"))
    replies = spark.createDataFrame([("A", json.dumps({"Note": "rate limited"}))], "symbol string, body string")
    ingest_batch(replies, raw, rej, log, "BATCH_1")
    row = spark.read.parquet(log).first()
    assert row.status == "PARTIAL" and row.details == "Inserted: 0, Errors: 1, Verified: 0"


def test_ingest_run_uses_the_fallback_and_keeps_recent_days(spark, scratch):
    from barwise.streaming import ingest_batch
    raw, rej, log = (os.path.join(scratch, x) for x in ("raw", "rejects", "log"))
    spare = bars(spark, [5.0, 6.0], raw=True).withColumn("data_source", F.lit("FALLBACK"))
    empty = spark.createDataFrame([("A", "{}")], "symbol string, body string")
    ingest_batch(empty, raw, rej, log, "BATCH_1", fallback=spare, api_key="SECRETKEY1")
    stored = spark.read.parquet(raw)
    assert {(r.data_source, r.api_key_used) for r in stored.collect()} == {("FALLBACK", "...Y1")}
    full = spark.createDataFrame([("A", _reply([(f"2024-02-{d:02d}", "7", "1") for d in range(1, 11)]))],
                                 "symbol string, body string")
    ingest_batch(full, raw, rej, log, "BATCH_2", fallback=spare, keep_days=3)
    days = sorted(r.date.day for r in spark.read.parquet(raw).where("batch_id = 'BATCH_2'").collect())
    assert days == [8, 9, 10]


def test_text_dates_become_dates_in_the_scan(spark, scratch):
    from barwise.plans.enrich import enrich
    out = enrich(bars(spark, [10 + i for i in range(5)], raw=True), dt.datetime(2024, 1, 1))
    path = os.path.join(scratch, "text_dates")
    out.withColumn("date_trading", F.col("date_trading").cast("string")).write.parquet(path)
    back = T.enriched_scan(spark, path)
    assert dict(back.dtypes)["date_trading"] == "date"
    assert [r.date_trading for r in back.collect()] == [dt.date(2024, 1, d) for d in range(1, 6)]


def test_served_table_reads_only_the_years_it_needs(spark, scratch):
    from barwise.plans.enrich import enrich
    out = enrich(bars(spark, [10 + i for i in range(40)], start=dt.date(2023, 12, 10), raw=True),
                 dt.datetime(2024, 2, 1))
    path = os.path.join(scratch, "by_year")
    T.write_enriched(out, path)
    assert T.as_of(spark, path) == dt.date(2024, 1, 18)
    recent = T.serve_enriched(spark, path, days=10)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "annee" in plan.split("PartitionFilters")[1].split("]")[0]
    assert recent.agg(F.min("date_trading")).first()[0] == dt.date(2024, 1, 1)


def test_create_insert_select_drop_round_trip(spark, scratch):
    from pyspark.sql import types as Ty
    schema = Ty.StructType([Ty.StructField("id", Ty.IntegerType()),
                            Ty.StructField("test_name", Ty.StringType()),
                            Ty.StructField("created_at", Ty.TimestampNTZType())])
    T.create_table(spark, "scratch_t", schema, path=os.path.join(scratch, "scratch_t"))
    rows = [(i, f"test_{i}", dt.datetime(2024, 1, 1, 0, 0, i)) for i in (1, 2, 3)]
    spark.createDataFrame(rows, schema).write.insertInto("scratch_t")
    assert sorted(r.id for r in T.read_table(spark, "scratch_t").collect()) == [1, 2, 3]
    T.drop_table(spark, "scratch_t")
    assert not spark.catalog.tableExists("scratch_t")


def test_table_options_come_from_conf(spark):
    spark.sparkContext._conf.set("spark.barwise.source.url", "jdbc:example://host/db")
    opts = T.table_options(spark, name="RAW", schema="S1")
    assert opts["dbtable"] == "RAW" and opts["sfSchema"] == "S1"


def test_refresh_enriched_end_to_end(spark, scratch):
    from barwise.plans.refresh import refresh_enriched
    raw_path, out = os.path.join(scratch, "raw"), os.path.join(scratch, "enriched")
    for i, bid in enumerate(["BATCH_20240101_2100", "BATCH_20240102_2100"]):
        closes = [100.0 + k + i for k in range(60)]  # the second batch re-sends every day, +1
        batch = S.stamp_batch(bars(spark, closes, raw=True), bid, "P",
                              dt.datetime(2024, 1, 1 + i, 21))
        T.append_raw(S.split_valid(batch)[0], raw_path)
    refresh_enriched(spark, raw_path, out, dt.datetime(2024, 3, 1))
    back = T.enriched_scan(spark, out)
    rows = back.collect()
    assert len(rows) == 60 and back.columns[-1] == "horodatage_calcul"
    assert rows[0].prix_fermeture == 101.0  # latest batch won
    assert os.path.isdir(os.path.join(out, "annee=2024"))
