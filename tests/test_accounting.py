"""A run loses nothing silently: every landed row is stored, repeated, older
than the days kept, or rejected; keys are enforced while a batch is written."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from barwise.sources import ingest as S
from barwise.sources import tables as T
from barwise.streaming import ingest_batch
from tests.helpers import bars


def _reply(days):
    return json.dumps({"Time Series (Daily)": {
        d: {"1. open": c, "2. high": c, "3. low": c, "4. close": c, "5. volume": "10"} for d, c in days}})


def _days(n, first=dt.date(2024, 1, 1)):
    return [(str(first + dt.timedelta(days=i)), str(i + 1)) for i in range(n)]


def _run(spark, scratch, replies, **how):
    raw, rej, log, acc = (os.path.join(scratch, x) for x in ("raw", "rejects", "log", "accounting"))
    frame = spark.createDataFrame(replies, "symbol string, body string")
    got = ingest_batch(frame, raw, rej, log, "BATCH_1", accounting_path=acc, **how)
    assert got["landed"] == got["stored"] + got["repeated"] + got["older"] + got["rejected"]
    assert spark.read.parquet(acc).count() == 1
    return got, T.read_or_empty(spark, raw, S.RAW_BARS), spark.read.parquet(rej) if got["rejected"] else None, \
        spark.read.parquet(log).first()


def test_days_are_counted_not_rows(spark, scratch):
    got, stored, _, log = _run(spark, scratch, [("A", _reply(_days(40)))] * 2, keep_days=30)
    assert (got["stored"], got["repeated"], got["older"], got["rejected"]) == (30, 40, 10, 0)
    assert sorted(r.date for r in stored.collect())[0] == dt.date(2024, 1, 11)
    assert log.status == "SUCCESS"


def test_rejects_are_not_cut_off_by_the_days_kept(spark, scratch):
    body = _reply(_days(40) + [("soon", "1"), ("2024-13-45", "1")])
    got, stored, rejects, log = _run(spark, scratch, [("A", body)], keep_days=30)
    assert stored.count() == 30 and got["older"] == 10
    assert [r.reject_reason for r in rejects.collect()] == ["BAD_DATE"] * 2
    assert (log.status, log.details) == ("PARTIAL", "Inserted: 30, Errors: 2, Verified: 30")


def test_every_kind_of_reply_is_accounted_for(spark, scratch):
    good = _reply(_days(3))
    quote = json.dumps({"Global Quote": {"05. price": "186.20"}})
    replies = [("A", good), ("B", good[:-20]), ("C", None), ("D", '{"Note": "limit"}'),
               ("E", '{"Time Series (Daily)": {}}'), ("F", quote), ("G", "[1, 2]"), (None, good)]
    parsed = S.parse_landed(spark.createDataFrame(replies, "symbol string, body string"), "B", "P").collect()
    by = {r.symbol: (r.kind, r.reject_reason) for r in parsed if r.symbol not in ("A", None)}
    assert by == {"B": ("lost", "BAD_JSON"), "C": ("lost", "BAD_JSON"), "D": ("lost", "NO_SERIES"),
                  "E": ("lost", "EMPTY_SERIES"), "F": ("quote", None), "G": ("lost", "NO_SERIES")}
    assert [r.price for r in parsed if r.symbol == "F"] == [186.2]
    got, stored, rejects, log = _run(spark, scratch, replies)
    assert (got["stored"], got["rejected"], got["lost_replies"]) == (3, 8, 5)
    reasons = sorted(r.reject_reason for r in rejects.collect())
    assert reasons == ["BAD_JSON"] * 2 + ["EMPTY_SERIES"] + ["NO_SERIES"] * 2 + ["NULL_SYMBOL"] * 3
    assert log.status == "PARTIAL"


def test_one_parse_gives_the_rows_of_parse_daily(spark):
    body = json.dumps({"Time Series (Daily)": {
        "2024-01-02": {"1. open": 1.5, "2. high": "2", "3. low": "1", "4. close": "NaN", "5. volume": "7"},
        "2024-01-03": {"1. open": "x", "2. high": "2", "3. low": "1", "4. close": "1", "5. volume": "7"},
        "2024-01-04": {"1. open": "1", "2. high": "2", "3. low": "1", "4. close": "1"},
        "2024-01-05": {"1. open": "1", "2. high": "2", "3. low": "1", "4. close": "1", "5. volume": "7"},
        "soon": {"1. open": "1", "2. high": "2", "3. low": "1", "4. close": "1", "5. volume": "7"}}})
    replies = spark.createDataFrame([("A", body), ("B", "{}")], "symbol string, body string")
    one, two = S.parse_daily(replies, "B1", "P"), S.parse_landed(replies, "B1", "P").where("kind = 'day'")
    assert sorted(map(str, one.collect())) == sorted(map(str, two.select(*one.columns).collect()))


def test_an_all_reject_primary_gives_way_to_the_fallback(spark, scratch):
    spare = bars(spark, [5.0, 6.0], raw=True).withColumn("data_source", F.lit("FALLBACK"))
    got, stored, _, log = _run(spark, scratch, [("A", _reply([("soon", "1")]))], fallback=spare)
    assert (got["stored"], got["rejected"]) == (2, 1)
    assert {r.data_source for r in stored.collect()} == {"FALLBACK"} and log.data_source == "FALLBACK"


def test_a_repeated_or_null_key_fails_the_append(spark, scratch):
    path = os.path.join(scratch, "raw")
    good = S.split_valid(S.stamp_batch(bars(spark, [1.0, 2.0, 3.0], raw=True), "B1", "P", dt.datetime(2024, 1, 1)))[0]
    twice = good.unionByName(good.limit(1))
    null = good.withColumn("symbol", F.when(F.col("close") > 1, F.col("symbol")))
    for bad in (twice, null):
        with pytest.raises(Exception, match="null or repeated"):
            T.append_raw(bad, path)
        assert T.read_or_empty(spark, path, S.RAW_BARS).count() == 0
    T.append_raw(good, path)
    with pytest.raises(Exception, match="null or repeated"):
        T.append_raw(twice, path, retry=True)
    assert T.read_or_empty(spark, path, S.RAW_BARS).count() == 3
