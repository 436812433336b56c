"""Incremental ingest: each landed file is ingested once, retries are idempotent."""

import json
import os

from barwise.streaming import ingest_landed


def _land(folder, name, symbol, days):
    body = json.dumps({"Time Series (Daily)": {
        d: {"1. open": c, "2. high": c, "3. low": c, "4. close": c, "5. volume": "10"}
        for d, c in days}})
    with open(os.path.join(folder, name), "w") as f:
        f.write(json.dumps({"symbol": symbol, "body": body}) + "\n")


def test_landed_files_are_ingested_once(spark, scratch):
    land = os.path.join(scratch, "landing")
    os.makedirs(land)
    raw, rej, log, ck = (os.path.join(scratch, x) for x in ("raw", "rejects", "log", "ck"))
    _land(land, "a.json", "AAA", [("2024-01-02", "10.5"), ("2024-01-03", "bad")])
    q = ingest_landed(spark, land, raw, rej, log, ck)
    q.awaitTermination(120)
    assert spark.read.parquet(raw).count() == 1
    assert spark.read.parquet(rej).first().reject_reason == "BAD_NUMBER"
    _land(land, "b.json", "BBB", [("2024-01-02", "20.0"), ("2024-01-03", "21.0")])
    q = ingest_landed(spark, land, raw, rej, log, ck)
    q.awaitTermination(120)
    stored = spark.read.parquet(raw)
    assert stored.count() == 3
    assert stored.select("batch_id").distinct().count() == 2
    logs = {r.batch_id: r for r in spark.read.parquet(log).collect()}
    assert sorted(r.status for r in logs.values()) == ["PARTIAL", "SUCCESS"]


def test_a_new_stream_never_reuses_batch_ids(spark, scratch):
    land, raw, rej, log = (os.path.join(scratch, x) for x in ("landing", "raw", "rejects", "log"))
    os.makedirs(land)
    for name, symbol in (("a.json", "AAA"), ("b.json", "BBB")):
        _land(land, name, symbol, [("2024-01-02", "10.5")])
        # another checkpoint folder each time, as after a lost one
        ingest_landed(spark, land, raw, rej, log, os.path.join(scratch, "ck-" + symbol)).awaitTermination(120)
        if symbol == "AAA":
            os.rename(os.path.join(land, name), os.path.join(scratch, name))
    stored = spark.read.parquet(raw)
    assert sorted(r.symbol for r in stored.collect()) == ["AAA", "BBB"]
    assert stored.select("batch_id").distinct().count() == 2


def test_two_replies_for_a_day_give_one_row_from_the_later_file(spark, scratch):
    land, raw, rej, log, ck = (os.path.join(scratch, x) for x in ("landing", "raw", "rejects", "log", "ck"))
    os.makedirs(land)
    _land(land, "z.json", "AAA", [("2024-01-02", "1")])
    _land(land, "a.json", "AAA", [("2024-01-02", "2")])
    os.utime(os.path.join(land, "z.json"), (1_700_000_000, 1_700_000_000))
    os.utime(os.path.join(land, "a.json"), (1_700_000_100, 1_700_000_100))
    ingest_landed(spark, land, raw, rej, log, ck).awaitTermination(120)
    assert [float(r.close) for r in spark.read.parquet(raw).collect()] == [2.0]


def test_checkpoint_folder_is_required(spark, scratch):
    import pytest
    with pytest.raises(ValueError):
        ingest_landed(spark, scratch, scratch, scratch, scratch, "")
