"""Incremental refresh: after every run the enriched table is what a full run
over all batches gives, and only what changed is computed."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from barwise.plans.enrich import enrich
from barwise.operators.filters import last_n_rows
from barwise.plans.refresh import read_panels, refresh_increment
from barwise.sources.bars import walk_bars
from barwise.sources.ingest import split_valid, stamp_batch
from barwise.sources.tables import append_raw

SF = "/root/testdata/sf0.001"
TS = dt.datetime(2024, 1, 2, 21)


class Job:
    def __init__(self, spark, folder):
        self.spark = spark
        self.raw, self.enriched, self.state = (f"{folder}/{x}" for x in ("raw", "enriched", "state"))
        self.runs = 0

    def land(self, bars, hour=None):
        self.runs += 1
        loaded = TS + dt.timedelta(hours=self.runs if hour is None else hour)
        append_raw(split_valid(stamp_batch(bars, f"BATCH_{self.runs:03d}", "PRIMARY", loaded))[0], self.raw)

    def refresh(self):
        return refresh_increment(self.spark, self.raw, self.enriched, self.state, TS, block=256)

    def check(self):
        """The stored table against a full run, value by value, and the
        panels against its last rows."""
        full = enrich(self.spark.read.parquet(self.raw), TS).drop("horodatage_calcul")
        got = self.spark.read.parquet(self.enriched).select(*full.columns)
        last = last_n_rows(got, 20)
        assert sorted(map(str, read_panels(self.spark, self.state).select(*last.columns).collect())) == \
            sorted(map(str, last.collect()))
        a, b = (sorted((tuple(r) for r in df.collect()), key=lambda r: r[:2]) for df in (full, got))
        assert len(a) == len(b)
        for x, y in zip(a, b):
            assert x[:2] == y[:2]
            for v, w in zip(x[2:], y[2:]):
                assert v == w or (isinstance(v, float) and math.isclose(v, w, abs_tol=1e-9)), (x, y)


@pytest.fixture(scope="module")
def bars(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bars")) + "/walk"
    walk_bars(spark, SF).write.parquet(path)
    return spark.read.parquet(path)


def test_new_days_use_the_state_only(spark, scratch, bars):
    job = Job(spark, scratch)
    days = sorted(r[0] for r in bars.select("date").distinct().collect())
    cut, again = days[-40], days[-70]
    job.land(bars.where(F.col("date") < F.lit(cut)))
    first = job.refresh()
    assert first["rows"] == bars.where(F.col("date") < F.lit(cut)).count()
    job.check()
    # thirty known days are sent again, as each run does
    job.land(bars.where(F.col("date") >= F.lit(again)))
    second = job.refresh()
    new = bars.where(F.col("date") >= F.lit(cut))
    assert second["days"] == second["rows"] == new.count()
    assert second["blocks"] == new.select("symbol", F.year("date")).distinct().count()
    job.check()
    # the panels' queries read the panels alone
    files = read_panels(spark, job.state).inputFiles()
    assert files and all("/state/panels/" in f for f in files)
    assert job.refresh()["batches"] == 0
    job.land(bars.where(F.col("date") >= F.lit(again)))
    assert job.refresh() | {"batches": 0} == dict.fromkeys(second, 0)
    job.check()


def test_late_and_corrected_days(spark, scratch, bars):
    job = Job(spark, scratch)
    symbol = bars.agg(F.min("symbol")).first()[0]
    own = [r[0] for r in bars.where(F.col("symbol") == symbol).orderBy("date").select("date").collect()]
    late, fixed = own[len(own) // 2], own[len(own) // 3]
    job.land(bars.where(~((F.col("symbol") == symbol) & (F.col("date") == F.lit(late)))))
    job.refresh()
    job.check()
    one = bars.where(F.col("symbol") == symbol)
    job.land(one.where(F.col("date") == F.lit(late)).unionByName(
        one.where(F.col("date") == F.lit(fixed)).withColumn("close", (F.col("close") + 7).cast("decimal(10,4)"))))
    counts = job.refresh()
    assert counts["days"] == 2 and counts["symbols"] == 1
    assert counts["blocks"] == len({d.year for d in own if d.year >= fixed.year})
    job.check()


def test_an_older_batch_that_comes_later_loses(spark, scratch, bars):
    job = Job(spark, scratch)
    job.land(bars, hour=10)
    job.refresh()
    job.land(bars.withColumn("close", (F.col("close") + 1).cast("decimal(10,4)")), hour=5)
    assert job.refresh()["days"] == 0
    job.check()


def test_days_without_a_close_new_symbols_and_emptied_years(spark, scratch, bars):
    job = Job(spark, scratch)
    symbols = sorted(r[0] for r in bars.select("symbol").distinct().collect())
    job.land(bars.where(F.col("symbol") != symbols[0]))
    job.refresh()
    job.land(bars.where(F.col("symbol") == symbols[0]))
    assert job.refresh()["symbols"] == 1
    job.check()
    last = bars.agg(F.max(F.year("date"))).first()[0]
    job.land(bars.where(F.year("date") == last).withColumn("close", F.lit(None).cast("decimal(10,4)")))
    job.refresh()
    job.check()
    job.land(bars.where((F.year("date") == last) & (F.col("symbol") == symbols[1])))
    job.refresh()
    job.check()


def test_a_lost_run_is_made_good(spark, scratch, bars, monkeypatch):
    from barwise.plans import refresh
    job = Job(spark, scratch)
    days = sorted(r[0] for r in bars.select("date").distinct().collect())
    job.land(bars.where(F.col("date") < F.lit(days[-30])))
    job.refresh()
    whole, calls = refresh._replace, []

    def dies(df, path, *how):
        calls.append(path)
        if len(calls) == stop:
            raise RuntimeError("lost")
        whole(df, path, *how)
    for stop in (2, 4):  # before the states, before the bars
        calls.clear()
        monkeypatch.setattr(refresh, "_replace", dies)
        job.land(bars.where(F.col("date") >= F.lit(days[-30 if stop == 2 else -45])).withColumn(
            "close", (F.col("close") + stop).cast("decimal(10,4)")))
        with pytest.raises(RuntimeError):
            job.refresh()
        monkeypatch.setattr(refresh, "_replace", whole)
        assert job.refresh()["days"] > 0
        job.check()


def test_an_empty_raw_table(spark, scratch):
    assert set(Job(spark, scratch).refresh().values()) == {0}
