"""State kept beside the tables: correlation blocks, streamed averages."""

import datetime as dt
import math
import os

import pytest
from pyspark.sql import functions as F

from barwise.operators import indicators as I
from barwise.operators.corr_blocks import corr_window, refresh_corr
from barwise.operators.correlation import corr_matrix
from barwise.plans.enrich import to_served
from barwise.sources.bars import walk_bars
from barwise.streaming.macd import streamed_macd

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def served(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bars")) + "/walk"
    to_served(walk_bars(spark, SF)).write.parquet(path)
    return spark.read.parquet(path)


def _pairs(df):
    return {(r.symbole_a, r.symbole_b): r.correlation for r in df.collect()}


def _same(a, b):
    a, b = _pairs(a), _pairs(b)
    assert a.keys() == b.keys()
    for k in a:
        assert (a[k] is None) == (b[k] is None) and (a[k] is None or math.isclose(a[k], b[k], abs_tol=1e-6)), k


def test_windows_equal_the_recompute_after_new_late_and_corrected_days(spark, scratch, served):
    day = F.col("date_trading")
    days = sorted(r[0] for r in served.select(day).distinct().collect())
    late, cut = days[len(days) // 2], days[-30]
    first = served.where((day != F.lit(late)) & (day <= F.lit(cut)))
    n = refresh_corr(spark, first, scratch, tile=2)
    assert n == len({(d - dt.date(1970, 1, 1)).days // 64 for d in days if d <= cut})
    _same(corr_window(spark, first, scratch, days[0], days[-1], 6, tile=2), corr_matrix(first, digits=6))
    changed = served.where((day == F.lit(late)) | (day > F.lit(cut))).select(day)
    touched = {(d - dt.date(1970, 1, 1)).days // 64 for d in days if d == late or d > cut}
    assert refresh_corr(spark, served, scratch, changed, tile=2) == len(touched)
    for a, b in ((0, -1), (0, 10), (len(days) // 3, -15), (5, 5)):
        window = served.where(day.between(F.lit(days[a]), F.lit(days[b])))
        _same(corr_window(spark, served, scratch, days[a], days[b], 6, tile=2), corr_matrix(window, digits=6))
    assert refresh_corr(spark, served, scratch, served.limit(0).select(day)) == 0
    with pytest.raises(ValueError):
        corr_window(spark, served, scratch, days[5], days[4])


def test_a_block_that_lost_its_days_and_a_symbol_not_met_yet(spark, scratch, served):
    day = F.col("date_trading")
    refresh_corr(spark, served, scratch)
    days = sorted(r[0] for r in served.select(day).distinct().collect())
    kept = served.where(day < F.lit(days[-100]))
    refresh_corr(spark, kept, scratch, served.where(day >= F.lit(days[-100])).select(day))
    _same(corr_window(spark, kept, scratch, days[0], days[-1], 6), corr_matrix(kept, digits=6))
    more = kept.unionByName(kept.where("symbole = 'BUILDING'").withColumn("symbole", F.lit("NEW")))
    near = days[len(days) // 2]
    window = more.where(day.between(F.lit(near), F.lit(near + dt.timedelta(days=20))))
    _same(corr_window(spark, more, scratch, near, near + dt.timedelta(days=20), 6), corr_matrix(window, digits=6))


def test_streamed_averages_survive_restarts_and_mark_late_bars(spark, scratch, served):
    day = F.col("date_trading")
    days = sorted(r[0] for r in served.select(day).distinct().collect())
    late = served.where(day == F.lit(days[-20]))
    parts = [served.where(day < F.lit(days[-60])), served.where((day >= F.lit(days[-60])) & (day != F.lit(days[-20]))),
             late]
    land, out, ck = (os.path.join(scratch, x) for x in ("land", "out", "ck"))
    for part in parts:
        part.write.mode("append").parquet(land)
        stream = streamed_macd(spark.readStream.schema(served.schema).parquet(land))
        stream.writeStream.option("checkpointLocation", ck).trigger(availableNow=True).format(
            "parquet").start(out).awaitTermination(300)
    got = spark.read.parquet(out)
    assert got.where("late").count() == late.count() and got.where("late and macd_line is not null").count() == 0
    onward = served.where(day != F.lit(days[-20]))
    rows = {(r.symbole, r.date_trading): r for r in got.where("not late").collect()}
    assert len(rows) == onward.count()
    expected = I.macd(onward).join(I.rsi(onward, 14, "wilder").select("symbole", "date_trading", "rsi_14"),
                                   ["symbole", "date_trading"]).collect()
    for r in expected:
        g = rows[r.symbole, r.date_trading]
        assert (g.macd_line, g.macd_signal, g.rsi) == (r.macd_line, r.macd_signal, r.rsi_14)
