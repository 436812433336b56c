"""Scalar functions: formats, rounding and parsing."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from barwise.functions import scalars as X


def test_formats_round_half_even_before_printing(spark):
    df = spark.createDataFrame(
        [(Decimal("2.6750"), Decimal("-0.0123"), Decimal("12.3450"), 1234567)],
        "x decimal(10,4), d decimal(10,4), p decimal(10,4), v bigint")
    r = df.select(X.fmt_fixed("x").alias("a"), X.fmt_signed("d").alias("b"),
                  X.fmt_percent("p").alias("c"), X.fmt_thousands("v").alias("e"),
                  X.round2("x").alias("r")).first()
    assert (r.a, r.b, r.c, r.e) == ("2.68", "-0.0123", "12.3%", "1,234,567")
    assert r.r == Decimal("2.68")


def test_dates_and_text(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 7, 1, 21, 5, 9), "ABCDEFGHIJKL", "12.5x")],
                               "ts timestamp_ntz, s string, t string")
    r = df.select(X.fmt_date("ts", X.STAMP_FORMAT).alias("stamp"),
                  X.fmt_date("ts", X.DISPLAY_TIME_FORMAT).alias("disp"),
                  X.quarter_key(X.day_of("ts")).alias("q"),
                  X.half_key(X.day_of("ts")).alias("h"),
                  X.days_before(X.day_of("ts"), 30).alias("m30"),
                  X.prefix_mask("s", 8).alias("mask"),
                  X.parse_number("t").alias("bad"),
                  X.parse_number(F.lit("12.5")).alias("good")).first()
    assert r.stamp == "20240701_2105" and r.disp == "2024-07-01 21:05:09"
    assert (r.q, r.h) == ("2024Q3", "2024-S2")
    assert r.m30 == dt.date(2024, 6, 1)
    assert r.mask == "ABCDEFGH..."
    assert r.bad is None and r.good == 12.5
