"""Tables read and written through the configured source."""

import os

import pytest
from pyspark.sql import functions as F

from barwise.schemas import RAW_BARS
from barwise.sources import ingest as S
from barwise.sources import tables as T
from barwise.sources.connector import read_source, write_source
from tests.helpers import bars
from tests.test_refresh import TS


def test_round_trip_append_overwrite_and_schema_override(spark, scratch):
    spark.sparkContext._conf.set("spark.barwise.source.path", scratch)
    good = S.split_valid(S.stamp_batch(bars(spark, [float(i) for i in range(50)], raw=True), "B1", "P", TS))[0]
    one = T.table_options(spark, "raw_bars", "FIRST")
    two = T.table_options(spark, "raw_bars", "SECOND")
    write_source(good.repartition(3), one)
    write_source(good.limit(5), two)
    back = read_source(spark, one)
    assert back.columns == good.columns and [t for _, t in back.dtypes] == [t for _, t in good.dtypes]
    assert sorted(map(str, back.collect())) == sorted(map(str, good.collect()))
    assert back.rdd.getNumPartitions() == 3
    write_source(good, one)
    assert read_source(spark, one).count() == 100 and read_source(spark, two).count() == 5
    write_source(good.limit(7), one, "overwrite")
    assert read_source(spark, one).select("close").agg(F.count("close")).first()[0] == 7
    assert not os.listdir(os.path.join(scratch, "FIRST", "raw_bars", "_staging"))


def test_a_failed_write_leaves_the_table_as_it_was(spark, scratch):
    options = {"path": scratch, "dbtable": "t"}
    df = spark.range(0, 100, 1, 4)
    write_source(df, options)
    bad = df.withColumn("id", F.when(F.col("id") == 99, F.raise_error(F.lit("boom")).cast("long")).otherwise(F.col("id")))
    for mode in ("append", "overwrite"):
        with pytest.raises(Exception, match="boom"):
            write_source(bad, options, mode)
        assert read_source(spark, options).count() == 100


def test_missing_tables_and_options(spark, scratch):
    none = read_source(spark, {"path": scratch, "dbtable": "none"}, RAW_BARS)
    assert none.count() == 0 and none.columns == RAW_BARS.fieldNames()
    with pytest.raises(Exception, match="no table"):
        read_source(spark, {"path": scratch, "dbtable": "none"}).count()
    with pytest.raises(Exception, match="dbtable"):
        read_source(spark, {"path": scratch}, RAW_BARS).count()
