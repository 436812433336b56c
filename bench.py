"""Benchmark the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion through the ``noop`` sink (the whole plan
executes, nothing is collected to the driver). Before timing, one small
enrich and one correlation over the sf0.001 tables run untimed, so JVM
start-up, JIT, code generation and Python worker start-up are not charged
to the first headline queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from barwise.plans.catalog import QUERIES, RUN_TS  # noqa: E402
from barwise.plans.enrich import enrich  # noqa: E402
from barwise.session import build_session  # noqa: E402
from barwise.sources.bars import brand_bars  # noqa: E402

HEADLINE = [
    "enrich", "avg_price_volume", "dedupe_latest_batch", "parse_daily", "perf_price_month",
    "perf_volatility", "pivot_close", "corr_matrix", "last_n_rows", "view_signal_board",
    "view_macd", "rsi_14_wilder", "table_profile",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    # sf0.1 bars are a few MB: with the default 1 MB floor AQE would coalesce
    # every shuffle into one task and leave 7 of 8 cores idle
    spark = build_session(f"local[{cpus}]", app="barwise-bench", shuffle_partitions=2 * cpus,
                          extra={"spark.driver.memory": "16g",
                                 "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k"})
    run(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm_dir):
        run(enrich(brand_bars(spark, warm_dir, exact=True), RUN_TS))
        run(QUERIES["corr_matrix"](spark, warm_dir))  # starts the pandas workers
    timings = {}

    def timed(name, make):
        t0 = time.perf_counter()
        run(make())
        timings[name] = round(time.perf_counter() - t0, 3)

    # the flagship at bench scale: brand bars (lineitem x part) -> enriched table
    timed("brand_enrich", lambda: enrich(brand_bars(spark, sf_dir, exact=True), RUN_TS))
    for name in HEADLINE:
        timed(name, lambda n=name: QUERIES[n](spark, sf_dir))
    total = round(sum(timings.values()), 3)
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec",
                      "queries": timings, "sf": os.path.basename(sf_dir.rstrip("/")),
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
