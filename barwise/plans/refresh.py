"""The daily job: stored raw bars -> enriched table, whole or by increment.

``refresh_enriched`` reads the whole raw table and writes every year.

``refresh_increment`` reads the batches that it has not seen and brings the
enriched table to what a full run would give. It keeps, beside the table:

* ``bars``: the taken row of every (symbol, date), by year, with its load time
  and batch, so a later batch is compared with it and re-sent days that say
  the same change nothing;
* ``states``: how each series stands after each of its years (rows so far,
  the last 200 closes, MACD's three sums), by year;
* ``panels``: the last 20 enriched rows of every symbol, by hash of the symbol,
  which serve the dashboard's latest values and tables;
* ``runs``: the batches that are done, one file set a run.

A symbol's series is taken up again at the newest state that lies before its
earliest changed day: after its last row if all changes are new days, before
an earlier year if a day was re-sent or came late. Only rows after that state
are computed (their windows reach into its tail, its sums are carried in), and
only the year partitions that hold such rows are replaced.

A run that is lost half-way is made good by the next one: enriched rows and
states are replaced before ``bars`` are, so the changes are found again, and
states beyond the earliest changed day are never taken up. One run at a time.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.filters import DATE, KEY, last_n_rows
from ..operators.indicators import CLOSE
from ..operators.series import DEFAULT_BLOCK, IDX, usable
from ..schemas import ENRICHED, ENRICHED_COLUMNS, PRICE, RAW_BARS, RAW_TO_SERVED
from ..session import materialize, path_exists, scratch
from ..sources.ingest import dedupe_latest_batch
from ..sources.tables import read_or_empty, write_enriched
from .enrich import SUMS, TAIL, as_enriched, enrich, indicators_after

YEAR = "annee"
_VALUES = ("open", "high", "low", "close", "volume")
BARS = T.StructType([*[f for f in RAW_BARS.fields if f.name in (
    "symbol", "date", *_VALUES, "batch_id", "load_timestamp")], T.StructField(YEAR, T.IntegerType())])
STATES = T.StructType([
    T.StructField(KEY, T.StringType()), T.StructField("n_rows", T.LongType()),
    T.StructField("last_date", T.DateType()), T.StructField("tail", T.ArrayType(PRICE)),
    *[T.StructField(name, T.DoubleType()) for name in SUMS], T.StructField(YEAR, T.IntegerType())])
RUNS = "run string, batch_id string, run_ts timestamp"
#: Rows of a symbol that panels hold, and the parts that their symbols are dealt to.
PANEL_ROWS, PANEL_PARTS, PART = 20, 64, "seau"


def refresh_enriched(spark: SparkSession, raw_path: str, enriched_path: str,
                     run_ts: dt.datetime | None = None) -> None:
    raw = spark.read.parquet(raw_path)
    write_enriched(enrich(raw, run_ts), enriched_path)


def _replace(df: DataFrame, path: str, by: str, values: list[int] = ()) -> None:
    """Replace the partitions of ``df`` (by its column ``by``) at ``path``,
    which ``df`` may be read from; those of ``values`` without a row become
    empty."""
    df = materialize(df, "replaced")
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    left = {r[0] for r in df.select(by).distinct().collect()} if values else set()
    for value in values:
        if value not in left:
            df.drop(by).limit(0).write.mode("overwrite").parquet(f"{path}/{by}={value}")


def changed_bars(fresh: DataFrame, stored: DataFrame) -> DataFrame:
    """The taken row of every (symbol, date) of ``fresh`` among it and
    ``stored``, with ``changed``: whether it says something else than the
    stored one, or there is none."""
    values = F.struct(*_VALUES)
    own = stored.join(fresh.select("symbol", "date"), ["symbol", "date"], "left_semi")
    was = own.select("symbol", "date", values.alias("_was"), F.lit(True).alias("_known"))
    taken = dedupe_latest_batch(fresh.unionByName(own))
    return (taken.join(was, ["symbol", "date"], "left")
            .withColumn("changed", F.col("_known").isNull() | ~values.eqNullSafe(F.col("_was")))
            .drop("_was", "_known"))


def start_states(states: DataFrame, since: DataFrame, years: tuple[int, int]) -> DataFrame:
    """For each symbol of ``since`` (symbole, since) its newest state that
    ends before that day. ``years`` are the first and last year of the days:
    the states of these years and the one before are read, older ones only
    for symbols that have none there."""

    def newest(part: DataFrame, wanted: DataFrame) -> DataFrame:
        near = part.join(wanted, KEY).where(F.col("last_date") < F.col("since"))
        others = [f.name for f in STATES.fields if f.name != KEY]
        return near.groupBy(KEY).agg(F.max_by(F.struct(*others), "last_date").alias("_s")).select(KEY, "_s.*")

    recent = F.col(YEAR).between(years[0] - 1, years[1])
    found = materialize(newest(states.where(recent), since), "start_states")
    rest = since.join(found, KEY, "left_anti")
    return found.unionByName(newest(states.where(F.col(YEAR) < years[0] - 1), rest))


def states_after(computed: DataFrame, starts: DataFrame) -> DataFrame:
    """The states after each year of ``computed`` rows (``indicators_after``):
    a year's last closes are at most 366, and a tail takes the closes of the
    years that reach into it."""
    closes = F.sort_array(F.collect_list(F.struct(F.col(IDX).alias("i"), F.col(CLOSE).alias("x"))))
    by_year = computed.groupBy(KEY, F.year(DATE).alias(YEAR)).agg(
        (F.max(IDX) + 1).alias("n_rows"), F.max(DATE).alias("last_date"),
        F.max_by(F.struct(*SUMS), IDX).alias("_sums"), closes.alias("_closes"))
    near = Window.partitionBy(KEY).orderBy("n_rows").rangeBetween(1 - TAIL, 0)
    lists = F.sort_array(F.collect_list(F.struct("n_rows", "_closes")).over(near))
    mine = by_year.withColumn("_own", F.flatten(F.transform(lists, lambda x: x["_closes"]["x"])))
    both = mine.join(starts.select(KEY, F.col("tail").alias("_before")), KEY, "left").withColumn(
        "_all", F.concat(F.coalesce("_before", F.array().cast(T.ArrayType(PRICE))), F.col("_own")))
    tail = F.slice("_all", F.greatest(F.lit(1), F.size("_all") - (TAIL - 1)), TAIL)
    return both.select(KEY, "n_rows", "last_date", tail.alias("tail"),
                       *[F.col("_sums")[name].alias(name) for name in SUMS], YEAR)


def _part(key: str = KEY) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(PANEL_PARTS)).cast("int")


def refresh_panels(spark: SparkSession, enriched_path: str, path: str, after: DataFrame, computed: DataFrame) -> None:
    """Bring the last rows of the symbols of ``after`` (symbole, _after,
    _total) up to their ``computed`` rows, which are all their rows after that
    day. Where fewer are left than a panel holds though the symbol has more,
    days were taken away: these symbols' last rows are read from the enriched
    table, which is up to date."""
    schema = T.StructType([*ENRICHED.fields, T.StructField(PART, T.IntegerType())])
    old = read_or_empty(spark, path, schema)
    parts = [r[0] for r in after.select(_part().alias(PART)).distinct().collect()]  # 64 at most
    old = old.where(F.col(PART).isin(parts)).drop(PART).join(after, KEY, "left")
    others = old.where(F.col("_after").isNull()).drop("_after", "_total")
    before = old.where(F.col(DATE) <= F.col("_after")).drop("_after", "_total")
    mine = materialize(last_n_rows(before.unionByName(computed), PANEL_ROWS), "panel_rows")
    held = mine.groupBy(KEY).agg(F.count(F.lit(1)).alias("n"))
    few = after.join(held, KEY, "left").where(
        F.coalesce("n", F.lit(0)) < F.least(F.lit(PANEL_ROWS), F.col("_total"))).select(KEY)
    few = materialize(few, "panel_short")
    if not few.isEmpty():
        whole = spark.read.parquet(enriched_path).drop(YEAR).join(few, KEY, "left_semi") \
            if path_exists(spark, enriched_path) else computed.limit(0)
        mine = mine.join(few, KEY, "left_anti").unionByName(last_n_rows(whole, PANEL_ROWS).select(*mine.columns))
    _replace(others.unionByName(mine).withColumn(PART, _part()), path, PART, parts)


def read_panels(spark: SparkSession, state_path: str) -> DataFrame:
    """The last rows of every symbol, as the refresh keeps them: what the
    ``latest`` and ``table`` views need of the enriched table."""
    return read_or_empty(spark, f"{state_path.rstrip('/')}/panels",
                         T.StructType([*ENRICHED.fields, T.StructField(PART, T.IntegerType())])).drop(PART)


def refresh_increment(spark: SparkSession, raw_path: str, enriched_path: str, state_path: str,
                      run_ts: dt.datetime | None = None, block: int = DEFAULT_BLOCK) -> dict:
    """Bring the enriched table up to the raw table's new batches.

    Gives counts: batches read, days changed, symbols and (symbol, year)
    blocks computed, rows computed, years replaced. The first run computes
    everything. Rows without a key are left out; a day whose taken row has no
    close has no indicators, and takes them away if it had them.
    """
    with scratch(spark):
        return _refresh_increment(spark, raw_path, enriched_path, state_path, run_ts, block)


def _refresh_increment(spark, raw_path, enriched_path, state_path, run_ts, block) -> dict:
    run_ts = run_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    bars_path, states_path, panels_path, runs_path = (
        f"{state_path.rstrip('/')}/{x}" for x in ("bars", "states", "panels", "runs"))
    raw = read_or_empty(spark, raw_path, RAW_BARS)
    done = read_or_empty(spark, runs_path, RUNS)
    new = raw.select("batch_id").distinct().join(done.select("batch_id"), "batch_id", "left_anti")  # partition values
    batches = [r[0] for r in new.collect()]
    counts = {"batches": len(batches), "days": 0, "symbols": 0, "blocks": 0, "rows": 0, "years": 0}
    if not batches:
        return counts
    names = [f.name for f in BARS.fields if f.name != YEAR]
    fresh = dedupe_latest_batch(raw.where(F.col("batch_id").isin(batches) & F.col("symbol").isNotNull()
                                          & F.col("date").isNotNull()).select(*names))
    fresh = materialize(fresh, "fresh_bars")
    first, last = fresh.agg(F.min(F.year("date")), F.max(F.year("date"))).first()
    stored = read_or_empty(spark, bars_path, BARS)
    if first is not None:
        near = F.col(YEAR).between(first, last)
        taken = materialize(changed_bars(fresh, stored.where(near).select(*names)), "taken_bars")
        since = materialize(taken.where("changed").groupBy(F.col("symbol").alias(KEY)).agg(
            F.min("date").alias("since")), "changed_symbols")
        counts["days"] = taken.where("changed").count()
        counts |= _recompute(spark, taken, stored, since, (first, last), enriched_path, states_path, panels_path,
                               run_ts, block)
        kept = stored.where(near).join(taken, ["symbol", "date"], "left_anti")
        _replace(kept.unionByName(taken.select(*names).withColumn(YEAR, F.year("date"))), bars_path, YEAR)
    one = uuid.uuid4().hex
    spark.createDataFrame([(one, b, run_ts) for b in batches], RUNS).coalesce(1).write.mode("append").parquet(runs_path)
    return counts


def _recompute(spark, taken, stored, since, years, enriched_path, states_path, panels_path, run_ts, block) -> dict:
    """Compute the changed symbols anew from their start states and replace
    the years that hold computed rows, in the enriched table and the states."""
    states = read_or_empty(spark, states_path, STATES)
    starts = materialize(start_states(states, since, years), "start_states")
    # a symbol without a state before its changed day has no row before that year
    after = since.join(starts.select(KEY, "last_date"), KEY, "left").select(
        KEY, F.coalesce("last_date", F.make_date(F.year("since") - 1, F.lit(12), F.lit(31))).alias("_after"))
    after = materialize(after, "computed_from")
    # partition pruning: no row before the oldest start state is read
    oldest, symbols = after.agg(F.min(F.year("_after")), F.count(F.lit(1))).first()
    if not symbols:
        return {}
    columns = list(RAW_TO_SERVED)
    old = stored.where(F.col(YEAR) >= oldest).select(*columns).join(taken, ["symbol", "date"], "left_anti")
    rows = old.unionByName(taken.select(*columns)).select(*[F.col(r).alias(s) for r, s in RAW_TO_SERVED.items()])
    rows = rows.join(after, KEY).where(F.col(DATE) > F.col("_after")).drop("_after")
    rows = materialize(usable(rows, KEY, DATE, CLOSE), "rows_to_compute")
    computed = materialize(as_enriched(
        indicators_after(rows, starts, block), run_ts,
        [IDX, *SUMS, F.col(CLOSE).alias("_close")]), "computed_rows")
    new_states = materialize(states_after(computed.drop(CLOSE).withColumnRenamed("_close", CLOSE), starts), "states")
    # a year is replaced if it holds rows after a start state, computed or old
    enriched = read_or_empty(spark, enriched_path, T.StructType([*ENRICHED.fields, T.StructField(YEAR, T.IntegerType())]))
    near = enriched.where(F.col(YEAR) >= oldest).join(after, KEY).where(F.col(DATE) > F.col("_after"))
    n_rows, blocks = computed.agg(F.count(F.lit(1)), F.countDistinct(KEY, F.year(DATE))).first()
    replaced = sorted({r[0] for r in computed.select(F.year(DATE)).distinct().union(
        near.select(YEAR).distinct()).distinct().collect()})
    for table, path, fresh in (
            (enriched, enriched_path, computed.select(*ENRICHED_COLUMNS).withColumn(YEAR, F.year(DATE))),
            (states.withColumn(DATE, F.col("last_date")), states_path, new_states.withColumn(DATE, F.col("last_date")))):
        kept = table.where(F.col(YEAR).isin(replaced)).join(after, KEY, "left")
        kept = kept.where(F.col("_after").isNull() | (F.col(DATE) <= F.col("_after"))).drop("_after")
        both = kept.unionByName(fresh.select(*kept.columns))
        _replace(both.drop(DATE) if table is not enriched else both, path, YEAR, replaced)
    totals = new_states.groupBy(KEY).agg(F.max("n_rows").alias("total"))
    after = after.join(totals, KEY, "left").join(starts.select(KEY, "n_rows"), KEY, "left").select(
        KEY, "_after", F.coalesce("total", "n_rows", F.lit(0)).alias("_total"))
    refresh_panels(spark, enriched_path, panels_path, materialize(after, "totals"), computed.select(*ENRICHED_COLUMNS))
    return {"symbols": symbols, "blocks": blocks, "rows": n_rows, "years": len(replaced)}
