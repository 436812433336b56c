"""S16 at scale: a table's profile kept as sketches, one row a batch.

``add_sketches`` reads the batches that have no sketch yet and stores for each
of them the row count and, by column, nulls, least and greatest value, a
HyperLogLog sketch of its values and a KLL sketch of its numbers. Sketches
merge, so ``sketch_profile`` gives the whole table's profile from a row a
batch, whatever the table holds. Counts and ranges are exact; distinct counts
are within about 3% (twelve index bits, two standard errors), quantiles within
about 2% of the rows in rank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_or_empty

BY, HLL_BITS, KLL_K = "batch_id", 12, 200
#: Quantiles of numeric columns.
RANKS = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def _numeric(kind: str) -> bool:
    return kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal")


def sketches(df: DataFrame, by: str = BY) -> DataFrame:
    """One row for each value of ``by``: exact counts and ranges and sketches
    of every other column (``n_rows``; ``c<i>_n``, ``_lo``, ``_hi``, ``_hll``
    and, of numbers, ``_kll`` for the column at place i)."""
    parts = [F.count(F.lit(1)).alias("n_rows")]
    for i, (c, kind) in enumerate((c, k) for c, k in df.dtypes if c != by):
        x = F.col(c)
        parts += [F.count(x).alias(f"c{i}_n"), F.min(x).alias(f"c{i}_lo"), F.max(x).alias(f"c{i}_hi"),
                  F.hll_sketch_agg(x.cast("string"), HLL_BITS).alias(f"c{i}_hll")]
        if _numeric(kind):
            parts.append(F.kll_sketch_agg_double(x.cast("double"), KLL_K).alias(f"c{i}_kll"))
    return df.groupBy(by).agg(*parts)


def add_sketches(table: DataFrame, path: str, by: str = BY) -> int:
    """Sketch the batches of ``table`` that ``path`` does not have; gives
    their number. With ``by`` a partition column only their files are read."""
    spark = table.sparkSession
    known = read_or_empty(spark, path, f"{by} string").select(by)
    new = [r[0] for r in table.select(by).where(F.col(by).isNotNull()).distinct().join(known, by, "left_anti").collect()]
    if new:
        sketches(table.where(F.col(by).isin(new)), by).coalesce(1).write.mode("append").parquet(path)
    return len(new)


def sketch_profile(spark: SparkSession, path: str, columns: list[tuple[str, str]], by: str = BY) -> DataFrame:
    """The profile of all batches: one row a column (position, column_name,
    n_rows, n_nulls, min_value, max_value, n_distinct, p25, p50, p75) for
    ``columns``, the table's (name, type) pairs without ``by``."""
    merged = [F.sum("n_rows").alias("n_rows")]
    for i, (_, kind) in enumerate(columns):
        merged += [F.sum(f"c{i}_n").alias(f"c{i}_n"), F.min(f"c{i}_lo").alias(f"c{i}_lo"),
                   F.max(f"c{i}_hi").alias(f"c{i}_hi"), F.hll_union_agg(f"c{i}_hll").alias(f"c{i}_hll")]
        if _numeric(kind):
            merged.append(F.kll_merge_agg_double(f"c{i}_kll").alias(f"c{i}_kll"))
    whole = spark.read.parquet(path).agg(*merged)
    entries = []
    for i, (name, kind) in enumerate(columns):
        full = F.col(f"c{i}_n") > 0

        def rank(r: float, i=i, kind=kind, full=full):
            if not _numeric(kind):
                return F.lit(None).cast("double")
            return F.when(full, F.kll_sketch_get_quantile_double(f"c{i}_kll", F.lit(r)))
        entries.append(F.struct(
            F.lit(i).alias("position"), F.lit(name).alias("column_name"), F.col("n_rows").alias("n_rows"),
            (F.col("n_rows") - F.col(f"c{i}_n")).alias("n_nulls"), F.col(f"c{i}_lo").cast("string").alias("min_value"),
            F.col(f"c{i}_hi").cast("string").alias("max_value"),
            F.hll_sketch_estimate(f"c{i}_hll").alias("n_distinct"),
            *[rank(r).alias(name) for name, r in RANKS.items()]))
    return whole.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
