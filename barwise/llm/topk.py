"""Operator 9: exact top-k search by tiled matrix products.

Queries go out in waves of bounded size. Each task multiplies a wave with
its part of the vectors, tile by tile, keeps a tile's highest scores by
partial selection, and folds them into its running lists. The lists of all
tasks are merged in two levels: by query and branch, then by query. So what
is shuffled is k rows a query and task, never scores of all pairs. A wave's
lists are written and its broadcast destroyed before the next is collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, ship_package, table

K, QUERY_MOD, SCALE = 5, 50, 256
#: Numbers in one wave of queries (8 bytes each), rows of a tile, branches of the merge.
WAVE_NUMBERS, TILE, BRANCHES = 2_000_000, 4096, 32
_NONE, _LOW, _HIGH = np.iinfo(np.int64).max, -(1 << 63) + 1, (1 << 63) - 1


def quantise(vectors: list, scale: int = SCALE) -> np.ndarray:
    """Whole numbers floor(scale * x), held as doubles."""
    return np.floor(np.stack([np.asarray(v, np.float64) for v in vectors]) * scale)


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products of rows, as longs.

    Doubles add whole numbers exactly below 2^53; beyond, Python's integers
    do, and results past a long end at its limits."""
    most = (np.abs(q).max(initial=0)) * (np.abs(c).max(initial=0)) * q.shape[1]
    if most < 2.0 ** 53:
        return (q @ c.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in c]
    return np.array([[min(_HIGH, max(_LOW, sum(int(a) * b for a, b in zip(row, w)))) for w in whole]
                     for row in q], np.int64)


def select(row: np.ndarray, score: np.ndarray, vec_id: np.ndarray, key: np.ndarray, k: int):
    """The k best of each row: higher score, then smaller id, then smaller
    key; a key counts once, with its best score."""
    order = np.lexsort((key, vec_id, -score, row))
    row, score, vec_id, key = row[order], score[order], vec_id[order], key[order]
    again = np.lexsort((np.arange(len(row)), key, row))  # first of each (row, key)
    first = np.zeros(len(row), bool)
    a, b = row[again], key[again]
    first[again] = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))[:len(row)]
    row, score, vec_id, key = row[first], score[first], vec_id[first], key[first]
    keep = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[keep], score[keep], vec_id[keep], key[keep]


def tile_best(own: np.ndarray, q: np.ndarray, keys: np.ndarray, ids: np.ndarray, c: np.ndarray, k: int):
    """The best of one tile for each query (but the rows whose key is its own)."""
    scores = products(q, c)
    scores[own[:, None] == keys[None, :]] = np.iinfo(np.int64).min  # not itself
    repeats = len(keys) - len(np.unique(keys))
    n = k + 1 + repeats  # repeats of a key must not push others out
    if scores.shape[1] > n:
        least = np.partition(scores, scores.shape[1] - n, axis=1)[:, -n][:, None]
        row, col = np.nonzero(scores >= least)
    else:
        row, col = np.nonzero(np.ones(scores.shape, bool))
    s, v, key = scores[row, col], ids[col], keys[col]
    ok = s != np.iinfo(np.int64).min
    return select(row[ok], s[ok], v[ok], key[ok], k)


def _valid(df: DataFrame, id_col: str, vec_col: str, *more) -> DataFrame:
    df = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"), *more)
    bad = F.exists("v", lambda x: F.coalesce(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(True)))
    return df.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & ~bad)


def _search(rows: DataFrame, asked: DataFrame, by_id: bool, k: int, scale: int, wave_numbers: int,
            tile: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the best of ``rows`` (vec_id, key, v)
    for each of ``asked`` (vec_id, key, v) but the rows of its key; ``by_id``:
    queries of one id have one list."""
    spark = rows.sparkSession
    numbers = asked.agg(F.sum(F.size("v"))).first()[0] or 0
    waves = max(1, -(-numbers // wave_numbers))
    order = [F.desc("score"), F.asc("vec_id"), F.asc("key")]
    branch = Window.partitionBy("query", "branch").orderBy(*order)
    last = Window.partitionBy("query").orderBy(*order)
    out = None
    for w in range(waves):
        wave = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(waves)) == w).toPandas()  # bounded by the wave
        wave["query"] = pd.factorize(wave["vec_id"])[0] if by_id else np.arange(len(wave))
        by_size = {}
        for size, g in wave.groupby(wave["v"].map(len)):
            by_size[size] = (g["query"].to_numpy(), g["key"].to_numpy(), quantise(list(g["v"]), scale))
        held = spark.sparkContext.broadcast(by_size)

        def run(batches: Iterator[pd.DataFrame], held=held) -> Iterator[pd.DataFrame]:
            best = {}
            for pdf in batches:
                for size, g in pdf.groupby(pdf["v"].map(len)):
                    if size not in held.value:
                        continue
                    _, own, q = held.value[size]
                    for at in range(0, len(g), tile):
                        part = g.iloc[at:at + tile]
                        c = quantise(list(part["v"]), scale)
                        keys, ids = part["key"].to_numpy(), part["vec_id"].to_numpy()
                        for b in range(0, len(q), 1024):
                            new = tile_best(own[b:b + 1024], q[b:b + 1024], keys, ids, c, k)
                            old = best.get((size, b))
                            best[size, b] = new if old is None else select(
                                *(np.concatenate(x) for x in zip(old, new)), k)
            for (size, b), (row, score, vec_id, key) in best.items():
                yield pd.DataFrame({"query": held.value[size][0][b:b + 1024][row], "vec_id": vec_id, "key": key,
                                    "score": score})

        found = rows.mapInPandas(run, "query long, vec_id long, key long, score long")
        # a branch holds all rows of a key, so that keys repeated across tasks meet
        found = found.withColumn("branch", F.pmod("key", F.lit(BRANCHES)))
        found = found.groupBy("query", "branch", "vec_id", "key").agg(F.max("score").alias("score"))
        found = found.withColumn("k", F.row_number().over(branch)).where(F.col("k") <= k)
        found = found.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)
        named = spark.createDataFrame(wave[["query", "vec_id"]].drop_duplicates(), "query long, query_id long")
        found = materialize(found.join(named, "query").select("query_id", "rank", "vec_id", "score"), "top_lists")
        held.destroy()
        out = found if out is None else out.unionByName(found)
    return out


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: int = SCALE, wave_numbers: int = WAVE_NUMBERS, tile: int = TILE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of ``vectors`` with the
    highest integer inner product for each row of ``queries``, but the
    query's own id; ties go to the smaller id.

    Vectors that are null or empty or hold null, NaN or infinite components,
    and rows without an id, take no part. Vectors of another length than the
    query's are no candidates. An id given more than once counts once, by its
    best score. Fewer than k candidates give fewer rows.
    """
    ship_package(vectors.sparkSession)
    key = F.col(id_col).cast("long").alias("key")
    return _search(_valid(vectors, id_col, vec_col, key), _valid(queries, id_col, vec_col, key), True, k, scale,
                   wave_numbers, tile)


def top_k_rows(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding",
               scale: int = SCALE, wave_numbers: int = WAVE_NUMBERS, tile: int = TILE) -> DataFrame:
    """``top_k`` within one table: the queries are the rows where ``is_query``
    holds, and every row but the query's own is a candidate. Rows that repeat
    an id are rows of their own, as candidates and as queries."""
    ship_package(vectors.sparkSession)
    flag = F.coalesce(is_query, F.lit(False)).alias("asked")
    rows = materialize(_valid(vectors, id_col, vec_col, flag).withColumn("key", F.monotonically_increasing_id()),
                       "top_rows")
    return _search(rows.drop("asked"), rows.where("asked").drop("asked"), False, k, scale, wave_numbers, tile)


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k_rows(table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_MOD == 0)


OP9_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
p AS (
  SELECT a.r AS query, a.vec_id AS query_id, b.vec_id AS vec_id,
         CAST(list_sum([a.q[i] * b.q[i] FOR i IN range(1, len(a.q) + 1)]) AS BIGINT) AS score
  FROM v a JOIN v b ON a.r <> b.r AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS k FROM p)
SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM r WHERE k <= 5
"""
