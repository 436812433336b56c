"""Operator 12: hard negatives by threshold joins with an inverted index.

An anchor's positives are its nearest rows of the same label; a positive's
negatives are the nearest rows of other labels whose score lies in a window
below the positive's. Both are windows over scores of which the first k rows
are wanted, and both are filled the same way: a window is first searched from
a high threshold, and the threshold is lowered, for the windows that are not
full yet, until they are or their own end is reached.

A search joins anchors with tiles of rows. A tile has an inverted index over
its dimensions, strongest first, in steps of ``STEP``. A row's last dimensions
are left out of it from the point where the norm of the row's rest times the
anchors' is below every threshold: alone they can't reach one. Partial scores
are accumulated along the index; rows that no anchor can reach any more, by
the norms of what remains, are dropped on the way, and only rows with a pair
that can still reach its threshold are completed from their unindexed rest.
A task raises a window's threshold to its own k-th best score, once it has k.

Anchors go out in waves of bounded size. A wave's lists are merged, written,
and its broadcast destroyed before the next wave is collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh, materialize, ship_package, table
from .topk import products

POSITIVES, NEGATIVES, LOW, HIGH, SCALE = 5, 10, 30, 90, 256
#: Numbers of the anchors of one wave; anchors and rows of a tile; dimensions of a step.
WAVE_NUMBERS, BLOCK, TILE, STEP = 8_000_000, 512, 4096, 8
#: Thresholds of a search for positives, as shares of the greatest possible
#: score, and of one for negatives, as shares of the window from its top.
POSITIVE_STEPS, NEGATIVE_STEPS = (0.5, 0.25, 0.125), (1 / 16, 1 / 4)
_LEAST, _MOST = -(1 << 63) + 1, (1 << 63) - 1
_EXACT = 2.0 ** 53
LISTS = "a_row long, slot long, vec_id long, row long, score long"


def remaining(v: np.ndarray, borders: list[int]) -> np.ndarray:
    """Norms of each row from every border to its end, rounded up a little."""
    squares = np.cumsum((v * v)[:, ::-1], axis=1)[:, ::-1]
    squares = np.concatenate([squares, np.zeros((len(v), 1))], axis=1)
    return np.sqrt(squares[:, borders]) * (1 + 1e-9)


def reaching(a: np.ndarray, c: np.ndarray, least: np.ndarray, step: int = STEP):
    """All pairs (i, j, score) with ``a[i] . c[j] >= least[i]``, whole numbers
    held as doubles. Found by the index where sums are exact in doubles, else
    by products of whole numbers."""
    most = np.abs(a).max(initial=0) * np.abs(c).max(initial=0) * a.shape[1]
    if not most < _EXACT:
        scores = products(a, c)
        i, j = np.nonzero(scores >= least[:, None])
        return i, j, scores[i, j]
    borders = [*range(0, a.shape[1], step), a.shape[1]]
    steps = len(borders) - 1
    order = np.argsort(-(c * c).sum(axis=0), kind="stable")
    a, c, t = a[:, order], c[:, order], least.astype(np.float64)
    rest_a, rest_c = remaining(a, borders), remaining(c, borders)
    with np.errstate(divide="ignore", invalid="ignore"):
        limit = np.where(rest_a > 0, t[:, None] / rest_a, np.where(t > 0, np.inf, -np.inf)[:, None])
    limit = limit.min(axis=0)
    # steps of each row that the index holds; the rest can't reach a threshold alone
    depth = (rest_c[:, :steps] >= limit[:steps]).sum(axis=1)
    rows = np.argsort(-depth, kind="stable")[:np.count_nonzero(depth)]

    def alive(upto: int) -> np.ndarray:
        seen = np.minimum(depth[rows], upto)
        return (scores + rest_a[:, seen] * rest_c[rows, seen] >= t[:, None]).any(axis=0)

    scores = np.zeros((len(a), len(rows)))
    for k in range(steps):
        n = int(np.searchsorted(-depth[rows], -k, side="left"))  # rows whose index goes beyond k
        if n:
            scores[:, :n] += a[:, borders[k]:borders[k + 1]] @ c[rows[:n], borders[k]:borders[k + 1]].T
        if k + 1 == steps or (k + 1) & k == 0:
            keep = alive(k + 1)
            if not keep.all():
                rows, scores = rows[keep], scores[:, keep]
    for k in np.unique(depth[rows]):  # the unindexed rest of what is left
        if k < steps:
            part = np.nonzero(depth[rows] == k)[0]
            scores[:, part] += a[:, borders[k]:] @ c[rows[part], borders[k]:].T
    i, j = np.nonzero(scores >= t[:, None])
    return i, rows[j], scores[i, j].astype(np.int64)


class Wave:
    """Anchors of one length with their windows, as arrays."""

    def __init__(self, asked: pa.Table, length: int):
        self.row = asked.column("a_row").to_numpy()
        self.label = np.asarray(asked.column("label").to_pylist())
        flat = asked.column("v").combine_chunks().flatten().to_numpy()
        self.v = flat.reshape(-1, length)
        windows = asked.column("windows").to_pylist()
        shape = (len(windows), max(map(len, windows)))
        self.slot = np.zeros(shape, np.int64)
        self.low, self.high = np.full(shape, _MOST), np.full(shape, _LEAST)
        for i, own in enumerate(windows):
            for w, x in enumerate(own):
                self.slot[i, w], self.low[i, w], self.high[i, w] = x["slot"], x["low"], x["high"]


class Lists:
    """The best rows so far of every window of a block of anchors."""

    def __init__(self, wave: Wave, part: slice, k: int, same: bool):
        self.k, self.same = k, same
        self.row, self.label, self.slot = wave.row[part], wave.label[part], wave.slot[part]
        self.v = wave.v[part].astype(np.float64)
        self.low, self.high = wave.low[part].copy(), wave.high[part]
        self.best = tuple(np.empty(0, np.int64) for _ in range(4))  # window, score, vec_id, row

    def add(self, row: np.ndarray, vec_id: np.ndarray, label: np.ndarray, v: np.ndarray) -> None:
        i, j, score = reaching(self.v, v, self.low.min(axis=1))
        ok = ((self.label[i] == label[j]) == self.same) & (self.row[i] != row[j])
        i, j, score = i[ok], j[ok], score[ok]
        found, width = [self.best], self.slot.shape[1]
        for w in range(width):
            ok = (score >= self.low[i, w]) & (score <= self.high[i, w])
            found.append((i[ok] * width + w, score[ok], vec_id[j[ok]], row[j[ok]]))
        window, score, ids, rows = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((rows, ids, -score, window))
        place = np.arange(len(order)) - np.searchsorted(window[order], window[order])
        order, place = order[place < self.k], place[place < self.k]
        self.best = window[order], score[order], ids[order], rows[order]
        full = order[place == self.k - 1]  # the k-th best is the least that still counts
        np.maximum.at(self.low.reshape(-1), window[full], score[full])

    def rows(self) -> pa.RecordBatch:
        window, score, ids, rows = self.best
        width = self.slot.shape[1]
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (self.row[window // width], self.slot.reshape(-1)[window], ids, rows, score)],
            names=["a_row", "slot", "vec_id", "row", "score"])


def search(rows: DataFrame, asked: DataFrame, k: int, same: bool, wave_numbers: int = WAVE_NUMBERS,
           block: int = BLOCK, tile: int = TILE) -> DataFrame:
    """The first k rows of every window of ``asked`` (a_row, label, v, windows:
    array of (slot, low, high)), as (a_row, slot, rank, vec_id, row, score)."""
    spark = rows.sparkSession
    numbers = asked.agg(F.sum(F.size("v"))).first()[0] or 0
    waves = max(1, -(-numbers // wave_numbers))
    order = Window.partitionBy("a_row", "slot").orderBy(F.desc("score"), "vec_id", "row")
    out = None
    for wave in range(waves):
        part = asked.where(F.pmod(F.xxhash64("a_row"), F.lit(waves)) == wave).toArrow()  # bounded by the wave
        length = np.array([len(x) for x in part.column("v")], np.int64)
        held = spark.sparkContext.broadcast(
            {int(n): Wave(part.filter(pa.array(length == n)), int(n)) for n in np.unique(length)})

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            lists: dict[int, list[Lists]] = {}
            for batch in batches:
                v = batch.column("v")
                size = np.diff(v.offsets.to_numpy())
                ids = [batch.column(x).to_numpy() for x in ("row", "vec_id")]
                label = np.asarray(batch.column("label").to_pylist())
                for n in np.unique(size):
                    n = int(n)
                    if n not in held.value:
                        continue
                    if n not in lists:
                        lists[n] = [Lists(held.value[n], slice(at, at + block), k, same)
                                    for at in range(0, len(held.value[n].row), block)]
                    mine = np.nonzero(size == n)[0]
                    for at in range(0, len(mine), tile):
                        some = mine[at:at + tile]
                        flat = v.take(pa.array(some)).flatten().to_numpy().astype(np.float64)
                        for own in lists[n]:
                            own.add(ids[0][some], ids[1][some], label[some], flat.reshape(-1, n))
            for own in lists.values():
                yield from (x.rows() for x in own)

        found = rows.select("row", "vec_id", "label", "v").mapInArrow(run, LISTS)
        found = materialize(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k),
                            "negative_lists")
        held.destroy()
        out = found if out is None else out.unionByName(found)
    return out


def fill(rows: DataFrame, anchors: DataFrame, windows: DataFrame, k: int, same: bool, **how) -> DataFrame:
    """The first k rows of every window (a_row, slot, high, steps): searched
    from the first of its ``steps``, then from the lower ones while it isn't
    full; the last step is the window's own end."""
    last = F.col("steps")[F.size("steps") - 1]
    count = windows.agg(F.max(F.size("steps"))).first()[0] or 0
    still, done = windows, []
    for at in range(count):
        low = F.col("steps")[at]
        asked = still.groupBy("a_row").agg(
            F.collect_list(F.struct("slot", low.alias("low"), "high")).alias("windows"))
        asked = materialize(asked.join(anchors, "a_row"), "negative_windows")
        found = search(rows, asked, k, same, **how)
        if at + 1 < count:
            full = found.where(F.col("rank") == k).select("a_row", "slot")
            still = materialize(still.where(low > last).join(full, ["a_row", "slot"], "left_anti"), "negative_open")
            found = found.join(still.select("a_row", "slot"), ["a_row", "slot"], "left_anti")
        done.append(found)
        if at + 1 < count and still.isEmpty():
            break
    out = done[0] if done else None
    for found in done[1:]:
        out = out.unionByName(found)
    return out


def hard_negatives(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding",
                   label_col: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH, scale: int = SCALE, **how) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score) for the rows of ``vectors`` where ``is_anchor`` holds.

    Components become floor(scale * x); a score is the integer inner product
    with the anchor; higher scores come first, ties by the smaller id. An
    anchor's positives are its first ``positives`` other rows of the same
    label; a positive's negatives are the first ``negatives`` rows of another
    label with low * positive <= 100 * score <= high * positive (in percent,
    0 <= low <= high), so a positive below zero has none. Fewer rows give
    shorter lists; an empty table gives none.

    Rows without an id or a label, and vectors that are null or empty or hold
    null, NaN or infinite components (after scaling as well), take no part.
    Vectors of another length than the anchor's are no candidates. Rows that
    repeat an id are rows of their own: each is a candidate, and an anchor for
    itself; only an anchor's own row is never its candidate. Scores beyond a
    long end at its limits. Other columns are not read.
    """
    ship_package(vectors.sparkSession)
    whole = "bigint" if dict(vectors.dtypes)[label_col] in ("tinyint", "smallint", "int", "bigint") else "string"
    flag = fresh(vectors, "_anchor")
    v = F.transform(F.col(vec_col).cast("array<double>"), lambda x: F.lit(float(scale)) * x)
    rows = vectors.withColumn(flag, F.coalesce(is_anchor, F.lit(False))).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast(whole).alias("label"),
        F.col(flag).alias("anchor"), v.alias("v"))
    bad = F.exists("v", lambda x: F.coalesce(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(True)))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0) & ~bad)
    # floor() of a double is a long in Spark, too short for large components
    rows = rows.withColumn("v", F.transform("v", lambda x: F.when(F.abs(x) < _EXACT, F.floor(x).cast("double")).otherwise(x)))
    most = rows.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0] or 0.0
    kind = "smallint" if most < 2 ** 15 else "int" if most < 2 ** 31 else "double"
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    rows = materialize(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "anchor",
                                   F.col("v").cast(f"array<{kind}>").alias("v"), norm.alias("norm")), "negative_rows")
    anchors = rows.where("anchor").select(F.col("row").alias("a_row"), F.col("vec_id").alias("anchor_id"), "label",
                                          "v", "norm")
    longest = rows.agg(F.max("norm")).first()[0] or 0.0

    def bound(share: float) -> Column:
        return F.least(F.lit(share * longest) * F.col("norm"), F.lit(2.0 ** 62)).cast("long")

    nearest = fill(rows, anchors, anchors.select(
        "a_row", F.lit(0).cast("long").alias("slot"), F.lit(_MOST).alias("high"),
        F.array(*map(bound, POSITIVE_STEPS), F.lit(_LEAST)).alias("steps")), positives, True, **how)
    if nearest is None:  # no rows at all
        nearest = vectors.sparkSession.createDataFrame([], LISTS)
    chosen = materialize(nearest.join(anchors.select("a_row", "anchor_id"), "a_row").where(F.col("score") >= 0).select(
        "a_row", "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("slot")), "negative_positives")
    part, over = F.expr("slot div 100"), F.pmod(F.col("slot"), F.lit(100))
    top = part * high + F.floor(over * high / 100).cast("long")
    end = part * low + F.ceil(over * low / 100).cast("long")
    steps = [top - F.floor((top - end) * share).cast("long") for share in NEGATIVE_STEPS]
    windows = chosen.select("a_row", "slot").distinct().select(
        "a_row", "slot", top.alias("high"), F.array(*steps, end).alias("steps"))
    lists = fill(rows, anchors, windows.where(F.col("steps")[len(steps)] <= F.col("high")), negatives, False, **how)
    if lists is None:
        lists = vectors.sparkSession.createDataFrame([], f"{LISTS}, rank int")
    return chosen.join(lists, ["a_row", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
        F.col("slot").alias("positive_score"), F.col("score").alias("negative_score"))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    mislabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", mislabelled), F.col("vec_id") % 100 == 0)


OP12_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
s AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id AS vec_id, a.label = b.label AS same,
         CAST(list_sum([a.q[i] * b.q[i] FOR i IN range(1, len(a.q) + 1)]) AS BIGINT) AS score
  FROM v a JOIN v b ON a.r <> b.r AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0),
p AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) AS k FROM s WHERE same)
  WHERE k <= 5),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score,
         s.score AS negative_score,
         row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.vec_id) AS k
  FROM p JOIN s ON s.a = p.a AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, CAST(k AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE k <= 10
"""
