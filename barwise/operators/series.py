"""Per-symbol time-series primitives that spread one symbol over many tasks.

A window ``PARTITION BY symbol`` puts a whole symbol in one task. Here a
series is instead cut into fixed blocks of rows:

* ``running_sums`` / ``with_row_index``: prefix sums (and the 0-based row
  position) per key in date order. Totals are taken per (key, calendar
  month), a small table, offset by a window over months, and finished inside
  each (key, month) group, which holds at most 31 rows once (key, date) is
  unique.
* ``prepare_series``: row position ``_i``, block ``_blk = _i div B`` and a
  copy of the last ``halo`` rows of every block in the next block
  (``_halo = true``). Any lag or trailing sum reaching back up to ``halo``
  rows is then exact inside ``PARTITION BY key, _blk``; ``finish_series``
  drops the copies.
* ``geometric_columns`` (and ``ema_columns`` on top of it): exponential sums
  without recursion, ``G_t = q^u * sum_{k<=u} w_k x_k q^-k`` as a running
  sum over the partition. When the halo covers ``geometric_halo(q)`` rows
  (older weights below 1e-17) that is the whole answer: no join. With a
  shorter halo, what earlier blocks carry in is ``sum_l q^(B(l-1)) E(b-l)``,
  where ``E(b)`` is block b's sum seen from its last row (a plain per-block
  SUM), from a small per-block table joined back on (key, _blk).

No Python runs per row and no group grows with the length of a series.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

IDX = "_i"
BLK = "_blk"
HALO = "_halo"
DEFAULT_BLOCK = 2048
DEFAULT_HALO = 200
_BKT = "_bkt"
# A fixed value of the data model: weights below this share of the newest one
# are left out of an EMA. It is a tenth of what a double can still tell apart
# from 1, so no result on finite prices shows it.
_EMA_TAIL = 1e-17
# the halo may add this share of copied rows; beyond it, sums are carried
_MAX_COPIES = 0.25
# largest exponent kept inside a block, far from double overflow (~709)
_MAX_EXPONENT = 700.0


def _month_bucket(order: str) -> Column:
    return F.year(F.col(order)) * 12 + F.month(F.col(order))


def running_sums(df: DataFrame, key: str, order: str,
                 values: dict[str, Column]) -> DataFrame:
    """Add inclusive running sums of each expression per ``key`` by ``order``.

    ``order`` is a date, unique within ``key``. Sums of decimals stay exact.
    """
    b = df.select("*", _month_bucket(order).alias(_BKT),
                  *[expr.alias(f"_v_{name}") for name, expr in values.items()])
    totals = b.groupBy(key, _BKT).agg(
        *[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in values])
    before = Window.partitionBy(key).orderBy(_BKT).rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = totals.select(
        key, _BKT, *[F.sum(f"_t_{n}").over(before).alias(f"_o_{n}") for n in values])
    joined = b.join(offsets, [key, _BKT])
    inside = Window.partitionBy(key, _BKT).orderBy(order).rowsBetween(
        Window.unboundedPreceding, 0)
    out = joined.select(
        "*", *[(F.coalesce(F.col(f"_o_{n}"), F.lit(0))
                + F.sum(f"_v_{n}").over(inside)).alias(n) for n in values])
    helpers = [_BKT] + [f"_{p}_{n}" for n in values for p in "vo"]
    return out.drop(*helpers)


def with_row_index(df: DataFrame, key: str, order: str, out: str = IDX) -> DataFrame:
    """0-based position of each row within its key, in ``order`` order."""
    counted = running_sums(df, key, order, {out: F.lit(1)})
    return counted.withColumn(out, F.col(out) - 1)


def prepare_series(df: DataFrame, key: str, order: str,
                   halo: int = DEFAULT_HALO, block: int = DEFAULT_BLOCK) -> DataFrame:
    """Index rows and lay them out in halo blocks (see module docstring).

    A row is copied into every later block whose first ``halo`` preceding
    rows include it (one block when ``halo < block``).
    """
    if halo < 0:
        raise ValueError(f"halo must be >= 0: {halo}")
    if block < 1 or block & (block - 1):
        raise ValueError("block must be a power of two")
    indexed = with_row_index(df, key, order)
    own = F.floor(F.col(IDX) / block)
    last = F.floor((F.col(IDX) + halo) / block)
    meta = {"barwise": {"key": key, "order": order, "halo": halo, "block": block}}
    return (indexed
            .withColumn(BLK, F.explode(F.sequence(own, last)))
            .withMetadata(BLK, meta)
            .withColumn(HALO, F.col(BLK) != own))


def continue_series(df: DataFrame, starts: DataFrame, key: str, order: str, value: str,
                    halo: int = DEFAULT_HALO, block: int = DEFAULT_BLOCK) -> DataFrame:
    """``prepare_series`` for rows that go on where a stored series ended.

    ``starts`` has one row a key: ``n_rows``, how many rows came before, and
    ``tail``, their last values, oldest first (``halo`` of them, or all). The
    rows get the positions they have in the whole series, so blocks lie where
    they lie there; the tail stands before them as context, in the value
    column only. Keys without a row in ``starts`` begin a series.
    """
    if block < 1 or block & (block - 1):
        raise ValueError("block must be a power of two")
    ended = starts.select(key, F.col("n_rows").alias("_n0"), F.col("tail").alias("_tail"))
    first = F.coalesce(F.col("_n0"), F.lit(0))
    rows = with_row_index(df, key, order).join(ended.drop("_tail"), key, "left")
    rows = rows.withColumn(IDX, F.col(IDX) + first).withColumn(HALO, F.lit(False))
    context = ended.select(key, "_n0", F.size("_tail").alias("_m"), F.posexplode("_tail").alias("_pos", value)).select(
        key, "_n0", value, (F.col("_n0") - F.col("_m") + F.col("_pos")).alias(IDX), F.lit(True).alias(HALO))
    both = rows.unionByName(context, allowMissingColumns=True)
    own = F.floor(F.col(IDX) / block)
    last = F.floor((F.col(IDX) + halo) / block)
    meta = {"barwise": {"key": key, "order": order, "halo": halo, "block": block}}
    both = both.withColumn(BLK, F.explode(F.sequence(own, last))).withMetadata(BLK, meta)
    # context serves the blocks that have rows of their own
    both = both.where(~F.col(HALO) | (F.col(BLK) >= F.floor(first / block)))
    return both.withColumn(HALO, F.col(HALO) | (F.col(BLK) != own)).drop("_n0")


def carried_sums(starts: DataFrame, key: str, ratios: dict[str, float], block: int = DEFAULT_BLOCK) -> DataFrame:
    """Stored geometric sums of the last row before a continued series (one
    column a term, in ``starts``), as the end of the block before its first
    one: what ``geometric_columns`` carries in."""
    at = F.floor(F.col("n_rows") / block)
    past = F.col("n_rows") - at * block  # rows of the first block that came before
    return starts.where(F.col("n_rows") > 0).select(
        key, (at - 1).alias(BLK),
        *[(F.col(name) * F.pow(F.lit(q), -past)).alias(f"_e_{name}") for name, q in ratios.items()])


def series_meta(df: DataFrame) -> dict | None:
    if BLK not in df.columns:
        return None
    return df.schema[BLK].metadata.get("barwise")


def finish_series(df: DataFrame) -> DataFrame:
    return df.where(~F.col(HALO)).drop(IDX, BLK, HALO)


def usable(df: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """The rows that take part in a series: key, date and value are there and
    the value is a number. The others are left out before any window, so a
    gap never counts as a row or a zero."""
    ok = F.col(key).isNotNull() & F.col(order).isNotNull() & F.col(value).isNotNull()
    if dict(df.dtypes)[value] in ("double", "float"):
        ok = ok & ~F.isnan(value) & (F.abs(value) != float("inf"))
    return df.where(ok)


def geometric_layout(ratios: list[float]) -> tuple[int, int]:
    """(block, halo) for geometric sums with these ratios.

    The block is the largest that keeps all powers within a double's range.
    The halo covers the slowest ratio if that copies a quarter of the rows at
    most; otherwise it is 0 and earlier blocks are carried in by a join.
    """
    halo = max((geometric_halo(q) for q in ratios), default=0)
    steep = max((-math.log(q) for q in ratios if q > 0), default=0.0)
    block = DEFAULT_BLOCK
    while True:
        copies = halo if halo <= _MAX_COPIES * block else 0
        if block == 1 or steep * (block + copies) <= _MAX_EXPONENT:
            return block, copies
        block //= 2


def on_series(df: DataFrame, key: str, order: str, need: int, fn, want: int = 0,
              block: int = DEFAULT_BLOCK, value: str | None = None) -> DataFrame:
    """Run ``fn`` on a prepared frame whose halo covers ``need`` rows.

    A frame that is already prepared is used as is (composition shares one
    layout); otherwise rows without a usable ``value`` are left out, the rest
    is prepared with a halo of ``max(need, want)`` rows and finished around
    ``fn``.
    """
    meta = series_meta(df)
    if meta is not None:
        if meta["halo"] < need:
            raise ValueError(f"prepared halo {meta['halo']} < {need} rows needed")
        return fn(df, meta["key"])
    if value is not None:
        df = usable(df, key, order, value)
    prepared = prepare_series(df, key, order, halo=max(need, want, 0), block=block)
    return finish_series(fn(prepared, key))


def block_window(key: str) -> Window:
    return Window.partitionBy(key, BLK).orderBy(IDX)


def geometric_halo(q: float) -> int:
    """Rows after which a geometric weight ``q^k`` is below 1e-17 (0 for q=0)."""
    if q <= 0.0:
        return 0
    return math.ceil(-math.log(_EMA_TAIL) / -math.log(q))


def geometric_columns(df: DataFrame, terms: dict[str, tuple[str, float, int]],
                      outputs: dict[str, list[tuple[str, float]]], starts: DataFrame | None = None) -> DataFrame:
    """Add linear combinations of geometric sums to a prepared frame.

    A term ``name: (value, q, first)`` is
    ``G(t) = sum_{first<=k<=t} w_k x_k q^(t-k)`` with ``w_first = 1/(1-q)``
    and ``w_k = 1`` after it: the sum over a series whose values before
    ``first`` all equal ``x_first``. An EMA with smoothing ``a`` is
    ``a * G`` for ``q = 1 - a``. Each output ``out: [(term, coef), ...]`` is
    ``sum coef * G`` (NULL before the largest ``first`` used, and on halo
    rows).

    When the frame's halo holds ``geometric_halo(q)`` rows for every term,
    older rows weigh less than 1e-17 and each sum is finished inside its
    (key, block) partition: a running sum over the halo and block rows, no
    join. Otherwise what earlier blocks carry in comes from one per-block
    aggregate and one join of that small table. Either way all terms share
    one window pass. With ``starts`` (of ``carried_sums``; a frame of
    ``continue_series``) the rows before the first one are carried in, too.
    """
    meta = series_meta(df)
    if meta is None:
        raise ValueError("geometric_columns needs a prepared series frame")
    key, block, halo_rows = meta["key"], meta["block"], meta["halo"]
    idx, blk, halo = F.col(IDX), F.col(BLK), F.col(HALO)
    running = block_window(key).rowsBetween(Window.unboundedPreceding, 0)
    local = starts is None and all(geometric_halo(q) <= halo_rows for _, q, _ in terms.values())
    # position inside the partition: halo rows first, from 0
    r = idx - blk * block + (halo_rows if local else 0)
    span = block + (halo_rows if local else 0)
    partial, ends, lags = {}, {}, {}
    for name, (value, q, first) in terms.items():
        if not 0 <= q < 1:
            raise ValueError(f"q must be in [0, 1): {q}")
        # with the local form the halo rows are real history and count
        live = (idx >= first) if local else (~halo & (idx >= first))
        weight = F.when(idx == first, F.lit(1.0 / (1.0 - q))).otherwise(F.lit(1.0))
        x = weight * F.col(value).cast("double")
        if q == 0.0:
            partial[name] = F.when(live, x)
            continue
        decay = -math.log(q)
        if decay * span > _MAX_EXPONENT:
            raise ValueError(f"q {q} needs blocks of at most "
                             f"{int(_MAX_EXPONENT / decay) - (span - block)} rows")
        partial[name] = F.pow(F.lit(q), r) * F.sum(
            F.when(live, x * F.pow(F.lit(q), -r))).over(running)
        if not local:
            lags[name] = max(1, math.ceil(-math.log(_EMA_TAIL) / (decay * block)))
            # the in-block sum as seen from the block's last row
            ends[name] = F.sum(F.when(live, x * F.pow(F.lit(q), (block - 1) - r)))
    out_df = df.select("*", *[c.alias(f"_p_{n}") for n, c in partial.items()])
    if ends:
        per_block = (df.where(~halo).groupBy(key, BLK)
                     .agg(*[c.alias(f"_e_{n}") for n, c in ends.items()]))
        if starts is not None:
            per_block = per_block.unionByName(starts.select(key, BLK, *[f"_e_{n}" for n in ends]))
        by_block = Window.partitionBy(key).orderBy(BLK)
        carries = []
        for name in ends:
            q = terms[name][1]
            total = None
            for lag in range(1, lags[name] + 1):
                t = (F.lit(q ** (block * (lag - 1)))
                     * F.coalesce(F.lag(f"_e_{name}", lag).over(by_block), F.lit(0.0)))
                total = t if total is None else total + t
            carries.append(total.alias(f"_c_{name}"))
        out_df = out_df.join(per_block.select(key, BLK, *carries), [key, BLK], "left")
    full = {}
    for name, (value, q, first) in terms.items():
        if name in ends:
            full[name] = F.col(f"_p_{name}") + F.pow(F.lit(q), r + 1) * F.col(f"_c_{name}")
        else:
            full[name] = F.col(f"_p_{name}")
    cols = []
    for out, combo in outputs.items():
        first = max(terms[t][2] for t, _ in combo)
        val = None
        for t, coef in combo:
            part = F.lit(coef) * full[t]
            val = part if val is None else val + part
        cols.append(F.when(~halo & (idx >= first), val).alias(out))
    keep = [c for c in out_df.columns
            if not c.startswith(("_p_", "_c_")) and c not in outputs]
    return out_df.select(*keep, *cols)


def ema_columns(df: DataFrame, specs: list[tuple[str, float, str, int]]) -> DataFrame:
    """Add exponential moving averages to a prepared frame.

    Each spec is ``(value_column, alpha, out_column, first_index)``:
    ``e_first = x_first``, ``e_t = alpha*x_t + (1-alpha)*e_(t-1)``; NULL before
    ``first_index`` and on halo rows. Values must be non-null from
    ``first_index`` on.
    """
    terms, outputs = {}, {}
    for value, alpha, out, first in specs:
        if not 0 < alpha <= 1:
            raise ValueError(f"alpha must be in (0, 1]: {alpha}")
        terms[f"g_{out}"] = (value, 1.0 - alpha, first)
        outputs[out] = [(f"g_{out}", alpha)]
    return geometric_columns(df, terms, outputs)
