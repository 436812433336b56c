"""I13 ``enrich``: raw bars -> the 21-column enriched table.

Plan: dedupe (aggregate on symbol, date) -> clean bars written once to the
checkpoint folder -> row position (small per-month table + groups of at most
31 rows) -> one shuffle on (symbol, block) with 509 halo rows per block -> one
sort shared by SMA 20/50/200, bands, RSI and MACD, all finished inside their
partition -> labels (narrow).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.filters import DATE, KEY
from ..operators.indicators import (CLOSE, band_values, bollinger_percent_value, exact_prices,
                                    gain_value, loss_value, macd, macd_halo, macd_terms, rsi_level_value,
                                    rsi_value, sliding_bands, sma_value,
                                    trading_signal_value, trend_value, with_delta, with_trailing)
from ..operators.series import HALO as HALO_ROW
from ..operators.series import (DEFAULT_BLOCK, IDX, carried_sums, continue_series, finish_series, prepare_series,
                                usable)
from ..schemas import ENRICHED_COLUMNS, RAW_TO_SERVED
from ..session import materialize
from ..sources.ingest import dedupe_latest_batch

# SMA 200 needs 200 earlier rows; MACD's slowest kernel (span 26) weighs less
# than 1e-17 after 509 rows, so with this halo every indicator is finished
# inside its (symbol, block) partition: no join after the one shuffle
HALO = max(200, macd_halo())


def to_served(bars: DataFrame) -> DataFrame:
    """Rename raw bar columns to the served names (before any window, so a
    symbol filter still reaches the scan)."""
    return bars.select(*[F.col(r).alias(s) for r, s in RAW_TO_SERVED.items()])


def indicators(served: DataFrame, block: int = DEFAULT_BLOCK) -> DataFrame:
    """All indicator and label columns on served bars (decimal prices give
    exact finite windows).

    The same formulas as the standalone operators, fused: one lag for the
    deltas, one trailing-sum pass for SMA 20/50/200, the bands and RSI, one
    geometric pass for MACD, and one select for the four labels.
    """
    p = prepare_series(served, KEY, DATE, halo=HALO, block=block)
    base = p.columns
    out = finish_series(_computed(p))
    return _labelled(out, [c for c in out.columns if c not in base or c in served.columns])


#: What a series' state holds of its closes, and the sums of MACD's kernels.
TAIL = 200
SUMS = {f"{name[1:]}_sum": q for name, (_, q, _) in macd_terms(12, 26, 9, CLOSE)[0].items()}


def indicators_after(served: DataFrame, starts: DataFrame, block: int = DEFAULT_BLOCK) -> DataFrame:
    """``indicators`` of rows that go on from stored states (``starts``: key,
    n_rows, tail, one column for each of ``SUMS``), with the row's position
    ``_i`` and its sums, which are the states to come.

    Only the new rows, the tails and the sums are read: windows reach back
    into the tail, and MACD's sums are carried in. Values equal those of the
    whole series."""
    p = continue_series(served, starts, KEY, DATE, CLOSE, halo=TAIL, block=block)
    terms = {f"_{name[:-4]}": q for name, q in SUMS.items()}
    ends = carried_sums(starts.withColumnsRenamed({name: f"_{name[:-4]}" for name in SUMS}), KEY, terms, block)
    out = _computed(p, ends, True).where(~F.col(HALO_ROW))
    return _labelled(out, [*served.columns, *[c for c in out.columns if c in ENRICHED_COLUMNS and c not in served.columns],
                           IDX, *SUMS])


def _computed(p: DataFrame, starts: DataFrame | None = None, sums: bool = False) -> DataFrame:
    """The indicators on a prepared frame."""
    x = F.col(CLOSE)
    exact = exact_prices(p, CLOSE)
    p = with_delta(p, CLOSE, KEY)
    windows = {"s20": (x, 20), "s50": (x, 50), "s200": (x, 200), "q20": (x * x, 20),
               "g14": (gain_value(), 14), "l14": (loss_value(), 14)}

    def outputs(t):
        return [sma_value(t["s20"], 20).alias("moyenne_mobile_20j"),
                sma_value(t["s50"], 50).alias("moyenne_mobile_50j"),
                sma_value(t["s200"], 200).alias("moyenne_mobile_200j"),
                *(band_values(t["s20"], t["q20"], 20, 2, 0) if exact else []),
                rsi_value(t["g14"], t["l14"], 14).alias("rsi_14")]
    p = with_trailing(p, windows, KEY, outputs, exact)
    if not exact:
        p = sliding_bands(p, KEY, 20)
    return macd(p, starts=starts, sums=sums).drop("_delta")


def _labelled(out: DataFrame, keep: list[str]) -> DataFrame:
    return out.select(*keep,
                      bollinger_percent_value().alias("bollinger_percent"),
                      trend_value().alias("tendance_globale"),
                      rsi_level_value().alias("niveau_rsi"),
                      trading_signal_value().alias("signal_trading"))


def as_enriched(out: DataFrame, run_ts: dt.datetime | None, also: list[str] = ()) -> DataFrame:
    """Computed bars in the contract's 21 columns (and ``also``)."""
    run_ts = run_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    prices = ("prix_ouverture", "prix_haut", "prix_bas", "prix_fermeture")
    cols = [F.col(c).cast("double").alias(c) if c in prices else F.col(c)
            for c in ENRICHED_COLUMNS[:-1]]
    return out.select(*cols, F.lit(run_ts).cast("timestamp").alias("horodatage_calcul"), *also)


def enrich(raw: DataFrame, run_ts: dt.datetime | None = None,
           block: int = DEFAULT_BLOCK) -> DataFrame:
    """Raw bars (any batches, or none) -> enriched bars in the contract's 21
    columns, one row per (symbol, date). Rows without a key are left out, and
    so are those without a finite close: they have no indicators."""
    # keys are NOT NULL in the raw table; a bar without a close has no indicators
    bars = usable(dedupe_latest_batch(raw), "symbol", "date", "close")
    # the series layout joins the bars back to small per-month and per-block
    # tables; write the clean bars once so the raw input is read only once
    bars = materialize(bars, "clean_bars")
    return as_enriched(indicators(to_served(bars), block), run_ts)
