"""Operator 6: quality by a generalised additive model with pair terms.

A text becomes some twenty numbers (lengths, shares of character classes,
repetition). Each number is cut into bins. Cyclic boosting visits the
features one after the other, fits a tree of few leaves on one feature's
gradient histogram and adds a small step of it to that feature's lookup
table; then the most useful pairs of features are boosted the same way on
two-way tables. A score is a sum of table look-ups, done for all rows of a
batch at once.

The model is fitted on a bounded sample of labelled rows (``max_rows``, the
rows of smallest hash); it scores every row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, ship_package, table

FEATURES = [
    "log_chars", "log_words", "word_chars", "upper", "digit", "stop_comma", "exclaim", "symbol", "pipe",
    "space", "newline", "non_ascii", "distinct_words", "top_word", "same_next", "repeated_pairs",
    "repeated_lines", "sentence_words", "short_words", "entropy", "longest_word", "line_chars",
]
MAX_ROWS, THRESHOLD = 20_000, 0.3
_STOP = re.compile(r"[.!?]+(?:\s|$)")
_SYMBOLS = np.frombuffer(b"#$%&*@^~=<>{}[]\\/_+`;:", np.uint8)


def features(text: str | None) -> list[float]:
    """The numbers of one text, in the order of ``FEATURES``."""
    data = (text or "").encode("utf-8", "replace")
    words = data.split()
    if not words:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n, w = len(data), len(words)
    share = counts[counts > 0] / n
    code = np.fromiter(map(hash, words), np.int64, w)
    # hash() of bytes differs between workers; only equality is looked at
    _, again = np.unique(code, return_counts=True)
    pairs = len(np.unique(code[:-1] * 31 + code[1:])) if w > 1 else 1
    lines = [x for x in data.split(b"\n") if x.strip()]
    sizes = np.fromiter(map(len, words), np.int64, w)
    return [
        float(np.log1p(n)), float(np.log1p(w)), float(sizes.mean()), counts[65:91].sum() / n, counts[48:58].sum() / n,
        (counts[46] + counts[44]) / n, (counts[33] + counts[63]) / n, counts[_SYMBOLS].sum() / n, counts[124] / n,
        counts[32] / n, counts[10] / n, counts[128:].sum() / n, len(again) / w, again.max() / w,
        float((code[1:] == code[:-1]).sum()) / w, 1 - pairs / max(1, w - 1), 1 - len(set(lines)) / len(lines),
        w / (1 + len(_STOP.findall(text))), float((sizes <= 2).mean()),
        float(-(share * np.log2(share)).sum()), float(np.log1p(sizes.max())), float(np.log1p(n / len(lines))),
    ]


def _leaves(grad: np.ndarray, hess: np.ndarray, leaves: int, least: float) -> np.ndarray:
    """A tree of ``leaves`` leaves over ordered bins; the step of each bin."""
    parts = [(0, len(grad))]
    while len(parts) < leaves:
        best = (1e-9, None, None)
        for i, (a, b) in enumerate(parts):
            g, h = np.cumsum(grad[a:b]), np.cumsum(hess[a:b])
            left, right = slice(None, -1), None
            if b - a < 2:
                continue
            gl, hl = g[left], h[left]
            gr, hr = g[-1] - gl, h[-1] - hl
            gain = gl ** 2 / (hl + 1) + gr ** 2 / (hr + 1) - g[-1] ** 2 / (h[-1] + 1)
            gain[(hl < least) | (hr < least)] = 0
            at = int(gain.argmax())
            if gain[at] > best[0]:
                best = (gain[at], i, a + at + 1)
            del right
        if best[1] is None:
            break
        a, b = parts[best[1]]
        parts[best[1]:best[1] + 1] = [(a, best[2]), (best[2], b)]
    out = np.zeros(len(grad))
    for a, b in parts:
        out[a:b] = grad[a:b].sum() / (hess[a:b].sum() + 1)
    return out


@dataclass
class AdditiveModel:
    """Lookup tables: one a feature, one a chosen pair of features."""

    edges: list[np.ndarray]
    base: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1 for rows of features."""
        total = np.full(len(x), self.base)
        for f, (edges, values) in enumerate(zip(self.edges, self.tables)):
            total += values[np.searchsorted(edges, x[:, f], side="right")]
        for (a, b), values in zip(self.pairs, self.pair_tables):
            total += values[np.searchsorted(self.pair_edges[a], x[:, a], side="right"),
                            np.searchsorted(self.pair_edges[b], x[:, b], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(col: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(col, np.linspace(0, 1, bins + 1)[1:-1]))


def fit(x: np.ndarray, y: np.ndarray, bins: int = 48, rounds: int = 150, pair_bins: int = 10, pairs: int = 8,
        pair_rounds: int = 60, rate: float = 0.1, leaves: int = 3, least: float = 2.0) -> AdditiveModel:
    """Fit on rows ``x`` with labels ``y`` (0 or 1). Without rows of both
    labels the score is the same for every text: the smoothed share of 1."""
    share = (float(y.sum()) + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    empty = [np.empty(0)] * len(FEATURES)
    model = AdditiveModel(empty, base, [np.zeros(1) for _ in FEATURES])
    if len(np.unique(y)) < 2:
        return model
    model.edges = [_edges(c, bins) for c in x.T]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    codes = [np.searchsorted(e, c, side="right") for e, c in zip(model.edges, x.T)]
    total = np.full(len(y), base)

    def gradients():
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for f, code in enumerate(codes):
            size = len(model.tables[f])
            if size < 2:
                continue
            g, h = gradients()
            step = rate * _leaves(np.bincount(code, g, size), np.bincount(code, h, size), leaves, least)
            model.tables[f] += step
            total += step[code]
    # pairs by what a free two-way table would still gain
    model.pair_edges = [_edges(c, pair_bins) for c in x.T]
    small = [np.searchsorted(e, c, side="right") for e, c in zip(model.pair_edges, x.T)]
    sizes = [len(e) + 1 for e in model.pair_edges]
    g, h = gradients()
    gains = []
    for a in range(len(FEATURES)):
        for b in range(a + 1, len(FEATURES)):
            cell = small[a] * sizes[b] + small[b]
            gg, hh = np.bincount(cell, g, sizes[a] * sizes[b]), np.bincount(cell, h, sizes[a] * sizes[b])
            gains.append((float((gg ** 2 / (hh + 1)).sum()), a, b))
    model.pairs = [(a, b) for _, a, b in sorted(gains, reverse=True)[:pairs]]
    model.pair_tables = [np.zeros((sizes[a], sizes[b])) for a, b in model.pairs]
    for _ in range(pair_rounds):
        for k, (a, b) in enumerate(model.pairs):
            g, h = gradients()
            shape = model.pair_tables[k].shape
            cell = small[a] * shape[1] + small[b]
            gg = np.bincount(cell, g, shape[0] * shape[1]).reshape(shape)
            hh = np.bincount(cell, h, shape[0] * shape[1]).reshape(shape)
            # one split of the first feature, then a small tree on the second
            gl, hl = np.cumsum(gg.sum(1)), np.cumsum(hh.sum(1))
            gain = (gl ** 2 / (hl + 1) + (gl[-1] - gl) ** 2 / (hl[-1] - hl + 1))[:-1]
            cut = int(gain.argmax()) + 1 if len(gain) else shape[0]
            step = np.zeros(shape)
            for rows in (slice(0, cut), slice(cut, shape[0])):
                if gg[rows].size:
                    step[rows] = rate * _leaves(gg[rows].sum(0), hh[rows].sum(0), 2, least)
            model.pair_tables[k] += step
            total += step[small[a], small[b]]
    return model


def train(docs: DataFrame, labels: DataFrame, held_out_mod: int | None = 5, max_rows: int = MAX_ROWS,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", **how) -> AdditiveModel:
    """Fit on labelled documents, at most ``max_rows`` of them.

    With ``held_out_mod`` m, documents whose crc32(id as text) mod m is 0 are
    left out. A document labelled more than once takes the more frequent
    label (1 on a tie); one given more than once counts once. Null ids and
    labels are not used.
    """
    ship_package(docs.sparkSession)
    labels = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("y"))
    labels = labels.where("doc_id is not null and y is not null")
    if held_out_mod:
        labels = labels.where(crc_mod("doc_id", held_out_mod) != 0)
    labels = labels.groupBy("doc_id").agg((F.avg("y") >= 0.5).cast("double").alias("y"))
    # labels may cover documents that the table no longer has
    labels = labels.join(docs.select(F.col(id_col).cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi")
    chosen = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)  # the bound of the broadcast
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "y": pdf["y"], "x": [features(t) for t in pdf["text"]]})

    rows = (texts.join(F.broadcast(chosen), "doc_id")
            .mapInPandas(run, "doc_id long, y double, x array<double>")
            .groupBy("doc_id").agg(F.min(F.struct("x", "y")).alias("r")).select("doc_id", "r.x", "r.y").toPandas())
    rows = rows.sort_values("doc_id")
    x = np.array(rows["x"].tolist(), float).reshape(-1, len(FEATURES))
    return fit(x, rows["y"].to_numpy(float), **how)


def score(docs: DataFrame, model: AdditiveModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) for every row; null and empty texts are scored as
    texts without words. Repeated rows get equal scores."""
    ship_package(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                x = np.array([features(t) for t in pdf["text"]], float)
                yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "score": held.value.score(x)})

    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return docs.mapInPandas(run, "doc_id long, score double")


def filter_quality(docs: DataFrame, model: AdditiveModel, text_col: str = "text",
                   threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, as they were."""
    ship_package(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            x = np.array([features(t) for t in texts], float).reshape(-1, len(FEATURES))
            yield pd.Series(held.value.score(x))

    scored = F.pandas_udf(scores, "double", functionType=F.PandasUDFType.SCALAR_ITER)
    return docs.where(scored(F.col(text_col).cast("string")) >= threshold)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
