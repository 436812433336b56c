"""Operator 8: benchmark decontamination by suffix arrays of training shards.

The test items are the queries. Each task turns its documents into shards of
word ids, builds the suffix array of every shard (positions sorted by the
words that follow, by rank doubling) and binary-searches all test suffixes in
it at once. A range of equal prefixes gives every place of a window; windows
that follow each other in item and document join to the longest verbatim
match. Documents stay whole in their shard, so the result needs no shuffle.

Words that no test item has can't be part of a match: they get id 0 and end
every suffix, and runs of known words shorter than the shortest window are
not indexed.

The test items are sent to the executors in blocks of bounded size; a larger
benchmark takes more passes over the documents, not more memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keyed, lower_words, materialize, ship_package, table

#: Words of a window, and the share of hit words (1 in ...) that contaminates.
WINDOW, SHARE = 13, 20
#: Words of test items that are sent out at once, and words of a shard.
BLOCK_WORDS, SHARD_WORDS = 2_000_000, 1_000_000


class Queries:
    """The distinct windows of a block of test items."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        texts: dict[tuple[bytes, ...], set[str]] = {}
        for item_id, text in items:
            words = tuple(lower_words(text))
            if words:
                texts.setdefault(words, set()).add(item_id)
        self.ids = [sorted(x) for x in texts.values()]
        rows, self.least = [], window
        for k, words in enumerate(texts):
            codes = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words]
            self.least = min(self.least, len(codes))
            for p in range(max(1, len(codes) - window + 1)):
                part = codes[p:p + window]
                rows.append(part + [0] * (window - len(part)) + [k, p])
        m = np.array(rows, np.int32).reshape(-1, window + 2)
        # windows sorted; each distinct one knows the (item, position) pairs that have it
        m = m[np.lexsort(m.T[::-1])] if len(m) else m
        new = np.ones(len(m), bool)
        new[1:] = (m[1:, :window] != m[:-1, :window]).any(axis=1)
        self.windows = m[new, :window]
        self.lengths = (self.windows > 0).sum(axis=1)
        self.first = np.append(np.flatnonzero(new), len(m))
        self.item, self.place = m[:, window].copy(), m[:, window + 1].copy()


def suffix_array(ids: np.ndarray, least: int, depth: int) -> np.ndarray:
    """Positions of known words in runs of ``least`` or more, sorted by the
    next ``depth`` words. 0 ends a run; ``ids`` ends with ``depth`` zeros."""
    stops = np.flatnonzero(ids == 0)
    gaps = np.diff(stops, prepend=-1) - 1
    long = gaps >= least
    if not long.any():
        return np.empty(0, np.int64)
    size = gaps[long]
    pos = np.repeat(stops[long] - size, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    rank = np.zeros(len(ids) + depth, np.int64)
    rank[pos] = ids[pos]
    step = 1
    while True:
        key = rank[pos] * (len(ids) + int(rank.max()) + 2) + (rank[pos + step] if step > 0 else 0)
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.empty(len(pos), np.int64)
        new[order] = np.cumsum(np.concatenate(([1], (ordered[1:] != ordered[:-1]).astype(np.int64))))
        step *= 2
        if step >= depth or new.max() == len(pos):
            return pos[order]
        rank[pos] = new


def _below(ids, at, windows, lengths, equal: bool) -> np.ndarray:
    """Whether the suffix at ``at`` sorts before its window (or, with
    ``equal``, before or as a continuation of it)."""
    have = ids[at[:, None] + np.arange(windows.shape[1])]
    diff = (have != windows) & (np.arange(windows.shape[1]) < lengths[:, None])
    col = diff.argmax(axis=1)
    row = np.arange(len(at))
    differs = diff[row, col]
    return np.where(differs, have[row, col] < windows[row, col], equal)


def search(ids: np.ndarray, q: Queries) -> tuple[np.ndarray, np.ndarray]:
    """(window, position) of every place of every window in a shard."""
    sa = suffix_array(ids, q.least, 1 << (q.window - 1).bit_length())
    if not len(sa) or not len(q.windows):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    bounds = []
    for equal in (False, True):
        lo, hi = np.zeros(len(q.windows), np.int64), np.full(len(q.windows), len(sa))
        while (open_ := np.flatnonzero(lo < hi)).size:
            mid = (lo[open_] + hi[open_]) // 2
            less = _below(ids, sa[mid], q.windows[open_], q.lengths[open_], equal)
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]
        bounds.append(lo)
    n = bounds[1] - bounds[0]
    which = np.repeat(np.arange(len(n)), n)
    at = sa[np.repeat(bounds[0], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
    return which, at


def scan_shard(docs: list[np.ndarray], q: Queries) -> list[tuple[list, list, list]]:
    """For each document (word ids): hit intervals, item ids, longest matches."""
    ends = np.cumsum([len(d) + 1 for d in docs])
    pad = np.zeros(2 * q.window + 4, np.int32)
    ids = np.concatenate([x for d in docs for x in (d, pad[:1])] + [pad])
    which, at = search(ids, q)
    out = [([], [], []) for _ in docs]
    if not len(at):
        return out
    size = q.lengths[which]
    cover = np.zeros(len(ids) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + size, -1)
    hit = np.concatenate(([0], (np.cumsum(cover) > 0).astype(np.int8)))
    step = np.diff(hit)
    starts, stops = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    begins = ends - np.array([len(d) + 1 for d in docs])
    for s, e, d in zip(starts, stops, np.searchsorted(ends, starts, side="right")):
        out[d][0].append((int(s - begins[d]), int(e - begins[d])))
    # one row for each (item, place in the item, place in the shard)
    n = q.first[which + 1] - q.first[which]
    pick = np.repeat(q.first[which], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    item, shift, pos, size = q.item[pick], np.repeat(at, n) - q.place[pick], np.repeat(at, n), np.repeat(size, n)
    order = np.lexsort((pos, shift, item))
    item, shift, pos, size = item[order], shift[order], pos[order], size[order]
    new = np.ones(len(item), bool)
    new[1:] = (item[1:] != item[:-1]) | (shift[1:] != shift[:-1]) | (pos[1:] != pos[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(item)) - 1
    for k, s, e, d in zip(item[first], pos[first], pos[last] + size[last],
                          np.searchsorted(ends, pos[first], side="right")):
        for i in q.ids[k]:
            out[d][1].append(i)
            out[d][2].append((i, int(s - begins[d]), int(e - s)))
    return [(a, sorted(set(b)), c) for a, b, c in out]


_SCHEMA = ("doc_id long, text_hash long, n_words long, hits array<struct<s:int,e:int>>, items array<string>, "
           "matches array<struct<item_id:string,start:int,length:int>>")


def _pass(docs: DataFrame, q, shard_words: int) -> DataFrame:
    """``q``: a broadcast of a block's queries."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queries = q.value
        get = queries.vocab.get

        def done(rows, shard):
            found = scan_shard(shard, queries)
            return pd.DataFrame({
                "doc_id": [r[0] for r in rows], "text_hash": [r[1] for r in rows],
                "n_words": [len(s) for s in shard], "hits": [f[0] for f in found],
                "items": [f[1] for f in found], "matches": [f[2] for f in found]}).astype({"doc_id": "Int64"})

        rows, shard, size = [], [], 0
        for pdf in batches:
            for doc_id, text_hash, text in zip(pdf["doc_id"], pdf["text_hash"], pdf["text"]):
                words = lower_words(text)
                rows.append((None if pd.isna(doc_id) else int(doc_id), text_hash))
                shard.append(np.fromiter(map(get, words, repeat(0)), np.int32, len(words)))
                size += len(words)
                if size >= shard_words:
                    yield done(rows, shard)
                    rows, shard, size = [], [], 0
        if rows:
            yield done(rows, shard)

    return docs.mapInPandas(run, _SCHEMA)


def find_contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
                       block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_words, hits, items, matches).

    ``hits`` are the word intervals that any window covers, ``items`` the
    ids (as text, sorted) of test items with a window there, ``matches`` the
    longest verbatim matches (item_id, start word, words).

    Null and empty texts have no words. Items without words or without an id
    match nothing; an id on several rows is one item with all their windows.
    Repeated documents each get their row; an empty table gives no rows; an
    empty benchmark gives rows without hits. Other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    items = (items.select(F.col(item_col).cast("string").alias("item_id"),
                          F.col(item_text).cast("string").alias("text"))
             .where("item_id is not null and text is not null"))
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // (2 * block_words)))  # a word has two characters or more, with its space
    parts = []
    for b in range(blocks):
        own = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        q = Queries([(r[0], r[1]) for r in own.collect()], window)
        part = _pass(docs, spark.sparkContext.broadcast(q), shard_words)
        parts.append(part if blocks == 1 else
                     materialize(part.where(F.lit(b == 0) | (F.size("items") > 0)).withColumn("b", F.lit(b)), "hits"))
    if blocks == 1:
        return parts[0].drop("text_hash")
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    merged = (every.groupBy("doc_id", "text_hash", "n_words")
              .agg(F.flatten(F.collect_list("hits")).alias("hits"),
                   F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
                   F.array_distinct(F.flatten(F.collect_list("matches"))).alias("matches"),
                   F.count_if(F.col("b") == 0).alias("copies")))
    # the intervals of several blocks, joined where they touch or overlap
    start = F.expr("array(cast(null as struct<s:int,e:int>))")
    joined = F.aggregate(
        F.array_sort("hits"), F.slice(start, 1, 0),
        lambda acc, x: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["e"] >= x["s"]),
                              F.concat(F.slice(acc, 1, F.size(acc) - 1),
                                       F.array(F.struct(F.element_at(acc, -1)["s"].alias("s"),
                                                        F.greatest(F.element_at(acc, -1)["e"], x["e"]).alias("e")))))
        .otherwise(F.concat(acc, F.array(x))))
    return (merged.withColumn("hits", joined)
            .withColumn("_", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select("doc_id", "n_words", "hits", "items", "matches"))


def with_verdict(found: DataFrame, share: int = SHARE) -> DataFrame:
    """Adds n_hit and ``contaminated``: some word is hit, and one in ``share``."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda acc, x: acc + x["e"] - x["s"])
    return (found.withColumn("n_hit", n_hit)
            .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """``docs`` without the contaminated rows, all columns as they were. Each
    row goes by its own verdict, whether its id is null or on other rows too."""
    rows, key = keyed(docs, "rows")
    bad = with_verdict(find_contamination(rows, items, key, **how)).where("contaminated")
    bad = materialize(bad.select(F.col("doc_id").alias(key)), "bad")
    return rows.join(bad, key, "left_anti").select(*[rows[c] for c in docs.columns])


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_verdict(find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def brute_force(text: str | None, items: list[tuple[str, str | None]], window: int = WINDOW) -> tuple:
    """(n_words, n_hit, sorted item ids, sha256) by plain scanning, for tests."""
    words = lower_words(text)
    hit, ids = set(), set()
    for item_id, t in items:
        w = lower_words(t)
        size = min(window, len(w))
        for p in range(len(w) - size + 1 if w else 0):
            for i in range(len(words) - size + 1):
                if words[i:i + size] == w[p:p + size]:
                    hit.update(range(i, i + size))
                    ids.add(str(item_id))
    text = ",".join(sorted(ids))
    return len(words), len(hit), sorted(ids), hashlib.sha256(text.encode()).hexdigest()
