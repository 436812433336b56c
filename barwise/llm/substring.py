"""Operator 1: substring deduplication by sliding sentence spans.

A document is cut into sentences. Every run of several consecutive sentences
is hashed, the hashes of all documents meet in one aggregation, and a
sentence goes if a run that covers it is a repeat of one that stands in an
earlier row, or earlier in its own. Rows stand in the order of their ids, those
without one last; rows of one id in the order of a key that each row gets.

A run from a sentence on is the shortest with ``sentences`` sentences and
``least_words`` words, or with ``many_words`` words, whichever ends first:
so short lines that any two texts may share don't count, and a long passage
counts also where it has few full stops. In scripts that are written without
spaces two characters count as a word.

Within a row, repeats are settled on the spot, so the aggregation sees a run
once a row, as (hash, id, key), and combines before it shuffles. Repeats go back
to a row by its key: a list is never longer than the runs of one text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keyed, materialize, ship_package, span_hashes, table

SENTENCES, LEAST_WORDS, MANY_WORDS = 2, 20, 40
_GAP = re.compile(r"\s*\n\s*|(?:(?<=[.!?])|(?<=[.!?][\"')\]»”’]))\s+|(?<=[。！？｡।॥።။។])\s*(?=\S)")
# characters of scripts that are written without spaces: two make up a word
_DENSE = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\U00020000-\U0003ffff]")
_LAST = (1 << 63) - 1


def _order(own: str, key: str):
    """Place of a row: its id, then its key (below 2^61), as one number, which
    an aggregation can update in place."""
    whole = F.col(own).cast("decimal(19,0)") * F.lit(Decimal(1 << 61)).cast("decimal(19,0)")
    return (whole + F.col(key).cast("decimal(19,0)")).cast("decimal(38,0)")


def sentences(text: str | None) -> list[tuple[int, int]]:
    """(start, end) of the sentences: parted by line breaks, by white space
    after a full stop, exclamation or question mark (and a closing quote or
    bracket), and after other scripts' full stops."""
    out, at = [], 0
    for m in _GAP.finditer(text or ""):
        if m.start() > at:
            out.append((at, m.start()))
        at = m.end()
    if text and at < len(text):
        out.append((at, len(text)))
    return out


def runs(text: str | None, spans: list[tuple[int, int]], count: int, least: int, many: int):
    """(hash, first sentence, sentences) of the runs of a text. Letters' case
    (A-Z) and the amount of white space make no difference."""
    words = [text[s:e].encode("utf-8", "surrogatepass").lower().split() for s, e in spans]
    n = np.cumsum([0, *map(len, words)])
    if text and not text.isascii():
        n = n + np.cumsum([0, *[len(_DENSE.findall(text, s, e)) // 2 for s, e in spans]])
    parts = [b" ".join(w) for w in words]
    data = b"\n".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)) if parts else ends
    i = np.arange(len(parts))
    # the first sentence that brings the words, or the words and the sentences
    enough = np.searchsorted(n, n[:-1] + least)
    last = np.minimum(np.maximum(i + count, enough), np.searchsorted(n, n[:-1] + many))
    ok = last <= len(parts)
    i, last = i[ok], last[ok]
    return span_hashes(data, starts[i], ends[last - 1]).view(np.int64), i, last - i


def _cover(n: int, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, first, 1)
    np.add.at(step, first + size, -1)
    return np.cumsum(step)[:n] > 0


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count: int = SENTENCES,
                     least_words: int = LEAST_WORDS, many_words: int = MANY_WORDS) -> DataFrame:
    """One row per row of ``docs``: (doc_id, text, n_sentences, n_removed,
    removed), the text without the sentences that are repeats and their
    places (s, e) in the old text. Nulls stay null, empty texts empty.

    The first of equal runs is the one of the smallest id, and there of the
    smallest place. Rows without an id come after all others. Rows that share
    an id, or have none, are told apart by keys of their own: one of them has
    the first, and the others' runs are repeats. An empty table gives no rows;
    other columns are not read.
    """
    ship_package(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows, key = keyed(docs, "rows")
    rows = rows.select(F.col(key).alias("key"), F.coalesce("doc_id", F.lit(_LAST)).alias("own"),
                       F.col("doc_id").isNull().alias("anon"), "text")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            hashes = [np.unique(runs(text, sentences(text), count, least_words, many_words)[0])
                      for text in pdf["text"]]
            if hashes:
                n = list(map(len, hashes))
                yield pd.DataFrame({"key": np.repeat(pdf["key"].to_numpy(), n), "own": np.repeat(pdf["own"].to_numpy(), n),
                                    "hash": np.concatenate(hashes)})

    spans = materialize(rows.select("key", "own", "text").mapInPandas(scan, "key long, own long, hash long"), "runs")
    repeated = (spans.groupBy("hash").agg(F.min(_order("own", "key")).alias("first"), F.count("*").alias("n"))
                .where("n > 1").select("hash", "first"))
    later = (spans.join(repeated, "hash").where(_order("own", "key") != F.col("first"))
             .groupBy("key").agg(F.collect_set("hash").alias("again")))

    def clean(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for text, again in zip(pdf["text"], pdf["again"]):
                parts = sentences(text)
                h, first, size = runs(text, parts, count, least_words, many_words)
                own = np.zeros(len(h), bool)
                own[np.unique(h, return_index=True)[1]] = True
                gone = ~own
                if again is not None:
                    gone |= np.isin(h, np.asarray(again, np.int64))
                cover = _cover(len(parts), first[gone], size[gone])
                removed = [p for p, c in zip(parts, cover) if c]
                if removed:
                    # a sentence goes with the gap after it
                    bounds = [s for s, _ in parts[1:]] + [len(text)]
                    text = text[:parts[0][0]] + "".join(
                        text[p[0]:b] for p, b, c in zip(parts, bounds, cover) if not c)
                out.append((text, len(parts), len(removed), removed))
            found = pd.DataFrame(out, columns=["text", "n_sentences", "n_removed", "removed"])
            found.insert(0, "doc_id", pd.arrays.IntegerArray(
                pdf["own"].to_numpy(np.int64, copy=True), pdf["anon"].to_numpy(bool, copy=True)))
            yield found

    return rows.join(later, "key", "left").select("own", "anon", "text", "again").mapInPandas(
        clean, "doc_id long, text string, n_sentences long, n_removed long, removed array<struct<s:int,e:int>>")


def op1_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents"))
