"""Operator 11: importance resampling towards a target distribution.

Texts are bags of hashed word n-grams. A bucket's gain is the logarithm of
how much more often the target holds it than the corpus; a text's weight is
its mean gain; noise of a Gumbel distribution makes the highest scores a
sample without replacement.

Counts by segment: a line break parts words, so a text is cut into lines.
The corpus' distinct lines meet in one aggregation, the features of each are
counted once and multiplied by how often the line stands in the corpus.
Features that reach over a line's end are counted by themselves, text by
text. Scoring does the same with the distinct lines of a batch of texts.

Sizes: counts are one array of ``buckets`` numbers a task, and one such table
for the whole corpus. Ranks come from one range sort of the scored rows
(numbers only): a row's rank is its place in its part and the parts' sizes
before it, so no task holds more than a part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _WORD_TABLE, materialize, ship_package, table

#: Longest n-gram, buckets, least words of a text that is drawn, percent drawn, seed.
NGRAM, BUCKETS, MIN_WORDS, PERCENT, SEED = 2, 10_000, 20, 25, 7
#: As ``lower_words``, but line breaks stay.
_LINE_TABLE = _WORD_TABLE[:10] + b"\n" + _WORD_TABLE[11:]


def chained(words: list[bytes], most: int) -> list[list[int]]:
    """Checksums of all runs of 1, 2, ... ``most`` words, joined by a space:
    each run's is the shorter one's, carried on over a space and a word."""
    runs = [list(map(crc32, words))]
    for k in range(1, min(most, len(words))):
        spaced = map(crc32, repeat(b" "), runs[-1][:len(words) - k])
        runs.append(list(map(crc32, words[k:], spaced)))
    return runs


def line_features(words: list[bytes], most: int = NGRAM, buckets: int = BUCKETS) -> np.ndarray:
    """The buckets of all features inside one line."""
    if not words:
        return np.empty(0, np.int64)
    return np.concatenate([np.array(r, np.int64) for r in chained(words, most)]) % buckets


def line_ends(words: list[bytes], most: int = NGRAM) -> tuple[list[bytes], list[bytes] | None]:
    """The words of a line that features of its neighbours can reach: all of
    a short line, else its first and its last ``most`` - 1."""
    reach = most - 1
    return (words, None) if len(words) <= 2 * reach else (words[:reach], words[len(words) - reach:])


def crossing_features(ends: list[tuple], most: int = NGRAM, buckets: int = BUCKETS) -> np.ndarray:
    """The buckets of all features that begin in one line and end in another,
    from the ``line_ends`` of a text's lines."""
    found: list[int] = []
    near: list[bytes] = []
    line_of: list[int] = []

    def take():
        for k in range(2, most + 1):
            for i in range(len(near) - k + 1):
                if line_of[i] != line_of[i + k - 1]:
                    found.append(crc32(b" ".join(near[i:i + k])))

    for i, (head, tail) in enumerate(ends):
        near += head
        line_of += [i] * len(head)
        if tail is not None:  # no feature spans a long line
            take()
            near, line_of = list(tail), [i] * len(tail)
    take()
    return np.array(found, np.int64) % buckets


def text_lines(text: str | None) -> list[bytes]:
    """The lines of a text, words parted by spaces."""
    return text.encode("utf-8", "surrogatepass").translate(_LINE_TABLE).split(b"\n") if text else []


def bucket_counts(docs: DataFrame, text_col: str = "text", most: int = NGRAM, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many features of all texts fall into each bucket;
    buckets without any are left out. Null texts have none."""
    ship_package(docs.sparkSession)
    texts = docs.select(F.col(text_col).cast("string").alias("text")).where(F.col("text").isNotNull())
    lines = (texts.select(F.explode(F.split("text", "\n", -1)).alias("line")).where(F.col("line") != "")
             .groupBy("line").agg(F.count(F.lit(1)).alias("times")))

    def rows(total: np.ndarray) -> pd.DataFrame:
        at = np.nonzero(total)[0]
        return pd.DataFrame({"bucket": at, "n": total[at]})

    def inside(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for pdf in batches:
            for line, times in zip(pdf["line"], pdf["times"]):
                for data in text_lines(line):
                    np.add.at(total, line_features(data.split(), most, buckets), times)
        yield rows(total)

    def across(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for pdf in batches:
            for text in pdf["text"]:
                ends = [line_ends(words, most) for line in text_lines(text) if (words := line.split())]
                np.add.at(total, crossing_features(ends, most, buckets), 1)
        yield rows(total)

    found = lines.mapInPandas(inside, "bucket long, n long").unionByName(
        texts.mapInPandas(across, "bucket long, n long"))
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, text_col: str = "text", most: int = NGRAM,
          buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 * ln(share in the target / share in the corpus)) of every
    bucket, each count raised by one. ``buckets`` rows at most come to the
    driver, for each table."""
    counted = []
    for df in (corpus, target):
        n = np.zeros(buckets, np.int64)
        for bucket, count in bucket_counts(df, text_col, most, buckets).collect():
            n[bucket] = count
        counted.append(n)
    s, t = counted
    all_s, all_t = float(s.sum() + buckets), float(t.sum() + buckets)
    return np.array([math.floor(1000 * math.log(float(b + 1) * all_s / (float(a + 1) * all_t)))
                     for a, b in zip(s.tolist(), t.tolist())], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
          most: int = NGRAM) -> DataFrame:
    """(doc_id, n_words, n_features, weight) for each row of ``docs``: the
    floored mean of the gains of its features, 0 where there is none."""
    ship_package(docs.sparkSession)
    buckets = len(gain)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            met: dict[bytes, tuple] = {}  # distinct lines of this batch
            out = []
            for text in pdf["text"]:
                n_words = n_features = total = 0
                ends = []
                for line in text_lines(text):
                    known = met.get(line)
                    if known is None:
                        words = line.split()
                        inside = line_features(words, most, buckets)
                        known = met[line] = (len(words), len(inside), int(gain[inside].sum()), line_ends(words, most))
                    if known[0]:
                        n_words, n_features, total = n_words + known[0], n_features + known[1], total + known[2]
                        ends.append(known[3])
                crossing = crossing_features(ends, most, buckets)
                n_features, total = n_features + len(crossing), total + int(gain[crossing].sum())
                out.append((n_words, n_features, total // n_features if n_features else 0))
            found = pd.DataFrame(out, columns=["n_words", "n_features", "weight"])
            found.insert(0, "doc_id", pdf["doc_id"].astype("Int64").to_numpy())
            yield found

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInPandas(run, "doc_id long, n_words long, n_features long, weight long"))


def noise(id_col: str, seed: int = SEED) -> F.Column:
    """Whole numbers of a Gumbel distribution (times 1000), fixed by the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str | None = None, percent: int = PERCENT, min_words: int = MIN_WORDS,
             most: int = NGRAM, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) for every row of
    ``docs``; rank numbers the drawn rows by score and is null for others.

    Of the N rows with ``min_words`` words or more, floor(percent * N / 100)
    are drawn: the highest scores, ties to the smaller id (rows without an id
    last; rows alike in both in the order they are read). Null and empty texts
    have no words, weight 0, and are not drawn. A row without an id gets the
    noise of an empty id. Repeated rows are rows of their own. Texts of any
    length are counted whole, line by line; other columns are not read. An
    empty ``docs`` gives no rows; an empty target leaves weights that favour
    what is rare in the corpus.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    wanted = target.select(F.col(target_text_col or text_col).alias("text"))
    weighed = weigh(own, gains(own, wanted, "text", most, buckets), "doc_id", "text", most)
    scored = materialize(weighed.withColumn("score", F.col("weight") + noise("doc_id", seed))
                         .withColumn("_row", F.monotonically_increasing_id()), "resample_scores")
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("_row")]
    fit = scored.where(F.col("n_words") >= min_words)
    # one range sort; the id counts the rows of each part from (part << 33)
    placed = materialize(fit.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("_at", F.monotonically_increasing_id()), "resample_order")
    parts = placed.groupBy(F.shiftright("_at", 33).alias("_part")).agg(F.count(F.lit(1)).alias("n"))
    first, total = [], 0
    for part, n in sorted(parts.collect()):  # one row a part
        first.append((part, total))
        total += n
    draw = percent * total // 100
    before = docs.sparkSession.createDataFrame(first, "_part long, _first long")
    rank = F.col("_first") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    ranked = (placed.withColumn("_part", F.shiftright("_at", 33)).join(before, "_part")
              .withColumn("rank", F.when(rank <= draw, rank)))
    rest = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    columns = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    return ranked.select(*columns).unionByName(rest.select(*columns))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")
