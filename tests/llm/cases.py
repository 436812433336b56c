"""Awkward documents that every operator has to take."""

import random

from pyspark.sql import types as T

# column names that operators use inside; an input may have them as well
CLASHING = ["key", "hash", "rep", "comp", "x", "y", "hub", "block", "file", "row", "k", "score", "start",
            "length", "first", "base", "found", "mentions", "low", "flat", "words", "again", "_id", "n", "h1"]
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), *[T.StructField(c, T.StringType()) for c in CLASHING]])

_rng = random.Random(7)
VOCABULARY = ["".join(_rng.choice("abcdefghijklmnoprstuvé") for _ in range(_rng.randint(2, 9))) for _ in range(3000)]


def prose(n: int, seed: int) -> str:
    rng = random.Random(seed)
    out, left = [], n
    while left > 0:
        size = min(left, rng.randint(4, 12))
        out.append(" ".join(rng.choice(VOCABULARY) for _ in range(size)).capitalize() + ".")
        left -= size
    return " ".join(out)


def awkward() -> list[tuple]:
    """(doc_id, text, lang): nulls, empty, blank, short and very long texts,
    exact and near copies, repeated rows, a row without an id."""
    base = prose(80, 1)
    words = base.split(" ")
    near = " ".join(words[:-3] + ["changed", "the", "end."])
    return [
        (1, base, "en"), (2, base, "en"), (3, near, "en"), (4, None, None), (5, "", "en"), (6, " \n\t ", None),
        (7, "one two three", "en"), (8, "one  two\nthree", None), (9, prose(30_000, 2), "fr"),
        (10, "word " * 5000, "en"), (11, "123 456 !!! ***", "en"), (12, "日本語。テスト é", "ja"),
        (13, "x" * 60_000, None), (2, base, "en"), (None, base, "en"), (None, None, None),
        (2 ** 62, prose(60, 3), "de"), (-5, prose(60, 3).upper(), "de"), (14, "a b\x0bc\x1cd e", None),
    ]


def frame(spark, rows):
    full = [(i, t, lang, "s", None if t is None else len(t), *["clash"] * len(CLASHING)) for i, t, lang in rows]
    return spark.createDataFrame(full, SCHEMA)
