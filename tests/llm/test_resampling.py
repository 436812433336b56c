"""Operator 11: importance resampling against a plain version."""

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

from pyspark.sql import functions as F

from barwise.llm.resampling import NGRAM, op11_resampling, resample
from tests.llm.cases import SCHEMA, awkward, frame, prose

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, most):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    return len(words), [crc32(" ".join(words[i:i + k]).encode()) % 10_000
                        for k in range(1, most + 1) for i in range(len(words) - k + 1)]


def plain(docs, target, most=NGRAM, percent=25, least=20):
    """The contract, row by row: [(doc_id, n_features, weight, score, rank)]."""
    s, t = Counter(), Counter()
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            counts.update(features(text, most)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10_000) / ((s[b] + 1) * (T + 10_000)))) for b in range(10_000)]
    rows = []
    for doc_id, text in docs:
        n, found = features(text, most)
        weight = math.floor(sum(gain[b] for b in found) / len(found)) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, score, None, n])
    fit = sorted((r for r in rows if r[5] >= least),
                 key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(fit[:percent * len(fit) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def test_whole_tables_against_the_contract(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    out = op11_resampling(spark, SF)
    assert [t for _, t in out.dtypes] == ["bigint"] * 5
    assert got(out) == plain(docs, target)
    assert sum(r[4] is not None for r in got(out)) > 20


def test_awkward_documents_lines_and_longer_runs(spark):
    rows = awkward() + [(300 + i, t, None) for i, t in enumerate([
        "one\ntwo\nthree four\n\n \nfive six seven eight\nnine", "a\n" * 60, "same line here\nsame line here\nother",
        "x\r\ny z É\nÀ-b", "\n\n", prose(50, 9).replace(". ", ".\n")])]
    target = [prose(30, 4), None, "", "same line\nhere five"]
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    docs = [(i, t) for i, t, _ in rows]
    for most in (1, 2, 4):
        out = resample(frame(spark, rows).repartition(3), goal, percent=60, most=most)
        assert out.count() == len(rows)
        assert got(out) == plain(docs, target, most, 60), most


def test_ties_go_to_the_smaller_id_and_repeats_stay(spark):
    rows = [(i % 3, prose(25, 1), None) for i in range(12)] + [(None, prose(25, 1), None)] * 4
    out = resample(frame(spark, rows), frame(spark, rows[:1]), percent=50)
    drawn = sorted((r["rank"], r.score, r.doc_id) for r in out.where(F.col("rank").isNotNull()).collect())
    assert [r[0] for r in drawn] == list(range(1, 9))
    assert drawn == sorted(drawn, key=lambda r: (-r[1], r[2] is None, r[2] or 0))


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = frame(spark, [(1, prose(30, 1), None), (2, prose(30, 2), None)])
    assert resample(none, some).count() == 0
    assert got(resample(some, none, percent=50)) == plain([(1, prose(30, 1)), (2, prose(30, 2))], [], percent=50)
