"""Operators 6, 9 and 10: quality, exact search, language."""

import math
import random

import numpy as np
import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from barwise.llm import language, quality, topk
from barwise.llm.common import crc_mod, table
from tests.llm.cases import awkward, frame, prose

SF = "/root/testdata/sf0.01"


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = np.zeros((3000, len(quality.FEATURES)))
    x[:, :4] = rng.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # no single feature tells anything
    model = quality.fit(x[:2000], y[:2000], rounds=30)
    assert ((model.score(x[2000:]) > 0.5) == (y[2000:] > 0.5)).mean() > 0.9
    assert (0, 1) in model.pairs


def test_scoring_is_a_sum_of_lookups():
    rng = np.random.default_rng(1)
    x = rng.random((500, len(quality.FEATURES)))
    y = (x[:, 2] + 0.2 * rng.random(500) > 0.6).astype(float)
    model = quality.fit(x, y, rounds=20, pair_rounds=5)
    for row, got in zip(x[:20], model.score(x[:20])):
        total = model.base
        for f in range(len(row)):
            total += model.tables[f][sum(e <= row[f] for e in model.edges[f])]
        for (a, b), values in zip(model.pairs, model.pair_tables):
            total += values[sum(e <= row[a] for e in model.pair_edges[a]), sum(e <= row[b] for e in model.pair_edges[b])]
        assert got == pytest.approx(1 / (1 + math.exp(-total)))


def test_quality_on_held_out_labels(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = quality.train(docs, labels)
    scored = quality.score(docs, model).join(labels, "doc_id").where(crc_mod("doc_id", 5) == 0).toPandas()
    good = (scored.score >= quality.THRESHOLD) == (scored.quality == 1)
    assert len(scored) > 50 and good.mean() > 0.93


def test_quality_of_awkward_documents(spark):
    docs = frame(spark, awkward())
    labels = spark.createDataFrame([(1, 1), (1, 1), (1, 0), (10, 0), (11, 0), (None, 1), (9, None), (2, 1), (999, 1)],
                                   "doc_id long, quality int")
    model = quality.train(docs, labels, held_out_mod=None)
    got = quality.score(docs, model).collect()
    assert len(got) == len(awkward()) and all(0 <= r.score <= 1 for r in got)
    kept = quality.filter_quality(docs, model)
    assert kept.columns == docs.columns
    want = sum(r.score >= quality.THRESHOLD for r in got)
    assert kept.count() == want
    assert quality.score(frame(spark, []), model).collect() == []
    flat = quality.train(docs, labels.where(F.lit(False)))  # nothing to learn from
    assert {r.score for r in quality.score(docs, flat).collect()} == {0.5}


def test_language_on_held_out_documents(spark):
    docs = table(spark, SF, "documents")
    model = language.train(docs.where(crc_mod("doc_id", 4) != 2))
    got = language.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(
        crc_mod("doc_id", 4) == 2).toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.97 and got.score.between(0, 1).all()
    assert got.rejected.mean() < 0.15
    strange = spark.createDataFrame([(1, "zzqx kkwv jjxq " * 30)], "doc_id long, text string")
    assert language.predict(strange, model).first().rejected


def test_language_of_awkward_documents(spark):
    docs = frame(spark, awkward())
    model = language.train(docs)
    got = language.predict(docs, model).collect()
    assert len(got) == len(awkward())
    by_id = {r.doc_id: r.lang_pred for r in got if r.doc_id is not None}
    assert by_id[4] == by_id[5] == by_id[6] == by_id[11] == "und" and by_id[1] == "en" and by_id[12] == "ja"
    assert language.predict(frame(spark, []), model).collect() == []
    none = language.train(frame(spark, []))
    assert {r.lang_pred for r in language.predict(docs, none).collect()} == {"und"}


def plain_top(vectors, asked, k=5):
    def whole(v):
        return None if not v or any(x is None or not math.isfinite(x) for x in v) else [math.floor(256 * x) for x in v]
    rows = [(i, whole(v)) for i, v in vectors if i is not None and whole(v)]
    out = []
    for q in sorted({i for i, _ in rows if asked(i)}):
        best = {}
        for _, a in (r for r in rows if r[0] == q):
            for j, b in rows:
                if j != q and len(a) == len(b):
                    s = min(2 ** 63 - 1, max(1 - 2 ** 63, sum(x * y for x, y in zip(a, b))))
                    best[j] = max(best.get(j, s), s)
        ranked = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        out += [(q, r + 1, j, s) for r, (j, s) in enumerate(ranked)]
    return out


@pytest.mark.parametrize("wave_numbers, tile", [(2_000_000, 4096), (30, 7)])
def test_search_against_all_pairs(spark, wave_numbers, tile):
    rng = random.Random(4)
    vectors = [(i, [rng.choice([-1.0, -0.5, 0.0, 0.25, 0.5, 1.0]) for _ in range(4)]) for i in range(120)]  # many ties
    vectors += [(200 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(30)]
    vectors += [(300, None), (301, []), (302, [1.0, None, 0.0, 0.0]), (303, [float("nan")] * 4),
                (304, [float("inf"), 0.0, 0.0, 0.0]), (None, [9.0] * 4), (305, [1.0, 2.0]), (306, [3.0, -2.0]),
                (7, [0.5, 0.5, 0.5, 0.5]), (7, [0.5, 0.5, 0.5, 0.5]), (10, [1.0, 1.0, 1.0, 1.0])]
    df = spark.createDataFrame([(i, v, "clash", "clash") for i, v in vectors],
                               "vec_id long, embedding array<double>, score string, branch string").repartition(5)
    got = topk.top_k(df, df.where("vec_id % 5 = 0"), wave_numbers=wave_numbers, tile=tile)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()) \
        == sorted(plain_top(vectors, lambda i: i % 5 == 0))
    # within one table every row stands for itself, also if it repeats an id
    con = duckdb.connect()
    con.register("embeddings", pa.table({"vec_id": pa.array([i for i, _ in vectors], pa.int64()),
                                         "embedding": pa.array([v for _, v in vectors], pa.list_(pa.float64()))}))
    rows = topk.top_k_rows(df, F.col("vec_id") % 50 == 0, wave_numbers=wave_numbers, tile=tile)
    own = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in rows.collect())
    assert own == sorted(con.execute(topk.OP9_SQL).fetchall())
    twice = [(50, [0.5] * 4), (50, [0.25] * 4), (1, [0.5] * 4)]
    both = topk.top_k_rows(spark.createDataFrame(twice, "vec_id long, embedding array<double>"), F.col("vec_id") == 50)
    assert sorted((r["rank"], r.vec_id, r.score) for r in both.collect()) == sorted(
        [(1, 1, 65536), (2, 50, 32768), (1, 1, 32768), (2, 50, 32768)])


def test_search_with_huge_components(spark):
    vectors = [(0, [2.0 ** 40, 1.0]), (5, [2.0 ** 40, -3.0]), (1, [1e300, 1.0]), (2, [-1e300, 0.0]), (3, [0.5, 0.0])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = topk.top_k(df, df.where("vec_id % 5 = 0"))
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()) \
        == sorted(plain_top(vectors, lambda i: i % 5 == 0))
    assert topk.top_k(df.where("vec_id > 99"), df.where("vec_id > 99")).collect() == []
