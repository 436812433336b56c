"""Operator 12: hard negatives against a plain version."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barwise.llm.negatives import hard_negatives, op12_negatives, reaching

SF = "/root/testdata/sf0.01"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows, is_anchor, positives=5, negatives=10, low=30, high=90):
    """Every pair, one by one; rows are (vec_id, vector, label)."""
    ok = [(i, [math.floor(256.0 * x) for x in v], label) for i, v, label in rows
          if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (a_id, av, a_label) in enumerate(ok):
        if not is_anchor(a_id):
            continue
        scored = sorted((-sum(x * y for x, y in zip(av, v)), i, label) for b, (i, v, label) in enumerate(ok)
                        if b != a and len(v) == len(av))
        for p, p_id, _ in [x for x in scored if x[2] == a_label][:positives]:
            window = [(-n, n_id) for n, n_id, label in scored if label != a_label and low * -p <= 100 * -n <= high * -p]
            out += [(a_id, p_id, k + 1, n_id, -p, n) for k, (n, n_id) in enumerate(window[:negatives])]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def frame(spark, rows, label="int"):
    schema = f"vec_id long, embedding array<double>, label {label}, row string, v string, slot string, _anchor string"
    return spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], schema)


def random_rows(n, d, seed, labels=4, spread=1.0):
    rng = random.Random(seed)
    return [(i, [round(rng.gauss(0, spread), 2) for _ in range(d)], rng.randrange(labels)) for i in range(n)]


def test_whole_table_against_all_pairs(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in table]
    out = op12_negatives(spark, SF)
    assert [t for _, t in out.dtypes] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]
    assert got(out) == plain(rows, lambda i: i % 100 == 0)


@pytest.mark.parametrize("seed,labels,spread", [(1, 2, 1.0), (2, 30, 0.3), (3, 3, 0.01)])
def test_random_tables_ties_and_few_partners(spark, seed, labels, spread):
    rows = random_rows(160, 12, seed, labels, spread)
    rows += [(i + 500, v, label) for i, v, label in rows[:40]]  # equal vectors: ties
    out = hard_negatives(frame(spark, rows).repartition(5), F.col("vec_id") % 10 == 0, tile=16)
    assert got(out) == plain(rows, lambda i: i % 10 == 0)


def test_several_waves_and_blocks(spark):
    rows = random_rows(120, 7, 5)
    out = hard_negatives(frame(spark, rows), F.col("vec_id") % 4 == 0, wave_numbers=50, block=3, positives=2,
                         negatives=3, low=10, high=70)
    assert got(out) == plain(rows, lambda i: i % 4 == 0, 2, 3, 10, 70)


def test_awkward_rows(spark):
    rows = random_rows(60, 6, 7, 3)
    rows += [(0, rows[3][1], 1), (0, rows[0][1], rows[0][2]), (7, None, 1), (None, rows[1][1], 1), (8, [], 1),
             (9, [1.0, None, 2.0, 0.0, 0.0, 0.0], 1), (10, [math.nan] + [0.0] * 5, 2), (11, [math.inf] + [0.0] * 5, 2),
             (20, [1.0, 2.0], 0), (30, [2.0, 1.0], 0), (40, [1.0, 1.0], 1), (12, rows[2][1], None),
             (50, [0.0] * 6, 1), (60, [0.0] * 6, 1), (70, [0.0] * 6, 2)]
    assert got(hard_negatives(frame(spark, rows), F.col("vec_id") % 10 == 0)) == plain(rows, lambda i: i % 10 == 0)
    text = [(i, v, None if label is None else f"label {label}") for i, v, label in rows]
    assert got(hard_negatives(frame(spark, text, "string"), F.col("vec_id") % 10 == 0)) == \
        plain(rows, lambda i: i % 10 == 0)


@pytest.mark.parametrize("scale", [3e5, 2e6])
def test_sums_beyond_exact_doubles(spark, scale):
    rows = [(i, [x * scale for x in v], label) for i, v, label in random_rows(40, 4, 9, 2)]
    expected = plain(rows, lambda i: i % 5 == 0)
    assert max(r[4] for r in expected) > 2 ** 53 and len(expected) > 50
    assert got(hard_negatives(frame(spark, rows), F.col("vec_id") % 5 == 0)) == expected


def test_empty_and_lonely_tables(spark):
    assert hard_negatives(frame(spark, []), F.col("vec_id") % 5 == 0).count() == 0
    one = random_rows(3, 4, 1, 1)
    assert hard_negatives(frame(spark, one), F.col("vec_id") % 2 == 0).count() == 0
    assert hard_negatives(frame(spark, one), F.lit(False)).count() == 0


def test_index_finds_every_pair_over_its_threshold():
    rng = np.random.default_rng(3)
    for d in (1, 8, 13, 64):
        a, c = np.floor(rng.normal(0, 60, (20, d))), np.floor(rng.normal(0, 60, (300, d)) * rng.exponential(1, d))
        full = (a @ c.T).astype(np.int64)
        for share in (1.5, 0.99, 0.6, 0.2, 0.0, -1.0):
            least = np.floor(np.sort(full, axis=1)[:, -1] * share).astype(np.int64)
            i, j, score = reaching(a, c, least)
            assert set(zip(i.tolist(), j.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(full >= least[:, None]))))
            assert (score == full[i, j]).all()
