"""The pipeline stage by stage against plain versions, and the registry."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from barwise.llm import minhash, pii, quality, suffix
from barwise.llm.common import materialize, table
from tests.llm.test_dedup import plain_components

SF = "/root/testdata/sf0.001"


def test_stages_in_order_and_registered():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "minhash_near_dedup", "benchmark_decontamination", "pii", "best_fit_packing"]
    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1


def test_stages_against_plain_versions(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    rows = {r.doc_id: r.text for r in docs.collect()}
    steps = dict(corpus_pipeline.STAGES)

    kept = materialize(steps["quality_classifier"](spark, docs, SF), "t")
    model = quality.train(docs, table(spark, SF, "labels"))
    import numpy as np
    want = {i for i, t in rows.items() if model.score(np.array([quality.features(t)]))[0] >= quality.THRESHOLD}
    assert kept.columns == columns and {r.doc_id for r in kept.collect()} == want

    unique = materialize(steps["minhash_near_dedup"](spark, kept, SF), "t")
    comps = plain_components([(i, rows[i], None) for i in want])
    want = {i for i, (_, root) in comps.items() if i == root}
    assert unique.columns == columns and {r.doc_id for r in unique.collect()} == want

    clean = materialize(steps["benchmark_decontamination"](spark, unique, SF), "t")
    items = [(str(r.item_id), r.text) for r in table(spark, SF, "benchmark").collect()]
    bad = set()
    for r in suffix.with_verdict(suffix.find_contamination(unique, table(spark, SF, "benchmark"))).where(
            "n_hit > 0").collect():
        n, hit, _, _ = suffix.brute_force(rows[r.doc_id], items)
        assert (n, hit) == (r.n_words, r.n_hit)
        if 20 * hit >= n:
            bad.add(r.doc_id)
    want -= bad
    assert clean.columns == columns and {r.doc_id for r in clean.collect()} == want

    private = materialize(steps["pii"](spark, clean, SF), "t")
    assert private.columns == columns
    for r in private.collect():
        spans = pii.base_spans(rows[r.doc_id])
        if not spans:
            continue
        for kind, s, e in spans:
            assert rows[r.doc_id][s:e] not in r.text
        assert r.n_chars == len(r.text)
    assert {r.doc_id for r in private.collect()} == want

    packed = steps["best_fit_packing"](spark, private, SF).toPandas()
    assert set(packed.doc_id) == want
    assert packed.groupby("sequence_id").length.sum().max() <= 2048


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "piece", "start", "length", "sequence_id", "offset"} <= set(out.columns)
    assert out.count() > 0


def test_top_k_matches_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    want = sorted(con.execute(entry.oracle_sql()["op9_topk"]).fetchall())
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in entry.queries()["op9_topk"](spark, SF).collect())
    assert got == want and want


@pytest.mark.parametrize("name", ["op1_sentence_spans", "op3_minhash", "op8_decontamination"])
def test_operators_shuffle_no_cross_joins(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "BatchEvalPython" not in plan


def test_minhash_parameters_miss_few_pairs():
    bands = minhash.PERMS // minhash.ROWS
    assert (1 - minhash.THRESHOLD ** minhash.ROWS) ** bands < 1e-5
