"""Operators 1 and 3: near copies and repeated passages."""

import random

import numpy as np
import pytest

from barwise.llm.components import connected_components
from barwise.llm.minhash import (BITS, PERMS, op3_minhash, drop_near_duplicate_rows, drop_near_duplicates, estimate, minima,
                                 near_duplicate_rows, near_duplicates, pack, shingles)
from barwise.llm.substring import LEAST_WORDS, MANY_WORDS, SENTENCES, dedup_substrings, runs, sentences
from tests.llm.cases import awkward, frame, prose


def plain_components(rows):
    """Smallest linked id of each document, by comparing all pairs."""
    sets = {}
    for i, text, _ in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] or "")):
        w = (text or "").encode().lower().split()
        sets.setdefault(i, {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set())
    parent = {i: i for i in sets}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both, either = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if both and 100 * both >= 75 * either:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def check(spark, rows, **how):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(frame(spark, rows), **how).collect()}
    assert got == plain_components(rows)
    return got


def test_awkward_documents(spark):
    got = check(spark, awkward())
    assert got[1][1] == got[2][1] == got[3][1] == 1
    assert got[7][1] == got[8][1] == 7  # fewer than five words: one shingle
    assert got[4] == (0, 4) and got[5] == (0, 5) and got[6] == (0, 6)


def mutate(text, share, rng):
    words = text.split(" ")
    for i in range(len(words)):
        if rng.random() < share:
            words[i] = f"w{rng.randrange(10 ** 6)}"
    return " ".join(words)


@pytest.mark.parametrize("part", [256, 5])
def test_chains_and_large_groups_against_all_pairs(spark, part):
    rng = random.Random(3)
    rows = []
    # a chain: each link is similar to the next only
    words = prose(300, 11).split(" ")
    for i in range(12):
        rows.append((100 + i, " ".join(words), None))
        at = 20 * i % 280
        words = words[:at] + [f"c{i}x{j}" for j in range(18)] + words[at + 18:]
    # a group whose members are around the threshold to one another
    base = prose(120, 12)
    rows += [(1000 + i, mutate(base, 0.03, rng), None) for i in range(60)]
    # documents that share a passage only
    passage = prose(60, 13)
    rows += [(2000 + i, prose(50, 100 + i) + " " + passage, None) for i in range(40)]
    rng.shuffle(rows)
    check(spark, rows, part=part)


def test_empty_table(spark):
    assert near_duplicates(frame(spark, [])).collect() == []
    assert dedup_substrings(frame(spark, [])).collect() == []


def test_dropping_keeps_columns_rows_without_id_and_one_of_each_group(spark):
    docs = frame(spark, awkward())
    out = drop_near_duplicates(docs)
    assert out.columns == docs.columns
    ids = sorted((r.doc_id for r in out.collect() if r.doc_id is not None))
    assert len(ids) == len(set(ids)) and 1 in ids and 2 not in ids and 3 not in ids
    assert sum(r.doc_id is None for r in out.collect()) == 2


def test_rows_without_id_and_rows_that_repeat_one_are_told_apart(spark):
    a, b, c = prose(80, 21), prose(80, 22), prose(80, 23)
    near = " ".join(a.split(" ")[:-2] + ["other", "end."])
    rows = [(None, a, None), (5, a, None), (None, near, None), (7, b, None), (7, c, None), (7, b, None),
            (None, prose(80, 24), None), (None, prose(80, 24), None), (None, None, None), (None, "", None),
            (2 ** 62 + 1, prose(80, 25), None), (9, c, None)]
    found = sorted(((r.doc_id, r.component_id, r.kept) for r in near_duplicate_rows(frame(spark, rows)).collect()),
                   key=repr)
    assert found == sorted(
        [(None, 5, False), (5, 5, True), (None, 5, False), (7, 7, True), (7, 7, True), (7, 7, False),
         (None, None, True), (None, None, False), (None, None, True), (None, None, True),
         (2 ** 62 + 1, 2 ** 62 + 1, True), (9, 7, False)], key=repr)
    docs = frame(spark, rows)
    out = drop_near_duplicate_rows(docs)
    assert out.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted(
        [(5, a), (7, b), (7, c), (None, prose(80, 24)), (None, None), (None, ""), (2 ** 62 + 1, prose(80, 25))], key=repr)


def test_estimate_is_close_to_the_similarity(spark):
    rng = np.random.default_rng(1)
    rows, truth = [], []
    for k, share in enumerate((0.3, 0.6, 0.75, 0.9)):
        both = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
        n = round(1000 * (1 - share) / (2 * share))
        a, b = (np.concatenate([both, rng.integers(0, 1 << 63, n, dtype=np.uint64)]) for _ in range(2))
        rows.append((k, *[pack(minima(x, PERMS), BITS).view(np.int64).tolist() for x in (a, b)]))
        truth.append(1000 / (1000 + 2 * n))
    df = spark.createDataFrame(rows, "k int, a array<long>, b array<long>")
    got = [r.e for r in df.select("k", estimate("a", "b", PERMS, BITS).alias("e")).orderBy("k").collect()]
    assert got == pytest.approx(truth, abs=0.15)


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(5, 5), (900, 901)], "a long, b long")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, 901: 900}


def tasks(spark, run):
    """Tasks that ``run`` starts, as Spark's status tracker has them."""
    sc, name = spark.sparkContext, f"tasks-{random.random()}"
    sc.setJobGroup(name, name)
    try:
        run()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    seen = sc.statusTracker()
    stages = {s for j in seen.getJobIdsForGroup(name) for s in seen.getJobInfo(j).stageIds}
    return sum(i.numCompletedTasks for i in map(seen.getStageInfo, stages) if i)


@pytest.fixture()
def many_partitions(spark):
    held = {"spark.sql.shuffle.partitions": "13", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "1k"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def test_few_tasks_for_groups_that_are_soon_settled(many_partitions):
    # with many partitions a job costs its tasks, however few its rows
    spark, rng, base = many_partitions, random.Random(4), prose(120, 12)
    rows = [(1000 + i, mutate(base, 0.03, rng), None) for i in range(60)]
    rows += [(2000 + i, prose(80, 50), None) for i in range(60)] + [(3000 + i, prose(80, i), None) for i in range(60)]
    got = {}
    n = tasks(spark, lambda: got.update(
        {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(frame(spark, rows)).collect()}))
    assert got == plain_components(rows)
    assert n < 1_100, n


def test_stars_take_no_round(many_partitions):
    spark = many_partitions
    edges = spark.createDataFrame([(7, i) for i in range(8, 60)] + [(9, 7), (2, 1), (3, 1), (1, 3)], "a long, b long")
    got = {}
    n = tasks(spark, lambda: got.update({r.node: r.root for r in connected_components(edges).collect()}))
    assert got == {**{i: 7 for i in range(8, 60)}, 2: 1, 3: 1}
    assert n < 100, n


def test_components_against_union_find(spark):
    rng = random.Random(6)
    for n, m in ((40, 30), (200, 260), (300, 200)):
        pairs = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
        up = list(range(n))
        for _ in range(n):
            for a, b in pairs:
                up[a] = up[b] = min(up[a], up[b])
        df = spark.createDataFrame(pairs + [(None, 3), (4, None)], "a long, b long")
        got = {r.node: r.root for r in connected_components(df).collect()}
        assert got == {i: up[i] for i in range(n) if up[i] != i}


def test_shingles_of_short_texts():
    assert len(shingles(None)) == len(shingles("")) == len(shingles(" \t")) == 0
    assert len(shingles("a b c")) == 1 and shingles("A b\nC")[0] == shingles("a  b c")[0]
    assert len(shingles("a b c d e f")) == 2 and len(shingles("a " * 50)) == 1


def plain_dedup(rows):
    """What stays of each document, by the definition."""
    out = []
    keyed = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    owner = {}
    for i, text, _ in keyed:
        spans = sentences(text)
        h, first, size = runs(text, spans, SENTENCES, LEAST_WORDS, MANY_WORDS)
        for v in h.tolist():
            owner.setdefault(v, i)
    for i, text, _ in rows:
        spans = sentences(text)
        h, first, size = runs(text, spans, SENTENCES, LEAST_WORDS, MANY_WORDS)
        gone, seen = set(), set()
        for v, a, n in zip(h.tolist(), first.tolist(), size.tolist()):
            if owner[v] != i or v in seen:
                gone.update(range(a, a + n))
            seen.add(v)
        out.append((i, len(spans), tuple(spans[g] for g in sorted(gone))))
    return sorted(out, key=repr)


def test_sentence_spans_against_the_definition(spark):
    passage = prose(70, 5)
    rows = awkward() + [(50 + i, f"{prose(40, 200 + i)}\n{passage}\n{prose(40, 300 + i)}", None) for i in range(6)]
    rows.append((70, f"{passage} Between them. {passage}", None))
    got = dedup_substrings(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_sentences, tuple((x.s, x.e) for x in r.removed)) for r in got), key=repr) \
        == plain_dedup(rows)
    by_id = {r.doc_id: r for r in got if r.doc_id is not None and r.doc_id >= 50}
    assert sum(passage in by_id[i].text for i in range(50, 56)) == 1 and passage in by_id[50].text
    for i in range(51, 56):
        assert prose(40, 150 + i) in by_id[i].text and prose(40, 250 + i) in by_id[i].text


def test_repeats_between_rows_without_id_or_of_one_id_go(spark):
    one, two, three = prose(70, 31), prose(70, 32), prose(70, 33)
    rows = [(None, f"{prose(40, 400 + i)}\n{one}", None) for i in range(5)]
    rows += [(80, two, None), (80, two, None), (80, two, None), (2 ** 62 + 1, three, None), (None, three, None)]
    got = dedup_substrings(frame(spark, rows)).collect()
    assert len(got) == len(rows) and sum(r.doc_id is None for r in got) == 6
    assert sum(one in r.text for r in got) == 1 and sum(r.n_removed > 0 and r.doc_id is None for r in got) == 5
    assert sorted(r.text for r in got if r.doc_id == 80) == ["", "", two]
    assert [r.text for r in got if r.doc_id == 2 ** 62 + 1] == [three]
    assert [r.n_removed for r in got if r.doc_id is None and one not in r.text].count(0) == 0


def test_long_sentence_counts_alone_and_short_lines_do_not(spark):
    long = " ".join(f"w{i}" for i in range(60)) + "."
    rows = [(1, f"First one. {long}", None), (2, f"{long} Other text here.", None),
            (3, "Yes. No. Maybe.", None), (4, "Yes. No. Maybe.", None)]
    got = {r.doc_id: r for r in dedup_substrings(frame(spark, rows)).collect()}
    assert got[1].n_removed == 0 and got[2].text == "Other text here."
    assert got[3].n_removed == got[4].n_removed == 0


def test_texts_without_spaces_and_quoted_stops(spark):
    rng = random.Random(8)
    line = "".join(chr(0x4E00 + rng.randrange(3000)) + ("。" if i % 24 == 23 else "") for i in range(480))
    quoted = [f'{prose(12, 60 + k)[:-1]}."' for k in range(4)]
    rows = [(1, line, "zh"), (2, line, "zh"), (3, " ".join(quoted), None),
            (4, " ".join([prose(12, 90) + '"', *quoted[1:]]), None)]
    got = {r.doc_id: r for r in dedup_substrings(frame(spark, rows)).collect()}
    assert got[1].text == line and got[2].text == "" and got[2].n_removed == 20
    # a quoted stop ends a sentence; the last one alone makes no run
    assert got[3].n_removed == 0 and got[4].n_removed == 5 and got[4].n_sentences == 8


def mirror(n, a="a", b="b"):
    """The a/b sequence whose polynomial hash modulo 2^64 equals its mirror's."""
    out = a
    while len(out) < n:
        out += out.translate(str.maketrans({a: b, b: a}))
    return out


def test_texts_that_polynomials_mistake_for_one_another(spark):
    x, y = mirror(1024), mirror(1024, "b", "a")
    assert shingles(x)[0] != shingles(y)[0]
    rows = [(1, x, None), (2, y, None)]
    found = near_duplicates(frame(spark, rows)).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(1, 1), (2, 2)}
    more = " ".join(f"w{i}" for i in range(25))  # one sentence of 26 words: one run
    long = [(i, f"{t} {more}.", None) for i, t, _ in rows]
    assert all(r.n_removed == 0 for r in dedup_substrings(frame(spark, long), many_words=26).collect())
    same = [(1, long[0][1], None), (2, long[0][1], None)]
    assert sum(r.n_removed for r in dedup_substrings(frame(spark, same), many_words=26).collect()) == 1


def test_kept_is_by_id_in_the_query(spark, tmp_path):
    frame(spark, [(7, prose(60, 1), None), (7, prose(60, 1), None), (9, prose(60, 1), None),
                  (None, prose(60, 1), None), (None, prose(60, 2), None)]).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in op3_minhash(spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted([(7, 7, True), (7, 7, True), (9, 7, False), (None, 7, False), (None, None, True)], key=repr)
