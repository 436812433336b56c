"""Operators 2, 7 and 8: personal data, licenses, benchmark passages."""

import random
import re
from re import _parser

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barwise.llm import licenses, pii, suffix
from barwise.llm.common import in_chunks, lower_words
from tests.llm.cases import awkward, frame, prose

PRIVATE = [
    "Write to a.b+c@ex-ample.co.uk, x@y or z@w.org.", "a@b.c_d@e.f @@x@y.z", "12.34.56.78 and 1.2.3.4.5 and 256.1.1.1",
    "007.08.9.0255", "4111 1111 1111 1111 and 4111-1111-1111-1112", "41111111111111111111111111", "+1 (555) 123-4567 or +1234567",
    "+49 30 123456789012345678", "+1..........", "card 5500 0000 0000 0004, mail me@here.com", "+12 +34 5678901",
    "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "é 10.0.0.1 日本 10.0.0.2",
]


def test_base_spans_by_the_plain_patterns():
    for text in PRIVATE + [t for _, t, _ in awkward()]:
        got = [f"{k}:{s}:{e}" for k, s, e in pii.base_spans(text)]
        assert got == pii.brute_force(text)[0], text


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("a1@.-+ (0495_%é")), max_size=40))
def test_base_spans_on_random_texts(text):
    assert [f"{k}:{s}:{e}" for k, s, e in pii.base_spans(text)] == pii.brute_force(text)[0]


def test_contexts_discover_unseen_identifiers(spark):
    rng = random.Random(2)
    rows = [(500 + i, f"{prose(5, i)} please call number +1 555 {rng.randrange(10 ** 6, 10 ** 7)} today {prose(4, i + 50)}", None)
            for i in range(12)]
    rows += [(100, "Now please call number 5551234567 today again.", None),
             (101, "There were 20241201 things.", None)]
    rows += awkward()
    got = pii.find_pii(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert [(x.kind, rows[12][1][x.s:x.e]) for x in by_id[100].found] == [("phone", "5551234567")]
    assert by_id[101].found == [] and by_id[101].base == []
    out = pii.redact(frame(spark, rows))
    assert out.columns == frame(spark, rows).columns and out.count() == len(rows)
    texts = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert texts[100][0] == "Now please call number [PHONE] today again." and texts[100][1] == len(texts[100][0])
    assert texts[101][0] == "There were 20241201 things." and texts[4] == (None, None)
    assert all("[PHONE]" in texts[i][0] and "555 " not in texts[i][0] for i in range(500, 512))


def test_contexts_are_whole_words_at_any_distance(spark):
    assert pii.words_before("one  two" + " " * 500, 508) == ["one", "two"]
    assert pii.words_before("a " + "x" * 300 + " b 5", 304) == ["x" * 300, "b"]
    assert pii.words_before("  One", 5) == ["one"] and pii.words_before("", 0) == []
    rng = random.Random(2)
    for gap in (" ", " " * 70, "\n" + " " * 300):
        rows = [(500 + i, f"{prose(5, i)} please call number{gap}+1 555 {rng.randrange(10 ** 6, 10 ** 7)} today {prose(4, i)}",
                 None) for i in range(12)]
        rows.append((100, f"Now please call number{gap}5551234567 today again.", None))
        by_id = {r.doc_id: r for r in pii.find_pii(frame(spark, rows)).collect()}
        assert [x.kind for x in by_id[100].found] == ["phone"], gap


def test_recurring_contexts_induce_secrets(spark):
    rng = random.Random(5)
    key = lambda n=40: "".join(rng.choice("0123456789abcdef") for _ in range(n - 8)) + "a1b2c3d4"
    keys = [key() for _ in range(12)]
    rows = [(500 + i, f'{prose(6, i)} token = "{k}" {prose(6, i + 60)}', None) for i, k in enumerate(keys)]
    rows += [(600 + i, f"{prose(6, 200 + i)} password={key(20)} {prose(5, i)}", None) for i in range(9)]
    rows += [(700 + i, f"{prose(6, 300 + i)} {key()} {prose(5, i)}", None) for i in range(9)]  # contexts of their own
    rows += [(800 + i, f"{prose(6, 400 + i)} size = {1000 + i} {prose(5, i)}", None) for i in range(9)]
    rows += [(900, f"{prose(9, 500)} token = unknown then {keys[0]} again.", None)]  # a known value elsewhere
    got = {r.doc_id: r for r in pii.find_pii(frame(spark, rows)).collect()}
    for i, text, _ in rows:
        found = [(x.kind, text[x.s:x.e]) for x in got[i].found]
        if i < 600:
            assert found == [("secret", keys[i - 500])]
        elif i < 700:
            assert [k for k, _ in found] == ["secret"] and text[got[i].found[0].s - 1] == "="
        else:
            assert found == ([("secret", keys[0])] if i == 900 else [])
    texts = {r.doc_id: r.text for r in pii.redact(frame(spark, rows)).collect()}
    assert 'token = "[SECRET]"' in texts[500] and "password=[SECRET]" in texts[600] and keys[0] not in texts[900]


def test_secrets_of_the_test_table_are_discovered(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    planted = {r.doc_id for r in docs.where("text rlike 'token = \"[0-9a-f]{40}\"'").collect()}
    found = {r.doc_id for r in pii.op2_pii(spark, "/root/testdata/sf0.01").where("n_found > 0").collect()}
    assert planted and planted <= found
    clean = {r.doc_id for r in docs.where("not text rlike '[0-9a-f]{16}'").collect()}
    assert not found & clean


def test_discovered_spans_go_to_their_own_row(spark):
    rng = random.Random(2)
    rows = [(500 + i, f"{prose(5, i)} please call number +1 555 {rng.randrange(10 ** 6, 10 ** 7)} today {prose(4, i + 50)}", None)
            for i in range(12)]
    hidden = "Now please call number 5551234567 today again."
    other = prose(40, 77)
    rows += [(None, hidden, None), (100, hidden, None), (100, other, None), (None, other, None)]
    out = sorted(((r.doc_id, r.text) for r in pii.redact(frame(spark, rows)).collect()
                  if r.doc_id in (None, 100)), key=repr)
    masked = "Now please call number [PHONE] today again."
    assert out == sorted([(None, masked), (100, masked), (100, other), (None, other)], key=repr)


def test_only_private_texts_go_through_python(spark):
    """Texts without a span are neither sent to a worker nor changed."""
    text = "Write to a@b.org or 10.0.0.1, card 4111 1111 1111 1111."
    rows = [(1, text, None), (2, "Nothing here.", None), (3, None, None), (4, "", None), (None, text, None), (1, "é", None)]
    out = pii.redact(frame(spark, rows))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    sent = [x for x in plan.splitlines() if "ArrowEvalPython" in x]
    assert len(sent) == 1 and "CASE WHEN isnotnull(_spans" in sent[0]
    clean = "Write to [EMAIL] or [IP], card [CARD]."
    got = [(r.doc_id, r.text, r.n_chars) for r in out.collect()]
    assert sorted(got, key=str) == sorted([(i, clean if t == text else t, None if t is None else len(clean if t == text else t))
                                           for i, t, _ in rows], key=str)


def test_workers_hold_few_results_at_once():
    texts = ["x" * n for n in (5, 5, 30, 0, 1)] + [None] + ["y" * 4] * 10
    frames = [f["text"].tolist() for f in in_chunks(iter([pd.DataFrame({"text": texts[:4]}), pd.DataFrame({"text": texts[4:]})]),
                                                    limit=12)]
    assert [t for f in frames for t in f] == texts
    assert all(len(f) == 1 or sum(len(t or "") for t in f) <= 12 for f in frames) and len(frames) < len(texts)


def test_spans_of_awkward_documents(spark):
    rows = awkward() + [(200 + i, t, None) for i, t in enumerate(PRIVATE)]
    got = {r.doc_id: r for r in pii.find_pii(frame(spark, rows)).collect() if r.doc_id and r.doc_id >= 200}
    for i, text in enumerate(PRIVATE):
        assert [f"{x.kind}:{x.s}:{x.e}" for x in got[200 + i].base] == pii.brute_force(text)[0]


def plain_base(text):
    words = lower_words(text)
    out = [(i, label) for phrase, label in licenses.PHRASES for i in range(len(words))
           if words[i:i + len(phrase.split())] == phrase.encode().split()]
    return len(words), sorted(i for i, _ in out), sorted({x for _, x in out})


LICENSED = [
    "cc by cc by", "CC-BY 4.0, all Rights; Reserved", "GNU General\nPublic License v3", "acc by", "cc  by",
    "Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: MIT", "Released under the MIT License.",
    "spdx-license-identifier: gpl-2.0-or-later and gpl v3", "https://creativecommons.org/licenses/by-nc/4.0/",
    "Permission is hereby granted, free of charge", "all rights reserved " * 40, "licensed under CC BY-NC 4.0.",
]


def test_base_phrases_and_words(spark):
    rows = awkward() + [(300 + i, t, None) for i, t in enumerate(LICENSED)]
    got = licenses.scan(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want = sorted(((i, *plain_base(t)) for i, t, _ in rows), key=repr)
    assert sorted(((r.doc_id, r.n_words, r.starts, r.base_labels) for r in got), key=repr) == want
    found = {r.doc_id: [(x.label, x.level) for x in r.detections] for r in got}
    assert found[305] == [("apache-2.0", 2)] and found[306] == [("mit", 0)] and found[307] == [("mit", 2)]
    assert ("gpl-2.0", 0) in found[308] and ("gpl-3.0", 3) in found[308]
    assert found[309] == [("cc-by-nc-4.0", 1)] and ("mit", 4) in found[310]
    # the general name inside the longer one is suppressed
    assert ("cc-by-nc-4.0", 2) in found[312] and len(found[312]) == 1
    assert found[4] == found[5] == []


def test_gate_lets_every_rule_through():
    """Each license's own forms pass the keyword gate, and there are hundreds of rules."""
    rules = licenses.rules()
    assert len(rules) >= 200 and len({r[2] for r in rules}) >= 50
    for keyword, _, _, level in rules:
        if level in (0, 1):
            assert any(g in keyword or keyword in g or "licen" in keyword for g in licenses.GATE)


def samples(regex):
    """A text for each alternative of a rule, with its options and without."""
    def expand(part, options):
        out = [""]
        for op, arg in part:
            name = str(op)
            if name == "LITERAL":
                more = [chr(arg)]
            elif name == "ANY":
                more = ["."]
            elif name == "IN":
                kind, value = arg[0]
                more = [chr(v) for k, v in arg if str(k) == "LITERAL"] or [
                    chr(value[0]) if str(kind) == "RANGE" else "\n " if "SPACE" in str(value) else "x"]
            elif name == "BRANCH":
                more = [t for p in arg[1] for t in expand(p, options)]
            elif name == "SUBPATTERN":
                more = expand(arg[3], options)
            elif name in ("MAX_REPEAT", "MIN_REPEAT"):
                n = max(arg[0], min(options, arg[1]))
                more = [t * n for t in expand(arg[2], options)]
            else:
                more = [""]
            out = [a + b for a in out for b in more]
        return out

    return {t for options in (0, 1) for t in expand(_parser.parse(regex), options)}


def test_a_sample_of_every_rule_passes_its_keyword_and_the_gate(spark):
    texts = []
    for keyword, regex, _, level in licenses.rules():
        for text in samples(regex):
            assert re.search(regex, text), (regex, text)
            flat = licenses.folded(text)
            assert any(licenses.folded(k) in flat for k in keyword.split("|")), (keyword, text)
            assert any(g in flat for g in licenses.GATE), text
            texts.append((text, re.search(regex, text).span(), level))
    assert {level for *_, level in texts} == set(range(5))
    got = licenses.scan(frame(spark, [(i, f"x {t} y", None) for i, (t, *_) in enumerate(texts)])).collect()
    found = {r.doc_id: r.detections for r in got}
    for i, (text, (s, e), level) in enumerate(texts):
        assert any(x.s <= s + 2 and x.e >= e + 2 and x.level <= level for x in found[i]), text


def test_bare_codes_and_broken_lines_are_found(spark):
    texts = [("Released under MIT.", "mit", 2), ("available under apache-2.0", "apache-2.0", 2),
             ("Distributed under the MPL-2.0", "mpl-2.0", 2), ("licensed\n  under the\tMIT\nlicense", "mit", 2),
             ("Redistribution and use in source and\n binary forms", "bsd", 4),
             ("is provided 'as-is'", "warranty-disclaimer", 4), ("PROVIDED \"AS\n  IS\"", "warranty-disclaimer", 4),
             ("This is free and\nunencumbered software", "unlicense", 4)]
    got = {r.doc_id: r for r in licenses.scan(frame(spark, [(i, t, None) for i, (t, *_) in enumerate(texts)])).collect()}
    for i, (text, label, level) in enumerate(texts):
        assert (label, level) in [(x.label, x.level) for x in got[i].detections], text
    # places are those of the text as it came
    assert [(x.s, x.e) for x in got[4].detections] == [(0, len(texts[4][0]))]


def test_licenses_native_and_empty(spark):
    df = licenses.scan(frame(spark, []))
    assert df.collect() == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "Exchange" not in plan


ITEMS = [("i1", prose(40, 900)), ("i2", "three short words"), ("i3", prose(13, 901)), ("i4", None), ("i5", "..."),
         (None, prose(30, 902)), ("i6", prose(40, 900)), ("i7", "word " * 20), ("i10", "one")]


def contaminated_rows():
    item = ITEMS[0][1]
    words = item.split()
    rows = [(400, f"{prose(30, 1)} {item} {prose(30, 2)}", None), (401, " ".join(words[5:18]), None),
            (402, " ".join(words[5:17]), None), (403, f"Three-short words? {prose(200, 3)}", None),
            (404, item.upper() + " " + item, None), (405, ITEMS[2][1] + " " + prose(400, 4), None),
            (406, " ".join(words[:20]) + " x " + " ".join(words[20:]), None)]
    return rows + awkward()


@pytest.mark.parametrize("block_words, shard_words", [(2_000_000, 4_000_000), (40, 50)])
def test_windows_against_plain_scanning(spark, block_words, shard_words):
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    rows = [r for r in contaminated_rows() if r[1] is None or len(r[1]) < 20_000]
    found = suffix.with_verdict(suffix.find_contamination(
        frame(spark, rows), items, block_words=block_words, shard_words=shard_words))
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found.collect()), key=repr)
    plain = [i for i in ITEMS if i[0] is not None]
    want = sorted(((i, *suffix.brute_force(t, plain)[:3]) for i, t, _ in rows), key=repr)
    assert got == want


def test_longest_matches_and_removal(spark):
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    docs = frame(spark, contaminated_rows())
    found = {r.doc_id: r for r in suffix.find_contamination(docs, items).collect()}
    whole = len(lower_words(ITEMS[0][1]))
    longest = {(m.item_id, m.length) for m in found[400].matches}
    assert ("i1", whole) in longest and ("i6", whole) in longest
    out = suffix.decontaminate(docs, items)
    assert out.columns == docs.columns
    ids = {r.doc_id for r in out.collect()}
    assert 400 not in ids and 404 not in ids and 403 in ids and 402 in ids and 4 in ids


@pytest.mark.parametrize("block_words", [2_000_000, 40])
def test_removal_judges_each_row(spark, block_words):
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    item = ITEMS[0][1]
    rows = [(None, item, None), (None, prose(50, 5), None), (7, item, None), (7, prose(50, 6), None),
            (7, item, None), (None, None, None), (2 ** 62 + 1, prose(50, 8), None)]
    out = suffix.decontaminate(frame(spark, rows), items, block_words=block_words)
    assert out.columns == frame(spark, rows).columns
    want = [rows[i][:2] for i in (1, 3, 5, 6)]
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted(want, key=repr)


def test_empty_documents_and_empty_benchmark(spark):
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    assert suffix.find_contamination(frame(spark, []), items).collect() == []
    none = suffix.find_contamination(frame(spark, awkward()), items.where(F.lit(False)))
    assert all(r.hits == [] for r in none.collect()) and none.count() == len(awkward())


def test_suffix_array_is_sorted():
    import numpy as np
    rng = np.random.default_rng(0)
    ids = np.append(rng.integers(0, 4, 300), np.zeros(40)).astype(np.int32)
    sa = suffix.suffix_array(ids, 2, 16)
    def tail(p):
        t = ids[p:p + 16].tolist()
        return t[:t.index(0)] if 0 in t else t
    assert [tail(p) for p in sa] == sorted(tail(p) for p in sa)
