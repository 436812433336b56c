"""Operator 13: counts against plain loops, estimation against a plain
version, verdicts against the held labels."""

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from barwise.llm import quality_rules as Q
from tests.llm.cases import SCHEMA, awkward, frame, prose

SF = "/root/testdata/sf0.001"
TEXTS = ["a b c a b c", "a a a a a", "x y z x y\tz\nx y", "one\none\n\n one\none ", "# $ & a|b <c> 100%", "a b\x0bc\x1cd a b c d",
         "\n\n\n", "same line\r\nsame line\nsame line\r\n", "é ü 日本 é ü 日本 é ü 日本", "a b c d a b c x b c d"]


def plain_counts(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if re.search("[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered))


def test_counts_by_plain_loops(spark):
    rows = awkward() + [(100 + i, t, None) for i, t in enumerate(TEXTS)] + [(200, prose(300, 5) * 3, "en")]
    out = Q.judge(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    got = sorted(((r.doc_id, *[r[c] for c in Q.BASE], r.base_failed) for r in out), key=repr)
    expected = []
    for i, text, _ in rows:
        c = plain_counts(text)
        expected.append((i, *c, c[0] < 50 or 100 * c[4] > 50 * c[0]))
    assert got == sorted(expected, key=repr)
    assert all(0 <= r.score <= 1 and r.kept == (not r.base_failed and r.score >= Q.KEEP) for r in out)


def plain_estimate(patterns, tolerance, iterations):
    """Expectation-maximisation over a list of (votes, n)."""
    size = len(Q.RULES)
    share, good, bad = Q.FIRST_SHARE, [Q.FIRST_ON_GOOD] * size, [Q.FIRST_ON_BAD] * size
    for _ in range(iterations):
        posts = []
        for votes, _ in patterns:
            yes, no = share, 1 - share
            for v, g, b in zip(votes, good, bad):
                yes *= {1: g, -1: 1 - g, 0: 1}[v]
                no *= {1: 1 - b, -1: b, 0: 1}[v]
            posts.append(yes / (yes + no))
        n = sum(m for _, m in patterns)
        new = (sum(p * m for p, (_, m) in zip(posts, patterns)) + Q.PRIOR * Q.FIRST_SHARE) / (n + Q.PRIOR)
        rates = []
        for j in range(size):
            t = Counter()
            for p, (votes, m) in zip(posts, patterns):
                t[votes[j], "g"] += m * p
                t[votes[j], "b"] += m * (1 - p)
            rates.append(((t[1, "g"] + Q.PRIOR * Q.FIRST_ON_GOOD) / (t[1, "g"] + t[-1, "g"] + Q.PRIOR),
                          (t[-1, "b"] + Q.PRIOR * Q.FIRST_ON_BAD) / (t[1, "b"] + t[-1, "b"] + Q.PRIOR)))
        moved = max([abs(new - share)] + [abs(x - y) for (x, z), y, w in zip(rates, good, bad)]
                    + [abs(z - w) for (x, z), y, w in zip(rates, good, bad)])
        share, good, bad = new, [x for x, _ in rates], [x for _, x in rates]
        if moved <= tolerance:
            break
    return [share, *good, *bad]


def test_estimates_by_the_plain_version(spark):
    found = Q.counts(spark.read.parquet(f"{SF}/documents.parquet")).select("n_words", *Q.votes())
    names = [f"v_{name}" for name, *_ in Q.RULES]
    table = found.where("n_words > 0").groupBy(*names).agg(F.count(F.lit(1)).alias("n")).persist()
    plain = [(tuple(r)[:-1], r.n) for r in table.collect()]
    assert len(plain) > 5
    got = Q.estimate(table, 1e-6, 60).parameters()
    assert all(math.isclose(x, y, abs_tol=1e-6) for x, y in zip(got, plain_estimate(plain, 1e-6, 60)))


def test_verdicts_agree_with_the_labels(spark):
    sf = SF.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    out = Q.op13_quality_rules(spark, sf)
    assert dict(out.dtypes)["kept"] == "boolean" and {dict(out.dtypes)[c] for c in Q.BASE} == {"bigint"}
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    rows = out.join(labels, "doc_id").where("not base_failed").collect()
    good, bad = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.97 * len(good)
    assert sum(not r.kept for r in bad) >= 0.8 * len(bad)


def test_empty_table(spark):
    assert Q.judge(spark.createDataFrame([], SCHEMA)).count() == 0
    none = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert [(r.n_words, r.base_failed, r.kept) for r in Q.judge(none).collect()] == [(0, True, False)] * 2
