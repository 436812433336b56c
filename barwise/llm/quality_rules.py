"""Operator 13: quality rules under weak supervision, native.

A rule looks at a text's counts and votes for it, against it, or abstains.
No rule decides alone: expectation-maximisation estimates from all texts how
often each rule's votes are right on good and on bad texts, without labels,
and a text is kept if its posterior probability of being good is high enough.

Everything is done in SQL expressions. Counts are taken on the row. Repeated
3-word windows are found by sorting a text's windows, which is skipped where
all their hashes differ. The texts are reduced to how often each combination
of votes occurs, so an iteration is one aggregation over a small table, and
only sums come to the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table

#: White space that parts words, and characters that count as symbols (fixed by the contract).
SPACE, SYMBOLS = r"\x20\x09-\x0D", "#*$%&|<>"
#: Least words, and percent of words in repeated windows, of a text that isn't rejected outright.
MIN_WORDS, MAX_REPEATED = 50, 50
#: A text is kept from this posterior probability on.
KEEP = 0.5
#: Iterations end when no estimate moves by more than this, or after so many.
TOLERANCE, ITERATIONS = 1e-4, 100
#: What is assumed at first: the share of good texts, and how often a rule's
#: vote is right on good and on bad texts. Rules are written to be precise, not
#: complete: they seldom vote against a good text, but know few kinds of bad ones.
FIRST_SHARE, FIRST_ON_GOOD, FIRST_ON_BAD = 0.8, 0.995, 0.1
#: These first beliefs count as much as so many texts of either kind.
PRIOR = 2.0

#: Frequent short words of four languages.
COMMON = ("the of and to in a is that for on with as was "
          "le la les de des et un une est que dans pour qui "
          "der die das und ein eine in zu den mit von ist "
          "el los las en y es por con para una del").split()

#: A rule: its name, when it votes for a text, when against; it abstains otherwise.
RULES = [
    ("length", "n_words >= 100", f"n_words < {MIN_WORDS}"),
    ("word_size", "word_chars between 3 * n_words and 9 * n_words", "word_chars < 2 * n_words or word_chars > 14 * n_words"),
    ("longest_word", "longest between 4 and 40", "longest > 100 or longest < 3"),
    ("symbols", "n_symbols <= 0.02 * n_words", "n_symbols > 0.1 * n_words"),
    ("letters", "n_others <= 0.1 * word_chars", "n_others > 0.2 * word_chars"),
    ("real_words", "n_real >= 0.9 * n_words", "n_real < 0.8 * n_words"),
    ("capitals", "n_capitals <= 0.12 * word_chars", "n_capitals > 0.3 * word_chars"),
    ("digits", "n_digits <= 0.05 * word_chars", "n_digits > 0.25 * word_chars"),
    ("marks", "n_marks <= 0.05 * n_words", "n_marks > 0.2 * n_words"),
    ("sentences", "n_stops between 0.01 * n_words and 0.25 * n_words", "n_stops = 0 and n_words >= 30 or n_stops > 0.5 * n_words"),
    ("duplicate_lines", "n_lines >= 3 and n_dup_lines <= 0.05 * n_lines", "n_dup_lines > 0.3 * n_lines"),
    ("repeats", "n_repeat_words <= 0.1 * n_words", "n_repeat_words > 0.35 * n_words"),
    ("variety", "n_distinct >= 0.35 * n_words", "n_distinct < 0.08 * n_words"),
    ("common_words", "n_common >= 0.05 * n_words", "n_common < 0.002 * n_words and n_words >= 30 and n_bytes <= 1.3 * n_chars"),
]

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeat_words(words: Column) -> Column:
    """Words in 3-word windows that stand twice or more in ``words``, from the
    sorted windows of ``sorted_windows`` in column ``_sorted``."""

    def same(x: Column, y: Column) -> Column:
        equal = x["h"] == y["h"]
        for name in "abc":
            equal = equal & (x[name] == y[name])
        return F.coalesce(equal, F.lit(False))

    ordered = F.col("_sorted")
    again = F.filter(ordered, lambda x, i: same(x, F.get(ordered, i - 1)) | same(x, F.get(ordered, i + 1)))
    places = F.sort_array(F.transform(again, lambda x: x["p"]))
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
    step = F.aggregate(places, start, lambda s, p: F.struct(
        p.alias("last"), (s["n"] + F.least(F.lit(3), p - s["last"])).alias("n")))
    return step["n"]


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The counts that rules look at, one row for each row of ``docs``."""
    text, words = F.col("_text"), F.col("_words")
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    d = d.select("doc_id", "_text",
                 F.filter(F.split(text, f"[{SPACE}]+", -1), lambda w: w != "").alias("_words"),
                 F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{SPACE}]")).alias("_lines"))
    none = F.array().cast("array<int>")
    at = F.when(F.size(words) >= 3, F.sequence(F.lit(0), F.size(words) - 3)).otherwise(none)
    d = d.select("*", F.transform(at, lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2])).alias("_hashes"))
    hashes = F.col("_hashes")
    # different hashes mean different windows; only else the windows themselves are sorted
    some = F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), F.sequence(F.lit(0), F.size(words) - 3)).otherwise(none)
    d = d.select("*", F.sort_array(F.transform(some, lambda i: F.struct(
        hashes[i].alias("h"), words[i].alias("a"), words[i + 1].alias("b"), words[i + 2].alias("c"),
        i.alias("p")))).alias("_sorted"))

    def matches(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern))

    numbers = {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": matches(f"[{SYMBOLS}]"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": repeat_words(words),
        "n_lines": F.size("_lines"),
        "n_chars": F.length(text),
        "n_bytes": F.octet_length(text),
        "longest": F.coalesce(F.array_max(F.transform(words, F.length)), F.lit(0)),
        "n_others": matches(rf"[^\p{{L}}{SPACE}]"),
        "n_capitals": matches(r"\p{Lu}"),
        "n_digits": matches("[0-9]"),
        "n_marks": matches("[!?]"),
        "n_stops": matches(rf"[.!?。！？](?=[{SPACE}\"')]|$)"),
        "n_distinct": F.size(F.array_distinct(words)),
        "n_real": F.size(F.filter(words, lambda w: w.rlike(r"\p{L}"))),
        "n_common": F.size(F.filter(words, lambda w: w.isin(COMMON))),
    }
    return d.select("doc_id", *[x.cast("long").alias(name) for name, x in numbers.items()])


def votes() -> list[Column]:
    """Each rule's vote on a row of ``counts``: 1, -1, or 0 for none; texts
    without words get no votes."""
    return [F.when(F.col("n_words") == 0, 0).when(F.expr(against), -1).when(F.expr(for_it), 1).otherwise(0)
            .cast("tinyint").alias(f"v_{name}") for name, for_it, against in RULES]


class Model:
    """What is believed of the texts and the rules: the share of good texts,
    and how often each rule's votes are right on good and on bad texts."""

    def __init__(self, share: float, on_good: list[float], on_bad: list[float]):
        self.share, self.on_good, self.on_bad = share, on_good, on_bad

    def posterior(self) -> Column:
        """Probability that a row's text is good, from its votes."""
        odds = F.lit(math.log(self.share / (1 - self.share)))
        for (name, *_), good, bad in zip(RULES, self.on_good, self.on_bad):
            vote = F.col(f"v_{name}")
            odds = odds + F.when(vote == 1, math.log(good / (1 - bad))).when(vote == -1, math.log((1 - good) / bad)).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))

    def parameters(self) -> list[float]:
        return [self.share, *self.on_good, *self.on_bad]


def estimate(patterns: DataFrame, tolerance: float = TOLERANCE, iterations: int = ITERATIONS) -> Model:
    """The model that expectation-maximisation finds for ``patterns`` (the
    votes, and n: how many texts have them). Each iteration reads the whole
    table once; without any text the first beliefs stay."""
    model = Model(FIRST_SHARE, [FIRST_ON_GOOD] * len(RULES), [FIRST_ON_BAD] * len(RULES))
    for _ in range(iterations):
        weighed = patterns.withColumn("_good", F.col("n") * model.posterior())
        good, bad = F.col("_good"), F.col("n") - F.col("_good")
        sums = [F.sum(good), F.sum("n")]
        for name, *_ in RULES:
            up, down = F.col(f"v_{name}") == 1, F.col(f"v_{name}") == -1
            sums += [F.sum(F.when(up, good)), F.sum(F.when(down, good)), F.sum(F.when(down, bad)), F.sum(F.when(up, bad))]
        total = [x or 0.0 for x in weighed.agg(*[x.alias(f"s{i}") for i, x in enumerate(sums)]).first()]
        if not total[1]:
            return model
        share = (total[0] + PRIOR * FIRST_SHARE) / (total[1] + PRIOR)
        on_good = [(x + PRIOR * FIRST_ON_GOOD) / (x + y + PRIOR) for x, y in zip(total[2::4], total[3::4])]
        on_bad = [(x + PRIOR * FIRST_ON_BAD) / (x + y + PRIOR) for x, y in zip(total[4::4], total[5::4])]
        new = Model(share, on_good, on_bad)
        moved = max(abs(x - y) for x, y in zip(model.parameters(), new.parameters()))
        model = new
        if moved <= tolerance:
            break
    return model


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: float = KEEP,
          min_words: int = MIN_WORDS, max_repeated: int = MAX_REPEATED) -> DataFrame:
    """For each row of ``docs``: doc_id, the counts of ``BASE``, base_failed,
    kept, score (the posterior) and votes (rule by rule, as text).

    A text with fewer than ``min_words`` words, or with more than
    ``max_repeated`` percent of its words in repeated 3-word windows, fails
    and isn't kept; others are kept if their score is ``keep`` or more. Null
    texts count as empty: no words, no votes, failed. Repeated rows are judged
    each by itself, rows without an id as well. Texts are read whole, however
    long. Rules are estimated from all texts; an empty table gives no rows.
    Other columns are not read.
    """
    found = materialize(counts(docs, id_col, text_col).select("*", *votes()), "quality_counts")
    names = [f"v_{name}" for name, *_ in RULES]
    patterns = materialize(found.where(F.col("n_words") > 0).groupBy(*names).agg(F.count(F.lit(1)).alias("n")),
                           "quality_votes")
    model = estimate(patterns)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeated * F.col("n_words"))
    shown = F.array_join(F.array(*[F.when(F.col(v) != 0, F.concat(F.when(F.col(v) > 0, "+").otherwise("-"), F.lit(v[2:])))
                                   for v in names]), ",")
    return (found.withColumn("base_failed", failed).withColumn("score", model.posterior())
            .select(F.col("doc_id"), *BASE, "base_failed",
                    (~F.col("base_failed") & (F.col("score") >= keep)).alias("kept"), "score", shown.alias("votes")))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))
