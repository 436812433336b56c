"""Operator 2: personal data by patterns and bootstrapped contexts.

Fixed patterns find the base spans (email, ip, card, phone). They seed a
bootstrap for what the patterns miss: each seed and each other
number-like token is an instance, the words around it are its lexical
patterns, and instances and patterns form a graph. In each round Spark
scores patterns by the share of known instances among all they meet, keeps
the trustworthy ones, and scores unknown instances by the patterns that meet
them (one minus the product of the doubts). Instances over the threshold
join the known ones for the next round; their places become spans of the
kind that their patterns vote for. Base spans always stay.

Contexts also induce a kind of their own, ``secret``, which no fixed pattern
seeds: where one context recurs before many different key-like tokens and
hardly before any other, those tokens are known instances from the start. A
key-like token in a context of its own is none.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh, in_chunks, keyed, materialize, ship_package, table

KINDS = ("email", "ip", "card", "phone")
#: Rounds of the bootstrap; known instances that a pattern needs; the least
#: confidence of a pattern and score of an instance; digits of a candidate.
ROUNDS, SUPPORT, CONFIDENCE, ACCEPT, DIGITS = 3, 4, 0.6, 0.7, 4

#: The induced kind, and how many different key-like tokens a context needs for it.
SECRET, INDUCED = "secret", 8
#: Key-like: this long, letters and digits only, some of either.
KEY_CHARS, KEY_MIXED = 16, 4

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# matches start where a run of digits starts, as the runs are taken whole
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9]){15,}+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"\S*[0-9@]\S*")
_EDGE = "()[]{}<>\"'.,;:!?"
_OPEN = "([{<\"'"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost spans: the longest local part that is free, an @, a domain."""
    out, last = [], 0
    at = text.find("@")
    while at >= 0:
        s = at
        while s > last and text[s - 1] in _LOCAL:
            s -= 1
        m = _DOMAIN.match(text, at + 1) if s < at else None
        if m:
            out.append((s, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    return out


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start; code points, end exclusive."""
    if not text:
        return []
    out = [("email", s, e) for s, e in emails(text)]
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append(("phone", *m.span()))
    return out


_AFTER = re.compile(r"\s*(\S*)")


def words_before(text: str, at: int, n: int = 2) -> list[str]:
    """The last ``n`` words before a place, lower-cased, however long they are
    and however far away. An equals sign is a word; quotes and brackets that
    open at the place don't count."""
    reach = 64
    while True:
        part = text[max(0, at - reach):at].rstrip(_OPEN).replace("=", " = ")
        words = part.rsplit(None, n)
        # a word that begins where the part does may begin earlier
        if reach >= at or len(words) > n:
            return [w.lower() for w in words[-n:]]
        reach *= 2


def _contexts(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns of a place: the two words before it, and the word on
    either side; digits in them are alike."""
    left = [_DIGIT.sub("0", w) for w in words_before(text, start)]
    after = _AFTER.match(text, end)
    right = [_DIGIT.sub("0", after.group(1).lower())] if after.group(1) else []
    out = []
    if len(left) == 2:
        out.append(f"{left[0]} {left[1]} _")
    if left and right:
        out.append(f"{left[-1]} _ {right[0]}")
    return out


def mentions(text: str | None, base: list[tuple[str, int, int]], digits: int = DIGITS):
    """(kind or "", start, end, value, patterns) of seeds and candidates."""
    if not text:
        return []
    out = [(k, s, e, re.sub(r"\W", "", text[s:e]).lower(), _contexts(text, s, e)) for k, s, e in base]
    taken = sorted((s, e) for _, s, e in base)
    for m in _TOKEN.finditer(text) if _DIGIT.search(text) or "@" in text else ():
        start = m.start() + m.group().rfind("=") + 1  # name=value: the value
        word = text[start:m.end()]
        s = start + len(word) - len(word.lstrip(_EDGE))
        e = m.end() - (len(word) - len(word.rstrip(_EDGE)))
        while taken and taken[0][1] <= s:
            taken.pop(0)
        if s >= e or any(a < e and s < b for a, b in taken):
            continue
        if sum(c.isdigit() for c in text[s:e]) >= digits or "@" in text[s:e]:
            out.append(("", s, e, re.sub(r"\W", "", text[s:e]).lower(), _contexts(text, s, e)))
    return [x for x in out if x[3]]


def scan(docs: DataFrame, digits: int = DIGITS) -> DataFrame:
    """(doc_id, base, mentions) of ``docs`` (doc_id, text), one row a row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in in_chunks(batches):
            base = [base_spans(t) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "base": base,
                                "mentions": [mentions(t, b, digits) for t, b in zip(pdf["text"], base)]})

    span = "kind:string,s:int,e:int"
    return docs.select("doc_id", "text").mapInPandas(
        run, f"doc_id long, base array<struct<{span}>>, "
             f"mentions array<struct<{span},value:string,patterns:array<string>>>")


def bootstrap(found: DataFrame, rounds: int = ROUNDS, support: float = SUPPORT, confidence: float = CONFIDENCE,
              accept: float = ACCEPT) -> DataFrame:
    """(value, kind, score) of discovered instances.

    ``found``: (kind, value, pattern) of all mentions, kind "" if unknown."""
    edges = materialize(found.groupBy("value", "pattern").agg(F.count("*").alias("n")), "edges")
    seeds = found.where("kind <> ''").groupBy("value", "kind").agg(F.lit(1.0).alias("score"))
    seeds = materialize(seeds, "seeds")
    met = materialize(edges.groupBy("pattern").agg(F.count("*").alias("met")), "met")
    induced = materialize(induce(edges, confidence).join(seeds, "value", "left_anti"), "induced")
    seeds = seeds.unionByName(induced)
    known, new = seeds, None
    for _ in range(rounds):
        patterns = (edges.join(known, "value").groupBy("pattern", "kind").agg(F.sum("score").alias("known"))
                    .where(F.col("known") >= support).join(met, "pattern")
                    .withColumn("confidence", F.col("known") / F.col("met"))
                    .where(F.col("confidence") >= confidence).select("pattern", "kind", "confidence"))
        patterns = materialize(patterns, "patterns")
        doubt = F.least(F.col("confidence"), F.lit(0.999))
        votes = (edges.join(patterns, "pattern").groupBy("value", "kind")
                 .agg((1 - F.exp(F.sum(F.log(1 - doubt)))).alias("score"))
                 .where(F.col("score") >= accept)
                 .join(seeds.select("value").distinct(), "value", "left_anti"))
        best = Window.partitionBy("value").orderBy(F.desc("score"), "kind")
        last, new = new, materialize(
            votes.withColumn("k", F.row_number().over(best)).where("k = 1").drop("k"), "found")
        named = ["value", "kind"]
        if new.isEmpty() or (last is not None and new.join(last, named, "left_anti").isEmpty()
                             and last.join(new, named, "left_anti").isEmpty()):
            break  # the same instances as the round before
        known = seeds.unionByName(new.select("value", "kind", "score"))
    return new.select("value", "kind", "score").unionByName(induced)


def key_like(value: str = "value") -> Column:
    """Whether a value may be a key: long, letters and digits, some of both."""
    v = F.col(value)
    return (v.rlike(f"^[a-z0-9]{{{KEY_CHARS},}}$") & (F.regexp_count(v, F.lit("[0-9]")) >= KEY_MIXED)
            & (F.regexp_count(v, F.lit("[a-z]")) >= KEY_MIXED))


def induce(edges: DataFrame, confidence: float = CONFIDENCE, least: int = INDUCED) -> DataFrame:
    """(value, kind, score): key-like values that stand in a context which
    meets ``least`` different ones and, in a share of ``confidence``, nothing
    else. The score is that share, of the best of a value's contexts."""
    share = F.count_if(key_like()) / F.count(F.lit(1))
    contexts = edges.groupBy("pattern").agg(F.count_if(key_like()).alias("keys"), share.alias("share")).where(
        (F.col("keys") >= least) & (F.col("share") >= confidence))
    return (edges.where(key_like()).join(contexts, "pattern").groupBy("value").agg(F.max("share").alias("score"))
            .select("value", F.lit(SECRET).alias("kind"), "score"))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row per row of ``docs``: (doc_id, base, found), arrays of
    (kind, s, e), each by kind in the order of ``KINDS`` (then ``secret``),
    then start. Texts are searched whole, however long.

    Null and empty texts have none. Rows that repeat an id are looked at one
    by one. An empty table gives no rows. Other columns are not read.
    """
    ship_package(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = materialize(scan(docs), "mentions").select(
        "*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    each = rows.select("file", "row", F.explode("mentions").alias("m")).select("file", "row", "m.*")
    known = bootstrap(each.select("kind", "value", F.explode("patterns").alias("pattern")), **how)
    added = (each.where("kind = ''").drop("kind", "patterns").join(known, "value")
             .groupBy("file", "row").agg(F.collect_list(F.struct("kind", "s", "e")).alias("found")))
    none = F.array().cast("array<struct<kind:string,s:int,e:int>>")
    return (rows.join(added, ["file", "row"], "left")
            .select("doc_id", in_order(F.col("base")).alias("base"),
                    in_order(F.coalesce("found", none)).alias("found")))


def in_order(spans):
    """Spans by kind as listed, then start."""
    rank = F.create_map(*[F.lit(x) for i, k in enumerate((*KINDS, SECRET)) for x in (k, i)])
    keyed = F.transform(spans, lambda x: F.struct(rank[x["kind"]].alias("k"), x["s"].alias("s"), x["e"].alias("e"),
                                                  x["kind"].alias("kind")))
    return F.transform(F.array_sort(keyed), lambda x: F.struct(x["kind"].alias("kind"), x["s"].alias("s"),
                                                              x["e"].alias("e")))


def as_text(spans):
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with every span of ``find_pii`` replaced by its kind in
    brackets; ``n_chars``, if there, follows the new text. Other columns and
    rows stay. Spans that overlap are replaced as one, named by the first.
    Each row gets the spans discovered in it, whether its id is null or on
    other rows too."""
    ship_package(docs.sparkSession)
    rows, key = keyed(docs, "rows")
    spans = fresh(rows, "_spans")
    private = (find_pii(rows, key, text_col, **how).select(F.col("doc_id").alias(key), F.concat("base", "found").alias(spans))
               .where(F.size(spans) > 0))
    joined = rows.join(private, key, "left")

    def run(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, own in zip(texts, spans):
            if own is not None:
                parts, last = [], 0
                for x in sorted(own, key=lambda x: (x["s"], -x["e"])):
                    if x["s"] >= last:
                        parts += [text[last:x["s"]], f"[{x['kind'].upper()}]"]
                    last = max(last, x["e"])
                text = "".join(parts) + text[last:]
            out.append(text)
        return pd.Series(out, dtype=object)

    clean = F.pandas_udf(run, "string")
    text = F.col(text_col).cast("string")
    # only texts with spans go through Python
    text = F.coalesce(clean(F.when(F.col(spans).isNotNull(), text), F.col(spans)), text)
    keep = [F.col(c) if c != text_col else text.alias(text_col) for c in docs.columns]
    out = joined.select(*keep)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length(text_col).cast(dict(docs.dtypes)["n_chars"]),
                                                   F.col("n_chars")))
    return out


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = find_pii(table(spark, sf_dir, "documents"))

    def count(kind):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return spans.select("doc_id", *map(count, KINDS), F.sha2(as_text(F.col("base")), 256).alias("base_sha256"),
                        as_text(in_order(F.array_union("base", "found"))).alias("spans"),
                        F.size("found").cast("long").alias("n_found"))


def brute_force(text: str | None) -> tuple[list[str], str]:
    """Base spans by the plain patterns, for tests."""
    text = text or ""
    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(re.sub("[^0-9]", "", m)) <= 19
                 and luhn(re.sub("[^0-9]", "", m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15)}
    out = [f"{k}:{m.start()}:{m.end()}" for k, (p, ok) in rules.items() for m in re.finditer(p, text) if ok(m.group())]
    return out, hashlib.sha256(",".join(out).encode()).hexdigest()
