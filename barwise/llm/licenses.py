"""Operator 7: license detections by ordered signature rules, native.

A rule is its keywords, a regular expression, a label and a level of trust.
Every match of a rule holds one of its keywords, so only documents with some
keyword of the whole set are looked at, and in them only rules of which a
keyword is there. The places of all matches are put in order; one that lies
inside a longer match of equal or higher trust is dropped. Everything is done
in SQL expressions on the row: no Python, no shuffle.

Keywords are looked up in the text's words, where punctuation and white space
of any amount is one space; regular expressions run on the text itself, and a
space in them stands for any white space, so lines may break anywhere.

Words: A-Z lower-cased, runs of a-z, 0-9 and characters from U+0080.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Base phrases and labels (fixed by the contract).
PHRASES = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

# Licenses: SPDX id, how texts name it (a regex on lower-cased text), and the
# keywords (parted by |) of which any such name holds one.
LICENSES = [
    ("apache-1.1", r"apache (?:software )?license,? (?:version )?1\.1", "apache license|apache software license"),
    ("apache-2.0", r"apache (?:software )?license(?:,? (?:version )?2(?:\.0)?)?", "apache license|apache software license"),
    ("mit", r"mit license|expat license", "mit license|expat license"),
    ("mit-0", r"mit no attribution", "no attribution"),
    ("isc", r"isc license", "isc license"),
    ("0bsd", r"bsd zero[- ]clause|zero[- ]clause bsd", "bsd"),
    ("bsd-2-clause", r"(?:simplified|freebsd|2[- ]clause|two[- ]clause) bsd license|bsd 2[- ]clause", "bsd"),
    ("bsd-3-clause", r"(?:modified|new|revised|3[- ]clause|three[- ]clause) bsd license|bsd 3[- ]clause", "bsd"),
    ("bsd-4-clause", r"(?:original|4[- ]clause|four[- ]clause) bsd license|bsd 4[- ]clause", "bsd"),
    ("gpl-2.0", r"gnu general public license,? (?:version |v)2(?:\.0)?|gpl ?v?2(?:\.0)?", "gnu general public license|gpl"),
    ("gpl-3.0", r"gnu general public license,? (?:version |v)3(?:\.0)?|gpl ?v?3(?:\.0)?", "gnu general public license|gpl"),
    ("lgpl-2.1", r"gnu lesser general public license,? (?:version |v)2\.1|lgpl ?v?2\.1", "gnu lesser general public license|lgpl"),
    ("lgpl-3.0", r"gnu lesser general public license,? (?:version |v)3(?:\.0)?|lgpl ?v?3(?:\.0)?", "gnu lesser general public license|lgpl"),
    ("agpl-3.0", r"gnu affero general public license(?:,? (?:version |v)3(?:\.0)?)?|agpl ?v?3(?:\.0)?", "gnu affero general public license|agpl"),
    ("mpl-1.1", r"mozilla public license,? (?:version |v)?1\.1", "mozilla public license"),
    ("mpl-2.0", r"mozilla public license(?:,? (?:version |v)?2\.0)?", "mozilla public license"),
    ("epl-1.0", r"eclipse public license,? (?:version |v)?1\.0", "eclipse public license"),
    ("epl-2.0", r"eclipse public license(?:,? (?:version |v)?2\.0)?", "eclipse public license"),
    ("cddl-1.0", r"common development and distribution license", "common development and distribution license"),
    ("cpl-1.0", r"common public license", "common public license"),
    ("eupl-1.2", r"european union public licen[cs]e", "european union public licen"),
    ("ecl-2.0", r"educational community license", "educational community license"),
    ("afl-3.0", r"academic free license", "academic free license"),
    ("osl-3.0", r"open software license", "open software license"),
    ("artistic-1.0", r"artistic license,? (?:version )?1\.0", "artistic license"),
    ("artistic-2.0", r"artistic license(?:,? (?:version )?2\.0)?", "artistic license"),
    ("bsl-1.0", r"boost software license", "boost software license"),
    ("zlib", r"zlib license|zlib/libpng license", "zlib license|zlib/libpng license"),
    ("unlicense", r"the unlicense", "unlicense"),
    ("wtfpl", r"do what the f\w+ you want", "do what the f"),
    ("ncsa", r"university of illinois/ncsa open source license", "ncsa open source license"),
    ("python-2.0", r"python software foundation license|psf license", "python software foundation license|psf license"),
    ("postgresql", r"postgresql licen[cs]e", "postgresql licen"),
    ("openssl", r"openssl license", "openssl license"),
    ("ofl-1.1", r"sil open font license", "open font license"),
    ("ms-pl", r"microsoft public license", "microsoft public license"),
    ("ms-rl", r"microsoft reciprocal license", "microsoft reciprocal license"),
    ("odbl-1.0", r"open database license", "open database license"),
    ("odc-by-1.0", r"open data commons attribution license", "open data commons attribution license"),
    ("pddl-1.0", r"public domain dedication and license", "public domain"),
    ("gfdl-1.3", r"gnu free documentation license", "free documentation license"),
    ("upl-1.0", r"universal permissive license", "universal permissive license"),
    ("w3c", r"w3c software notice", "w3c software notice"),
    ("vim", r"vim license", "vim license"),
    ("cc0-1.0", r"cc0(?: 1\.0)?|creative commons zero", "cc0|creative commons zero"),
    ("cc-by-4.0", r"cc[- ]by[- ]4\.0|creative commons attribution 4\.0", "cc by|creative commons attribution"),
    ("cc-by-3.0", r"cc[- ]by[- ]3\.0|creative commons attribution 3\.0", "cc by|creative commons attribution"),
    ("cc-by-sa-4.0", r"cc[- ]by-sa(?:[- ]4\.0)?|creative commons attribution-share-?alike", "cc by|creative commons attribution"),
    ("cc-by-nc-4.0", r"cc[- ]by-nc(?:[- ]4\.0)?|creative commons attribution-noncommercial", "cc by|creative commons attribution"),
    ("cc-by-nd-4.0", r"cc[- ]by-nd(?:[- ]4\.0)?|creative commons attribution-noderiv\w+", "cc by|creative commons attribution"),
    ("cc-by-nc-sa-4.0", r"cc[- ]by-nc-sa(?:[- ]4\.0)?", "cc by"),
    ("cc-by-nc-nd-4.0", r"cc[- ]by-nc-nd(?:[- ]4\.0)?", "cc by"),
]

# Sentences that stand for a license or a claim without naming it.
SENTENCES = [
    ("permission is hereby granted, free of charge", r"permission is hereby granted,? free of charge", "mit"),
    ("redistribution and use in source", r"redistribution and use in source and binary forms", "bsd"),
    ("permission to use, copy, modify", r"permission to use, copy, modify,? and(?:/or)? distribute", "isc"),
    ("free software; you can redistribute", r"is free software; you can redistribute it and/or modify", "gpl"),
    ("free software: you can redistribute", r"is free software: you can redistribute it and/or modify", "gpl"),
    ("public domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain", "public-domain"),
    ("free and unencumbered software", r"this is free and unencumbered software", "unlicense"),
    ("without warranty of any kind", r"without warranty of any kind", "warranty-disclaimer"),
    ("provided as is", r"provided [\"']as[ -]is[\"']", "warranty-disclaimer"),
    ("copyright", r"copyright (?:\(c\)|©)? ?[0-9]{4}(?:-[0-9]{4})?", "copyright"),
    ("©", r"© ?[0-9]{4}", "copyright"),
    ("proprietary", r"proprietary and confidential", "proprietary"),
    ("unauthorized copying", r"unauthorized copying of this file", "proprietary"),
    ("may not be reproduced", r"may not be reproduced", "reserved-terms"),
    ("no part of this", r"no part of this (?:publication|work|book)", "reserved-terms"),
    ("trade secret", r"trade secrets?", "proprietary"),
    ("terms of use", r"subject to (?:the|our) terms of use", "terms-of-use"),
    ("terms of service", r"subject to (?:the|our) terms of service", "terms-of-use"),
    ("creative commons", r"creative commons", "creative-commons"),
    ("gnu general public license", r"gnu general public license", "gpl"),
    ("gnu lesser general public license", r"gnu lesser general public license", "lgpl"),
    ("gnu library general public license", r"gnu library general public license", "lgpl"),
]

#: Trust of a rule by level: tag, address, name in a grant, name, sentence.
TRUST = [1.0, 0.95, 0.9, 0.75, 0.6]
#: Trust of a base phrase.
BASE_TRUST = 0.5


#: Keywords of a grant.
GRANTS = "licensed under|licenced under|released under|distributed under|available under"


def _loose(regex: str) -> str:
    """``regex`` with any white space for its spaces."""
    for a, b in ((r"[- ]", r"(?:-|\s+)"), (r"[ -]", r"(?:-|\s+)"), (" ?", r"\s*"), (" ", r"\s+")):
        regex = regex.replace(a, b)
    return regex


def rules() -> list[tuple[str, str, str, int]]:
    """(keywords parted by |, regex, label, level), in order: each license
    gives a rule for its tag, two kinds of address, its name in a grant and
    its bare name."""
    out = []
    for spdx, name, word in LICENSES:
        code = spdx.replace(".", r"\.")
        tail = r"(?:-only|-or-later|\+)?(?![\w.-]*\w)"
        out.append(("spdx-license-identifier", rf"spdx-license-identifier:\s*{code}{tail}", spdx, 0))
        out.append(("spdx.org/licenses", rf"spdx\.org/licenses/{code}{tail}", spdx, 1))
        if spdx.startswith("cc-by"):
            kind, version = spdx[3:].rsplit("-", 1)
            out.append(("creativecommons", rf"creativecommons\.org/licenses/{kind}/{version}", spdx, 1))
        else:
            out.append(("opensource.org/license", rf"opensource\.org/licenses?/{code}\b", spdx, 1))
        out.append((GRANTS, rf"(?:licen[cs]ed|released|distributed|available) under (?:the )?(?:terms of the )?"
                    rf"(?:{name}|{code}(?![\w.-]*\w))", spdx, 2))
        out.append((word, rf"\b(?:{name})(?!\w)", spdx, 3))
        out.append(("license:", rf"license:\s*{code}(?![\w.-]*\w)", spdx, 0))
    out += [(k, r, label, 4) for k, r, label in SENTENCES]
    return [(k, _loose(r), label, level) for k, r, label, level in out]


def folded(keyword: str) -> str:
    """A keyword as it stands in a text's words."""
    return re.sub(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ", keyword).strip()


def _gate() -> list[str]:
    """Words of which every keyword of every rule holds one: a document
    without any has no match of any rule."""
    short = ["licen", "copyright", "gpl", "creative", "cc by", "bsd", "public domain", "free software"]
    keys = {folded(k) for words, *_ in rules() for k in words.split("|")}
    return short + sorted(k for k in keys if not any(w in k for w in short))


GATE = _gate()


def _any(text: Column, words: list[str]) -> Column:
    found = F.lit(False)
    for w in words:
        found = found | F.contains(text, F.lit(w))
    return found


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _places(text: Column, rule: Column) -> Column:
    """(start, -end, level, label) of every match of a rule: pieces between
    matches and the matches' own lengths add up to the places."""
    pieces = F.split(text, rule["regex"], -1)
    texts = F.regexp_extract_all(text, rule["regex"], F.lit(0))
    pairs = F.zip_with(pieces, texts, lambda p, m: F.struct(F.length(p).alias("p"), F.length(m).alias("m")))
    none = F.array().cast("array<struct<s:int,e:int,level:int,label:string>>")
    start = F.struct(F.lit(0).alias("at"), none.alias("out"))
    return F.aggregate(
        F.filter(pairs, lambda x: x["m"].isNotNull()), start,
        lambda acc, x: F.struct(
            (acc["at"] + x["p"] + x["m"]).alias("at"),
            F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + x["p"]).alias("s"), (-(acc["at"] + x["p"] + x["m"])).alias("e"),
                rule["level"].alias("level"), rule["label"].alias("label")))).alias("out")),
        lambda acc: acc["out"])


def detections(text: Column, flat: Column) -> Column:
    """Kept detections of lower-cased ``text``, whose words are ``flat``:
    (start, end, level, label)."""
    table_ = F.array(*[F.struct(F.array(*[F.lit(folded(x)) for x in k.split("|")]).alias("kw"),
                                F.lit(r).alias("regex"), F.lit(label).alias("label"), F.lit(level).alias("level"))
                       for k, r, label, level in rules()])
    here = F.filter(table_, lambda r: F.exists(r["kw"], lambda k: F.contains(flat, k)))
    found = F.array_sort(F.flatten(F.transform(here, lambda r: _places(text, r))))
    levels = len(TRUST)
    none = F.array().cast("array<struct<s:int,e:int,level:int,label:string>>")
    start = F.struct(F.array(*[F.lit(-1)] * levels).alias("far"), none.alias("out"))

    def step(acc, x):
        # how far matches of each level or a higher one reach so far
        inside = F.element_at(acc["far"], x["level"] + 1) >= -x["e"]
        far = F.transform(acc["far"], lambda v, i: F.when(i >= x["level"], F.greatest(v, -x["e"])).otherwise(v))
        return F.struct(far.alias("far"), F.when(inside, acc["out"]).otherwise(F.concat(acc["out"], F.array(F.struct(
            x["s"].alias("s"), (-x["e"]).alias("e"), x["level"].alias("level"), x["label"].alias("label"))))).alias("out"))

    kept = F.aggregate(found, start, step, lambda acc: acc["out"])
    return F.when(_any(flat, GATE), kept).otherwise(none)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_words, starts, base_labels,
    detections). ``starts`` are the word positions of the base phrases.

    Null and empty texts have no words and no detections. Repeated rows each
    get their row; an empty table gives none; other columns are not read.
    """
    low = F.coalesce(lower_ascii(F.col(text_col).cast("string")), F.lit(""))
    df = docs.select(F.col(id_col).cast("long").alias("doc_id"), low.alias("low"))
    flat = F.trim(F.regexp_replace("low", r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))
    df = df.select("doc_id", "low", F.concat(F.lit(" "), flat, F.lit(" ")).alias("flat"))
    blanks = F.octet_length("flat") - F.octet_length(F.replace("flat", F.lit(" "), F.lit("")))
    n_words = F.when(F.col("flat") == "  ", 0).otherwise(blanks - 1).cast("long")
    there = [(p.split(), label, F.contains(F.col("flat"), F.lit(f" {p} "))) for p, label in PHRASES]
    words = F.split(F.trim("flat"), " ")

    def at(i, parts):
        same = F.lit(True)
        for k, w in enumerate(parts):
            same = same & (F.get(F.col("words"), i + k) == w)
        return F.coalesce(same, F.lit(False))

    any_phrase = F.lit(False)
    for _, _, c in there:
        any_phrase = any_phrase | c
    df = df.select("doc_id", "low", "flat", n_words.alias("n_words"),
                   F.array_sort(F.filter(F.array(*[F.when(c, F.lit(label)) for _, label, c in there]),
                                         lambda x: x.isNotNull())).alias("base_labels"),
                   F.when(any_phrase, words).alias("words"))
    starts = F.filter(F.sequence(F.lit(0), F.size("words") - 1),
                      lambda i: at(i, there[0][0]) | at(i, there[1][0]) | at(i, there[2][0]))
    return df.select("doc_id", "n_words", "base_labels",
                     F.when(F.col("words").isNotNull(), starts).otherwise(F.array().cast("array<int>")).alias("starts"),
                     detections(F.col("low"), F.col("flat")).alias("detections"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    trust = F.array(*[F.lit(x) for x in TRUST])
    best = F.array_max(F.transform("detections", lambda x: F.element_at(trust, x["level"] + 1)))
    base = F.when(F.size("starts") > 0, BASE_TRUST).otherwise(0.0)
    labels = F.array_sort(F.array_union("base_labels", F.transform("detections", lambda x: x["label"])))
    return found.select(
        "doc_id", "n_words", F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"), F.array_max("starts").cast("long").alias("last_word"),
        F.concat_ws(",", "base_labels").alias("base_labels"), F.concat_ws(",", labels).alias("labels"),
        F.greatest(F.coalesce(best, F.lit(0.0)), base).alias("score"))
