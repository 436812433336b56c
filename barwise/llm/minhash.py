"""Operator 3: near-duplicate documents by b-bit MinHash.

1. One pass over the texts gives each document the hash of its whole shingle
   set, ``perms`` minima of which only the lowest ``bits`` bits are kept,
   packed into 64-bit planes, and one key per band of ``rows`` minima.
2. Documents with equal sets collapse to one of them, so a group of copies
   counts as one document from here on.
3. Documents that share a band key are candidates. Similarity is estimated
   from the packed planes: matching positions are counted with bit_count and
   corrected for the 2^-bits chance matches.
4. Links are confirmed on the full shingle sets, in blocks.

All pairs of a bucket are never emitted. In round one each member is
compared with the leaders of its buckets only (a star), and confirmed links
form components. A pair inside a component needs no further check, as it
can't change the result. Round two takes the buckets that hold several
components: their members are dealt to blocks of bounded size, which compare
packed planes and keep lists of candidates, and then check the full sets. So
every candidate pair is confirmed, refuted or already connected, and rows
grow with documents, not with pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import U64, fresh, in_chunks, keyed, materialize, mix64, span_hashes, table
from .components import connected_components

#: Minima a document, kept bits of each, minima a band. A pair at similarity
#: 0.75 shares none of 32 bands of 4 with probability 5e-6.
PERMS, BITS, ROWS = 128, 4, 4
WORDS = 5
THRESHOLD = 0.75
#: An estimate is off by 0.04 (one standard deviation at 0.75 with 128 minima
#: of 4 bits); pairs are confirmed from four deviations below the threshold.
SLACK = 0.16

#: Documents of a part of a bucket; two parts meet in a block.
PART = 256
#: Pairs of a group that are confirmed together.
GROUP_PAIRS = 8192

_RNG = np.random.default_rng(5)
_MUL = (_RNG.integers(0, 1 << 32, PERMS * 8, dtype=np.uint64) | U64(1)).astype(np.uint32)
_XOR = _RNG.integers(0, 1 << 32, PERMS * 8, dtype=np.uint64).astype(np.uint32)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles.

    A-Z is lower-cased; words are what ASCII white space parts. A text of
    fewer words is one shingle; without words there is none.
    """
    w = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not w:
        return np.empty(0, U64)
    data = b" ".join(w)
    if len(w) <= words:
        return span_hashes(data, np.array([0]), np.array([len(data)]))
    cut = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    starts = np.concatenate(([0], cut + 1))[:len(w) - words + 1]
    ends = np.concatenate((cut, [len(data)]))[words - 1:]
    return np.unique(span_hashes(data, starts, ends))


def minima(hashes: np.ndarray, perms: int) -> np.ndarray:
    """The smallest value under each of ``perms`` mixings of 32-bit hashes."""
    low = np.full(perms, np.uint32(0xFFFFFFFF))
    small = (hashes >> U64(32)).astype(np.uint32)
    xor, mul = _XOR[:perms, None], _MUL[:perms, None]
    for i in range(0, len(small), 2048):  # blocks stay in the processor's cache
        h = (small[None, i:i + 2048] ^ xor) * mul
        h ^= h >> np.uint32(15)
        np.minimum(low, h.min(axis=1), out=low)
    return low


def pack(low: np.ndarray, bits: int) -> np.ndarray:
    """The lowest ``bits`` bits of the minima as planes of 64-bit words."""
    planes = [np.packbits(((low >> np.uint32(b)) & np.uint32(1)).astype(np.uint8)) for b in range(bits)]
    return np.concatenate(planes).view(">u8").astype(U64)


def sketches(docs: DataFrame, perms: int = PERMS, bits: int = BITS, rows: int = ROWS,
             words: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, h1, h2, planes, bands, own, anon) of ``docs``
    (doc_id, text, own, anon); none of its columns but the text is null."""
    bands = perms // rows
    salt = np.arange(1, bands + 1, dtype=np.uint64) * U64(0xD1B54A32D192ED03)

    def one(text):
        s = shingles(text, words)
        if not len(s):
            return 0, 0, 0, [], []
        low = minima(s, perms)
        key = salt.copy()
        for part in low[:bands * rows].reshape(bands, rows).T.astype(U64):
            key = mix64(key + part)
        return (len(s), int(np.bitwise_xor.reduce(s).view(np.int64)),
                int(mix64(s).sum(dtype=U64).view(np.int64)),
                pack(low, bits).view(np.int64), key.view(np.int64))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in in_chunks(batches):
            out = [one(t) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"]} | {
                c: [x[i] for x in out]
                for i, c in enumerate(("n_shingles", "h1", "h2", "planes", "bands"))}
                | {"own": pdf["own"], "anon": pdf["anon"]})

    return docs.select("doc_id", "text", "own", "anon").mapInPandas(
        run, "doc_id long, n_shingles long, h1 long, h2 long, planes array<long>, bands array<long>, "
             "own long, anon boolean")


def estimate(a: str, b: str, perms: int, bits: int) -> Column:
    """Collision-corrected similarity of two columns of packed planes."""
    words = perms // 64
    same = None
    for w in range(words):
        diff = None
        for p in range(bits):
            x = F.col(a)[p * words + w].bitwiseXOR(F.col(b)[p * words + w])
            diff = x if diff is None else diff.bitwiseOR(x)
        n = F.bit_count(diff)
        same = n if same is None else same + n
    match = F.lit(1.0) - same / F.lit(float(perms))
    chance = 2.0 ** -bits
    return (match - F.lit(chance)) / F.lit(1 - chance)


def _similar_in_blocks(rows: DataFrame, threshold: float, slack: float, perms: int, bits: int) -> DataFrame:
    """(doc, ys): documents with their candidates in one block.

    ``rows`` are (block, key, left, same, rep, comp, planes, bands, size): the
    left and right documents of parts of buckets. A pair counts if its
    components differ, its sizes and estimate allow the threshold, and this
    bucket's key is the first that both have (so no pair is seen twice).
    """
    words, chance = perms // 64, 2.0 ** -bits
    least = threshold - slack

    def pairs(g: pd.DataFrame):
        left = g["left"].to_numpy()
        rep, comp, size = (g[c].to_numpy() for c in ("rep", "comp", "size"))
        planes, bands = np.stack(g["planes"]).view(np.uint64), np.stack(g["bands"])
        at = np.flatnonzero(left)
        to = at if g["same"].iloc[0] else np.flatnonzero(~left)
        cand: dict[int, list[int]] = {}
        for x in at:
            y = to[(comp[to] != comp[x]) & (rep[to] > rep[x] if to is at else rep[to] != rep[x])]
            y = y[100 * np.minimum(size[y], size[x]) >= round(threshold * 100) * np.maximum(size[y], size[x])]
            if not len(y):
                continue
            diff = np.bitwise_or.reduce((planes[y] ^ planes[x]).reshape(len(y), bits, words), axis=1)
            match = 1 - np.bitwise_count(diff).sum(axis=1) / perms
            y = y[(match - chance) / (1 - chance) >= least]
            if len(y):
                shared = bands[y] == bands[x]
                y = y[bands[x][shared.argmax(axis=1)] == g["key"].iloc[0]]
            if len(y):
                cand[int(rep[x])] = rep[y].tolist()
        return list(cand.items())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # a block that may go on in the next batch
        for pdf in batches:
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            starts = np.flatnonzero(np.diff(pdf["block"].to_numpy(), prepend=pdf["block"].iloc[0] - 1 if len(pdf) else 0))
            if not len(pdf):
                continue
            held = pdf.iloc[starts[-1]:]
            out = [r for i, j in zip(starts[:-1], starts[1:]) for r in pairs(pdf.iloc[i:j])]
            if out:
                yield pd.DataFrame(out, columns=["doc", "ys"])
        if held is not None and len(held):
            out = pairs(held)
            if out:
                yield pd.DataFrame(out, columns=["doc", "ys"])

    dealt = rows.repartition("block").sortWithinPartitions("block")
    return dealt.mapInPandas(run, "doc long, ys array<long>")


def _unresolved(members: DataFrame, labels: DataFrame, sketch: DataFrame, part: int) -> DataFrame:
    """Rows for ``_similar_in_blocks``: buckets that hold several components.

    Documents of the leader's component need no comparison with one another:
    only the others (strays) are compared, with all. Strays and the rest are
    cut into parts of about ``part`` documents; a block is a part of strays
    with another part.
    """
    own = (members.join(labels, members["rep"] == labels["node"], "left")
           .select("key", "rep", "first", F.coalesce("root", "rep").alias("comp")))
    main = own.where(F.col("rep") == F.col("first")).select("key", F.col("comp").alias("main")).distinct()
    own = own.join(main, "key").withColumn("stray", F.col("comp") != F.col("main"))
    parts = (own.groupBy("key").agg(F.count_if("stray").alias("s"), F.count_if(~F.col("stray")).alias("d"))
             .where("s > 0").select("key", F.ceil(F.col("s") / part).alias("s"), F.ceil(F.col("d") / part).alias("d")))
    own = own.join(parts, "key").withColumn(
        "b", F.pmod(F.xxhash64("rep"), F.when(F.col("stray"), F.col("s")).otherwise(F.col("d"))))
    last = F.when(F.col("stray"), F.col("s") + F.col("d")).otherwise(F.col("s")) - 1
    own = own.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("o"))
    # strays: block (b, o), or (o, b) as the right side of an earlier part
    right = ~F.col("stray") | (F.col("o") < F.col("b"))
    i = F.when(F.col("stray"), F.least("b", "o")).otherwise(F.col("o"))
    j = F.when(F.col("stray"), F.greatest("b", "o")).otherwise(F.col("s") + F.col("b"))
    # a part of the rest stands after the strays' parts
    i = F.when(F.col("stray") & (F.col("o") >= F.col("s")), F.col("b")).otherwise(i)
    j = F.when(F.col("stray") & (F.col("o") >= F.col("s")), F.col("o")).otherwise(j)
    return (own.select("key", "rep", "comp", (~right).alias("left"), i.alias("i"), j.alias("j"))
            .join(sketch, "rep")
            .select(F.xxhash64("key", "i", "j").alias("block"), "key", "left", (F.col("i") == F.col("j")).alias("same"),
                    "rep", "comp", "planes", "bands", "size"))


def _confirm(found: DataFrame, docs: DataFrame, threshold: float, words: int) -> DataFrame:
    """Edges (x, y) that connect what the similar pairs of ``found`` (doc, ys)
    connect; similar on their full sets. A group's sets are sent to it once,
    however many of its pairs need them; pairs that the group has already
    connected are left out, and each of its documents points to the smallest
    one that it is connected with there."""
    # the group of a family: the smallest id that its members meet, cut by its
    # number of pairs; so a set goes to few groups, also if many buckets saw it
    low = F.min(F.array_min("ys")).over(Window.partitionBy("doc"))
    found = materialize(found.select("doc", "ys", F.least("doc", low).alias("hub")), "found")
    cut = found.groupBy("hub").agg(F.ceil(F.sum(F.size("ys")) / GROUP_PAIRS).alias("n"))
    found = found.join(cut, "hub").withColumn("family", F.xxhash64("hub", F.pmod(F.xxhash64("doc"), "n")))
    found = materialize(found.select("family", "doc", "ys"), "families")
    both = found.groupBy("family").agg(F.array_union(
        F.collect_set("doc"), F.flatten(F.collect_list(F.array_distinct("ys")))).alias("docs"))
    need = materialize(both.select("family", F.explode(F.array_distinct("docs")).alias("doc_id")), "need")
    n = need.count()
    if not n:
        return found.select(F.col("doc").alias("x"), F.col("doc").alias("y"))
    groups = F.lit(max(8, n // 512))
    found = found.withColumn("at", F.pmod("family", groups))
    need = need.select(F.pmod("family", groups).alias("to"), "doc_id").distinct()
    texts = docs.join(need.select("doc_id").distinct(), "doc_id", "left_semi")

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in in_chunks(batches):
            yield pd.DataFrame({"doc_id": pdf["doc_id"],
                                "grams": [shingles(t, words).tobytes() for t in pdf["text"]]})

    held = need.join(texts.mapInPandas(sets, "doc_id long, grams binary"), "doc_id")
    percent = round(threshold * 100)

    def check(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        grams = {d: np.frombuffer(g, U64) for d, g in zip(right["doc_id"], right["grams"])}
        up = {d: d for d in grams}

        def root(d):
            while up[d] != d:
                up[d] = up[up[d]]
                d = up[d]
            return d

        for x, ys in zip(left["doc"], left["ys"]):
            for y in ys:
                a, b = grams[x], grams[y]
                if root(x) == root(y):
                    continue
                if len(a) > len(b):
                    a, b = b, a
                if 100 * len(a) < percent * len(b):
                    continue
                at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                both = int((b[at] == a).sum())
                if 100 * both >= percent * (len(a) + len(b) - both):
                    i, j = root(x), root(y)
                    up[max(i, j)] = min(i, j)
        return pd.DataFrame([(d, root(d)) for d in grams if up[d] != d], columns=["x", "y"])

    return found.groupBy("at").cogroup(held.groupBy("to")).applyInPandas(check, "x long, y long")


def _near_rows(docs: DataFrame, key: str, id_col: str, text_col: str, threshold: float = THRESHOLD,
               perms: int = PERMS, bits: int = BITS, rows: int = ROWS, words: int = WORDS, slack: float = SLACK,
               part: int = PART) -> DataFrame:
    """(row, doc_id, n_shingles, component_id, kept) of each row of ``docs``,
    which its column ``key`` names. In here a row's key stands as doc_id, and
    its id as ``own`` (0 if it has none: ``anon``)."""
    own = F.col(id_col).cast("long")
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.coalesce(own, F.lit(0)).alias("own"), own.isNull().alias("anon"))
    all_sketches = materialize(sketches(docs, perms, bits, rows, words), "sketches")
    some = all_sketches.where("n_shingles > 0")
    # of rows the one of the smallest id comes first, those without an id last
    ids = some.groupBy("h1", "h2", "n_shingles").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("copies"),
        F.min(F.struct("anon", "own", "doc_id")).alias("head"),
        F.min_by(F.struct("planes", "bands"), "doc_id").alias("sketch"))
    ids = materialize(ids.select("h1", "h2", "n_shingles", "rep", "copies", "head", "sketch.*"), "sets")
    reps = ids.select("rep", "copies", "n_shingles", "planes", "bands")

    keys = reps.select("rep", "copies", F.explode("bands").alias("key"))
    # the leader of a bucket: of most copies, then smallest id; and one at random
    order = F.struct(F.col("copies"), (-F.col("rep")).alias("r"))
    buckets = (keys.groupBy("key")
               .agg(F.count("*").alias("n"), F.max_by("rep", order).alias("first"),
                    F.max_by("rep", F.xxhash64("rep")).alias("other"))
               .where("n > 1"))
    members = materialize(keys.join(buckets, "key").select("key", "n", "rep", "first", "other"), "members")
    sketch = reps.select("rep", "planes", "bands", F.col("n_shingles").alias("size"))
    planes = sketch.drop("bands")
    stars = (members.select(F.col("rep").alias("x"), F.explode(F.array("first", "other")).alias("y"))
             .where("x <> y").distinct()
             # x last: the window below needs the rows by x as well
             .join(planes.toDF("y", "py", "sy"), "y").join(planes.toDF("x", "px", "sx"), "x")
             .where(F.least("sx", "sy") * 100 >= F.greatest("sx", "sy") * round(threshold * 100))
             .withColumn("est", estimate("px", "py", perms, bits))
             .where(F.col("est") >= threshold - slack))
    best = Window.partitionBy("x").orderBy(F.desc("est"), "y")
    stars = stars.withColumn("k", F.row_number().over(best)).where("k <= 2")
    star = stars.select(F.col("x").alias("doc"), F.array("y").alias("ys"))
    links = materialize(_confirm(star, docs, threshold, words), "links")
    labels = connected_components(links.toDF("a", "b"))
    rest = _similar_in_blocks(_unresolved(members, labels, sketch, part), threshold, slack, perms, bits)
    more = materialize(_confirm(rest, docs, threshold, words), "links")
    if not more.isEmpty():
        # the components so far say all that the first links do
        labels = connected_components(labels.toDF("a", "b").unionByName(more.toDF("a", "b")))
    named = materialize(ids.join(labels, ids["rep"] == labels["node"], "left")
                        .select("h1", "h2", "n_shingles", "head", F.coalesce("root", "rep").alias("root")), "named")
    heads = named.groupBy("root").agg(F.min("head").alias("head"))
    named = named.drop("head").join(heads, "root").select("h1", "h2", "n_shingles", "head")
    out = (all_sketches.select("doc_id", "n_shingles", "h1", "h2", "own", "anon")
           .join(named, ["h1", "h2", "n_shingles"], "left")
           .withColumn("head", F.coalesce("head", F.struct("anon", "own", "doc_id"))))
    return out.select(F.col("doc_id").alias("row"), F.when(~F.col("anon"), F.col("own")).alias("doc_id"), "n_shingles",
                      F.when(~F.col("head.anon"), F.col("head.own")).alias("component_id"),
                      (F.col("head.doc_id") == F.col("doc_id")).alias("kept"))


def near_duplicate_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_shingles, component_id, kept).

    Two rows are linked if 100 * intersection >= threshold% of the union of
    their shingle sets; ``component_id`` is the smallest id that links reach
    (null if no row there has one). ``kept`` marks one row of a component,
    the first of that id; without ids, any one.

    Rows are told apart by a key of their own: rows that share an id are
    linked if their texts are alike, and rows without an id are linked as
    any others. Null and empty texts and texts without words have no
    shingle: they are components of their own and kept. An empty table gives
    an empty result. Other columns are not looked at.
    """
    rows, key = keyed(docs.select(id_col, text_col), "rows")
    return _near_rows(rows, key, id_col, text_col, **how).drop("row")


def drop_near_duplicate_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with the rows that ``near_duplicate_rows`` keeps, all columns
    as they were."""
    rows, key = keyed(docs, "rows")
    found = _near_rows(rows, key, id_col, text_col, **how)
    gone = materialize(found.where("not kept").select(F.col("row").alias(key)), "gone")
    return rows.join(gone, key, "left_anti").select(*[rows[c] for c in docs.columns])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``near_duplicate_rows`` by id, one row per id: rows without an id are
    left out, and rows that repeat an id are one document, whose text is the
    smallest of them."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text")).where("doc_id is not null")
    if not docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        docs = docs.groupBy("doc_id").agg(F.min("text").alias("text"))
    return near_duplicate_rows(docs, **how)


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with one document of each component of ``near_duplicates``,
    all columns as they were: for tables that go by id alone.

    Rows without an id stay. Of rows that repeat an id the one of the
    smallest text stays.
    """
    found = near_duplicates(docs, id_col, text_col, **how)
    name = fresh(docs, "_gone")
    gone = materialize(found.where("not kept").select(F.col("doc_id").alias(name)), "gone")
    out = docs.join(gone, docs[id_col] == gone[name], "left_anti")
    again = (docs.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count("*").alias("n")).where("n > 1"))
    if not again.isEmpty():
        named, k = out.where(F.col(id_col).isNotNull()), fresh(docs, "_k")
        first = Window.partitionBy(id_col).orderBy(F.col(text_col).asc_nulls_last())
        out = (named.withColumn(k, F.row_number().over(first)).where(F.col(k) == 1).drop(k)
               .unionByName(out.where(F.col(id_col).isNull())))
    return out


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``kept`` is doc_id = component_id, for all rows of that id;
    ``kept_row`` marks one row of the component."""
    found = near_duplicate_rows(table(spark, sf_dir, "documents"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("kept"))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"), F.col("kept").alias("kept_row"))
