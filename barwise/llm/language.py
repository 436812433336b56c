"""Operator 10: language by nearest centroid.

Texts become hashed counts of byte n-grams of their lower-cased letters,
weighted by TF-IDF and brought to length 1. Each language has several
centroids: its training vectors, clustered by spherical k-means. A text gets
the language of the centroid of highest cosine; if that centroid is farther
than nearly all of its own training texts, the text counts as rejected.

Document frequencies come from all training texts. The clusters are fitted
on a bounded sample a language (``sample`` rows of smallest hash).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import crc_mod, materialize, ship_package, table

DIMS = 1 << 13
SAMPLE, CLUSTERS = 400, 3
UNKNOWN = "und"
_NO_LETTER = re.compile(r"[\W\d_]+")


def grams(text: str | None) -> np.ndarray:
    """Hashed counts of the 2-, 3- and 4-grams of a text's letters."""
    data = (" " + _NO_LETTER.sub(" ", text or "").lower() + " ").encode("utf-8", "replace")
    a = np.frombuffer(data, np.uint8).astype(np.uint32)
    out = np.zeros(DIMS, np.float32)
    code = a
    for n in (2, 3, 4):
        if len(a) < n:
            break
        code = code[:-1] * np.uint32(257) + a[n - 1:]
        out += np.bincount((code * np.uint32(2654435761)) >> np.uint32(32 - 13), minlength=DIMS)
    return out


def vector(text: str | None, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(grams(text)) * idf
    size = float(np.sqrt((v * v).sum()))
    return v / size if size else v


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def cluster(x: np.ndarray, clusters: int, steps: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: (centroids, smallest cosine that is still usual)."""
    # start far apart: each next seed is the row least like those before
    seeds, best = [0], x @ x[0]
    while len(seeds) < min(clusters, len(x)):
        seeds.append(int(best.argmin()))
        best = np.maximum(best, x @ x[seeds[-1]])
    c = x[seeds].copy()
    for _ in range(steps):
        own = (x @ c.T).argmax(axis=1)
        for k in range(len(c)):
            if (own == k).any():
                m = x[own == k].sum(axis=0)
                c[k] = m / max(1e-12, float(np.linalg.norm(m)))
    cos = x @ c.T
    own = cos.argmax(axis=1)
    near = np.array([np.quantile(cos[own == k, k], 0.01) if (own == k).any() else 1.0 for k in range(len(c))])
    return c, near


class Centroids:
    def __init__(self, idf: np.ndarray, langs: list[str], vectors: np.ndarray, near: np.ndarray):
        self.idf, self.langs, self.vectors, self.near = idf, langs, vectors, near

    def predict(self, texts) -> tuple[list[str], np.ndarray, list[bool]]:
        """(language, cosine, rejected) of each text."""
        langs, scores, far = [], np.zeros(len(texts)), []
        for i, text in enumerate(texts):
            if not self.langs or not has_letter(text):
                langs.append(UNKNOWN)
                far.append(True)
                continue
            cos = self.vectors @ vector(text, self.idf)
            k = int(cos.argmax())
            langs.append(self.langs[k])
            scores[i] = min(1.0, max(0.0, float(cos[k])))
            far.append(bool(cos[k] < self.near[k]))
        return langs, scores, far


#: Rows of the sample that are broadcast at most (16 bytes each and the language's name).
SENT_ROWS = 200_000


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample: int = SAMPLE, clusters: int = CLUSTERS) -> Centroids:
    """Fit on the rows of ``docs`` with a language and a letter. The model
    holds ``clusters`` vectors a language, whatever the number of rows."""
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang")).where("lang is not null and text is not null")
    # the smallest hashes of a language: those under twice the sample's share of
    # the hash range first, so that no task sorts a whole language
    ids = docs.select("doc_id", "lang").distinct().withColumn("u", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)))
    sizes = ids.groupBy("lang").agg(F.count("*").alias("n"))
    low = ids.join(sizes, "lang").where(F.col("u").cast("double") * F.col("n") < 2.0 * sample * (1 << 40))
    first = Window.partitionBy("lang").orderBy("u", "doc_id")
    picked = materialize(low.withColumn("k", F.row_number().over(first))
                         .where(F.col("k") <= sample).select("doc_id", "lang"), "language_sample")
    # a few hundred rows a language: sent to the texts, unless there are very many languages
    chosen = F.broadcast(picked) if picked.count() <= SENT_ROWS else picked

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, n = np.zeros(DIMS, np.int64), 0
        for pdf in batches:
            for text in pdf["text"]:
                if has_letter(text):
                    seen += grams(text) > 0
                    n += 1
        yield pd.DataFrame({"gram": np.append(np.arange(DIMS), -1), "n": np.append(seen, n)})

    df = (docs.select("text").mapInPandas(frequencies, "gram int, n long")
          .groupBy("gram").agg(F.sum("n").alias("n")).toPandas().set_index("gram")["n"])  # one row a dimension
    count = df.reindex(range(DIMS), fill_value=0).to_numpy()
    idf = (np.log((1 + int(df.get(-1, 0))) / (1 + count)) + 1).astype(np.float32)
    held = spark.sparkContext.broadcast(idf)

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf = pdf[[has_letter(t) for t in pdf["text"]]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "lang": pdf["lang"],
                                "v": [vector(t, held.value).astype(np.float16).tobytes() for t in pdf["text"]]})

    rows = (docs.join(chosen, ["doc_id", "lang"], "left_semi")
            .mapInPandas(vectors, "doc_id long, lang string, v binary").dropDuplicates(["doc_id", "lang", "v"]))

    def centroids(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "v"])
        x = np.stack([np.frombuffer(v, np.float16) for v in pdf["v"]]).astype(np.float32)
        c, near = cluster(x, clusters)
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "v": [r.tobytes() for r in c], "near": near})

    found = materialize(rows.groupBy("lang").applyInPandas(centroids, "lang string, v binary, near double"),
                        "centroids").toPandas().sort_values(["lang", "v"])
    v = np.stack([np.frombuffer(b, np.float32) for b in found["v"]]) if len(found) else np.empty((0, DIMS))
    return Centroids(idf, list(found["lang"]), v.astype(np.float32), found["near"].to_numpy())


def predict(docs: DataFrame, model: Centroids, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, rejected) for every row.

    Null texts and texts without a letter are ``und`` with score 0, as is
    everything if no language was learned. Ties go to the language that
    sorts first.
    """
    ship_package(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            langs, scores, far = held.value.predict(list(pdf["text"]))
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "lang_pred": langs,
                                "score": scores, "rejected": far})

    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return docs.mapInPandas(run, "doc_id long, lang_pred string, score double, rejected boolean")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(crc_mod("doc_id", 4) != 2))
    return predict(docs, model).select(
        "doc_id", F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score",
        "rejected")
