"""Connected components by alternating large and small stars.

Every step is a group-by with a map-side minimum and an equi-join; rounds end
when the edges are stars. Nothing is collected but the number of nodes that
are not yet part of one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """``edges`` (u > v), each v replaced by the smallest v of its own edges."""
    low = edges.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("m"))
    return edges.join(low, "v", "left").select("u", F.coalesce("m", "v").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """For each u of ``edges`` (u > v): u and its v, all tied to the smallest v."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    ends = F.explode(F.array("u", "v"))
    return edges.join(low, "u").select(ends.alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _all_stars(edges: DataFrame) -> bool:
    """Whether every u of ``edges`` (u > v) has one v, which is no u itself:
    then each v is the smallest node of its component."""
    ends = edges.select(F.col("u").alias("node"), "v").unionByName(
        edges.select(F.col("v").alias("node"), F.lit(None).alias("v")))
    nodes = ends.groupBy("node").agg(F.min("v").alias("low"), F.max("v").alias("high"),
                                     F.count_if(F.col("v").isNull()).alias("below"))
    return nodes.where("low <> high or (low is not null and below > 0)").count() == 0


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (two integer columns a, b).

    ``root`` is the smallest node that can be reached; roots themselves are
    not listed. Self-loops, repeated and null edges are ignored. The number
    of rounds grows with the logarithm of the longest path; edges that are
    stars already take none. Each round is written to the checkpoint folder,
    so a lost executor costs one round; ``edges`` themselves are read several
    times, so they should be stored.
    """
    e = (edges.where("a <> b")
         .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    if _all_stars(e):
        e = materialize(e.distinct(), "cc")
    else:
        while True:
            e = materialize(_small_star(_large_star(e)), "cc")
            if _all_stars(e):
                break
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
