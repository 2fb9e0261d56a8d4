"""Connected components by alternating large-star and small-star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.functions.storage import pinned


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (a, b); label: the smallest node reachable.

    Each step points neighbours at the smallest one near them, by a minimum per node and a join, so
    no node's neighbours are ever gathered; every step is written to the shared folder. The number
    of steps grows with the logarithm of a component's size.
    """
    now = pinned(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                 .distinct(), "edges")
    before = None
    while (state := tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 40))).first())) != before:
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        wide = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .where("u <> v").distinct()
        small = wide.groupBy("u").agg(F.min("v").alias("m"))
        met = wide.join(small, "u")
        near = met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = pinned(near.unionByName(small.select("u", F.col("m").alias("v"))).distinct(), "edges")
    labels = now.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return labels.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct()
