"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotflow.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of these."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every linked node; ``root`` is the smallest node it reaches.

    ``edges``: columns ``a`` and ``b`` without nulls, in any direction, with repeats.
    Large and small stars alternate until the links no longer change; they are a
    star around each root then. A node with very many links is summed before its
    shuffle and joined, never gathered.
    """
    now, before = materialize(edges.select("a", "b").where("a <> b").distinct(), "links"), None
    while True:
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before:
            break
        before = state
        now = materialize(_small_star(_large_star(now)), "links")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
