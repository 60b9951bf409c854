"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wonweave.llm import common


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    own = least.select("u", F.col("m").alias("v"))
    return down.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root of every node of `edges` (u, v: long); the root is the component's least node.

    Each round moves a row per edge; hot nodes are joined on, never gathered. The rows stop
    changing after about as many rounds as the logarithm of the longest path.
    """
    edges = common.staged(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(now) == seen or not now[0]:
            out = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            out._staged_at = edges._staged_at
            return out
        seen = tuple(now)
        before, edges = edges, common.staged(_small_star(_large_star(edges)), "edges")
        common.drop(before)
