"""Lines to details, and the tree of amounts over them, as a long table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNNAMED = "(미지정)"


def details(lines: DataFrame, keys: Sequence[str], amount: str, seq: str, first: Sequence[str] = ()) -> DataFrame:
    """A row for each key: amount, line_count, and what its first line says of `first`."""
    return lines.groupBy(*keys).agg(F.sum(amount).alias(amount), F.count("*").alias("line_count"), *[F.min_by(c, seq).alias(c) for c in first])


def rollup_tree(df: DataFrame, levels: Sequence[str], amount: str) -> DataFrame:
    """level, path (array), name, amount, n of every node; level 0 is the root. Null names get a placeholder first, so that they aren't taken for subtotals."""
    named = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit(UNNAMED)).alias(c) for c in levels], F.col(amount).alias("__amount"))
    cube = named.rollup(*levels).agg(F.sum("__amount").alias("amount"), F.count("*").alias("n"), F.grouping_id().alias("__g"))
    # grouping_id has a bit for each level that is rolled up
    level = F.lit(len(levels)) - F.bit_count("__g")
    out = cube.withColumn("level", level.cast("int"))
    path = F.slice(F.array(*levels), F.lit(1), F.col("level"))
    return out.withColumn("path", path).select("level", "path", F.when(F.col("level") > 0, F.element_at("path", -1)).otherwise("전체").alias("name"), "amount", "n")


def children_in_order(tree: DataFrame) -> DataFrame:
    """With parent (path) and place among its children, by amount."""
    from pyspark.sql import Window

    parent = F.slice("path", F.lit(1), F.greatest(F.col("level") - 1, F.lit(0)))
    w = Window.partitionBy("parent").orderBy(F.desc("amount"), "name")
    return tree.filter("level > 0").withColumn("parent", parent).withColumn("place", F.row_number().over(w))


def search(tree: DataFrame, text: str) -> DataFrame:
    """Nodes whose name holds `text`, their ancestors and all below them.

    Ancestors come from exploding the hits' own prefixes; descendants by joining each node's
    prefixes with the hits: equi-joins only.
    """
    key = F.array_join("path", "\x1f")
    hits = tree.filter((F.col("level") > 0) & F.lower("name").contains(text.lower())).select("path")
    prefixes = lambda p: F.transform(F.sequence(F.lit(0), F.size(p)), lambda i: F.array_join(F.slice(p, F.lit(1), i), "\x1f"))
    above = hits.select(F.explode(prefixes(F.col("path"))).alias("k")).distinct()
    hit = hits.select(key.alias("k")).distinct()
    keyed = tree.withColumn("__k", key)
    below = keyed.filter("level > 0").select("__k", F.explode(prefixes(F.col("path"))).alias("k")).join(hit, "k", "left_semi").select(F.col("__k").alias("k"))
    return keyed.join(above.unionByName(below).distinct(), F.col("__k") == F.col("k"), "left_semi").drop("__k")


def to_depth(tree: DataFrame, depth: int) -> DataFrame:
    return tree.filter(F.col("level") <= depth)


def statistics(tree: DataFrame, depth: int) -> DataFrame:
    """nodes, leaves, and nodes with an amount."""
    return tree.agg(F.count("*").alias("nodes"), F.count_if(F.col("level") == depth).alias("leaves"), F.count_if(F.col("amount") > 0).alias("funded"))


def nest(tree: DataFrame, depth: int) -> DataFrame:
    """One row: the tree as nested structs (name, amount, n, children), for export of a tree of bounded size."""
    level = tree.filter(F.col("level") == depth).select("path", F.struct("name", "amount", "n").alias("node"))
    for k in range(depth - 1, -1, -1):
        order = F.array_sort(F.collect_list("node"), lambda a, b: F.when(a["amount"] > b["amount"], -1).when(a["amount"] < b["amount"], 1).when(a["name"] < b["name"], -1).otherwise(1))
        up = level.withColumn("path", F.slice("path", 1, k)).groupBy("path").agg(order.alias("children"))
        level = tree.filter(F.col("level") == k).join(up, "path", "left").select("path", F.struct("name", "amount", "n", "children").alias("node"))
    return level.select("node.*")
