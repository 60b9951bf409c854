"""Order-aware duplicates, ranks and ordinal ids. `seq` always is an explicit order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wonweave.functions.columns import col


def first_by(df: DataFrame, keys: Sequence[str], seq: Sequence[Column | str]) -> DataFrame:
    """The first row of each key."""
    w = Window.partitionBy(*keys).orderBy(*seq)
    return df.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def least_by_json(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The row of the least JSON (fields in order of their names) of each key; combines before it shuffles."""
    names = sorted(df.columns)
    row = F.struct(*[F.col(f"`{n}`") for n in names])
    text = F.to_json(row, {"ignoreNullFields": "false"})
    return df.groupBy(*keys).agg(F.min_by(row, text).alias("__r")).select(*[F.col(f"__r.`{n}`").alias(n) for n in df.columns])


def best_and_second(df: DataFrame, key: str, score: str, tie: str) -> DataFrame:
    """`df` with rank (1: best) and margin, the best's lead over the second (null if it is alone)."""
    w = Window.partitionBy(key).orderBy(F.desc(score), tie)
    return df.withColumn("rank", F.row_number().over(w)).withColumn("margin", F.col(score) - F.lead(score).over(w))


def top(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int) -> DataFrame:
    """The first n rows of each key."""
    w = Window.partitionBy(*keys).orderBy(*order) if keys else Window.orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def ordinal_id(prefix: str, keys: Sequence[str], order: Sequence[Column | str], width: int = 3) -> Column:
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("string")
    return F.concat(F.lit(f"{prefix}-"), F.when(F.length(n) < width, F.lpad(n, width, "0")).otherwise(n))


def shared_by_owners(df: DataFrame, owner: str, identity: Sequence[str]) -> DataFrame:
    """`df` with `shared`: whether several owners have rows of this identity. Counted, then joined back."""
    n = df.groupBy(*identity).agg(F.countDistinct(owner).alias("__owners"))
    same = F.lit(True)
    left, right = df.alias("l"), n.alias("r")
    for c in identity:
        same = same & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    return left.join(right, same, "left").select("l.*", (F.col("__owners") > 1).alias("shared"))


def multiset_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one that the other lacks, with `side`; multiplicities count."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def set_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys of one that the other lacks, with `side`."""
    ka, kb = a.select(key).distinct(), b.select(key).distinct()
    return ka.join(kb, key, "left_anti").withColumn("side", F.lit("left")).unionByName(kb.join(ka, key, "left_anti").withColumn("side", F.lit("right")))


def keep_if_any(df: DataFrame, c: Column | str) -> DataFrame:
    return df.filter(F.coalesce(col(c), F.lit(False)))
