"""Whether two tables hold the same rows, as often, whatever their order; and which rows differ.

Tables are compared by fingerprints of groups: counts, and sums of two 64-bit hashes of each
row. These are small, the same whatever the partitions, and those of parts of a table add up to
those of the whole. Only groups whose fingerprints differ are compared row by row. Sums that
agree by chance don't matter below: 128 bits and the count would have to.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wonweave.operators import quality


def _no_maps(kind: T.DataType) -> None:
    if isinstance(kind, T.MapType):
        raise ValueError("maps have no order: compare their entries")
    for f in kind.fields if isinstance(kind, T.StructType) else [kind] if isinstance(kind, T.ArrayType) else []:
        _no_maps(f.dataType if isinstance(f, T.StructField) else f.elementType)


def row_text(df: DataFrame, columns: Sequence[str]) -> Column:
    """A row's values as text, in order of names; null is none of the other values."""
    for c in columns:
        _no_maps(df.schema[c].dataType)
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(columns)]), {"ignoreNullFields": "false"})


def fingerprints(df: DataFrame, by: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """by, n, h1, h2 of each group; of the whole table if `by` is empty."""
    text = row_text(df, columns or df.columns)
    hashed = df.select(*by, F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"))
    wide = lambda c: F.sum(F.col(c).cast("decimal(20,0)")).cast("decimal(38,0)").alias(c)
    return hashed.groupBy(*by).agg(F.count("*").alias("n"), wide("h1"), wide("h2"))


def merged(parts: Sequence[DataFrame], by: Sequence[str]) -> DataFrame:
    """Fingerprints of tables that are put together, from theirs."""
    return reduce(DataFrame.unionByName, parts).groupBy(*by).agg(F.sum("n").alias("n"), *[F.sum(c).cast("decimal(38,0)").alias(c) for c in ("h1", "h2")])


def differing(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
    """by, n_a, n_b: groups whose fingerprints differ; 0 where a side has none. Null is a group like others."""
    name = lambda df, s: df.select(F.struct(*[F.col(k) for k in by]).alias("k"), *[F.col(c).alias(f"{c}_{s}") for c in ("n", "h1", "h2")])
    x, y = name(a, "a"), name(b, "b").withColumnRenamed("k", "k_b")
    both = x.join(y, x["k"].eqNullSafe(y["k_b"]), "full")
    same = (F.col("n_a") == F.col("n_b")) & (F.col("h1_a") == F.col("h1_b")) & (F.col("h2_a") == F.col("h2_b"))
    key = F.when(F.col("n_a").isNotNull(), F.col("k")).otherwise(F.col("k_b"))
    return both.filter(~F.coalesce(same, F.lit(False))).select(key.alias("k"), F.coalesce("n_a", F.lit(0)).alias("n_a"), F.coalesce("n_b", F.lit(0)).alias("n_b")).select("k.*", "n_a", "n_b")


def differences(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
    """The columns of `a`, side, times: rows that `a` has more often (missing from b), or `b` (extra), and how much more often. Only groups that differ are looked into."""
    columns = a.columns
    if sorted(columns) != sorted(b.columns):
        raise ValueError(f"different columns: {sorted(set(columns) ^ set(b.columns))}")
    found = differing(fingerprints(a, by), fingerprints(b, by), by).select(*[F.col(k).alias(f"__{k}") for k in by])
    on = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in by]) if by else F.lit(True)
    within = lambda df: (df.join(found, on, "left_semi") if by else df).select(*columns)
    signed = within(a).withColumn("__d", F.lit(1)).unionByName(within(b).withColumn("__d", F.lit(-1)))
    sums = signed.groupBy(*columns).agg(F.sum("__d").alias("d")).filter("d <> 0")
    return sums.select(*columns, F.when(F.col("d") > 0, "missing").otherwise("extra").alias("side"), F.abs("d").alias("times"))


def violations(a: DataFrame, b: DataFrame, by: Sequence[str], check_id: str) -> DataFrame:
    """A violation for each row that only one table has, or has more often: its group, and what it says."""
    key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in by]) if by else F.lit("")
    said = F.concat(F.col("side"), F.lit(" "), F.col("times").cast("string"), F.lit(" "), row_text(a, a.columns))
    return quality.violations(differences(a, b, by), check_id, F.lit(True), key, said)
