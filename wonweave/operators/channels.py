"""Shares of an amount by channel or item."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wonweave.functions.columns import share
from wonweave.operators import classify


def mix(lines: DataFrame, keys: Sequence[str], by: dict[str, Column], amount: str, places: int = 6) -> DataFrame:
    """keys, by, amount, line_count, share of the key's amount. One shuffle by the keys after the partial sums."""
    sums = lines.select(*keys, *[c.alias(n) for n, c in by.items()], F.col(amount).alias("amount")).groupBy(*keys, *by).agg(F.sum("amount").alias("amount"), F.count("*").alias("line_count"))
    total = F.sum("amount").over(Window.partitionBy(*keys))
    return sums.withColumn("share", share("amount", total, places))


def as_array(mixed: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """The rows of a key as an array of structs, largest amount first, then by the fields."""
    row = F.struct((-F.col("amount")).alias("__order"), *fields)
    return mixed.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(row)), lambda r: F.struct(*[r[f].alias(f) for f in fields])).alias("channels"))


def totals(items: DataFrame, code: str, amount: str) -> DataFrame:
    """code, label, amount, n in the channels' display order (`place`)."""
    labels = {c: label for c, label, _ in classify.FLOW_CHANNELS}
    return items.groupBy(code).agg(F.sum(amount).alias("amount"), F.count("*").alias("n")).withColumn("label", classify.first_value(code, labels)).withColumn("place", classify.flow_order(code)).orderBy("place", "label")
