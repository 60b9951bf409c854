"""Snapshots by date. They are states, cumulative to their date: never sum over dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wonweave.functions.columns import rate


def tier_summary(rows: DataFrame, date: str, tier: str, tiers: Sequence[str], dates: DataFrame, gov: Column, sums: Sequence[str], spend: str, budget: str) -> DataFrame:
    """A row for each date of `dates` and each tier, also without rows: n, governments, sums, rate of spend (null without a budget)."""
    found = rows.groupBy(date, tier).agg(F.count("*").alias("n"), F.countDistinct(gov).alias("governments"), *[F.sum(s).alias(s) for s in sums])
    domain = dates.select(date).distinct().select(date, F.explode(F.array(*[F.struct(F.lit(i).alias("tier_order"), F.lit(t).alias(tier)) for i, t in enumerate(tiers)])).alias("t")).select(date, "t.*")
    dense = domain.join(found, [date, tier], "left")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "governments", *sums)]
    return dense.select(date, tier, "tier_order", *zero).withColumn("rate", rate(spend, budget))


def as_of(rows: DataFrame, days: DataFrame, event_day: str, date: str) -> DataFrame:
    """Rows known on each snapshot date (those on or before it). `days` is a short list."""
    return rows.join(F.broadcast(days), F.col(event_day) <= F.col(date))


def latest(rows: DataFrame, date: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows of the last date (of each key)."""
    if not keys:
        return rows.join(rows.agg(F.max(date).alias(date)), date, "left_semi")
    return rows.join(rows.groupBy(*keys).agg(F.max(date).alias(date)), [*keys, date], "left_semi")


def override(baseline: DataFrame, newest: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Baseline rows, replaced by the newest rows of their key; new keys are added."""
    return newest.unionByName(baseline.join(newest.select(*keys).distinct(), list(keys), "left_anti"))


def deltas(summary: DataFrame, keys: Sequence[str], date: str, value: str) -> DataFrame:
    """Change since the date before."""
    w = Window.partitionBy(*keys).orderBy(date)
    return summary.withColumn("delta", F.col(value) - F.lag(value).over(w))


def series(summary: DataFrame, date: str, tier: str, tiers: Sequence[str], value: str) -> DataFrame:
    """A row for each date with a column for each tier."""
    return summary.groupBy(date).pivot(tier, list(tiers)).agg(F.sum(value))
