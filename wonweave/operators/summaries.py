"""Headline counts, of all and of parts, in one pass; and orders of rows that reports keep to."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wonweave.operators import classify


def headlines(df: DataFrame, keys: Sequence[str], sets: Sequence[Sequence[str]], figures: Mapping[str, Column]) -> DataFrame:
    """keys (null where a row is of all of them), by (which keys it is of), figures: one aggregate over grouping sets.

    A null key is told from one that isn't grouped by through `by`.
    """
    of = [F.when(F.grouping(k) == 0, F.lit(k)) for k in keys]
    by = F.array_join(F.array_compact(F.array(*of)), ",")
    return df.groupingSets([[F.col(k) for k in s] for s in sets], *keys).agg(by.alias("by"), *[c.alias(n) for n, c in figures.items()])


def record_headlines(record: DataFrame, mix: DataFrame) -> DataFrame:
    """Of all and of each office: businesses, their amounts, how many have documents, a local channel, local rows, and how many rows these are."""
    local = mix.filter((F.col("channel") == "local_subsidy") & (F.col("amount") > 0)).select("business_id").distinct().withColumn("has_local", F.lit(True))
    x = record.join(local, "business_id", "left")
    figures = {"businesses": F.count("*"), "total_won": F.sum("congress_amt"), "with_documents": F.count_if(F.col("n_references") > 0), "local_candidates": F.count_if(F.col("has_local")), "with_local_rows": F.count_if(F.col("local_rows") > 0), "local_rows": F.sum("local_rows")}
    return headlines(x, ["office_name"], [[], ["office_name"]], figures)


def card_headlines(cards: DataFrame, matches: DataFrame) -> DataFrame:
    """Cards of all, of each ministry, of each status and of both."""
    x = cards.select("card", "ministry").join(matches.select("card", "status"), "card", "left")
    return headlines(x, ["ministry", "status"], [[], ["ministry"], ["status"], ["ministry", "status"]], {"cards": F.count("*"), "matched_share": F.bround(F.count_if(F.col("status") == "matched") / F.count("*"), 6)})


def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def candidate_order() -> list[Column]:
    """Local candidates: by national amount from the highest, then region, government, code and name."""
    return [F.coalesce("national_amt", F.lit(0)).desc(), _text("region_name"), _text("local_gov_name"), _text("detail_business_code"), _text("detail_business_name")]


def map_order(reference: Column) -> list[Column]:
    """Flow maps: the reference first, then office, title and id."""
    return [F.when(reference, 0).otherwise(1), _text("office_name"), _text("title"), _text("business_id")]


def timeline_order() -> list[Column]:
    """Rows of a snapshot: by tier, national amount from the highest, region, government and code."""
    return [F.coalesce(F.array_position(F.array(*map(F.lit, classify.TIERS)), F.col("tier")), F.lit(0)), F.coalesce("national_amt", F.lit(0)).desc(), _text("region_name"), _text("local_gov_name"), _text("detail_business_code")]


def key_order() -> list[Column]:
    """Businesses, plans and keywords: by their key's parts."""
    return [F.col("canonical_key").asc_nulls_first()]


def in_order(df: DataFrame, order: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """With `place`, from 1, within each `by`: an order that a table keeps, whatever the partitions. Without `by` ranges are sorted apart and counted."""
    from pyspark.sql import Window

    if by:
        return df.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    from wonweave.sources import sinks

    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    ranged = sinks.staged(ranged, "in-order").withColumn("__part", F.shiftrightunsigned("__at", 33))
    sizes = sorted((r["__part"], r.n) for r in ranged.groupBy("__part").agg(F.count("*").alias("n")).collect())  # a row for each range
    before, rows = 0, []
    for part, n in sizes:
        rows.append((part, before))
        before += n
    starts = df.sparkSession.createDataFrame(rows, "__part long, __before long")
    place = F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return ranged.join(F.broadcast(starts), "__part").withColumn("place", place).drop("__part", "__at", "__before")
