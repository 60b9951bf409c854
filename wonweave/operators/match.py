"""Blocked fuzzy linkage of document cards with detail businesses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wonweave.functions import scoring
from wonweave.operators import dedupe


def candidates(cards: DataFrame, details: DataFrame, block: str = "block", boost: bool = False) -> DataFrame:
    """Scored pairs of one block. Both sides bring the columns of scoring.features (c_..., d_...), `card` and `detail`; what Python computes, it computes for each side's rows and not for pairs."""
    pairs = cards.join(details, block).withColumn("s", scoring.score("c", "d"))
    if boost:
        pairs = pairs.withColumn("s", scoring.boosted("s", "i", "d"))
    return pairs.select(block, "card", "detail", F.col("s.score").alias("score"), F.col("s.method").alias("method")).filter("score > 0")


def decide(score: Column, margin: Column, exact: Column, n_exact: Column, aggregate: Column) -> Column:
    """struct(status, confidence) of a card's best candidate. Unrounded scores count; a null margin means that there is no second."""
    clear = margin.isNull() | (margin >= 8)
    made = lambda status, confidence: F.struct(F.lit(status).alias("status"), F.lit(confidence).alias("confidence"))
    return (
        F.when(aggregate, made("ambiguous", "low"))
        .when(exact & (n_exact == 1), made("matched", "high"))
        .when((score >= 88) & clear, made("matched", "high"))
        .when((score >= 70) & clear, made("matched", "medium"))
        .when(score >= 55, made("ambiguous", "low"))
        .otherwise(made("unmatched", "none"))
    )


def best(cards: DataFrame, pairs: DataFrame) -> DataFrame:
    """card, detail, score (2 places), method, status, confidence, margin for each card (card, aggregate)."""
    ranked = dedupe.best_and_second(pairs, "card", "score", "detail").withColumn("n_exact", F.count_if(F.col("method") == "exact").over(Window.partitionBy("card"))).filter("rank = 1")
    joined = cards.select("card", "aggregate").join(ranked, "card", "left")
    out = joined.withColumn("d", decide(F.col("score"), F.col("margin"), F.coalesce(F.col("method") == "exact", F.lit(False)), F.coalesce("n_exact", F.lit(0)), F.col("aggregate")))
    return out.select("card", F.when(F.col("d.status") == "matched", F.col("detail")).alias("detail"), F.bround(F.coalesce("score", F.lit(0.0)), 2).alias("score"), F.when(F.col("aggregate"), "aggregate_heading").when(F.col("d.status") == "unmatched", "none").otherwise(F.col("method")).alias("method"), F.col("d.status").alias("status"), F.col("d.confidence").alias("confidence"), F.bround("margin", 2).alias("margin"))


def top3(pairs: DataFrame) -> DataFrame:
    """card, top3: its best candidates with scores of 2 places."""
    ranked = dedupe.best_and_second(pairs, "card", "score", "detail").filter("rank <= 3")
    row = F.struct("rank", F.bround("score", 2).alias("score"), F.col("method").alias("reason"), "detail")
    return ranked.groupBy("card").agg(F.sort_array(F.collect_list(row)).alias("top3"))


def summary(matches: DataFrame) -> DataFrame:
    """Counts by status and confidence, and the share that matched (3 places; 0 of none)."""
    n = F.count("*")
    each = lambda c, v: F.count_if(F.col(c) == v).alias(v)
    return matches.agg(n.alias("cards"), each("status", "matched"), each("status", "ambiguous"), each("status", "unmatched"), each("confidence", "high"), each("confidence", "medium"), F.bround(F.count_if(F.col("status") == "matched") / F.greatest(n, F.lit(1)), 3).alias("match_rate"))


def methods(matches: DataFrame) -> DataFrame:
    """How often each method decided; unmatched cards don't count."""
    return matches.filter("status <> 'unmatched'").groupBy("method").agg(F.count("*").alias("n"))
