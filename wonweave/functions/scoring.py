"""How alike two titles are."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wonweave.functions import text
from wonweave.functions.columns import col


def features(prefix: str, title: Column | str, normalized: bool = True) -> list[Column]:
    """Columns <prefix>_norm, <prefix>_tokens and <prefix>_bigrams: computed once a row, before any join."""
    norm = text.title_key(title, normalized)
    return [norm.alias(f"{prefix}_norm"), text.tokens(title, normalized).alias(f"{prefix}_tokens"), text.bigrams(norm).alias(f"{prefix}_bigrams")]


def _jaccard(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)) / F.greatest(F.size(F.array_union(a, b)), F.lit(1))


def score(a: str, b: str) -> Column:
    """struct(score, method) of the features `a` and `b`: equal 100; one holds the other 80 to 95; shared words 45 to 95; shared pairs of characters, from 35 % on, 54 to 80."""
    na, nb = F.col(f"{a}_norm"), F.col(f"{b}_norm")
    ta, tb = F.col(f"{a}_tokens"), F.col(f"{b}_tokens")
    both = F.size(F.array_intersect(ta, tb))
    pairs = _jaccard(F.col(f"{a}_bigrams"), F.col(f"{b}_bigrams"))
    shorter = F.least(F.length(na), F.length(nb)) / F.greatest(F.length(na), F.length(nb))
    made = lambda value, name: F.struct(value.cast("double").alias("score"), F.lit(name).alias("method"))
    return (
        F.when((na == "") | (nb == ""), made(F.lit(0), "none"))
        .when(na == nb, made(F.lit(100), "exact"))
        .when(na.contains(nb) | nb.contains(na), made(80 + 15 * shorter, "containment"))
        .when(both > 0, made(F.least(F.lit(95.0), 45 + 45 * _jaccard(ta, tb) + F.least(F.lit(20), 5 * (both - 1))), "tokens"))
        .when(pairs >= 0.35, made(40 + 40 * pairs, "bigrams"))
        .otherwise(made(F.lit(0), "none"))
    )


def boosted(scored: Column | str, implementer: str, name: str) -> Column:
    """8 more for a score under 88 if the implementer is named in `name`: all of it, or a word of three characters."""
    s = col(scored)
    norm, words, inside = F.col(f"{implementer}_norm"), F.col(f"{implementer}_tokens"), F.col(f"{name}_norm")
    named = ((F.coalesce(norm, F.lit("")) != "") & inside.contains(norm)) | F.exists(F.coalesce(words, F.array().cast("array<string>")), lambda w: (F.length(w) >= 3) & inside.contains(w))
    up = F.struct(F.least(F.lit(100.0), s["score"] + 8).alias("score"), F.concat(s["method"], F.lit("+implementer")).alias("method"))
    return F.when((s["score"] > 0) & (s["score"] < 88) & named, up).otherwise(s)
