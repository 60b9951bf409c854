"""Checks as rows: each violation is (check_id, key, message)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def violations(df: DataFrame, check_id: str, bad: Column, key: Column, message: Column | str) -> DataFrame:
    said = F.lit(message) if isinstance(message, str) else message
    return df.filter(F.coalesce(bad, F.lit(False))).select(F.lit(check_id).alias("check_id"), key.cast("string").alias("key"), said.alias("message"))


def not_unique(df: DataFrame, check_id: str, keys: Sequence[str]) -> DataFrame:
    joined = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return violations(df.groupBy(*keys).agg(F.count("*").alias("__n")), check_id, F.col("__n") > 1, joined, F.concat(F.lit("rows: "), F.col("__n").cast("string")))


def blank(df: DataFrame, check_id: str, columns: Sequence[str], key: str) -> DataFrame:
    parts = [violations(df, check_id, F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == "", F.col(key), f"{c} is blank") for c in columns]
    return union(parts)


def missing(df: DataFrame, other: DataFrame, check_id: str, key: str, other_key: str) -> DataFrame:
    """Keys without a row in `other`."""
    known = other.select(F.col(other_key).alias("__k")).distinct()
    return violations(df.filter(F.col(key).isNotNull()).join(known, F.col(key) == F.col("__k"), "left_anti").select(key).distinct(), check_id, F.lit(True), F.col(key), "unknown key")


def outside(df: DataFrame, check_id: str, c: str, allowed: Sequence[str], key: str) -> DataFrame:
    return violations(df, check_id, ~F.coalesce(F.col(c), F.lit("")).isin(*allowed), F.col(key), F.concat(F.lit(f"{c}: "), F.coalesce(F.col(c), F.lit("null"))))


def sums_differ(a: DataFrame, b: DataFrame, check_id: str, key: str, amount_a: str, amount_b: str, within: float = 0.0) -> DataFrame:
    """Keys whose sums in the two frames differ, or that only one of them has."""
    sa = a.groupBy(F.col(key).alias("k")).agg(F.sum(amount_a).alias("x"))
    sb = b.groupBy(F.col(key).alias("k")).agg(F.sum(amount_b).alias("y"))
    both = sa.join(sb, "k", "full")
    return violations(both, check_id, F.col("x").isNull() | F.col("y").isNull() | (F.abs(F.col("x") - F.col("y")) > within), F.col("k"), F.concat_ws(" <> ", F.coalesce(F.col("x").cast("string"), F.lit("none")), F.coalesce(F.col("y").cast("string"), F.lit("none"))))


def tree_sums(tree: DataFrame, check_id: str) -> DataFrame:
    """Nodes of a long tree whose children don't sum to them, in amount or count."""
    key = lambda p: F.array_join(p, "\x1f")
    kids = tree.filter("level > 0").groupBy(key(F.slice("path", F.lit(1), F.col("level") - 1)).alias("k"), (F.col("level") - 1).alias("l")).agg(F.sum("amount").alias("a"), F.sum("n").alias("c"))
    joined = tree.withColumn("k", key(F.col("path"))).join(kids, (F.col("level") == F.col("l")) & (tree_key() == kids["k"]))
    return violations(joined, check_id, (F.col("amount") != F.col("a")) | (F.col("n") != F.col("c")), tree_key(), "children differ")


def tree_key() -> Column:
    return F.array_join("path", "\x1f")


def completeness(rows: DataFrame, declared: DataFrame, key: str, page: str | None = None) -> DataFrame:
    """key, rows, total, issues (array, empty if complete): no rows, no total, total differs, pages aren't 1 ... n. Keys of either frame."""
    pages = [F.countDistinct(page).alias("n_pages"), F.min(page).alias("first_page"), F.max(page).alias("last_page")] if page else []
    found = rows.groupBy(key).agg(F.count("*").alias("rows"), *pages)
    both = declared.select(key, "total").join(found, key, "full")
    n = F.coalesce("rows", F.lit(0))
    issues = [F.when(n == 0, "no rows"), F.when(F.col("total").isNull(), "total missing"), F.when(F.col("total").isNotNull() & (F.col("total") != n), "total differs")]
    if page:
        issues.append(F.when((n > 0) & ((F.col("first_page") != 1) | (F.col("last_page") != F.col("n_pages"))), "pages missing"))
    return both.select(key, n.alias("rows"), "total", F.array_compact(F.array(*issues)).alias("issues"))


def match_rules(matches: DataFrame) -> DataFrame:
    """Status vocabulary, scores in range, a detail exactly for what matched."""
    return union([outside(matches, "match_status", "status", ("matched", "ambiguous", "unmatched"), "card"), violations(matches, "match_score", ~F.col("score").between(0, 100), F.col("card"), "score"), violations(matches, "match_detail", (F.col("status") == "matched") != F.col("detail").isNotNull(), F.col("card"), "detail")])


def one_channel(items: DataFrame, check_id: str = "one_channel") -> DataFrame:
    """Items that aren't in exactly one channel."""
    n = items.groupBy("business_id", "item_id").agg(F.countDistinct("code").alias("n"))
    return violations(n, check_id, F.col("n") != 1, F.concat_ws("|", F.col("business_id").cast("string"), "item_id"), "channels")


def spans_hold(spans: DataFrame, chunks: DataFrame, check_id: str = "span") -> DataFrame:
    """Spans (source_pdf, block_start, block_end, page_start, page_end) whose pages aren't those of their chunks."""
    from wonweave.operators.sections import chunks_in

    pages = chunks_in(spans, chunks).groupBy("source_pdf", "block_start", "block_end", "page_start", "page_end").agg(F.min("chunk_page").alias("a"), F.max("chunk_page").alias("z"))
    return violations(pages, check_id, (F.col("page_start") != F.col("a")) | (F.col("page_end") != F.col("z")), F.concat_ws("|", "source_pdf", F.col("block_start").cast("string")), "pages")


def union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def report(all_violations: DataFrame, examples: int = 4) -> DataFrame:
    """check_id, n, examples (the first few keys). Tasks pass on no more than the first few keys of each check."""
    n = all_violations.groupBy("check_id").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("check_id").orderBy("key"))
    first = all_violations.select("check_id", "key").distinct().withColumn("place", place).filter(F.col("place") <= examples)
    return n.join(first.groupBy("check_id").agg(F.array_sort(F.collect_list("key")).alias("examples")), "check_id")
