"""Money flows: items, subprojects, crosswalks, local candidates, and whether sums agree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wonweave.functions import columns
from wonweave.functions.columns import col

#: What documents say of the money of the documented business; (subproject, channel, won).
CROSSWALK = (
    ("데이터 기반 지역문제해결 사업", "private_delegation", 982_000_000),
    ("다부처 협업 지역역량성장거점 활성화", "local_subsidy", 1_600_000_000),
    ("사회연대경제 활성화", "local_subsidy", 10_350_000_000),
    ("사회연대경제 활성화", "procurement", 1_489_000_000),
)


def items(lines: DataFrame, business: str, amount: str, seq: Sequence[str]) -> DataFrame:
    """Lines with a positive amount, each with the ordinal id that it had among all."""
    n = F.row_number().over(Window.partitionBy(business).orderBy(*seq))
    return lines.withColumn("item_id", F.concat(F.lit("item-"), F.lpad(n.cast("string"), 2, "0"))).filter(F.col(amount) > 0)


def crosswalk(subprojects: DataFrame, channels: DataFrame, definitions: DataFrame, business: str = "business_id") -> DataFrame:
    """business, subproject_id, channel_id, amount of the definitions (label, code, amount) whose label and code the business has; others drop."""
    d = F.broadcast(definitions)  # a fixed list
    return subprojects.alias("s").join(d.alias("d"), "label").join(channels.alias("c"), (F.col(f"c.{business}") == F.col(f"s.{business}")) & (F.col("c.code") == F.col("d.code"))).select(F.col(f"s.{business}").alias(business), F.col("s.id").alias("subproject_id"), F.col("c.id").alias("channel_id"), F.col("d.amount").alias("amount"))


def crosswalk_agrees(allocations: DataFrame, subprojects: DataFrame, by: str = "subproject_id") -> DataFrame:
    """Sums of allocations against what they allocate (id, amount), with their difference."""
    a = allocations.groupBy(F.col(by).alias("id")).agg(F.sum("amount").alias("allocated"))
    return subprojects.join(a, "id", "left").withColumn("difference", F.coalesce("allocated", F.lit(0)) - F.col("amount"))


def with_subproject(rows: DataFrame, subprojects: DataFrame, name: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows left-joined with the subproject of their (normalised) name; of several of one label the last counts."""
    last = subprojects.groupBy(*keys, F.col("name_key").alias(name)).agg(F.max_by("id", "seq").alias("subproject_id"))
    return rows.join(last, [*keys, name], "left")


def seeded(rows: DataFrame, seeds: DataFrame, on: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """`fields` from a fixed seed table where it has the row's key."""
    s = F.broadcast(seeds.select(*on, *[F.col(f).alias(f"__{f}") for f in fields]))
    out = rows.join(s, list(on), "left")
    for f in fields:
        out = out.withColumn(f, F.coalesce(f"__{f}", f)).drop(f"__{f}")
    return out


def funded(rows: DataFrame, parts: Sequence[str], budget: str, spend: str) -> DataFrame:
    """With funding_total, funding_gap, execution_rate (null without a budget) and additive = false."""
    total = sum((F.coalesce(F.col(p), F.lit(0)) for p in parts), F.lit(0))
    return rows.withColumn("funding_total", total).withColumn("funding_gap", F.col(budget) - total).withColumn("execution_rate", columns.rate(spend, budget)).withColumn("additive", F.lit(False))


def region_rollup(rows: DataFrame, keys: Sequence[str], gov: Column, sums: Sequence[str], counts: dict[str, Column], spend: str | None = None, budget: str | None = None) -> DataFrame:
    """n, governments, conditional counts and sums of each region; with `spend` and `budget` (of the sums) its execution_rate, null without a budget."""
    out = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.countDistinct(gov).alias("governments"), *[F.count_if(c).alias(k) for k, c in counts.items()], *[F.sum(s).alias(s) for s in sums])
    return out.withColumn("execution_rate", columns.rate(spend, budget)) if spend and budget else out


def candidate_summary(rows: DataFrame, gov: Column, kind: str, sums: Sequence[str]) -> DataFrame:
    """One row: counts, distinct governments, kinds as a sorted array and a map of counts, sums."""
    by_kind = rows.groupBy(kind).agg(F.count("*").alias("n")).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(kind, "n")))).alias("by_kind"))
    one = rows.agg(F.count("*").alias("n"), F.countDistinct(gov).alias("governments"), F.sort_array(F.collect_set(kind)).alias("kinds"), *[F.sum(s).alias(s) for s in sums])
    return one.crossJoin(by_kind)  # one row each


def level_summary(rows: DataFrame, level: str, gov: str, amount: str, seq: str, most: int = 20) -> tuple[DataFrame, DataFrame]:
    """(sums by level; the top governments by amount, with the level last seen)."""
    levels = rows.groupBy(level).agg(F.count("*").alias("n"), F.sum(amount).alias("amount"))
    govs = rows.groupBy(gov).agg(F.count("*").alias("n"), F.sum(amount).alias("amount"), F.max_by(level, seq).alias(level))
    return levels, govs.orderBy(F.desc("amount"), gov).limit(most)


def reconciled(businesses: DataFrame, parts: dict[str, DataFrame], key: str, total: str) -> DataFrame:
    """For each part (key, amount) its sum and its difference from the business's total; null where a business has none of it."""
    out = businesses.select(key, total)
    for name, df in parts.items():
        out = out.join(df.groupBy(key).agg(F.sum("amount").alias(f"{name}_total")), key, "left").withColumn(f"{name}_difference", F.col(f"{name}_total") - F.col(total))
    return out


def gap(observed: DataFrame, central: DataFrame) -> DataFrame:
    """observed - central of two one-row frames (amount), their ratio, and that they can't be reconciled."""
    return observed.select(F.col("amount").alias("observed")).crossJoin(central.select(F.col("amount").alias("central"))).select("observed", "central", (F.col("observed") - F.col("central")).alias("gap"), columns.rate("observed", "central").alias("ratio"), F.lit(False).alias("reconcilable"))


def composition(rows: DataFrame, key: Sequence[str], parts: Sequence[str]) -> DataFrame:
    """key, part, amount, share of each positive part of a row's funding."""
    long = rows.select(*key, F.explode(F.array(*[F.struct(F.lit(p).alias("part"), col(p).alias("amount")) for p in parts])).alias("x")).select(*key, "x.*").filter("amount > 0")
    return long.withColumn("share", columns.share("amount", F.sum("amount").over(Window.partitionBy(*key))))


def money_edges(business: DataFrame, item_rows: DataFrame, subprojects: DataFrame, cross: DataFrame) -> DataFrame:
    """src, dst, amount, type from source to business to subprojects and items to channels to destinations."""
    e = lambda df, s, d, a, t: df.select(F.col("business_id"), s.alias("src"), d.alias("dst"), a.cast("long").alias("amount"), F.lit(t).alias("type"))
    b = F.col("business_id").cast("string")
    tag = lambda name, c: F.concat(F.lit(f"{name}:"), b, F.lit(":"), c.cast("string"))
    to_channel = item_rows.groupBy("business_id", "code").agg(F.sum("amount").alias("amount"))
    parts = [
        e(business, F.lit("source"), tag("business", F.lit("")), F.col("amount"), "source"), e(subprojects, tag("business", F.lit("")), tag("sub", F.col("id")), F.col("amount"), "subproject"), e(item_rows, tag("business", F.lit("")), tag("item", F.col("item_id")), F.col("amount"), "item"),
        e(item_rows, tag("item", F.col("item_id")), tag("channel", F.col("code")), F.col("amount"), "channel"), e(to_channel, tag("channel", F.col("code")), tag("destination", F.col("code")), F.col("amount"), "destination"), e(cross, tag("sub", F.col("subproject_id")), tag("channel", F.col("code")), F.col("amount"), "crosswalk"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
