"""Money-flow graphs of businesses: where the money comes from, what it is for, through what channels it goes and to whom; and, beside it, what is seen locally.

Confirmed amounts flow; local candidates and contexts are edges of amount 0 that are never added to
them. Where a source says nothing there is a node of type `unknown` in place of a guess. An edge
whose ends aren't both there is dropped.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TYPES = ("source", "core", "item", "channel", "destination", "candidate", "beneficiary", "reconcile", "unknown")
EDGES = ("flow", "classification", "crosswalk", "candidate", "context")
LOCAL_CHANNEL, REGIONS = "local_subsidy", 8


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _rows(df: DataFrame, id_: Column, type_: Column | str, stage: str, title: Column | str, amount: Column | None = None) -> DataFrame:
    made = lambda v: v if isinstance(v, Column) else F.lit(v)
    return df.select("business_id", id_.alias("id"), made(type_).alias("type"), F.lit(stage).alias("stage"), made(title).alias("title"), (amount if amount is not None else F.lit(None)).cast("decimal(20,0)").alias("amount"))


def channels(items: DataFrame) -> DataFrame:
    return items.groupBy("business_id", "code").agg(F.sum("amount").alias("amount"))


def regions(local: DataFrame, most: int = REGIONS) -> DataFrame:
    """business_id, region, amount, place, total: regions of a business by national amount, then name; the first `most`, and how many there are."""
    sums = local.groupBy("business_id", F.coalesce("region_name", F.lit("")).alias("region")).agg(F.sum("national_amt").alias("national"), F.sum("budget_cash_amt").alias("amount"))
    w = Window.partitionBy("business_id")
    ranked = sums.withColumn("place", F.row_number().over(w.orderBy(F.desc("national"), "region"))).withColumn("total", F.count("*").over(w))
    return ranked.filter(F.col("place") <= most)


def nodes(facts: Mapping[str, DataFrame], most: int = REGIONS) -> DataFrame:
    """business_id, id, type, stage, title, amount.

    `facts`: business (business_id, title, account, total), subprojects (id, label, amount), basis (text), items (item_id, title, amount, code), noted (code: channels that documents say more of), local (region_name, national_amt, budget_cash_amt,
    subproject_id), people (beneficiary); all with a business_id.
    """
    c, business = F.col, facts["business"]
    has = lambda name, df: df.select("business_id").distinct().withColumn(name, F.lit(True))
    known = business.join(has("has_subs", facts["subprojects"]), "business_id", "left").join(has("has_basis", facts["basis"].filter(F.trim("text") != "")), "business_id", "left").join(has("has_items", facts["items"]), "business_id", "left")
    seen = facts["local"].groupBy("business_id").agg(F.count("*").alias("n_local"))
    known = known.join(seen, "business_id", "left").join(facts["people"].select("business_id", "beneficiary"), "business_id", "left").na.fill(False, ["has_subs", "has_basis", "has_items"]).na.fill(0, ["n_local"])
    sums = known.join(facts["items"].groupBy("business_id").agg(F.sum("amount").alias("items_total")), "business_id", "left").join(facts["subprojects"].groupBy("business_id").agg(F.sum("amount").alias("subs_total")), "business_id", "left")
    through = channels(facts["items"]).join(facts["noted"].select("business_id", "code").distinct().withColumn("noted", F.lit(True)), ["business_id", "code"], "left")
    places = regions(facts["local"], most)
    agrees = lambda total: F.when(F.coalesce(c(total) == c("total"), F.lit(False)), "reconcile").otherwise("unknown")
    parts = [
        _rows(known, F.lit("source"), "source", "G0", c("account"), c("total")), _rows(known, F.lit("business"), "core", "G0", c("title"), c("total")),
        _rows(facts["subprojects"], _text("sub:", c("id")), "item", "G1", c("label"), c("amount")),
        _rows(known.filter("NOT has_subs"), F.when(c("has_basis"), "basis").otherwise("sub:unknown"), F.when(c("has_basis"), "item").otherwise("unknown"), "G1", F.when(c("has_basis"), "산출근거").otherwise("내역사업 배분 근거 없음")),
        _rows(facts["items"], _text("item:", c("item_id")), "item", "G2", c("title"), c("amount")), _rows(known.filter("NOT has_items"), F.lit("item:none"), "unknown", "G2", "확정 목·세목 없음", F.lit(0)),
        _rows(through, _text("channel:", c("code")), "channel", "G2", c("code"), c("amount")), _rows(known.filter("NOT has_items"), F.lit("channel:none"), "unknown", "G2", "집행채널 없음", F.lit(0)),
        _rows(through, _text("destination:", c("code")), F.when(c("noted"), "destination").otherwise("unknown"), "G3", c("code"), c("amount")),
        _rows(known, F.lit("local"), F.when(c("n_local") > 0, "candidate").otherwise("unknown"), "G4", F.when(c("n_local") > 0, _text("지역 세부사업 ", c("n_local"), "건")).otherwise("지역 편성 후보 미확인")),
        _rows(places, _text("region:", c("region")), "candidate", "G4", c("region"), c("amount")), _rows(places.filter(f"place = 1 AND total > {int(most)}"), F.lit("region:more"), "candidate", "G4", _text("그 밖의 ", c("total") - most, "개 권역")),
        _rows(known, F.lit("beneficiary"), F.when(c("beneficiary").isNotNull(), "beneficiary").otherwise("unknown"), "G5", F.coalesce("beneficiary", F.lit("수혜자 미확인"))),
        _rows(sums, F.lit("reconcile:items"), agrees("items_total"), "G5", "세부사업 총액 = 목·세목 합계", c("items_total") - c("total")), _rows(sums, F.lit("reconcile:subprojects"), agrees("subs_total"), "G5", "세부사업 총액 = 내역사업 합계", c("subs_total") - c("total")),
        _rows(known, F.lit("reconcile:local"), F.when(c("n_local") > 0, "candidate").otherwise("unknown"), "G5", "지역 스냅샷"),
    ]
    return reduce(DataFrame.unionByName, parts)


def edges(facts: Mapping[str, DataFrame], found: DataFrame, most: int = REGIONS) -> DataFrame:
    """business_id, src, dst, type, amount, between the nodes `found`. `facts` also has cross (subproject_id, code, amount)."""
    c = F.col

    def rows(df: DataFrame, src: Column, dst: Column, type_: str, amount: Column | None = None) -> DataFrame:
        return df.select("business_id", src.alias("src"), dst.alias("dst"), F.lit(type_).alias("type"), (amount if amount is not None else F.lit(0)).cast("decimal(20,0)").alias("amount"))

    through, local = channels(facts["items"]), facts["local"].select("business_id").distinct()
    places = regions(facts["local"], most)
    parts = [
        rows(facts["business"], F.lit("source"), F.lit("business"), "flow", c("total")), rows(facts["subprojects"], F.lit("business"), _text("sub:", c("id")), "flow", c("amount")), rows(facts["items"], F.lit("business"), _text("item:", c("item_id")), "flow", c("amount")),
        rows(facts["items"], _text("item:", c("item_id")), _text("channel:", c("code")), "classification"), rows(facts["cross"], _text("sub:", c("subproject_id")), _text("channel:", c("code")), "crosswalk", c("amount")), rows(through, _text("channel:", c("code")), _text("destination:", c("code")), "flow", c("amount")),
        rows(local, F.lit(f"channel:{LOCAL_CHANNEL}"), F.lit("local"), "candidate"), rows(facts["local"].filter("subproject_id IS NOT NULL").select("business_id", "subproject_id").distinct(), _text("sub:", c("subproject_id")), F.lit("local"), "candidate"),
        rows(places, F.lit("local"), _text("region:", c("region")), "candidate"), rows(places.filter(f"place = 1 AND total > {int(most)}"), F.lit("local"), F.lit("region:more"), "candidate"), rows(through, _text("destination:", c("code")), F.lit("beneficiary"), "context"), rows(local, F.lit("local"), F.lit("reconcile:local"), "context"),
    ]
    return with_both_ends(reduce(DataFrame.unionByName, parts), found, ["business_id"])


def with_both_ends(e: DataFrame, n: DataFrame, within: Sequence[str]) -> DataFrame:
    """Edges whose ends are both nodes, in the same `within`."""
    for end in ("src", "dst"):
        e = e.join(n.select(*within, F.col("id").alias(end)).distinct(), [*within, end], "left_semi")
    return e.select(*within, "src", "dst", "type", "amount")
