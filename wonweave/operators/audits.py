"""Checks of cards, of matches and of local candidates; each violation is (check_id, key, message)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wonweave.functions import columns, text
from wonweave.operators import compare, quality
from wonweave.operators.quality import violations

#: What can't be a card's title or implementer, signs of markup in a title, ways of execution, the shape of codes.
NO_TITLES = ("사업명", "사업개요", "산출근거", "추진체계", "구분", "코드", "명칭")
NO_IMPLEMENTERS = ("기관명", "구분", "미정", "해당없음", "해당 없음", "사업", "사업명", "직접수행", "절차내용", "지자체 보조", "2024년결산")
MARKUP = ("colspan", "rowspan", "</", "|")
PATHS = ("직접", "위탁/출연", "보조", "융자", "출자", "기금")
CODE = r"^\d{3,6}-\d{2,6}(?:[~,]\d{2,6})*$"
EXTRACTOR, SOURCE, STATUS, MODE, LOCAL_CHANNEL = "kordoc_chunks", "lofin_QWGJK", "keyword_candidate", "keyword_dbiz_nm", "local_subsidy"
#: The least share of cards that are matched; the least length of a keyword without white space.
LEAST_MATCHED, LEAST_KEYWORD = 0.75, 4
PLACE = ("source_pdf", "page_start", "page_end", "title")


def card_checks(cards: DataFrame, sources: Sequence[str] | None = None, aggregates: int | None = None) -> DataFrame:
    """Of cards: card, source_pdf, extractor, title, code, code_type, implementer, page_start, page_end, anchor_chunk_id, source_chunk_start, source_chunk_end, exec_paths, amounts."""
    c = F.col
    title = F.trim(F.coalesce("title", F.lit("")))
    filled = lambda name: F.coalesce(c(name), F.lit("")) != ""
    strings = F.array().cast("array<string>")
    paths, amounts = F.coalesce("exec_paths", strings), F.coalesce("amounts", strings)
    marked = F.exists(F.array(*map(F.lit, MARKUP)), lambda m: F.contains(F.lower(title), m))
    rules = {
        "card_extractor": ~F.coalesce(c("extractor") == EXTRACTOR, F.lit(False)), "card_title": (title == "") | title.isin(*NO_TITLES), "card_markup": marked, "card_code": ~F.coalesce(c("code"), F.lit("")).rlike(CODE),
        "card_pages": ~F.coalesce((c("page_start") >= 1) & (c("page_start") <= c("page_end")), F.lit(False)), "card_chunks": ~(filled("anchor_chunk_id") & filled("source_chunk_start") & filled("source_chunk_end")),
        "card_code_type": ~F.coalesce(c("code_type").isin("detail", "aggregate"), F.lit(False)), "card_implementer": F.trim(F.coalesce("implementer", F.lit(""))).isin(*NO_IMPLEMENTERS),
        "card_paths": F.exists(paths, lambda p: ~p.isin(*PATHS)), "card_paths_twice": F.size(F.array_distinct(paths)) < F.size(paths), "card_amounts": F.exists(amounts, lambda a: a.rlike("[\\n\\r]")),
    }
    if sources is not None:
        rules["card_source"] = ~F.coalesce(c("source_pdf").isin(*sources), F.lit(False))
    bad = F.filter(F.array(*[F.when(F.coalesce(holds, F.lit(False)), F.lit(name)) for name, holds in rules.items()]), lambda x: x.isNotNull())
    each = cards.select("card", F.explode(bad).alias("check_id")).select("check_id", c("card").cast("string").alias("key"), F.lit("card").alias("message"))
    parts = [each, quality.not_unique(cards, "card_place", [*PLACE, "code"])]
    if aggregates is not None:
        n = cards.agg(F.count_if(c("code_type") == "aggregate").alias("n"))
        parts.append(violations(n, "card_aggregates", c("n") != aggregates, F.lit("aggregate"), c("n").cast("string")))
    return quality.union(parts)


def match_checks(cards: DataFrame, matches: DataFrame, top3: DataFrame, detail: DataFrame, least: float = LEAST_MATCHED) -> DataFrame:
    """Of matches (card, status, detail, score, method): besides match_rules(), what ties them to cards (card, ministry, code_type, PLACE) and businesses (detail, office_name, detail_business_name).

    A matched card is of its business's office; an exact name is that of one business of its office; aggregate
    headings are left open; every card is there once; enough are matched.
    """
    c = F.col
    named = detail.withColumn("name", text.name_key("detail_business_name"))
    once = named.withColumn("same", F.count("*").over(_by("office_name", "name"))).select("detail", c("office_name").alias("office"), "same")
    held = matches.join(cards.select("card", "ministry", "code_type"), "card", "left").join(once, "detail", "left")
    matched = c("status") == "matched"
    ranks = top3.select("card", F.explode("top3").alias("t")).select("card", c("t.score").alias("score"))
    share = matches.agg(F.count("*").alias("n"), F.count_if(matched).alias("m"))
    return quality.union([
        quality.match_rules(matches), violations(ranks, "rank_score", ~c("score").between(0, 100), c("card"), "score"),
        violations(held, "match_unknown", matched & c("office").isNull(), c("card"), "unknown business"), violations(held, "match_office", matched & (c("ministry") != c("office")), c("card"), "another office"),
        violations(held, "match_name", matched & c("method").startswith("exact") & (c("same") > 1), c("card"), "a name of several businesses"),
        violations(held, "match_aggregate", (c("code_type") == "aggregate") & ~((c("status") == "ambiguous") & (c("method") == "aggregate_heading")), c("card"), "an aggregate heading is matched"),
        compare.violations(cards.select("card"), matches.select("card"), [], "match_cards"), violations(share, "match_share", (c("n") > 0) & (c("m") < c("n") * least), F.lit("matched"), F.concat_ws(" of ", c("m").cast("string"), c("n").cast("string"))),
    ])


def _by(*keys: str):
    from pyspark.sql import Window

    return Window.partitionBy(*keys)


IDENTITY = ("exe_ymd", "local_gov_code", "detail_business_code")


def candidate_checks(rows: DataFrame, records: DataFrame, mix: DataFrame, attached: DataFrame | None = None) -> DataFrame:
    """Of local candidates: central_key, central_name, year, exe_ymd, source, match_status, match_mode, keyword, keyword_strategy, national_amt, central_amount, IDENTITY.

    `records`: business_id, canonical_key; `mix`: business_id, channel, amount. `attached` (canonical_key, IDENTITY) must
    be the same rows, as often.
    """
    c = F.col
    name = F.concat_ws("|", F.array_join("central_key", "/", "null"), *[F.coalesce(x, F.lit("null")) for x in IDENTITY])
    local = mix.filter(c("channel") == LOCAL_CHANNEL).groupBy("business_id").agg(F.sum("amount").alias("local_amount"))
    known = records.select("business_id", c("canonical_key").alias("k")).join(local, "business_id", "left").select("k", F.coalesce("local_amount", F.lit(0)).alias("local_amount"))
    x = rows.withColumn("__name", name).join(known, c("central_key") == c("k"), "left")
    year = F.element_at(c("central_key"), 1)
    rules = {
        "candidate_key": ~columns.is_key("central_key"), "candidate_business": c("k").isNull(), "candidate_year": ~(columns.year_text("year") == year), "candidate_day": ~columns.is_snapshot_date("exe_ymd", year),
        "candidate_source": ~((c("source") == SOURCE) & (c("match_status") == STATUS) & (c("match_mode") == MODE)), "candidate_keyword": F.length(F.regexp_replace(F.coalesce("keyword", F.lit("")), r"(?U)\s+", "")) < LEAST_KEYWORD, "candidate_strategy": F.coalesce("keyword_strategy", F.lit("")) == "",
        "candidate_name": ~(c("central_name") == F.element_at(c("central_key"), -1)), "candidate_amount": ~(c("national_amt") > 0), "candidate_identity": F.exists(F.array(*IDENTITY), lambda v: F.coalesce(v, F.lit("")) == ""),
        "candidate_central": c("k").isNotNull() & ~((c("local_amount") > 0) & (c("central_amount") == c("local_amount"))),
    }
    bad = F.filter(F.array(*[F.when(F.coalesce(holds, F.lit(True)), F.lit(n)) for n, holds in rules.items()]), lambda v: v.isNotNull())
    each = x.select("__name", F.explode(bad).alias("check_id")).select("check_id", c("__name").alias("key"), F.lit("candidate").alias("message"))
    parts = [each, quality.not_unique(rows.withColumn("central_key", F.array_join("central_key", "/", "null")), "candidate_twice", ["central_key", *IDENTITY])]
    if attached is not None:
        parts.append(compare.violations(rows.select(c("central_key").alias("canonical_key"), *IDENTITY), attached.select("canonical_key", *IDENTITY), ["canonical_key"], "candidate_attached"))
    return quality.union(parts)
