"""From businesses with local transfers to keyword queries and their rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wonweave.functions import columns, text
from wonweave.functions.columns import col
from wonweave.operators import classify, dedupe

#: Verified keywords, the first whose needle a name holds; keywords that are too general.
OVERRIDES = ("지역사랑상품권", "재해위험지역", "사회연대경제", "청년월세", "스마트시티", "주거급여")
GENERIC = ("건설사업", "기반시설", "관리사업", "보조사업", "시설개선", "운영지원", "재정지원", "지역개발", "투자유치")
#: Fixed value: a subproject that a document names, as a second query of its business.
DOCUMENTED = ((("2026", "행정안전부", "지역균형발전특별회계", "정부혁신조직", "주민참여 지역문제 해결 확산", "지역사회 자생적 창조역량 강화"), "사회연대경제 활성화", "사회연대경제"),)
LEAST = 5


def select(lines: DataFrame, businesses: DataFrame, keys: list[str], amount: str, local: Column) -> DataFrame:
    """Known businesses with their sum and count of local-transfer lines, where that is over 0."""
    known = lines.join(businesses.select(*keys).distinct(), keys, "left_semi")
    return known.filter(local).groupBy(*keys).agg(F.sum(amount).alias("local_amount"), F.count("*").alias("local_lines")).filter("local_amount > 0")


def choose(name: Column | str, key=text.plain_key) -> Column:
    """struct(keyword, strategy, reason) of a business name."""
    original = text.collapse(name)
    squeezed = key(original)
    bare = F.regexp_replace(text.collapse(F.regexp_replace(F.regexp_replace(original, r"\([^()]*\)", " "), "[·ㆍ,/~]+", " ")), r"^[ \-_]+|[ \-_]+$", "")
    bare = F.trim(F.regexp_replace(bare, r"\s+(사업|지원|추진)$", ""))
    made = lambda keyword, strategy, reason: F.struct(keyword.cast("string").alias("keyword"), strategy.cast("string").alias("strategy"), reason.cast("string").alias("reason"))
    none = F.lit(None)
    strategy = F.when(bare == original, "normalized_full_title").otherwise("normalized_without_parenthetical_qualifier")
    out = F.when(F.length(key(bare)) < LEAST, made(none, none, F.lit(f"keyword_shorter_than_{LEAST}_semantic_characters"))).when(key(bare).isin(*GENERIC), made(none, none, F.lit("keyword_is_generic"))).otherwise(made(bare, strategy, none))
    for needle in reversed(OVERRIDES):
        out = F.when(squeezed.contains(needle), made(F.lit(needle), F.lit(f"verified_override:{needle}"), none)).otherwise(out)
    return out


def expand(plan: DataFrame, key: str) -> DataFrame:
    """The plan's queries, and a second for each documented subproject of a business in it."""
    spark = plan.sparkSession
    seeds = spark.createDataFrame([(list(k), name, word) for k, name, word in DOCUMENTED], "k array<string>, matched_subproject string, w string")
    first = plan.withColumn("matched_subproject", F.lit(None).cast("string"))
    more = plan.join(F.broadcast(seeds), F.col(key) == F.col("k")).withColumn("keyword", F.col("w")).withColumn("strategy", F.lit("documented_pdf_subproject_title")).drop("k", "w")
    return first.filter("keyword IS NOT NULL").unionByName(more)


def fan_out(queries: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows that were fetched once for a keyword, for each query of it."""
    return queries.join(rows, "keyword")


def to_fetch(queries: DataFrame, cached: DataFrame) -> DataFrame:
    """Distinct keywords that aren't cached."""
    return queries.select("keyword").distinct().join(cached.select("keyword").distinct(), "keyword", "left_anti").orderBy("keyword")


def local_rows(raw: DataFrame, year: Column, day: Column) -> DataFrame:
    """Rows of the year and day with a positive national amount; what is no number drops."""
    national = columns.number_or_null("bdg_ntep")
    kept = raw.filter((columns.number_or_null("fyr", "int") == year) & (F.col("exe_ymd") == day) & (national > 0))
    amounts = {"budget_cash_amt": "bdg_cash_amt", "national_amt": "bdg_ntep", "sido_amt": "capep", "sigungu_amt": "sggep", "other_amt": "etc_amt", "spend_amt": "ep_amt", "compile_amt": "cpl_amt"}
    names = {"region_code": "wa_laf_cd", "region_name": "wa_laf_hg_nm", "local_gov_code": "laf_cd", "local_gov_name": "laf_hg_nm", "account_name": "acnt_dv_nm", "detail_business_name": "dbiz_nm", "detail_business_code": "dbiz_cd", "field_name": "fld_nm"}
    return kept.select(
        year.alias("year"), "exe_ymd", *[F.col(v).alias(k) for k, v in names.items()], F.coalesce(F.nullif(F.col("part_nm"), F.lit("")), F.col("sect_nm")).alias("section_name"),
        classify.local_level("laf_cd").alias("local_level"), *[F.coalesce(columns.number_or_null(v), F.lit(0.0)).try_cast(columns.WON).alias(k) for k, v in amounts.items()], *[c for c in raw.columns if c in ("keyword", "central_key")],
    )


def identity() -> list[Column]:
    """What makes two local rows one: day, government, business."""
    return [F.col("exe_ymd"), F.coalesce(F.nullif(F.col("local_gov_code"), F.lit("")), F.col("local_gov_name")), F.coalesce(F.nullif(F.col("detail_business_code"), F.lit("")), text.plain_key(F.concat_ws("", "account_name", "detail_business_name")))]


def dedupe_rows(rows: DataFrame, owner: str) -> DataFrame:
    """Of rows of one owner and identity that with the least JSON."""
    keyed = rows.withColumn("__i", F.concat_ws("\x1f", *identity()))
    return dedupe.least_by_json(keyed, [owner, "__i"]).drop("__i")


def plan(businesses: DataFrame, name: str) -> DataFrame:
    c = choose(col(name))
    return businesses.withColumn("c", c).select("*", "c.keyword", "c.strategy", "c.reason").drop("c")
