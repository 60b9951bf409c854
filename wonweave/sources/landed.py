"""Landed API payloads, chunk files and caches as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wonweave.functions import columns
from wonweave.functions.columns import col

LINE_FIELDS = {"office_name": "OFFC_NM", "account_name": "FSCL_NM", "acct_name": "ACCT_NM", "field_name": "FLD_NM", "section_name": "SECT_NM", "program_name": "PGM_NM", "unit_business_name": "ACTV_NM", "detail_business_name": "SACTV_NM", "mok_name": "CITM_NM", "semok_name": "EITM_NM"}
LINE_AMOUNTS = {"budget_confirm_amt_thousands": "Y_YY_DFN_KCUR_AMT", "budget_modified_amt_thousands": "Y_YY_MEDI_KCUR_AMT", "budget_confirm_plus_mod_amt_thousands": "Y_YY_DFN_MEDI_KCUR_AMT"}
CHUNK = "id string, type string, page int, text string"


def unwrap(payload: Column | str) -> Column:
    """A JSON object that may come as a JSON string; null if it is neither."""
    once = F.get_json_object(col(payload), "$")
    return F.when(F.ltrim(once).startswith("{") | F.ltrim(once).startswith("["), once).otherwise(F.get_json_object(once, "$"))


def rows_of(df: DataFrame, payload: str, service: str, row: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """keep, total, code, page_row, and the fields of each row of a service's payload; a payload without rows gives one row of nulls."""
    part = f"array<struct<head array<struct<list_total_count: bigint, RESULT: struct<CODE: string, MESSAGE: string>>>, row: array<struct<{row}>>>>"
    parsed = df.withColumn("__p", F.from_json(unwrap(payload), f"`{service}` {part}, RESULT struct<CODE: string, MESSAGE: string>"))
    lists = F.col(f"__p.`{service}`")
    heads = F.flatten(F.filter(F.transform(lists, lambda x: x["head"]), lambda h: h.isNotNull()))
    rows = F.flatten(F.filter(F.transform(lists, lambda x: x["row"]), lambda r: r.isNotNull()))
    total = F.array_max(F.transform(heads, lambda h: h["list_total_count"]))
    code = F.coalesce(F.get(F.filter(F.transform(heads, lambda h: h["RESULT"]["CODE"]), lambda c: c.isNotNull()), F.lit(0)), F.col("__p.RESULT.CODE"))
    return parsed.select(*keep, total.alias("total"), code.alias("code"), F.posexplode_outer(rows).alias("page_row", "r")).select(*keep, "total", "code", "page_row", "r.*")


def lines(rows: DataFrame, year: Column, office: Column, order: tuple[str, ...]) -> DataFrame:
    """Budget lines: names as they are, amounts in thousands or null, the amount in won."""
    amounts = {k: columns.number_or_null(v, "decimal(20,3)") for k, v in LINE_AMOUNTS.items()}
    return rows.select(
        *order, year.cast("int").alias("year"), office.alias("ministry_query"), *[F.col(v).alias(k) for k, v in LINE_FIELDS.items()], *[c.alias(k) for k, c in amounts.items()],
        (F.coalesce(amounts["budget_confirm_amt_thousands"], F.lit(0)) * 1000).cast(columns.WON).alias("congress_amt"),
    )


def chunk_files(spark: SparkSession, path: str) -> DataFrame:
    """source_pdf, chunk_idx and the fields of each chunk of files that hold one JSON array each."""
    read = spark.read.text(path, wholetext=True).select(F.regexp_replace(F.element_at(F.split(F.input_file_name(), "/"), -1), r"\.json$", "").alias("source_pdf"), F.from_json("value", f"array<struct<{CHUNK}>>").alias("c"))
    return read.select("source_pdf", F.posexplode("c").alias("chunk_idx", "c")).select("source_pdf", "chunk_idx", "c.*")


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.col("value").alias("text"))


def documents(spark: SparkSession, path: str, least: int = 1000) -> DataFrame:
    """Files that begin like PDFs and have a size; only the beginnings are compared."""
    return spark.read.format("binaryFile").load(path).filter((F.col("length") >= least) & (F.substring("content", 1, 4) == F.lit(b"%PDF"))).select("path", "length", "modificationTime")


def cache_valid(manifest: DataFrame, version: str, year: int, day: str) -> DataFrame:
    """Cached keywords that may be used: of this version, year and day, complete."""
    return manifest.filter((F.col("version") == version) & (F.col("year") == year) & (F.col("exe_ymd") == day) & F.col("complete") & (F.col("rows") == F.col("total")))


def keyword_hash(keyword: Column | str) -> Column:
    return F.substring(F.sha2(col(keyword), 256), 1, 16)


def newest_year(df: DataFrame, year: str = "year") -> DataFrame:
    return df.agg(F.max(year).alias(year))


def partial(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first rows, flagged as incomplete unless they are all."""
    return df.orderBy(*order).limit(n).withColumn("complete", F.lit(df.limit(n + 1).count() <= n))


def pages_in_order(rows: DataFrame, page: str = "page", row: str = "page_row") -> DataFrame:
    """With row_idx in order of page and row, within each office; counted by page, so that no single task orders all."""
    from pyspark.sql import Window

    sizes = rows.groupBy("office", page).agg(F.count("*").alias("__n"))
    before = sizes.withColumn("__before", F.sum("__n").over(Window.partitionBy("office").orderBy(page)) - F.col("__n"))
    inside = F.row_number().over(Window.partitionBy("office", page).orderBy(row)) - 1
    return rows.join(before.drop("__n"), ["office", page]).withColumn("row_idx", F.col("__before") + inside).drop("__before")


def page_plan(totals: DataFrame, size: int, key: str = "office") -> DataFrame:
    """key, page, expected: the pages that `total` rows fill, page 1 also where there are none or the total is unknown (expected null)."""
    last = F.greatest(F.ceil(F.coalesce("total", F.lit(0)) / size), F.lit(1)).cast("int")
    planned = totals.select(key, "total", F.explode(F.sequence(F.lit(1), last)).alias("page"))
    return planned.select(key, "page", F.when(F.col("total").isNotNull(), F.least(F.lit(size), F.greatest(F.col("total") - (F.col("page") - 1) * size, F.lit(0)))).cast("int").alias("expected"))


def page_gaps(plan: DataFrame, pages: DataFrame, key: str = "office") -> DataFrame:
    """key, page, expected, got (0 if the page is missing) of planned pages that have fewer or more rows, and pages that nothing planned or whose total is unknown (expected 0)."""
    got = pages.groupBy(key, "page").agg(F.sum("n_rows").cast("long").alias("got"))
    both = plan.join(got, [key, "page"], "full").select(key, "page", F.coalesce("expected", F.lit(0)).cast("long").alias("expected"), F.coalesce("got", F.lit(0)).alias("got"))
    return both.filter("expected <> got")
