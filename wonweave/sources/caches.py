"""Caches of fetched rows and of extracted documents: which entries hold, and what is to be done anew."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wonweave.sources import sinks

#: normal: what the cache has, else what the earlier cache has, else the service; refresh: the service; cache_only: never the service.
MODES = ("normal", "refresh", "cache_only")
CACHE, LEGACY, NETWORK, MISSING = "cache", "legacy_cache", "network", "missing"
VERSION = "1.0"
LEAST_OUTPUT = 20


class CacheMissing(Exception):
    """Keywords that only the service could answer, in a run that mustn't ask it."""


def valid_entries(entries: DataFrame, service: str, year: int, day: str) -> DataFrame:
    """keyword, entry: the latest entry of each keyword that is of this schema, service, year and day, and complete.

    `entries`: entry, keyword, schema_version, service, year, exe_ymd, complete, has_rows.
    """
    good = (F.col("schema_version") == VERSION) & (F.col("service") == service) & (F.col("year") == year) & (F.col("exe_ymd") == day) & F.col("complete") & F.col("has_rows")
    return entries.filter(good & F.col("keyword").isNotNull()).groupBy("keyword").agg(F.max("entry").alias("entry"))


def legacy_entries(entries: DataFrame, year: int, day: str) -> DataFrame:
    """As valid_entries(), of the earlier form, which says by its parameters what it answers: entry, keyword, fyr, exe_ymd, dbiz_nm, has_rows."""
    good = (F.trim(F.col("fyr").cast("string")) == str(year)) & (F.col("exe_ymd").cast("string") == day) & (F.col("dbiz_nm") == F.col("keyword")) & F.col("has_rows")
    return entries.filter(good).groupBy("keyword").agg(F.max("entry").alias("entry"))


def planned(keywords: DataFrame, valid: DataFrame, legacy: DataFrame, mode: str = "normal") -> DataFrame:
    """keyword, source, entry of each distinct keyword: where its rows come from."""
    if mode not in MODES:
        raise ValueError(f"mode is one of {', '.join(MODES)}")
    asked = keywords.select("keyword").filter(F.col("keyword").isNotNull()).distinct()
    if mode == "refresh":
        return asked.select("keyword", F.lit(NETWORK).alias("source"), F.lit(None).cast(valid.schema["entry"].dataType).alias("entry"))
    found = asked.join(valid.withColumnRenamed("entry", "__valid"), "keyword", "left").join(legacy.withColumnRenamed("entry", "__legacy"), "keyword", "left")
    source = F.when(F.col("__valid").isNotNull(), CACHE).when(F.col("__legacy").isNotNull(), LEGACY).otherwise(NETWORK if mode == "normal" else MISSING)
    return found.select("keyword", source.alias("source"), F.coalesce("__valid", "__legacy").alias("entry"))


def read_through(plan: DataFrame, cached: DataFrame, legacy: DataFrame, fetch: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows with `source`, entries to add to the cache). Rows of `cached` and `legacy` have an `entry`, those of fetch(keywords) don't.

    Nothing is fetched if any keyword is missing. A keyword without rows is an entry too.
    """
    plan = sinks.staged(plan, "cache-plan")
    if gone := plan.filter(F.col("source") == MISSING).orderBy("keyword").limit(5).collect():
        raise CacheMissing("no valid cache for " + ", ".join(repr(r.keyword) for r in gone))
    of = lambda rows, source: rows.join(plan.filter(F.col("source") == source).select("keyword", "entry"), ["keyword", "entry"]).drop("entry").withColumn("source", F.lit(source))
    out = of(cached, CACHE).unionByName(of(legacy, LEGACY))
    asked = plan.filter(F.col("source") == NETWORK).select("keyword")
    if asked.isEmpty():
        return out, asked.select("keyword", F.lit(0).cast("long").alias("rows"))
    if fetch is None:
        raise CacheMissing("keywords are to be fetched, and there is no service")
    got = sinks.staged(fetch(asked), "fetched")
    counts = got.groupBy("keyword").agg(F.count("*").alias("rows"))
    return out.unionByName(got.withColumn("source", F.lit(NETWORK))), asked.join(counts, "keyword", "left").fillna(0, ["rows"])


def document_files(spark: SparkSession, path: str) -> DataFrame:
    """path, length, modified of files; their contents aren't read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", F.col("modificationTime").alias("modified"))


def to_extract(documents: DataFrame, outputs: DataFrame, manifest: DataFrame, pages: DataFrame, version: str, form: str = "chunks") -> DataFrame:
    """path, reasons of documents whose extraction is missing, failed, of another version or form, partial, of another file than is there now, cut off, or short of pages.

    `documents`: path, length, modified; `outputs`: path, length; `manifest`: path, out, returncode, form, version, pages (asked for), input_bytes, input_modified, out_bytes, n_pages; `pages`: out, first_page, last_page, as found in
    the chunks. Of several entries of a document the latest input counts.
    """
    last = manifest.groupBy("path").agg(F.max_by(F.struct(*[c for c in manifest.columns if c != "path"]), "input_modified").alias("m"))
    there = outputs.select(F.col("path").alias("__out"), F.col("length").alias("__out_length"))
    covered = pages.select(F.col("out").alias("__chunks"), "first_page", "last_page")
    m = F.col
    x = documents.join(last, "path", "left").join(there, m("m.out") == m("__out"), "left").join(covered, m("m.out") == m("__chunks"), "left")
    no = lambda c: ~F.coalesce(c, F.lit(False))
    rules: dict[str, Column] = {
        "failed": no(m("m.returncode") == 0), "form": no(m("m.form") == form), "version": no(m("m.version") == version), "partial": m("m.pages").isNotNull(), "size": no(m("m.input_bytes") == m("length")), "time": no(m("m.input_modified") == m("modified")),
        "no output": m("__out").isNull(), "output size": m("__out").isNotNull() & no(m("m.out_bytes") == m("__out_length")), "output short": F.coalesce(m("__out_length") < LEAST_OUTPUT, F.lit(False)),
    }
    if form == "chunks":
        rules["pages"] = no((m("m.n_pages") > 0) & (m("first_page") == 1) & (m("last_page") == m("m.n_pages")))
    reasons = F.when(m("m").isNull(), F.array(F.lit("new"))).otherwise(F.array_compact(F.array(*[F.when(holds, F.lit(name)) for name, holds in rules.items()])))
    return x.select("path", reasons.alias("reasons")).filter(F.size("reasons") > 0)
