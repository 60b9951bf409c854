"""Paged JSON APIs as a Spark data source, and landing of what came whole.

A request asks for one page of one scope (an office and a year). Page 1 says how many rows there
are; the other pages are planned from that, so they are read side by side, and a page that has
fewer rows than planned is seen. Where a service's totals can't be relied on, `plan` = `walk`
reads a scope's pages one after another until they end.

Filters on office and year (equality, IN) reach the requests, so what isn't asked for isn't
fetched. Pages are the rows of the table; landed.rows_of() takes their rows apart.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from wonweave.operators import quality
from wonweave.sources import landed, sinks

SCHEMA = "office string, year int, page int, n_rows int, total long, code string, payload string"


class ApiError(Exception):
    """What asking again doesn't mend."""


class ShortScope(Exception):
    """Fewer rows than the service says there are."""


@dataclass(frozen=True)
class Answer:
    text: str
    n_rows: int
    total: int | None
    code: str | None


def answer_of(text: str, service: str | None) -> Answer:
    """Reads a page: a JSON object, maybe inside a JSON string, with the service's list of `head` and `row` parts."""
    body = json.loads(text)
    if isinstance(body, str):
        text, body = body, json.loads(body)
    if not isinstance(body, dict):
        return Answer(text, 0, None, None)
    results = [body["RESULT"]] if isinstance(body.get("RESULT"), dict) else []
    named = body.get(service) if service else None
    parts = named if isinstance(named, list) else next((v for k, v in body.items() if k != "RESULT" and isinstance(v, list)), [])
    parts = [p for p in parts if isinstance(p, dict)]
    heads = [h for p in parts for h in p.get("head") or [] if isinstance(h, dict)]
    results += [h["RESULT"] for h in heads if isinstance(h.get("RESULT"), dict)]
    totals = [h["list_total_count"] for h in heads if "list_total_count" in h]
    rows = sum(isinstance(r, dict) for p in parts for r in (p.get("row") if isinstance(p.get("row"), list) else []))
    total = str(totals[-1]).strip() if totals else ""
    return Answer(text, rows, int(total) if total.isdigit() else None, results[-1].get("CODE") if results else None)


@dataclass(frozen=True)
class Service:
    """How to ask, from the options of spark.read.format("paged_api")."""

    url: str
    post: bool
    service: str | None
    params: tuple[tuple[str, str], ...]
    headers: tuple[tuple[str, str], ...]
    office_param: str
    year_param: str
    page_param: str
    size_param: str
    size: int
    most_pages: int
    ok: str
    tries: int
    wait: float
    timeout: float

    @classmethod
    def of(cls, options: Mapping[str, str]) -> Service:
        o = {k.lower(): v for k, v in options.items()}
        told = lambda name: tuple(json.loads(o.get(name, "{}")).items())
        return cls(
            o["url"], o.get("method", "GET").upper() == "POST", o.get("service"), told("params"), told("headers"), o.get("officeparam", "office"), o.get("yearparam", "year"), o.get("pageparam", "pIndex"), o.get("sizeparam", "pSize"), int(o.get("pagesize", "1000")),
            int(o.get("maxpages", "100000")), o.get("okcode", "INFO-000"), int(o.get("retries", "3")), float(o.get("wait", "0.5")), float(o.get("timeout", "90")),
        )

    def ask(self, office: str | None, year: int | None, page: int) -> Answer:
        """A page. Failures of the line, errors of the server and cut-off answers are tried again, after longer and longer waits."""
        sent = dict(self.params) | {self.page_param: str(page), self.size_param: str(self.size)}
        sent |= ({self.office_param: office} if office is not None else {}) | ({self.year_param: str(year)} if year is not None else {})
        headers = {"Accept": "application/json"} | dict(self.headers)
        if self.post:
            request = urllib.request.Request(self.url, json.dumps(sent, ensure_ascii=False).encode(), headers | {"Content-Type": "application/json"}, method="POST")
        else:
            request = urllib.request.Request(f"{self.url}?{urllib.parse.urlencode(sent)}", headers=headers)
        for attempt in range(1, self.tries + 1):
            try:
                with urllib.request.urlopen(request, timeout=self.timeout) as got:
                    answer = answer_of(got.read().decode("utf-8"), self.service)
                break
            except (OSError, ValueError) as e:
                if isinstance(e, urllib.error.HTTPError) and e.code < 500 and e.code != 429:
                    raise ApiError(f"{office} {year} page {page}: HTTP {e.code}") from e
                if attempt == self.tries:
                    raise
                time.sleep(self.wait * attempt)
        if answer.code is not None and answer.code != self.ok:
            raise ApiError(f"{office} {year} page {page}: {answer.code}")
        return answer


@dataclass(frozen=True)
class Scope:
    office: str | None
    year: int | None


class Pages(InputPartition):
    """Pages first ... last of a scope of `total` rows; without `last` they are walked through."""

    def __init__(self, scope: Scope, first: int, last: int | None, total: int | None):
        self.scope, self.first, self.last, self.total = scope, first, last, total


def _listed(text: str | None) -> list[str | None]:
    """A JSON list, or names between commas; nothing given is one scope without a name."""
    if not text:
        return [None]
    return json.loads(text) if text.lstrip().startswith("[") else [x.strip() for x in text.split(",")]


class PagedReader(DataSourceReader):
    def __init__(self, options: Mapping[str, str]):
        o = {k.lower(): v for k, v in options.items()}
        self.service, self.walk, self.strict = Service.of(options), o.get("plan", "pages") == "walk", o.get("short", "fail") == "fail"
        self.pages_per_task, self.asking = int(o.get("pagespertask", "8")), int(o.get("asking", "8"))
        self.scopes = [Scope(a, None if y is None else int(y)) for a in _listed(o.get("offices")) for y in _listed(o.get("years"))]

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Scopes that a filter rules out aren't asked for; Spark keeps the other filters."""
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute in (("office",), ("year",)):
                kept = {f.value}
            elif isinstance(f, In) and f.attribute in (("office",), ("year",)):
                kept = set(f.value)
            else:
                yield f
                continue
            self.scopes = [s for s in self.scopes if getattr(s, f.attribute[0]) in kept]

    def partitions(self) -> list[Pages]:
        """From the totals of first pages: a number for each scope comes to the driver, no rows."""
        if self.walk or not self.scopes:
            return [Pages(s, 1, None, None) for s in self.scopes] or [Pages(Scope(None, None), 1, 0, 0)]
        with ThreadPoolExecutor(self.asking) as pool:
            totals = list(pool.map(lambda s: self.service.ask(s.office, s.year, 1).total, self.scopes))
        out = []
        for scope, total in zip(self.scopes, totals, strict=True):
            # without a total there is no plan: page 1 alone, which the check of totals won't pass
            last = min(self.service.most_pages, max(1, -(-(total or 0) // self.service.size)))
            out += [Pages(scope, p, min(last, p + self.pages_per_task - 1), total) for p in range(1, last + 1, self.pages_per_task)]
        return out

    def read(self, partition: Pages) -> Iterator[tuple]:
        scope, page, got = partition.scope, partition.first, 0
        total, last = partition.total, partition.last if partition.last is not None else self.service.most_pages
        while page <= last:
            answer = self.service.ask(scope.office, scope.year, page)
            got += answer.n_rows
            yield scope.office, scope.year, page, answer.n_rows, answer.total, answer.code, answer.text
            if partition.last is None:
                total = answer.total if answer.total is not None else total
                if answer.n_rows < self.service.size or (total is not None and got >= total):
                    break
            page += 1
        if self.strict and total is not None:
            before = (partition.first - 1) * self.service.size
            planned = total if partition.last is None else min(total, last * self.service.size) - before
            if got < planned:
                raise ShortScope(f"{scope.office} {scope.year}: {got} of {planned} rows from page {partition.first} on")


class PagedApi(DataSource):
    """spark.dataSource.register(PagedApi); spark.read.format("paged_api").options(...).load()

    url, method (GET, POST), service; offices, years (comma-separated or JSON lists); pageSize,
    maxPages, pagesPerTask; officeParam, yearParam, pageParam, sizeParam; params, headers (JSON objects:
    Spark lower-cases the names of options, which a service may tell apart); retries, wait, timeout, okCode; plan (pages, walk); short (fail: rows missing end the read; keep:
    they are left to the check of totals).
    """

    @classmethod
    def name(cls) -> str:
        return "paged_api"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PagedReader:
        return PagedReader(dict(self.options))


def checked(pages: DataFrame, field: str | None = None, service: str | None = None) -> DataFrame:
    """office, year, rows, total, issues of each scope; issues is empty if it came whole.

    Of pages that say different totals the largest counts. With `field` (of the rows of
    `service`) each row must name the office that was asked for.
    """
    same = ["office", "year"]
    per = pages.groupBy(*same).agg(F.sum("n_rows").alias("rows"), F.max("total").alias("total"), F.count("*").alias("n"), F.countDistinct("page").alias("n_pages"), F.min("page").alias("first"), F.max("page").alias("last"))
    if field:
        named = landed.rows_of(pages, "payload", service, f"{field}: string", (*same, "page")).filter(F.col("page_row").isNotNull() & ~F.col(field).eqNullSafe(F.col("office")))
        named = named.groupBy(*same).agg(F.count("*").alias("others"))
        key = F.struct(F.coalesce("office", F.lit("")), F.coalesce("year", F.lit(0)))
        per = per.withColumn("__k", key).join(named.select(key.alias("__k"), "others"), "__k", "left").drop("__k")
    else:
        per = per.withColumn("others", F.lit(0))
    issues = [
        F.when(F.col("rows") == 0, "no rows"), F.when(F.col("total").isNull(), "total missing"), F.when(F.col("total") != F.col("rows"), "total differs"),
        F.when((F.col("first") != 1) | (F.col("last") != F.col("n_pages")), "pages missing"), F.when(F.col("n") != F.col("n_pages"), "pages repeated"), F.when(F.col("others") > 0, "other office"),
    ]
    return per.select(*same, "rows", "total", F.array_compact(F.array(*issues)).alias("issues"))


def land(spark: SparkSession, options: Mapping[str, str], path: str, field: str | None = None) -> DataFrame:
    """Fetches all scopes and commits those that came whole to `path`, below their year and office; returns checked().

    What was landed before of a scope that now is incomplete, or isn't asked for, stays as it was.
    """
    spark.dataSource.register(PagedApi)
    pages = sinks.staged(spark.read.format("paged_api").options(**{**options, "short": "keep"}).load(), "pages")
    found = sinks.staged(checked(pages, field=field, service=options.get("service")), "scopes")
    whole = found.filter(F.size("issues") == 0).select(F.col("office").alias("__o"), F.col("year").alias("__y"))
    kept = pages.join(whole, pages["office"].eqNullSafe(F.col("__o")) & pages["year"].eqNullSafe(F.col("__y")), "left_semi")
    kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "office").parquet(path)
    return found


def require_whole(found: DataFrame) -> None:
    """Raises sinks.Incomplete if a scope of checked() has issues."""
    bad = found.filter(F.size("issues") > 0)
    if rows := bad.orderBy("office", "year").limit(5).collect():
        raise sinks.Incomplete("; ".join(f"{r.office} {r.year}: {', '.join(r.issues)}" for r in rows))


def violations(found: DataFrame) -> DataFrame:
    return quality.violations(found.select("office", F.explode("issues").alias("issue")), "paging", F.lit(True), F.col("office"), F.col("issue"))
