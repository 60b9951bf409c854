"""Read-through caches, documents to extract, headline sets, published counts, orders, long paths."""

import pytest
from pyspark.sql import functions as F

from wonweave.operators import graph, summaries
from wonweave.sources import caches, sinks

ENTRIES = [(1, "a", "1.0", "s", 2026, "20260101", True, True), (2, "a", "1.0", "s", 2026, "20260101", True, True), (3, "b", "0.9", "s", 2026, "20260101", True, True), (4, "c", "1.0", "t", 2026, "20260101", True, True), (5, "d", "1.0", "s", 2026, "20260101", None, True), (6, "e", "1.0", "s", 2026, "20260102", True, True), (7, "f", "1.0", "s", 2026, "20260101", True, False), (8, "g", "1.0", "s", 2026, "20260101", True, True)]
OLD = [(1, "a", "2026", "20260101", "a", True), (2, "b", "2026", "20260101", "b", True), (3, "c", "2025", "20260101", "c", True), (4, "d", "2026", "20260101", "other", True), (5, "e", "2026", "20260101", "e", False), (6, "h", "2026", "20260101", "h", True)]


@pytest.fixture
def frames(spark):
    now = spark.createDataFrame(ENTRIES, "entry int, keyword string, schema_version string, service string, year int, exe_ymd string, complete boolean, has_rows boolean")
    old = spark.createDataFrame(OLD, "entry int, keyword string, fyr string, exe_ymd string, dbiz_nm string, has_rows boolean")
    asked = spark.createDataFrame([(x,) for x in "abcdefghz"] + [("a",), (None,)], "keyword string")
    return asked, caches.valid_entries(now, "s", 2026, "20260101"), caches.legacy_entries(old, 2026, "20260101")


def test_where_rows_come_from(frames):
    got = {mode: {r.keyword: (r.source, r.entry) for r in caches.planned(*frames, mode).collect()} for mode in caches.MODES}
    assert got["normal"] == {"a": ("cache", 2), "b": ("legacy_cache", 2), "g": ("cache", 8), "h": ("legacy_cache", 6)} | {k: ("network", None) for k in "cdefz"}
    assert set(got["refresh"].values()) == {("network", None)} and len(got["refresh"]) == 9
    assert {k for k, v in got["cache_only"].items() if v[0] == "missing"} == set("cdefz")
    with pytest.raises(ValueError):
        caches.planned(*frames, "offline")


def test_reading_through(spark, frames):
    cached = spark.createDataFrame([(2, "a", 10), (2, "a", 11), (1, "a", 99), (8, "g", 12), (3, "b", 98)], "entry int, keyword string, n int")
    legacy = spark.createDataFrame([(2, "b", 20), (1, "a", 97)], "entry int, keyword string, n int")
    asked = []

    def fetch(keywords):
        asked.append(sorted(r.keyword for r in keywords.collect()))
        return keywords.filter("keyword IN ('c', 'd')").select("keyword", F.lit(30).alias("n"))

    rows, new = caches.read_through(caches.planned(*frames), cached, legacy, fetch)
    assert sorted(map(tuple, rows.select("keyword", "n", "source").collect())) == [("a", 10, "cache"), ("a", 11, "cache"), ("b", 20, "legacy_cache"), ("c", 30, "network"), ("d", 30, "network"), ("g", 12, "cache")]
    assert sorted(map(tuple, new.collect())) == [("c", 1), ("d", 1), ("e", 0), ("f", 0), ("z", 0)] and asked == [list("cdefz")]
    with pytest.raises(caches.CacheMissing, match="'c', 'd'"):
        caches.read_through(caches.planned(*frames, "cache_only"), cached, legacy, fetch)
    with pytest.raises(caches.CacheMissing):
        caches.read_through(caches.planned(*frames), cached, legacy)
    only = frames[0].filter("keyword IN ('a', 'b')")
    rows, new = caches.read_through(caches.planned(only, *frames[1:], "cache_only"), cached, legacy)
    assert rows.count() == 3 and new.count() == 0 and len(asked) == 1


def test_documents_to_extract(spark, tmp_path):
    for name, size in (("a.pdf", 30), ("b.pdf", 40), ("c.pdf", 50)):
        (tmp_path / name).write_bytes(b"x" * size)
    docs = caches.document_files(spark, str(tmp_path))
    assert "content" not in docs.columns and {r.length for r in docs.collect()} == {30, 40, 50}
    rows = docs.withColumn("name", F.element_at(F.split("path", "/"), -1))
    good = rows.filter("name <> 'c.pdf'").select("path", F.concat(F.lit("out/"), "name").alias("out"), F.lit(0).alias("returncode"), F.lit("chunks").alias("form"), F.lit("2").alias("version"), F.lit(None).cast("string").alias("pages"), F.col("length").alias("input_bytes"), F.col("modified").alias("input_modified"), F.lit(99).alias("out_bytes"), F.lit(3).alias("n_pages"))
    good = spark.createDataFrame(good.collect(), good.schema)
    outputs = spark.createDataFrame([("out/a.pdf", 99), ("out/b.pdf", 99)], "path string, length long")
    pages = spark.createDataFrame([("out/a.pdf", 1, 3), ("out/b.pdf", 1, 3)], "out string, first_page int, last_page int")
    ask = lambda manifest, outputs=outputs, pages=pages, **k: {r.path[-5:]: r.reasons for r in caches.to_extract(caches.document_files(spark, str(tmp_path)), outputs, manifest, pages, "2", **k).collect()}
    assert ask(good) == {"c.pdf": ["new"]}
    (tmp_path / "b.pdf").write_bytes(b"y" * 41)
    assert "size" in ask(good)["b.pdf"] and "a.pdf" not in ask(good)
    assert ask(good.withColumn("version", F.lit("1")))["a.pdf"] == ["version"] and ask(good.withColumn("pages", F.lit("1-2")))["a.pdf"] == ["partial"] and ask(good.withColumn("returncode", F.lit(None).cast("int")))["a.pdf"] == ["failed"]
    assert ask(good, outputs.filter("path <> 'out/a.pdf'"))["a.pdf"] == ["no output"] and ask(good, outputs.withColumn("length", F.lit(10)))["a.pdf"] == ["output size", "output short"]
    assert ask(good, pages=pages.withColumn("last_page", F.lit(2)))["a.pdf"] == ["pages"] and "a.pdf" not in ask(good.withColumn("form", F.lit("md")), pages=pages.limit(0), form="md")


def test_headlines_tell_a_null_from_all(spark):
    df = spark.createDataFrame([("a", "x", 1), (None, "x", 2), ("a", None, 4)], "k string, s string, n long")
    got = {(r.k, r.s, r.by): (r.c, r.n) for r in summaries.headlines(df, ["k", "s"], [[], ["k"], ["k", "s"]], {"c": F.count("*"), "n": F.sum("n")}).collect()}
    assert got == {(None, None, ""): (3, 7), ("a", None, "k"): (2, 5), (None, None, "k"): (1, 2), ("a", "x", "k,s"): (1, 1), (None, "x", "k,s"): (1, 2), ("a", None, "k,s"): (1, 4)}


def test_orders(spark):
    rows = [(i % 7, f"n{i % 3}", f"c{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "national_amt long, local_gov_name string, detail_business_code string").withColumn("region_name", F.lit(None).cast("string")).withColumn("detail_business_name", F.lit("x")).repartition(5)
    got = summaries.in_order(df, summaries.candidate_order()).orderBy("place").collect()
    assert [r.place for r in got] == list(range(1, 201)) and [(r.national_amt, r.local_gov_name, r.detail_business_code) for r in got] == sorted(rows, key=lambda r: (-r[0], r[1], r[2]))
    assert summaries.in_order(df.limit(0), summaries.candidate_order()).collect() == []


def test_counts_are_published(spark, tmp_path):
    tables = {"a": spark.range(7), "b": spark.range(0)}
    path = sinks.publish(tables, spark.range(0).withColumn("x", F.lit(1)), str(tmp_path / "p"))
    assert {r.name: r.rows for r in sinks.counts(spark, str(tmp_path / "p")).collect()} == {"a": 7, "b": 0} and spark.read.parquet(f"{path}/a").count() == 7


def test_headlines_of_the_rebuild(spark):
    record = spark.createDataFrame([("1", "A", 5, 1, 2), ("2", "A", 6, 0, 0), ("3", "B", 7, 0, 1)], "business_id string, office_name string, congress_amt long, n_references int, local_rows long")
    mix = spark.createDataFrame([("1", "local_subsidy", 3), ("2", "local_subsidy", 0), ("3", "direct", 9)], "business_id string, channel string, amount long")
    got = {r.office_name: tuple(r)[2:] for r in summaries.record_headlines(record, mix).collect()}
    assert got == {None: (3, 18, 1, 1, 2, 3), "A": (2, 11, 1, 1, 1, 2), "B": (1, 7, 0, 0, 1, 1)}
    cards = spark.createDataFrame([("c1", "A"), ("c2", "A"), ("c3", "B")], "card string, ministry string")
    matches = spark.createDataFrame([("c1", "matched"), ("c2", "unmatched"), ("c3", "matched")], "card string, status string")
    got = {(r.ministry, r.status, r.by): (r.cards, r.matched_share) for r in summaries.card_headlines(cards, matches).collect()}
    assert got[None, None, ""] == (3, 0.666667) and got["A", None, "ministry"] == (2, 0.5) and got["A", "matched", "ministry,status"] == (1, 1.0) and len(got) == 8


@pytest.mark.parametrize("n,up", [(3, False), (8, False), (9, True), (40, False)])
def test_paths_of_any_length(spark, n, up):
    """A chain with a shortcut, a cycle and a side branch, against a plain search."""
    edges = [(i, i + 1) for i in range(n)] + [(0, n // 2), (n, n // 3), (n // 2, 1000), (1000, 1001), (2000, 0)]
    e = spark.createDataFrame(edges, "src long, dst long")
    starts = [0, n, 1001]
    step = [(b, a) for a, b in edges] if up else edges
    want = set()
    for s in starts:
        depth, front = {s: 0}, [s]
        while front:
            front = [b for b in {b for a, b in step if a in set(front)} if b not in depth]
            depth |= dict.fromkeys(front, max(depth.values()) + 1)
        want |= {(s, x, d) for x, d in depth.items()}
    got = graph.reachable(e, spark.createDataFrame([(s,) for s in starts], "id long"), upstream=up).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    rounds, whole = [], sinks.staged
    monkeypatch.setattr(sinks, "staged", lambda df, name="stage": (rounds.append(name), whole(df, name))[1])
    n = 10_000
    got = graph.reachable(spark.range(n).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst")), spark.createDataFrame([(0,)], "id long"))
    assert got.agg(F.count("*"), F.max("depth"), F.count_if(F.col("node") == F.col("depth"))).first() == (n + 1, n, n + 1) and len(rounds) < 60
