"""The paged data source against a stub service on this machine."""

import json
import threading
import urllib.parse
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from wonweave.sources import api, landed, sinks

SIZE = 4
ROWS = {("A", 2024): 11, ("B, x", 2024): 4, ("C", 2024): 1, ("가", 2024): 9, ("A", 2025): 2, ("none", 2024): 0}


class Stub:
    """Rows of offices by page. `broken`: what goes wrong with (office, page)."""

    def __init__(self):
        self.asked, self.broken, self.lock = [], {}, threading.Lock()
        stub = self

        class Handler(BaseHTTPRequestHandler):
            def do_GET(self):
                self.reply({k: v[0] for k, v in urllib.parse.parse_qs(urllib.parse.urlsplit(self.path).query).items()})

            def do_POST(self):
                self.reply(json.loads(self.rfile.read(int(self.headers["Content-Length"]))))

            def reply(self, q):
                office, year, page, size = q["OFFC_NM"], int(q["YY"]), int(q["pIndex"]), int(q["pSize"])
                with stub.lock:
                    stub.asked.append((self.command, office, year, page, q.get("Key")))
                    what = stub.broken.get((office, page))
                    if isinstance(what, list):
                        what = what.pop(0) if what else None
                total = ROWS[office, year]
                rows = [{"OFFC_NM": "other" if what == "other" else office, "N": i} for i in range(total)][(page - 1) * size : page * size]
                if what == "short":
                    rows = rows[:-1]
                head = [{"list_total_count": total + 5 if what == "total" else total}, {"RESULT": {"CODE": "ERROR-300" if what == "code" else "INFO-000", "MESSAGE": ""}}]
                body = json.dumps({"Svc": [{"head": head[1:] if what == "untold" else head}, {"row": rows}]}, ensure_ascii=False)
                if page % 2:
                    body = json.dumps(body)  # a JSON string that holds JSON
                data = body.encode()
                self.send_response(what if isinstance(what, int) else 200)
                self.end_headers()
                self.wfile.write(data[: len(data) // 2] if what == "cut" else data)

            def log_message(self, *args):
                pass

        self.server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()

    def options(self, **more):
        offices = sorted({o for o, y in ROWS if y == 2024 and o != "none"})
        return {"url": f"http://127.0.0.1:{self.server.server_port}/x", "service": "Svc", "officeParam": "OFFC_NM", "yearParam": "YY", "offices": json.dumps(offices), "years": "2024", "pageSize": str(SIZE), "pagesPerTask": "2", "wait": "0.01", "params": '{"Key": "k"}'} | more


@pytest.fixture
def stub(spark):
    spark.dataSource.register(api.PagedApi)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    s = Stub()
    yield s
    s.server.shutdown()
    s.server.server_close()


def load(spark, stub, **more):
    return spark.read.format("paged_api").options(**stub.options(**more)).load()


def numbers(pages):
    """(office, N) in order of pages."""
    rows = landed.rows_of(pages, "payload", "Svc", "OFFC_NM: string, N: int", ("office", "page"))
    return [(r.office, r.N) for r in landed.pages_in_order(rows.filter("page_row IS NOT NULL")).orderBy("office", "row_idx").collect()]


WANTED = sorted((o, i) for (o, y), n in ROWS.items() if y == 2024 for i in range(n))


@pytest.mark.parametrize("method", ["GET", "POST"])
@pytest.mark.parametrize("plan", ["pages", "walk"])
def test_all_pages_in_order(spark, stub, method, plan):
    pages = load(spark, stub, method=method, plan=plan).cache()
    assert numbers(pages) == WANTED
    assert [(r.office, r.page, r.n_rows, r.total) for r in pages.filter("office = 'A'").orderBy("page").collect()] == [("A", 1, 4, 11), ("A", 2, 4, 11), ("A", 3, 3, 11)]
    assert {a[0] for a in stub.asked} == {method} and {a[4] for a in stub.asked} == {"k"}
    pages.unpersist()


def test_failures_are_tried_again(spark, stub):
    stub.broken = {("A", 2): [500, "cut", None], ("C", 1): [503, None], ("가", 3): ["cut"]}
    assert numbers(load(spark, stub)) == WANTED


def test_lasting_failures_end_the_read(spark, stub):
    for what, said in ((404, "HTTP 404"), ("code", "ERROR-300"), ("short", "of 8 rows")):
        stub.broken, before = {("A", 2): what}, len(stub.asked)
        with pytest.raises(Exception, match=said):
            load(spark, stub).collect()
        if what == 404:  # not tried again by the reader, only by Spark
            assert sum(a[3] == 2 and a[1] == "A" for a in stub.asked[before:]) <= 4
    stub.broken = {("A", 1): "short"}  # a walk ends there, and rows are missing
    with pytest.raises(Exception, match="3 of 11 rows"):
        load(spark, stub, plan="walk").collect()


def test_only_what_is_asked_for_is_fetched(spark, stub):
    df = load(spark, stub, years="2024,2025", offices='["A"]')
    got = df.filter((F.col("office") == "A") & F.col("year").isin(2025) & (F.col("n_rows") > 0))
    assert [(r.office, r.year, r.n_rows) for r in got.collect()] == [("A", 2025, 2)]
    assert {a[1:3] for a in stub.asked} == {("A", 2025)}
    stub.asked.clear()
    assert {r.office for r in load(spark, stub).filter(F.col("office").isin("C", "가")).select("office").distinct().collect()} == {"C", "가"}
    assert {a[1] for a in stub.asked} == {"C", "가"}
    stub.asked.clear()
    assert load(spark, stub).filter("office = 'nobody'").collect() == [] and not stub.asked


def test_only_whole_scopes_are_landed(spark, stub, tmp_path):
    path = str(tmp_path / "raw")
    found = api.land(spark, stub.options(), path, "OFFC_NM")
    assert all(r.issues == [] for r in found.collect()) and numbers(spark.read.parquet(path)) == WANTED
    api.require_whole(found)
    stub.broken = {("A", 2): "short", ("B, x", 1): "untold", ("가", 3): "total", ("C", 1): "other"}
    found = api.land(spark, stub.options(offices=json.dumps(["A", "B, x", "C", "가", "none"])), path, "OFFC_NM")
    assert {r.office: sorted(r.issues) for r in found.collect()} == {"A": ["total differs"], "B, x": ["total missing"], "C": ["other office"], "가": ["total differs"], "none": ["no rows"]}
    assert numbers(spark.read.parquet(path)) == WANTED  # what was landed before stays
    with pytest.raises(sinks.Incomplete, match="A 2024: total differs"):
        api.require_whole(found)
    assert api.violations(found).count() == 5


def test_pages_missing_or_repeated(spark):
    rows = [("a", 1, p, 1, 3, "", "{}") for p in (1, 3, 4)] + [("b", 1, 1, 1, 2, "", "{}")] * 2 + [("c", 1, 1, 2, 2, "", "{}")]
    got = {r.office: r.issues for r in api.checked(spark.createDataFrame(rows, api.SCHEMA)).collect()}
    assert got == {"a": ["pages missing"], "b": ["pages repeated"], "c": []}


def test_answers_of_any_shape():
    assert api.answer_of("[1]", None) == api.Answer("[1]", 0, None, None)
    assert api.answer_of('{"RESULT": {"CODE": "INFO-200"}}', "Svc").code == "INFO-200"
    got = api.answer_of(json.dumps({"Other": [{"head": [{"list_total_count": " 7 "}, 3]}, {"row": [{}, 5, {}]}, None]}), "Svc")
    assert (got.n_rows, got.total, got.code) == (2, 7, None)
    assert api.answer_of('{"Svc": [{"head": [{"list_total_count": "many"}]}]}', "Svc").total is None


def test_page_plan_of_unknown_and_empty_totals(spark):
    totals = spark.createDataFrame([("a", 0), ("b", None), ("c", 5)], "office string, total long")
    plan = landed.page_plan(totals, 2)
    assert sorted(map(tuple, plan.collect()), key=str) == [("a", 1, 0), ("b", 1, None), ("c", 1, 2), ("c", 2, 2), ("c", 3, 1)]
    pages = spark.createDataFrame([("c", 1, 2), ("c", 2, 1), ("d", 1, 3), ("a", 1, 0)], "office string, page int, n_rows int")
    assert sorted(map(tuple, landed.page_gaps(plan, pages).collect())) == [("c", 2, 2, 1), ("c", 3, 1, 0), ("d", 1, 0, 3)]
