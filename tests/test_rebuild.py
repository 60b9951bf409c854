"""The offline rebuild on the documented business and a few around it; conservation laws."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wonweave.plans import rebuild

REFERENCE = (2026, "행정안전부", "지역균형발전특별회계", "정부혁신조직", "주민참여 지역문제 해결 확산", "지역사회 자생적 창조역량 강화")
ITEMS = [("자치단체경상보조", 11_950), ("일반용역비", 9_939), ("민간위탁사업비", 982), ("일반수용비", 414), ("정책연구비", 300), ("임차료", 77), ("국내여비", 57), ("사업추진비", 34)]
BASIS = "① 가나 사업: 예산 6,764백만원\n② 다라: 예산 1,000백만원\n③ 마바: 예산 2,500백만원\n④ 사아: 예산 1,650백만원\n⑤ 자차: 예산 11,839백만원"


@pytest.fixture(scope="module")
def tables(spark):
    rows = [(*REFERENCE, "자치단체이전" if "자치단체" in n else "운영비", n, Decimal(a * 1_000_000)) for n, a in ITEMS]
    rows += [(2026, "국토교통부", "일반회계", "p", "u", f"도로 건설 {i}", "건설비", "시설비", Decimal(1000 * i)) for i in range(4)]
    rows += [(2026, "국토교통부", "일반회계", "p", None, "철도특별사법경찰대 기본경비", "운영비", "수용비", Decimal(7))]
    lines = spark.createDataFrame([(i, *r, "f", "s") for i, r in enumerate(rows)], "row_idx long, year int, office_name string, account_name string, program_name string, unit_business_name string, detail_business_name string, mok_name string, semok_name string, congress_amt decimal(20,0), field_name string, section_name string")
    lines = lines.withColumn("unit_business_name", F.coalesce("unit_business_name", F.lit("없음")))
    cards = spark.createDataFrame([("c1", "행정안전부", "지역사회 자생적 창조역량 강화", "1337-300", "행정안전부", "d.pdf", 3, 9, "c0001"), ("c2", "국토교통부", "도로 건설", "1400-301~305", None, "d.pdf", 10, 12, "c0002"), ("c3", "국토교통부", "전혀 다른 이름", None, None, "d.pdf", 13, 14, "c0003")], "card string, ministry string, title string, code string, implementer string, source_pdf string, page_start int, page_end int, anchor_chunk_id string")
    key = [str(x) for x in REFERENCE]
    candidates = spark.createDataFrame([(key, "사회연대경제", "사회연대경제 활성화", Decimal(10)), (None, "도로", "도로", Decimal(5)), (["x"] * 6, "기타", "기타", Decimal(4))], "central_key array<string>, keyword string, detail_business_name string, national_amt decimal(20,0)")
    procedures = spark.createDataFrame([("c1", "procedure", 0, "신청 접수 → 심사 → 교부 → 정산"), ("c1", "purpose", 0, "지역 문제를 주민이 푼다"), ("c1", "legal_history", 0, "법률 제1조"), ("c1", "implementation", 0, "사업 시행주체 : 지역진흥재단\n지원 대상 : 마을 주민"), ("c1", "effects", 0, "참여 주민이 는다"), ("c1", "review", 0, "지적이 없었다"), ("c1", "budget_basis", 0, BASIS)], "card string, section string, seq int, text string")
    return rebuild.run(lines, cards, candidates, procedures)


def test_laws_hold(tables):
    assert tables["violations"].collect() == []


def test_reference_business(tables):
    r = tables["canonical"].filter("business_id = 'kb-ace0474d507615f7'").first()
    assert int(r.congress_amt) == 23_753_000_000 and r.n_references == 1 and r.local_rows == 1 and r.channels[0].channel == "local_subsidy"
    f = tables["flow"].filter("business_id = 'kb-ace0474d507615f7'").first()
    assert (int(f.items_difference), int(f.subprojects_difference), f.warnings) == (0, 0, [])
    assert {x.code: int(x.amount) // 10**6 for x in tables["flow_totals"].collect() if x.code != "construction"} == {"local_subsidy": 11_950, "private_delegation": 982, "procurement": 10_239, "internal": 582}


def test_zero_amounts_keep_their_map(tables):
    zero = tables["flow"].filter("total = 0").first()
    assert zero.items_total is None and zero.warnings == ["no_positive_items"]


def test_matches_and_workflow(tables):
    got = {r.card: r.status for r in tables["matches"].collect()}
    assert got == {"c1": "matched", "c2": "ambiguous", "c3": "unmatched"} and tables["unresolved"].count() == 2
    assert tables["nodes"].filter("kind = 'procedure'").count() == 4 and tables["edges"].filter("type = 'sequence'").count() == 3
    assert [r.keyword for r in tables["plan"].collect()] == ["지역사회 자생적 창조역량 강화"]
    s = tables["summary"].first()
    assert (s.businesses, s.offices, s.matched, s.with_local) == (6, 2, 1, 1)


def test_published_or_not(tables, spark, tmp_path):
    from wonweave.sources.sinks import Incomplete

    small = {k: tables[k] for k in ("details", "violations")}
    assert spark.read.parquet(rebuild.publish(small, str(tmp_path / "ok")) + "/details").count() == 6
    with pytest.raises(Incomplete):
        rebuild.publish(small | {"violations": tables["details"]}, str(tmp_path / "bad"))


def test_workflow_of_the_documented_business(tables):
    mine = "business_id = 'kb-ace0474d507615f7'"
    nodes = tables["nodes"].filter(mine).orderBy("ordinal").collect()
    assert [n.kind for n in nodes] == ["purpose", "basis", "budget", *["budget_item"] * 8, "implementation", "beneficiary", *["procedure"] * 4, "local_candidate", "performance", "review"]
    assert [n.display_id for n in nodes] == [f"P{i:02d}" for i in range(1, 21)] and len({n.id for n in nodes}) == 20
    by = {n.kind: n for n in nodes}
    assert (by["budget"].amount, by["budget"].evidence.field, by["budget"].evidence.year, by["budget"].label) == (23_753_000_000, "Y_YY_DFN_KCUR_AMT", 2026, "2026년 국회확정액")
    assert nodes[3].label == "자치단체이전 · 자치단체경상보조" and nodes[3].detail == "원자료 1행 · 사업액 대비 50.3%"
    assert (by["purpose"].evidence.source_pdf, by["purpose"].evidence.page_start, by["purpose"].evidence.chunk_start) == ("d.pdf", 3, "c0001") and by["purpose"].evidence.evidence_id.startswith("ev-")
    assert (by["beneficiary"].detail, by["beneficiary"].actor, by["implementation"].actor) == ("마을 주민", "beneficiary", "ministry")  # the card names the ministry itself
    assert by["local_candidate"].assertion == "candidate" and by["local_candidate"].evidence.match_status == "keyword_candidate"
    assert [n.phase for n in nodes if n.kind == "procedure"] == ["G3", "G3", "G3", "G6"]
    edges = tables["edges"].filter(mine).groupBy("type", "assertion").count().collect()
    assert {(e.type, e.assertion, e["count"]) for e in edges} == {("context", "derived", 1), ("fund", "api", 8), ("delivery", "documented", 1), ("sequence", "documented", 3), ("candidate", "candidate", 1)}
    assert {(a.role, a.name, a.assertion) for a in tables["actors"].filter(mine).collect()} == {("ministry", "행정안전부", "api"), ("beneficiary", "마을 주민", "documented"), ("local", "광역·기초 지방자치단체", "candidate")}


def test_coverage_says_what_is_known(tables):
    got = {r.level: r.n for r in tables["coverage"].groupBy("level").agg(F.count("*").alias("n")).collect()}
    assert got == {"documented_flow": 1, "api_only": 5}


def test_broken_graphs_are_told(spark, tables):
    from wonweave.operators import workflow

    n, e, a = tables["nodes"], tables["edges"], tables["actors"]
    told = lambda n, e, a: {(r.check_id) for r in workflow.broken(n, e, a).collect()}
    assert told(n, e, a) == set()
    assert told(n.unionByName(n.filter("kind = 'budget'").limit(1)), e, a) == {"node_id", "node_display"}
    assert told(n.withColumn("kind", F.when(F.col("kind") == "purpose", "aim").otherwise(F.col("kind"))), e, a) == {"node_kind"}
    assert "edge_source" in told(n.filter("kind <> 'budget'"), e, a)
    assert told(n, e, a.filter("role <> 'local'")) == {"node_actor"}
    assert told(n.withColumn("assertion", F.lit("documented")), e, a) == {"candidate_only"}
    assert told(n, e.withColumn("evidence", F.lit(None).cast(workflow.EVIDENCE_TYPE)), a) == {"edge_evidence"}
    assert told(n, e.withColumn("business_id", F.lit("x")), a) == {"edge_across"}
