"""Published values and small cases by hand."""

import pytest
from pyspark.sql import functions as F

from wonweave.functions import columns, extract, scoring, steps, text
from wonweave.operators import classify, dedupe, flow, graph, hierarchy, keywords, match, quality, sections, timeline
from wonweave.sources import landed, sinks

KEY = ["2026", "행정안전부", "지역균형발전특별회계", "정부혁신조직", "주민참여 지역문제 해결 확산", "지역사회 자생적 창조역량 강화"]


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


@pytest.mark.parametrize(
    "title,name,implementer,score",
    [
        ("과표양성화를 위한 시가표준액 조사", "과표양성화를위한시가표준액조사", "한국지방세연구원", 100.0), ("철도특별사법경찰대 인건비", "인건비", "철도특별사법경찰대", 83.75), ("철도특별사법경찰대 인건비", "철도특별사법경찰대 기본경비", "철도특별사법경찰대", 64.25),
        ("지방항공청 등 인건비", "인건비", "국토교통부", 85.0), ("본부기본경비(총액)", "기본경비", "", 87.5), ("본부기본경비(총액)", "본부 기본경비(비총액)", "", 75.0),
    ],
)
def test_published_scores(spark, title, name, implementer, score):
    df = spark.createDataFrame([(title, name, implementer)], "t string, n string, w string")
    df = df.select(*scoring.features("c", "t"), *scoring.features("d", "n"), *scoring.features("i", "w"))
    got = df.withColumn("s", scoring.score("c", "d")).withColumn("b", scoring.boosted("s", "i", "d")).first()
    assert got.b.score == pytest.approx(score)


def test_published_id(spark):
    assert one(spark, columns.stable_id("kb", F.array(*map(F.lit, KEY))).alias("x")).x == "kb-ace0474d507615f7"


@pytest.mark.parametrize("code,level", [("1100000", "광역본청"), ("1111000", "기초"), ("2871000", "기초"), ("11", "unknown"), (None, "unknown")])
def test_local_level(spark, code, level):
    assert one(spark, classify.local_level(F.lit(code)).alias("x")).x == level


@pytest.mark.parametrize("name,keyword", [("주거급여지원", "주거급여"), ("특수상황지역개발(제주)", "특수상황지역개발"), ("지가조사", None), ("지역개발 사업", None)])
def test_keywords(spark, name, keyword):
    assert one(spark, keywords.choose(F.lit(name)).alias("x")).x.keyword == keyword


def test_text_traps(spark):
    got = one(spark, text.title_key(F.lit("가ㆍ나·다‧라 Ａ１")).alias("a"), text.name_key(F.lit("가ㆍ나")).alias("b"), text.title_key(F.lit("é")).alias("c"), text.heading_text(F.lit("a\\~b～c")).alias("d"))
    assert got.a == "가ᆞ나다라a1" and got.b == "가나" and got.c == "é" and got.d == "a-b-c"
    assert one(spark, text.bigrams(F.lit("a")).alias("x")).x == [] and one(spark, text.bigrams(F.lit("abab")).alias("x")).x == ["ab", "ba"]


def test_numbers(spark):
    df = spark.createDataFrame([("1,234",), ("",), ("x",), (None,), ("nan",)], "a string")
    assert [r.x for r in df.select(columns.number_or_null("a").alias("x")).collect()][:4] == [1234.0, None, None, None]
    assert [int(r.x) for r in df.select(columns.won("a").alias("x")).collect()] == [0, 0, 0, 0, 0]
    assert one(spark, columns.rate(F.lit(1), F.lit(0)).alias("x")).x is None and one(spark, columns.share(F.lit(1), F.lit(0)).alias("x")).x == 0.0
    assert one(spark, columns.is_snapshot_date(F.lit("20260631"), F.lit(2026)).alias("x")).x is False and one(spark, columns.korean_amount(F.lit(23_753_000_000)).alias("x")).x == "237.5억"


def test_channels(spark):
    items = [("자치단체경상보조", "local_subsidy", 11950), ("일반용역비", "procurement", 9939), ("민간위탁사업비", "private_delegation", 982), ("일반수용비", "internal", 414), ("정책연구비", "procurement", 300), ("임차료", "internal", 77), ("국내여비", "internal", 57), ("사업추진비", "internal", 34)]
    df = spark.createDataFrame([(a, "", c) for a, _, c in items], "mok string, semok string, amount long").withColumn("code", classify.flow_channel("semok", "mok"))
    assert [r.code for r in df.collect()] == [b for _, b, _ in items]
    assert {r.code: r.s for r in df.groupBy("code").agg(F.sum("amount").alias("s")).collect()} == {"local_subsidy": 11950, "private_delegation": 982, "procurement": 10239, "internal": 582}
    assert one(spark, classify.channel(F.lit("자치단체이전"), F.lit("")).alias("a"), classify.channel(F.lit("건설비"), F.lit("토지")).alias("b"), classify.channel(F.lit("운영비"), F.lit(None)).alias("c")) == ("local_subsidy", "capital", "direct")


@pytest.mark.parametrize(
    "scores,aggregate,status,confidence",
    [([], False, "unmatched", "none"), ([50], False, "unmatched", "none"), ([60], False, "ambiguous", "low"), ([75], False, "matched", "medium"), ([75, 70], False, "ambiguous", "low"), ([90, 80], False, "matched", "high"), ([90, 83], False, "ambiguous", "low"), ([100], False, "matched", "high"), ([100, 95], False, "matched", "high"), ([100, 100], False, "ambiguous", "low"), ([100], True, "ambiguous", "low")],
)
def test_decisions(spark, scores, aggregate, status, confidence):
    cards = spark.createDataFrame([("c", aggregate)], "card string, aggregate boolean")
    pairs = spark.createDataFrame([("c", f"d{i}", float(s), "exact" if s == 100 else "tokens") for i, s in enumerate(scores)], "card string, detail string, score double, method string")
    got = match.best(cards, pairs).first()
    assert (got.status, got.confidence) == (status, confidence) and (got.detail is not None) == (status == "matched")


def test_completeness(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 3), ("e", 1)], "office string, page int")
    declared = spark.createDataFrame([("a", 2), ("b", 2), ("c", 4), ("d", None), ("e", 5)], "office string, total int")
    got = {r.office: r.issues for r in quality.completeness(rows, declared, "office", "page").collect()}
    assert got == {"a": [], "b": ["pages missing"], "c": ["no rows", "total differs"], "d": ["no rows", "total missing"], "e": ["total differs"]}


def test_publish_is_all_or_nothing(spark, tmp_path):
    ok, bad = spark.createDataFrame([], "check_id string"), spark.createDataFrame([("x",)], "check_id string")
    path = str(tmp_path / "out")
    with pytest.raises(sinks.Incomplete):
        sinks.publish({"t": spark.range(3)}, bad, path)
    assert not (tmp_path / "out").exists() and sinks.published(spark, path) is None
    first = sinks.publish({"t": spark.range(3)}, ok, path, {"t": ["id"]})
    assert sinks.published(spark, path) == first

    class Broken:
        """A table whose writing fails: the version before stays."""

        @property
        def write(self):
            raise OSError

    with pytest.raises(OSError):
        sinks.publish({"t": spark.range(4), "u": Broken()}, ok, path)
    assert sinks.published(spark, path) == first and spark.read.parquet(first + "/t").count() == 3
    second = sinks.publish({"t": spark.range(5)}, ok, path)
    sinks.publish({"t": spark.range(6)}, ok, path)
    assert spark.read.parquet(sinks.published(spark, path) + "/t").count() == 6 and spark.read.parquet(second + "/t").count() == 5
    assert len([x for x in (tmp_path / "out").iterdir() if x.name.startswith("v-")]) == 2


def test_json_is_safe_and_stable(spark):
    df = spark.createDataFrame([(2, "</script>& ", float("nan")), (1, None, 1.5)], "b int, a string, c double")
    assert [r.value for r in sinks.json_lines(df, ["b"]).collect()][0] == '{"a":null,"b":1,"c":1.5}'
    assert "</script>" not in sinks.html_page(df, "t", ["b"]).first().value.split("id=data>")[1][:-9]


def test_payloads(spark):
    inner = '{"S":[{"head":[{"list_total_count":2},{"RESULT":{"CODE":"INFO-000"}}]},{"row":[{"K":"1"},{"K":"2"}]}]}'
    import json

    df = spark.createDataFrame([(1, inner), (2, json.dumps(inner)), (3, '{"RESULT":{"CODE":"INFO-200"}}'), (4, "junk"), (5, None)], "i int, p string")
    got = sorted(map(tuple, landed.rows_of(df, "p", "S", "K: string", ("i",)).collect()), key=str)
    assert got == [(1, 2, "INFO-000", 0, "1"), (1, 2, "INFO-000", 1, "2"), (2, 2, "INFO-000", 0, "1"), (2, 2, "INFO-000", 1, "2"), (3, None, "INFO-200", None, None), (4, None, None, None, None), (5, None, None, None, None)]


def test_local_rows_and_first_wins(spark):
    cols = "fyr exe_ymd wa_laf_cd wa_laf_hg_nm laf_cd laf_hg_nm acnt_dv_nm dbiz_nm dbiz_cd fld_nm part_nm sect_nm bdg_cash_amt bdg_ntep capep sggep etc_amt ep_amt cpl_amt keyword central_key".split()
    row = lambda **k: tuple({**dict.fromkeys(cols, "1"), "fyr": "2026", "exe_ymd": "20260630", "bdg_ntep": "1,000", "part_nm": "", "sect_nm": "s", **k}[c] for c in cols)
    raw = spark.createDataFrame([row(), row(), row(bdg_ntep="0"), row(bdg_ntep="x"), row(fyr="2025"), row(dbiz_cd="2")], ", ".join(f"{c} string" for c in cols))
    rows = keywords.local_rows(raw, F.lit(2026), F.lit("20260630"))
    assert rows.count() == 3 and rows.first().section_name == "s" and int(rows.first().national_amt) == 1000
    assert keywords.dedupe_rows(rows, "central_key").count() == 2
    first = dedupe.first_by(spark.createDataFrame([("a", 2, "x"), ("a", 1, "y")], "k string, n int, v string"), ["k"], ["n"])
    assert first.first().v == "y"


def test_documented_query_is_added(spark):
    plan = spark.createDataFrame([(KEY, "지역사회", "normalized_full_title"), (["2026", "x", "", "", "", ""], None, None)], "central_key array<string>, keyword string, strategy string")
    assert sorted((r.keyword, r.matched_subproject) for r in keywords.expand(plan, "central_key").collect()) == [("사회연대경제", "사회연대경제 활성화"), ("지역사회", None)]


def test_extraction(spark):
    got = one(spark, extract.amounts(F.lit("1,200백만원과 5억원, 1,200백만원")).alias("a"), extract.execution_paths(F.lit("민간위탁 및 융자")).alias("b"), extract.checked_support(F.lit("| 직접 | 출연 | 융자 |\n|---|---|---|\n| | ○ | V |")).alias("c"), extract.heading(F.lit("## (3) 청년 지원 (1337-300~302)")).alias("d"), extract.title(F.lit("(9) 청년월세 한시 특별지원 (1337-300)")).alias("e"), extract.placeholder(F.lit("해당 없음")).alias("f"), extract.basis(F.lit("3) 2026년도 예산 산출 근거 가나다 4) 사업효과 라마")).alias("g"))
    assert got.a == ["1,200백만원", "5억원"] and got.b == ["위탁/출연", "융자"] and got.c == ["위탁/출연", "융자"]
    assert tuple(got.d) == (3, "청년 지원", "1337-300~302", "aggregate") and got.e == "청년월세 한시 특별지원" and got.f is True and got.g == "가나다"
    texts = {"① 가나 사업: 예산 1,000백만원\n설명\n② 다라: (2026 예산) 0백만원\n③ 마바: 예산 5백만원 끝": [("sub-01", "①", "가나 사업", 10**9, "설명"), ("sub-03", "③", "마바", 5 * 10**6, "끝")], "": [], None: []}
    df = spark.createDataFrame([(x,) for x in texts], "a string").select("a", extract.subprojects("a").alias("p"))
    assert {r.a: [tuple(x) for x in r.p] for r in df.collect()} == texts


TABLE = "<table><tr><th>추진 계획</th><th>시행 주체</th></tr>{}</table>"


@pytest.mark.parametrize(
    "section,found",
    [
        ("신청 접수 → 심사·선정 → 보조금 교부\n → 정산", ["신청 접수", "심사·선정", "보조금 교부", "정산"]), ("① 공고 ② 접수", ["공고", "접수"]), ("신청", []), (None, []), ("", []),
        ("사업 집행 절차: 공고 &rarr; 접수 &lt;온라인&gt; → 접수 <온라인> -> 정산", ["공고", "접수", "정산"]), ("공고 → (기관 협의) → 해당 없음 → 1,000백만원 → 추진절차 → 정산 → 부처", ["공고", "정산"]),
        (TABLE.format("<tr><td>공고문 작성</td><td>담당자</td><td>서류 심사</td><td>협약 체결</td></tr><tr><td>세부 일정</td><td>집행</td></tr>"), ["공고문 작성", "서류 심사"]),
        (TABLE.format("<tr><td>접수 - 검토<br>• 선정 ❍ 교부</td></tr>"), ["접수", "검토", "선정", "교부"]), ("<table><tr><td>공고</td></tr><tr><td>접수</td></tr></table>", []),
        ("| 구분 | 추진 절차 |\n|---|---|\n| 1 | 공고 |\n| 2 | 접수 |\n\n| 신청 | 정산 |", ["공고", "접수"]), ("a → 공고 → b" + " → 접수" * 3, ["공고", "접수"]), (" → ".join(f"{chr(0xAC00 + i)} 점검" for i in range(40)), [f"{chr(0xAC00 + i)} 점검" for i in range(24)]),
    ],
)
def test_procedure_steps(spark, section, found):
    assert spark.createDataFrame([(section,)], "a string").select(steps.procedure_steps("a").alias("s")).first().s == found


@pytest.mark.parametrize(
    "structured,title,field,snippet,best",
    [
        (True, "청년 결산 지원", None, None, "청년 결산 지원"), (True, "사업명", None, None, None), (False, "청년 결산 지원", None, None, None), (False, "(3) 청년월세 지원 (1337-300)", None, "", "청년월세 지원"),
        (False, "긴" * 50, "짧은 이름 하나", None, "짧은 이름 하나"), (False, "가나다라", "가나다라마바사아자차카타", None, "가나다라마바사아자차카타"), (False, "열두자가되는사업의이름임", "가나다라", "(1) 가나다라마 (1337-300) 사업명: 다른 것", "열두자가되는사업의이름임"),
        (None, None, None, None, None), (False, "a | b | c", "청년 소관부처 행안부", None, None),
    ],
)
def test_card_titles(spark, structured, title, field, snippet, best):
    df = spark.createDataFrame([(structured, title, field, snippet)], "e boolean, t string, f string, s string")
    assert df.select(extract.card_title("e", "t", "f", "s").alias("x")).first().x == best


@pytest.mark.parametrize(
    "section,found",
    [
        ("사업시행주체\n구분\n 한국 연구원 \n끝", "한국 연구원"), ("시행주체\n기관명\n# 제목\n연구원", None), ("사업시행주체\n직접 수행\n시행주체\n연구원", "연구원"), ("사업시행주체\n(단위: 원)", None), ("사업시행주체\n구분\n기관\n기관명\n사업명\n연구원", None),
        ("사업시행주체: 연구원", None), ("사업시행주체", None), (None, None),
    ],
)
def test_implementer_below_its_label(spark, section, found):
    assert spark.createDataFrame([(section,)], "a string").select(extract.implementer_below("a").alias("x")).first().x == found


def greedy(rows):
    """The scan from chunk to chunk that anchors() stands for."""
    import re

    shape = re.compile(r"^\s*#{1,6}\s*\(\d+\).+\(\d{3,6}-\d{2,6}\)\s*$")
    bare = lambda s: re.sub(r"^\s*#{1,6}\s*", "", s).strip()
    out, i = [], 0
    while i < len(rows):
        kind, page, line = rows[i]
        if kind == "heading" and shape.match(line):
            out.append((i, 1))
        elif kind == "heading" and i + 1 < len(rows) and rows[i + 1][:2] == ("heading", page) and shape.match(f"### {bare(line)} {bare(rows[i + 1][2])}"):
            out.append((i, 2))
            i += 1
        i += 1
    return out


def test_anchors_are_greedy(spark):
    import random

    draw = random.Random(3)
    texts = ["## (1) 사업 (1337-300)", "(2) 앞", "뒤 (1337-301)", "# (3) 가운데", "### 뒤 (1337-302)", "(4) 온전 (1337-303)", "본문"]
    docs = {f"d{k}": [(draw.choice(["heading", "heading", "heading", "text"]), draw.randint(1, 2), draw.choice(texts)) for _ in range(14)] for k in range(40)}
    df = spark.createDataFrame([(d, i, *r) for d, rows in docs.items() for i, r in enumerate(rows)], "source_pdf string, chunk_idx int, type string, page int, text string")
    got = sorted((r.source_pdf, r.chunk_idx, r.width) for r in sections.anchors(df).collect())
    assert got == sorted((d, i, w) for d, rows in docs.items() for i, w in greedy(rows))


def test_reachable_past_a_hundred_edges(spark):
    e = spark.range(130).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    assert graph.reachable(e, spark.range(1)).agg(F.max("depth")).first()[0] == 130


def test_steps_have_phase_and_actor(spark):
    df = spark.createDataFrame([("성과 점검",), ("신청 접수",), ("집행",), ("행안부 교부",), ("연구원 수행",), ("주민 신청",)], "s string").select("s", F.lit("행정안전부").alias("m"), F.lit("연구원").alias("i"), F.lit("주민").alias("b"))
    got = [(r.p, r.a.actor, r.a.assertion) for r in df.select(classify.phase("s").alias("p"), classify.step_actor("s", "m", "i", "b").alias("a")).collect()]
    assert got == [("G6", "implementer", "derived"), ("G3", "implementer", "derived"), ("G4", "implementer", "derived"), ("G3", "ministry", "documented"), ("G4", "implementer", "documented"), ("G3", "beneficiary", "documented")]


def test_blocks_and_merged_headings(spark):
    chunks = spark.createDataFrame([("d", 0, "heading", 1, "## (1) 가나 사업 (1337-300)"), ("d", 1, "text", 1, "내용"), ("d", 2, "heading", 2, "## (2) 다라"), ("d", 3, "heading", 2, "## 마바 (1337-301)"), ("d", 4, "text", 2, "끝")], "source_pdf string, chunk_idx int, type string, page int, text string")
    found = sections.blocks(sections.anchors(chunks), chunks.groupBy("source_pdf").agg(F.max("chunk_idx").alias("last")))
    assert sorted((r.heading.code, r.width, r.block_start, r.block_end) for r in found.collect()) == [("1337-300", 1, 0, 1), ("1337-301", 2, 2, 4)]
    assert sections.chunks_in(found, chunks).count() == 5


def test_tree_laws(spark):
    lines = spark.createDataFrame([("a", "x", 3), ("a", None, 4), (None, "x", 5)], "k string, j string, v long")
    tree = hierarchy.rollup_tree(lines, ["k", "j"], "v")
    assert quality.tree_sums(tree, "t").count() == 0 and tree.filter("level = 0").first().amount == 12 and tree.count() == 6
    broken = tree.withColumn("amount", F.when(F.col("level") == 0, 1).otherwise(F.col("amount")))
    assert quality.tree_sums(broken, "t").count() == 1


def test_cycles_end(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "src string, dst string")
    assert graph.reachable(e, spark.createDataFrame([("a",)], "id string")).count() == 3


def test_dense_tiers(spark):
    rows = spark.createDataFrame([("20260101", "strong", "g", 5, 1)], "d string, t string, g string, b int, s int")
    got = timeline.tier_summary(rows, "d", "t", ("strong", "broad"), rows.select("d"), F.col("g"), ["b", "s"], "s", "b").orderBy("tier_order").collect()
    assert [(r.n, r.rate) for r in got] == [(1, 0.2), (0, None)]


def test_seeds_win(spark):
    rows = spark.createDataFrame([("b", "x", "old"), ("c", "x", "old")], "business_id string, label string, note string")
    seeds = spark.createDataFrame([("b", "x", "new")], "business_id string, label string, note string")
    assert sorted(r.note for r in flow.seeded(rows, seeds, ["business_id", "label"], ["note"]).collect()) == ["new", "old"]


def test_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id":"c1","type":"text","page":1,"text":"x"},{"id":"c2","type":"heading","page":2,"text":"y"}]')
    assert [(r.source_pdf, r.chunk_idx, r.id) for r in landed.chunk_files(spark, f"file://{tmp_path}/a.json").orderBy("chunk_idx").collect()] == [("a", 0, "c1"), ("a", 1, "c2")]
    (tmp_path / "p.pdf").write_bytes(b"%PDF" + b"0" * 2000)
    (tmp_path / "q.pdf").write_bytes(b"<html" + b"0" * 2000)
    assert landed.documents(spark, f"file://{tmp_path}/*.pdf").count() == 1


def test_stream(spark, tmp_path):
    from wonweave.streaming import ingest

    spark.createDataFrame([(1, "2026-01-01 00:00:00", "a"), (1, "2026-01-01 00:00:00", "a"), (2, "2026-01-05 00:00:00", "a")], "id int, ts string, kind string").selectExpr("id", "cast(ts as timestamp) ts", "kind").write.parquet(str(tmp_path / "in"))
    stream = ingest.windowed(ingest.landing(spark, str(tmp_path / "in"), "id int, ts timestamp, kind string"), "ts", "kind", "id")
    ingest.run_once(stream, str(tmp_path / "c"), str(tmp_path / "out"))
    assert [r.n for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [1]
