"""Workflow graphs of suppliers: their lines are the budget and its items, documents and local rows follow from keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wonweave.functions import columns
from wonweave.operators import flow_map, workflow
from wonweave.plans.registry import query, table

#: section, whether a supplier has it, its text.
TEXTS = (
    ("purpose", "s_suppkey % 2 = 0", "'사업 목적 ' || s_name"), ("legal_history", "s_suppkey % 3 = 0", "'법률 제' || s_suppkey || '조'"), ("effects", "s_suppkey % 5 = 0", "'효과가 있다'"), ("review", "s_suppkey % 7 = 0", "'지적 사항'"),
    ("implementation", "s_suppkey % 4 <> 1", "'시행 주체 : 기관 ' || s_suppkey % 11 || CASE WHEN s_suppkey % 6 <> 0 THEN chr(10) || '지원대상 : 주민 ' || s_suppkey % 9 ELSE '' END"),
    ("procedure", "s_suppkey % 2 = 1", "'신청 접수 → 심사 → 교부 → ' || CASE WHEN s_suppkey % 3 = 1 THEN '주민 ' || s_suppkey % 9 || ' 설명회' ELSE '정산' END"),
)
CARD = "s_suppkey % 10 = 3"


def facts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).withColumn("business_id", F.col("s_suppkey").cast("string"))
    li = table(spark, sf_dir, "lineitem").withColumn("amount", columns.cents("l_extendedprice")).withColumn("business_id", F.col("l_suppkey").cast("string"))
    total = li.groupBy("business_id").agg(F.sum("amount").alias("congress_amt"))
    business = s.join(total, "business_id", "left").select("business_id", F.lit(2026).alias("year"), F.col("n_name").alias("office_name"), F.coalesce("congress_amt", F.lit(0)).alias("congress_amt"))
    items = li.groupBy("business_id", F.col("l_returnflag").alias("mok_name"), F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("semok_name")).agg(F.sum("amount").alias("amount"), F.count("*").alias("line_count"))
    items = items.join(total.withColumnRenamed("congress_amt", "all"), "business_id").withColumn("share", columns.share("amount", "all", 8))
    place = [F.concat(F.lit("doc"), (F.col("s_suppkey") % 3).cast("string")).alias("source_pdf"), F.col("s_suppkey").cast("int").alias("page_start"), (F.col("s_suppkey") + 2).cast("int").alias("page_end"), F.lit("c1").alias("chunk_start"), F.lit("c9").alias("chunk_end")]
    said = F.filter(F.array(*[F.struct(F.lit(n).alias("section"), F.when(F.expr(has), F.expr(t)).alias("text")) for n, has, t in TEXTS]), lambda x: x["text"].isNotNull())
    sections = s.select("business_id", *place, F.explode(said).alias("x")).select("business_id", "source_pdf", "page_start", "page_end", "chunk_start", "chunk_end", "x.section", "x.text", F.concat_ws("-", "business_id", "x.section").alias("evidence_id"))
    cards = s.filter(CARD).select("business_id", F.lit("k").alias("card"), F.lit("전담 기관").alias("implementer"), *place)
    who = workflow.people(business, sections, cards)
    local = li.filter("l_quantity >= 49").select("business_id", F.concat(F.lit("gov "), (F.col("l_orderkey") % 20).cast("string")).alias("local_gov_name"), F.lit(None).cast("string").alias("local_gov_code"), F.lit("기초").alias("local_level"), F.lit("20260101").alias("exe_ymd"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("detail_business_code"), F.lit("지방사업").alias("detail_business_name"), F.col("amount").alias("national_amt"))
    return {"business": business, "items": items, "cards": cards, "sections": sections.join(who.select("business_id", "implementer"), "business_id", "left"), "people": who, "steps": workflow.steps_of(sections, who, F.split("text", " → ")), "local": local}


_SECTIONS = " UNION ALL ".join(f"SELECT CAST(s_suppkey AS VARCHAR) AS b, '{n}' AS section, {t} AS text FROM supplier WHERE {has}" for n, has, t in TEXTS)
_SECTION_NODES = " UNION ALL ".join(f"SELECT b, {rule} AS rule, 1 AS nth, '{phase}' AS phase, '{kind}' AS kind, '{actor}' AS actor, '{label}' AS label, regexp_replace(text, '\\s+', ' ', 'g') AS detail, NULL::BIGINT AS amount, 'documented' AS assertion, b || '-{name}' AS evidence_id FROM se WHERE section = '{name}'" for rule, phase, kind, actor, label, name in (
    (0, "G0", "purpose", "ministry", "사업 목적·내용", "purpose"), (1, "G0", "basis", "ministry", "법적 근거·추진 경위", "legal_history"), (8, "G6", "performance", "ministry", "사업 효과·성과지표", "effects"), (9, "G6", "review", "ministry", "외부 지적·평가·결산", "review"),
))
NODES = f"""
WITH se AS ({_SECTIONS}), li AS (SELECT CAST(l_suppkey AS VARCHAR) AS b, CAST(round(l_extendedprice * 100) AS BIGINT) AS a, * FROM lineitem),
su AS (SELECT b, CAST(sum(a) AS BIGINT) AS a FROM li GROUP BY 1),
it AS (SELECT b, l_returnflag AS m, 'line ' || l_linenumber AS s, CAST(sum(a) AS BIGINT) AS a, count(*) AS n FROM li GROUP BY ALL),
it8 AS (SELECT *, row_number() OVER (PARTITION BY b ORDER BY a DESC, m, s) AS nth FROM it QUALIFY nth <= 8),
lo AS (SELECT b, a, 'gov ' || l_orderkey % 20 AS gov, row_number() OVER (PARTITION BY b ORDER BY a DESC, 'gov ' || l_orderkey % 20, l_orderkey || '-' || l_linenumber || '-' || l_partkey) AS nth FROM li WHERE l_quantity >= 49 QUALIFY nth <= 12),
sp AS (SELECT CAST(s_suppkey AS VARCHAR) AS b, s_suppkey AS k, n_name AS office, CASE WHEN {CARD} THEN '전담 기관' WHEN s_suppkey % 4 <> 1 THEN '기관 ' || s_suppkey % 11 END AS imp, CASE WHEN s_suppkey % 4 <> 1 AND s_suppkey % 6 <> 0 THEN '주민 ' || s_suppkey % 9 END AS ben FROM supplier JOIN nation ON s_nationkey = n_nationkey),
st AS (SELECT b, unnest(string_split(text, ' → ')) AS step, generate_subscripts(string_split(text, ' → '), 1) AS nth FROM se WHERE section = 'procedure'),
un AS ({_SECTION_NODES}
  UNION ALL SELECT sp.b, 2, 1, 'G1', 'budget', 'ministry', '2026년 국회확정액', '열린재정 ExpenditureBudgetAdd2의 목·세목 합계', coalesce(su.a, 0), 'api', NULL FROM sp LEFT JOIN su USING (b)
  UNION ALL SELECT it8.b, 3, nth, 'G1', 'budget_item', 'ministry', m || ' · ' || s, '원자료 ' || n || '행 · 사업액 대비 ' || format('{{:.1f}}', round_even(it8.a / su.a, 8) * 100) || '%', it8.a, 'api', NULL FROM it8 JOIN su USING (b)
  UNION ALL SELECT b, 4, 1, 'G2', 'implementation', CASE WHEN imp IS NULL THEN 'ministry' ELSE 'implementer' END, '시행방법·시행주체', regexp_replace(text, '\\s+', ' ', 'g'), NULL, 'documented', b || '-implementation' FROM se JOIN sp USING (b) WHERE section = 'implementation'
  UNION ALL SELECT b, 5, 1, 'G2', 'beneficiary', 'beneficiary', '사업 수혜자', ben, NULL, 'documented', b || '-implementation' FROM sp WHERE ben IS NOT NULL
  UNION ALL SELECT b, 6, nth, CASE WHEN step = '정산' THEN 'G6' WHEN step LIKE '%설명회' THEN 'G4' ELSE 'G3' END, 'procedure', CASE WHEN ben IS NOT NULL AND step LIKE '주민%' THEN 'beneficiary' WHEN imp IS NOT NULL THEN 'implementer' ELSE 'ministry' END, step, step, NULL, 'documented', b || '-procedure' FROM st JOIN sp USING (b)
  UNION ALL SELECT b, 7, nth, 'G5', 'local_candidate', 'local', gov || ' · 지방사업', '기초 · 기준일 20260101 · 중앙사업과의 관계는 keyword_candidate', a, 'candidate', NULL FROM lo),
nu AS (SELECT *, row_number() OVER (PARTITION BY b ORDER BY rule, nth) - 1 AS i FROM un),
no AS (SELECT b AS business_id, 'p-' || substr(sha256(b || chr(31) || kind || chr(31) || label || chr(31) || CASE WHEN i = 0 THEN '' ELSE CAST(i AS VARCHAR) END), 1, 14) AS id, 'P' || CASE WHEN i < 9 THEN '0' ELSE '' END || (i + 1) AS display_id, phase, kind, actor, label, detail, amount, assertion, evidence_id, i FROM nu)"""


@query(f"{NODES} SELECT business_id, id, display_id, phase, kind, actor, label, CASE WHEN kind <> 'budget_item' THEN detail END AS detail, coalesce(amount, 0) AS amount, assertion, evidence_id FROM no")
def workflow_graph_nodes(spark, sf_dir):
    n = workflow.nodes(facts(spark, sf_dir))
    # shares are rounded from doubles, which engines may do differently in the last place
    return n.select("business_id", "id", "display_id", "phase", "kind", "actor", "label", F.when(F.col("kind") != "budget_item", F.col("detail")).alias("detail"), F.coalesce(F.col("amount").cast("long"), F.lit(0)).alias("amount"), "assertion", F.col("evidence.evidence_id").alias("evidence_id"))


@query(f"""{NODES},
ed AS (SELECT business_id AS b, 0 AS rule, d.i, s.id AS src, d.id AS dst, 'context' AS type, 'derived' AS assertion FROM no AS s JOIN no AS d USING (business_id) WHERE s.kind = 'basis' AND d.kind = 'purpose'
  UNION ALL SELECT business_id, 1, d.i, s.id, d.id, 'fund', 'api' FROM no AS s JOIN no AS d USING (business_id) WHERE s.kind = 'budget' AND d.kind = 'budget_item'
  UNION ALL SELECT business_id, 2, d.i, s.id, d.id, 'delivery', 'documented' FROM no AS s JOIN no AS d USING (business_id) WHERE s.kind = 'implementation' AND d.kind = 'beneficiary'
  UNION ALL SELECT business_id, 3, s.i, s.id, d.id, 'sequence', 'documented' FROM no AS s JOIN no AS d USING (business_id) WHERE s.kind = 'procedure' AND d.kind = 'procedure' AND d.i = s.i + 1
  UNION ALL SELECT business_id, 4, d.i, s.id, d.id, 'candidate', 'candidate' FROM no AS s JOIN no AS d USING (business_id) WHERE s.kind = 'budget' AND d.kind = 'local_candidate'),
en AS (SELECT *, row_number() OVER (PARTITION BY b ORDER BY rule, i) - 1 AS k FROM ed)
SELECT b AS business_id, 'e-' || substr(sha256(b || chr(31) || src || chr(31) || dst || chr(31) || type || chr(31) || CASE WHEN k = 0 THEN '' ELSE CAST(k AS VARCHAR) END), 1, 14) AS id, src, dst, type, assertion FROM en""")
def workflow_graph_edges(spark, sf_dir):
    return workflow.edges(workflow.nodes(facts(spark, sf_dir))).select("business_id", "id", "src", "dst", "type", "assertion")


@query(f"""{NODES}, lc AS (SELECT DISTINCT b FROM lo)
SELECT b AS business_id, role, name, assertion FROM (SELECT b, 'ministry' AS role, office AS name, 'api' AS assertion FROM sp UNION ALL SELECT b, 'implementer', imp, 'documented' FROM sp UNION ALL SELECT b, 'beneficiary', ben, 'documented' FROM sp UNION ALL SELECT b, 'local', '{workflow.LOCAL_ACTOR}', 'candidate' FROM lc) WHERE name IS NOT NULL""")
def workflow_graph_actors(spark, sf_dir):
    f = facts(spark, sf_dir)
    return workflow.actors(f["people"], f["business"], f["local"]).select("business_id", "role", "name", "assertion")


@query(f"""{NODES} SELECT sp.b AS business_id, CASE WHEN k % 2 = 1 THEN 'documented_flow' WHEN {CARD.replace("s_suppkey", "k")} THEN 'structured_facts' ELSE 'api_only' END AS level, CAST({CARD.replace("s_suppkey", "k")} AS BIGINT) AS n_cards, CAST(k % 2 AS BIGINT) AS n_sequences FROM sp""")
def workflow_coverage(spark, sf_dir):
    f = facts(spark, sf_dir)
    return workflow.coverage(f["business"], workflow.nodes(f), f["cards"])


def flow_facts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Suppliers as businesses: lines by flag and status are items, lines of two part sizes subprojects, lines of a quantity of 50 local rows of the customer's nation."""
    li = table(spark, sf_dir, "lineitem").withColumn("amount", columns.cents("l_extendedprice")).withColumn("business_id", F.col("l_suppkey").cast("string"))
    s = table(spark, sf_dir, "supplier").withColumn("business_id", F.col("s_suppkey").cast("string"))
    held = li.filter("l_suppkey % 5 <> 0")
    total = li.groupBy("business_id").agg(F.sum("amount").alias("total"))
    business = s.join(total, "business_id", "left").select("business_id", F.col("s_name").alias("title"), F.lit("일반회계").alias("account"), F.coalesce("total", F.lit(0)).alias("total"))
    item = F.concat("l_returnflag", "l_linestatus")
    code = F.when(F.col("l_returnflag") == "R", "local_subsidy").when(F.col("l_returnflag") == "A", "procurement").otherwise("internal")
    items = held.groupBy("business_id", item.alias("item_id"), code.alias("code")).agg(F.sum("amount").alias("amount")).withColumn("title", F.col("item_id"))
    subs = li.filter("l_suppkey % 3 = 0").groupBy("business_id", (F.col("l_linenumber") % 2).alias("id")).agg(F.sum("amount").alias("amount")).withColumn("label", F.concat(F.lit("내역 "), F.col("id").cast("string")))
    cross = li.filter("l_suppkey % 2 = 0").groupBy("business_id", (F.col("l_linenumber") % 3).alias("subproject_id"), code.alias("code")).agg(F.sum("amount").alias("amount"))
    places = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("o_orderkey", "n_name")
    local = li.filter("l_quantity = 50").join(places, F.col("l_orderkey") == F.col("o_orderkey")).select("business_id", F.col("n_name").alias("region_name"), F.col("amount").alias("national_amt"), (F.col("amount") * 2).alias("budget_cash_amt"), F.when(F.col("l_linenumber") == 1, 1).when(F.col("l_linenumber") == 2, 7).alias("subproject_id"))
    k = F.col("s_suppkey")
    return {
        "business": business, "subprojects": subs, "basis": s.filter("s_suppkey % 4 = 1").select("business_id", F.lit("근거").alias("text")), "items": items, "noted": s.filter("s_suppkey % 2 = 1").select("business_id", F.lit("procurement").alias("code")),
        "local": local, "people": s.select("business_id", F.when(k % 3 == 1, F.concat(F.lit("주민 "), k.cast("string"))).alias("beneficiary")), "cross": cross,
    }


_CODE = "CASE l_returnflag WHEN 'R' THEN 'local_subsidy' WHEN 'A' THEN 'procurement' ELSE 'internal' END"
FLOW_NODES = f"""
WITH li AS (SELECT l_suppkey AS k, CAST(round(l_extendedprice * 100) AS BIGINT) AS a, * FROM lineitem), b AS (SELECT s_suppkey AS k, s_name, coalesce(sum(a), 0) AS t FROM supplier LEFT JOIN li ON li.k = s_suppkey GROUP BY ALL),
it AS (SELECT k, l_returnflag || l_linestatus AS i, {_CODE} AS code, sum(a) AS a FROM li WHERE k % 5 <> 0 GROUP BY ALL), ch AS (SELECT k, code, sum(a) AS a FROM it GROUP BY ALL), su AS (SELECT k, l_linenumber % 2 AS i, sum(a) AS a FROM li WHERE k % 3 = 0 GROUP BY ALL),
cr AS (SELECT k, l_linenumber % 3 AS i, {_CODE} AS code, sum(a) AS a FROM li WHERE k % 2 = 0 GROUP BY ALL),
lo AS (SELECT li.k, n_name AS r, a, CASE l_linenumber WHEN 1 THEN 1 WHEN 2 THEN 7 END AS s FROM li JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE l_quantity = 50),
rg AS (SELECT k, r, sum(a) * 2 AS a, row_number() OVER (PARTITION BY k ORDER BY sum(a) DESC, r) AS p, count(*) OVER (PARTITION BY k) AS n FROM lo GROUP BY k, r QUALIFY p <= 8),
nl AS (SELECT k, count(*) AS n FROM lo GROUP BY 1), x AS (SELECT b.k, s_name, t, coalesce(nl.n, 0) AS n, EXISTS (SELECT 1 FROM su WHERE su.k = b.k) AS hs, EXISTS (SELECT 1 FROM it WHERE it.k = b.k) AS hi, (SELECT sum(a) FROM it WHERE it.k = b.k) AS ti, (SELECT sum(a) FROM su WHERE su.k = b.k) AS ts FROM b LEFT JOIN nl USING (k)),
no(k, id, type, stage, title, amount) AS (
  SELECT k, 'source', 'source', 'G0', '일반회계', t FROM x UNION ALL SELECT k, 'business', 'core', 'G0', s_name, t FROM x UNION ALL SELECT k, 'sub:' || i, 'item', 'G1', '내역 ' || i, a FROM su
  UNION ALL SELECT k, CASE WHEN k % 4 = 1 THEN 'basis' ELSE 'sub:unknown' END, CASE WHEN k % 4 = 1 THEN 'item' ELSE 'unknown' END, 'G1', CASE WHEN k % 4 = 1 THEN '산출근거' ELSE '내역사업 배분 근거 없음' END, NULL FROM x WHERE NOT hs
  UNION ALL SELECT k, 'item:' || i, 'item', 'G2', i, a FROM it UNION ALL SELECT k, 'item:none', 'unknown', 'G2', '확정 목·세목 없음', 0 FROM x WHERE NOT hi UNION ALL SELECT k, 'channel:' || code, 'channel', 'G2', code, a FROM ch UNION ALL SELECT k, 'channel:none', 'unknown', 'G2', '집행채널 없음', 0 FROM x WHERE NOT hi
  UNION ALL SELECT k, 'destination:' || code, CASE WHEN k % 2 = 1 AND code = 'procurement' THEN 'destination' ELSE 'unknown' END, 'G3', code, a FROM ch
  UNION ALL SELECT k, 'local', CASE WHEN n > 0 THEN 'candidate' ELSE 'unknown' END, 'G4', CASE WHEN n > 0 THEN '지역 세부사업 ' || n || '건' ELSE '지역 편성 후보 미확인' END, NULL FROM x
  UNION ALL SELECT k, 'region:' || r, 'candidate', 'G4', r, a FROM rg UNION ALL SELECT k, 'region:more', 'candidate', 'G4', '그 밖의 ' || (n - 8) || '개 권역', NULL FROM rg WHERE p = 1 AND n > 8
  UNION ALL SELECT k, 'beneficiary', CASE WHEN k % 3 = 1 THEN 'beneficiary' ELSE 'unknown' END, 'G5', CASE WHEN k % 3 = 1 THEN '주민 ' || k ELSE '수혜자 미확인' END, NULL FROM x
  UNION ALL SELECT k, 'reconcile:items', CASE WHEN ti = t THEN 'reconcile' ELSE 'unknown' END, 'G5', '세부사업 총액 = 목·세목 합계', ti - t FROM x UNION ALL SELECT k, 'reconcile:subprojects', CASE WHEN ts = t THEN 'reconcile' ELSE 'unknown' END, 'G5', '세부사업 총액 = 내역사업 합계', ts - t FROM x
  UNION ALL SELECT k, 'reconcile:local', CASE WHEN n > 0 THEN 'candidate' ELSE 'unknown' END, 'G5', '지역 스냅샷', NULL FROM x)"""


@query(f"{FLOW_NODES} SELECT CAST(k AS VARCHAR) AS business_id, id, type, stage, title, CAST(coalesce(amount, -1) AS BIGINT) AS amount FROM no")
def flow_map_nodes(spark, sf_dir):
    n = flow_map.nodes(flow_facts(spark, sf_dir))
    return n.withColumn("amount", F.coalesce("amount", F.lit(-1)).cast("long"))


@query(f"""{FLOW_NODES}, ed(k, src, dst, type, amount) AS (
  SELECT k, 'source', 'business', 'flow', t FROM x UNION ALL SELECT k, 'business', 'sub:' || i, 'flow', a FROM su UNION ALL SELECT k, 'business', 'item:' || i, 'flow', a FROM it UNION ALL SELECT k, 'item:' || i, 'channel:' || code, 'classification', 0 FROM it
  UNION ALL SELECT k, 'sub:' || i, 'channel:' || code, 'crosswalk', a FROM cr UNION ALL SELECT k, 'channel:' || code, 'destination:' || code, 'flow', a FROM ch UNION ALL SELECT k, 'channel:local_subsidy', 'local', 'candidate', 0 FROM nl UNION ALL SELECT DISTINCT k, 'sub:' || s, 'local', 'candidate', 0 FROM lo WHERE s IS NOT NULL
  UNION ALL SELECT k, 'local', 'region:' || r, 'candidate', 0 FROM rg UNION ALL SELECT k, 'local', 'region:more', 'candidate', 0 FROM rg WHERE p = 1 AND n > 8 UNION ALL SELECT k, 'destination:' || code, 'beneficiary', 'context', 0 FROM ch UNION ALL SELECT k, 'local', 'reconcile:local', 'context', 0 FROM nl)
SELECT CAST(ed.k AS VARCHAR) AS business_id, src, dst, ed.type, CAST(ed.amount AS BIGINT) AS amount FROM ed WHERE EXISTS (SELECT 1 FROM no WHERE no.k = ed.k AND no.id = src) AND EXISTS (SELECT 1 FROM no WHERE no.k = ed.k AND no.id = dst)""")
def flow_map_edges(spark, sf_dir):
    f = flow_facts(spark, sf_dir)
    return flow_map.edges(f, flow_map.nodes(f)).withColumn("amount", F.col("amount").cast("long"))
