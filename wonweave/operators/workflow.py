"""Workflow graphs from facts: what becomes a node, an actor or an edge is said by tables of rules.

Facts are frames with a business_id; a rule names the frame, which rows of it count and in what order, and
what a node says. Nodes and edges are numbered in order of the rules, and their ids follow from
their numbers. Each carries what it rests on (EVIDENCE) and how far that goes (`assertion`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wonweave.functions import extract, text
from wonweave.functions.columns import col, key, let, stable_id
from wonweave.operators import classify

ASSERTIONS = ("api", "documented", "derived", "candidate")
KINDS = ("purpose", "basis", "budget", "budget_item", "implementation", "beneficiary", "procedure", "local_candidate", "performance", "review")
#: What a node, edge or actor rests on; fields that don't apply are null.
EVIDENCE = {
    "source_type": "string", "service": "string", "field": "string", "year": "int", "exe_ymd": "string", "match_status": "string",
    "source_pdf": "string", "page_start": "int", "page_end": "int", "chunk_start": "string", "chunk_end": "string", "evidence_id": "string",
}
EVIDENCE_TYPE = "struct<" + ",".join(f"{k}:{t}" for k, t in EVIDENCE.items()) + ">"
PLACE = ("source_pdf", "page_start", "page_end", "chunk_start", "chunk_end")
#: Names of services and fields, and the labels of actors' roles.
BUDGET_API, BUDGET_FIELD, LOCAL_API = "ExpenditureBudgetAdd2", "Y_YY_DFN_KCUR_AMT", "QWGJK"
ROLES = {"ministry": "소관부처", "implementer": "문서상 시행주체", "beneficiary": "문서상 수혜자", "local": "LOFIN 지방사업 후보"}
LOCAL_ACTOR, UNKNOWN_MINISTRY = "광역·기초 지방자치단체", "소관부처"
IMPLEMENTER_LABELS, BENEFICIARY_LABELS = ["사업 시행 주체", "시행 주체"], ["사업 수혜자", "수혜 대상", "지원 대상"]


def evidence(**fields: Column | str | int | None) -> Column:
    """A provenance struct; strings are literal."""
    value = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.struct(*[value(fields.get(k)).cast(t).alias(k) for k, t in EVIDENCE.items()])


def of_api(field: str | None = None, year: Column | None = None) -> Column:
    return evidence(source_type="openfiscal_api", service=BUDGET_API, field=field, year=year)


def of_candidate(day: Column | None = None) -> Column:
    return evidence(source_type="lofin_api", service=LOCAL_API, exe_ymd=day, match_status="keyword_candidate")


def of_section() -> Column:
    """Of a row of sections: its place in the document, and its own id."""
    return evidence(source_type="ministry_pdf", evidence_id=F.col("evidence_id"), **{c: F.col(c) for c in PLACE})


def of_card(field: str) -> Column:
    """Of a card's field, where no section was found."""
    return evidence(source_type="ministry_pdf", field=field, **{c: F.col(c) for c in PLACE})


@dataclass(frozen=True)
class Node:
    """Rows of `source` (those that `where` holds for, in `order`, up to `most` of a business) become nodes of a kind."""

    kind: str
    phase: str | Column
    source: str
    label: str | Column
    detail: str | Column
    assertion: str
    evidence: Column
    actor: str | Column = "ministry"
    where: str = "true"
    order: tuple[Column, ...] = ()
    most: int | None = None
    amount: Column | None = None
    actor_assertion: Column | None = None
    chain: Column | None = None


@dataclass(frozen=True)
class Edge:
    """From the node of kind `source` to those of kind `target`; a `chain` joins neighbours of one chain."""

    type: str
    source: str
    target: str
    assertion: str
    label: str
    evidence: Column
    chain: bool = False


def _node_rules() -> tuple[Node, ...]:
    c = F.col
    first = (c("source_pdf"), c("page_start"), c("evidence_id"))
    section = lambda kind, phase, name, label, **more: Node(kind, phase, "sections", label, c("text"), "documented", of_section(), where=f"section = '{name}'", order=first, most=1, **more)
    implementer = F.when(c("implementer").isNotNull(), "implementer").otherwise("ministry")
    local = (c("national_amt").desc(), F.coalesce("local_gov_name", F.lit("")), F.coalesce("exe_ymd", F.lit("")), F.coalesce("local_gov_code", F.lit("")), F.coalesce("detail_business_code", F.lit("")), F.coalesce("detail_business_name", F.lit("")))
    return (
        section("purpose", "G0", "purpose", "사업 목적·내용"),
        section("basis", "G0", "legal_history", "법적 근거·추진 경위"),
        Node("budget", "G1", "business", F.concat(c("year").cast("string"), F.lit("년 국회확정액")), "열린재정 ExpenditureBudgetAdd2의 목·세목 합계", "api", of_api(BUDGET_FIELD, c("year")), amount=c("congress_amt")),
        Node(
            "budget_item", "G1", "items", F.concat_ws(" · ", "mok_name", "semok_name"), F.concat(F.lit("원자료 "), c("line_count").cast("string"), F.lit("행 · 사업액 대비 "), F.format_string("%.1f", F.coalesce("share", F.lit(0.0)) * 100), F.lit("%")), "api", of_api(BUDGET_FIELD),
            order=(c("amount").desc(), c("mok_name"), c("semok_name")), most=8, amount=c("amount"),
        ),
        section("implementation", "G2", "implementation", "시행방법·시행주체", actor=implementer),
        Node("beneficiary", "G2", "people", "사업 수혜자", c("beneficiary"), "documented", c("beneficiary_evidence"), actor="beneficiary", where="beneficiary IS NOT NULL"),
        Node("procedure", classify.phase("step"), "steps", c("step"), c("step"), "documented", of_section(), actor=c("by.actor"), order=(*first, c("seq")), actor_assertion=c("by.assertion"), chain=c("evidence_id")),
        Node(
            "local_candidate", "G5", "local", F.concat_ws(" · ", F.coalesce("local_gov_name", F.lit("지자체")), F.coalesce("detail_business_name", F.lit("지방사업"))),
            F.concat(F.coalesce("local_level", F.lit("단계 미상")), F.lit(" · 기준일 "), F.coalesce("exe_ymd", F.lit("-")), F.lit(" · 중앙사업과의 관계는 keyword_candidate")), "candidate", of_candidate(c("exe_ymd")), actor="local", order=local, most=12, amount=F.coalesce("national_amt", F.lit(0)),
        ),
        section("performance", "G6", "effects", "사업 효과·성과지표"),
        section("review", "G6", "review", "외부 지적·평가·결산"),
    )


def _edge_rules() -> tuple[Edge, ...]:
    target = F.col("target_evidence")
    return (
        Edge("context", "basis", "purpose", "derived", "근거·목적 분류", F.lit(None).cast(EVIDENCE_TYPE)),
        Edge("fund", "budget", "budget_item", "api", "목·세목 구성", of_api(BUDGET_FIELD)),
        Edge("delivery", "implementation", "beneficiary", "documented", "문서상 수혜 관계", target),
        Edge("sequence", "procedure", "procedure", "documented", "문서 명시 순서", target, chain=True),
        Edge("candidate", "budget", "local_candidate", "candidate", "LOFIN 키워드 후보·합산 불가", target),
    )


def people(business: DataFrame, sections: DataFrame, cards: DataFrame) -> DataFrame:
    """business_id, ministry, implementer and beneficiary with their evidence, local: who acts in each business.

    Whom a card names implements, in order of cards; else whom the text on implementation names. The ministry
    itself isn't named twice.
    """
    told = sections.filter("section = 'implementation'")
    said = told.groupBy("business_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("source_pdf", "page_start", "evidence_id", "text"))), lambda x: x["text"]), "\n").alias("said"), F.min(F.struct("source_pdf", "page_start", "evidence_id", of_section().alias("e"))).alias("first"))
    named = cards.withColumn("named", extract.actor("implementer")).filter("named IS NOT NULL")
    named = named.groupBy("business_id").agg(F.min_by(F.struct("named", of_card("implementer").alias("e")), F.struct("source_pdf", "page_start", "card")).alias("card"))
    x = business.select("business_id", F.coalesce(text.collapse("office_name"), F.lit("")).alias("ministry")).join(said, "business_id", "left").join(named, "business_id", "left")
    x = x.withColumn("ministry", F.when(F.col("ministry") == "", UNKNOWN_MINISTRY).otherwise(F.col("ministry")))
    squeezed = lambda c: F.regexp_replace(c, r"(?U)\s+", "")
    implementer = F.coalesce("card.named", let(extract.labelled("said", IMPLEMENTER_LABELS), extract.actor))
    return x.select(
        "business_id", "ministry", let(implementer, lambda i: F.when(squeezed(i) != squeezed(F.col("ministry")), i)).alias("implementer"), F.coalesce("first.e", "card.e").alias("implementer_evidence"),
        let(extract.labelled("said", BENEFICIARY_LABELS), extract.actor).alias("beneficiary"), F.col("first.e").alias("beneficiary_evidence"),
    )


def actors(who: DataFrame, business: DataFrame, local: DataFrame) -> DataFrame:
    """business_id, id, role, role_label, name, assertion, evidence."""
    has_local = local.select("business_id").distinct().withColumn("local", F.lit(LOCAL_ACTOR))
    x = who.join(business.select("business_id", "year"), "business_id").join(has_local, "business_id", "left")
    made = lambda role, assertion, e: F.struct(F.lit(role).alias("role"), F.lit(ROLES[role]).alias("role_label"), F.col(role).alias("name"), F.lit(assertion).alias("assertion"), e.cast(EVIDENCE_TYPE).alias("evidence"))
    each = F.array(made("ministry", "api", of_api(None, F.col("year"))), made("implementer", "documented", F.col("implementer_evidence")), made("beneficiary", "documented", F.col("beneficiary_evidence")), made("local", "candidate", of_candidate()))
    return x.select("business_id", F.explode(F.filter(each, lambda a: a["name"].isNotNull())).alias("a")).select("business_id", stable_id("a", key("business_id", "a.role", "a.name"), 14).alias("id"), "a.*")


def _numbered(parts: Sequence[DataFrame], order: Sequence[str]) -> DataFrame:
    """With `ordinal`, from 0 in each business."""
    return reduce(DataFrame.unionByName, parts).withColumn("ordinal", F.row_number().over(Window.partitionBy("business_id").orderBy(*order)) - 1)


def _ordinal() -> Column:
    """As part of an id: 0 is left out."""
    return F.when(F.col("ordinal") == 0, "").otherwise(F.col("ordinal").cast("string"))


def nodes(facts: Mapping[str, DataFrame], rules: Sequence[Node] | None = None) -> DataFrame:
    """business_id, id, display_id, ordinal, phase, kind, actor (a role), actor_assertion, label, detail, amount, assertion, evidence, chain."""
    made = lambda v: v if isinstance(v, Column) else F.lit(v)
    parts = []
    for place, r in enumerate(rules or _node_rules()):
        nth = F.row_number().over(Window.partitionBy("business_id").orderBy(*(r.order or ("business_id",))))
        rows = facts[r.source].filter(r.where).withColumn("nth", nth)
        rows = rows.filter(F.col("nth") <= r.most) if r.most else rows
        clean = lambda v, n: F.left(text.collapse(made(v)), F.lit(n))
        parts.append(rows.select(
            "business_id", F.lit(place).alias("rule"), "nth", made(r.phase).alias("phase"), F.lit(r.kind).alias("kind"), made(r.actor).alias("actor"), (r.actor_assertion if r.actor_assertion is not None else F.lit(r.assertion)).alias("actor_assertion"),
            clean(r.label, 180).alias("label"), clean(r.detail, 900).alias("detail"), (r.amount if r.amount is not None else F.lit(None)).cast("decimal(20,0)").alias("amount"), F.lit(r.assertion).alias("assertion"), r.evidence.cast(EVIDENCE_TYPE).alias("evidence"), (r.chain if r.chain is not None else F.lit(None)).cast("string").alias("chain"),
        ))
    out = _numbered(parts, ["rule", "nth"])
    named = F.concat(stable_id("p", F.array(F.col("business_id").cast("string"), F.col("kind"), F.col("label"), _ordinal()), 14))
    return out.select("business_id", named.alias("id"), F.format_string("P%02d", F.col("ordinal") + 1).alias("display_id"), "ordinal", "phase", "kind", "actor", "actor_assertion", "label", "detail", "amount", "assertion", "evidence", "chain")


def edges(n: DataFrame, rules: Sequence[Edge] | None = None) -> DataFrame:
    """business_id, id, src, dst, type, label, assertion, evidence."""
    parts = []
    for place, r in enumerate(rules or _edge_rules()):
        if r.chain:
            w = Window.partitionBy("business_id", "chain").orderBy("ordinal")
            pairs = n.filter(F.col("kind") == r.source).select("business_id", F.col("id").alias("src"), F.lead("id").over(w).alias("dst"), F.col("ordinal").alias("nth"), F.col("evidence").alias("target_evidence")).filter("dst IS NOT NULL")
        else:
            src = n.filter(F.col("kind") == r.source).select("business_id", F.col("id").alias("src"))
            dst = n.filter(F.col("kind") == r.target).select("business_id", F.col("id").alias("dst"), F.col("ordinal").alias("nth"), F.col("evidence").alias("target_evidence"))
            pairs = src.join(dst, "business_id")
        parts.append(pairs.select("business_id", F.lit(place).alias("rule"), "nth", "src", "dst", F.lit(r.type).alias("type"), F.lit(r.label).alias("label"), F.lit(r.assertion).alias("assertion"), r.evidence.cast(EVIDENCE_TYPE).alias("evidence")))
    out = _numbered(parts, ["rule", "nth", "src"])
    named = stable_id("e", F.array(F.col("business_id").cast("string"), F.col("src"), F.col("dst"), F.col("type"), _ordinal()), 14)
    return out.select("business_id", named.alias("id"), "src", "dst", "type", "label", "assertion", "evidence")


def steps_of(sections: DataFrame, who: DataFrame, steps: Column) -> DataFrame:
    """A row for each step of procedure sections, with who takes it; `steps` is an array of a section's steps."""
    said = sections.filter("section = 'procedure'").withColumn("steps", steps).select("business_id", "evidence_id", *PLACE, F.posexplode("steps").alias("seq", "step"))
    return said.join(who.select("business_id", "ministry", "implementer", "beneficiary"), "business_id", "left").withColumn("by", classify.step_actor("step", "ministry", "implementer", "beneficiary")).drop("ministry", "implementer", "beneficiary")


def coverage(business: DataFrame, n: DataFrame, cards: DataFrame) -> DataFrame:
    """business_id, level, n_cards, n_sequences: whether documents say an order of steps, only facts, or nothing."""
    chains = n.filter("kind = 'procedure'").groupBy("business_id").agg(F.countDistinct("chain").alias("n_sequences"))
    held = cards.groupBy("business_id").agg(F.count("*").alias("n_cards"))
    x = business.select("business_id").join(chains, "business_id", "left").join(held, "business_id", "left").fillna(0, ["n_sequences", "n_cards"])
    return x.select("business_id", classify.coverage("n_sequences", F.lit(0), "n_cards").alias("level"), "n_cards", "n_sequences")


def broken(n: DataFrame, e: DataFrame, a: DataFrame) -> DataFrame:
    """check_id, key, message: what a graph must not have."""
    from wonweave.operators import graph, quality

    roles = a.select(F.col("business_id").alias("b"), F.col("role").alias("r")).distinct()
    nobody = n.join(roles, (F.col("business_id") == F.col("b")) & (F.col("actor") == F.col("r")), "left_anti")
    across = e.join(n.select(F.col("id").alias("src"), F.col("business_id").alias("sb")), "src").join(n.select(F.col("id").alias("dst"), F.col("business_id").alias("db")), "dst")
    unfounded = (F.col("assertion") != "derived") & (col("evidence").isNull() | F.col("evidence.source_type").isNull())
    placed = (F.col("evidence.source_type") == "ministry_pdf") & (F.col("evidence.source_pdf").isNull() | (F.col("evidence.page_start") > F.col("evidence.page_end")))
    both = [quality.violations(df, f"{name}_{what}", bad, F.col("id"), said) for name, df in (("node", n), ("edge", e)) for what, bad, said in (("evidence", unfounded, "no evidence"), ("place", placed, "no place in a document"), ("assertion", ~F.col("assertion").isin(*ASSERTIONS), "unknown assertion"))]
    return quality.union([
        *both, quality.not_unique(n, "node_id", ["id"]), quality.not_unique(n, "node_display", ["business_id", "display_id"]), quality.not_unique(e, "edge_id", ["id"]), quality.outside(n, "node_kind", "kind", KINDS, "id"), quality.outside(n, "node_phase", "phase", graph.PHASES, "id"), quality.outside(e, "edge_type", "type", graph.EDGE_TYPES, "id"),
        quality.violations(nobody, "node_actor", F.lit(True), F.col("id"), "actor isn't there"), quality.missing(e, n, "edge_source", "src", "id"), quality.missing(e, n, "edge_target", "dst", "id"), quality.violations(across, "edge_across", (F.col("sb") != F.col("db")) | (F.col("sb") != F.col("business_id")), F.col("id"), "ends in two businesses"),
        quality.violations(n, "candidate_only", (F.col("kind") == "local_candidate") & (F.col("assertion") != "candidate"), F.col("id"), "a candidate is said to be more"),
    ])
