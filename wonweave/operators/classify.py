"""Ordered rules as data; the first that holds decides."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from wonweave.functions.columns import col


def any_of(text: Column, needles: Sequence[str]) -> Column:
    out = F.lit(False)
    for n in needles:
        out = out | text.contains(n)
    return out


def first_rule(rules: Sequence[tuple[Column, str]], otherwise: str | None) -> Column:
    out = None
    for holds, name in rules:
        out = F.when(holds, name) if out is None else out.when(holds, name)
    return F.lit(otherwise) if out is None else out.otherwise(otherwise)


#: The eight channels of the canonical records, in order; (code, label, words).
CHANNELS = (
    ("local_subsidy", "지자체 이전", ("자치단체이전",)),
    ("private_transfer", "민간 이전", ("민간이전",)),
    ("contribution", "출연", ("출연금",)),
    ("loan", "융자", ("융자",)),
    ("equity", "출자", ("출자",)),
    ("international", "해외 이전", ("해외이전",)),
    ("capital", "시설·자산", ("건설비", "유형자산", "무형자산", "건설보상비")),
    ("direct", "직접 집행", ()),
)
#: The eleven channels of the flow maps; (code, label, display order).
FLOW_CHANNELS = (
    ("local_subsidy", "지방자치단체 보조", 10), ("private_delegation", "민간위탁", 20), ("private_subsidy", "민간보조", 30), ("contribution", "출연", 40), ("procurement", "용역·연구계약", 50), ("loan", "융자", 60),
    ("equity", "출자", 70), ("personnel", "인건비", 80), ("construction", "시설·자산", 90), ("internal", "운영·사업관리", 100), ("other", "기타 집행", 110),
)


def channel(mok: Column | str, semok: Column | str) -> Column:
    """The canonical channel of an item: words of item and sub-item; capital by the item's exact name."""
    mok, semok = (F.coalesce(col(c), F.lit("")) for c in (mok, semok))
    both = F.concat(mok, F.lit(" "), semok)
    rules = [(any_of(both, words) | (semok.contains("자치단체") if code == "local_subsidy" else F.lit(False)), code) for code, _, words in CHANNELS[:6]]
    return first_rule([*rules, (mok.isin(*CHANNELS[6][2]), "capital")], "direct")


#: Channels of the flow map in order; an item is of the first that has a word of each of its groups in both names together.
FLOW_WORDS = (
    ("local_subsidy", ("자치단체",), ("보조", "이전")),
    ("private_delegation", ("민간위탁",)),
    ("private_subsidy", ("민간",), ("보조",)),
    ("contribution", ("출연",)),
    ("loan", ("융자", "대여")),
    ("equity", ("출자",)),
    ("procurement", ("용역", "연구비", "연구개발")),
    ("personnel", ("인건비", "보수", "직급보조")),
    ("construction", ("시설비", "건설", "자산취득", "토지매입")),
    ("internal", ("운영비", "수용비", "여비", "임차료", "업무추진비", "사업추진비", "공공요금", "포상금")),
)


def flow_channel(mok: Column | str, semok: Column | str) -> Column:
    """The flow map's channel of an item, from both names without spaces."""
    x = F.replace(F.concat_ws(" ", col(mok), col(semok)), F.lit(" "), F.lit(""))
    return first_rule([(reduce(Column.__and__, [any_of(x, words) for words in groups]), code) for code, *groups in FLOW_WORDS], "other")


def flow_order(code: Column | str) -> Column:
    return first_value(code, {c: n for c, _, n in FLOW_CHANNELS})


def first_value(c: Column | str, values: dict) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), col(c))


def local_level(code: Column | str) -> Column:
    """Wide-area if the third to fifth digits of a code of five or more are zeros; the last three don't tell."""
    digits = F.regexp_replace(F.coalesce(col(code).cast("string"), F.lit("")), r"\D", "")
    return F.when(F.length(digits) < 5, "unknown").when(F.substring(digits, 3, 3) == "000", "광역본청").otherwise("기초")


def is_local_transfer(mok: Column | str, semok: Column | str) -> Column:
    mok, semok = (F.coalesce(col(c), F.lit("")) for c in (mok, semok))
    return F.concat(mok, F.lit(" "), semok).contains("자치단체이전") | semok.contains("자치단체")


def candidate_tier(title: Column | str) -> Column:
    """strong, broad or verify, of a title key."""
    x = col(title)
    return F.when(x.contains("혁신모델"), "strong").when(any_of(x, ("생태계활성화", "활력제고")) | (x.contains("사회연대경제활성화") & ~x.contains("청년일경험")), "broad").otherwise("verify")


def aligned_tier(title: Column | str, alignment: Column | str) -> Column:
    """As candidate_tier, but what is only a query's result is to be verified."""
    return F.when(col(alignment) == "query_result", "verify").otherwise(candidate_tier(title))


TIERS = ("strong", "broad", "verify")


def alignment(title: Column | str, keyword: Column | str, titles: Column | str) -> Column:
    """How a local title (a name key) relates to the compared titles (name keys) and the keyword."""
    t, k, others = col(title), col(keyword), col(titles)
    overlap = F.exists(others, lambda o: (F.least(F.length(t), F.length(o)) >= 5) & (o.contains(t) | t.contains(o)))
    return F.when((t != "") & F.array_contains(others, t), "exact_title").when((t != "") & overlap, "title_overlap").when((k != "") & t.contains(k), "keyword_contained").otherwise("query_result")


#: Patterns of what comes late, and what comes early, in a procedure.
REVIEW_STEP = "점검|성과|평가|정산|결산|완료|최종|보고서|결과|환류|지적|시정"
PREPARE_STEP = "신청|수요조사|계획|공고|접수|검토|심사|선정|협의|협약|계약|입찰|배정|교부"


def phase(step: Column | str) -> Column:
    return F.when(col(step).rlike(REVIEW_STEP), "G6").when(col(step).rlike(PREPARE_STEP), "G3").otherwise("G4")


def step_actor(step: str, ministry: str, implementer: str, beneficiary: str) -> Column:
    """struct(actor, assertion): whom a step's words name; else who implements, or the ministry, as derived."""
    squeeze = lambda c: F.regexp_replace(F.coalesce(col(c), F.lit("")), r"\s+", "")
    s, m, i, b = (squeeze(c) for c in (step, ministry, implementer, beneficiary))
    made = lambda who, how: F.struct(F.lit(who).alias("actor"), how.alias("assertion"))
    documented, derived = F.lit("documented"), F.lit("derived")
    return (
        F.when((b != "") & s.rlike("수혜|국민|주민|대상자|신청자"), made("beneficiary", F.when(s.contains(b), documented).otherwise(derived)))
        .when((i != "") & s.contains(i), made("implementer", documented))
        .when(((m != "") & s.contains(m)) | s.rlike("부처|행안부|국토부|행정안전부|국토교통부"), made("ministry", documented))
        .when(i != "", made("implementer", derived))
        .otherwise(made("ministry", derived))
    )


def code_type(code: Column | str) -> Column:
    return F.when(col(code).rlike("[~～,]"), "aggregate").otherwise("detail")


def coverage(n_steps: Column | str, n_sections: Column | str, n_cards: Column | str) -> Column:
    return F.when(col(n_steps) > 0, "documented_flow").when((col(n_sections) > 0) | (col(n_cards) > 0), "structured_facts").otherwise("api_only")


def warnings(**checks: Column) -> Column:
    """The names of what holds, in order."""
    return F.array_compact(F.array(*[F.when(holds, F.lit(name)) for name, holds in checks.items()]))


def inferred_year(*stated: Column, file_name: Column, default: int) -> Column:
    return F.coalesce(*[s.try_cast("int") for s in stated], F.nullif(F.regexp_extract(file_name, r"(20\d{2})", 1), F.lit("")).try_cast("int"), F.lit(default))
