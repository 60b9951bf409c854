"""Steps of a procedure section, by rules over columns.

A section is decoded once for a row. Candidates come from phrases between arrows, else behind
circled numbers; then from HTML tables; then, if there is still no step beside another, from
tables of bars. A candidate loses what LEADING says, in order, and is a step if none of the
rules against it holds and it names an action.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wonweave.functions import text
from wonweave.functions.columns import col

#: Words that show an action.
ACTION = "신청|수요조사|조사|계획|공고|접수|검토|심사|선정|협의|협약|계약|입찰|배정|교부|지급|집행|시행|수행|추진|운영|구축|설계|발주|착공|준공|승인|확정|납부|회수|교육|연수|개발|관리|유지|작성|제출|결재|처리|점검|보고|평가|정산|완료|통보|등록|발간"
#: Arrows between steps, and numbers before steps.
ARROW = "→|⇒|➜|⇢|⇨|⟶|▶|=>|->"
CIRCLED = "①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮⑯⑰⑱⑲⑳"
#: What a phrase loses at its begin, in this order.
LEADING = (r"^#{1,6}\s*", rf"^(?:\(?\d{{1,2}}\)?|[{CIRCLED}])\s*[.)]?\s*", r"^(?:사업\s*집행\s*절차|추진\s*절차)\s*[:：-]?\s*")
#: Characters that a phrase and a line lose at both ends.
PHRASE_ENDS, LINE_ENDS = r" \-·□○ㅇ:;|>", r" \-·□○ㅇ"
#: Shapes of whole phrases that are no step.
NO_STEP_SHAPES = (r"해당\s*(?:사항)?\s*없음", r"\([^)]*(?:협의|중심)\)", r"[\d,().백만원원%\s]+")
#: Phrases that are no step, without all but letters and digits.
NO_STEP = (
    "추진절차", "시행주체", "절차내용", "추진절차시행주체절차내용", "부처", "피출연피보조기관", "간접보조사업자", "사업수행자", "수행기관", "주관연구개발기관", "전담기관",
    "중기재정계획", "각종평가", "대외공개평가해당없음", "자체평가해당없음",
)
#: What marks a table of steps, and a row of its headers.
STEP_TABLE = r"추진\s*계획|세부\s*일정|추진\s*절차|절차\s*내용|시행\s*주체"
HEADER_ROW = r"추진\s*계획|절차\s*내용|세부\s*일정"
#: Tables, rows and cells of markup, what parts steps in a cell, and lines of bars.
TABLE, ROW, TABLE_CELL = "(?is)<table[^>]*>(.*?)</table>", "(?is)<tr[^>]*>(.*?)</tr>", "(?is)<t[dh][^>]*>(.*?)</t[dh]>"
PARTED = r"\n|\s*[•❍]\s*|\s+-\s+(?=[가-힣A-Za-z])"
BAR_LINES, BAR_RULE = r"(?m)(?:^[^\n]*\|[^\n]*(?:\n|\z))+", r"^[| :\-]*$"
#: Bounds of a phrase, of a cell, of a section, of the cells that a row gives and of the steps that a section gives.
SHORTEST, LONGEST, CELL, SECTION, CELLS, MOST = 2, 220, 900, 4200, 2, 24

# stand for < and > that were character references, until markup is gone
_LESS, _MORE = "", ""


def _split(c: Column, pattern: str) -> Column:
    return F.split(c, f"(?U){pattern}")


def _ends(c: Column, characters: str) -> Column:
    return F.regexp_replace(c, f"^[{characters}]+|[{characters}]+$", "")


def _each(c: Column, of) -> Column:
    """What `of` gives for each element, in one array."""
    return F.flatten(F.transform(c, of))


def decoded(c: Column | str) -> Column:
    """Character references decoded; those of < and > can't be taken for markup."""
    x = F.coalesce(col(c).cast("string"), F.lit(""))
    return text.unescape_html(F.regexp_replace(F.regexp_replace(x, r"(?i)&(?:lt|#60|#x3c);", _LESS), r"(?i)&(?:gt|#62|#x3e);", _MORE))


def lines(c: Column) -> Column:
    """Lines of decoded markup: cells end with a tab, rows and blocks with a line; rules and empty lines go."""
    x = F.regexp_replace(F.regexp_replace(c, r"(?i)<br\s*/?>", "\n"), "(?i)</(?:td|th)>", "\t")
    x = F.regexp_replace(F.regexp_replace(x, r"(?i)</(?:tr|table|p|div|li|h[1-6])>", "\n"), "<[^>]+>", " ")
    x = F.replace(F.translate(x, _LESS + _MORE, "<>"), F.lit("\\~"), F.lit("~"))
    cleaned = lambda s: F.trim(F.regexp_replace(_ends(F.regexp_replace(s, "[ \\t]+", " "), r" |\t"), r"!\[image\]\([^)]*\)", ""))
    return F.filter(F.transform(_split(x, r"\r\n|[\n\r]"), cleaned), lambda s: (s != "") & ~s.rlike(r"^[-:| ]+$"))


def _excerpt(c: Column, limit: int) -> Column:
    each = F.transform(lines(c), lambda s: _ends(F.regexp_replace(s, r"^#{1,6}\s*", ""), LINE_ENDS))
    return F.rtrim(F.left(F.array_join(F.array_distinct(F.filter(each, lambda s: s != "")), "\n"), F.lit(limit)))


def _phrase(c: Column) -> Column:
    x = F.array_join(lines(c), "\n")
    for pattern in LEADING:
        x = F.regexp_replace(x, f"(?U){pattern}", "")
    return _ends(F.regexp_replace(x, r"(?U)\s+", " "), PHRASE_ENDS)


def _is_step(x: Column) -> Column:
    against = [~F.length(x).between(SHORTEST, LONGEST), *(x.rlike(f"(?U)^(?:{shape})$") for shape in NO_STEP_SHAPES), F.regexp_replace(x, "[^0-9A-Za-z가-힣]", "").isin(*NO_STEP)]
    out = x.rlike(ACTION)
    for holds in against:
        out = out & ~holds
    return out


def _steps(phrases: Column) -> Column:
    return F.array_distinct(F.filter(F.transform(phrases, _phrase), _is_step))


def _no_header(cells: Column) -> Column:
    return ~F.exists(cells, lambda x: x.rlike(f"(?U){HEADER_ROW}"))


def _html_phrases(raw: Column) -> Column:
    """Of the rows of marked tables, but for headers: what the first cells with an action list."""
    tables = F.filter(F.regexp_extract_all(raw, F.lit(TABLE), F.lit(1)), lambda t: F.array_join(lines(t), "\n").rlike(f"(?U){STEP_TABLE}"))
    rows = _each(tables, lambda t: F.regexp_extract_all(t, F.lit(ROW), F.lit(1)))
    cells = F.transform(rows, lambda r: F.filter(F.transform(F.regexp_extract_all(r, F.lit(TABLE_CELL), F.lit(1)), lambda x: _excerpt(x, CELL)), lambda x: x != ""))
    told = _each(F.filter(cells, _no_header), lambda x: F.slice(F.filter(x, lambda y: y.rlike(ACTION)), 1, CELLS))
    return _each(told, lambda x: _split(x, PARTED))


def _bar_phrases(raw: Column) -> Column:
    """Of the rows of marked tables of bars, but for headers: every cell with an action."""
    groups = F.filter(F.regexp_extract_all(raw, F.lit(BAR_LINES), F.lit(0)), lambda g: F.replace(g, F.lit("\n"), F.lit(" ")).rlike(f"(?U){STEP_TABLE}"))
    rows = F.filter(_each(groups, lambda g: _split(g, "\n")), lambda s: ~F.trim(s).rlike(BAR_RULE))
    cells = F.transform(rows, lambda s: F.transform(F.split(_ends(F.trim(s), "|"), r"\|"), lambda x: F.trim(F.regexp_replace(x, r"(?U)\s+", " "))))
    return F.filter(F.flatten(F.filter(cells, _no_header)), lambda x: x.rlike(ACTION))


def _let(value: Column, body) -> Column:
    """body(value), with value computed once for a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def procedure_steps(c: Column | str) -> Column:
    """Steps of a section's markup, each once, in order; none if there is but one."""
    none = F.array().cast("array<string>")
    more = lambda found, phrases: F.array_distinct(F.concat(found, _steps(phrases)))

    def of_text(x: Column) -> Column:
        arrows = F.when(x.rlike(ARROW), _steps(_split(F.regexp_replace(x, r"(?U)\s*\n\s*", " "), rf"\s*(?:{ARROW})\s*"))).otherwise(none)
        numbered = _split(x, rf"(?:^|\s)[{CIRCLED}]\s*")
        return _let(arrows, lambda a: F.when((F.size(a) < 2) & (F.size(numbered) >= 3), more(a, F.slice(numbered, F.lit(2), F.size(numbered)))).otherwise(a))

    def of_raw(raw: Column) -> Column:
        tables = _let(_let(_excerpt(raw, SECTION), of_text), lambda a: more(a, _html_phrases(raw)))
        found = _let(tables, lambda a: F.when(F.size(a) < 2, more(a, _bar_phrases(raw))).otherwise(a))
        return _let(found, lambda a: F.when(F.size(a) >= 2, F.slice(a, 1, MOST)).otherwise(none))

    return _let(decoded(c), of_raw)
