"""Business blocks and sections in ordered chunks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wonweave.functions import extract
from wonweave.functions import text as text_functions
from wonweave.functions.columns import col

@dataclass(frozen=True)
class Section:
    """A section begins at the first row that `preferred` fits, else at the first that `start` fits, and ends before the next that one of `stops` fits; its text is cut at `limit`."""

    name: str
    label: str
    start: str
    stops: tuple[str, ...]
    limit: int
    preferred: str | None = None


#: Fixed values.
SPECS = (
    Section("purpose", "사업 목적·내용", r"(?:^|\s)(?:1\)\s*)?사업\s*목적[·ㆍ\s]*내용|사업\s*목적", (r"(?:^|\s)2\)\s*사업\s*개요", r"사업\s*근거\s*및\s*추진경위"), 1500),
    Section("legal_history", "법적 근거·추진 경위", r"사업\s*근거\s*및\s*추진경위|법령상\s*근거", (r"주요\s*내용", r"(?:^|\s)3\)\s*20?26.*산출\s*근거"), 2400),
    Section("implementation", "시행 구조·수혜자", r"사업\s*추진\s*체계|사업시행방법|사업\s*시행\s*방법", (r"(?:^|\s)3\)\s*20?26.*산출\s*근거", r"(?:^|\s)4\)\s*사업\s*효과"), 1800),
    Section("budget_basis", "예산 산출근거", r"(?:3\)\s*)?20?26년도\s*예산\s*산출\s*근거|산출\s*세부내역\s*비교", (r"(?:^|\s)4\)\s*사업\s*효과", r"사업\s*효과"), 2200),
    Section("effects", "사업 효과·성과지표", r"(?:4\)\s*)?사업\s*효과|성과\s*지표", (r"(?:^|\s)5\)\s*타당성", r"총사업비\s*대상사업", r"사업\s*집행\s*절차"), 2400),
    Section(
        "procedure", "사업 집행절차", r"(?:7\)\s*)?사업\s*집행\s*절차|추진\s*절차|지원\s*절차|처리\s*절차",
        (r"(?:^|\s)8\)\s*중기재정", r"(?:^|\s)8\)\s*각종\s*평가", r"(?:^|\s)9\)\s*최근", r"각종\s*평가", r"최근\s*\d+년간.*외부지적", r"##\s*다\."), 4200, r"사업\s*집행\s*절차",
    ),
    Section("review", "외부 지적·평가·결산", r"최근\s*\d+년간.*(?:외부지적|평가)|주요\s*외부지적사항|최근\s*\d+년간\s*결산", (r"부처\s*건의사항", r"##\s*다\.", r"###\s*사\s*업"), 2200),
)
#: A section that says that there is none, in the first so many characters.
NONE_SAID, NONE_WITHIN = {"procedure": r"사업\s*집행\s*절차\s*[:：]?\s*해당\s*(?:사항)?\s*없음"}, 180
#: Rows of a document that are looked up together in range joins.
BIN = 64


def fits(c: Column | str, pattern: str) -> Column:
    """Whether a pattern is found, whatever the case; white space and digits are those of Unicode."""
    return col(c).rlike(f"(?iuU)(?:{pattern})")


def anchors(chunks: DataFrame, doc: str = "source_pdf", seq: str = "chunk_idx") -> DataFrame:
    """Heading chunks that are business headings, or begin a pair of headings on one page that is one only together.

    A chunk that a pair has used begins nothing, so of pairs in a row every other one counts.
    Its marks of a heading don't matter in a pair: it has one of its own.
    """
    w = Window.partitionBy(doc).orderBy(seq)
    nxt = {c: F.lead(c).over(w) for c in ("text", "type", "page")}
    bare = lambda c: F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"^\s*#{1,6}\s*", ""))
    is_heading = F.coalesce(F.col("type") == "heading", F.lit(False))
    single = F.when(is_heading, extract.heading("text"))
    together = F.when(is_heading & (nxt["type"] == "heading") & nxt["page"].eqNullSafe(F.col("page")), extract.heading(F.concat(F.lit("### "), bare(F.col("text")), F.lit(" "), bare(nxt["text"]))))
    found = chunks.withColumn("one", single).withColumn("two", F.when(F.col("one").isNull(), together))
    # in a run of chunks that could each begin a pair, the first, third ... do; one that is a heading alone ends a run only if it isn't used
    can = F.col("two").isNotNull()
    run = F.sum((~can).cast("int")).over(w)
    place = F.row_number().over(Window.partitionBy(doc, "__run").orderBy(seq)) - F.when(F.col("__first_can"), 0).otherwise(1)
    found = found.withColumn("__run", run).withColumn("__first_can", F.first(can).over(Window.partitionBy(doc, "__run").orderBy(seq)))
    found = found.withColumn("__begins", can & (place % 2 == 1)).drop("__run", "__first_can")
    used = F.coalesce(F.lag("__begins").over(w), F.lit(False))
    found = found.withColumn("__used", used).withColumn("heading", F.when(~F.col("__used"), F.coalesce("one", F.when(F.col("__begins"), F.col("two")))))
    return found.filter(F.col("heading").isNotNull()).withColumn("width", F.when(F.col("one").isNotNull(), 1).otherwise(2)).drop("one", "two", "__begins", "__used")


def blocks(anchored: DataFrame, ends: DataFrame, doc: str = "source_pdf", seq: str = "chunk_idx") -> DataFrame:
    """From each anchor to before the next of its document, or its end (`ends`: doc, last)."""
    w = Window.partitionBy(doc).orderBy(seq)
    return anchored.withColumn("__next", F.lead(seq).over(w)).join(ends, doc).withColumn("block_start", F.col(seq)).withColumn("block_end", F.coalesce(F.col("__next") - 1, F.col("last"))).drop("__next", "last")


def chunks_in(spans: DataFrame, chunks: DataFrame, doc: str = "source_pdf", seq: str = "chunk_idx", width: int = BIN) -> DataFrame:
    """Chunks of each span (doc, block_start, block_end): an equi-join on the document and on bins of `width` places, so that a long document is many keys; the exact range holds as well.

    A chunk is in one bin, so none comes twice. Spans are first cut to the places that their document has. A span that
    ends before it begins has none.
    """
    place = lambda c: F.floor(F.col(c) / width).cast("long")
    reach = chunks.groupBy(F.col(doc).alias("__doc")).agg(F.min(seq).alias("__from"), F.max(seq).alias("__to"))
    within = spans.join(reach, spans[doc] == F.col("__doc")).withColumn("__first", F.greatest("block_start", "__from")).withColumn("__last", F.least("block_end", "__to")).filter("__first <= __last")
    s = within.withColumn("__bin", F.explode(F.sequence(place("__first"), place("__last")))).alias("s")
    c = chunks.withColumn("__bin", place(seq)).alias("c")
    both = (F.col(f"s.{doc}") == F.col(f"c.{doc}")) & (F.col("s.__bin") == F.col("c.__bin")) & F.col(f"c.{seq}").between(F.col("s.block_start"), F.col("s.block_end"))
    return s.join(c, both).select(*[F.col(f"s.{x}") for x in spans.columns], *[F.col(f"c.{x}").alias(f"chunk_{x}") for x in chunks.columns if x != doc])


def spans(rows: DataFrame, key: Sequence[str], seq: str, text: str, specs: Sequence[Section] = SPECS) -> DataFrame:
    """key, section, start, end (exclusive; null if it doesn't stop) of each section found.

    It starts at the first row that its preferred pattern fits, else at the first that its start fits. The
    patterns are matched where the text is; only rows at which a section begins or ends are moved.
    """
    any_of = lambda patterns: reduce(Column.__or__, [fits(text, p) for p in patterns]) if patterns else F.lit(False)
    mark = lambda x: F.struct(F.lit(x.name).alias("section"), any_of([x.preferred] if x.preferred else []).alias("first"), fits(text, x.start).alias("begins"), any_of(x.stops).alias("stops"))
    each = rows.select(*key, seq, F.explode(F.filter(F.array(*map(mark, specs)), lambda m: m["first"] | m["begins"] | m["stops"])).alias("m")).select(*key, seq, "m.*")
    least = lambda c: F.min(F.when(F.col(c), F.col(seq))).over(Window.partitionBy(*key, "section"))
    marked = each.withColumn("start", F.coalesce(least("first"), least("begins"))).filter(F.col("start").isNotNull())
    return marked.groupBy(*key, "section", "start").agg(F.min(F.when((F.col(seq) > F.col("start")) & F.col("stops"), F.col(seq))).alias("end"))


def extracted(chunks: DataFrame, key: Sequence[str], seq: str, raw: str, specs: Sequence[Section] = SPECS, none_said: dict[str, str] = NONE_SAID) -> DataFrame:
    """key, section, label, text, start, last (the section's first and last place) of each section that says something.

    Markup goes before patterns are matched. A section's text is its lines without marks, each once, up to the
    section's limit: lines that are found again go before they meet, and none moves on past the limit, so a
    section of any length is a few lines in the end.
    """
    plain = text_functions.markup_to_lines(raw, True)
    rows = chunks.select(*key, seq, plain.alias("__plain"))
    found = spans(rows, key, seq, "__plain", specs)
    limits = F.create_map(*[F.lit(v) for x in specs for v in (x.name, x.limit)])
    labels = F.create_map(*[F.lit(v) for x in specs for v in (x.name, x.label)])
    joined = F.concat_ws("\x1f", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key])
    ranged = found.select(*key, "section", F.col("start"), joined.alias("__key"), F.col("start").alias("block_start"), F.coalesce(F.col("end") - 1, F.lit(2**62)).alias("block_end"))
    inside = chunks_in(ranged, rows.select(joined.alias("__key"), seq, "__plain"), "__key", seq).drop("__key")
    place, body = f"chunk_{seq}", "chunk___plain"
    last = inside.groupBy(*key, "section").agg(F.max(place).alias("last"))
    said = inside.select(*key, "section", "start", F.col(place).alias("__place"), F.posexplode(F.transform(F.split(body, "\n"), text_functions.unmarked)).alias("__line", "line")).filter("line <> ''")
    once = said.groupBy(*key, "section", "start", "line").agg(F.min(F.struct("__place", "__line")).alias("at"))
    before = F.sum(F.length("line") + 1).over(Window.partitionBy(*key, "section").orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
    kept = once.withColumn("__before", F.coalesce(before, F.lit(0))).filter(F.col("__before") < F.element_at(limits, F.col("section")))
    texts = kept.groupBy(*key, "section", "start").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]), "\n").alias("text"))
    texts = texts.withColumn("text", F.rtrim(F.left(F.col("text"), F.element_at(limits, F.col("section")))))
    none = reduce(Column.__or__, [(F.col("section") == name) & fits(F.left(F.col("text"), F.lit(NONE_WITHIN)), p) for name, p in none_said.items()], F.lit(False))
    return texts.filter(extract.usable("text") & ~none).join(last, [*key, "section"]).select(*key, "section", F.element_at(labels, F.col("section")).alias("label"), "text", "start", "last")


def lines(df: DataFrame, key: Sequence[str], text: str) -> DataFrame:
    """key, line_idx, line of each line of a text."""
    return df.select(*key, F.posexplode(F.split(F.coalesce(col(text), F.lit("")), "\n")).alias("line_idx", "line"))


def by_section(rows: DataFrame, key: Sequence[str], seq: str, last: bool = False) -> DataFrame:
    """One row of each section of a key: the first, or the last."""
    pick = F.max_by if last else F.min_by
    rest = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(pick(F.struct(*rest), F.col(seq)).alias("r")).select(*key, "r.*")
