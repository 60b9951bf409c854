"""The offline rebuild: lines, cards and local candidates to canonical records, tree, workflow, flow maps and checks.

Every step takes and returns frames. `run` returns them all; `publish` writes them if the
checks find nothing. Keys have six parts (year first), also where one year is all there is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wonweave.functions import columns, extract, scoring, steps, text
from wonweave.operators import attach, channels, classify, dedupe, flow, graph, hierarchy, keywords, match, quality, sections, summaries
from wonweave.operators import workflow as work
from wonweave.sources import sinks

NAMES = ("office_name", "account_name", "program_name", "unit_business_name", "detail_business_name")
KEY = ("year", *NAMES)


def with_key(df: DataFrame) -> DataFrame:
    key = columns.key(*KEY)
    return df.withColumn("canonical_key", key).withColumn("business_id", columns.stable_id("kb", key))


def details(lines: DataFrame) -> DataFrame:
    return with_key(hierarchy.details(lines, KEY, "congress_amt", "row_idx", ["field_name", "section_name"]).withColumn("congress_amt", F.col("congress_amt").cast(columns.WON)))


def linked(cards: DataFrame, detail: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(best match, top three) of each card (card, ministry, title, code, implementer)."""
    block = lambda c: text.name_key(c)
    c = cards.select("card", block("ministry").alias("block"), F.coalesce(F.col("code").rlike("[~,]"), F.lit(False)).alias("aggregate"), *scoring.features("c", "title"), *scoring.features("i", F.coalesce("implementer", F.lit("")))).drop("i_bigrams")
    d = detail.select(block("office_name").alias("block"), F.col("business_id").alias("detail"), *scoring.features("d", "detail_business_name"))
    pairs = sinks.staged(match.candidates(c, d, boost=True), "pairs")
    return match.best(c, pairs), match.top3(pairs)


def references(cards: DataFrame, matches: DataFrame) -> DataFrame:
    """business_id and the provenance of each matched card; the first of each place in a document."""
    ref = F.struct(F.lit("document").alias("source"), "source_pdf", "page_start", "page_end", "anchor_chunk_id", "title")
    rows = cards.join(matches.filter("status = 'matched'").select("card", F.col("detail").alias("business_id")), "card")
    return dedupe.first_by(rows, ["business_id", "source_pdf", "page_start", "code", "title"], ["card"]).select("business_id", "card", ref.alias("ref"))


def attached(detail: DataFrame, mix: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates of businesses with a local channel: by key; for those without any, unkeyed ones by name."""
    fit = attach.eligible(detail, mix, ["business_id"])
    b = fit.select(F.col("canonical_key").alias("k"), "business_id", text.name_key("detail_business_name").alias("name")).withColumn("corpus", F.col("name"))
    rows = candidates.select(F.when(columns.is_key("central_key"), columns.trimmed_key("central_key")).alias("k"), text.name_key("keyword").alias("word"), text.name_key("detail_business_name").alias("row_name"), F.struct(*[c for c in candidates.columns if c != "central_key"]).alias("row"))
    pairs = attach.exact_then_fallback(b, rows, "k", "name", "corpus", "word", "row_name")
    return pairs.select(F.col("b_business_id").alias("business_id"), "how", "r_row.*").withColumn("additive", F.lit(False))


def canonical(detail: DataFrame, mix: DataFrame, refs: DataFrame, local: DataFrame) -> DataFrame:
    """A record for each detail business, with arrays of its channels and references and a count of its local candidates."""
    lists = channels.as_array(mix, ["business_id"], ["channel", "amount", "line_count", "share"])
    docs = refs.groupBy("business_id").agg(F.sort_array(F.collect_list("ref")).alias("references"))
    n = local.groupBy("business_id").agg(F.count("*").alias("local_rows"), F.sum("national_amt").alias("local_national"))
    out = detail.join(lists, "business_id", "left").join(docs, "business_id", "left").join(n, "business_id", "left")
    return out.withColumn("local_rows", F.coalesce("local_rows", F.lit(0))).withColumn("n_references", F.coalesce(F.size("references"), F.lit(0)))


def breakdown(lines: DataFrame, detail: DataFrame) -> DataFrame:
    """business_id, mok_name, semok_name, amount, line_count, share of the business's amount: all items, whatever their sign."""
    named = with_key(lines).select("business_id", F.coalesce("mok_name", F.lit("(목 미상)")).alias("mok_name"), F.coalesce("semok_name", F.lit("(세목 미상)")).alias("semok_name"), "congress_amt")
    sums = named.groupBy("business_id", "mok_name", "semok_name").agg(F.sum("congress_amt").cast(columns.WON).alias("amount"), F.count("*").alias("line_count"))
    return sums.join(detail.select("business_id", F.col("congress_amt").alias("__all")), "business_id").withColumn("share", columns.share("amount", "__all", 8)).drop("__all")


#: Columns of local candidates that nodes may name; those that aren't there are null.
LOCAL_FIELDS = ("local_gov_name", "local_gov_code", "local_level", "exe_ymd", "detail_business_code", "detail_business_name")


def workflow_facts(lines: DataFrame, detail: DataFrame, refs: DataFrame, cards: DataFrame, procedures: DataFrame, local: DataFrame) -> dict[str, DataFrame]:
    """What the rules of operators/workflow.py read: business, items, cards, sections, people, steps, local."""
    business = detail.select("business_id", "year", "office_name", "congress_amt")
    held = refs.select("business_id", "card").join(cards.select("card", "implementer", "source_pdf", "page_start", "page_end", F.col("anchor_chunk_id").alias("chunk_start"), F.lit(None).cast("string").alias("chunk_end")), "card")
    said = held.drop("implementer").join(sections.by_section(procedures, ["card", "section"], "seq").select("card", "section", "text"), "card")
    said = sinks.staged(said.withColumn("evidence_id", columns.stable_id("ev", columns.key("source_pdf", "chunk_start", "section"), 14)), "sections")
    who = sinks.staged(work.people(business, said, held), "people")
    for c in LOCAL_FIELDS:
        local = local if c in local.columns else local.withColumn(c, F.lit(None).cast("string"))
    with_who = said.join(who.select("business_id", "implementer"), "business_id", "left")
    return {"business": business, "items": breakdown(lines, detail), "cards": held, "sections": with_who, "people": who, "steps": work.steps_of(said, who, steps.procedure_steps("text")), "local": local}


def flow_items(lines: DataFrame) -> DataFrame:
    """Positive items of each business with their flow channel."""
    rows = with_key(lines).withColumn("amount", F.col("congress_amt")).groupBy("business_id", "mok_name", "semok_name").agg(F.sum("amount").cast(columns.WON).alias("amount"), F.count("*").alias("line_count"), F.min("row_idx").alias("row_idx"))
    return flow.items(rows, "business_id", "amount", ["row_idx"]).withColumn("code", classify.flow_channel("mok_name", "semok_name"))


def flow_maps(detail: DataFrame, items: DataFrame, subs: DataFrame) -> DataFrame:
    """Totals, sums of items and subprojects, their differences, and warnings, of each business."""
    base = detail.select("business_id", F.col("congress_amt").alias("total"))
    out = flow.reconciled(base, {"items": items.select("business_id", "amount"), "subprojects": subs.select("business_id", "amount")}, "business_id", "total")
    return out.withColumn("warnings", classify.warnings(no_positive_items=F.col("items_total").isNull(), items_differ=F.coalesce(F.col("items_difference") != 0, F.lit(False)), subprojects_differ=F.coalesce(F.col("subprojects_difference") != 0, F.lit(False))))


def page_coverage(chunks: DataFrame) -> DataFrame:
    """First and last page and number of pages with chunks of each document."""
    return chunks.groupBy("source_pdf").agg(F.min("page").alias("first_page"), F.max("page").alias("last_page"), F.countDistinct("page").alias("pages"))


def unresolved(matches: DataFrame) -> DataFrame:
    return matches.filter(F.col("status") != "matched")


def summary(record: DataFrame, matches: DataFrame, local: DataFrame) -> DataFrame:
    """One row of headline counts and sums."""
    r = record.agg(F.count("*").alias("businesses"), F.countDistinct("office_name").alias("offices"), F.sum("congress_amt").alias("total_won"), F.count_if(F.col("n_references") > 0).alias("with_documents"), F.count_if(F.col("local_rows") > 0).alias("with_local"))
    return r.crossJoin(match.summary(matches)).crossJoin(local.agg(F.count("*").alias("local_rows")))  # one row each


def checks(lines: DataFrame, record: DataFrame, mix: DataFrame, items: DataFrame, tree: DataFrame, matches: DataFrame, nodes: DataFrame, edges: DataFrame, local: DataFrame) -> DataFrame:
    """All violations: (check_id, key, message)."""
    keyed = with_key(lines).select("business_id", "congress_amt")
    recomputed: Column = columns.stable_id("kb", F.col("canonical_key"))
    return quality.union([
        quality.not_unique(record, "unique_business", ["business_id"]), quality.violations(record, "id", recomputed != F.col("business_id"), F.col("business_id"), "id differs"), quality.violations(record, "key", ~columns.is_key("canonical_key"), F.col("business_id"), "blank part"),
        quality.sums_differ(keyed, record, "line_sums", "business_id", "congress_amt", "congress_amt"), quality.sums_differ(mix, record, "channel_sums", "business_id", "amount", "congress_amt"), quality.sums_differ(items, record.filter("congress_amt > 0"), "item_sums", "business_id", "amount", "congress_amt"),
        quality.tree_sums(tree, "tree_sums"), quality.match_rules(matches), quality.one_channel(items), quality.missing(edges, nodes, "edge_source", "src", "id"), quality.missing(edges, nodes, "edge_target", "dst", "id"), quality.not_unique(nodes, "unique_node", ["id"]),
        quality.outside(edges, "edge_type", "type", graph.EDGE_TYPES, "id"), quality.outside(nodes, "phase", "phase", graph.PHASES, "id"), quality.violations(local, "positive", F.col("national_amt") <= 0, F.col("business_id"), "not positive"), quality.missing(local, record, "local_owner", "business_id", "business_id"),
    ])


def run(lines: DataFrame, cards: DataFrame, candidates: DataFrame, procedures: DataFrame) -> dict[str, DataFrame]:
    """All tables. `cards`: card, ministry, title, code, implementer, source_pdf, page_start, page_end, anchor_chunk_id; `candidates`: as keywords.local_rows, with central_key; `procedures`: card, section, text."""
    detail = sinks.staged(details(lines), "details")
    keyed = with_key(lines)
    mix = sinks.staged(channels.mix(keyed, ["business_id"], {"channel": classify.channel("mok_name", "semok_name")}, "congress_amt"), "mix")
    matches, top3 = linked(cards, detail)
    matches = sinks.staged(matches, "matches")
    refs = sinks.staged(references(cards, matches), "references")
    local = sinks.staged(attached(detail, mix, candidates), "local")
    record = sinks.staged(canonical(detail, mix, refs, local), "canonical")
    tree = sinks.staged(hierarchy.rollup_tree(detail, NAMES, "congress_amt"), "tree")
    items = sinks.staged(flow_items(lines), "items")
    facts = workflow_facts(lines, detail, refs, cards, procedures, local)
    owned = facts["sections"]
    nodes = sinks.staged(work.nodes(facts), "nodes")
    edges, actors = sinks.staged(work.edges(nodes), "edges"), sinks.staged(work.actors(facts["people"], facts["business"], local), "actors")
    covered = sinks.staged(work.coverage(facts["business"], nodes, facts["cards"]), "coverage")
    subs = owned.filter("section = 'budget_basis'").select("business_id", F.explode(extract.subprojects("text")).alias("s")).select("business_id", "s.id", "s.label", F.col("s.amount_won").cast(columns.WON).alias("amount"), "s.detail")
    subs = sinks.staged(subs, "subprojects")
    return {
        "details": detail, "channels": mix, "matches": matches, "top3": top3, "unresolved": unresolved(matches), "canonical": record, "tree": tree, "local": local, "nodes": nodes, "edges": edges, "actors": actors, "coverage": covered, "items": items, "subprojects": subs, "flow": flow_maps(detail, items, subs), "flow_totals": channels.totals(items, "code", "amount"),
        "plan": keywords.plan(keywords.select(keyed, detail, ["business_id"], "congress_amt", classify.is_local_transfer("mok_name", "semok_name")).join(detail.select("business_id", "detail_business_name"), "business_id"), "detail_business_name"),
        "summary": summary(record, matches, local), "headlines": summaries.record_headlines(record, mix), "card_headlines": summaries.card_headlines(cards, matches), "violations": checks(lines, record, mix, items, tree, matches, nodes, edges, local).unionByName(work.broken(nodes, edges, actors)),
    }


def publish(tables: dict[str, DataFrame], path: str) -> str:
    return sinks.publish({k: v for k, v in tables.items() if k != "violations"}, tables["violations"], path)
