"""Graphs, spans, searches and checks, on conversations and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wonweave.functions import columns
from wonweave.operators import dedupe, flow, graph, hierarchy, quality, search, sections
from wonweave.plans.budget import FLOW, lines, with_channels
from wonweave.plans.registry import query, table


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").alias("business_id"), (F.col("conv_id") * 100 + F.col("turn")).alias("id"), F.col("turn").alias("seq"), F.col("role").alias("label"))


def turn_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.sequence(turns(spark, sf_dir))


EDGES = "SELECT conv_id * 100 + turn AS src, conv_id * 100 + lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS dst FROM conversations QUALIFY dst IS NOT NULL"


@query(f"WITH e AS ({EDGES}) SELECT src // 100 AS business_id, 'e-' || substr(sha256(src || chr(31) || dst || chr(31) || 'sequence'), 1, 14) AS id, CAST(src AS BIGINT) AS src, CAST(dst AS BIGINT) AS dst FROM e")
def step_edges(spark, sf_dir):
    return turn_edges(spark, sf_dir).select("business_id", "id", "src", "dst")


@query(f"WITH RECURSIVE e AS ({EDGES}), r(start, node, depth) AS (SELECT conv_id * 100, conv_id * 100, 0 FROM conversations WHERE turn = 0 UNION SELECT start, dst, depth + 1 FROM r JOIN e ON node = src) SELECT CAST(start AS BIGINT) AS start, CAST(node AS BIGINT) AS node, CAST(min(depth) AS INTEGER) AS depth FROM r GROUP BY 1, 2")
def graph_reachability(spark, sf_dir):
    starts = turns(spark, sf_dir).filter("seq = 0").select("id")
    return graph.reachable(turn_edges(spark, sf_dir), starts)


@query(f"WITH e AS ({EDGES}), c AS (SELECT conv_id * 100 + turn AS id FROM conversations WHERE turn = 1) SELECT CAST(id AS BIGINT) AS id, 'out' AS side, CAST(dst AS BIGINT) AS other FROM c JOIN e ON id = src UNION ALL SELECT id, 'in', src FROM c JOIN e ON id = dst")
def graph_neighbors(spark, sf_dir):
    return graph.neighbours(turn_edges(spark, sf_dir), turns(spark, sf_dir).filter("seq = 1").select("id"))


@query("""
WITH n AS (SELECT conv_id, turn, role FROM conversations), s AS (SELECT conv_id, min(turn) AS t FROM n WHERE role LIKE '%user%' GROUP BY 1), a AS (SELECT n.conv_id, min(n.turn) AS t FROM n JOIN s ON s.conv_id = n.conv_id AND n.turn > s.t WHERE role LIKE '%assistant%' GROUP BY 1)
SELECT n.conv_id * 100 + n.turn AS id FROM n JOIN a ON a.conv_id = n.conv_id AND n.turn > a.t WHERE role LIKE '%user%'""")
def path_terms(spark, sf_dir):
    return graph.path_terms(turn_edges(spark, sf_dir), turns(spark, sf_dir), ["user", "assistant", "user"])


@query(f"WITH RECURSIVE e AS ({EDGES}), c AS (SELECT conv_id * 100 + turn AS id FROM conversations WHERE turn = 2), d(s, n) AS (SELECT id, id FROM c UNION SELECT s, dst FROM d JOIN e ON n = src), u(s, n) AS (SELECT id, id FROM c UNION SELECT s, src FROM u JOIN e ON n = dst) SELECT CAST(s AS BIGINT) AS start, CAST(n AS BIGINT) AS node, 'down' AS side FROM d UNION ALL SELECT s, n, 'up' FROM u")
def graph_highlight(spark, sf_dir):
    return graph.closure_both(turn_edges(spark, sf_dir), turns(spark, sf_dir).filter("seq = 2").select("id")).select("start", "node", "side")


def flow_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_channels(spark, sf_dir).withColumn("business_id", F.col("l_suppkey"))
    one = rows.groupBy("business_id").agg(F.sum("amount").alias("amount"))
    by_part = rows.groupBy("business_id", F.col("p_type").alias("item_id"), "code").agg(F.sum("amount").alias("amount"))
    subs = rows.groupBy("business_id", F.col("channel").alias("id")).agg(F.sum("amount").alias("amount"))
    cross = by_part.select("business_id", F.lit("direct").alias("subproject_id"), "code", F.lit(1).cast("long").alias("amount")).distinct()
    return flow.money_edges(one, by_part, subs, cross)


@query(f"""
WITH r AS (SELECT l_suppkey AS b, CAST(round(l_extendedprice * 100) AS BIGINT) AS a, p_type, {FLOW} AS code FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT type, CAST(count(*) AS BIGINT) AS n, CAST(sum(a) AS BIGINT) AS amount FROM (SELECT 'source' AS type, sum(a) AS a FROM r GROUP BY b UNION ALL SELECT 'item', sum(a) FROM r GROUP BY b, p_type, code UNION ALL SELECT 'channel', sum(a) FROM r GROUP BY b, p_type, code UNION ALL SELECT 'destination', sum(a) FROM r GROUP BY b, code) GROUP BY 1""")
def flow_nodes_edges(spark, sf_dir):
    e = flow_graph(spark, sf_dir)
    return graph.visible(e, ["crosswalk", "subproject"]).groupBy("type").agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))


@query("SELECT DISTINCT CAST(l_orderkey AS BIGINT) AS missing FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 10 <> 0) UNION SELECT o_orderkey FROM orders WHERE o_orderkey % 10 = 0 AND o_orderkey IN (SELECT l_orderkey FROM lineitem)")
def edge_integrity(spark, sf_dir):
    e = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("src"), F.col("l_orderkey").alias("dst"))
    return graph.dangling(e, table(spark, sf_dir, "orders").filter("o_orderkey % 10 <> 0").select(F.col("o_orderkey").alias("id")))


@query("""
WITH n AS (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY CASE role WHEN 'system' THEN 'G0' WHEN 'user' THEN 'G2' ELSE 'G4' END, turn, 'p-' || substr(sha256(conv_id || chr(31) || role || chr(31) || role || chr(31) || turn), 1, 14)) AS i, turn FROM conversations)
SELECT CAST(conv_id AS VARCHAR) AS business_id, 'P' || lpad(CAST(i AS VARCHAR), 2, '0') AS display_id, role AS kind, CAST(turn AS INTEGER) AS seq FROM n""")
def workflow_nodes(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    phase = F.when(F.col("role") == "system", "G0").when(F.col("role") == "user", "G2").otherwise("G4")
    parts = [graph.nodes(c.filter(F.col("role") == r), "conv_id", r, phase, F.col("role"), seq=F.col("turn")) for r in ("system", "user", "assistant")]
    return graph.display_ids(quality.union(parts)).select("business_id", "display_id", "kind", "seq")


@query("SELECT CAST(o_custkey AS VARCHAR) AS business_id, o_orderpriority AS name, CASE WHEN max(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) = 1 THEN 'ministry' ELSE 'implementer' END AS role FROM orders GROUP BY 1, 2")
def workflow_actors(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return graph.actors(o, "o_custkey", {"ministry": F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")), "implementer": F.col("o_orderpriority")}).select("business_id", "name", "role")


@query("SELECT conv_id, turn, CAST(coalesce(lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) - 1, max(turn) OVER (PARTITION BY conv_id)) AS BIGINT) AS block_end FROM conversations WHERE role = 'user'".replace("max(turn) OVER (PARTITION BY conv_id)", "(SELECT max(turn) FROM conversations c WHERE c.conv_id = conversations.conv_id)"))
def block_boundaries(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    ends = c.groupBy("conv_id").agg(F.max("turn").alias("last"))
    return sections.blocks(c.filter("role = 'user'"), ends, "conv_id", "turn").select("conv_id", "turn", "block_end")


@query("SELECT s.conv_id, s.turn AS block_start, count(*) AS n, min(c.turn) AS first, max(c.turn) AS last FROM conversations s JOIN conversations c ON c.conv_id = s.conv_id AND c.turn BETWEEN s.turn AND s.turn + 2 WHERE s.role = 'user' GROUP BY 1, 2")
def span_range_join(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    spans = c.filter("role = 'user'").select("conv_id", F.col("turn").alias("block_start"), (F.col("turn") + 2).alias("block_end"))
    return sections.chunks_in(spans, c.select("conv_id", "turn"), "conv_id", "turn").groupBy("conv_id", "block_start").agg(F.count("*").alias("n"), F.min("chunk_turn").alias("first"), F.max("chunk_turn").alias("last"))


@query("""
WITH s AS (SELECT conv_id, turn AS a, turn + 2 + CASE WHEN conv_id % 5 = 0 THEN 1 ELSE 0 END AS claimed FROM conversations WHERE role = 'user'), p AS (SELECT s.conv_id, s.a, s.claimed, max(c.turn) AS z FROM s JOIN conversations c ON c.conv_id = s.conv_id AND c.turn BETWEEN s.a AND s.a + 2 GROUP BY ALL)
SELECT 'span' AS check_id, conv_id || '|' || a AS key, 'pages' AS message FROM p WHERE claimed <> z""")
def span_pages(spark, sf_dir):
    """Spans of three turns from each of the user's, one in five said to end a turn later than it does."""
    c = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("source_pdf"), F.col("turn").alias("chunk_idx"), F.col("turn").alias("page"), "role")
    end = F.col("chunk_idx") + 2
    spans = c.filter("role = 'user'").select("source_pdf", F.col("chunk_idx").alias("block_start"), end.alias("block_end"), F.col("chunk_idx").alias("page_start"), (end + F.when(F.col("source_pdf") % 5 == 0, 1).otherwise(0)).alias("page_end"))
    return quality.spans_hold(spans, c)


@query("SELECT conv_id, arg_min(turn, turn) AS first_turn, arg_max(role, turn) AS last_role FROM conversations GROUP BY 1")
def section_choice(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    first = sections.by_section(c, ["conv_id"], "turn").select("conv_id", F.col("turn").alias("first_turn"))
    return first.join(sections.by_section(c, ["conv_id"], "turn", last=True).select("conv_id", F.col("role").alias("last_role")), "conv_id")


HAY = "regexp_replace(lower(p_name), '[^0-9a-z]+', '', 'g') || '|' || regexp_replace(lower(p_brand), '[^0-9a-z]+', '', 'g') || '|' || regexp_replace(lower(p_type), '[^0-9a-z]+', '', 'g')"


@query(f"SELECT p_partkey, p_name FROM part WHERE contains({HAY}, 'redring') ORDER BY p_name, p_partkey LIMIT 10")
def search_contains(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("haystack", search.haystack(F.col("p_name"), F.col("p_brand"), F.col("p_type")))
    return search.search(p, "Red Ring", ["p_name", "p_partkey"]).select("p_partkey", "p_name")


@query(f"SELECT p_partkey, p_name FROM part WHERE contains({HAY}, 'ring') AND p_brand = 'Brand#5' ORDER BY p_name, p_partkey LIMIT 40")
def search_filtered(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("haystack", search.haystack(F.col("p_name"), F.col("p_brand"), F.col("p_type")))
    return search.search(p, "ring", ["p_name", "p_partkey"], 40, p_brand="Brand#5").select("p_partkey", "p_name")


@query("SELECT DISTINCT p_brand FROM part")
def facet_offices(spark, sf_dir):
    return search.facet(table(spark, sf_dir, "part"), "p_brand")


@query("SELECT c_name, c_custkey FROM customer WHERE c_custkey = 1")
def point_lookup(spark, sf_dir):
    return search.lookup(table(spark, sf_dir, "customer"), "c_custkey", "-5", "1").select("c_name", "c_custkey")


@query("SELECT min(c_custkey) AS c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'")
def default_choice(spark, sf_dir):
    return search.default_id(table(spark, sf_dir, "customer"), "c_custkey", F.col("c_mktsegment") == "BUILDING", "c_custkey")


@query("SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_custkey % 2 = 0")
def evidence_lookup(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("evidence_id"))
    return search.evidence_of(o, table(spark, sf_dir, "customer").filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("evidence_id"), "c_name")).select("o_orderkey", "c_name")


@query(f"""
WITH s AS (SELECT l_orderkey AS k, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS x FROM lineitem GROUP BY 1), o AS (SELECT o_orderkey AS k, CAST(round(o_totalprice * 100) AS BIGINT) AS y FROM orders)
SELECT check_id, count(*) AS n FROM (
  SELECT 'unique_lines' AS check_id FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) UNION ALL SELECT 'line_sums' FROM s FULL JOIN o USING (k) WHERE x IS NULL OR y IS NULL OR x <> y
  UNION ALL SELECT 'known_parts' FROM (SELECT DISTINCT l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5)) UNION ALL SELECT 'status' FROM orders WHERE o_orderstatus NOT IN ('F', 'O')) GROUP BY 1""")
def quality_violations(spark, sf_dir):
    li, o = lines(spark, sf_dir), table(spark, sf_dir, "orders")
    found = quality.union([
        quality.not_unique(li, "unique_lines", ["l_orderkey", "l_linenumber"]),
        quality.sums_differ(li.withColumnRenamed("l_orderkey", "k"), o.select(F.col("o_orderkey").alias("k"), columns.cents("o_totalprice").alias("t")), "line_sums", "k", "amount", "t"),
        quality.missing(li, table(spark, sf_dir, "part").filter("p_size > 5"), "known_parts", "l_partkey", "p_partkey"),
        quality.outside(o, "status", "o_orderstatus", ("F", "O"), "o_orderkey"),
        quality.blank(o, "blank_priority", ["o_orderpriority"], "o_orderkey"),
        quality.tree_sums(hierarchy.rollup_tree(li, ["l_returnflag", "l_linestatus"], "amount"), "tree"),
    ])
    return quality.report(found).select("check_id", "n")


@query("SELECT l_suppkey AS owner, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1")
def owner_parts(spark, sf_dir):
    return dedupe.keep_if_any(table(spark, sf_dir, "lineitem"), F.col("l_suppkey").isNotNull()).groupBy(F.col("l_suppkey").alias("owner")).agg(F.countDistinct("l_partkey").alias("parts"))
