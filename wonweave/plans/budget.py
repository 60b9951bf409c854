"""Accounting queries: office = region, account = nation, program = segment, unit = priority, detail = order, line = lineitem; amounts in cents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wonweave.functions import columns
from wonweave.functions.columns import cents
from wonweave.operators import attach, channels, classify, dedupe, flow, hierarchy, quality, timeline
from wonweave.plans.registry import query, table
from wonweave.sources import sinks

CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"
LEVELS = ("r_name", "n_name", "c_mktsegment", "o_orderpriority")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumn("amount", cents("l_extendedprice"))


def placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with the names of their region, nation, segment and priority."""
    t = lambda n: table(spark, sf_dir, n)
    places = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    who = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(places, F.col("c_nationkey") == F.col("n_nationkey")).select("o_orderkey", *LEVELS)
    return lines(spark, sf_dir).join(who, F.col("l_orderkey") == F.col("o_orderkey"))


PLACED = f"""lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
TREE = f"""
SELECT CAST(4 - (GROUPING(r_name) + GROUPING(n_name) + GROUPING(c_mktsegment) + GROUPING(o_orderpriority)) AS INTEGER) AS level, concat_ws('/', r_name, n_name, c_mktsegment, o_orderpriority) AS path,
  CASE WHEN GROUPING(r_name) = 1 THEN '전체' WHEN GROUPING(n_name) = 1 THEN r_name WHEN GROUPING(c_mktsegment) = 1 THEN n_name WHEN GROUPING(o_orderpriority) = 1 THEN c_mktsegment ELSE o_orderpriority END AS name,
  CAST(sum({CENTS}) AS BIGINT) AS amount, count(*) AS n
FROM {PLACED} GROUP BY ROLLUP (r_name, n_name, c_mktsegment, o_orderpriority)"""


def tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.rollup_tree(placed(spark, sf_dir), LEVELS, "amount")


def _flat(t: DataFrame) -> DataFrame:
    return t.withColumn("path", F.array_join("path", "/"))


@query(TREE)
def hierarchy_rollup(spark, sf_dir):
    return _flat(tree(spark, sf_dir))


@query(f"""
WITH t AS ({TREE}), p AS (SELECT *, array_to_string(list_slice(string_split(path, '/'), 1, level - 1), '/') AS parent FROM t WHERE level > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY parent ORDER BY amount DESC, name) AS place FROM p)
SELECT parent, name, amount, CAST(place AS INTEGER) AS place FROM r WHERE place <= 3""")
def tree_top_children(spark, sf_dir):
    ranked = hierarchy.children_in_order(tree(spark, sf_dir)).filter("place <= 3")
    return ranked.select(F.array_join("parent", "/").alias("parent"), "name", "amount", "place")


@query(f"""
WITH t AS ({TREE}), h AS (SELECT path FROM t WHERE level > 0 AND lower(name) LIKE '%build%')
SELECT level, path, amount FROM t WHERE EXISTS (SELECT 1 FROM h WHERE h.path = t.path OR t.path = '' OR starts_with(h.path, t.path || '/') OR starts_with(t.path, h.path || '/'))""")
def tree_search(spark, sf_dir):
    # the search reads the tree four times
    return _flat(hierarchy.search(sinks.staged(tree(spark, sf_dir), "tree"), "BUILD")).select("level", "path", "amount")


@query(f"WITH t AS ({TREE}) SELECT level, path, amount, n FROM t WHERE level <= 2")
def tree_depth(spark, sf_dir):
    return _flat(hierarchy.to_depth(tree(spark, sf_dir), 2)).select("level", "path", "amount", "n")


@query(f"WITH t AS ({TREE}) SELECT count(*) AS nodes, count(*) FILTER (level = 4) AS leaves, count(*) FILTER (amount > 0) AS funded FROM t")
def tree_statistics(spark, sf_dir):
    return hierarchy.statistics(tree(spark, sf_dir), 4)


@query(f"WITH t AS ({TREE}), r AS (SELECT * FROM t WHERE level = 1) SELECT (SELECT amount FROM t WHERE level = 0) AS amount, count(*) AS children, arg_max(name, amount) AS largest FROM r")
def tree_nested(spark, sf_dir):
    return hierarchy.nest(tree(spark, sf_dir), 4).select("amount", F.size("children").cast("long").alias("children"), F.col("children")[0]["name"].alias("largest"))


@query(f"SELECT l_orderkey, l_linenumber, {CENTS} AS amount, coalesce(CAST(round(l_quantity) AS BIGINT), 0) * 1000 AS thousands, CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END AS flag FROM lineitem")
def line_normalize(spark, sf_dir):
    return lines(spark, sf_dir).select("l_orderkey", "l_linenumber", "amount", (F.coalesce(F.round("l_quantity").cast("long"), F.lit(0)) * 1000).alias("thousands"), F.nullif(F.col("l_returnflag"), F.lit("N")).alias("flag"))


ORDERED = "l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity"


@query(f"SELECT l_orderkey, CAST(sum({CENTS}) AS BIGINT) AS amount, count(*) AS line_count, arg_min(l_returnflag, ({ORDERED})) AS l_returnflag FROM lineitem GROUP BY l_orderkey")
def detail_aggregate(spark, sf_dir):
    seq = F.struct(*[c.strip() for c in ORDERED.split(",")])
    return hierarchy.details(lines(spark, sf_dir).withColumn("seq", seq), ["l_orderkey"], "amount", "seq", ["l_returnflag"])


CHANNEL = "CASE WHEN p_type LIKE '%PROMO%' OR p_name LIKE '%ring%' THEN 'local_subsidy' WHEN p_type LIKE '%ECONOMY%' THEN 'private_transfer' WHEN p_type LIKE '%STANDARD%' THEN 'loan' WHEN p_name LIKE '%gear%' THEN 'equity' WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'capital' ELSE 'direct' END"
FLOW = "CASE WHEN p_name LIKE '%red%' AND (p_type LIKE '%PROMO%' OR p_type LIKE '%LARGE%') THEN 'local_subsidy' WHEN p_type LIKE '%PROMO%' THEN 'contribution' WHEN p_name LIKE '%blue%' THEN 'procurement' WHEN p_type LIKE '%SMALL%' THEN 'internal' ELSE 'other' END"


def with_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    t, n = F.col("p_type"), F.col("p_name")
    # the names of items that a part stands for
    item = classify.first_rule([(t.contains("PROMO") | n.contains("ring"), "자치단체이전"), (t.contains("ECONOMY"), "민간이전"), (t.contains("STANDARD"), "융자금"), (n.contains("gear"), "출자금"), (t.isin("SMALL", "MEDIUM"), "건설비")], "운영비")
    sub = classify.first_rule([(n.contains("red") & classify.any_of(t, ("PROMO", "LARGE")), "자치단체 경상보조"), (t.contains("PROMO"), "기관 출연금"), (n.contains("blue"), "연구개발비"), (t.contains("SMALL"), "일반수용비")], "예비비")
    channel, code = classify.channel(item, F.lit("")), classify.flow_channel(F.lit(""), sub)
    return lines(spark, sf_dir).join(part.select("p_partkey", "p_name", "p_type", channel.alias("channel"), code.alias("code")), F.col("l_partkey") == F.col("p_partkey"))


@query(f"""
WITH s AS (SELECT l_suppkey, {CHANNEL} AS channel, CAST(sum({CENTS}) AS BIGINT) AS amount, count(*) AS line_count FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)
SELECT *, CASE WHEN sum(amount) OVER w <> 0 THEN round_even(CAST(amount AS DOUBLE) / CAST(sum(amount) OVER w AS DOUBLE), 6) ELSE 0 END AS share FROM s WINDOW w AS (PARTITION BY l_suppkey)""")
def channel_mix(spark, sf_dir):
    return channels.mix(with_channels(spark, sf_dir), ["l_suppkey"], {"channel": F.col("channel")}, "amount")


@query(f"""
WITH s AS (SELECT {FLOW} AS code, CAST(sum({CENTS}) AS BIGINT) AS amount, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)
SELECT code, amount, n, CASE code WHEN 'local_subsidy' THEN '지방자치단체 보조' WHEN 'contribution' THEN '출연' WHEN 'procurement' THEN '용역·연구계약' WHEN 'internal' THEN '운영·사업관리' ELSE '기타 집행' END AS label,
  CASE code WHEN 'local_subsidy' THEN 10 WHEN 'contribution' THEN 40 WHEN 'procurement' THEN 50 WHEN 'internal' THEN 100 ELSE 110 END AS place FROM s""")
def flow_channel_totals(spark, sf_dir):
    return channels.totals(with_channels(spark, sf_dir), "code", "amount")


@query(f"""
WITH s AS (SELECT c_mktsegment, l_returnflag, l_linestatus, CAST(sum({CENTS}) AS BIGINT) AS amount, count(*) AS line_count FROM {PLACED} GROUP BY ALL)
SELECT *, round_even(CAST(amount AS DOUBLE) / CAST(sum(amount) OVER (PARTITION BY c_mktsegment) AS DOUBLE), 8) AS share FROM s""")
def item_breakdown(spark, sf_dir):
    return channels.mix(placed(spark, sf_dir), ["c_mktsegment"], {"l_returnflag": F.col("l_returnflag"), "l_linestatus": F.col("l_linestatus")}, "amount", 8)


@query(f"""
WITH s AS (SELECT l_orderkey, l_returnflag, CAST(sum({CENTS}) AS BIGINT) AS amount FROM lineitem GROUP BY ALL)
SELECT o_orderkey, coalesce(string_agg(l_returnflag || ':' || amount, ',' ORDER BY l_returnflag), '') AS flags FROM orders LEFT JOIN s ON o_orderkey = l_orderkey GROUP BY o_orderkey""")
def channels_attached(spark, sf_dir):
    sums = lines(spark, sf_dir).groupBy(F.col("l_orderkey").alias("o_orderkey"), "l_returnflag").agg(F.sum("amount").alias("amount"))
    listed = attach.left_list(table(spark, sf_dir, "orders").select("o_orderkey"), sums, ["o_orderkey"], ["l_returnflag", "amount"], "flags")
    return listed.select("o_orderkey", F.array_join(F.transform("flags", lambda x: F.concat_ws(":", x["l_returnflag"], x["amount"].cast("string"))), ",").alias("flags"))


@query(f"""
WITH f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY {ORDERED}) AS rn FROM lineitem WHERE l_returnflag = 'R') WHERE rn = 1)
SELECT o_orderkey, CAST(l_partkey AS DOUBLE) AS l_partkey, CAST(l_suppkey AS DOUBLE) AS l_suppkey FROM orders LEFT JOIN f ON o_orderkey = l_orderkey""")
def matched_attach_left(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("o_orderkey", F.col("l_orderkey")).withColumn("status", F.when(F.col("l_returnflag") == "R", "matched").otherwise("ambiguous"))
    return attach.matched_only(table(spark, sf_dir, "orders"), rows, ["o_orderkey"], ["l_partkey"], [c.strip() for c in ORDERED.split(",")]).select("o_orderkey", F.col("l_partkey").cast("double"), F.col("l_suppkey").cast("double"))


@query("SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F' AND o_totalprice > 0)")
def eligible_semi(spark, sf_dir):
    sums = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.when(F.col("o_orderstatus") == "F", "local_subsidy").otherwise("direct").alias("channel"), F.col("o_totalprice").alias("amount"))
    return attach.eligible(table(spark, sf_dir, "customer"), sums, ["c_custkey"]).select("c_custkey", "c_name")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def unmatched_anti(spark, sf_dir):
    return table(spark, sf_dir, "orders").join(table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey", "o_custkey")


@query("""
WITH d AS (SELECT o_custkey AS k, CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE count(*) + CASE WHEN o_custkey % 5 = 0 THEN 1 ELSE 0 END END AS total FROM orders GROUP BY o_custkey),
f AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_custkey % 11 <> 0 GROUP BY o_custkey)
SELECT k, coalesce(n, 0) AS rows, CAST(total AS DOUBLE) AS total, concat_ws(',', CASE WHEN n IS NULL THEN 'no rows' END, CASE WHEN total IS NULL THEN 'total missing' END, CASE WHEN total <> coalesce(n, 0) THEN 'total differs' END) AS issues FROM d FULL JOIN f USING (k)""")
def completeness_gate(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("k", F.col("o_custkey"))
    declared = o.groupBy("k").agg(F.count("*").alias("n")).select("k", F.when(F.col("k") % 7 != 0, F.col("n") + F.when(F.col("k") % 5 == 0, 1).otherwise(0)).alias("total"))
    return quality.completeness(o.filter("k % 11 <> 0"), declared, "k").withColumn("issues", F.array_join("issues", ",")).withColumn("total", F.col("total").cast("double"))


@query(f"""
WITH o AS (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS total FROM orders), a AS (SELECT l_orderkey AS k, CAST(sum({CENTS}) AS BIGINT) AS t FROM lineitem GROUP BY 1), b AS (SELECT l_orderkey AS k, CAST(sum({CENTS}) AS BIGINT) AS t FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
SELECT o_orderkey, total, CAST(a.t AS DOUBLE) AS items_total, CAST(a.t - total AS DOUBLE) AS items_difference, CAST(b.t AS DOUBLE) AS returned_total, CAST(b.t - total AS DOUBLE) AS returned_difference FROM o LEFT JOIN a ON a.k = o_orderkey LEFT JOIN b ON b.k = o_orderkey""")
def reconcile_totals(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", cents("o_totalprice").alias("total"))
    rows = lines(spark, sf_dir).select(F.col("l_orderkey").alias("o_orderkey"), "amount", "l_returnflag")
    found = flow.reconciled(o, {"items": rows, "returned": rows.filter("l_returnflag = 'R'")}, "o_orderkey", "total")
    return found.select("o_orderkey", "total", *[F.col(c).cast("double") for c in found.columns[2:]])


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, CASE WHEN l_quantity * l_discount <> 0 THEN round_even(l_tax / l_discount, 6) END AS rate FROM lineitem")
def execution_rate(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", columns.rate("l_tax", F.when(F.col("l_quantity") * F.col("l_discount") != 0, F.col("l_discount"))).alias("rate"))


@query(f"""
WITH g AS (SELECT n_name, CAST(sum({CENTS}) AS BIGINT) AS amount, count(*) AS n FROM {PLACED} GROUP BY 1)
SELECT n_name, n, amount FROM g ORDER BY amount DESC, n_name LIMIT 20""")
def top_local_govs(spark, sf_dir):
    _, top = flow.level_summary(placed(spark, sf_dir), "r_name", "n_name", "amount", "l_orderkey")
    return top.select("n_name", "n", "amount")


@query(f"SELECT r_name, count(*) AS n, CAST(sum({CENTS}) AS BIGINT) AS amount FROM {PLACED} GROUP BY 1")
def level_totals(spark, sf_dir):
    return flow.level_summary(placed(spark, sf_dir), "r_name", "n_name", "amount", "l_orderkey")[0]


@query(f"""
SELECT r_name, n_name, count(*) AS n, count(DISTINCT o_orderkey) AS governments, count(*) FILTER (l_returnflag = 'R') AS returned, CAST(sum({CENTS}) AS BIGINT) AS amount FROM {PLACED} GROUP BY 1, 2""")
def region_rollup(spark, sf_dir):
    return flow.region_rollup(placed(spark, sf_dir), ["r_name", "n_name"], F.col("o_orderkey"), ["amount"], {"returned": F.col("l_returnflag") == "R"})


@query(f"""
SELECT r_name, count(*) AS n, count(DISTINCT o_orderkey) AS governments, CAST(sum({CENTS}) AS BIGINT) AS amount, CAST(coalesce(sum(CASE WHEN l_returnflag = 'R' THEN {CENTS} END), 0) AS BIGINT) AS spent, round_even(CAST(coalesce(sum(CASE WHEN l_returnflag = 'R' THEN {CENTS} END), 0) AS DOUBLE) / sum({CENTS}), 6) AS execution_rate FROM {PLACED} GROUP BY 1""")
def region_rates(spark, sf_dir):
    rows = placed(spark, sf_dir).withColumn("spent", F.when(F.col("l_returnflag") == "R", F.col("amount")).otherwise(0))
    return flow.region_rollup(rows, ["r_name"], F.col("o_orderkey"), ["amount", "spent"], {}, "spent", "amount")


@query("""
WITH k AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1)
SELECT (SELECT count(*) FROM events) AS n, (SELECT count(DISTINCT user_id) FROM events) AS governments, (SELECT CAST(sum(round(value * 100)) AS BIGINT) FROM events) AS cents, string_agg(event_type || '=' || n, ',' ORDER BY event_type) AS kinds FROM k""")
def candidate_summary(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("cents", F.round(F.col("value") * 100).cast("long"))
    s = flow.candidate_summary(e, F.col("user_id"), "event_type", ["cents"])
    return s.select("n", "governments", "cents", F.array_join(F.transform("kinds", lambda k: F.concat(k, F.lit("="), F.element_at("by_kind", k).cast("string"))), ",").alias("kinds"))


@query("""
WITH u AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, unnest(['base', 'discount', 'tax']) AS part, unnest([CAST(round(l_extendedprice * (1 - l_discount) * 100) AS BIGINT), CAST(round(l_extendedprice * l_discount * 100) AS BIGINT), CAST(round(l_extendedprice * l_tax * 100) AS BIGINT)]) AS amount FROM lineitem),
p AS (SELECT l_suppkey, part, CAST(sum(amount) AS BIGINT) AS amount FROM u GROUP BY ALL HAVING sum(amount) > 0)
SELECT *, round_even(CAST(amount AS DOUBLE) / CAST(sum(amount) OVER (PARTITION BY l_suppkey) AS DOUBLE), 6) AS share FROM p""")
def funding_composition(spark, sf_dir):
    part = lambda x: F.round(F.col("l_extendedprice") * x * 100).cast("long")
    rows = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.sum(part(1 - F.col("l_discount"))).alias("base"), F.sum(part(F.col("l_discount"))).alias("discount"), F.sum(part(F.col("l_tax"))).alias("tax"))
    return flow.composition(rows, ["l_suppkey"], ["base", "discount", "tax"])


@query(f"""
WITH i AS (SELECT l_orderkey, 'item-' || lpad(CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {ORDERED}) AS VARCHAR), 2, '0') AS item_id, {CENTS} - 3000000 AS amount FROM lineitem) SELECT * FROM i WHERE amount > 0""")
def positive_items(spark, sf_dir):
    rows = lines(spark, sf_dir).withColumn("amount", F.col("amount") - 3_000_000)
    return flow.items(rows, "l_orderkey", "amount", [c.strip() for c in ORDERED.split(",")]).select("l_orderkey", "item_id", "amount")


@query(f"""
WITH s AS (SELECT l_suppkey AS b, p_brand AS label, CAST(sum({CENTS}) AS BIGINT) AS amount FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL), c AS (SELECT l_suppkey AS b, {FLOW} AS code FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
d(label, code, a) AS (VALUES ('Brand#1', 'contribution', 100), ('Brand#2', 'procurement', 200), ('Brand#2', 'none', 300), ('Brand#9999', 'other', 400)),
x AS (SELECT s.b AS business_id, s.label AS subproject_id, d.code AS channel_id, d.a AS amount FROM s JOIN d USING (label) JOIN c ON c.b = s.b AND c.code = d.code)
SELECT business_id, subproject_id, channel_id, CAST(amount AS BIGINT) AS amount FROM x""")
def crosswalk(spark, sf_dir):
    rows = with_channels(spark, sf_dir).join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), "p_brand"), F.col("l_partkey") == F.col("k")).withColumn("business_id", F.col("l_suppkey"))
    subs = rows.groupBy("business_id", F.col("p_brand").alias("label")).agg(F.sum("amount").alias("total")).withColumn("id", F.col("label"))
    chans = rows.select("business_id", "code").distinct().withColumn("id", F.col("code"))
    seeds = spark.createDataFrame([("Brand#1", "contribution", 100), ("Brand#2", "procurement", 200), ("Brand#2", "none", 300), ("Brand#9999", "other", 400)], "label string, code string, amount long")
    return flow.crosswalk(subs, chans, seeds)


@query(f"""
WITH o AS (SELECT CAST(sum({CENTS}) AS BIGINT) AS x FROM lineitem WHERE l_returnflag = 'R'), c AS (SELECT CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS y FROM orders)
SELECT x AS observed, y AS central, x - y AS gap, round_even(CAST(x AS DOUBLE) / CAST(y AS DOUBLE), 6) AS ratio, FALSE AS reconcilable FROM o, c""")
def candidate_gap(spark, sf_dir):
    return flow.gap(lines(spark, sf_dir).filter("l_returnflag = 'R'").agg(F.sum("amount").alias("amount")), table(spark, sf_dir, "orders").agg(F.sum(cents("o_totalprice")).alias("amount")))


@query(f"""
WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, CAST(round(l_quantity * 100) AS BIGINT) AS a, CAST(round(l_tax * 10000) AS BIGINT) AS b, CAST(round(l_discount * 10000) AS BIGINT) AS budget FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, a + b AS funding_total, budget - (a + b) AS funding_gap, CASE WHEN budget <> 0 THEN round_even(CAST(b AS DOUBLE) / CAST(budget AS DOUBLE), 6) END AS execution_rate, FALSE AS additive FROM r""")
def funding_gap(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(F.col("l_quantity") * 100).cast("long").alias("a"), F.round(F.col("l_tax") * 10000).cast("long").alias("b"), F.round(F.col("l_discount") * 10000).cast("long").alias("budget"))
    return flow.funded(rows, ["a", "b"], "budget", "b").drop("a", "b", "budget")


DAYS = ("20240107", "20240114", "20240121", "20240128")
DAY_SQL = "(VALUES " + ", ".join(f"('{d}')" for d in DAYS) + ") AS d(exe_ymd)"
TIER = "CASE WHEN event_type = 'purchase' THEN 'strong' WHEN event_type IN ('click', 'view') THEN 'broad' ELSE 'verify' END"


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is known on each of four days."""
    days = spark.createDataFrame([(d,) for d in DAYS], "exe_ymd string")
    e = table(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyyMMdd")).withColumn("cents", F.round(F.col("value") * 100).cast("long"))
    tier = F.when(F.col("event_type") == "purchase", "strong").when(F.col("event_type").isin("click", "view"), "broad").otherwise("verify")
    return timeline.as_of(e, days, "day", "exe_ymd").withColumn("tier", tier)


SNAP = f"SELECT *, strftime(ts, '%Y%m%d') AS day, CAST(round(value * 100) AS BIGINT) AS cents, {TIER} AS tier FROM events JOIN {DAY_SQL} ON strftime(ts, '%Y%m%d') <= exe_ymd"


def _tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = spark.createDataFrame([(d,) for d in DAYS], "exe_ymd string")
    rows = snapshots(spark, sf_dir).withColumn("spend", F.when(F.col("user_id") % 2 == 0, F.col("cents")).otherwise(0))
    return timeline.tier_summary(rows, "exe_ymd", "tier", (*classify.TIERS, "empty"), days, F.col("user_id"), ["cents", "spend"], "spend", "cents")


TIER_SQL = f"""
WITH s AS ({SNAP}), g AS (SELECT exe_ymd, tier, count(*) AS n, count(DISTINCT user_id) AS governments, sum(cents) AS cents, sum(CASE WHEN user_id % 2 = 0 THEN cents ELSE 0 END) AS spend FROM s GROUP BY 1, 2),
t(tier_order, tier) AS (VALUES (0, 'strong'), (1, 'broad'), (2, 'verify'), (3, 'empty'))
SELECT exe_ymd, tier, tier_order, coalesce(n, 0) AS n, coalesce(governments, 0) AS governments, CAST(coalesce(cents, 0) AS BIGINT) AS cents, CAST(coalesce(spend, 0) AS BIGINT) AS spend, CASE WHEN coalesce(cents, 0) <> 0 THEN round_even(CAST(spend AS DOUBLE) / CAST(cents AS DOUBLE), 6) END AS rate
FROM {DAY_SQL} CROSS JOIN t LEFT JOIN g USING (exe_ymd, tier)"""


@query(TIER_SQL)
def snapshot_tiers(spark, sf_dir):
    return _tiers(spark, sf_dir)


@query(f"WITH x AS ({TIER_SQL}) SELECT exe_ymd, tier, CAST(cents - lag(cents) OVER (PARTITION BY tier ORDER BY exe_ymd) AS DOUBLE) AS delta FROM x")
def snapshot_delta(spark, sf_dir):
    return timeline.deltas(_tiers(spark, sf_dir), ["tier"], "exe_ymd", "cents").select("exe_ymd", "tier", F.col("delta").cast("double").alias("delta"))


@query(f"WITH x AS ({TIER_SQL}) SELECT exe_ymd, CAST(sum(n) FILTER (tier = 'strong') AS BIGINT) AS strong, CAST(sum(n) FILTER (tier = 'broad') AS BIGINT) AS broad, CAST(sum(n) FILTER (tier = 'verify') AS BIGINT) AS verify FROM x GROUP BY 1")
def snapshot_series(spark, sf_dir):
    return timeline.series(_tiers(spark, sf_dir), "exe_ymd", "tier", classify.TIERS, "n")


@query("WITH e AS (SELECT *, strftime(ts, '%Y%m%d') AS day FROM events) SELECT event_id, user_id, day FROM e WHERE (user_id, day) IN (SELECT user_id, max(day) FROM e GROUP BY 1)")
def snapshot_latest(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyyMMdd"))
    return timeline.latest(e, "day", ["user_id"]).select("event_id", "user_id", "day")


@query("""
WITH e AS (SELECT *, strftime(ts, '%Y%m%d') AS day FROM events), l AS (SELECT * FROM e WHERE day = (SELECT max(day) FROM e)), b AS (SELECT * FROM e WHERE day < '20240110')
SELECT event_id, user_id FROM l UNION ALL SELECT event_id, user_id FROM b WHERE user_id NOT IN (SELECT user_id FROM l)""")
def snapshot_override(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyyMMdd")).select("event_id", "user_id", "day")
    return timeline.override(e.filter("day < '20240110'"), timeline.latest(e, "day"), ["user_id"]).select("event_id", "user_id")


@query("""
WITH e AS (SELECT event_id, user_id, event_type, strftime(ts, '%Y%m%d') AS day, ts FROM events), r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, day ORDER BY ts, event_id) AS rn FROM e)
SELECT event_id, user_id, event_type, day FROM r WHERE rn = 1""")
def local_dedupe_first(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyyMMdd"))
    return dedupe.first_by(e, ["user_id", "event_type", "day"], ["ts", "event_id"]).select("event_id", "user_id", "event_type", "day")


@query("""
WITH e AS (SELECT event_id, user_id, event_type, strftime(ts, '%Y%m%d') AS day FROM events), j AS (SELECT *, '{"day":"' || day || '","event_id":' || event_id || ',"event_type":"' || event_type || '","user_id":' || user_id || '}' AS j FROM e)
SELECT arg_min(event_id, j) AS event_id, user_id, event_type, day FROM j GROUP BY user_id, event_type, day""")
def local_dedupe_min(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.date_format("ts", "yyyyMMdd").alias("day"))
    return dedupe.least_by_json(e, ["user_id", "event_type", "day"])


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, (SELECT count(DISTINCT i.l_suppkey) > 1 FROM lineitem i WHERE i.l_partkey = o.l_partkey) AS shared FROM lineitem o")
def shared_owner_flag(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return dedupe.shared_by_owners(rows, "l_suppkey", ["l_partkey"])


@query("""
WITH r AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders)
SELECT o_custkey, o_orderkey, CAST(rank AS INTEGER) AS rank, 'local-' || lpad(CAST(rank AS VARCHAR), 3, '0') AS display_id FROM r WHERE rank <= 8""")
def top_rows(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    ranked = dedupe.top(o, ["o_custkey"], [F.desc("o_totalprice"), "o_orderkey"], 8)
    return ranked.withColumn("display_id", dedupe.ordinal_id("local", ["o_custkey"], ["rank"])).select("o_custkey", "o_orderkey", "rank", "display_id")


@query("""
WITH a AS (SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 3 <> 0), b AS (SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 3 <> 1)
SELECT *, 'left' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT *, 'right' AS side FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def multiset_diff(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return dedupe.multiset_difference(o.filter("o_orderkey % 3 <> 0").select("o_custkey", "o_orderstatus"), o.filter("o_orderkey % 3 <> 1").select("o_custkey", "o_orderstatus"))


@query("SELECT DISTINCT o_orderkey AS k, 'left' AS side FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) UNION ALL SELECT DISTINCT l_orderkey, 'right' FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)")
def set_equality(spark, sf_dir):
    return dedupe.set_difference(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k")), table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k")), "k")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'O') UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'P'")
def union_offices(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return o.filter(F.col("o_orderstatus").isin("F", "O")).unionByName(o.filter("o_orderstatus = 'P'"))


@query("SELECT c_custkey, 'kb-' || substr(sha256(CAST(c_custkey AS VARCHAR) || chr(31) || coalesce(c_name, '') || chr(31) || coalesce(c_mktsegment, '')), 1, 16) AS id FROM customer")
def stable_ids(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", columns.stable_id("kb", columns.key("c_custkey", "c_name", "c_mktsegment")).alias("id"))
