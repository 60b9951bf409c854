"""Nodes, edges and paths of workflow and money-flow graphs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wonweave.functions.columns import key, stable_id

PHASES = ("G0", "G1", "G2", "G3", "G4", "G5", "G6")
EDGE_TYPES = ("context", "fund", "delivery", "sequence", "candidate", "information", "feedback")
NODE_COLUMNS = ("business_id", "id", "phase", "kind", "label", "amount", "seq")


def nodes(df: DataFrame, business: str, kind: str, phase: str | Column, label: Column, amount: Column | None = None, seq: Column | None = None) -> DataFrame:
    """A node for each row; its id follows from business, kind, label and order."""
    order = seq if seq is not None else F.lit(0)
    return df.select(F.col(business).cast("string").alias("business_id"), stable_id("p", key(F.col(business), F.lit(kind), label, order), 14).alias("id"), (F.lit(phase) if isinstance(phase, str) else phase).alias("phase"), F.lit(kind).alias("kind"), label.alias("label"), (amount if amount is not None else F.lit(None)).cast("long").alias("amount"), order.cast("int").alias("seq"))


def edges(df: DataFrame, source: str, target: str, kind: str, label: Column | None = None) -> DataFrame:
    """An edge for each row; its id follows from its ends and type."""
    return df.select("business_id", stable_id("e", key(source, target, F.lit(kind)), 14).alias("id"), F.col(source).alias("src"), F.col(target).alias("dst"), F.lit(kind).alias("type"), (label if label is not None else F.lit("")).alias("label"))


def sequence(n: DataFrame) -> DataFrame:
    """Edges between consecutive nodes of a business, by seq."""
    w = Window.partitionBy("business_id").orderBy("seq", "id")
    return edges(n.withColumn("next_id", F.lead("id").over(w)).filter("next_id IS NOT NULL"), "id", "next_id", "sequence")


def display_ids(n: DataFrame) -> DataFrame:
    """P01, P02 ... in order of phase and seq."""
    i = F.row_number().over(Window.partitionBy("business_id").orderBy("phase", "seq", "id"))
    return n.withColumn("display_id", F.format_string("P%02d", i))


def actors(df: DataFrame, business: str, roles: dict[str, Column]) -> DataFrame:
    """A row for each named actor of a business: the first role (in order) that it has."""
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("o"), F.lit(r).alias("role"), c.alias("name")) for i, (r, c) in enumerate(roles.items())]))
    named = df.select(F.col(business).cast("string").alias("business_id"), each.alias("a")).filter("a.name IS NOT NULL AND a.name <> ''")
    return named.groupBy("business_id", F.col("a.name").alias("name")).agg(F.min_by("a.role", "a.o").alias("role")).withColumn("id", stable_id("a", key("business_id", "name"), 14))


def only_known_ends(e: DataFrame, n: DataFrame, id_: str = "id") -> DataFrame:
    """Edges both of whose ends are nodes."""
    ids = n.select(F.col(id_).alias("__id")).distinct()
    return e.join(ids, F.col("src") == F.col("__id"), "left_semi").join(ids, F.col("dst") == F.col("__id"), "left_semi")


def dangling(e: DataFrame, n: DataFrame, id_: str = "id") -> DataFrame:
    ids = n.select(F.col(id_).alias("__id")).distinct()
    ends = e.select(F.explode(F.array("src", "dst")).alias("missing"))
    return ends.join(ids, F.col("missing") == F.col("__id"), "left_anti").distinct()


def neighbours(e: DataFrame, chosen: DataFrame) -> DataFrame:
    """id, side, other of each edge at a chosen node (id)."""
    c, e = chosen.select("id"), e.select("src", "dst")
    out = c.join(e, F.col("id") == F.col("src")).select("id", F.lit("out").alias("side"), F.col("dst").alias("other"))
    return out.unionByName(c.join(e, F.col("id") == F.col("dst")).select("id", F.lit("in").alias("side"), F.col("src").alias("other")))


#: Hops that are taken one by one; beyond, paths double.
HOPS = 7


def reachable(e: DataFrame, starts: DataFrame, upstream: bool = False) -> DataFrame:
    """start, node, depth (least) of all that paths reach, of any length; start itself at 0. Ends as soon as nothing is new, also in cycles.

    The result has a row for each pair, as it must. The first HOPS rounds each move what is new since the one before. Paths
    that go on are doubled: from what is reached in fewer than 2**k hops and the pairs of nodes that 2**k hops join comes
    what is reached in fewer than 2**(k + 1), so a chain of 10,000 nodes takes 11 more rounds.
    """
    from wonweave.sources.sinks import staged

    step = e.select(F.col("dst").alias("a"), F.col("src").alias("b")) if upstream else e.select(F.col("src").alias("a"), F.col("dst").alias("b"))
    step = staged(step.distinct())
    seen = front = starts.select(F.col("id").alias("start"), F.col("id").alias("node"), F.lit(0).alias("depth")).distinct()
    for d in range(1, HOPS + 1):
        new = front.join(step, F.col("node") == F.col("a")).select("start", F.col("b").alias("node")).distinct().join(seen, ["start", "node"], "left_anti")
        front = staged(new.withColumn("depth", F.lit(d)))
        if front.isEmpty():
            return seen
        seen = seen.unionByName(front)
    seen, hops, jump = staged(seen), 1, step
    twice = lambda j: j.join(j.select(F.col("a").alias("b"), F.col("b").alias("c")), "b").select("a", F.col("c").alias("b")).distinct()
    while hops <= HOPS:
        jump, hops = staged(twice(jump)), 2 * hops
    while True:
        far = seen.join(jump, F.col("node") == F.col("a")).select("start", F.col("b").alias("node"), (F.col("depth") + hops).alias("depth"))
        new = staged(far.groupBy("start", "node").agg(F.min("depth").alias("depth")).join(seen.select("start", "node"), ["start", "node"], "left_anti"))
        if new.isEmpty():
            return seen
        seen = staged(seen.unionByName(new))
        jump, hops = staged(twice(jump)), 2 * hops


def path_terms(e: DataFrame, n: DataFrame, terms: Sequence[str]) -> DataFrame:
    """Nodes whose label holds the last term, on paths that pass labels with the terms before it, in order (steps may lie between)."""
    front = n.filter(F.col("label").contains(terms[0])).select("id").distinct()
    for t in terms[1:]:
        after = reachable(e, front).filter("depth > 0").select(F.col("node").alias("id")).distinct()
        front = n.filter(F.col("label").contains(t)).join(after, "id", "left_semi").select("id").distinct()
    return front


def visible(e: DataFrame, hidden: Sequence[str]) -> DataFrame:
    return e.filter(~F.col("type").isin(*hidden)) if hidden else e


def closure_both(e: DataFrame, chosen: DataFrame) -> DataFrame:
    """What lies up and down from chosen nodes, with `side`."""
    return reachable(e, chosen).withColumn("side", F.lit("down")).unionByName(reachable(e, chosen, upstream=True).withColumn("side", F.lit("up")))
