"""Operator 10: URL rules, and trust and distrust that spread over links between hosts.

A rule (host, path) fits a url whose host is the rule's or a subdomain of it and whose path
begins with the rule's; of several the longest counts. Urls without a rule get their host's
verdict: hosts with an allowed page are seeds of trust, which flows along links; hosts that a
rule blocks whole are seeds of distrust, which flows against them (who links to a blocked host
is distrusted); a host that is blocked whole but for some allowed pages is neither.

Both are personalised PageRank, read from its targets: a host's distrust is the rank that blocked
hosts have in the PageRank personalised to that host, the chance that a walk along its links,
which goes on with the chance DAMPING and ends where it meets one, meets a blocked host; its
trust is the same of trusted hosts and links followed backwards. So a host's score rests on
its own links, and other linkers of a seed don't dilute it. What arrived in a round is
spread in the next, until none of it is CLOSE: DAMPING makes it less each round, so this takes 57 rounds at most. A host is
blocked if its distrust exceeds its trust and the threshold.

A null url, or one without `://`, has an empty host and path, no rule, and is allowed. A null
page has no links. Repeated rows count and return each. Empty tables give empty results; extra
columns are ignored. A host without links or seeds is allowed, and so is one whose scores tie. A
url or page of any length is taken whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wonweave.llm import common

#: (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
DAMPING, THRESHOLD, CLOSE = 0.85, 0.25, 1e-4
#: Of links to other hosts: absolute ones, or such as begin with //.
LINK = r"""(?i)<a\b[^>]*?\shref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule(rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits the columns host and path, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def host_edges(pages: DataFrame) -> DataFrame:
    """src, dst, n: links from pages of a host to another host (absolute or //host links). Counted in tasks first."""
    link = F.regexp_extract_all("html", F.lit(LINK), F.lit(1))
    found = pages.select(common.host(F.col("url")).alias("src"), F.explode(link).alias("dst")).withColumn("dst", common.lowered(F.col("dst")))
    return found.filter("src <> '' AND dst <> '' AND src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))


def arriving(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """host, score of the hosts from which damped walks along `edges` (src, dst, n) arrive at `seeds` (host); seeds have 1.

    A round moves a row for each edge to a host that the round before reached, summed before it is moved, and is written to
    shared storage. Walks end at seeds, so their own links don't matter.
    """
    seeds = common.staged(seeds.select("host", F.lit(1.0).alias("score")), "rank-seeds")
    out = edges.groupBy("src").agg(F.sum("n").alias("all"))
    shares = edges.join(out, "src").join(seeds.select(F.col("host").alias("src")), "src", "left_anti")
    shares = common.staged(shares.select("src", "dst", (F.col("n") / F.col("all")).alias("share")), "rank-shares")
    parts = [seeds]
    while True:
        moved = parts[-1].join(shares, parts[-1]["host"] == shares["dst"]).groupBy(F.col("src").alias("host")).agg((F.sum(F.col("score") * F.col("share")) * DAMPING).alias("score"))
        moved = common.staged(moved, "rank")
        most = moved.agg(F.max("score")).first()[0]
        if most is None or most < CLOSE:
            common.drop(moved)
            break
        parts.append(moved)
    score = common.staged(reduce(DataFrame.unionByName, parts).groupBy("host").agg(F.sum("score").alias("score")), "ranks")
    common.drop(shares, *parts)
    return score


def judge(pages: DataFrame, rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust of every row."""
    ruled = pages.select("page_id", common.host(F.col("url")).alias("host"), path(F.col("url")).alias("path")).withColumn("r", rule(rules))
    whole = [h for verdict, h, p in rules if verdict == "block" and p in ("", "/")]
    by_host = common.staged(ruled.filter("host <> ''").groupBy("host").agg(F.count("*").alias("n"), F.count_if(F.col("r.verdict") == "allow").alias("allowed")), "hosts")
    blocked = F.lit(False)
    for h in whole:
        blocked = blocked | (F.col("host") == h) | F.col("host").endswith("." + h)
    edges = common.staged(host_edges(pages), "host-edges")
    # hosts may be linked to without having pages
    known = by_host.select("host", "n", "allowed").unionByName(edges.select(F.col("dst").alias("host"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("allowed"))).groupBy("host").agg(F.sum("n").alias("n"), F.sum("allowed").alias("allowed"))
    bad = known.filter(blocked & (F.col("allowed") == 0)).select("host")
    good = known.filter(~blocked & (F.col("allowed") > 0)).select("host")
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    scores = {"trust": arriving(back, good).withColumnRenamed("score", "trust"), "distrust": arriving(edges, bad).withColumnRenamed("score", "distrust")}
    hosts = known.select("host")
    for found in scores.values():
        hosts = hosts.join(found, "host", "left")
    hosts = hosts.select("host", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in scores])
    hosts = common.staged(hosts, "host-scores")  # the join below is then dealt out anew on both sides, and Spark can split a large host
    # rounded, so that the order of sums doesn't settle ties
    method = F.when((F.round("distrust", 9) > F.round("trust", 9)) & (F.col("distrust") > threshold), "block").otherwise("allow")
    return ruled.join(hosts, "host", "left").select("page_id", "host", "path", F.col("r.rule").alias("rule"), F.coalesce("r.verdict", method).alias("verdict"), *scores)


def digests(found: DataFrame) -> DataFrame:
    return found.select("page_id", "host", "path", "rule", "verdict")


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_FIRST = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
_CASE = "CASE " + " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{{}}'".replace("{}", v + " " + h + p) for v, h, p in _FIRST) + " END"
_BLOCKED = " OR ".join(f"host = '{h}' OR ends_with(host, '.{h}')" for v, h, p in RULES if v == "block" and p in ("", "/"))
_WALK = "SELECT 0 AS k, host, 1.0::DOUBLE AS s FROM {0} UNION ALL SELECT k + 1, {1}, sum(s * share) * {2} FROM {3} JOIN {4} ON host = {5} WHERE k < 57 GROUP BY k, {1} HAVING sum(s * share) * {2} >= {6}"
SQL = f"""
WITH RECURSIVE pg AS (SELECT page_id, {_LOWER.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")} AS host, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path, html FROM pages),
ru AS (SELECT page_id, host, path, {_CASE} AS r FROM pg),
li AS (SELECT host AS src, unnest(regexp_extract_all(html, '{LINK.replace("'", "''")}', 1)) AS dst FROM pg),
ed AS (SELECT src, {_LOWER.format("dst")} AS dst, count(*) AS n FROM li WHERE src <> '' AND dst <> '' AND src <> {_LOWER.format("dst")} GROUP BY ALL),
kn AS (SELECT host, sum(allowed) AS allowed FROM (SELECT host, CASE WHEN r LIKE 'allow%' THEN 1 ELSE 0 END AS allowed FROM ru WHERE host <> '' UNION ALL SELECT dst, 0 FROM ed) GROUP BY 1),
bad AS (SELECT host FROM kn WHERE ({_BLOCKED}) AND allowed = 0), good AS (SELECT host FROM kn WHERE NOT ({_BLOCKED}) AND allowed > 0),
fwd AS (SELECT src, dst, n / sum(n) OVER (PARTITION BY src) AS share FROM ed WHERE src NOT IN (SELECT host FROM bad)), bwd AS (SELECT src, dst, n / sum(n) OVER (PARTITION BY dst) AS share FROM ed WHERE dst NOT IN (SELECT host FROM good)),
dis(k, host, s) AS ({_WALK.format("bad", "src", DAMPING, "dis", "fwd", "dst", CLOSE)}),
tru(k, host, s) AS ({_WALK.format("good", "dst", DAMPING, "tru", "bwd", "src", CLOSE)}),
sc AS (SELECT host, coalesce((SELECT sum(s) FROM dis WHERE dis.host = kn.host), 0) AS d, coalesce((SELECT sum(s) FROM tru WHERE tru.host = kn.host), 0) AS t FROM kn)
SELECT page_id, host, path, substr(r, instr(r, ' ') + 1) AS rule, CASE WHEN r IS NOT NULL THEN substr(r, 1, instr(r, ' ') - 1) WHEN round(d, 9) > round(t, 9) AND d > {THRESHOLD} THEN 'block' ELSE 'allow' END AS verdict FROM ru LEFT JOIN sc USING (host)
"""
