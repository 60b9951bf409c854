"""Operator 11: a Merkle manifest of a dataset, in a node store outside memory.

Rows become leaves, leaves are sorted into runs by group and key, and get coordinates: the
number of their group's tree and their place in it. The store holds a row for each node
(tree, n, level, idx, hash), in Parquet folders by level. A pass reads one level, in blocks of
SPAN consecutive nodes, as a stream in order, and writes the levels above it up to one node for
each block; the next pass reads what the last wrote. The trees' roots are the leaves of one
more tree. Proofs are merge-scans from the top: a block's nodes, the path above it and the
leaves asked for meet in order of coordinates, and leaves get their siblings as they stream by.
A task holds a block (2 * SPAN hashes), whatever the size of a tree; a tree of a third or of all
rows is many blocks.

Defined cases: a null field counts as `-`; a null group has a tree of its own and comes first; a
null key comes first in its tree; repeated rows are leaves each, those of one key in order of
their hashes; texts of any length are hashed whole; an empty table has no trees, so its manifest
and proofs are empty. Columns that aren't named in `fields` don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wonweave.llm import common

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Nodes that a block's task holds of its lowest level.
SPAN = 1024
#: Rows of a lookup table that are broadcast; beyond it, it is joined by shuffling.
SMALL = 50_000
#: Rows of an Arrow batch that a scan emits.
EMIT = 8192

NODES = "tree long, n long, level int, idx long, hash string"
#: What a row of a merge-scan is: a block's path to the top, a node, a leaf asked for.
PATH, NODE, ASKED = 0, 1, 2


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(c: Column) -> Column:
    text = c.cast("string")
    return F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(fields: dict[str, Column]) -> Column:
    """H of the fields' encodings, in order."""
    return F.sha2(F.concat(*[encoded(c) for c in fields.values()]), 256)


def tampered(fields: dict[str, Column]) -> dict[str, Column]:
    """n_chars is one more; wide enough that the largest long is, too."""
    return fields | {"n_chars": (fields["n_chars"].cast("decimal(20,0)") + 1).cast("decimal(20,0)")}


class Manifest(NamedTuple):
    """What write() left in shared storage, and the only parts of it that the driver has: the root, depths, and no rows."""

    items: DataFrame  # doc_id, changed, tree, n, idx
    trees: DataFrame  # tree, n, lang
    nodes: str
    top: str
    most: int
    count: int
    fan_out: int
    root: str | None


def _in_order(leaves: DataFrame) -> DataFrame:
    """doc_id, leaf, changed, tree, n, idx, lang: `leaves` sorted into runs of (lang, doc_id, leaf), dealt out by ranges.

    Rows that agree in all three may be dealt to several ranges: which of them comes first makes no difference.
    Besides row counts, only the first and last group of each range comes to the driver.
    """
    spark = leaves.sparkSession
    order = [F.col("lang").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), "leaf", "spread"]
    runs = leaves.withColumn("spread", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    runs = common.staged(runs.drop("spread").withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftrightunsigned("at", 33)), "leaf-runs")
    groups = common.staged(runs.groupBy("part", "lang").agg(F.count("*").alias("size"), F.min("at").alias("first")), "leaf-groups")
    ranked = groups.withColumn("rank", F.row_number().over(Window.partitionBy("part").orderBy("first")))
    name = F.coalesce(F.sha2("lang", 256), F.lit("-"))
    ends = ranked.groupBy("part").agg(F.count("*").alias("n"), F.min_by(F.struct(name.alias("name"), "size"), "rank").alias("first"), F.max_by(F.struct(name.alias("name"), "size"), "rank").alias("last"))
    begun, held, last, rows = 0, 0, None, []
    for r in sorted(ends.collect(), key=lambda r: r.part):  # a row for each range
        goes_on = r.first.name == last
        rows.append((r.part, begun - goes_on, held if goes_on else 0))
        begun += r.n - goes_on
        held = r.last.size + (held if goes_on and r.n == 1 else 0)
        last = r.last.name
    starts = spark.createDataFrame(rows, "part long, base long, held long")
    placed = ranked.join(F.broadcast(starts), "part").select("part", "lang", (F.col("base") + F.col("rank") - 1).alias("tree"), (F.when(F.col("rank") == 1, F.col("held")).otherwise(0) - F.col("first")).alias("shift"), "size")
    placed = placed.join(placed.groupBy("tree").agg(F.sum("size").alias("n")), "tree").select("part", F.col("lang").alias("of"), "tree", "shift", "n")
    if groups.limit(SMALL + 1).count() <= SMALL:
        placed = F.broadcast(placed)
    same = (runs["part"] == placed["part"]) & runs["lang"].eqNullSafe(placed["of"])
    return runs.join(placed, same).select("doc_id", "leaf", "changed", "tree", "n", (F.col("at") + F.col("shift")).alias("idx"), "lang")


def _div(a: Column, b: Column | int) -> Column:
    return F.call_function("div", a, (b if isinstance(b, Column) else F.lit(b)).cast("long"))


def _above(n: Column, fan_out: int, levels: int) -> Column:
    """How many nodes a tree of n leaves has at a level."""
    return _div(n - 1, fan_out**levels) + 1


def _height(fan_out: int) -> int:
    """Levels that a pass climbs: blocks have SPAN nodes at most, and one level at least is climbed."""
    h = 1
    while fan_out ** (h + 1) <= SPAN:
        h += 1
    return h


def _passes(most: int, fan_out: int) -> list[int]:
    """The levels from which passes climb, for trees of up to `most` leaves."""
    out, base, step = [0], _height(fan_out), _height(fan_out)
    while -(-most // fan_out**base) > 1:
        out.append(base)
        base += step
    return out


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == EMIT:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for i in range(0, batch.num_rows, EMIT):
            yield from zip(*[c.to_pylist() for c in batch.slice(i, EMIT).columns], strict=True)


def _climbed(rows: Iterator[tuple], base: int, height: int, fan_out: int) -> Iterator[tuple]:
    """The nodes above those of a level, which come by (tree, n, idx, hash) in order: as runs fill up they become a node, and so on."""
    span = fan_out**height
    block: tuple | None = None
    waiting: list[list[str]] = []
    done: list[int] = []

    def push(tree: int, n: int, level: int, h: str) -> Iterator[tuple]:
        """A node of `level` above base joins its run."""
        while level < len(waiting):
            waiting[level].append(h)
            if len(waiting[level]) < fan_out:
                return
            h, level = digest("".join(waiting[level])), level + 1
            waiting[level - 1] = []
            yield tree, n, base + level, done[level], h
            done[level] += 1

    def close() -> Iterator[tuple]:
        if block:
            for level in range(len(waiting)):
                if waiting[level]:
                    h = digest("".join(waiting[level]))
                    waiting[level] = []
                    yield block[0], block[2], base + level + 1, done[level + 1], h
                    yield from push(block[0], block[2], level + 1, h)

    for tree, n, idx, h in rows:
        now = (tree, idx // span, n)
        if now != block:
            yield from close()
            block, there = now, -(-n // fan_out**base)
            climb = height if there > span else next(d for d in range(height + 1) if fan_out**d >= there)
            waiting = [[] for _ in range(climb)]
            done = [now[1] * fan_out ** (height - k) for k in range(climb + 1)]
        yield from push(tree, n, 0, h)
    yield from close()


def _build(leaves: DataFrame, path: str, most: int, fan_out: int) -> None:
    """Writes the nodes of trees of up to `most` leaves to `path`, from `leaves` (tree, n, idx, hash)."""
    spark, height = leaves.sparkSession, _height(fan_out)
    schema = pa.schema([("tree", pa.int64()), ("n", pa.int64()), ("level", pa.int32()), ("idx", pa.int64()), ("hash", pa.string())])
    with common.staging(spark):
        leaves.withColumn("level", F.lit(0)).write.partitionBy("level").parquet(path)
        for base in _passes(most, fan_out):
            below = spark.read.schema(NODES).parquet(path).filter((F.col("level") == base) & (_above(F.col("n"), fan_out, base) > 1))
            block = _div(F.col("idx"), fan_out**height).alias("block")
            sorted_ = below.select("tree", block, "n", "idx", "hash").repartition("tree", "block").sortWithinPartitions("tree", "idx").select("tree", "n", "idx", "hash")

            @common.lean
            def run(batches: Iterator[pa.RecordBatch], base: int = base) -> Iterator[pa.RecordBatch]:
                yield from _batches(_climbed(_rows(batches), base, height, fan_out), schema)

            sorted_.mapInArrow(run, NODES).write.partitionBy("level").mode("append").parquet(path)


def _proved(rows: Iterator[tuple], base: int, height: int, fan_out: int, of_node: bool, finish: Callable) -> Iterator[tuple]:
    """finish(tree, n, idx, hash, siblings of each level, subroot, doc_id, changed) for what is asked for, in order of coordinates.

    Rows: (tree, block, kind, level, idx, n, hash, proof, subroot, doc_id, changed). Where `of_node` is set, all
    nodes of the lowest level are asked for.
    """
    nodes: list[list[str]] = []
    above: list[list[str]] = []
    subroot, known, block = "", 0, 0

    def siblings(place: int) -> list[list[str]]:
        out = []
        for level, here in enumerate(nodes[:known]):
            at = place // fan_out**level
            run = at - at % fan_out
            out.append(here[run:at] + here[at + 1 : run + fan_out])
        return out + above

    def pending() -> Iterator[tuple]:
        if of_node and nodes:
            for place, h in enumerate(nodes[0]):
                yield finish(tree, n, block * fan_out**height + place, h, siblings(place), subroot, None, None)

    for t, b, kind, level, idx, size, h, proof, sub, doc_id, changed in rows:
        if kind == PATH:
            yield from pending()
            tree, block, n, above, subroot = t, b, size, proof, sub
            there = -(-n // fan_out**base)
            known = height if there > fan_out**height else next(d for d in range(height + 1) if fan_out**d >= there)
            nodes = [[] for _ in range(max(known, 1))]
        elif kind == NODE:
            if level - base < len(nodes):
                nodes[level - base].append(h)
        else:
            place = idx - block * fan_out**height
            yield finish(t, size, idx, nodes[0][place], siblings(place), subroot, doc_id, changed)
    yield from pending()


def _scan(spark: SparkSession, store: str, whole: DataFrame, most: int, fan_out: int, asked: DataFrame | None, schema: pa.Schema, ddl: str, finish: Callable) -> DataFrame:
    """Merge-scans from the highest pass to the leaves. `whole` (tree, n, proof, subroot) says what is above each tree."""
    height = _height(fan_out)
    span = fan_out**height
    middle = pa.schema([("tree", pa.int64()), ("n", pa.int64()), ("idx", pa.int64()), ("proof", pa.list_(pa.list_(pa.string()))), ("subroot", pa.string())])
    keep = lambda tree, n, idx, h, proof, subroot, doc_id, changed: (tree, n, idx, proof, subroot)
    above = None
    for base in reversed(_passes(most, fan_out)):
        there = _above(F.col("n"), fan_out, base)
        ends = (there <= span) & (there > 1) if base else there <= span
        paths = whole.filter(ends).select("tree", F.lit(0).cast("long").alias("block"), "n", "proof", "subroot")
        if above is not None:
            paths = paths.unionByName(above.select("tree", F.col("idx").alias("block"), "n", "proof", "subroot"))
        none = lambda kind, **c: [F.lit(kind).alias("kind"), *[c.get(x, F.lit(None)).cast(t).alias(x) for x, t in (("level", "int"), ("idx", "long"), ("n", "long"), ("hash", "string"), ("proof", "array<array<string>>"), ("subroot", "string"), ("doc_id", "long"), ("changed", "string"))]]
        level = F.col("level") - base
        found = spark.read.schema(NODES).parquet(store).filter(F.col("level").between(base, base + height - 1) & ((there > 1) if base else F.lit(True)))
        reach = F.element_at(F.array(*[F.lit(fan_out ** (height - k)) for k in range(height)]), level + 1)
        rows = paths.select("tree", "block", *none(PATH, n=F.col("n"), proof=F.col("proof"), subroot=F.col("subroot")))
        rows = rows.unionByName(found.select("tree", _div(F.col("idx"), reach).alias("block"), *none(NODE, level=F.col("level"), idx=F.col("idx"), hash=F.col("hash"))))
        of_node = bool(base) or asked is None
        if not of_node:
            rows = rows.unionByName(asked.select("tree", _div(F.col("idx"), span).alias("block"), *none(ASKED, idx=F.col("idx"), n=F.col("n"), doc_id=F.col("doc_id"), changed=F.col("changed"))))
        rows = rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "kind", "level", "idx")
        last = base == 0
        out, done = (schema, finish) if last else (middle, keep)

        @common.lean
        def run(batches: Iterator[pa.RecordBatch], base: int = base, out: pa.Schema = out, done: Callable = done, of_node: bool = of_node) -> Iterator[pa.RecordBatch]:
            yield from _batches(_proved(_rows(batches), base, height, fan_out, of_node, done), out)

        result = rows.mapInArrow(run, ddl if last else "tree long, n long, idx long, proof array<array<string>>, subroot string")
        if last:
            return result
        above = common.staged(result, "paths")


def write(docs: DataFrame, fan_out: int = 2, fields: tuple[str, ...] = FIELDS) -> Manifest:
    """Writes the manifest of `docs`: trees by lang, ordered by doc_id, and the tree of their roots.

    `changed` is the leaf as tampering makes it, where 7 divides the crc32 of doc_id.
    """
    if fan_out < 2:
        raise ValueError("fan_out must be 2 or more")
    spark = docs.sparkSession
    columns = {f: F.col(f) for f in fields}
    touched = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    leaves = docs.select("lang", F.col("doc_id").cast("long").alias("doc_id"), leaf_hash(columns).alias("leaf"), F.when(touched, leaf_hash(tampered(columns))).alias("changed"))
    items = common.staged(_in_order(common.staged(leaves, "leaves")), "leaves-placed")
    trees = common.staged(items.filter("idx = 0").select("tree", "n", "lang"), "trees")
    sizes = trees.agg(F.coalesce(F.max("n"), F.lit(0)).alias("most"), F.count("*").alias("count")).first()
    nodes, top = common.scratch(spark, "nodes"), common.scratch(spark, "top")
    _build(items.select("tree", "n", "idx", F.col("leaf").alias("hash")), nodes, sizes.most, fan_out)
    _build(_roots(spark, nodes, fan_out).select(F.lit(0).cast("long").alias("tree"), F.lit(sizes["count"]).cast("long").alias("n"), F.col("tree").alias("idx"), "hash"), top, sizes["count"], fan_out)
    root = _roots(spark, top, fan_out).first()
    return Manifest(items.select("doc_id", "changed", "tree", "n", "idx"), trees, nodes, top, sizes.most, sizes["count"], fan_out, root and root.hash)


def _roots(spark: SparkSession, store: str, fan_out: int) -> DataFrame:
    """tree, n, hash of the highest node of each tree."""
    size = _above_at(F.col("n"), F.col("level"), fan_out)
    below = _above_at(F.col("n"), F.col("level") - 1, fan_out)
    return spark.read.schema(NODES).parquet(store).filter((size == 1) & ((F.col("level") == 0) | (below > 1))).select("tree", "n", "hash")


def _above_at(n: Column, level: Column, fan_out: int) -> Column:
    """_above() of a level that is a column; a long has no tree of more than 63 levels."""
    powers = F.array(*[F.lit(min(fan_out**k, 2**62)).cast("long") for k in range(64)])
    return _div(n - 1, F.element_at(powers, F.greatest(level, F.lit(0)) + 1)) + 1


def _whole(spark: SparkSession, m: Manifest) -> DataFrame:
    """tree, n, proof, subroot: the way from each tree's root through the tree of roots."""
    schema = pa.schema([("tree", pa.int64()), ("proof", pa.list_(pa.list_(pa.string()))), ("subroot", pa.string())])
    one = spark.createDataFrame([(0, m.count, [], m.root)], "tree long, n long, proof array<array<string>>, subroot string")
    ways = _scan(spark, m.top, one, m.count, m.fan_out, None, schema, "tree long, proof array<array<string>>, subroot string", lambda tree, n, idx, h, proof, subroot, doc_id, changed: (idx, proof, h))
    return common.staged(m.trees.select("tree", "n").join(ways, "tree"), "ways")


def _ddl(names: str) -> tuple[pa.Schema, str]:
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<array<string>>": pa.list_(pa.list_(pa.string()))}
    return pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in names.split(", ")]), names


def folded(leaf: str, idx: int, n: int, tree: int, proof: list[list[str]], fan_out: int) -> str:
    """The root that a leaf and its siblings lead to: n leaves of the tree say where its levels end and those of the tree of roots begin."""
    at, left = idx, n
    for level in proof:
        if left == 1:
            at, left = tree, -1  # from here on the tree of roots
        place = at % fan_out
        leaf = digest("".join([*level[:place], leaf, *level[place:]]))
        at //= fan_out
        left = -(-left // fan_out) if left > 0 else left
    return leaf


def proofs(m: Manifest, asked: DataFrame | None = None) -> DataFrame:
    """doc_id, tree, n, idx, leaf, subroot, proof (the siblings of each level, left to right) of the rows of m.items, or of some of them."""
    spark = m.trees.sparkSession
    if m.root is None:
        return spark.createDataFrame([], "doc_id long, tree long, n long, idx long, leaf string, subroot string, proof array<array<string>>")
    schema, ddl = _ddl("doc_id long, tree long, n long, idx long, leaf string, subroot string, proof array<array<string>>")
    return _scan(spark, m.nodes, _whole(spark, m), m.most, m.fan_out, m.items if asked is None else asked, schema, ddl, lambda tree, n, idx, h, proof, subroot, doc_id, changed: (doc_id, tree, n, idx, h, subroot, proof))


def audit(m: Manifest) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row: leaves as they are now (`changed`) are held against the manifest."""
    spark = m.trees.sparkSession
    if m.root is None:
        return spark.createDataFrame([], "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    schema, ddl = _ddl("doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string")
    fan_out = m.fan_out

    def finish(tree, n, idx, h, proof, subroot, doc_id, changed):
        return doc_id, h, subroot, digest("".join("".join(x) for x in proof)), folded(changed or h, idx, n, tree, proof, fan_out)

    found = _scan(spark, m.nodes, _whole(spark, m), m.most, m.fan_out, m.items, schema, ddl, finish)
    return found.withColumn("root", F.lit(m.root)).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


_ENCODED = " || ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE CAST(octet_length(encode(CAST({c} AS VARCHAR))) AS VARCHAR) || ':' || CAST({c} AS VARCHAR) END" for c in FIELDS)
SQL = f"""
WITH RECURSIVE crc(i, c, k) AS (SELECT i, i, 0 FROM range(256) AS r(i) UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc WHERE k < 8),
ids AS (SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR) AS s FROM documents WHERE doc_id IS NOT NULL),
sums(doc_id, s, c, k) AS (SELECT doc_id, s, 4294967295::BIGINT, 0 FROM ids UNION ALL SELECT doc_id, s, xor(x.c, sums.c >> 8), sums.k + 1 FROM sums JOIN (SELECT i, c FROM crc WHERE k = 8) AS x ON x.i = xor(sums.c, ascii(substr(s, sums.k + 1, 1))) & 255 WHERE sums.k < length(s)),
touched AS (SELECT doc_id FROM sums WHERE k = length(s) AND xor(c, 4294967295) % 7 = 0),
hashed AS (SELECT doc_id, lang, sha256({_ENCODED}) AS leaf, CASE WHEN doc_id IN (SELECT doc_id FROM touched) THEN sha256({_ENCODED.replace("(n_chars AS", "((n_chars::HUGEINT + 1) AS")}) END AS changed FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, row_number() OVER () AS uid FROM hashed),
low(tree, level, idx, h, n) AS (SELECT tree, 0, idx, leaf, n FROM placed UNION ALL SELECT tree, level + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 1) // 2 FROM low WHERE n > 1 GROUP BY tree, level, idx // 2),
subroots AS (SELECT tree, h, level FROM low WHERE n = 1),
high(level, idx, h, n) AS (SELECT 0, tree, h, (SELECT count(*) FROM subroots) FROM subroots UNION ALL SELECT level + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 1) // 2 FROM high WHERE n > 1 GROUP BY level, idx // 2),
root AS (SELECT h FROM high WHERE n = 1),
steps AS (
  SELECT p.uid, s.level AS step, p.idx >> s.level AS at, o.h FROM placed AS p JOIN (SELECT DISTINCT tree, level FROM low WHERE n > 1) AS s USING (tree) LEFT JOIN low AS o ON o.tree = p.tree AND o.level = s.level AND o.idx = xor(p.idx >> s.level, 1)
  UNION ALL
  SELECT p.uid, b.level + s.level, p.tree >> s.level, o.h FROM placed AS p JOIN subroots AS b USING (tree) CROSS JOIN (SELECT DISTINCT level FROM high WHERE n > 1) AS s LEFT JOIN high AS o ON o.level = s.level AND o.idx = xor(p.tree >> s.level, 1)),
proof AS (SELECT uid, sha256(string_agg(coalesce(h, ''), '' ORDER BY step)) AS proof_sha256 FROM steps GROUP BY uid),
fold(uid, step, h) AS (SELECT uid, 0, coalesce(changed, leaf) FROM placed UNION ALL SELECT f.uid, f.step + 1, sha256(CASE WHEN s.at % 2 = 0 THEN f.h || coalesce(s.h, '') ELSE s.h || f.h END) FROM fold AS f JOIN steps AS s ON s.uid = f.uid AND s.step = f.step),
ends AS (SELECT uid, arg_max(h, step) AS folded_root FROM fold GROUP BY uid)
SELECT doc_id, leaf, b.h AS subroot, (SELECT h FROM root) AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = (SELECT h FROM root) AS verified
FROM placed JOIN subroots AS b USING (tree) JOIN ends USING (uid) LEFT JOIN proof USING (uid)
"""
