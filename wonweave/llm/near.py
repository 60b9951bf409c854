"""Operator 6 as a stage: of texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more one stays.

Operator 6's SimHash of the five-word shingles and its generalised pigeonhole find most groups
of copies first. Every link is verified on whole sets. No number of bits that can be probed holds
all pairs of similarity 0.8, which differ in about 10 of 64 bits, so what SimHash has not joined
is completed by a prefix filter, which finds all such pairs: sets of n and m shingles that are
similar share at least 0.8 max(n, m), so they share one among the first n - ceil(0.8 n) + 1 of
each, in any order of all shingles, and k among the first n - ceil(0.8 n) + k. So a set that
shares few of its first ones with any others has no similar one and takes no further part.
Shingles that are frequent in a sample come last in the order, which keeps the buckets small
and changes no result.

A bucket is not compared pair by pair: in each round one set of it is compared with those that
no chain of links joins to it yet, and leaves; a bucket whose sets are all joined is done. So a
dense group of copies costs about its size. After ROUNDS the sets that are still apart are
compared where they are: pairs of a bucket of up to SMALL sets are rows, which are at most SMALL / 2 times
as many as the sets' rows; a larger bucket becomes a grid of blocks of bounded size, and a task
compares two blocks with matrix products of hashed bits, which bound how many shingles two
sets share. Only pairs that may be similar are compared whole, and of those only links between what isn't joined yet come out,
fewer than the sets. So many unlike sets that share much (copies that all differ in a fifth, say)
take the time of all pairs of them, which the similarity asks for, but not the rows.

Shingles are told by 64-bit XXH64, sets by 64-bit XXH64 of their shingles. Words are those of
operator 6; a text of fewer than five is one shingle, and texts without words, null ones too,
are equal. A very long text is one set. Rows are told by doc_id and digest, see
simhash.survivors(); an empty table gives an empty result; other columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wonweave.llm import common, graph, simhash

WORDS = 5
#: Differing bits up to which operator 6 proposes a link.
BITS_APART = 3
#: Rounds of one set against its bucket.
ROUNDS = 2
#: Sets of a bucket whose pairs are rows; sets and shingles of a block of a larger one, bits and rows of a matrix.
SMALL, BLOCK, BLOCK_SHINGLES, MOST_BITS, TILE = 32, 1024, 1 << 20, 1 << 15, 256
#: Of so many sets one is looked at for frequent shingles; of those at most so many are told apart.
SAMPLE, FREQUENT = 16, 100_000


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Distinct hashes in order."""
    return np.unique(simhash.hashes(text, words).view(np.int64))


def _frequent(docs: DataFrame) -> np.ndarray:
    """Hashes and counts of shingles that are frequent in a sample of texts, at most FREQUENT, by hash."""
    schema = pa.schema([("s", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingles(text))], schema=schema)

    seen = docs.select("text").filter(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0).mapInArrow(run, "s long").groupBy("s").agg(F.count("*").alias("k")).filter("k > 2")
    often = sorted((r.s, r.k) for r in seen.orderBy(F.desc("k"), "s").limit(FREQUENT).collect())
    return np.array(often, np.int64).reshape(-1, 2)


def lengths(n: int) -> tuple[int, int, int]:
    """(keys that a set of n shingles gives, those of them that a similar one shares one of, how many of all a similar one shares).

    Of sets that share o shingles those first n - o + k and m - o + k in order share k. A similar
    set has 0.8 n shingles at least, so its k is known too.
    """
    need = -(-4 * n // 5)
    k = lambda size: min(1 - -size // 20, -(-4 * size // 5))
    return n - need + k(n), n - need + 1, k(need)


def _scanned(docs: DataFrame) -> DataFrame:
    """doc_id, digest, node, n, fp, keys (the first shingles of the set), base, least (see lengths()) of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.string()), *((c, pa.int32() if c == "n" else pa.int64()) for c in ("node", "n", "fp")), ("keys", pa.list_(pa.int64())), ("base", pa.int32()), ("least", pa.int32())])
    shared = docs.sparkSession.sparkContext.broadcast(_frequent(docs))  # FREQUENT pairs at most, whatever the corpus

    def first(s: np.ndarray, most: int) -> np.ndarray:
        names, counts = shared.value[:, 0], shared.value[:, 1]
        rank = np.zeros(len(s), np.int64)
        if len(names):
            at = np.minimum(np.searchsorted(names, s), len(names) - 1)
            rank = np.where(names[at] == s, counts[at], 0)
        return s[np.lexsort((s, rank))][:most]

    def work(columns: list[list]) -> list:
        found = [shingles(t) for t in columns[2]]
        of = [lengths(len(s)) for s in found]
        nodes, prints = (np.array(x, np.uint64).view(np.int64) for x in ([_node(s) for s in found], [simhash.majority(s.view(np.uint64)) for s in found]))
        return [*columns[:2], nodes, [len(s) for s in found], prints, [first(s, x[0]) for s, x in zip(found, of, strict=True)], [x[1] for x in of], [x[2] for x in of]]

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), simhash.text_digest().alias("digest"), "text")
    return rows.mapInArrow(common.by_slice(schema, work), "doc_id long, digest string, node long, n int, fp long, keys array<long>, base int, least int")


def _node(s: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(s.tobytes(), 42)


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, shingles of the texts of the digests `wanted`."""
    schema = pa.schema([("node", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def work(columns: list[list]) -> list:
        found = [shingles(t) for t in columns[0]]
        return [np.array([_node(s) for s in found], np.uint64).view(np.int64), found]

    texts = docs.select(simhash.text_digest().alias("digest"), "text").join(wanted, "digest", "left_semi").dropDuplicates(["digest"])
    return texts.select("text").mapInArrow(common.by_slice(schema, work), "node long, shingles array<long>")


def _fits(n: Column, m: Column) -> Column:
    return 5 * F.least(n, m) >= 4 * F.greatest(n, m)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """u, v of those pairs whose sets have a similarity of 0.8 or more, in whole numbers."""
    a = sets.select(F.col("node").alias("u"), F.col("shingles").alias("a"))
    b = sets.select(F.col("node").alias("v"), F.col("shingles").alias("b"))
    shared = F.size(F.array_intersect("a", "b"))
    return pairs.distinct().join(a, "u").join(b, "v").filter(9 * shared >= 4 * (F.size("a") + F.size("b"))).select("u", "v")


def _indicators(sets: list[np.ndarray], bits: int) -> np.ndarray:
    """A row of 0 and 1 for each set: which of `bits` places its shingles hash to."""
    out = np.zeros((len(sets), bits), np.float32)
    if sets:
        place = (np.concatenate(sets).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits.bit_length() + 1)).astype(np.int64)
        out[np.repeat(np.arange(len(sets)), [len(s) for s in sets]), place] = 1
    return out


def joining(a: list[tuple[int, int, np.ndarray]], b: list[tuple[int, int, np.ndarray]] | None) -> Iterator[tuple[int, int]]:
    """Links (of nodes) between sets (node, root, shingles) of two blocks, or within one, that join all that links between them join, and nothing that a root joins already."""
    nodes = {node: root for node, root, _ in [*a, *(b or [])]}
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while x in above:
            above[x] = above.get(above[x], above[x])
            x = above[x]
        return x

    most = max(len(s) for *_, s in [*a, *(b or [])])
    bits = 1 << min(max(8 * most - 1, 1).bit_length(), MOST_BITS.bit_length() - 1)
    others = a if b is None else b
    sizes = [np.array([len(s) for *_, s in part], np.float32) for part in (a, others)]
    for i in range(0, len(a), TILE):
        left = _indicators([s for *_, s in a[i : i + TILE]], bits)
        for j in range(i if b is None else 0, len(others), TILE):
            right = _indicators([s for *_, s in others[j : j + TILE]], bits)
            n, m = sizes[0][i : i + TILE, None], sizes[1][j : j + TILE]
            same = left @ right.T
            # a place of one set that the other hasn't is a shingle at least that it hasn't
            shared = np.minimum(n - left.sum(axis=1)[:, None], m - right.sum(axis=1)) + same
            x, y = np.nonzero(9 * shared >= 4 * (n + m))
            for p, q in sorted(zip((x + i).tolist(), (y + j).tolist(), strict=True)):
                (u, root, s), (v, other, t) = a[p], others[q]
                if (b is None and q <= p) or top(root) == top(other):
                    continue
                if 9 * len(np.intersect1d(s, t, assume_unique=True)) >= 4 * (len(s) + len(t)):
                    above[top(nodes[u])] = top(nodes[v])
                    yield u, v


def _in_blocks(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """u, v: verified links that join what is similar in each bucket of `rows` (key, node, root, n), block by block."""
    blocks = rows.groupBy("key").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    placed = rows.select("key", "node", "root").join(blocks, "key").withColumn("mine", F.pmod(F.xxhash64("node", F.lit(6)), F.col("blocks")).cast("int"))
    pair = lambda k: F.struct(F.least("mine", k).alias("i"), F.greatest("mine", k).alias("j"), (k < F.col("mine")).cast("int").alias("side"))
    cells = placed.withColumn("cell", F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), pair))).select("key", "cell.*", "node", "root")
    ready = cells.join(sets, "node").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "side", "node").select("key", "i", "j", "side", "node", "root", "shingles")
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def links(within: bool, held: list[tuple]) -> pa.RecordBatch:
        sides = [[x[1:] for x in held if x[0] == k] for k in (0, 1)]
        found = list(joining(sides[0], None if within else sides[1])) if sides[0] and (within or sides[1]) else []
        return pa.RecordBatch.from_arrays([pa.array([min(p) for p in found], pa.int64()), pa.array([max(p) for p in found], pa.int64())], schema=schema)

    @common.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for key, i, j, side, node, root, s in zip(*[c.to_pylist() if k < 6 else c for k, c in enumerate(batch.columns)], strict=True):
                if (key, i, j) != now:
                    if held:
                        yield links(now[1] == now[2], held)
                    now, held = (key, i, j), []
                held.append((side, node, root, s.values.to_numpy().copy()))
        if held:
            yield links(now[1] == now[2], held)

    return ready.mapInArrow(run, "u long, v long")


def _simhash_links(nodes: DataFrame) -> DataFrame:
    """u, v: nodes that operator 6 joins, by equal fingerprints or by few differing bits; not verified."""
    prints = common.staged(nodes.groupBy("fp").agg(F.min("node").alias("rep")), "near-prints")
    same = nodes.join(prints, "fp").filter("node <> rep").select(F.col("rep").alias("u"), F.col("node").alias("v"))
    close = simhash.links(prints, BITS_APART)
    ends = [prints.select(F.col("fp").alias(c), F.col("rep").alias(f"rep_{c}")) for c in "uv"]
    return same.unionByName(close.join(ends[0], "u").join(ends[1], "v").select(F.col("rep_u").alias("u"), F.col("rep_v").alias("v")))


def components(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """node, root of all sets of `rows`, see _scanned(), that are linked with others."""
    keyed = rows.select("node", "n", "base", "least", F.posexplode("keys").alias("at", "key"))
    shared = common.staged(keyed.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a <> b").select("key"), "near-shared")
    hits = common.staged(keyed.join(shared, "key").select("key", "node", "n", "least", (F.col("at") < F.col("base")).alias("base")).distinct(), "near-hits")
    common.drop(shared)
    # a set that shares too few of its keys with any others has no similar one
    taking = common.staged(hits.groupBy("node", "least").agg(F.count("*").alias("k")).filter("k >= least").select("node"), "near-taking")
    base = hits.filter("base").join(taking, "node", "left_semi").select("key", "node", "n")
    left = common.staged(base.join(base.groupBy("key").agg(F.count("*").alias("k")).filter("k > 1").select("key"), "key"), "near-buckets")
    common.drop(hits)
    wanted = common.staged(rows.select("node", "fp", "digest").join(taking, "node", "left_semi").groupBy("node", "fp").agg(F.min("digest").alias("digest")), "near-wanted")
    sets = common.staged(_sets(docs, wanted.select("digest")), "near-sets")
    found = common.staged(_verified(_simhash_links(wanted), sets), "near-links")
    common.drop(taking, wanted)
    roots = graph.components(found)
    for k in range(ROUNDS + 1):
        named = left.join(roots.withColumnRenamed("node", "__node"), F.col("node") == F.col("__node"), "left").withColumn("root", F.coalesce("root", "node")).drop("__node")
        named = common.staged(named, "near-named")
        # of a bucket that is not all joined: a set of the least group leaves next
        groups = named.groupBy("key", "root").agg(F.count("*").alias("size"), F.min(F.struct("node", "n")).alias("first"))
        picked = groups.groupBy("key").agg(F.count("*").alias("roots"), F.min(F.struct("size", "root", "first")).alias("p")).filter("roots > 1")
        picked = common.staged(picked.select("key", F.col("p.root").alias("__root"), F.col("p.first.node").alias("__node"), F.col("p.first.n").alias("__n")), "near-picked")
        if picked.isEmpty():
            common.drop(named, picked)
            break
        if k == ROUNDS:
            many = common.staged(named.join(picked.select("key"), "key", "left_semi").groupBy("key").agg(F.count("*").alias("size")), "near-sizes")
            few = named.join(many.filter(F.col("size") <= SMALL).select("key"), "key", "left_semi")
            other = few.select("key", F.col("node").alias("__node"), F.col("n").alias("__n"), F.col("root").alias("__root"))
            apart = few.join(other, "key").filter("root < __root")
            large = named.join(many.filter(F.col("size") > SMALL).select("key"), "key", "left_semi")
        else:
            apart = named.join(picked, "key").filter("root <> __root")
        pairs = apart.filter(_fits(F.col("n"), F.col("__n"))).select(F.least("node", "__node").alias("u"), F.greatest("node", "__node").alias("v"))
        new = _verified(pairs, sets)
        new = common.staged(new.unionByName(_in_blocks(large, sets)) if k == ROUNDS else new, "near-links")
        if not new.isEmpty():
            before, found = found, common.staged(found.unionByName(new), "near-links")
            common.drop(before, roots)
            roots = graph.components(found)
        common.drop(new)
        if k < ROUNDS:
            was, left = left, common.staged(named.join(picked, "key").filter("node <> __node").select("key", "node", "n"), "near-buckets")
            common.drop(was)
        common.drop(named, picked)
    common.drop(left, sets, found)
    return roots


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, digest, root of every row: rows that links join have one root."""
    rows = common.staged(_scanned(docs), "near-rows")
    roots = components(rows, docs)
    return rows.select("doc_id", "digest", "node").join(roots, "node", "left").select("doc_id", "digest", F.coalesce("root", "node").alias("root"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group, see simhash.survivors()."""
    return simhash.survivors(docs, groups(docs))
