"""Operator 6: 64-bit SimHash fingerprints and their links at a few differing bits.

Links are found by a generalised pigeonhole: correlated bits are grouped into parts; a
dynamic program gives each part its own threshold t, at least -1 (not probed), so that the
sum of t + 1 is one more than the allowed difference; so of two linked fingerprints some
part differs in t bits at most. Fingerprints are dealt out by those parts' values (and all
within t bits of them) and verified. The program weighs rows dealt out against candidates
that it estimates from the counts of the parts' values over all fingerprints.

Documents of equal fingerprints are one node, so copies cost nothing further. Within a
bucket linked fingerprints leave the search as they are reached, and each is returned once.

A null text has no words and the fingerprint zero; so has an empty one. A null doc_id takes
part, but is never a component's id unless all of its component are null. Repeated rows are
linked and returned each; a text of any length has one fingerprint, made a stretch at a time.
Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations, repeat
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wonweave.llm import common, graph

BITS = 64
#: What verifying a candidate costs, where dealing out a row costs 1.
CANDIDATE_COST = 0.02
#: Up to so many fingerprints of a bucket are compared all at once, by their distance in the sorted bucket.
SMALL_BUCKET = 48


def hashes(text: str | None, shingle: int = 3) -> np.ndarray:
    """XXH64 (seed 42) of every shingle of a text, repeats included; fewer words than `shingle` are one, none of no words."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    parts = [b" ".join(words)] if len(words) < shingle else list(map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)))
    return np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(42)), np.uint64, len(parts))


def majority(found: np.ndarray) -> int:
    """Unsigned; a bit is 1 if over half of the hashes have it."""
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(found), 1 << 15):
        ones += np.unpackbits(found[i : i + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(found), bitorder="little").view(np.uint64)[0])


def fingerprint(text: str | None, shingle: int = 3) -> int:
    return majority(hashes(text, shingle))


def fingerprints(docs: DataFrame, shingle: int = 3, kept: str = "doc_id") -> DataFrame:
    """`kept`, fp (the fingerprint's bits as a signed long)."""
    schema = pa.schema([(kept, pa.int64()), ("fp", pa.int64())])

    def work(columns: list[list]) -> list:
        return [columns[0], np.array([fingerprint(t, shingle) for t in columns[1]], np.uint64).view(np.int64)]

    return docs.select(F.col(kept).cast("long").alias(kept), "text").mapInArrow(common.by_slice(schema, work), f"`{kept}` long, fp long")


def bit_sums(nodes: DataFrame) -> np.ndarray:
    """[i, j]: fingerprints with both bits; each task sends its sums, 64 rows of 64."""
    schema = pa.schema([("i", pa.int64()), ("n", pa.list_(pa.int64()))])

    @common.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS), np.int64)
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for k in range(0, len(fp), 1 << 16):
                bits = np.unpackbits(fp[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                total += (bits.T @ bits).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(range(BITS), pa.int64()), pa.array(total.tolist(), pa.list_(pa.int64()))], schema=schema)

    out = np.zeros((BITS, BITS))
    sent = nodes.select("fp").mapInArrow(run, "i long, n array<long>").select("i", F.posexplode("n").alias("j", "n"))
    for r in sent.groupBy("i", "j").agg(F.sum("n").alias("n")).collect():
        out[r.i, r.j] = r.n
    return out


def group_bits(both: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Parts of about equal size: each is seeded with the unused bit that correlates most, and filled with the bits closest to it."""
    p = both.diagonal() / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(corr, 0)
    unused, out = list(range(BITS)), []
    for k in range(parts):
        size = BITS // parts + (k < BITS % parts)
        group = [max(unused, key=lambda b: (corr[b, unused].sum(), -b))]
        unused.remove(group[0])
        while len(group) < size:
            b = max(unused, key=lambda b: (corr[b, group].sum(), -b))
            group.append(b)
            unused.remove(b)
        out.append(sorted(group))
    return out


def part_value(fp: np.ndarray, bits: list[int]) -> np.ndarray:
    out = np.zeros(len(fp), np.int64)
    for i, b in enumerate(bits):
        out |= ((fp >> b) & 1) << i
    return out


def ball(width: int, t: int) -> int:
    """Values within t bits of one of `width` bits."""
    return sum(comb(width, k) for k in range(t + 1))


def collisions(nodes: DataFrame, layouts: list[list[list[int]]]) -> list[list[float]]:
    """For each part of each layout the ordered pairs of fingerprints of an equal value."""
    flat = [(i, j, bits) for i, parts in enumerate(layouts) for j, bits in enumerate(parts)]

    def value(bits: list[int]):
        return sum((F.shiftright(F.col("fp"), b).bitwiseAND(F.lit(1)) * F.lit(1 << i) for i, b in enumerate(bits)), F.lit(0))

    keyed = nodes.select(F.posexplode(F.array(*[value(bits) for *_, bits in flat])).alias("k", "value"))
    rows = keyed.groupBy("k", "value").agg(F.count("*").alias("n")).groupBy("k").agg(F.sum(F.col("n").cast("double") * F.col("n")).alias("pairs")).collect()
    out = [[0.0] * len(parts) for parts in layouts]
    for r in rows:
        i, j, _ = flat[r.k]
        out[i][j] = r.pairs
    return out


def allocate(widths: list[int], pairs: list[float], n: int, most: int) -> tuple[float, list[int]]:
    """The cheapest thresholds whose t + 1 sum to most + 1, by dynamic programming over the parts."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for width, same in zip(widths, pairs, strict=True):
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, ts) in best.items():
            for t in range(-1, most - used + 1):
                more = 0.0 if t < 0 else ball(width, t) * (n + CANDIDATE_COST * same)
                if used + t + 1 not in step or cost + more < step[used + t + 1][0]:
                    step[used + t + 1] = (cost + more, [*ts, t])
        best = step
    return best[most + 1]


def plan(nodes: DataFrame, most: int = 3) -> list[tuple[list[int], int]]:
    """(bits, threshold) of the parts to probe."""
    both = bit_sums(nodes)
    n = nodes.count()
    layouts = [group_bits(both, n, m) for m in range(2, most + 2)] or [[list(range(BITS))]]
    found = [(*allocate([len(b) for b in parts], pairs, n, most), parts) for parts, pairs in zip(layouts, collisions(nodes, layouts), strict=True)]
    _, thresholds, parts = min(found, key=lambda x: x[0])
    return [(bits, t) for bits, t in zip(parts, thresholds, strict=True) if t >= 0]


def _deal(nodes: DataFrame, probes: list[tuple[list[int], int]]) -> DataFrame:
    """key, fp for each value within the threshold of each part."""
    schema = pa.schema([("key", pa.int64()), ("fp", pa.int64())])
    masks = [np.array([sum(1 << i for i in c) for k in range(t + 1) for c in combinations(range(len(bits)), k)], np.int64) for bits, t in probes]

    @common.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_fp = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for k, (bits, _) in enumerate(probes):
                step = max(1, 500_000 // len(masks[k]))
                for i in range(0, len(all_fp), step):
                    fp = all_fp[i : i + step]
                    keys = (part_value(fp, bits)[:, None] ^ masks[k]) * len(probes) + k
                    yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(fp, len(masks[k])))], schema=schema)

    return nodes.select("fp").mapInArrow(run, "key long, fp long")


def _spanning(fp: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Links that join what is linked in a bucket, each fingerprint reached once: what is reached isn't compared again."""
    out, left = [], fp
    while len(left) > 1:
        root, left = left[0], left[1:]
        front = [root]
        while front and len(left):
            x = front.pop()
            near = np.bitwise_count(left ^ x) <= most
            if near.any():
                got = left[near]
                left = left[~near]
                out += [(int(x), int(y)) for y in got]
                front += got.tolist()
    return out


def _small(keys: np.ndarray, fp: np.ndarray, most: int) -> list[tuple[int, int]]:
    """The same for many small buckets at once, sorted by key."""
    found = []
    for s in range(1, SMALL_BUCKET):
        same = keys[s:] == keys[:-s]
        if not same.any():
            break
        at = np.flatnonzero(same)
        at = at[np.bitwise_count(fp[at] ^ fp[at + s]) <= most]
        found.append(np.stack([at, at + s], axis=1))
    above: dict[int, int] = {}

    def top(i: int) -> int:
        while i in above:
            i = above[i]
        return i

    out = []
    for i, j in (np.concatenate(found).tolist() if found else []):
        a, b = top(i), top(j)
        if a != b:
            above[max(a, b)] = min(a, b)
            out.append((int(fp[i]), int(fp[j])))
    return out


def links(nodes: DataFrame, most: int = 3) -> DataFrame:
    """u, v: enough of the links between the distinct fingerprints `nodes` (fp) to connect all that are linked."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    @common.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edges(keys: np.ndarray, fp: np.ndarray) -> list[tuple[int, int]]:
            begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            size = np.diff(np.concatenate([begin, [len(keys)]]))
            small = np.repeat(size <= SMALL_BUCKET, size)
            out = _small(keys[small], fp[small], most)
            for b, n in zip(begin[size > SMALL_BUCKET], size[size > SMALL_BUCKET], strict=True):
                out += _spanning(np.unique(fp[b : b + n]), most)
            return out

        held: list[tuple[np.ndarray, np.ndarray]] = []
        last, rows = None, 0
        for batch in batches:
            keys, fp = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns)
            if not len(keys):
                continue
            cut = int(np.searchsorted(keys, keys[-1]))  # the last key may go on in the next batch
            if keys[0] == keys[-1] and last == keys[0]:
                held.append((keys, fp))
                continue
            done = [*held, (keys[:cut], fp[:cut])]
            held, last = [(keys[cut:], fp[cut:])], keys[-1]
            k, f = (np.concatenate([d[i] for d in done]) for i in (0, 1))
            if len(k) and (found := edges(k, f)):
                yield pa.RecordBatch.from_arrays([pa.array([e[i] for e in found], pa.int64()) for i in (0, 1)], schema=schema)
        if held:
            k, f = (np.concatenate([d[i] for d in held]) for i in (0, 1))
            if len(k) and (found := edges(k, f)):
                yield pa.RecordBatch.from_arrays([pa.array([e[i] for e in found], pa.int64()) for i in (0, 1)], schema=schema)

    dealt = _deal(nodes, plan(nodes, most))
    return dealt.repartition("key").sortWithinPartitions("key").mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, most: int = 3, shingle: int = 3) -> DataFrame:
    """doc_id, fp, component_id (the least doc_id that links reach) of every row."""
    prints = common.staged(fingerprints(docs, shingle), "simhash")
    nodes = common.staged(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    roots = graph.components(links(nodes, most)).withColumnRenamed("node", "fp")
    joined = nodes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(joined.join(named, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def digests(found: DataFrame) -> DataFrame:
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def text_digest() -> Column:
    """With doc_id it tells rows apart; a null text is not an empty one."""
    return F.coalesce(F.sha2("text", 256), F.lit("null"))


def survivors(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """One row of `docs` for each root in `rows` (doc_id, digest, root of each row): the least by doc_id, nulls last, then by the text's digest.

    A doc_id that several roots share, or that is null, stays once for each. Of rows that are
    equal in both, the least by the other columns stays; they are combined before they shuffle.
    """
    each = rows.groupBy("root", "doc_id", "digest").agg(F.count("*").alias("n"))
    first = each.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "digest", "n")).alias("r"))
    kept = common.staged(first.select(F.col("r.doc_id").alias("__id"), F.col("r.digest").alias("__digest"), F.col("r.n").alias("__n")), "survivors")
    found = docs.withColumn("__text_digest", text_digest()).join(kept, docs["doc_id"].cast("long").eqNullSafe(kept["__id"]) & (F.col("__text_digest") == kept["__digest"]))
    single = found.filter("__n = 1").select(*docs.columns)
    if kept.filter("__n > 1").isEmpty():
        return single
    order = [f.name for f in docs.schema.fields if not re.search("map<|variant", f.dataType.simpleString())]
    one = found.filter("__n > 1").groupBy("__id", "__digest").agg(F.min_by(F.struct(*docs.columns), F.struct(*order)).alias("r"))
    return single.unionByName(one.select("r.*"))
