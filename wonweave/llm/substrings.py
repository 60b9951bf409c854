"""Operator 4: removal of every byte in a string of LENGTH bytes that starts anywhere else too.

Prefix doubling over a sparse suffix array. A position p of a text stands behind the anchor
a(p), the position of the least hash of GRAM bytes among p ... p + SPAN - 1 (the leftmost of
equal ones). As GRAM + SPAN - 1 <= LENGTH, a(p) - p depends only on the LENGTH bytes at p, so
equal strings stand behind their own anchors at equal distances, and only anchors, about one
in 70 positions, need rows. A row stands for the distances d ... d + size - 1 behind an anchor:

- its core, the bytes that the strings at all of these contain, LENGTH - size + 1 of them;
- its whole, the bytes that they cover.

In rounds of lesser size and so of longer cores, Spark ranks the rows: a row's pair is the rank
of the core it came from and the name of the bytes by which that has grown at both ends. Pairs
are counted, sorted and numbered anew in that order; a row whose pair is unique leaves, for no
string behind it is found again. A row whose whole is found again leaves too, as all of its
strings are repeated; one row of each such whole stays as a witness, so that others find it.
What is left at a size of 1 are strings of LENGTH bytes, past the threshold. Rows whose wholes
are repeated end early, so late rounds have rows only at the ends of repeated passages.

Names that decide are 128-bit BLAKE2b of the bytes themselves. 64-bit hashes only choose
anchors and drop, before the first round, anchors whose next GRAM + 9 bytes are unique; their
collisions cost time and change nothing.

Exact copies are found by digest first: only one text of each takes part in the rounds, and
all bytes of a text that has a copy go if it has LENGTH bytes. Repeated rows count as copies
and each returns. A null or empty text has no bytes; a null doc_id is like any other. A text of
any length is worked through in stretches of a bounded size. Empty tables give empty results.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wonweave.llm import common

LENGTH = 200
GRAM, SPAN = 32, 160
#: Distances that a row of each round stands for; the cores have 41, 161, 191 and 200 bytes.
ROUNDS = (SPAN, 40, 10, 1)
CORE = LENGTH - SPAN + 1
#: Bytes looked at together; the hashes of so many fit a core's cache.
STRETCH = 1 << 18

_U = np.uint64
_BYTE = np.random.default_rng(20240607).integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_PLACE = _U((1 << 22) - 1)
_SALT = [i.to_bytes(2, "little") for i in range(SPAN + 1)]


def _mix(h: np.ndarray) -> np.ndarray:
    h ^= h >> _U(29)
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(32)
    return h


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes at each position: those of twice the bytes from pairs, again and again."""
    h, n, power = _BYTE[data], 1, _BASE
    while n < GRAM:
        pair = h[:-n] * _U(power)
        pair += h[n:]
        h = _mix(pair) if n >= 8 else pair
        n, power = 2 * n, power * power % 2**64
    return h


def _least(x: np.ndarray, w: int) -> np.ndarray:
    """Of each w in a row."""
    n = 1
    while n * 2 <= w:
        x = np.minimum(x[:-n], x[n:])
        n *= 2
    return np.minimum(x[: len(x) - (w - n)], x[w - n :]) if n < w else x


def _anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, a, lo, hi, core) in order: the positions lo ... hi - 1 of a text stand behind a, all as places in `data`."""
    none = (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    if len(data) < LENGTH:
        return none
    begin, end = offsets[:-1], offsets[1:]
    long = end - begin >= LENGTH
    h = gram_hashes(data)
    key = _mix(h.copy())
    key &= ~_PLACE
    key |= np.arange(len(key), dtype=np.uint64)
    a = (_least(key, SPAN) & _PLACE).astype(np.int64)
    edge = np.zeros(len(data) + 1, np.int8)
    edge[begin[long]] += 1
    edge[end[long] - LENGTH + 1] -= 1
    inside = np.cumsum(edge, dtype=np.int8)[: len(a)] > 0
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | ~inside[:-1]
    lo = np.flatnonzero(new & inside)
    if not len(lo):
        return none
    text = np.searchsorted(offsets, lo, side="right") - 1
    hi = np.minimum(np.append(lo[1:], len(data)), end[text] - LENGTH + 1)
    at = a[lo]
    return text, at, lo, hi, _mix(h[at] * _U(_BASE) + h[at + (CORE - GRAM)])


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """As _anchors(), a stretch at a time; a stretch is of whole texts or of a part of one."""
    found = []
    for i, j in common.slices(offsets, STRETCH):
        first, last = int(offsets[i]), int(offsets[j])
        if last - first <= STRETCH:
            parts = [(first, last, offsets[i : j + 1] - first)]
        else:
            parts = [(b, e := min(b + STRETCH + LENGTH - 1, last), np.array([0, e - b])) for b in range(first, max(first + 1, last - LENGTH + 1), STRETCH)]
        for b, e, at in parts:
            text, *places, core = _anchors(data[b:e], at)
            found.append((text + i, *(p + b for p in places), core))
    text, a, lo, hi, core = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 5
    # an anchor's positions may go on in the next stretch
    first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (text[1:] != text[:-1])])) if len(a) else a
    last = np.append(first[1:], len(a)) - 1 if len(a) else a
    return text[first], a[first], lo[first], hi[last], core[first]


def _batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


@contextmanager
def distinct_texts(docs: DataFrame) -> Iterator[DataFrame]:
    """key, n, body of each text of LENGTH bytes or more, in a table bucketed by key: rounds read it without moving it.

    A task sends each text once, and the count of what it saw again without the text. The
    table goes when the work on it is done or has failed.
    """
    spark = docs.sparkSession
    schema = pa.schema([("key", pa.binary()), ("n", pa.int64()), ("body", pa.binary())])

    @common.lean
    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        for batch in batches:
            bodies = batch.column(0).to_pylist()
            keys = [digest(b) for b in bodies]
            new = []
            for i, k in enumerate(keys):
                if k not in seen:
                    new.append(i)
                seen[k] = seen.get(k, -1) + 1
            yield _batch(schema, [keys[i] for i in new], [1] * len(new), [bodies[i] for i in new])
        again = [(k, n) for k, n in seen.items() if n]
        yield _batch(schema, [k for k, _ in again], [n for _, n in again], [None] * len(again))

    @common.lean
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = body = None
        n = 0
        for batch in batches:
            out = []
            for k, m, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != key:
                    if key is not None:
                        out.append((key, n, body))
                    key, n, body = k, 0, None
                n, body = n + m, b if body is None else body
            if out:
                yield _batch(schema, *zip(*out, strict=True))
        if key is not None:
            yield _batch(schema, [key], [n], [body])

    ddl = "key binary, n long, body binary"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    long = docs.select(F.coalesce("text", F.lit("")).cast("binary").alias("body")).filter(F.length("body") >= LENGTH)
    merged = long.mapInArrow(once, ddl).repartition(parts, "key").sortWithinPartitions("key").mapInArrow(merge, ddl)
    name = f"texts_{uuid.uuid4().hex}"
    path = common.scratch(spark, "texts")
    try:
        with common.staging(spark):
            merged.write.bucketBy(parts, "key").option("compression", "zstd").option("path", path).saveAsTable(name)
        out = spark.table(name)
        out._staged_at = path
        yield out
        common.drop(out)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


# A row of a round in one number: the anchor, how many texts it stands for (2: more), its first distance, and its least and greatest used ones.
def _packed(a: np.ndarray, n: np.ndarray, d: np.ndarray, least: np.ndarray, greatest: np.ndarray) -> np.ndarray:
    return (a << 32) | (n << 24) | (d << 16) | (least << 8) | greatest


def _marked(marks: DataFrame, texts: DataFrame, columns: list[str]) -> DataFrame:
    """key, body and the marks of each text as arrays. Only the marks are moved, and bodies are not sorted."""
    packed = marks.groupBy("key").agg(*[F.collect_list(c).alias(c) for c in columns]) if len(columns) == 1 else marks.groupBy("key").agg(F.collect_list(F.struct(*columns)).alias("m")).select("key", *[F.col(f"m.{c}").alias(c) for c in columns])
    return texts.select("key", "body").join(packed.hint("shuffle_hash"), "key").select("key", "body", *columns)


def _first(texts: DataFrame) -> DataFrame:
    """key, at, n, core of every anchor."""
    schema = pa.schema([("key", pa.binary()), ("at", pa.int64()), ("n", pa.int32()), ("core", pa.int64())])

    @common.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, data = batch.column(0), batch.column(2)
            copies = np.minimum(batch.column(1).to_numpy(zero_copy_only=False), 2).astype(np.int64)
            data, offsets = common.flat(data)
            text, a, lo, hi, core = anchors(data, offsets)
            at = _packed(a - offsets[text], copies[text], np.zeros(len(a), np.int64), a - hi + 1, a - lo)
            yield _batch(schema, keys.take(pa.array(text)), at, copies[text].astype(np.int32), core.view(np.int64))

    return texts.mapInArrow(run, "key binary, at long, n int, core long")


def _name(data: memoryview, salt: int) -> bytes:
    return hashlib.blake2b(data, digest_size=16, salt=_SALT[salt]).digest()


def _rows(marks: DataFrame, texts: DataFrame, size: int, before: int) -> DataFrame:
    """key, at, n, rank, core (the bytes by which it has grown), whole; for each `size` distances of rows of `before` distances."""
    schema = pa.schema([("key", pa.binary()), ("at", pa.int64()), ("n", pa.int32()), ("rank", pa.int64()), *((c, pa.int64()) for c in ("core1", "core2", "whole1", "whole2"))])

    @common.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = common.flat(batch.column(1))
            view = memoryview(data)
            counts, out, cores, wholes = [], [], [], []
            for i, (marked, ranks) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                body, had = view[offsets[i] : offsets[i + 1]], len(out)
                for mark, rank in zip(marked, ranks, strict=True):
                    a, n, d0, least, greatest = mark >> 32, mark >> 24 & 255, mark >> 16 & 255, mark >> 8 & 255, mark & 255
                    for d in range(d0 + (least - d0) // size * size, greatest + 1, size):
                        lo, hi = max(a - greatest, a - d - size + 1), min(a - least, a - d)  # the first and last position
                        if before == size:
                            cores.append(_name(body[a : a + CORE], 0))
                        else:
                            left, right = body[a - d : a - d0], body[a - d0 - before + 1 + LENGTH : a - d - size + 1 + LENGTH]
                            cores.append(_name(bytes(left) + bytes(right), d - d0))
                        wholes.append(_name(body[lo : hi + LENGTH], a - lo))
                        out.append((a << 32 | n << 24 | d << 16 | a - hi << 8 | a - lo, n, rank))
                counts.append(len(out) - had)
            if out:
                at, n, rank = (np.array(x, np.int64) for x in zip(*out, strict=True))
                named = [np.frombuffer(b"".join(x), "<i8").reshape(-1, 2) for x in (cores, wholes)]
                yield _batch(schema, batch.column(0).take(pa.array(np.repeat(np.arange(len(counts)), counts))), at, n.astype(np.int32), rank, *(np.ascontiguousarray(x[:, k]) for x in named for k in (0, 1)))

    return _marked(marks, texts, ["at", "rank"]).mapInArrow(run, "key binary, at long, n int, rank long, core1 long, core2 long, whole1 long, whole2 long")


PAIR, WHOLE = ["rank", "core1", "core2"], ["whole1", "whole2"]


def _with_count(at: Column, n: Column) -> Column:
    return at.bitwiseAND(F.lit(~(255 << 24))).bitwiseOR(F.shiftleft(n.cast("long"), 24))


def repeated(texts: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(key, at of the rows whose strings of LENGTH bytes all start elsewhere too; the staged tables that these are read from)."""
    first = common.staged(_first(texts), "anchors")
    # written first: both sides of a join on what is frequent are then dealt out anew, and Spark can split it
    often = common.staged(first.groupBy("core").agg(F.count("*").alias("k"), F.min("n").alias("least")).filter("k > 1 AND least = 1").select("core"), "anchors-often")
    marks = common.staged(first.join(often, "core").select("key", "at", F.lit(0).cast("long").alias("rank")), "marks")
    common.drop(first, often)
    found, before = [], SPAN
    for size in ROUNDS:
        rows = common.staged(_rows(marks, texts, size, before).withColumn("row", F.monotonically_increasing_id()), "rows")
        common.drop(marks)
        wholes = common.staged(rows.groupBy(*PAIR, *WHOLE).agg(F.sum("n").alias("of"), F.min("row").alias("row")), "wholes")
        done = rows.filter("n = 1").join(wholes.filter("of > 1").select(*WHOLE), WHOLE).select("key", "at")
        found.append(common.staged(done, "repeated"))
        if size > 1:
            # rank pairs that several wholes share, one of them not found again; numbered in their order
            pairs = wholes.groupBy(*PAIR).agg(F.sum("of").alias("of"), F.min("of").alias("least")).filter("of > 1 AND least = 1").select(*PAIR)
            ranks = common.staged(pairs.orderBy(*PAIR).withColumn("next", F.monotonically_increasing_id()), "ranks")
            kept = common.staged(wholes.join(ranks, PAIR).select("row", F.least("of", F.lit(2)).alias("of"), "next"), "kept")
            marks = common.staged(rows.join(kept, "row").select("key", _with_count(F.col("at"), F.col("of")).alias("at"), F.col("next").alias("rank")), "marks")
            common.drop(ranks, kept)
        common.drop(rows, wholes)
        before = size
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out, found


def runs(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of what [start, end) cover."""
    if not len(starts):
        return []
    by = np.argsort(starts, kind="stable")
    starts, ends = starts[by], np.maximum.accumulate(ends[by])
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    return list(zip(starts[new].tolist(), ends[np.concatenate([new[1:], [True]])].tolist(), strict=True))


def cut(body: memoryview, spans: list[tuple[int, int]]) -> bytes:
    at, out = 0, []
    for lo, hi in spans:
        out.append(body[at:lo])
        at = hi
    return b"".join([*out, body[at:]])


def to_characters(body: memoryview, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans, widened to where characters of UTF-8 begin and end, so that what is left between them is whole."""
    out = []
    for lo, hi in spans:
        while lo > 0 and body[lo] & 0xC0 == 0x80:
            lo -= 1
        while hi < len(body) and body[hi] & 0xC0 == 0x80:
            hi += 1
        out.append((lo, hi))
    return out


def changed_texts(docs: DataFrame, characters: bool = False) -> DataFrame:
    """key (digest), n_removed, n_spans, kept (bytes) of each distinct text that loses bytes; written to shared storage.

    With `characters`, a character that loses a byte isn't kept.
    """
    schema = pa.schema([("key", pa.binary()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])

    @common.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = common.flat(batch.column(1))
            view, out = memoryview(data), []
            for i, found in enumerate(batch.column(2).to_pylist()):
                at, body = np.array(found, np.int64), view[offsets[i] : offsets[i + 1]]
                spans = runs((at >> 32) - (at & 255), (at >> 32) - (at >> 8 & 255) + LENGTH)
                out.append((sum(e - b for b, e in spans), len(spans), cut(body, to_characters(body, spans) if characters else spans)))
            if out:
                yield _batch(schema, batch.column(0), *zip(*out, strict=True))

    with distinct_texts(docs) as texts:
        found, used = repeated(texts)
        cut_texts = _marked(found, texts, ["at"]).mapInArrow(run, "key binary, n_removed long, n_spans long, kept binary")
        copies = texts.filter("n > 1").select("key", F.length("body").cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.lit(b"").alias("kept"))
        out = common.staged(cut_texts.unionByName(copies), "changed-texts")
        common.drop(*used)
    return out


def _keyed(docs: DataFrame, columns: list[str]) -> DataFrame:
    """columns, key, n_bytes, sha256 of each row's text."""
    from pyspark.sql.pandas.types import to_arrow_type

    docs = docs.select(*columns, F.coalesce("text", F.lit("")).cast("binary").alias("body"))
    kept = [docs.schema[c] for c in columns]
    schema = pa.schema([*[(f.name, to_arrow_type(f.dataType)) for f in kept], ("key", pa.binary()), ("n_bytes", pa.int64()), ("sha256", pa.string())])

    @common.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch.column(batch.num_columns - 1).to_pylist()
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([digest(b) for b in bodies], pa.binary()), pa.array([len(b) for b in bodies], pa.int64()), pa.array([hashlib.sha256(b).hexdigest() for b in bodies])], schema=schema)

    return docs.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "key binary, n_bytes long, sha256 string"]))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    changed = changed_texts(docs).select("key", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    rows = _keyed(docs, ["doc_id"]).join(changed, "key", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return rows.select("doc_id", "n_bytes", zero("n_removed"), zero("n_spans"), F.coalesce("kept_sha256", "sha256").alias("kept_sha256"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """`docs` with texts less their repeated strings; n_chars, if there, follows. A character that loses bytes goes whole. Texts that lose all are empty and stay."""
    from pyspark.sql.pandas.types import to_arrow_type

    changed = changed_texts(docs, characters=True).select(F.col("key").alias("__key"), F.decode("kept", "UTF-8").alias("__kept"))
    schema = pa.schema([*[(f.name, to_arrow_type(f.dataType)) for f in docs.schema], ("__key", pa.binary())])
    at = docs.columns.index("text")

    @common.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [digest((t or "").encode()) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], schema=schema)

    keyed = docs.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), "__key binary"]))
    rows = keyed.join(changed, "__key", "left").withColumn("text", F.coalesce("__kept", "text"))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.coalesce(F.length("__kept"), "n_chars").cast(docs.schema["n_chars"].dataType))
    return rows.select(*docs.columns)


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT r, p, md5(b[p + 1 : p + {LENGTH}]) AS h FROM (SELECT r, b, unnest(range(0, n - {LENGTH} + 1)) AS p FROM d WHERE n >= {LENGTH})),
again AS (SELECT r, p FROM w JOIN (SELECT h FROM w GROUP BY h HAVING count(*) > 1) USING (h)),
run AS (SELECT r, p, sum(first) OVER (PARTITION BY r ORDER BY p) AS k FROM (SELECT r, p, CASE WHEN p <= lag(p) OVER (PARTITION BY r ORDER BY p) + {LENGTH} THEN 0 ELSE 1 END AS first FROM again)),
span AS (SELECT r, min(p) AS lo, max(p) + {LENGTH} AS hi FROM run GROUP BY r, k),
piece AS (SELECT r, lo, coalesce(lag(hi) OVER (PARTITION BY r ORDER BY lo), 0) AS start FROM (SELECT r, lo, hi FROM span UNION ALL SELECT r, n, n + 1 FROM d)),
kept AS (SELECT r, sha256(unhex(string_agg(hex(b[start + 1 : lo]), '' ORDER BY lo))) AS kept_sha256 FROM piece JOIN d USING (r) GROUP BY r),
total AS (SELECT r, CAST(sum(hi - lo) AS BIGINT) AS n_removed, count(*) AS n_spans FROM span GROUP BY r)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, kept_sha256 FROM d JOIN kept USING (r) LEFT JOIN total USING (r)
"""
