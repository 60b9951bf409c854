"""Operator 12: hard negatives by a vector-approximation file.

A row's vector becomes whole numbers, floor(256 * x), and these become cells: in each dimension
CELLS ranges with about as many vectors of a bounded sample each. The file has a byte for each
dimension and row. A cell's least and greatest number, looked up in a table, bound a row's score
from below and above; only a row whose bounds may enter a window is scored exactly. Windows are,
first, the best rows of an anchor's own label (its positives), then for each positive
the best rows of other labels whose scores are between 80 and 100 percent of the positive's.

Anchors meet all rows in a grid of slices of rows and groups of anchors; a task has a group and
one slice that streams by in tiles, and keeps what is best so far, which raises the bound that
others must reach. Rows move once for each group of anchors, anchors once for each slice. Of rows
that agree in label and vector scores agree too, and smaller ids come first, so only the
first KEPT of them can be among an anchor's first, and only these go into the file: a vector that
a third of all rows share isn't scored again and again.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component, take no part.
Whole numbers beyond 2**26 count as 2**26, which keeps scores exact. A shorter vector counts as
followed by zeros, an empty one as zeros. Repeated rows are rows of their own: they may be each
other's positives, anchors return each. A positive below zero has no window. No anchors, or an
empty table, give an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wonweave.llm import common

#: Positives of an anchor, negatives of a positive; a negative's score is from LOW to HIGH percent of the positive's.
TOP, LOW, HIGH = 5, 80, 100
#: Rows of one label and vector that can matter: an anchor and TOP others.
KEPT = TOP + 1
#: A component's largest whole number; cells of a dimension; vectors that cell borders are drawn from (never over twice as many).
LARGEST, CELLS, SAMPLE = 1 << 26, 64, 4096
#: Rows of a slice and anchors of a group at most; while there are fewer, slices are as small as gives SLICES of them.
SLICE, GROUP, SLICES, LEAST_SLICE = 65_536, 16_384, 24, 1024
#: Rows and anchors whose bounds are in memory together; pairs that are scored together.
TILE, BAND, PAIRS = 2048, 512, 16_384
#: Labels whose counts are broadcast; beyond, they are joined by shuffling.
SMALL = 50_000

ROWS = "vec_id long, label long, vector binary"


def whole_numbers(rows: DataFrame, anchor_every: int) -> DataFrame:
    """uid, vec_id, label, vector (little-endian 32-bit numbers), anchor of the rows that take part."""
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    given = rows.filter("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").select(F.col("vec_id").cast("long").alias("vec_id"), relabelled.alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("vector", pa.binary())])

    @common.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # a null is not a number
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
            ok = np.flatnonzero(bad[ends[1:]] == bad[ends[:-1]])
            with np.errstate(invalid="ignore"):
                data = np.floor(np.clip(np.where(np.isfinite(x), x, 0.0), -LARGEST, LARGEST) * 256).clip(-LARGEST, LARGEST).astype("<i4").tobytes()
            vectors = [data[4 * ends[i] : 4 * ends[i + 1]] for i in ok.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ok)), batch.column(1).take(pa.array(ok)), pa.array(vectors, pa.binary())], schema=schema)

    found = given.mapInArrow(run, ROWS)
    return found.select(F.monotonically_increasing_id().alias("uid"), "vec_id", "label", "vector", (F.col("vec_id") % anchor_every == 0).alias("anchor"))


def _matrix(vectors: list[bytes], dims: int) -> np.ndarray:
    """A row of numbers for each vector; shorter ones are followed by zeros."""
    out = np.zeros((len(vectors), dims), np.int64)
    sizes = np.array([len(v) // 4 for v in vectors], np.int64)
    x = np.frombuffer(b"".join(vectors), "<i4")
    begin = np.cumsum(sizes) - sizes
    out[np.repeat(np.arange(len(vectors)), sizes), np.arange(len(x)) - np.repeat(begin, sizes)] = x
    return out


@dataclass
class Cells:
    """Borders of each dimension's cells, and the least and greatest number of each."""

    borders: np.ndarray  # dims x (CELLS - 1)
    low: np.ndarray  # dims x CELLS
    high: np.ndarray

    @classmethod
    def learn(cls, sample: np.ndarray, least: np.ndarray, most: np.ndarray) -> Cells:
        """From a sample's numbers, and each dimension's least and greatest number of all rows. What the borders are makes no difference to results."""
        dims = len(least)
        if len(sample):
            at = (np.arange(1, CELLS) * len(sample)) // CELLS
            borders = np.sort(sample, axis=0)[at].T
        else:
            borders = np.zeros((dims, CELLS - 1), np.int64)
        low = np.minimum(np.concatenate([least[:, None], borders], axis=1), most[:, None])
        high = np.maximum(np.concatenate([borders - 1, most[:, None]], axis=1), least[:, None])
        return cls(borders, low, high)

    def of(self, x: np.ndarray) -> np.ndarray:
        """A byte for each number: its cell."""
        out = np.empty(x.shape, np.uint8)
        for d in range(x.shape[1]):
            out[:, d] = np.searchsorted(self.borders[d], x[:, d], side="right")
        return out

    def bounds(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d = np.arange(cells.shape[1])
        return self.low[d, cells], self.high[d, cells]


def learn_cells(vectors: DataFrame) -> Cells:
    """Each dimension's range is of all rows; a row for each dimension comes to the driver, and the sample."""
    spark = vectors.sparkSession
    schema = pa.schema([("dim", pa.int32()), ("least", pa.int64()), ("most", pa.int64())])

    @common.lean
    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = most = np.zeros(0, np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, TILE):
                part = batch.column(0).slice(i, TILE).to_pylist()
                x = _matrix(part, max(len(least), max(len(v) // 4 for v in part)))
                grown = np.zeros(x.shape[1], np.int64)  # zeros count: shorter vectors have them
                grown[: len(least)] = least
                least = np.minimum(grown, x.min(axis=0))
                grown = np.zeros(x.shape[1], np.int64)
                grown[: len(most)] = most
                most = np.maximum(grown, x.max(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(least)), pa.int32()), pa.array(least), pa.array(most)], schema=schema)

    found = vectors.select("vector").mapInArrow(ranges, "dim int, least long, most long").groupBy("dim").agg(F.min("least").alias("least"), F.max("most").alias("most")).collect()
    found = sorted(found, key=lambda r: r.dim) or [spark.createDataFrame([(0, 0, 0)], "dim int, least long, most long").first()]
    n = vectors.count()
    draw = common.draw(F.col("uid"), 12)
    sample = vectors.filter(draw < min(1.0, SAMPLE / max(n, 1))).select("vector", draw.alias("draw"), "uid").orderBy("draw", "uid").limit(2 * SAMPLE).collect()
    return Cells.learn(_matrix([bytes(r.vector) for r in sample], len(found)), np.array([r.least for r in found]), np.array([r.most for r in found]))


def approximations(vectors: DataFrame, cells: Cells) -> DataFrame:
    """The file: uid, vec_id, label, cells, vector of the rows that can be among an anchor's first."""
    nth = F.row_number().over(Window.partitionBy("label", "vector").orderBy("vec_id", "uid"))
    kept = vectors.withColumn("nth", nth).filter(F.col("nth") <= KEPT).select("uid", "vec_id", "label", "vector")
    schema = pa.schema([("uid", pa.int64()), ("vec_id", pa.int64()), ("label", pa.int64()), ("vector", pa.binary()), ("cells", pa.binary())])
    dims = len(cells.low)

    @common.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, TILE):
                part = batch.slice(i, TILE)
                found = cells.of(_matrix(part.column(3).to_pylist(), dims))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([r.tobytes() for r in found], pa.binary())], schema=schema)

    return kept.mapInArrow(run, "uid long, vec_id long, label long, vector binary, cells binary")


@dataclass
class Best:
    """The first TOP entries of each of `n` windows: by score from the highest, then by id and uid."""

    n: int
    window: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    score: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    vec_id: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    uid: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def add(self, window: np.ndarray, score: np.ndarray, vec_id: np.ndarray, uid: np.ndarray) -> None:
        w, s, v, u = (np.concatenate(x) for x in ((self.window, window), (self.score, score), (self.vec_id, vec_id), (self.uid, uid)))
        by = np.lexsort((u, v, -s, w))
        w = w[by]
        first = np.searchsorted(w, w, side="left")
        by = by[np.arange(len(w)) - first < TOP]
        self.window, self.score, self.vec_id, self.uid = (x[by] for x in (np.concatenate([self.window, window]), s, v, u))

    def floor(self) -> np.ndarray:
        """What a score must reach to enter a window that is full; the least number for others."""
        out = np.full(self.n, np.iinfo(np.int64).min)
        count = np.bincount(self.window, minlength=self.n)
        last = np.cumsum(count) - 1
        full = count >= TOP
        out[full] = self.score[last[full]]
        return out


class Cell:
    """BAND anchors at most, past which rows stream in tiles."""

    def __init__(self, cells: Cells, uid: np.ndarray, label: np.ndarray, x: np.ndarray, windows: np.ndarray | None):
        """`windows`: the scores of each anchor's positives (TOP columns; -1: none); without them the positives are looked for."""
        self.cells, self.uid, self.label, self.x, self.windows = cells, uid, label, x, windows
        signs = np.concatenate([np.maximum(x, 0), np.minimum(x, 0)], axis=1)
        reach = int(np.abs(signs).sum(axis=1).max(initial=0)) * int(max(np.abs(cells.low).max(initial=0), np.abs(cells.high).max(initial=0)))
        # whole numbers below these are exact in floating point; beyond, bounds are widened
        kind = np.float32 if reach < 1 << 24 else np.float64
        self.slack = 0.0 if reach < 1 << 53 else reach * 2.0**-40
        self.signs = signs.astype(kind)
        self.scored = self.seen = 0
        self.best = Best(len(uid) * (1 if windows is None else TOP))
        if windows is not None:
            none = windows < 0
            self.low = np.where(none, np.iinfo(np.int64).max, -(-windows * LOW // 100))
            self.high = np.where(none, -1, windows * HIGH // 100)
            self.least, self.most = self.low.copy(), self.high.max(axis=1)

    def tile(self, bounds: tuple[np.ndarray, np.ndarray], uid: np.ndarray, vec_id: np.ndarray, label: np.ndarray, x: np.ndarray) -> None:
        low, high = (b.astype(self.signs.dtype) for b in bounds)
        above = self.signs @ np.concatenate([high, low], axis=1).T + self.slack
        below = self.signs @ np.concatenate([low, high], axis=1).T - self.slack
        self.seen += above.size
        (self._positives if self.windows is None else self._negatives)(above, below, uid, vec_id, label, x)

    def _exact(self, a: np.ndarray, r: np.ndarray, x: np.ndarray) -> np.ndarray:
        self.scored += len(a)
        out = np.empty(len(a), np.int64)
        for k in range(0, len(a), PAIRS):
            out[k : k + PAIRS] = np.einsum("ij,ij->i", self.x[a[k : k + PAIRS]], x[r[k : k + PAIRS]])
        return out

    def _positives(self, above: np.ndarray, below: np.ndarray, uid: np.ndarray, vec_id: np.ndarray, label: np.ndarray, x: np.ndarray) -> None:
        fits = (self.label[:, None] == label) & (self.uid[:, None] != uid)
        floor = self.best.floor().astype(above.dtype)
        if above.shape[1] >= TOP and (floor < -(2.0**62)).any():
            # TOP rows that reach a score for certain
            floor = np.maximum(floor, np.partition(np.where(fits, below, -np.inf), -TOP, axis=1)[:, -TOP])
        # a little lower, for what a large number loses in floating point
        a, r = np.nonzero(fits & (above >= (floor - np.abs(floor) * 2.0**-20)[:, None]))
        self.best.add(a, self._exact(a, r, x), vec_id[r], uid[r])

    def _negatives(self, above: np.ndarray, below: np.ndarray, uid: np.ndarray, vec_id: np.ndarray, label: np.ndarray, x: np.ndarray) -> None:
        floor, most = self.least.min(axis=1).astype(np.float64), self.most.astype(np.float64)
        maybe = (above >= (floor * (1 - 2.0**-20))[:, None].astype(above.dtype)) & (below <= (most * (1 + 2.0**-20))[:, None].astype(above.dtype))
        a, r = np.nonzero(maybe & (self.label[:, None] != label))
        s = self._exact(a, r, x)
        pairs, w = np.nonzero((s[:, None] >= self.least[a]) & (s[:, None] <= self.high[a]))
        if len(pairs):
            self.best.add(a[pairs] * TOP + w, s[pairs], vec_id[r[pairs]], uid[r[pairs]])
            self.least = np.maximum(self.low, self.best.floor().reshape(-1, TOP))


def _grid(rows: DataFrame, anchors: DataFrame, key: str, further: list[str]) -> DataFrame:
    """Rows and anchors, dealt out: those of an equal key meet in (key, slice, band). Anchors come before rows."""
    rows, anchors = rows.withColumn("key", F.col(key).cast("long")), anchors.withColumn("key", F.col(key).cast("long"))
    size = max(LEAST_SLICE, min(SLICE, -(-rows.count() // SLICES)))
    cut = lambda n, most: F.greatest(F.ceil(n / most), F.lit(1)).cast("int")
    counted = rows.groupBy("key").agg(F.count("*").alias("n")).join(anchors.groupBy("key").agg(F.count("*").alias("m")), "key").select("key", cut(F.col("n"), size).alias("slices"), cut(F.col("m"), GROUP).alias("bands"))
    counted = common.staged(counted, "grid")
    if counted.limit(SMALL + 1).count() <= SMALL:
        counted = F.broadcast(counted)
    part = lambda n: F.pmod(F.xxhash64("uid", F.lit(12)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["uid", "vec_id", "label", "vector"]
    left = anchors.join(counted, "key").withColumn("band", part("bands")).select("key", "band", every("slices").alias("slice"), F.lit(0).alias("kind"), *columns, F.lit(None).cast("binary").alias("cells"), *further)
    right = rows.join(counted, "key").withColumn("slice", part("slices")).select("key", every("bands").alias("band"), "slice", F.lit(1).alias("kind"), *columns, "cells", *[F.lit(None).cast(anchors.schema[c].dataType).alias(c) for c in further])
    return left.unionByName(right).repartition("key", "slice", "band").sortWithinPartitions("key", "slice", "band", "kind").select("key", "slice", "band", "kind", *columns, "cells", *further)


OUT = [("anchor_uid", pa.int64()), ("anchor_id", pa.int64()), ("place", pa.int32()), ("positive_id", pa.int64()), ("positive_score", pa.int64()), ("vec_id", pa.int64()), ("uid", pa.int64()), ("score", pa.int64())]


def _streamed(cells: Cells, of_windows: bool):
    """The best of each window in each part of the grid."""
    schema = pa.schema(OUT)
    dims = len(cells.low)

    class Group:
        """The anchors of a part of the grid, as bands."""

        def __init__(self, rows: list[dict]):
            self.bands = []
            for i in range(0, len(rows), BAND):
                part = rows[i : i + BAND]
                windows = np.array([(r["scores"] + [-1] * TOP)[:TOP] for r in part], np.int64) if of_windows else None
                self.bands.append((part, Cell(cells, np.array([r["uid"] for r in part], np.int64), np.array([r["label"] for r in part], np.int64), _matrix([r["vector"] for r in part], dims), windows)))

        def tile(self, tile: pa.RecordBatch) -> None:
            uid, vec_id, label = (tile.column(k).to_numpy() for k in (4, 5, 6))
            bounds = cells.bounds(np.frombuffer(b"".join(tile.column(8).to_pylist()), np.uint8).reshape(-1, dims))
            x = _matrix(tile.column(7).to_pylist(), dims)
            for _, band in self.bands:
                band.tile(bounds, uid, vec_id, label, x)

        def out(self) -> Iterator[pa.RecordBatch]:
            for rows, band in self.bands:
                best = band.best
                who, place = (best.window // TOP, best.window % TOP) if of_windows else (best.window, best.window * 0)
                owners = [rows[i] for i in who.tolist()]
                of = [(r["ids"][p], r["scores"][p]) if of_windows else (None, None) for r, p in zip(owners, place.tolist(), strict=True)]
                cols = [[r["uid"] for r in owners], [r["vec_id"] for r in owners], place, [i for i, _ in of], [s for _, s in of], best.vec_id, best.uid, best.score]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    @common.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, waiting, at = None, [], None  # the group, its anchors while they come, and where
        for batch in batches:
            places = np.stack([batch.column(k).to_numpy() for k in range(4)], axis=1)
            edges = np.flatnonzero((places[1:] != places[:-1]).any(axis=1)) + 1
            for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(places)], strict=True):
                if lo == hi:
                    continue
                key, kind, part = tuple(places[lo, :3].tolist()), places[lo, 3], batch.slice(lo, hi - lo)
                if key != at:
                    if now:
                        yield from now.out()
                    now, waiting, at = None, [], key
                if kind == 0:
                    waiting += part.to_pylist()
                    continue
                now = now or Group(waiting)
                for i in range(0, part.num_rows, TILE):
                    now.tile(part.slice(i, TILE))
        if now:
            yield from now.out()

    return run


def _first(found: DataFrame, *of: str) -> DataFrame:
    """The first TOP of each window over all slices, with their rank."""
    rank = F.row_number().over(Window.partitionBy(*of).orderBy(F.col("score").desc(), "vec_id", "uid"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= TOP)


def mine(rows: DataFrame, anchor_every: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for `rows` (vec_id, embedding, label)."""
    vectors = common.staged(whole_numbers(rows, anchor_every), "vectors")
    cells = learn_cells(vectors)
    file = common.staged(approximations(vectors, cells), "approximations")
    anchors = vectors.filter("anchor").drop("anchor")
    ddl = "anchor_uid long, anchor_id long, place int, positive_id long, positive_score long, vec_id long, uid long, score long"
    near = _grid(file, anchors, "label", []).mapInArrow(_streamed(cells, False), ddl)
    positives = _first(common.staged(near, "positives"), "anchor_uid").groupBy(F.col("anchor_uid").alias("of")).agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("p"))
    ready = anchors.join(positives, F.col("uid") == F.col("of")).select("uid", "vec_id", "label", "vector", F.lit(0).alias("all"), F.col("p.vec_id").alias("ids"), F.col("p.score").alias("scores"))
    ready = common.staged(ready, "anchors")
    far = _grid(file.withColumn("all", F.lit(0)), ready, "all", ["ids", "scores"]).mapInArrow(_streamed(cells, True), ddl)
    found = _first(common.staged(far, "negatives"), "anchor_uid", "place")
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


SQL = f"""
WITH v AS (SELECT row_number() OVER () AS uid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label, [greatest(least(floor(256 * CAST(x AS DOUBLE)), {LARGEST}), -{LARGEST}) FOR x IN embedding] AS x
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
w AS (SELECT uid, vec_id, label, list_resize(x, (SELECT max(len(x)) FROM v), 0.0) AS x FROM v),
s AS (SELECT a.uid AS a, a.vec_id AS anchor_id, a.label = r.label AS same, r.uid, r.vec_id, CAST(list_inner_product(a.x, r.x) AS BIGINT) AS score FROM w AS a JOIN w AS r ON a.uid <> r.uid WHERE a.vec_id % 100 = 0),
p AS (SELECT a, anchor_id, uid AS p, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id, uid) <= {TOP})
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.a, p.p ORDER BY score DESC, vec_id, s.uid) AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.a = s.a WHERE NOT same AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score QUALIFY rank <= {TOP}
"""
