"""Operator 13: a quality classifier on random Fourier features of document statistics.

Statistics of whole texts (those that operator 9's rules may test) are put on even scales and
become WIDTH cosines of random projections, whose inner products approximate a Gaussian kernel.
Ridge regression on them is kernel ridge regression: every partition sums its rows' products
(the normal equations), Spark adds the sums up, the driver solves WIDTH + 1 equations. Labelled
rows that the regression hasn't seen then map its values to shares of label 1: counts for
each of STEPS values are pooled until they rise (isotonic regression), and lines are drawn
between the pools.

All labelled rows that aren't held out count, a quarter of them (by a hash of doc_id) for the
isotonic map; only the scales and the kernel's width are of a sample of about SAMPLE rows, never
over twice as many. Cosines are whole numbers in steps of 1/UNIT, so sums are exact and don't
depend on partitions.

Defined cases: labels of one doc_id that disagree, and nulls, don't count, nor do labels without a
document; rows without a doc_id are scored, not learned from. A null or empty text has statistics of zero
and is scored by them. Rows repeat as often as they are given, in training as in results. With no label every
score is 0.5; with labels of one value only, that value. Empty tables give empty results; extra
columns are ignored. Texts of any length are counted whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wonweave.llm import common, quality

#: Features; the steps of a cosine; the ridge's share of a feature's mean square; steps of the regression's values; sampled rows.
WIDTH, UNIT, RIDGE, STEPS, SAMPLE = 256, 512, 1e-3, 2048, 10_000
#: Values of the regression are cut to this range before they are calibrated.
RANGE = (-0.5, 1.5)
#: Pairs of sampled rows whose median distance is the kernel's width.
PAIRS = 4096
STATS = quality.TESTED
#: Statistics without an upper bound, which count by their logarithm.
GROWING = ("n_words", "mean_word", "longest_word", "words_per_line")


def bucket() -> Column:
    """crc32 of doc_id as text, modulo 3; 0 without one."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3, F.lit(0))


def values(columns: list[np.ndarray]) -> np.ndarray:
    """A row of numbers for each document, from columns of STATS."""
    return np.stack([np.log1p(c) if s in GROWING else np.asarray(c, float) for s, c in zip(STATS, columns, strict=True)], axis=1)


@dataclass
class Features:
    """Cosines of random projections of scaled values: their inner products approximate exp(-distance² / (2 width²))."""

    center: np.ndarray
    scale: np.ndarray
    width: float

    def __post_init__(self):
        rng = np.random.default_rng(13)
        self.directions = rng.normal(size=(len(STATS), WIDTH)) / self.width
        self.shifts = rng.uniform(0, 2 * np.pi, WIDTH)

    @classmethod
    def of(cls, sample: np.ndarray) -> Features:
        center, scale = sample.mean(axis=0), sample.std(axis=0)
        scale = np.where(scale > 1e-9, scale, 1.0)
        x = (sample - center) / scale
        rng = np.random.default_rng(31)
        a, b = rng.integers(0, len(x), (2, PAIRS))
        distance = np.sqrt(((x[a] - x[b]) ** 2).sum(axis=1))
        apart = distance[distance > 0]
        return cls(center, scale, float(np.median(apart)) if len(apart) else 1.0)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Whole numbers: steps of 1/UNIT; the last column is 1."""
        z = np.rint(np.cos(((x - self.center) / self.scale) @ self.directions + self.shifts) * UNIT)
        return np.concatenate([z, np.full((len(z), 1), float(UNIT))], axis=1)


def solve(gram: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Ridge weights from sums of products of features, and of features with labels."""
    penalty = np.full(len(gram), RIDGE * np.trace(gram) / len(gram))
    penalty[-1] = 0  # of the constant
    return np.linalg.solve(gram + np.diag(penalty), target)


def pooled(position: np.ndarray, ones: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression: (mean position, share of ones) of pools of neighbours whose shares rise strictly."""
    pools: list[list[float]] = []
    for p, k, m in zip(position.tolist(), ones.tolist(), n.tolist(), strict=True):
        pools.append([p * m, k, m])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    return np.array([p / m for p, _, m in pools]), np.array([k / m for _, k, m in pools])


@dataclass
class Model:
    features: Features | None
    weights: np.ndarray
    at: np.ndarray
    share: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.features(x) @ self.weights / UNIT, *RANGE)

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.features is None:
            return np.full(len(x), 0.5)
        return np.interp(self.raw(x), self.at, self.share)


def _numbers(batch: pa.RecordBatch, first: int) -> np.ndarray:
    return values([batch.column(k).to_numpy(zero_copy_only=False).astype(float) for k in range(first, first + len(STATS))])


def normal_equations(rows: DataFrame, features: Features) -> tuple[np.ndarray, np.ndarray]:
    """Sums over `rows` (quality, STATS). A partition gives a row for each pair of features; Spark adds them up."""
    upper = np.triu_indices(WIDTH + 1)
    schema = pa.schema([("place", pa.int32()), ("total", pa.int64())])

    @common.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, target = np.zeros((WIDTH + 1, WIDTH + 1)), np.zeros(WIDTH + 1)
        for batch in batches:
            if batch.num_rows:
                z, y = features(_numbers(batch, 1)), batch.column(0).to_numpy().astype(float)
                gram += z.T @ z
                target += z.T @ y
        sums = np.concatenate([gram[upper], target])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums)), pa.int32()), pa.array(sums.astype(np.int64))], schema=schema)

    # WIDTH squared rows in all, whatever the corpus
    found = rows.select("quality", *STATS).mapInArrow(run, "place int, total long").groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    sums = np.zeros(len(upper[0]) + WIDTH + 1)
    for r in found:
        sums[r.place] = float(r.total)
    gram = np.zeros((WIDTH + 1, WIDTH + 1))
    gram[upper] = sums[: len(upper[0])]
    gram = gram + gram.T - np.diag(np.diag(gram))
    return gram / UNIT**2, sums[len(upper[0]) :] / UNIT


def labelled(stats: DataFrame, labels: DataFrame, held_out: int = 1) -> DataFrame:
    """doc_id, quality, part (3: for calibration), STATS of rows that may be learned from."""
    agreed = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
    agreed = agreed.filter((F.col("quality") == F.col("most")) & (bucket() != held_out)).select("doc_id", F.col("quality").cast("int").alias("quality"))
    return stats.join(agreed, "doc_id").select("doc_id", "quality", F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(4)).alias("part"), *STATS)


def train(stats: DataFrame, labels: DataFrame, held_out: int = 1) -> Model:
    rows = common.staged(labelled(stats, labels, held_out), "labelled")
    counts = {r.quality: r.n for r in rows.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    nothing = np.zeros(WIDTH + 1)
    if not counts:
        return Model(None, nothing, np.zeros(1), np.full(1, 0.5))
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", *STATS, F.lit(14)), 11) / float(1 << 53)
    sample = rows.filter(draw < min(1.0, SAMPLE / sum(counts.values()))).select(draw.alias("draw"), *STATS).orderBy("draw", *STATS).limit(2 * SAMPLE).collect()
    if not sample:  # a few rows may all be drawn high
        sample = rows.select(draw.alias("draw"), *STATS).orderBy("draw", *STATS).limit(2 * SAMPLE).collect()
    features = Features.of(values([np.array([r[s] for r in sample], float) for s in STATS]))
    if len(counts) == 1:
        return Model(features, nothing, np.zeros(1), np.full(1, float(next(iter(counts)))))
    seen = rows.filter("part <> 3")
    if seen.select("quality").distinct().count() < 2 or rows.filter("part = 3").isEmpty():  # a few rows: all serve for both
        seen = unseen = rows
    else:
        unseen = rows.filter("part = 3")
    weights = solve(*normal_equations(seen, features))
    model = Model(features, weights, np.zeros(1), np.zeros(1))
    schema = pa.schema([("step", pa.int32()), ("quality", pa.int32())])

    @common.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = np.floor((model.raw(_numbers(batch, 1)) - RANGE[0]) / (RANGE[1] - RANGE[0]) * STEPS)
            yield pa.RecordBatch.from_arrays([pa.array(step.astype(np.int32)), batch.column(0)], schema=schema)

    steps = unseen.select("quality", *STATS).mapInArrow(run, "step int, quality int").groupBy("step").agg(F.sum("quality").alias("ones"), F.count("*").alias("n")).orderBy("step").collect()  # STEPS + 1 rows at most
    position = (np.array([r.step for r in steps]) + 0.5) / STEPS * (RANGE[1] - RANGE[0]) + RANGE[0]
    model.at, model.share = pooled(position, np.array([r.ones for r in steps]), np.array([r.n for r in steps]))
    return model


def score(stats: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of every row, from its statistics alone."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    @common.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(_numbers(batch, 1)))], schema=schema)

    return stats.select("doc_id", *STATS).mapInArrow(run, "doc_id long, score double")


def judge(docs: DataFrame, labels: DataFrame, held_out: int = 1) -> tuple[DataFrame, Model]:
    """doc_id, score of every row of `docs`; and the model."""
    stats = common.staged(quality.statistics(docs), "statistics")
    model = train(stats, labels, held_out)
    return score(stats, model), model


def digests(scored: DataFrame, held_out: int = 1) -> DataFrame:
    return scored.select("doc_id", (bucket() == held_out).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
