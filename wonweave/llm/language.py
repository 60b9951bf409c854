"""Operator 7: language identification with a string kernel.

Blended-spectrum presence kernel: texts share what character n-grams of 1 to ORDERS letters
both have, divided by the geometric mean of how many each has. Nyström landmarks, drawn from
the training texts, turn it into features; kernel ridge regression of one language against the
rest scores them. Presence is held in 2**HASH_BITS hashed places; a batch of texts is scored by
matrix products. Letters are lower-cased, everything else is a space.

Training rows are a bounded sample: about TRAIN_ROWS in all and never over twice as many, about
as many of each language, by a hash of doc_id (of the text where that is null). Whole texts of
any length are used in training and scoring.

A text that is null or has no letter is `und` with score 0, and so is every text if nothing
can be learned. Ties go to the first language in order. Repeated rows each return; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wonweave.llm import common

ORDERS, HASH_BITS = 3, 14
PLACES = 1 << HASH_BITS
TRAIN_ROWS, LANDMARKS = 6000, 160
RIDGE, SHARPNESS = 1.0, 4.0
#: Texts in a matrix.
BATCH = 192

_FOLD: list[np.ndarray] = []


def _fold() -> np.ndarray:
    """Code point to lower-case letter, or a space."""
    if not _FOLD:
        table = np.full(0x110000, 32, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                table[i] = ord(low) if len(low) == 1 else i
        _FOLD.append(table)
    return _FOLD[0]


def presence(texts: list[str | None]) -> np.ndarray:
    """Booleans, a row for each text and a column for each place."""
    out = np.zeros(len(texts) * PLACES, bool)
    sizes = np.array([len(t) if t else 0 for t in texts], np.int64)
    points = _fold()[np.frombuffer("".join(t or "" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)]
    row = np.repeat(np.arange(len(texts), dtype=np.int64), sizes)
    h, letter = np.zeros(len(points), np.uint64), np.zeros(len(points), bool)
    for n in range(1, ORDERS + 1):
        if len(points) < n:
            break
        # n-grams that begin at each place; those over two texts, or without a letter, don't count
        h = h[: len(points) - n + 1] * np.uint64(0x100000001B3) + (points[n - 1 :] + np.uint64(n)).astype(np.uint64)
        letter = letter[: len(h)] | (points[n - 1 :] != 32)
        ok = letter & (row[: len(h)] == row[n - 1 :])
        place = ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - HASH_BITS)).astype(np.int64)
        out[(row[: len(h)] * PLACES + place)[ok]] = True
    return out.reshape(len(texts), PLACES)


def has_letter(found: np.ndarray) -> np.ndarray:
    return found.any(axis=1)


class Classifier:
    def __init__(self, languages: list[str], landmarks: np.ndarray, weights: np.ndarray):
        self.languages, self.landmarks, self.weights = languages, landmarks, weights
        self.sizes = np.sqrt(np.maximum(landmarks.sum(axis=1), 1)).astype(np.float32)
        self.columns = np.ascontiguousarray(landmarks.T.astype(np.float32))

    def kernel(self, found: np.ndarray) -> np.ndarray:
        out = np.empty((len(found), len(self.sizes)), np.float32)
        for i in range(0, len(found), BATCH):
            part = found[i : i + BATCH]
            own = np.sqrt(np.maximum(part.sum(axis=1), 1)).astype(np.float32)
            out[i : i + BATCH] = (part.astype(np.float32) @ self.columns) / own[:, None] / self.sizes
        return out

    def scores(self, found: np.ndarray) -> np.ndarray:
        return self.kernel(found).astype(np.float64) @ self.weights

    @classmethod
    def fit(cls, found: np.ndarray, labels: list[str]) -> Classifier:
        languages = sorted(set(labels))
        which = np.array([languages.index(x) for x in labels])
        # landmarks: the same number of each language, in order of the sample
        picked = np.concatenate([np.flatnonzero(which == k)[: max(1, LANDMARKS // len(languages))] for k in range(len(languages))])
        model = cls(languages, found[picked], np.zeros((len(picked), len(languages))))
        base = model.kernel(found[picked]).astype(np.float64)
        values, vectors = np.linalg.eigh((base + base.T) / 2)
        root = vectors / np.sqrt(np.maximum(values, 1e-6))
        features = model.kernel(found).astype(np.float64) @ root
        targets = np.where(which[:, None] == np.arange(len(languages)), 1.0, -1.0)
        # every language weighs the same
        weight = 1.0 / np.bincount(which, minlength=len(languages))[which]
        weight *= len(which) / weight.sum()
        gram = features.T @ (features * weight[:, None]) + RIDGE * np.eye(features.shape[1])
        model.weights = root @ np.linalg.solve(gram, features.T @ (targets * weight[:, None]))
        return model


def bucket() -> Column:
    """crc32 of doc_id as text, modulo 4; 0 without one."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4, F.lit(0))


def train(docs: DataFrame, held_out: int = 2) -> Classifier | None:
    """Learns from text and lang of the rows that aren't held out."""
    rows = docs.filter((bucket() != held_out) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    each = max(20, TRAIN_ROWS // len(counts))
    draw = common.draw(F.coalesce(F.col("doc_id").cast("string"), F.col("text")), 7)
    part = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, min(1.0, each / n))])
    sampled = rows.filter(draw < F.element_at(part, F.col("lang"))).select(draw.alias("draw"), "lang", "text")
    # rows of one doc_id are drawn together: one of each stays, so that the sample is as large as it says
    sampled = sampled.groupBy("draw").agg(F.min(F.struct("lang", "text")).alias("r")).select("draw", "r.lang", "r.text")
    schema = pa.schema([("draw", pa.float64()), ("lang", pa.string()), ("found", pa.binary())])

    def work(columns: list[list]) -> list:
        out = []
        for i in range(0, len(columns[2]), BATCH):
            out += [np.packbits(x).tobytes() for x in presence(columns[2][i : i + BATCH])]
        return [columns[0], columns[1], out]

    # PLACES bits a row, about TRAIN_ROWS rows and never over twice as many, whatever the corpus
    got = sampled.mapInArrow(common.by_slice(schema, work), "draw double, lang string, found binary").orderBy("draw").limit(2 * TRAIN_ROWS).collect()
    got = sorted((r.draw, r.lang, bytes(r.found)) for r in got)
    if not got:
        return None
    found = np.unpackbits(np.frombuffer(b"".join(x for *_, x in got), np.uint8).reshape(len(got), -1), axis=1).view(bool)
    ok = has_letter(found)
    labels = [lang for (_, lang, _), k in zip(got, ok, strict=True) if k]
    return Classifier.fit(found if ok.all() else found[ok], labels) if labels else None


class _Scorer:
    """On an executor: language and score of texts."""

    def __init__(self, docs: DataFrame, model: Classifier | None):
        # LANDMARKS texts of PLACES bits, whatever the corpus
        self.shared = docs.sparkSession.sparkContext.broadcast(model and (model.languages, np.packbits(model.landmarks, axis=1), model.weights))
        self.model: Classifier | None = None

    def __call__(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        if self.shared.value is None:
            return ["und"] * len(texts), [0.0] * len(texts)
        if self.model is None:
            languages, bits, weights = self.shared.value
            self.model = Classifier(languages, np.unpackbits(bits, axis=1).view(bool), weights)
        langs, scores = [], []
        for i in range(0, len(texts), BATCH):
            found = presence(texts[i : i + BATCH])
            s = self.model.scores(found)
            best = s.argmax(axis=1)
            p = 1 / np.exp(SHARPNESS * (s - s.max(axis=1, keepdims=True))).sum(axis=1)
            for k, b, x in zip(has_letter(found), best, p, strict=True):
                langs.append(self.model.languages[b] if k else "und")
                scores.append(float(x) if k else 0.0)
        return langs, scores


def predict(docs: DataFrame, model: Classifier | None, key: str = "doc_id") -> DataFrame:
    """`key`, lang_pred, score of every row, from its text alone."""
    schema = pa.schema([(key, pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
    score = _Scorer(docs, model)
    return docs.select(F.col(key).cast("long").alias(key), "text").mapInArrow(common.by_slice(schema, lambda c: [c[0], *score(c[1])]), f"`{key}` long, lang_pred string, score double")


def digests(docs: DataFrame, model: Classifier | None) -> DataFrame:
    return predict(docs, model).select("doc_id", (bucket() == 2).alias("held_out"), "lang_pred", "score")


def drop_unknown(docs: DataFrame, held_out: int = 2) -> DataFrame:
    """The rows whose text isn't `und`, with all their columns; where nothing can be learned, the rows with a letter."""
    from pyspark.sql.pandas.types import to_arrow_type

    model = train(docs, held_out)
    score, learned = _Scorer(docs, model), model is not None

    def known(texts: list[str | None]) -> list[bool]:
        if learned:
            return [x != "und" for x in score(texts)[0]]
        return [bool(k) for i in range(0, len(texts), BATCH) for k in has_letter(presence(texts[i : i + BATCH]))]

    schema = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in docs.schema])
    at = docs.columns.index("text")

    @common.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keep, lo, size = batch.column(at).to_pylist(), [], 0, 0
            for hi in range(1, len(texts) + 1):
                size += len(texts[hi - 1] or "")
                if size > common.SLICE_BYTES or hi == len(texts):
                    keep += known(texts[lo:hi])
                    lo, size = hi, 0
            yield batch.filter(pa.array(keep, pa.bool_())).cast(schema)

    return docs.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema))
