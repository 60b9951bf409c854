"""Hard negatives against brute force: ties, repeats, nulls, hot vectors, short vectors, large numbers."""

import math

import cases
import numpy as np
import pytest

from wonweave.llm import negatives

COLUMNS = "vec_id long, embedding array<float>, label int, uid string, slice int, cells string"


def brute(rows, every=100):
    most = negatives.LARGEST
    kept = []
    for vec_id, x, label, *_ in rows:
        if vec_id is None or x is None or label is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        whole = [int(max(min(math.floor(256 * float(np.float32(v))), most), -most)) for v in x]
        kept.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, whole))
    out = []
    for i, (a, label, x) in enumerate(kept):
        if a % every:
            continue
        scored = [(-sum(p * q for p, q in zip(x, y)), v, k, other) for k, (v, other, y) in enumerate(kept) if k != i]  # noqa: B905
        for p, pid, _, _ in sorted(s for s in scored if s[3] == label)[:5]:
            fits = sorted(s for s in scored if s[3] != label and -80 * p <= -100 * s[0] <= -100 * p)
            out += [(a, pid, r, n, -p, -s) for r, (s, n, *_) in enumerate(fits[:5], 1)]
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, x, lab, "u", 1, "c") for i, x, lab in rows], COLUMNS)


def vectors(seed, n, dims=8, spread=0.2):
    rng = np.random.default_rng(seed)
    return [(i, [float(np.float32(v)) for v in rng.normal(0, spread, dims)], int(rng.integers(0, 4))) for i in range(n)]


def hot(seed, n):
    """A third of all rows are one vector, some are rows of a grid with many ties."""
    rows = vectors(seed, n)
    rng = np.random.default_rng(seed)
    return [(i, [0.5] * 8, 1 + (i % 5 == 0)) if i % 3 == 0 else (i, [float(v) for v in rng.integers(0, 3, 8) / 4], lab) if i % 7 == 1 else (i, x, lab) for i, x, lab in rows]


AWKWARD = [
    (0, [0.5, 0.25], 1), (0, [0.5, 0.25], 1), (1, [0.5, 0.25], 1), (2, None, 1), (3, [0.5, None], 1), (4, [0.5, float("nan")], 2), (5, [float("inf"), 0.1], 2), (6, [0.4, 0.4], None), (7, [0.4, 0.4], 9), (None, [0.4, 0.4], 2), (8, [], 2), (9, [0.5], 2), (10, [0.5, 0.2, 0.9], 3),
    (11, [3e38, 0.1], 4), (12, [-3e38, 0.1], 1), (100, [0.3, 0.3, 0.3], 2), (200, [], 1), (300, [3e38, 3e38], 4), (14, [0.5, 0.2], 4), (13, [0.5, 0.25], 2), (400, [-0.5, -0.2], 2),
]


@pytest.mark.parametrize("rows", [vectors(1, 1500), hot(2, 1300), AWKWARD, AWKWARD + hot(3, 400), [], [(1, [0.1], 1)], [(100, [0.1], 1)]], ids=["plain", "hot", "awkward", "both", "empty", "no-anchor", "alone"])
def test_mine(spark, monkeypatch, rows):
    for name, value in (("LEAST_SLICE", 100), ("GROUP", 3), ("TILE", 64), ("BAND", 2)):
        monkeypatch.setattr(negatives, name, value)
    got = negatives.mine(frame(spark, rows))
    assert cases.in_order(got) == brute(rows) and got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_few_rows_are_scored_exactly():
    """Of unlike vectors, most never get past their bounds; all of them count."""
    rng = np.random.default_rng(4)
    x = np.floor(256 * rng.normal(0, 0.125, (20_000, 32))).astype(np.int64)
    label = rng.integers(0, 10, len(x))
    cells = negatives.Cells.learn(x[:4000], x.min(axis=0), x.max(axis=0))
    low, high = cells.bounds(cells.of(x))
    assert (low <= x).all() and (x <= high).all()
    anchors, uid = np.arange(50), np.arange(len(x))
    scores = x[:50] @ x.T
    fits = (label[:50, None] == label) & (anchors[:, None] != uid)
    near = negatives.Cell(cells, anchors, label[:50], x[:50], None)
    first = np.sort(np.where(fits, scores, -(10**9)), axis=1)[:, : -negatives.TOP - 1 : -1]
    far = negatives.Cell(cells, anchors, label[:50], x[:50], first)
    for cell in (near, far):
        for i in range(0, len(x), 2000):
            part = slice(i, i + 2000)
            cell.tile(cells.bounds(cells.of(x[part])), uid[part], uid[part], label[part], x[part])
        assert cell.seen == 50 * len(x) and cell.scored < 0.05 * cell.seen
    assert (near.best.score.reshape(50, negatives.TOP) == first).all()
    for a in range(50):
        for w, p in enumerate(first[a]):
            ok = (label != label[a]) & (100 * scores[a] >= 80 * p) & (scores[a] <= p)
            assert far.best.score[far.best.window == a * negatives.TOP + w].tolist() == sorted(scores[a][ok], reverse=True)[: negatives.TOP]


def test_borders_and_extreme_numbers():
    x = np.array([[negatives.LARGEST, -3], [-negatives.LARGEST, 0], [0, 5]], np.int64)
    for sample in (x, x[:0], x[:1]):
        cells = negatives.Cells.learn(sample, x.min(axis=0), x.max(axis=0))
        low, high = cells.bounds(cells.of(x))
        assert (low <= x).all() and (x <= high).all()
