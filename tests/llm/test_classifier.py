"""The quality classifier against plain versions, on rows that it hasn't learned from, and with every awkward case."""

import math
import zlib

import cases
import numpy as np
import pytest

from wonweave.llm import classifier, quality

LABELS = "doc_id long, quality int, toxic int"


def test_cosines_approximate_the_gaussian_kernel(monkeypatch):
    monkeypatch.setattr(classifier, "WIDTH", 8192)
    rng = np.random.default_rng(1)
    x = rng.normal(2, 3, (40, len(classifier.STATS)))
    f = classifier.Features.of(x)
    z = f(x)[:, :-1] / classifier.UNIT
    scaled = (x - x.mean(axis=0)) / x.std(axis=0)
    for i in range(40):
        for j in range(40):
            want = math.exp(-sum((scaled[i] - scaled[j]) ** 2) / (2 * f.width**2))
            assert abs(2 / classifier.WIDTH * float(z[i] @ z[j]) - want) < 0.08


def test_normal_equations_and_ridge(spark):
    rng = np.random.default_rng(2)
    x, y = rng.random((300, len(classifier.STATS))) * 4, rng.integers(0, 2, 300)
    features = classifier.Features.of(classifier.values(list(x.T)))
    frame = spark.createDataFrame([(int(q), *map(float, r)) for q, r in zip(y, x, strict=True)], f"quality int, {', '.join(f'{s} double' for s in classifier.STATS)}")
    gram, target = classifier.normal_equations(frame.repartition(7), features)
    again = classifier.normal_equations(frame.coalesce(1), features)
    assert (gram == again[0]).all() and (target == again[1]).all()
    z = features(classifier.values(list(x.T))) / classifier.UNIT
    plain = np.zeros((classifier.WIDTH + 1, classifier.WIDTH + 1))
    for row in z:
        plain += np.outer(row, row)
    assert np.allclose(gram, plain) and np.allclose(target, z.T @ y)
    w = classifier.solve(gram, target)
    # the ridge's gradient is zero, as of a least-squares problem with a row more for each weight but the constant
    least = np.sqrt(classifier.RIDGE * np.trace(plain) / len(plain))
    more = np.diag([least] * classifier.WIDTH + [0.0])
    assert np.allclose(np.concatenate([z, more]) @ w, np.concatenate([z, more]) @ np.linalg.lstsq(np.concatenate([z, more]), np.concatenate([y, np.zeros(len(more))]), rcond=None)[0], atol=1e-6)


@pytest.mark.parametrize("seed", range(6))
def test_pools_by_the_min_max_formula(seed):
    rng = np.random.default_rng(seed)
    n, at = rng.integers(1, 6, 25), np.arange(25.0)
    ones = np.array([rng.binomial(m, min(0.9, 0.1 + k / 30)) for k, m in enumerate(n)])
    where, share = classifier.pooled(at, ones, n)
    fitted = [max(min(ones[i : j + 1].sum() / n[i : j + 1].sum() for j in range(k, 25)) for i in range(k + 1)) for k in range(25)]
    assert sorted(set(np.round(fitted, 9))) == list(np.round(share, 9)) and (np.diff(share) > 0).all() and (np.diff(where) > 0).all()
    for w, s in zip(where, share, strict=True):
        mine = np.isclose(fitted, s)
        assert w == pytest.approx((at * n)[mine].sum() / n[mine].sum())


def corpus(n=900):
    rng = np.random.default_rng(8)
    bad = rng.random(n) < 0.3
    texts = [" ".join(w + ("###" if b and k % 2 else "") for k, w in enumerate(cases.prose(1000 + i, 40).split())) for i, b in enumerate(bad)]
    return bad, texts


def test_end_to_end(spark):
    """Scores of held-out rows tell good from bad; they don't depend on partitions, labels of held-out rows, lang, source or doc_id."""
    bad, texts = corpus()
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)]
    docs = cases.docs(spark, rows + [(5, texts[5], "en", "a"), (2000, None, None, None), (2001, "", "en", "a"), (None, texts[3], "de", "b"), (2002, "x" * 200_000, "en", "a")])
    labels = [(i, int(not bad[i]), 0) for i in range(900)]
    odd = [(0, int(bad[0]), 0), (None, 0, 0), (1, None, 0), (1, None, 1), (7000, 1, 0), (3, 2, 0)]
    got = classifier.digests(classifier.judge(docs.repartition(5), spark.createDataFrame(labels + odd, LABELS))[0])
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and dict(got.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    out = got.collect()
    assert len(out) == 905 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    held = [r for r in out if r.held_out and r.doc_id is not None and r.doc_id < 900]
    assert {r.doc_id for r in held} == {i for i in range(900) if zlib.crc32(str(i).encode()) % 3 == 1} and np.mean([r.predicted == (not bad[r.doc_id]) for r in held]) > 0.97
    assert len({r.score for r in out if r.doc_id in (2000, 2001)}) == 1 and not next(r for r in out if r.doc_id is None).held_out
    # other labels of held-out rows, other doc_ids of what is scored, other partitions: the same scores
    turned = [(i, q if zlib.crc32(str(i).encode()) % 3 != 1 else 1 - q, 0) for i, q, _ in labels]
    again, model = classifier.judge(docs.coalesce(1), spark.createDataFrame(turned + odd, LABELS))
    assert sorted(r.score for r in again.collect()) == pytest.approx(sorted(r.score for r in out), abs=1e-9)
    moved = classifier.score(quality.statistics(cases.docs(spark, [(i + 5000, t, "xx", "z") for i, t in enumerate(texts)])), model).collect()
    assert {r.doc_id - 5000: r.score for r in moved} == pytest.approx({r.doc_id: r.score for r in out if r.doc_id is not None and r.doc_id < 900}, abs=1e-9)


def test_little_or_nothing_to_learn_from(spark):
    _, texts = corpus(30)
    docs = cases.docs(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    learn = [i for i in range(30) if zlib.crc32(str(i).encode()) % 3 != 1]
    scores = lambda rows: {r.score for r in classifier.judge(docs, spark.createDataFrame(rows, LABELS))[0].collect()}
    assert scores([]) == {0.5} and scores([(i, 0, 0) for i in range(30) if i not in learn]) == {0.5}
    assert scores([(i, 1, 0) for i in learn]) == {1.0} and scores([(learn[0], 0, 0)]) == {0.0}
    assert all(0 <= s <= 1 for s in scores([(learn[0], 0, 0), (learn[1], 1, 0)]))
    assert classifier.digests(classifier.judge(cases.docs(spark, []), spark.createDataFrame([(1, 1, 0)], LABELS))[0]).collect() == []
