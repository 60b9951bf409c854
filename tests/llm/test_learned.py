"""The learned operators against plain versions, and on rows that they haven't learned from."""

import cases
import numpy as np

from wonweave.llm import language, quality


def grams(text):
    """Letters in lower case, all else a space; n-grams of 1 to ORDERS with a letter in them."""
    s = "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text)
    return {s[i : i + n] for n in range(1, language.ORDERS + 1) for i in range(len(s) - n + 1) if s[i : i + n].strip()}


def test_kernel_and_ridge_by_plain_loops():
    rng = np.random.default_rng(6)
    parts = {"x": ["ka", "ro", "mi"], "y": ["sch", "ung", "ei"]}
    texts = [" ".join("".join(rng.choice(parts[lang], 3)) for _ in range(6)) for lang in "xy" * 20]
    labels, new = list("xy" * 20), ["karomi mika", "SCHUNG ei!", "ro sch"]
    model = language.Classifier.fit(language.presence(texts), labels)
    sets = [grams(t) for t in texts]
    # landmarks: the first of each language
    each = max(1, language.LANDMARKS // 2)
    landmarks = [s for lang in "xy" for s in [g for g, of in zip(sets, labels, strict=True) if of == lang][:each]]
    kernel = lambda a, b: len(a & b) / np.sqrt(len(a) * len(b))
    rows = lambda found: np.array([[kernel(a, b) for b in landmarks] for a in found])
    assert np.allclose(model.kernel(language.presence(texts)), rows(sets), atol=0.02)  # two n-grams may share a hashed place
    values, vectors = np.linalg.eigh(rows(landmarks))
    root = vectors / np.sqrt(np.maximum(values, 1e-6))
    features = rows(sets) @ root
    left, right = language.RIDGE * np.eye(len(landmarks)), np.zeros((len(landmarks), 2))
    for f, lang in zip(features, labels, strict=True):  # both languages have as many rows, so all weigh the same
        left += np.outer(f, f)
        right += np.outer(f, [1.0 if lang == x else -1.0 for x in "xy"])
    want = rows([grams(t) for t in new]) @ root @ np.linalg.solve(left, right)
    got = model.scores(language.presence(new))
    assert np.allclose(got, want, atol=0.1) and got[:2].argmax(axis=1).tolist() == [0, 1]


def test_samples_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(language, "TRAIN_ROWS", 5)
    docs = cases.docs(spark, [(i, cases.prose(i, 20), "en", "a") for i in range(300)])
    held = []
    monkeypatch.setattr(language.Classifier, "fit", classmethod(lambda cls, found, labels: held.append(len(labels))))
    language.train(docs)
    assert held and held[0] <= 10


def test_quality_end_to_end(spark):
    """Labels of two thirds; the rest is held out. Labels of one document that disagree, and nulls, don't count."""
    rng = np.random.default_rng(8)
    bad = rng.random(600) < 0.4
    texts = [" ".join(w + ("###" if b and k % 2 else "") for k, w in enumerate(cases.prose(1000 + i, 60).split())) for i, b in enumerate(bad)]
    docs = cases.docs(spark, [(i, t, "en", "a") for i, t in enumerate(texts)] + [(700, None, "en", "a"), (701, "few words", "en", "a")])
    rows = [(i, int(not bad[i]), 0) for i in range(400)] + [(0, int(bad[0]), 0), (None, 0, 0), (1, None, 0)]
    judged, rules = quality.judge(docs, spark.createDataFrame(rows, "doc_id long, quality int, toxic int"))
    got = {r.doc_id: r for r in judged.collect()}
    assert rules and np.mean([got[i].kept == (not bad[i]) for i in range(400, 600)]) > 0.98
    assert not got[700].kept and not got[701].kept and got[701].base_failed
    x = {s: np.array([got[i][s] for i in range(600)], float) for s in quality.TESTED}
    verdicts = [next((k for k, rule in enumerate(rules) if quality._covers(rule, {s: v[i : i + 1] for s, v in x.items()})[0]), None) for i in range(600)]
    assert [got[i].rule for i in range(600)] == verdicts
