"""Near copies: one row of each group stays, whatever its doc_id."""

import cases
import numpy as np
import pytest

import corpus_pipeline
from wonweave.llm import near, simhash


@pytest.mark.parametrize("shared", [None, 15])
def test_a_shared_doc_id_loses_no_group(spark, shared):
    rows = [(shared, cases.prose(100 + i, 40), "en", "a") for i in range(30)] + [(shared, cases.prose(100, 40), "de", "b")] * 3 + [(7, cases.prose(101, 40), "fr", "c")]
    docs = cases.docs(spark, rows).repartition(3)
    kept = near.keep_one(docs)
    assert kept.columns == docs.columns
    want = sorted([(shared, t) for i, t, *_ in rows[:30] if t != rows[-1][1]] + [(min(7, shared or 7), rows[-1][1])], key=str)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == want


@pytest.mark.parametrize("small,block,rounds", [(32, 1024, 2), (2, 8, 0), (3, 5, 1)])
def test_stage_finds_all_pairs_of_five_words(spark, monkeypatch, small, block, rounds):
    """Copies of ever more changed words, chains, a dense group, a shared passage, and short texts."""
    for name, value in (("SMALL", small), ("BLOCK", block), ("ROUNDS", rounds), ("TILE", 3 if small < 32 else 256)):
        monkeypatch.setattr(near, name, value)
    rng = np.random.default_rng(4)
    texts = []
    for k in range(8):
        words = cases.prose(200 + k, 60 + 40 * k).split()
        texts.append(" ".join(words))
        for m in range(1, 7):
            copy = list(words)
            for at in rng.choice(len(words), m, replace=False):
                copy[at] = f"new{k}x{m}x{at}"
            texts.append(" ".join(copy))
    dense = cases.prose(300, 120).split()
    texts += [" ".join([*dense[:at], f"odd{at}", *dense[at + 1 :]]) for at in range(60)]
    texts += [cases.SHARED + f" tail{i} " + cases.prose(400 + i, 12 + i) for i in range(25)]
    texts += ["one two", "ONE two", "one two three", "a b c d e", "a b c d e f", None, ""]
    rows = list(enumerate(texts))
    docs = cases.docs(spark, [(i, t, "en", "a") for i, t in rows]).repartition(3)
    got = sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect())
    assert got == sorted(i for i, _ in cases.near_survivors(rows))
    assert near.keep_one(docs.limit(0)).count() == 0


def test_simhash_alone_is_not_whole(spark):
    """Why the stage completes operator 6's links: some texts of similarity 0.8 differ in more bits than can be probed."""
    words = cases.prose(500, 100).split()
    apart = [simhash.fingerprint(" ".join(words), 5) ^ simhash.fingerprint(" ".join([*words[:at], "other", *words[at + 1 :]]), 5) for at in range(10, 90, 4)]
    assert any(x.bit_count() > near.BITS_APART for x in apart)


def test_texts_that_share_doc_ids_all_stay(spark):
    """Seven rows of six texts under repeated and null ids: each text stays once."""
    t = [cases.prose(600 + i, 30) for i in range(6)]
    rows = [(3, t[0]), (15, t[0]), (15, t[1]), (None, t[2]), (None, t[3]), (20, t[4]), (20, t[5])]
    got = near.keep_one(cases.docs(spark, [(i, x, "en", "a") for i, x in rows])).collect()
    assert sorted(r.text for r in got) == sorted(t) and {r.doc_id for r in got if r.text == t[0]} == {3}


@pytest.mark.parametrize("seed", range(4))
def test_blocks_join_what_is_similar_and_nothing_else(seed):
    rng = np.random.default_rng(seed)
    base = [np.unique(rng.integers(-(2**62), 2**62, 120)) for _ in range(3)]
    sets = []
    for k in range(60):
        s = base[k % 3].copy()
        s[rng.choice(len(s), int(rng.integers(0, 30)), replace=False)] = rng.integers(-(2**62), 2**62)
        sets.append(np.unique(np.concatenate([s[: len(s) - int(rng.integers(0, 10))], rng.integers(-(2**62), 2**62, int(rng.integers(0, 20)))])))
    roots = [int(rng.integers(0, 40)) for _ in sets]
    near_by = lambda a, b: 9 * len(np.intersect1d(a, b)) >= 4 * (len(a) + len(b))

    def groups(links):
        group = dict(zip(range(60), (1000 + r for r in roots), strict=True))
        for u, v in links:
            old, new = group[u], group[v]
            group = {x: new if g == old else g for x, g in group.items()}
        return {frozenset(x for x in group if group[x] == g) for g in group.values()}

    rows = [(k, 1000 + roots[k], sets[k]) for k in range(60)]
    found = list(near.joining(rows, None))
    assert all(near_by(sets[u], sets[v]) for u, v in found) and len(found) < 60
    assert groups(found) == groups([(i, j) for i in range(60) for j in range(i) if near_by(sets[i], sets[j])])
    across = list(near.joining(rows[:25], rows[25:]))
    assert groups(across) == groups([(i, j) for i in range(25) for j in range(25, 60) if near_by(sets[i], sets[j])])


def test_unlike_copies_do_not_become_pairs(spark, monkeypatch):
    """Texts that all share most of their words, but not enough: what is written stays in proportion to them."""
    words = cases.prose(700, 90).split()
    rng = np.random.default_rng(7)
    texts = []
    for k in range(150):
        copy = list(words)
        for at in rng.choice(len(words), 7, replace=False):
            copy[at] = f"own{k}x{at}"
        texts.append(" ".join(copy))
    made, whole = [], near._verified
    monkeypatch.setattr(near, "_verified", lambda pairs, sets: (made.append(pairs.count()), whole(pairs, sets))[1])
    rows = list(enumerate(texts))
    got = near.keep_one(cases.docs(spark, [(i, t, "en", "a") for i, t in rows]))
    assert sorted(r.doc_id for r in got.collect()) == sorted(i for i, _ in cases.near_survivors(rows))
    assert sum(made) < 40 * len(texts) < 150 * 149 // 2
