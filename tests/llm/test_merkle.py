"""The manifest against a brute-force tree, with every awkward case."""

import zlib

import cases
import pytest

from wonweave.llm import merkle


def leaf(row, more=0):
    values = [row[0], row[3], row[2], row[4], row[1]]  # doc_id, source, lang, n_chars, text
    if more and values[3] is not None:
        values[3] += 1
    return cases.sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes, fan_out):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([cases.sha("".join(out[-1][i : i + fan_out])) for i in range(0, len(out[-1]), fan_out)])
    return out


def way(tree, at, fan_out):
    """(own place, the others of the run) at each level."""
    for nodes in tree[:-1]:
        run = nodes[at - at % fan_out : at - at % fan_out + fan_out]
        yield at % fan_out, run[: at % fan_out] + run[at % fan_out + 1 :]
        at //= fan_out


def brute(rows, fan_out):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    ordered = {g: sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for g in names}
    trees = {g: levels([leaf(r) for r in ordered[g]], fan_out) for g in names}
    top = levels([trees[g][-1][0] for g in names], fan_out)
    out = []
    for k, g in enumerate(names):
        for i, r in enumerate(ordered[g]):
            steps = [*way(trees[g], i, fan_out), *way(top, k, fan_out)]
            h = leaf(r, r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0)
            for place, others in steps:
                h = cases.sha("".join([*others[:place], h, *others[place:]]))
            out.append((r[0], leaf(r), trees[g][-1][0], top[-1][0], cases.sha("".join("".join(o) for _, o in steps)), h, h == top[-1][0]))
    return sorted(out, key=str)


def many():
    """Trees of 1, 2, 3, 5, 64 and 200 leaves, and one without a lang; a third of all rows are one row."""
    sizes = {"a": 1, "b": 2, "ab": 3, "ß": 5, "z": 64, "\U00010000": 200, None: 9, "": 7}
    rows = [(100 * k + i, f"text {k} {i}", g, "s", i if i % 5 else None) for k, (g, n) in enumerate(sizes.items()) for i in range(n)]
    return rows + [(7, "same", "z", None, 2**63 - 1)] * 140 + [(None, None, None, None, None), (None, "", "z", "", 0), (3, "x" * 300_000, "z", "s", 1)]


@pytest.mark.parametrize("fan_out,span", [(2, 1024), (2, 4), (3, 9), (5, 3)])
def test_audit(spark, monkeypatch, fan_out, span):
    monkeypatch.setattr(merkle, "SPAN", span)
    rows = many()
    docs = spark.createDataFrame([(*r, "k", 1, 2, ["w"]) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, hash string, tree long, level int, idx array<string>").repartition(5)
    m = merkle.write(docs, fan_out)
    assert cases.in_order(merkle.audit(m)) == brute(rows, fan_out)


def test_documents(spark):
    docs = cases.docs(spark)
    rows = [(i, t, lang, s, len(t or "")) for i, t, lang, s in cases.DOCS]
    got = merkle.audit(merkle.write(docs))
    assert cases.in_order(got) == brute(rows, 2) and got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_proofs_lead_to_the_root_and_can_be_asked_for(spark):
    m = merkle.write(spark.createDataFrame(many(), "doc_id long, text string, lang string, source string, n_chars long"), 3)
    asked = m.items.filter("doc_id % 10 = 3")
    got = merkle.proofs(m, asked).collect()
    assert len(got) == asked.count() > 10
    assert all(merkle.folded(r.leaf, r.idx, r.n, r.tree, r.proof, 3) == m.root and merkle.folded(cases.sha("x"), r.idx, r.n, r.tree, r.proof, 3) != m.root for r in got)


def test_empty_and_single(spark):
    docs = cases.docs(spark, [])
    m = merkle.write(docs)
    assert m.root is None and merkle.audit(m).collect() == [] and merkle.proofs(m).collect() == []
    (one,) = merkle.audit(merkle.write(cases.docs(spark, [(1, "a", "en", "s")]))).collect()
    assert one.root == one.subroot == one.leaf == one.folded_root and one.verified and one.proof_sha256 == cases.sha("")
    with pytest.raises(ValueError):
        merkle.write(docs, 1)
