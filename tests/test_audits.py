"""Comparing tables by fingerprints, and the checks of cards, matches and candidates: each planted fault is named."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wonweave.operators import audits, compare

ROWS = [(i % 7 if i % 11 else None, f"v{i % 5}" if i % 3 else None, i % 4 / 2, [i % 2, None]) for i in range(200)]
SCHEMA = "g int, t string, x double, a array<int>"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_same_rows_in_any_order(spark):
    a, b = frame(spark, ROWS), frame(spark, random.Random(1).sample(ROWS, len(ROWS))).repartition(7)
    for by in ([], ["g"], ["g", "t"]):
        assert compare.differing(compare.fingerprints(a, by), compare.fingerprints(b, by), by).collect() == [] if by else compare.fingerprints(a, by).collect() == compare.fingerprints(b, by).collect()
        assert compare.differences(a, b.select("a", "x", "g", "t"), by).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_every_change_is_named(spark, seed):
    rng = random.Random(seed)
    other = list(ROWS)
    for _ in range(4):
        other.pop(rng.randrange(len(other)))
    other += [rng.choice(ROWS), (3, None, float("nan"), None), (None, "new", 0.0, [])]
    k = rng.randrange(len(other))
    other[k] = (other[k][0], "changed", *other[k][2:])
    got = compare.differences(frame(spark, ROWS), frame(spark, other), ["g"])
    want = Counter(map(str, ROWS))
    want.subtract(map(str, other))
    assert {str((r.g, r.t, r.x, r.a)): (r.times if r.side == "missing" else -r.times) for r in got.collect()} == {r: d for r, d in want.items() if d}
    told = compare.violations(frame(spark, ROWS), frame(spark, other), ["g"], "same").collect()
    assert len(told) == got.count() and all(v.check_id == "same" and v.message.startswith(("missing ", "extra ")) for v in told)


def test_values_that_hashes_could_mix_up(spark):
    pairs = [((None, "1"), ("1", None)), (("a", "b"), ("b", "a")), (("", None), (None, "")), (("1", "null"), ("1", None))]
    for one, two in pairs:
        a, b = (spark.createDataFrame([x], "p string, q string") for x in (one, two))
        assert compare.differences(a, b, []).count() == 2, (one, two)
    # changes that cancel each other in a sum of one number, not in hashes
    a, b = (spark.createDataFrame([(x,) for x in xs], "n long") for xs in ([1, 4], [2, 3]))
    assert compare.differences(a, b, []).count() == 4


def test_parts_add_up(spark):
    whole = compare.fingerprints(frame(spark, ROWS), ["g"])
    parts = [compare.fingerprints(frame(spark, ROWS[i::3]), ["g"]) for i in range(3)]
    assert compare.differing(whole, compare.merged(parts, ["g"]), ["g"]).collect() == []


def test_what_cannot_be_compared(spark):
    with pytest.raises(ValueError, match="different columns"):
        compare.differences(frame(spark, ROWS), frame(spark, ROWS).drop("a"), [])
    with pytest.raises(ValueError, match="maps"):
        compare.fingerprints(spark.sql("SELECT map('a', 1) AS m"), [])


CARD = {"card": "c", "source_pdf": "d", "extractor": audits.EXTRACTOR, "title": "도로 건설", "code": "1234-301", "code_type": "detail", "implementer": None, "page_start": 1, "page_end": 2, "anchor_chunk_id": "a", "source_chunk_start": "a", "source_chunk_end": "b", "exec_paths": ["보조"], "amounts": ["1,000원"], "ministry": "부"}
CARD_SCHEMA = "card string, source_pdf string, extractor string, title string, code string, code_type string, implementer string, page_start int, page_end int, anchor_chunk_id string, source_chunk_start string, source_chunk_end string, exec_paths array<string>, amounts array<string>, ministry string"
FAULTS = [
    ({}, set()), ({"extractor": None}, {"card_extractor"}), ({"title": " 구분 "}, {"card_title"}), ({"title": "A<TD COLSPAN=2>"}, {"card_markup"}), ({"code": "12-3"}, {"card_code"}), ({"code": None}, {"card_code"}), ({"code": "6040-301~902"}, set()), ({"page_start": 99}, {"card_pages"}), ({"page_end": None}, {"card_pages"}),
    ({"anchor_chunk_id": ""}, {"card_chunks"}), ({"code_type": None}, {"card_code_type"}), ({"implementer": " 미정 "}, {"card_implementer"}), ({"exec_paths": ["현금"]}, {"card_paths"}), ({"exec_paths": ["보조", "보조"]}, {"card_paths_twice"}), ({"amounts": ["1\n원"]}, {"card_amounts"}), ({"source_pdf": "e"}, {"card_source"}), ({"exec_paths": None, "amounts": None}, set()),
]


def test_cards(spark):
    rows = [tuple(({**CARD, "card": str(i), "page_end": 2 + i} | fault)[f.split()[0]] for f in CARD_SCHEMA.split(", ")) for i, (fault, _) in enumerate(FAULTS)]
    cards = spark.createDataFrame(rows, CARD_SCHEMA)
    got = {}
    for v in audits.card_checks(cards, ["d"], 0).collect():
        got.setdefault(v.key, set()).add(v.check_id)
    assert got == {str(i): want for i, (_, want) in enumerate(FAULTS) if want}
    assert {v.check_id for v in audits.card_checks(cards.limit(1).unionByName(cards.limit(1)), None, 7).collect()} == {"card_place", "card_aggregates"}
    assert audits.card_checks(cards.limit(0), ["d"], 0).collect() == []


def test_matches(spark):
    detail = spark.createDataFrame([("k1", "부", "도로"), ("k2", "부", "철도"), ("k3", "부", "철도"), ("k4", "청", "도로")], "detail string, office_name string, detail_business_name string")
    cards = spark.createDataFrame([(str(i), "부", "aggregate" if i == 6 else "detail") for i in range(9)], "card string, ministry string, code_type string")
    rows = [("0", "matched", "k1", 100.0, "exact"), ("1", "matched", "k4", 90.0, "tokens"), ("2", "matched", "k2", 100.0, "exact"), ("3", "matched", "k9", 80.0, "tokens"), ("4", "ambiguous", "k1", 60.0, "tokens"), ("5", "unmatched", None, 101.0, "none"), ("6", "matched", "k1", 75.0, "tokens"), ("7", "maybe", None, 1.0, "none"), ("x", "unmatched", None, 0.0, "none")]
    matches = spark.createDataFrame(rows, "card string, status string, detail string, score double, method string")
    top3 = spark.sql("SELECT '0' AS card, array(named_struct('score', 100.0D), named_struct('score', -1.0D)) AS top3")
    got = sorted((v.check_id, v.key) for v in audits.match_checks(cards, matches, top3, detail).collect())
    assert got == sorted([("match_office", "1"), ("match_name", "2"), ("match_unknown", "3"), ("match_detail", "4"), ("match_score", "5"), ("match_aggregate", "6"), ("match_status", "7"), ("match_cards", ""), ("match_cards", ""), ("rank_score", "0"), ("match_share", "matched")])
    fine = matches.filter("card = '0'")
    assert audits.match_checks(cards.filter("card = '0'"), fine, top3.limit(0), detail).collect() == []


def test_candidates(spark):
    key = ["2026", "부", "계정", "프로그램", "단위", "도로"]
    records = spark.createDataFrame([("k1", key), ("k2", [*key[:5], "철도"])], "business_id string, canonical_key array<string>")
    mix = spark.createDataFrame([("k1", "local_subsidy", 70), ("k1", "local_subsidy", 30), ("k1", "direct", 5), ("k2", "direct", 9)], "business_id string, channel string, amount long")
    good = {"central_key": key, "central_name": "도로", "year": "2026", "exe_ymd": "20260131", "source": audits.SOURCE, "match_status": audits.STATUS, "match_mode": audits.MODE, "keyword": "도로 건설", "keyword_strategy": "s", "national_amt": 5, "central_amount": 100, "local_gov_code": "11"}
    faults = [({}, set()), ({"central_key": key[:5]}, {"candidate_key", "candidate_business", "candidate_name"}), ({"central_key": None}, {"candidate_key", "candidate_business", "candidate_name", "candidate_year", "candidate_day"}), ({"year": "2025"}, {"candidate_year"}), ({"exe_ymd": "20260231"}, {"candidate_day"}), ({"match_mode": None}, {"candidate_source"}), ({"keyword": "가 나 다"}, {"candidate_keyword"}), ({"keyword_strategy": None}, {"candidate_strategy"}), ({"national_amt": 0}, {"candidate_amount"}), ({"local_gov_code": ""}, {"candidate_identity"}), ({"central_amount": 99}, {"candidate_central"}), ({"central_key": [*key[:5], "철도"], "central_name": "철도", "central_amount": 0}, {"candidate_central"})]
    schema = "central_key array<string>, central_name string, year string, exe_ymd string, source string, match_status string, match_mode string, keyword string, keyword_strategy string, national_amt long, central_amount long, local_gov_code string, detail_business_code string"
    rows = spark.createDataFrame([tuple((good | {"detail_business_code": f"b{i}"} | fault)[f.split()[0]] for f in schema.split(", ")) for i, (fault, _) in enumerate(faults)], schema)
    attached = rows.select(F.col("central_key").alias("canonical_key"), *audits.IDENTITY)
    got = {}
    for v in audits.candidate_checks(rows, records, mix, attached).collect():
        got.setdefault(v.key.split("|")[-1], set()).add(v.check_id)
    assert got == {f"b{i}": want for i, (_, want) in enumerate(faults) if want}
    assert [v.check_id for v in audits.candidate_checks(rows.limit(1), records, mix, attached.limit(0)).collect()] == ["candidate_attached"]
    assert sorted(v.check_id for v in audits.candidate_checks(rows.limit(1).unionByName(rows.limit(1)), records, mix, attached.limit(1)).collect()) == ["candidate_attached", "candidate_twice"]
