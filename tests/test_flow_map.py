"""Money-flow graphs: what is known flows, what isn't is said to be unknown, what has no end is dropped."""

import pytest

from wonweave.operators import flow_map


@pytest.fixture(scope="module")
def facts(spark):
    def made(rows, schema):
        return spark.createDataFrame(rows, schema)

    local = [("1", f"r{i}", 100 - i, 10, None) for i in range(10)] + [("1", "r0", 5, 1, 1), ("1", "r0", 5, 1, 9)]
    return {
        "business": made([("1", "도로", "일반회계", 30), ("2", "철도", None, 0), ("3", "항만", "특별회계", 5)], "business_id string, title string, account string, total long"),
        "subprojects": made([("1", 1, "가", 20), ("1", 2, "나", 10)], "business_id string, id int, label string, amount long"),
        "basis": made([("2", " "), ("3", "근거")], "business_id string, text string"),
        "items": made([("1", "a", "보조", 25, "local_subsidy"), ("1", "b", "용역", 5, "procurement"), ("3", "c", "운영", 4, "internal")], "business_id string, item_id string, title string, amount long, code string"),
        "noted": made([("1", "procurement"), ("1", "loan")], "business_id string, code string"),
        "local": made(local, "business_id string, region_name string, national_amt long, budget_cash_amt long, subproject_id int"),
        "people": made([("1", "주민"), ("2", None)], "business_id string, beneficiary string"),
        "cross": made([("1", 1, "local_subsidy", 20), ("1", 2, "loan", 10), ("1", 8, "procurement", 1)], "business_id string, subproject_id int, code string, amount long"),
    }


def test_nodes(facts):
    got = {(r.business_id, r.id): (r.type, r.amount) for r in flow_map.nodes(facts).collect()}
    assert len(got) == flow_map.nodes(facts).count() and {t for t, _ in got.values()} <= set(flow_map.TYPES)
    assert got["1", "destination:procurement"] == ("destination", 5) and got["1", "destination:local_subsidy"] == ("unknown", 25)
    assert {k: v for (b, k), v in got.items() if b == "2"} == {
        "source": ("source", 0), "business": ("core", 0), "sub:unknown": ("unknown", None), "item:none": ("unknown", 0), "channel:none": ("unknown", 0), "local": ("unknown", None), "beneficiary": ("unknown", None), "reconcile:items": ("unknown", None),
        "reconcile:subprojects": ("unknown", None), "reconcile:local": ("unknown", None),
    }
    assert got["3", "basis"] == ("item", None) and got["3", "reconcile:items"] == ("unknown", -1) and got["1", "reconcile:items"] == ("reconcile", 0) == got["1", "reconcile:subprojects"]
    assert got["1", "region:r0"] == ("candidate", 12) and ("1", "region:r8") not in got and got["1", "region:more"] == ("candidate", None) and got["1", "beneficiary"] == ("beneficiary", None)


def test_edges(facts):
    n = flow_map.nodes(facts)
    got = {(r.business_id, r.src, r.dst): (r.type, r.amount) for r in flow_map.edges(facts, n).collect()}
    assert {t for t, _ in got.values()} == set(flow_map.EDGES)
    assert {k[1:]: v for k, v in got.items() if v[0] == "crosswalk"} == {("sub:1", "channel:local_subsidy"): ("crosswalk", 20)}  # no channel of loans, no eighth subproject
    assert ("1", "sub:1", "local") in got and ("1", "sub:9", "local") not in got and ("1", "channel:local_subsidy", "local") in got
    assert sum(v[1] for k, v in got.items() if k[0] == "1" and k[1] == "business" and k[2].startswith("item:")) == 30
    assert all(v[1] == 0 for v in got.values() if v[0] in ("candidate", "context")) and {k[0] for k in got} == {"1", "2", "3"}
    ids = {(r.business_id, r.id) for r in n.collect()}
    assert all((b, s) in ids and (b, d) in ids for b, s, d in got)


def test_empty(facts):
    none = {k: v.limit(0) for k, v in facts.items()}
    assert flow_map.nodes(none).count() == 0 and flow_map.edges(none, flow_map.nodes(none)).count() == 0
