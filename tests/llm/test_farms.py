"""Link farms around blocked hosts."""

import pytest

from wonweave.llm import url_filter


def test_linkers_do_not_shield_each_other(spark):
    """30 hosts that link only to the same 10 blocked ones, one that mostly links elsewhere, one behind a linker, and a trusted one."""
    bad = "".join(f"<a href='http://b{k}.net/'>" for k in range(10))
    rows = [(i, f"http://farm{i}.com/", bad) for i in range(30)] + [
        (100, "http://fair.com/", "<a href='http://b0.net/'>" + "".join(f"<a href='http://c{k}.com/'>" for k in range(9))), (101, "http://behind.com/", "<a href='http://farm1.com/'>"),
        (102, "http://ok.org/fr/", "<a href='http://farm2.com/'>"), (103, "http://ok.org/x", bad), (104, "http://b0.net/", "<a href='http://c1.com/'>"), (105, "http://c1.com/", ""),
    ]
    got = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i].verdict for i in range(30)] == ["block"] * 2 + ["allow"] + ["block"] * 27
    assert got[2].trust == pytest.approx(0.85) == got[2].distrust and got[3].distrust == pytest.approx(0.85) and got[101].distrust == pytest.approx(0.85**2)
    assert [got[i].verdict for i in (100, 101, 102, 103, 104, 105)] == ["allow", "block", "allow", "allow", "block", "allow"]
