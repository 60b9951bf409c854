"""Queries take their whole tables."""

import html
import re

import pytest
from wonweave.plans import registry

DATA = "/root/testdata/sf0.001"
CELLS = r"(?i)</(p|div|tr|li|h[1-6]|table|td|th)\s*>"


def lines(x, tables=False):
    x = re.sub(r"(?i)<br\s*/?>", "\n", x or "")
    if tables:
        x = re.sub(r"(?i)</t[dh]\s*>", "\t", re.sub(r"!\[[^\]]*\]\([^)]*\)", " ", x))
    x = html.unescape(re.sub("<[^>]+>", " ", re.sub(CELLS, "\n", x)))
    out = [re.sub("[ \t]+", " ", s).strip(" |") for s in x.split("\n")]
    return [s for s in out if s and not (tables and re.fullmatch(r"[|:\- ]+", s))]


def test_html_to_text_takes_all_pages(spark):
    pages = registry.table(spark, DATA, "pages").collect()
    got = {r.page_id: r.body for r in registry.QUERIES["html_to_text"](spark, DATA).collect()}
    assert got == {r.page_id: "\n".join(lines(r.html)) for r in pages}
    assert len(got) == len(pages)
    assert any("&amp;" in r.html and "&" in got[r.page_id] for r in pages)


def test_section_excerpt_takes_all_documents(spark):
    docs = registry.table(spark, DATA, "documents").collect()
    got = sorted(((r.doc_id, r.excerpt) for r in registry.QUERIES["section_excerpt"](spark, DATA).collect()), key=str)
    want = []
    for r in docs:
        each = dict.fromkeys(re.sub(r"^#{1,6}\s*", "", s).strip(" -·□○ㅇ") for s in lines(r.text, True))
        want.append((r.doc_id, "\n".join(s for s in each if s)[:120].rstrip(" ")))
    assert got == sorted(want, key=str) and len(got) == len(docs)


@pytest.mark.parametrize("name,column,of,key", [("keyword_fan_out", "p_partkey", "part", "p_partkey"), ("exact_then_fallback", "b", "part", "p_partkey"), ("amount_mentions", "o_orderkey", "orders", "o_orderkey"), ("json_rows", "o_orderkey", "orders", "o_orderkey")])
def test_no_key_is_left_out(spark, name, column, of, key):
    """test_queries.py compares the rows with SQL."""
    got = {r[0] for r in registry.QUERIES[name](spark, DATA).select(column).distinct().collect()}
    every = {r[0] for r in registry.table(spark, DATA, of).select(key).collect()}
    assert got <= every and (name == "exact_then_fallback" or got == every)
