"""Queries against their SQL on rows that the small tables lack, and what they move."""

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F
from test_whole import lines
from wonweave.functions import columns, text
from wonweave.operators import keywords
from wonweave.plans import registry


def both(spark, top, name, **tables):
    """The query's rows and its SQL's, over `tables` of columns."""
    con = duckdb.connect()
    for t, columns in tables.items():
        pq.write_table(pa.table(columns), f"{top}/{t}.parquet")
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{top}/{t}.parquet'")
    theirs = con.sql(registry.SQL[name])
    ours = registry.QUERIES[name](spark, str(top)).select(*theirs.columns)
    return sorted(map(tuple, ours.collect()), key=str), sorted(theirs.fetchall(), key=str)


def test_fan_out_moves_no_pairs(spark, tmp_path, monkeypatch):
    """Parts that come twice or have no key, keywords without events, events without an id or a type."""
    seen, plain = [], keywords.fan_out
    monkeypatch.setattr(keywords, "fan_out", lambda q, rows: seen.append(plain(q, rows)) or seen[-1])
    parts = [*range(1000), 4, 4, 7, None]
    types = ["click", "view", "error", None] * 500 + ["click"]
    ours, theirs = both(spark, tmp_path, "keyword_fan_out", part={"p_partkey": pa.array(parts, "int64")}, events={"event_id": pa.array([*range(2000), None], "int64"), "event_type": types})
    assert ours == theirs and len(ours) == 1001
    assert sum(x.count() for x in seen) <= len(parts)


def test_fan_out_of_events_without_ids(spark, tmp_path):
    ours, theirs = both(spark, tmp_path, "keyword_fan_out", part={"p_partkey": pa.array([1, 2], "int64")}, events={"event_id": pa.array([None, None], "int64"), "event_type": ["view", "view"]})
    assert ours == theirs == [(1, 2, None, None, None)]


HTML = [
    "<p>a&amp</p><p>b&amp;c</p>", "&amp", "&amp;amp", "&amp;lt; &lt;b&gt; &ltx", "<td>x&copy y&copy;</td>&middot;&middot", "&nbsp;| &#38; &#x26; &AMP; &eacute;|", "a & b && c&", '<a href="?a&amp=1&b">t&quot;&quot</a>', "&am<b>p;</b>&<br>lt;",
    "<p>  x\t y |</p>\n\n<tr><td>|</td></tr>", "", None, "<p", "&<&>&",
]


def test_references_as_in_sql(spark, tmp_path):
    """Without semicolons, of other names, cut off, and what only looks like one."""
    ours, theirs = both(spark, tmp_path, "html_to_text", pages={"page_id": pa.array(range(len(HTML)), "int64"), "html": HTML})
    assert ours == theirs and len(ours) == len(HTML)
    assert dict(ours)[0] == "a&amp\nb&c"


def test_operator_decodes_all_references(spark):
    rows = spark.createDataFrame([(x,) for x in HTML], "html string")
    for got, x in rows.select(text.markup_to_lines("html"), "html").collect():
        assert got == "\n".join(lines(x))


KEYS = [*range(90), *range(8100, 8160), 9_999, 30_000, 300_000, 899_997, 900_001, 10**9 + 2, 3 * 10**9, -1, -2, -3, -4, -8_133, -9_000]


def test_amounts_as_in_sql(spark, tmp_path):
    """Beyond 10^12 won, below 0, without a nation."""
    keys = [*KEYS, 11, 12, 13]
    ours, theirs = both(spark, tmp_path, "shown_values", customer={"c_custkey": pa.array(keys, "int64"), "c_nationkey": pa.array([*(k % 25 for k in KEYS), None, None, None], "int32")})
    assert ours == theirs and len(ours) == len(keys)
    assert dict(r[:2] for r in ours)[8_133] == "10,003.6억"


def test_null_keys_as_in_sql(spark, tmp_path):
    ours, theirs = both(spark, tmp_path, "shown_values", customer={"c_custkey": pa.array([None, None, 5], "int64"), "c_nationkey": pa.array([3, None, 7], "int32")})
    assert ours == theirs


def test_largest_unit(spark):
    won = spark.createDataFrame([(1_230_000_000_000,), (-1_230_000_000_000,), (999_999,), (None,)], "won long")
    assert [tuple(r) for r in won.select(columns.korean_amount("won"), columns.korean_amount(F.col("won"), "억"), columns.korean_amount("won", "백만")).collect()] == [("1.2조", "12,300.0억", "1,230,000.0백만"), ("-1.2조", "-12,300.0억", "-1,230,000.0백만"), ("999,999",) * 3, (None,) * 3]
