"""Values read from texts that parts and orders are put into: titles, headings, ways of support, keys of cached keywords."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wonweave.functions import extract, scoring, text
from wonweave.operators import keywords, match, sections
from wonweave.plans import linkage, rebuild
from wonweave.plans.registry import query, table
from wonweave.sources import landed

ASCII = "".join(map(chr, range(33, 127)))
WIDE = "".join(chr(ord(c) + 0xFEE0) for c in ASCII)


@query("""
WITH k AS (SELECT p_partkey, lower(regexp_replace(p_name || p_brand, '[^0-9A-Za-z_]+', '', 'g')) AS key, lower(regexp_replace(p_name || p_type, '[^0-9A-Za-z_]+', '', 'g')) AS whole, [lower(x) FOR x IN regexp_extract_all(p_name || ' ' || p_type, '[0-9A-Za-z]{2,}') IF NOT regexp_full_match(x, '[0-9]+')] AS words FROM part)
SELECT p_partkey, key, array_to_string(list_sort(list_distinct(list_concat(words, CASE WHEN length(whole) >= 4 THEN [whole] ELSE [] END))), ',') AS tokens FROM k""")
def title_keys(spark, sf_dir):
    """Names in full-width letters with tags and middle dots between: their keys and tokens are those of the plain ones."""
    p = table(spark, sf_dir, "part")
    wide = lambda *c: F.translate(F.concat(*c), ASCII, WIDE)
    return p.select("p_partkey", text.title_key(F.concat(F.lit("<b>"), wide("p_name"), F.lit("</b>·"), wide("p_brand"))).alias("key"), F.array_join(F.array_sort(text.tokens(F.concat(wide("p_name"), F.lit(" "), wide("p_type")))), ",").alias("tokens"))


@query(f"""{linkage.PAIRS}, i AS (SELECT DISTINCT card, CASE WHEN length(title) % 2 = 0 THEN lower(split_part(title, ' ', 1)) ELSE '' END AS who FROM c)
SELECT card, detail, CASE WHEN up THEN least(100, score + 8) ELSE score END::DECIMAL(9, 4)::DOUBLE AS score, method || CASE WHEN up THEN '+implementer' ELSE '' END AS method FROM (SELECT s.card, s.detail, round_even(score, 4) AS score, method, score < 88 AND who <> '' AND contains(regexp_replace(lower(s.detail), '[^a-z0-9_]+', '', 'g'), who) AS up FROM s JOIN i USING (card) WHERE score > 0)""")
def boosted_pairs(spark, sf_dir):
    """Pairs of cards and names, where a card's first word stands for who implements."""
    title = F.element_at(F.split("card", r"\|"), -1)
    cards = linkage.cards(spark, sf_dir).withColumn("who", F.when(F.length(title) % 2 == 0, F.split(title, " ")[0]).otherwise(""))
    cards = cards.select("*", *scoring.features("i", "who", normalized=False)).drop("who", "i_bigrams")
    found = match.candidates(cards, linkage.details(spark, sf_dir), boost=True)
    return found.select("card", "detail", F.bround("score", 4).alias("score"), "method")


def chunked(orders: DataFrame) -> DataFrame:
    """Orders as chunks of their customer's document, four to a page."""
    seq = (F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - 1).cast("int")
    return orders.select("o_custkey", "o_orderkey", seq.alias("chunk_idx")).withColumn("page", F.floor(F.col("chunk_idx") / 4).cast("int"))


CHUNKED = "SELECT o_custkey, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INTEGER) AS i, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 4 AS page FROM orders"


@query(f"""
WITH c AS ({CHUNKED}), t AS (SELECT *, o_orderkey % 6 AS k FROM c),
n AS (SELECT *, [x FOR x IN [lead(k, 1) OVER w, lead(k, 2) OVER w, lead(k, 3) OVER w] IF x IN (1, 2)] AS near FROM t WINDOW w AS (PARTITION BY o_custkey ORDER BY i)),
f AS (SELECT o_custkey, unnest(CASE near[1] WHEN 1 THEN ['직접', '보조'] ELSE ['출자'] END) AS label FROM n WHERE k = 0 AND len(near) > 0)
SELECT o_custkey, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM f GROUP BY 1""")
def support_below(spark, sf_dir):
    k = F.col("o_orderkey") % 6
    said = F.when(k == 0, "2) 사업 지원 형태").when(k == 1, "| 직접 | 출자 | 보조 |\n|---|---|---|\n| ○ | | V |").when(k == 2, "| 직접 | 출 자 | 출자 |\n| - | ○ | |").otherwise("다른 글")
    found = extract.support_below(chunked(table(spark, sf_dir, "orders")).withColumn("text", said), "o_custkey")
    return found.select("o_custkey", F.array_join("labels", ",").alias("labels"))


@query(f"""
WITH c AS ({CHUNKED}), t AS (SELECT *, o_orderkey % 4 AS k FROM c), n AS (SELECT *, lead(k) OVER w AS nk, lead(page) OVER w AS np, lead(o_orderkey) OVER w AS nkey, coalesce(lag(k) OVER w = 1 AND lag(page) OVER w = page, false) AS used FROM t WINDOW w AS (PARTITION BY o_custkey ORDER BY i))
SELECT o_custkey, i AS chunk_idx, 1 AS ordinal, '도로 ' || o_orderkey AS title, '1234-300' AS code, 1 AS width FROM n WHERE k = 0 AND NOT used
UNION ALL SELECT o_custkey, i, 2, '공원 ' || o_orderkey || CASE nk WHEN 2 THEN ' 길' ELSE ' (1) 도로 ' || nkey END, CASE nk WHEN 2 THEN '1234-301' ELSE '1234-300' END, 2 FROM n WHERE k = 1 AND nk IN (0, 2) AND np = page""")
def heading_pairs(spark, sf_dir):
    """Headings of one row, and of two rows on a page: a heading that a pair has used begins nothing."""
    k, key = F.col("o_orderkey") % 4, F.col("o_orderkey").cast("string")
    said = F.when(k == 0, F.concat(F.lit("### (1) 도로 "), key, F.lit(" (1234-300)"))).when(k == 1, F.concat(F.lit("## (2) 공원 "), key)).when(k == 2, "### 길 (1234 – 301)").otherwise("### 글")
    chunks = chunked(table(spark, sf_dir, "orders")).withColumn("text", said).withColumn("type", F.lit("heading"))
    return sections.anchors(chunks, "o_custkey").select("o_custkey", "chunk_idx", "heading.ordinal", "heading.title", "heading.code", "width")


@query("""
SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN p_name || ' 도로' WHEN 1 THEN p_name || ' 공원' WHEN 2 THEN p_name || ' 주택' WHEN 3 THEN p_name || ' 하천' END AS title FROM part""")
def guessed_titles(spark, sf_dir):
    """Of blocks with a heading, with a name behind a label, with markup and references, with a title in a line, and with none."""
    n = F.col("p_name")
    block = (
        F.when(F.col("p_size") % 5 == 0, F.concat(F.lit("머리\n(12) "), n, F.lit(" 도로 (1337-300)\n사업명 다른 이름")))
        .when(F.col("p_size") % 5 == 1, F.concat(F.lit("<p>\n사 업 명 (3) "), n, F.lit(" 공원 (1337 – 301)\n글")))
        .when(F.col("p_size") % 5 == 2, F.concat(F.lit("글\n페이지 3\n<b>"), n, F.lit("</b>&nbsp;주택\n")))
        .when(F.col("p_size") % 5 == 3, F.concat(F.lit("법적근거 조항\n가\n| (7) "), n, F.lit("  하천 |")))
        .otherwise("예산액\n(1)\n가나")
    )
    return table(spark, sf_dir, "part").select("p_partkey", extract.guess_title(block).alias("title"))


@query("""
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '금액 ' || o_orderkey || '원' WHEN 1 THEN '산출 ' || o_orderkey WHEN 2 THEN '4) 사업효과 ' || o_orderkey || ' 처음' ELSE '' END AS basis FROM orders""")
def budget_basis(spark, sf_dir):
    k, m = F.col("o_orderkey").cast("string"), F.col("o_orderkey") % 4
    said = F.when(m == 0, F.concat(F.lit(" 3) 2026년도 예산 산출 근거\n금액  "), k, F.lit("원 4) 사업효과 많다 사업영향, 적다"))).when(m == 1, F.concat(F.lit("산출 "), k, F.lit(" 5) 타당성조사 6) 총사업비"))).when(m == 2, F.concat(F.lit("4) 사업효과 "), k, F.lit(" 처음 ")))
    return table(spark, sf_dir, "orders").select("o_orderkey", extract.basis(said).alias("basis"))


@query("SELECT doc_id, len(b) AS n, list_sum([length(x) FOR x IN b])::BIGINT AS chars FROM (SELECT doc_id, [x FOR x IN [trim(CASE WHEN i = 1 THEN s[i] ELSE '. ' || s[i] END, ' ') FOR i IN range(1, len(s) + 1)] IF length(x) >= 80] AS b FROM (SELECT doc_id, string_split(text, '. ') AS s FROM documents)) WHERE len(b) > 0")
def text_blocks(spark, sf_dir):
    """Whole documents, cut before each end of a sentence."""
    b = extract.blocks("text", r"\. ")
    return table(spark, sf_dir, "documents").select("doc_id", b.alias("b")).filter(F.size("b") > 0).select("doc_id", F.size("b").cast("long").alias("n"), F.aggregate("b", F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("chars"))


@query("SELECT c_custkey, substr(sha256(c_name || ' ' || c_mktsegment), 1, 16) AS hash FROM customer")
def keyword_hashes(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", landed.keyword_hash(F.concat_ws(" ", "c_name", "c_mktsegment")).alias("hash"))


@query(f"""
SELECT c_custkey, 'k' || c_custkey AS keyword, 'given' AS strategy, NULL AS matched_subproject FROM customer WHERE c_custkey % 7 <> 0
UNION ALL SELECT c_custkey, '{keywords.DOCUMENTED[0][2]}', 'documented_pdf_subproject_title', '{keywords.DOCUMENTED[0][1]}' FROM customer WHERE c_custkey % 50 = 0""")
def expanded_queries(spark, sf_dir):
    k = F.col("c_custkey")
    documented = F.array(*map(F.lit, keywords.DOCUMENTED[0][0]))
    plan = table(spark, sf_dir, "customer").select("c_custkey", F.when(k % 50 == 0, documented).otherwise(F.array("c_name")).alias("key"), F.when(k % 7 != 0, F.concat(F.lit("k"), k.cast("string"))).alias("keyword"), F.lit("given").alias("strategy"))
    return keywords.expand(plan, "key").select("c_custkey", "keyword", "strategy", "matched_subproject")


@query(f"{linkage.DECIDED} SELECT card, status, score FROM m WHERE status <> 'matched'")
def unresolved_cards(spark, sf_dir):
    return rebuild.unresolved(linkage.decided(spark, sf_dir)).select("card", "status", "score")
