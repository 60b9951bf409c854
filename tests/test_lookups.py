"""Substring joins by grams, range joins by bins, sections with preferred beginnings."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from wonweave.operators import attach, contains, sections


def texts(seed, n, letters="abㄱ😀 "):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 12))) for _ in range(n)]


@pytest.mark.parametrize("q", [1, 2, 3, 4])
def test_containing_finds_all(spark, q):
    hay, needles = [*texts(1, 120), None, "", "same", "same"], [*texts(2, 80), None, "", "same", "a", "ab"]
    got = contains.containing(spark.createDataFrame([(x,) for x in hay], "t string"), spark.createDataFrame([(x,) for x in needles], "t string"), q)
    want = {(h, n) for h, n in itertools.product(hay, needles) if h and n and len(n) >= q and n in h}
    rows = [tuple(r) for r in got.collect()]
    assert set(rows) == want and len(rows) == len(want) and len(want) > 5


def test_no_nested_loop(spark):
    frame = spark.createDataFrame([(x,) for x in texts(3, 20)], "t string")
    plan = contains.containing(frame, frame)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_attaching_by_key_name_keyword_and_tokens(spark):
    b = [(1, "river bridge repair", "roads and bridges", ["river", "bridge", "repair", "of"]), (2, "school meals", "meals for all", ["school", "meals"]), (3, "park", "green park", ["park"]), (4, "old age", None, []), (5, None, "", None), (2, "school meals", "twice", ["school", "meals"])]
    rows = [(10, 5, "x", "anything"), (11, None, "meals", "no"), (12, None, None, "bridge over the river"), (13, None, "zz", "bridge"), (14, None, None, "school"), (15, None, None, "the school meals plan"), (16, 9, "meals", "school meals"), (17, None, None, "parks"), (18, None, "green", None), (19, None, "al", "ol")]
    df_b = spark.createDataFrame(b, "k long, name string, corpus string, tokens array<string>")
    df_r = spark.createDataFrame(rows, "id long, k long, word string, title string").select("k", "id", "word", "title")

    def want(tokens):
        out = []
        for k, name, corpus, toks in b:
            exact = [r for r in rows if r[1] == k]
            out += [(k, corpus, r[0], "exact") for r in exact]
            if exact:
                continue
            few = sorted({t for t in toks or [] if len(t) >= 3})[:4]
            for r in rows:
                if r[1] is not None:
                    continue
                title = r[3] or ""
                ok = len(r[2] or "") >= 4 and r[2] in (corpus or "") or len(name or "") >= 4 and len(title) >= 4 and (name in title or title in name)
                if tokens and few:
                    ok = ok or sum(t in title for t in few) >= max(1, min(2, len(few)))
                if ok:
                    out.append((k, corpus, r[0], "fallback"))
        return sorted(out, key=str)

    for tokens in (None, "tokens"):
        got = attach.exact_then_fallback(df_b, df_r, "k", "name", "corpus", "word", "title", tokens=tokens)
        assert sorted(((r.b_k, r.b_corpus, r.r_id, r.how) for r in got.collect()), key=str) == want(tokens)
        assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
    assert len(want("tokens")) > len(want(None)) > 4


@pytest.mark.parametrize("width", [1, 3, 64])
def test_chunks_of_spans(spark, width):
    rng = random.Random(width)
    chunks = [(d, i, f"t{i}") for d in "ab" for i in range(40) if rng.random() < 0.9] + [(None, 1, "x")]
    spans = [(rng.choice(["a", "b", "c", None]), a := rng.randint(-5, 45), a + rng.randint(-3, 20), k) for k in range(60)] + [("a", 0, 2**62, 99), ("b", -(2**62), 3, 98)]
    got = sections.chunks_in(spark.createDataFrame(spans, "source_pdf string, block_start long, block_end long, key int"), spark.createDataFrame(chunks, "source_pdf string, chunk_idx int, text string"), width=width)
    want = sorted((k, i) for d, a, z, k in spans for e, i, _ in chunks if d is not None and d == e and a <= i <= z)
    assert sorted((r.key, r.chunk_chunk_idx) for r in got.collect()) == want
    assert "__bin" in got._jdf.queryExecution().executedPlan().toString() and got.columns == ["source_pdf", "block_start", "block_end", "key", "chunk_chunk_idx", "chunk_text"]


def section(spark, *texts_of_chunks):
    rows = [("d", i, t) for i, t in enumerate(texts_of_chunks)]
    found = sections.extracted(spark.createDataFrame(rows, "doc string, i long, raw string"), ["doc"], "i", "raw")
    return {r.section: (r.text, r.start, r.last) for r in found.collect()}


def test_a_structural_heading_is_preferred(spark):
    got = section(spark, "사업 추진절차는 다음과 같다", "<table><tr><td>무관한 표</td></tr></table>", "<b>7) 사업</b> 집행절차", "공모 신청 후 선정", "8) 중기재정 계획", "더")
    assert got["procedure"] == ("7) 사업 집행절차\n공모 신청 후 선정", 2, 3)
    assert section(spark, "지원절차", "신청서 접수와 심사")["procedure"] == ("지원절차\n신청서 접수와 심사", 0, 1)


def test_what_says_nothing_is_dropped(spark):
    assert "procedure" not in section(spark, "7) 사업 집행절차 : 해당사항 없음 그리고 다른 많은 설명 문장들")
    assert "procedure" not in section(spark, "7) 사업 집행절차", "해당없음") and section(spark, "사업목적", "", None) == {}
    assert section(spark, None, "사업 목적", "충분히 긴 설명 문장이다")["purpose"] == ("사업 목적\n충분히 긴 설명 문장이다", 1, 2)


def test_stops_hold_only_where_they_say(spark):
    # 15) is no 5)
    got = section(spark, "4) 사업효과", "효과에 대한 설명", "15) 타당성 조사라는 말", "5) 타당성 조사", "다음")
    assert got["effects"] == ("4) 사업효과\n효과에 대한 설명\n15) 타당성 조사라는 말", 0, 2)
    assert "review" not in section(spark, "최근 소식과 결산 이야기를 길게 쓴다")


def test_lines_count_once_and_texts_end_at_their_limit(spark):
    text, start, last = section(spark, "사업 목적", *(["## 같은 줄", "- 같은 줄 "] * 2000), *[f"서로 다른 줄 번호 {i}" for i in range(600)])["purpose"]
    assert len(text) == 1500 and text.startswith("사업 목적\n같은 줄\n서로 다른 줄 번호 0\n") and (start, last) == (0, 4600)


def test_case_does_not_matter(spark):
    rows = spark.createDataFrame([("d", 0, "x"), ("d", 1, "GOAL here"), ("d", 2, "End")], "doc string, i int, t string")
    spec = sections.Section("a", "A", "goal", ("^END$",), 10)
    assert [tuple(r) for r in sections.spans(rows, ["doc"], "i", "t", [spec]).collect()] == [("d", "a", 1, 2)]
    assert sections.spans(rows.filter(F.lit(False)), ["doc"], "i", "t", [spec]).collect() == []
