"""Conversations, pages, urls, and the pipeline."""

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from wonweave.llm import bpe, chat_format, common, html_text, queries, url_filter


def test_chat(spark):
    rows = [(1, 0, "user", "hi </s> \\ [INST]"), (1, 1, "assistant", "a\\<s>b\\\\"), (1, 1, "assistant", "a\\<s>b\\\\"), (1, 2, None, None), (2, None, "x\ny\\", ""), (2, 0, "assistant", ""), (None, 0, "assistant", "n😀"), (3, 0, "assistant", "</s")]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "conv_id long, turn long, role string, text string, turns int, formatted string")
    got = {r.conv_id: r for r in chat_format.digests(chat_format.formatted(chat_format.frame_turns(df))).collect()}
    for c in (1, 2, 3, None):
        turns = sorted((((t is not None, t or 0), r or "", x or "") for i, t, r, x in rows if i == c))
        learned = "".join(x for _, r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns) and got[c].turns_sha256 == cases.sha("".join(f"{r}\n{x}\n" for _, r, x in turns))
        assert got[c].loss_chars == len(learned) and got[c].loss_sha256 == cases.sha(learned)
    assert chat_format.digests(chat_format.formatted(chat_format.frame_turns(df.limit(0)))).count() == 0


@pytest.mark.parametrize(
    "record,turns",
    [
        ('{"messages":[{"role":"system","content":"s"},{"content":"q","role":"user"}]}', [("system", "s"), ("user", "q")]), ('{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":null}]}', [("user", "q"), ("assistant", "")]), ('{"instruction":"i","input":"","output":"o"}', [("user", "i"), ("assistant", "o")]),
        ('{"messages":[]}', []), ('{"messages":[{"role":"user","content":"q","name":"n"},{"role":"assistant","content":null}],"id":7}', [("user", "q"), ("assistant", "")]), ('{"id":1,"prompt":"p","completion":"c","tags":["t"]}', [("user", "p"), ("assistant", "c")]), ('{"prompt":"p","response":"r","messages":[{"role":"user","content":"q"}]}', [("user", "q")]),
        ('{"messages":[{"role":"user"}]}', None), ('{"messages":"no list"}', None), ('[1]', None), ('{"instruction":"i","context":null,"response":"r","output":"o"}', [("user", "i"), ("assistant", "r")]), ('{"dialog":[{"text":"a","speaker":"bot"}]}', [("assistant", "a")]), ('{"conversations":[{"from":"human","value":"q","weight":1}],"system":"s"}', [("user", "q")]), ('{"it\'s":1,"question":"q","answer":"a"}', [("user", "q"), ("assistant", "a")]),
        ('{"instruction":"i","input":"x","output":"o"}', [("user", "i\n\nx"), ("assistant", "o")]), ('{"prompt":"p","response":"r","system":"s"}', [("system", "s"), ("user", "p"), ("assistant", "r")]), ('{"a":1}', None), ("{", None), (None, None),
    ],
)
def test_layouts(spark, record, turns):
    got = spark.createDataFrame([(record,)], "j string").select(chat_format.json_turns(F.col("j")).alias("t")).first().t
    assert (got and [tuple(t) for t in got]) == turns


def test_frames_are_told_by_their_paths(spark):
    df = spark.createDataFrame([(1, "p", "c")], "conv_id int, prompt string, completion string")
    assert [tuple(t) for t in chat_format.frame_turns(df).first().turns] == [("user", "p"), ("assistant", "c")]
    assert [tuple(t) for t in chat_format.frame_turns(df.withColumn("more", F.lit(1))).first().turns] == [("user", "p"), ("assistant", "c")]
    with pytest.raises(ValueError):
        chat_format.frame_turns(df.drop("prompt"))
    assert chat_format.fingerprint(["b", "a"]) == chat_format.fingerprint(["a", "b"])


def test_the_fingerprint_selects(spark, monkeypatch):
    """Rows of turns too are told by their paths: without right fingerprints nothing is mapped."""
    rows = spark.createDataFrame([(1, 0, "user", "hi", 5)], "conv_id long, turn int, role string, text string, more int")
    assert [tuple(t) for t in chat_format.frame_turns(rows).first().turns] == [("user", "hi")]
    monkeypatch.setattr(chat_format, "fingerprint", lambda found: str(id(found)))
    with pytest.raises(ValueError):
        chat_format.frame_turns(rows)
    assert spark.createDataFrame([('{"prompt":"p","response":"r"}',)], "j string").select(chat_format.json_turns(F.col("j")).alias("t")).first().t is None


def test_long_conversations(spark):
    """Offsets past several groups of turns, and a long text."""
    n = 3000
    df = spark.range(n).selectExpr("1L AS conv_id", "id AS turn", "IF(id % 3 = 0, 'assistant', 'user') AS role", "IF(id = 600, repeat('é', 2000000), concat('t<s>', id)) AS text")
    got = chat_format.digests(chat_format.formatted(chat_format.frame_turns(df))).first()
    texts = ["é" * 2_000_000 if i == 600 else f"t<s>{i}" for i in range(n)]
    learned = "".join(texts[::3])
    assert (got.n_turns, got.loss_chars, got.loss_sha256) == (n, len(learned), cases.sha(learned))


PAGE = "<html><head><title>t</title><script>var a='<p>';</script></head><body><nav>menu</nav><header>site</header><div id=x class='side-bar sidebar'>s</div><article><header><h1>T &amp; U</h1></header><p>a <b>b</b>c<br>d<p>e&nbsp;f<div class=comments>no</div><aside>no</aside></article><form>f</form><div class=\"cookie notice\">c</div><footer>foot</footer></body></html>"


def test_pages_by_themselves():
    text = lambda p: html_text.text_of(html_text.parse(p))
    assert text(PAGE) == "T & U a bc d e f"
    assert text("") == "" and text("<p>only") == "only" and text("plain &lt;b&gt; text") == "plain <b> text"
    assert text("<article><p>one<!-- <p>no --><p>two &am") == "one two &am" and text("<body><nav>x</nav><p>y</p>") == "y"
    assert text("<div>" * 3000 + "deep" + "</div>" * 10) == "deep" and text("<article><script>if (a < b) '</p>'</script>z") == "z"
    assert text("<article><p>a</p></article><article class=comment>no</article>") == "a"


def test_tree_matching_is_largest():
    a, b = html_text.parse("<div><p>1</p><ul><li>x<li>y</ul><p>2</p></div>"), html_text.parse("<div><ul><li>x</ul><p>1</p><p>3</p></div>")
    assert len(html_text.align(a, b)) == 5  # the root, div, ul with li, and the p behind it


def matched(x, y):
    """Simple tree matching as it is defined, without memory: nodes in the largest matching of two trees of equal roots."""
    if x.tag != y.tag:
        return 0

    def most(xs, ys):
        if not xs or not ys:
            return 0
        return max(most(xs[1:], ys), most(xs, ys[1:]), matched(xs[0], ys[0]) and matched(xs[0], ys[0]) + most(xs[1:], ys[1:]))

    return 1 + most(x.kids, y.kids)


@pytest.mark.parametrize("seed", range(12))
def test_tree_matching_against_brute_force(seed):
    rng = np.random.default_rng(seed)

    def tree(depth):
        tag = ("div", "ul", "p")[rng.integers(3)]
        return f"<{tag}>" + "".join(tree(depth - 1) for _ in range(rng.integers(0, 4) if depth else 0)) + f"</{tag}>"

    a, b = (html_text.parse("<div>" + tree(3) + tree(2) + "</div>") for _ in range(2))
    pairs = html_text.align(a, b)
    assert len(pairs) == matched(a, b) and all(x.tag == y.tag for x, y in pairs)
    above = {id(k): n for t in (a, b) for n in (t, *html_text.below(t)) for k in n.kids}
    assert all((id(above[id(x)]), id(above[id(y)])) in {(id(p), id(q)) for p, q in pairs} for x, y in pairs if id(x) in above)


@pytest.mark.parametrize("cells,pairs", [(1 << 22, 1 << 18), (40, 1 << 18), (1 << 22, 2), (1, 1)])
def test_bounded_matching_still_matches(monkeypatch, cells, pairs):
    """Beyond the bounds fewer nodes may be matched; those that are keep tags, order and parents, each once."""
    monkeypatch.setattr(html_text, "CELLS", cells)
    monkeypatch.setattr(html_text, "PAIRS", pairs)
    rng = np.random.default_rng(3)
    lists = ["<div>" + "".join("<li>" + "<a>" * int(rng.integers(0, 3)) + "<b></b>" * int(rng.integers(0, 3)) for _ in range(60)) + "</div>" for _ in range(2)]
    a, b = map(html_text.parse, lists)
    got = html_text.align(a, b)
    assert all(x.tag == y.tag for x, y in got) and len({id(x) for x, _ in got}) == len({id(y) for _, y in got}) == len(got) > 50
    place = {id(n): k for t in (a, b) for k, n in enumerate((t, *html_text.below(t)))}
    order = sorted((place[id(x)], place[id(y)]) for x, y in got)
    assert [y for _, y in order] == sorted(y for _, y in order)
    above = {id(k): n for t in (a, b) for n in (t, *html_text.below(t)) for k in n.kids}
    held = {(id(x), id(y)) for x, y in got}
    assert all((id(above[id(x)]), id(above[id(y)])) in held for x, y in got if id(x) in above)


def test_wide_pages_take_little():
    """Lists of 20,000 links, alike and unlike."""
    import time
    import tracemalloc

    rng = np.random.default_rng(2)
    alike = html_text.parse("<ul>" + "<li><a>x</a>" * 20_000 + "</ul>")
    unlike = [html_text.parse("<ul>" + "".join("<li>" + "<a>" * int(rng.integers(0, 4)) + "<b></b>" * int(rng.integers(0, 4)) for _ in range(20_000)) + "</ul>") for _ in range(2)]
    tracemalloc.start()
    began = time.perf_counter()
    assert len(html_text.align(alike, alike)) == 40_002 and len(html_text.align(*unlike)) > 20_000 and len(html_text.align(alike, unlike[0])) > 20_000
    assert time.perf_counter() - began < 60 and tracemalloc.get_traced_memory()[1] < 300e6
    tracemalloc.stop()


def test_deep_and_long_pages():
    deep = "<div>" * 1_000_000 + "deep" + "</div>" * 10 + "</span>" * 1000
    root = html_text.parse(deep)
    assert html_text.text_of(root) == "deep" and html_text.wrapper("<div>x</div>").extract(root) == "deep" and html_text.outline(root)
    assert len(html_text.text_of(html_text.parse("<article>" + "<p>some words" * 100_000 + "</article>"))) == 100_000 * 11 - 1
    assert html_text.text_of(html_text.parse("<article><p>first</p></article><article><p>other</p></article>")) == "first"


def test_pages_without_names(spark):
    """No article, no classes, boilerplate that takes turns, a longer menu, near copies, two layouts: the wrapper alone tells."""
    rng = np.random.default_rng(5)
    words = lambda n, salt: " ".join(f"w{x}" for x in rng.integers(0, 10**6, n)) + f" {salt}"
    adverts, rows, want = ["Buy now", "Big sale today", "New shoes & more"], [], {}

    def page(i, body, title):
        menu = "".join(f"<li>item{k}</li>" for k in range(4 + i % 2))
        rows.append((i, f"http://plain.org/{i}", f"<body><div><ul>{menu}</ul></div><div>{adverts[i % 3].replace('&', '&amp;')}</div><div><h1>{title}</h1>{''.join(f'<p>{x}</p>' for x in body)}</div>" + ("<div>About us</div>" if i % 4 else "<table><tr><td>About us</table>")))
        want[i] = " ".join([title, *body])

    for i in range(60):
        page(i, [words(30, i) for _ in range(2 + i % 3)], f"Title {words(2, i)}")
    copied = [words(40, "copy") for _ in range(4)]
    for i in range(60, 200):  # near copies: most of the host's pages
        page(i, [f"{x} changed{i}" if k == i % 4 else x for k, x in enumerate(copied)], "Copied title")
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert sum(got[i] == want[i] for i in range(60)) == 60 and sum(got[i] == want[i] for i in want) == len(want)


def test_large_wrappers_are_joined(spark, monkeypatch):
    page = lambda i: f"<body><div>Follow us</div><p>Story {i} of {i * 7} things</p></body>"
    pages = spark.createDataFrame([(i, f"http://H.org/{i}", page(i)) for i in range(8)] + [(9, None, None)], "page_id long, url string, html string")
    want = sorted(map(tuple, html_text.extract(pages).collect()), key=str)
    monkeypatch.setattr(html_text, "REFERENCE_BYTES", 0)
    assert sorted(map(tuple, html_text.extract(pages).collect()), key=str) == want and want[0][2] == "Story 0 of 0 things"


def test_wrappers(spark):
    page = lambda i: f"<body><div>Follow us</div><div><p>Story number {i} about things {i * 7}</p></div><div>All rights reserved</div></body>"
    rows = [(i, f"http://h.org/{i}", page(i)) for i in range(12)] + [(100 + i, "http://copies.org/", page(1)) for i in range(9)] + [(200, None, None), (201, "x", ""), (202, "http://one.org", page(3)), (203, "http://h.org/3", page(3))]
    got = {r.page_id: r for r in html_text.digests(html_text.extract(spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, host int"))).collect()}
    assert len(got) == len(rows) and all(got[i].text == f"Story number {i} about things {i * 7}" for i in range(12))
    assert got[100].text == "Follow us Story number 1 about things 7 All rights reserved" == got[108].text and got[202].text.startswith("Follow us")
    assert (got[200].text, got[201].text, got[200].n_chars) == ("", "", 0) and got[203].text == got[3].text
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def arriving(edges, seeds):
    """The chance that a damped walk from each host ends at a seed, by repeated averaging."""
    score = {}
    for _ in range(300):
        score = {h: 1.0 if h in seeds else url_filter.DAMPING * sum(n * score.get(d, 0.0) for (a, d), n in edges.items() if a == h) / max(1, sum(n for (a, _), n in edges.items() if a == h)) for h in {x for e in edges for x in e} | set(seeds)}
    return score


def test_urls(spark):
    rows = [
        (1, "http://a.com/x", '<a href="http://bad.net/">x</a><a class="q" href=http://bad.net/2>'), (2, "http://b.com", '<a href="//ok.org/fr/">'), (3, "http://ok.org/fr/1", "<a href=http://c.com><A HREF='https://D.com'>"), (4, "HTTP://C.com:80/?q=/fr/", ""), (5, "http://bad.net/q", None), (6, None, "x"),
        (7, "nothing", "x"), (8, "https://m.example.net/en/5#f", ""), (9, "http://x.example.com/de/", ""), (10, "http://www.ok.org?x=/fr/", ""), (11, "http://notnet/", ""), (12, "http://e.net", ""), (1, "http://a.com/x", '<a href="http://bad.net/">x</a>'),
    ]
    df = spark.createDataFrame([(*r, "h", "p") for r in rows], "page_id long, url string, html string, host string, verdict string")
    found = url_filter.judge(df)
    got = {r.page_id: r for r in found.collect()}
    assert found.count() == len(rows) and (got[4].host, got[4].path) == ("c.com:80", "/") and (got[6].host, got[6].path, got[6].verdict) == ("", "", "allow")
    assert {i: got[i].rule for i in (3, 5, 8, 9, 10, 12)} == {3: "org/fr/", 5: "net/", 8: "example.net/en/", 9: "example.com/de/", 10: None, 12: None}
    assert [got[i].verdict for i in (1, 2, 3, 4, 5, 7, 8, 9, 10)] == ["block", "allow", "allow", "allow", "block", "allow", "allow", "block", "allow"]
    edges = {("a.com", "bad.net"): 3, ("b.com", "ok.org"): 1, ("ok.org", "c.com"): 1, ("ok.org", "d.com"): 1}
    trust = arriving({(d, a): n for (a, d), n in edges.items()}, {"ok.org"})
    distrust = arriving(edges, {"bad.net", "e.net"})
    for i in (1, 2, 3, 4, 5, 12):
        assert (got[i].trust, got[i].distrust) == pytest.approx((trust.get(got[i].host, 0.0), distrust.get(got[i].host, 0.0)), abs=1e-3)
    assert url_filter.judge(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_verdicts_of_linked_hosts(spark, seed):
    """Hosts at random, with cycles, seeds of both kinds and links to hosts without pages: scores against plain averaging, rows against SQL."""
    import duckdb
    import pandas as pd

    rng = np.random.default_rng(seed)
    hosts = [f"h{k}.com" for k in range(14)] + ["b0.net", "b1.net", "ok.org", "x.example.net"]
    rows, edges = [], {}
    for i in range(60):
        src = str(rng.choice(hosts))
        path = "/fr/" if src == "ok.org" else "/en/1" if src == "x.example.net" and i % 2 else "/p"
        out = [str(rng.choice([*hosts, "gone.net", "gone.com"])) for _ in range(int(rng.integers(0, 4)))]
        for dst in out:
            if dst != src:
                edges[src, dst] = edges.get((src, dst), 0) + 1
        rows.append((i, f"https://{src}{path}", "".join(f"<p><a class=x href='//{d.upper()}/'>{d}</a>" for d in out)))
    found = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    known = {r.host for r in found.values()} | {d for _, d in edges}
    allowed = {r.host for r in found.values() if r.verdict == "allow" and r.rule}
    bad = {h for h in known if h.endswith(".net") and h not in allowed}
    good = {h for h in allowed if not h.endswith(".net")}
    distrust, trust = arriving(edges, bad), arriving({(d, a): n for (a, d), n in edges.items()}, good)
    for r in found.values():
        assert (r.distrust, r.trust) == pytest.approx((distrust.get(r.host, 0.0), trust.get(r.host, 0.0)), abs=1e-3)
    con = duckdb.connect()
    con.register("pages", pd.DataFrame(rows, columns=["page_id", "url", "html"]))
    theirs = con.sql(url_filter.SQL).fetchall()
    assert sorted(theirs) == sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in found.values())
    assert {r.verdict for r in found.values() if not r.rule} == {"allow", "block"}


def test_pipeline(spark, tmp_path):
    """run() against brute force on small tables."""
    import corpus_pipeline

    cases.docs(spark).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    items = [(1, cases.prose(3, 40)), (2, "nothing that is there at all in any of the documents here")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path))
    kept = [(i, t) for i, t, *_ in cases.DOCS if any(c.isalpha() for c in t or "")]
    firsts = cases.near_survivors(kept)
    rest = [(i, left) for (i, _), left in zip(firsts, cases.characters_left([t for _, t in firsts]), strict=True)]
    clean = [(i, t) for i, t in rest if not cases.contamination(t, items)[1]]
    assert sorted(((r.doc_id, r.decoded_sha256) for r in got.collect()), key=str) == sorted(((i, cases.sha(t)) for i, t in clean), key=str) and len(clean) < len(rest) < len(kept)
    model = bpe.model(queries.vocabulary("byte_bpe_50k.tiktoken"), queries.pattern())
    assert {bytes(r.ids) for r in got.collect()} == set(model.encode([t for _, t in clean]))


def test_scratch_is_shared(spark):
    assert common.scratch(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_entry_names_all_queries():
    import __spark_entry__ as entry

    names = entry.queries()
    assert {f"op{n}_" for n in range(1, 14)} == {k.split("_")[0] + "_" for k in names if k.startswith("op")} and "pipeline" in names and set(entry.oracle_sql()) <= set(names)
