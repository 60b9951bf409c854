"""Operators on documents, against brute force, with nulls, ties, repeats, long texts and clashing columns."""

import base64
import zlib

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from wonweave.llm import bpe, decontaminate, language, quality, queries, simhash, substrings, token_io

TEXTS = [t for _, t, *_ in cases.DOCS]


@pytest.fixture(scope="module")
def docs(spark):
    return cases.docs(spark).repartition(3).cache()


def empty(spark):
    return spark.createDataFrame([], cases.COLUMNS)


def test_code_lengths_are_optimal_and_limited():
    n = np.array([1, 1, 2, 3, 5, 8, 13, 21])
    assert token_io.code_lengths(n, 16).tolist() == [7, 7, 6, 5, 4, 3, 2, 1]
    short = token_io.code_lengths(n, 4)
    assert short.max() == 4 and sum(2.0**-x for x in short) <= 1
    assert token_io.code_lengths(np.array([9]), 4).tolist() == [1] and token_io.code_lengths(np.ones(4, int), 2).tolist() == [2] * 4


@pytest.mark.parametrize("seed,n,ids", [(0, 1, 1), (1, 127, 3), (2, 128, 300), (3, 129, 5000), (4, 20_000, 50_000), (5, 0, 1)])
def test_blocks_round_trip(seed, n, ids):
    rng = np.random.default_rng(seed)
    x = np.minimum(rng.zipf(1.3, n), ids).astype(np.int64)
    code = token_io.Code.of({int(i): int(c) for i, c in zip(*np.unique(x, return_counts=True), strict=True)} or {0: 1})
    by_id, bits, to_id, to_bits = code.tables()
    payload, checkpoints = token_io.pack(x, by_id, bits)
    assert (token_io.unpack(payload, checkpoints, n, to_id, to_bits) == x).all()


def test_token_files(spark, docs):
    from tokenizers import Tokenizer

    path = queries.vocabulary("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    files = token_io.write_tokens(docs, path)
    got = token_io.read_tokens(spark, files).orderBy("start").collect()
    want = []
    for i, t, *_ in cases.DOCS:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        want.append((i is not None, i or 0, zlib.crc32(ids), i, ids))
    want.sort(key=lambda x: x[:3])
    start = 0
    for r, (*_, i, ids) in zip(got, want, strict=True):
        assert (r.doc_id, r.start, r.n_tokens, bytes(r.ids)) == (i, start, len(ids) // 4, ids)
        start += r.n_tokens
    digests = token_io.digests(spark, files).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in digests] == [(r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in got]
    assert token_io.digests(spark, token_io.write_tokens(empty(spark), path)).count() == 0


def test_ids_equal_the_library():
    """Chunks given to the model match by match, and those that aren't, against the whole tokenizer."""
    from tokenizers import Tokenizer

    path = queries.vocabulary("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    rng = np.random.default_rng(2)
    pieces = ["word", "Été", "über", "don't", "'s", "x_y", "12", "3a", "...", "#*", "<|endoftext|>", "<b>", " ", "  ", "\n", "\n\n", "\t", "\u00a0", "×", "ª", "😀", "日本", "\u0301", "a" * 70, "ﬀ", "½", "\x1c"]
    texts = ["".join(pieces[i] for i in rng.integers(0, len(pieces), n)) for n in [1, 2, 3, 5, 8, 40] * 60] + [" ".join(pieces[i] for i in rng.integers(0, len(pieces), 12)) for _ in range(60)] + [t or "" for t in TEXTS]
    for got, text in zip(token_io._cache(path).texts(texts), texts, strict=True):
        assert np.frombuffer(got, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)[:80]


def test_cache_generations():
    from wonweave.llm import common

    calls = []

    def encode(prefix, chunks):
        calls.extend(chunks)
        return [np.array([*(prefix + c).encode()], "<u4").tobytes() for c in chunks]

    cache = common.ChunkCache(encode, most=5, longest=4)
    texts = [" ".join(f"w{i % m}" for i in range(n)) for n, m in ((3, 2), (30, 9), (8, 4), (40, 30))] + ["longer words here"] * 2 + [" a", "a ", " ", "", "a a ", "x  y", "é\nü z"]
    for batch in (texts, texts[::-1], texts[:3], [None, *texts, ""]):
        assert [bytes(np.frombuffer(x, "<u4").tolist()).decode() for x in cache.texts(batch)] == [t or "" for t in batch]
    assert len(calls) < 300 and len(cache.key) <= 5 and len(cache.ids) <= 40


def test_cache_tells_words_apart(monkeypatch):
    """Where the hashes of two words agree, in a batch or between a batch and the cache, their bytes decide."""
    from wonweave.llm import common

    encode = lambda prefix, chunks: [np.array([*(prefix + c).encode()], "<u4").tobytes() for c in chunks]
    monkeypatch.setattr(common.ChunkCache, "_hash", staticmethod(lambda data, begin, end: np.zeros(len(begin), np.uint64)))
    cache = common.ChunkCache(encode)
    for batch in (["a b a"], ["c"], ["d"], ["a b"], ["d"], [" d"], ["dd"], ["d", "d"]):
        assert [bytes(np.frombuffer(x, "<u4").tolist()).decode() for x in cache.texts(batch)] == batch


def test_words_of_one_hash(spark):
    """Polynomials modulo 2**64 agree on a Thue-Morse word and the same with its letters swapped, whatever the base."""
    import public_tokenizers as p
    import tiktoken
    from tokenizers import Tokenizer

    from wonweave.llm import common

    words = ["".join("ab"[(k.bit_count() + turn) % 2] for k in range(n)) for n in (1024, 2048) for turn in (0, 1)]
    data = "".join(words).encode()
    begin = np.array([0, 1024, 2048, 4096])
    hashes = common.ChunkCache._hash(np.frombuffer(data, np.uint8), begin, begin + [1024, 1024, 2048, 2048])
    assert hashes[2] == hashes[3]
    texts = [*words, f"of {words[3]} and", f"of {words[2]} and"]
    path = queries.vocabulary("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    theirs = tiktoken.Encoding("own", pat_str=p.PATTERN, mergeable_ranks=ranks, special_tokens={})
    model = bpe.model(path, p.PATTERN)
    for batch in (texts, texts[::-1]):
        assert [np.frombuffer(x, "<u4").tolist() for x in model.encode(batch)] == [theirs.encode_ordinary(t) for t in batch]
    docs = cases.docs(spark, [(i, t, "en", "a") for i, t in enumerate(texts)]).coalesce(1)
    assert sorted((r.doc_id, r.decoded_sha256) for r in bpe.digests(docs, path, p.PATTERN).collect()) == [(i, cases.sha(t)) for i, t in enumerate(texts)]
    vocabulary = queries.vocabulary("byte_bpe_50k.json")
    library = Tokenizer.from_file(vocabulary)
    got = token_io.read_tokens(spark, token_io.write_tokens(docs, vocabulary)).orderBy("doc_id").collect()
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in got] == [[*library.encode(t, add_special_tokens=False).ids, 2] for t in texts]


def test_bpe_equals_the_library(spark, docs):
    import public_tokenizers as p
    import tiktoken

    path = queries.vocabulary("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    theirs = tiktoken.Encoding("own", pat_str=p.PATTERN, mergeable_ranks=ranks, special_tokens={})
    model = bpe.model(path, p.PATTERN)
    more = ["ab" * 700, "a" * 1500, "ሴ" * 900, "  ", " \n", "\n ", " a", "a ", "a  b", "x  y", "\x1c \x1d", "'s't 're", "0123456789" * 90, "é" * 600 + " " + "ü" * 600, *(TEXTS)]
    for t, ids in zip(more, model.encode(more), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == theirs.encode_ordinary(t or ""), repr(t)[:60]
        assert model.decode(ids) == (t or "").encode()
    want = sorted(((i, len(e := theirs.encode_ordinary(t or "")), cases.sha(np.array(e, "<u4").tobytes()), cases.sha((t or "").encode())) for i, t, *_ in cases.DOCS), key=str)
    assert cases.in_order(bpe.digests(docs, path, p.PATTERN)) == want
    assert bpe.digests(empty(spark), path, p.PATTERN).count() == 0


def test_simhash(spark, docs):
    want = sorted(cases.components([(i, t) for i, t, *_ in cases.DOCS]), key=str)
    assert cases.in_order(simhash.digests(simhash.near_duplicates(docs))) == want
    assert simhash.digests(simhash.near_duplicates(empty(spark))).count() == 0


def test_links_lose_none(spark, monkeypatch):
    """Random fingerprints, a dense ball of many, and each layout of parts."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 300, dtype=np.int64)
    ball = np.array([int(base[0]) ^ sum(1 << int(b) for b in rng.choice(20, 2, replace=False)) for _ in range(150)])
    chain = np.array([int(x) ^ (1 << int(b)) ^ (1 << int(c)) for x, b, c in zip(base[:100], rng.integers(0, 60, 100), rng.integers(0, 60, 100), strict=True)])
    fps = np.unique(np.concatenate([base, ball, chain]))
    nodes = spark.createDataFrame([(int(x),) for x in fps], "fp long")
    near = np.bitwise_count(fps[:, None] ^ fps) <= 3

    def groups(pairs):
        top = dict(zip(fps.tolist(), fps.tolist(), strict=True))

        def find(x):
            while top[x] != x:
                x = top[x]
            return x

        for u, v in pairs:
            a, b = find(int(u)), find(int(v))
            top[max(a, b)] = min(a, b)
        return {x: find(x) for x in top}

    want = groups([(fps[i], fps[j]) for i, j in np.argwhere(near) if i < j])
    got = [(r.u, r.v) for r in simhash.links(nodes).collect()]
    assert all(((u ^ v) & (2**64 - 1)).bit_count() <= 3 for u, v in got) and groups(got) == want and len(got) < 6 * len(fps)
    for probes in ([(list(range(32)), 1), (list(range(32, 64)), 1)], [(list(range(21)), 0), (list(range(21, 42)), 0), (list(range(42, 64)), 1)]):
        monkeypatch.setattr(simhash, "plan", lambda *_, probes=probes: probes)
        assert groups([(r.u, r.v) for r in simhash.links(nodes).collect()]) == want
    assert simhash.allocate([16] * 4, [0.0] * 4, 100, 3)[1] == [0, 0, 0, 0] and sum(t + 1 for t in simhash.allocate([16] * 4, [1e12, 0.0, 0.0, 0.0], 100, 3)[1]) == 4


def test_substrings(spark, docs):
    want = sorted(((i, len((t or "").encode()), n, runs, cases.sha(kept)) for (i, t, *_), (kept, n, runs) in zip(cases.DOCS, cases.removed(TEXTS), strict=True)), key=str)
    assert cases.in_order(substrings.digests(docs)) == want and sum(w[2] for w in want) > 1000
    assert substrings.digests(empty(spark)).count() == 0
    out = substrings.without_repeats(docs)
    assert out.columns == docs.columns and sorted(str((r.doc_id, r.text, r.n_chars)) for r in out.collect()) == sorted(str((i, t if t is None else left, len(left))) for (i, t, *_), left in zip(cases.DOCS, cases.characters_left(TEXTS), strict=True))


def test_no_character_is_made_of_parts(spark):
    """Strings that begin and end inside characters: what is left is whole characters of the text."""
    same = cases.prose(31, 60)[:240]
    texts = ["left ≤" + same + "☃ right", "q ቤ" + same + "♃ tail", "ሀ" + "é" * 130 + "ü", "ሁ" + "é" * 130 + "ý", "😀" + same[:197] + "😁", "🙀" + same[:197] + "🙁"]
    assert cases.removed(texts)[0][0].decode("utf-8", "ignore") == "left ☃ right"[:5] + "☃ right"
    rows = substrings.without_repeats(cases.docs(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])).orderBy("doc_id").collect()
    assert [r.text for r in rows] == cases.characters_left(texts) and all(set(r.text) <= set(t) and r.n_chars == len(r.text) for r, t in zip(rows, texts, strict=True))


@pytest.mark.parametrize("seed", range(3))
def test_substrings_of_noise(spark, seed):
    """Edits at every distance from shared passages, and periods."""
    rng = np.random.default_rng(seed)
    text = "".join(rng.choice(list("abcd é"), 4000))
    rows = [text[: 900 + seed], text[500:1400], "zz" + text[650:860], text[100:299] + "q", text[100:300], "ab" * 250, "ba" * 300, text[2000:2199], text[2000:2200] + text[2300:2650], text[1990:2700], "é" * 140, "xé" * 140]
    rows += [text[3000:3200] + "".join(rng.choice(list("abcd"), 30)) for _ in range(5)] + [text[3000 + i : 3200 + i] for i in range(4)]
    want = sorted(((i, len(t.encode()), n, runs, cases.sha(kept)) for i, (t, (kept, n, runs)) in enumerate(zip(rows, cases.removed(rows), strict=True))), key=str)
    assert cases.in_order(substrings.digests(cases.docs(spark, [(i, t, "en", "a") for i, t in enumerate(rows)]))) == want


def test_decontamination(spark, docs):
    items = [(1, cases.SHARED), (2, cases.SHARED[200:420]), (3, "very LONG words"), (4, None), (5, ""), (6, "--"), (None, cases.NEAR[:90]), (7, cases.prose(4, 90)[-70:]), (7, "x"), (8, " ".join(cases.NEAR.split()[:10]))]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, key int")
    want = []
    for i, t, *_ in cases.DOCS:
        n, hit, found = cases.contamination(t, items)
        want.append((i, n, hit, len(found), cases.sha(",".join(found)), hit > 0))
    assert cases.in_order(decontaminate.digests(decontaminate.find(docs, bench))) == sorted(want, key=str)
    clean = decontaminate.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns and clean.count() == sum(not w[5] for w in want)
    none = bench.limit(0)
    assert decontaminate.find(docs, none).filter("n_hit > 0").count() == 0 and decontaminate.find(empty(spark), bench).count() == 0


def test_language(spark, docs):
    rng = np.random.default_rng(0)
    parts = {"en": ["th", "ing", "er", "ou", "wh"], "de": ["sch", "ung", "ei", "ü", "cht"], "fr": ["eau", "é", "oi", "que", "ê"]}
    rows = [(i, " ".join("".join(rng.choice(parts[lang], 3)) for _ in range(30)), lang, "a") for i, lang in enumerate(list(parts) * 60)]
    both = cases.docs(spark, rows).unionByName(docs.filter("doc_id in (1, 2, 13)"))
    got = language.digests(both, language.train(both)).collect()
    assert len(got) == len(rows) + 3 and {r.lang_pred for r in got if r.doc_id == 13} >= {"und"}
    held = [(r.lang_pred, rows[r.doc_id][2]) for r in got if r.held_out and len(parts) and r.doc_id < len(rows) and r.score > 0]
    assert np.mean([a == b for a, b in held]) > 0.95 and all(0 <= r.score <= 1 for r in got)
    assert {r.held_out for r in got} == {True, False} and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    unlabelled = both.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.digests(unlabelled, language.train(unlabelled)).collect()} == {"und"}
    kept = language.drop_unknown(docs)
    assert kept.columns == docs.columns and kept.count() == sum(any(c.isalpha() for c in t or "") for t in TEXTS)
    assert language.digests(empty(spark), language.train(empty(spark))).count() == 0 and language.drop_unknown(empty(spark)).count() == 0


def test_lang_is_no_input(spark, docs):
    model = language.train(docs)
    a, b = (sorted(map(str, language.predict(d, model).collect())) for d in (docs, docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("y"))))
    assert a == b


def repeats(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    hit = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 5)} if len(words) < 2000 else None
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), None if hit is None else len(hit)


def test_quality(spark, docs):
    more = cases.docs(spark, [(20, "a b c d e f\na b c d e f\n\n x # b c d e f", "en", "a"), (21, "one two\none two\n \none two", "en", "a")])
    stats = {(r.doc_id, r.n_words): r for r in quality.statistics(docs.unionByName(more)).collect()}
    for i, t in [(i, t) for i, t, *_ in cases.DOCS] + [(r.doc_id, r.text) for r in more.collect()]:
        want = repeats(t)
        r = stats[i, want[0]]
        assert (r.word_chars, r.n_symbols, r.n_dup_lines) == want[1:4] and want[4] in (None, r.n_repeat_words)
    assert quality.train(quality.statistics(docs), spark.createDataFrame([], "doc_id long, quality int, toxic int")) == []
    judged, rules = quality.judge(empty(spark), spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int"))
    assert judged.count() == 0 and rules == []


def test_rules_are_learned(spark):
    rng = np.random.default_rng(1)
    bad = rng.random(900) < 0.3
    x = {s: rng.normal(size=900) for s in quality.TESTED}
    x["symbol_share"] = np.where(bad & (np.arange(900) % 2 == 0), 0.4, 0.0)
    x["distinct_share"] = np.where(bad & (np.arange(900) % 2 == 1), 0.2, 0.8)
    rules = quality.learn(x, bad)
    caught = np.zeros(900, bool)
    for rule in rules:
        caught |= quality._covers(rule, x)
    assert (caught == bad).mean() > 0.99
    df = spark.createDataFrame([tuple(float(x[s][i]) for s in quality.TESTED) for i in range(900)], ", ".join(f"{s} double" for s in quality.TESTED))
    assert [r.v is not None for r in df.select(quality.verdict(rules).alias("v")).collect()] == caught.tolist()
    assert quality.learn(x, np.zeros(900, bool)) == [] and quality.learn({s: v * 0 for s, v in x.items()}, bad) == []
