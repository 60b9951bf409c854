"""Small documents with every awkward case, and brute-force versions."""

import hashlib
import re
from collections import Counter

import numpy as np
import xxhash

WORDS = "the of and anton berlin quelle maison grande petit señor mañana perro straße über größe naïve été où ça very long words here 12 7x".split()


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(WORDS[i] for i in rng.integers(0, len(WORDS), n))


SHARED = prose(77, 70)
NEAR = prose(5, 300)
#: doc_id, text, lang, source, n_chars, and columns with names that the operators use themselves.
DOCS = [
    (1, None, "en", "a"), (2, "", None, "a"), (3, "x", "en", None), (4, prose(1, 120), "en", "a"), (5, prose(1, 120), "de", "b"), (5, prose(1, 120), "de", "b"), (6, prose(2, 80) + "\n" + SHARED + "\n" + prose(3, 40), "fr", "a"),
    (7, SHARED + " " + prose(4, 90), "fr", "a"), (8, NEAR, "en", "a"), (9, NEAR.replace("maison", "maisons", 1), "en", "a"), (None, prose(6, 60), "es", "a"), (None, prose(6, 60), "es", "a"), (10, "a" * 5000, "en", "a"), (11, "  two  spaces \t tabs\n\n \n lines nbsp  em it's don't <|endoftext|> 😀 é", "en", "a"),
    (12, prose(8, 20_000), "en", "c"), (13, "...", "en", "c"), (14, "Hello " * 400, "en", "c"), (15, prose(9, 12), "de", "c"), (15, prose(10, 13), "fr", "c"),
]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, key string, fp long, n int, body string, name long, words array<string>"


def docs(spark, rows=DOCS):
    return spark.createDataFrame([(i, t, lang, s, len(t or ""), "k", 1, 2, "b", 3, ["w"]) for i, t, lang, s in rows], COLUMNS)


def in_order(df):
    return sorted(map(tuple, df.collect()), key=str)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def components(rows, most=3):
    """component_id of each (doc_id, text)."""
    prints = [fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if group[i] > group[j] and (prints[i] ^ prints[j]).bit_count() <= most:
                    group[i], changed = group[j], True
    ids = {}
    for (doc, _), g in zip(rows, group, strict=True):
        if doc is not None:
            ids[g] = min(doc, ids.get(g, doc))
    return [(doc, f"{p:016x}", ids.get(g)) for (doc, _), p, g in zip(rows, prints, group, strict=True)]


def removed(texts, length=200):
    """Bytes of each text that stay, bytes removed, runs."""
    bodies = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in bodies for i in range(len(b) - length + 1))
    out = []
    for b in bodies:
        edge = np.zeros(len(b) + 1, int)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                edge[i] += 1
                edge[i + length] -= 1
        gone = np.cumsum(edge)[:-1] > 0
        out.append((bytes(np.frombuffer(b, np.uint8)[~gone]), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())))
    return out


def characters_left(texts, length=200):
    """Each text less the characters of which a byte is in a string of `length` bytes that is found twice."""
    seen = Counter(b[i : i + length] for t in texts for b in [(t or "").encode()] for i in range(len(b) - length + 1))
    out = []
    for t in texts:
        body, gone = (t or "").encode(), set()
        for i in range(len(body) - length + 1):
            if seen[body[i : i + length]] > 1:
                gone.update(range(i, i + length))
        left, at = [], 0
        for c in t or "":
            n = len(c.encode())
            if not gone & set(range(at, at + n)):
                left.append(c)
            at += n
        out.append("".join(left))
    return out


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def contamination(text, items):
    words, hit, found = bench_words(text), set(), set()
    for item, t in items:
        w = bench_words(t)
        m = min(10, len(w))
        windows = {tuple(w[i : i + m]) for i in range(len(w) - m + 1)} if w else set()
        for i in range(len(words) - m + 1):
            if m and tuple(words[i : i + m]) in windows:
                hit.update(range(i, i + m))
                if item is not None:
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def near_survivors(rows):
    """(doc_id, text) of the row that stays of each group of texts that chains of a Jaccard similarity of 0.8 or more over five-word shingles join."""
    sets = []
    for _, t in rows:
        w = lower(t or "").split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if group[i] != group[j] and (a == b or 5 * len(a & b) >= 4 * len(a | b)):
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    order = lambda r: (r[0] is None, r[0] or 0, "null" if r[1] is None else sha(r[1]))
    return [min((rows[k] for k in range(len(rows)) if group[k] == g), key=order) for g in sorted(set(group))]
