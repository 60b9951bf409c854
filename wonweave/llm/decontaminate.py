"""Operator 3: benchmark decontamination by winnowed word fingerprints; Spark SQL functions only.

Words are runs of 0-9, a-z and everything past ASCII, after A-Z are lower-cased. A window is
WINDOW consecutive words of an item; a shorter item is one window by itself. Of the hashes of
K consecutive words the least of each WINDOW - K + 1 in a row is kept as a fingerprint, so a
text that holds a window shares a fingerprint with it. (An item of m < WINDOW words has the
hash of its m words; texts keep all hashes of m words for each such m in the benchmark.)
Fingerprints keep their positions. Where a text has one of the benchmark's, the match is extended
to every whole window around it that the benchmark could have, and these are compared as words,
so that hash collisions don't matter. Texts without a common fingerprint aren't moved.

What is found depends on a text alone and is looked up by its digest: copies are compared
as one text, repeated rows each return. A null or empty text has no words; a text of any length
is one row. A null item_id takes part but isn't listed; repeated items count once. Empty tables
give rows without hits, or none. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wonweave.llm import common

WINDOW, K = 10, 5
#: A side of so many bytes at most is broadcast; a larger one is shuffled.
BROADCAST_BYTES = 32_000_000


def words(text: str = "text") -> Column:
    """The words of a column; none of null."""
    cut = F.split(common.lowered(F.col(text)), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.coalesce(F.array_remove(cut, ""), F.array().cast("array<string>"))


def _let(value: Column, body) -> Column:
    """body(value), with value computed once for a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


NO_PRINTS = "array<long>"


def _grams(hashes: Column, k: int) -> Column:
    """For each k words in a row their hash, and in the lower half their position."""
    at = lambda i: F.shiftleft(F.hash(*[F.get(hashes, i + F.lit(j)) for j in range(k)]).cast("long"), 32).bitwiseOR(i.cast("long"))
    return F.when(F.size(hashes) >= k, F.transform(F.sequence(F.lit(0), F.size(hashes) - F.lit(k)), at)).otherwise(F.array().cast(NO_PRINTS))


def print_of(gram: Column) -> Column:
    return F.shiftright(gram, 32).cast("int")


def place_of(gram: Column) -> Column:
    return gram.bitwiseAND(F.lit((1 << 32) - 1)).cast("int")


def fingerprints(hashes: Column, length: int) -> Column:
    """Distinct fingerprints of an array of word hashes with their positions, for windows of `length` words; of equal ones in a window the first."""
    k = min(K, length)
    w = length - k + 1
    if w == 1:
        return _grams(hashes, k)
    least = lambda g: F.transform(F.sequence(F.lit(1), F.size(g) - F.lit(w - 1)), lambda i: F.array_min(F.slice(g, i, w)))
    return F.array_distinct(_let(_grams(hashes, k), lambda g: F.when(F.size(g) >= w, least(g)).otherwise(F.array().cast(NO_PRINTS))))


def _bounded(df: DataFrame) -> DataFrame:
    """`df`, a staged table, to be broadcast if it is small in bytes."""
    size = F.lit(16)
    for f in df.schema.fields:
        size = size + (F.coalesce(F.octet_length(f.name), F.lit(0)) if f.dataType.typeName() == "string" else F.lit(8))
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_BYTES else df


def windows(items: DataFrame) -> DataFrame:
    """length, item_id, words (joined by spaces) of each window of each item."""
    w = items.select("item_id", words().alias("w")).filter(F.size("w") > 0).withColumn("length", F.least(F.size("w"), F.lit(WINDOW)))
    at = F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - F.col("length") + 1), lambda i: F.array_join(F.slice("w", i, F.col("length")), " ")))
    return w.select("length", "item_id", at.alias("words")).distinct()


PRINTS = "array<struct<length:int,gram:bigint>>"


def _print(length: int):
    return lambda gram: F.struct(F.lit(length).alias("length"), gram.alias("gram"))


def _key() -> Column:
    return F.md5(F.coalesce("text", F.lit(""))).alias("key")


def _around(at: Column, n: Column, lengths: list[int]) -> Column:
    """struct(length, start) of the windows of a text of n words that hold a fingerprint at its place, each once."""
    def starts(m: int) -> Column:
        back = m - min(K, m)
        return F.transform(F.filter(at, lambda x: x["length"] == m), lambda x: F.transform(F.sequence(F.greatest(x["place"] - back, F.lit(0)), F.least(x["place"], n - m)), lambda s: F.struct(F.lit(m).alias("length"), s.alias("start"))))

    return F.array_distinct(F.flatten(F.concat(*[starts(m) for m in lengths])))


def _covered(hits: Column) -> Column:
    """Words in any of the windows (start, length)."""
    end = lambda x: x["start"] + x["length"]
    step = lambda acc, x: F.struct(F.greatest(acc["to"], end(x)).alias("to"), (acc["n"] + F.greatest(end(x) - F.greatest(acc["to"], x["start"]), F.lit(0))).alias("n"))
    return F.aggregate(F.array_sort(hits), F.struct(F.lit(0).alias("to"), F.lit(0).alias("n")), step)["n"]


def find(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, key, n_words, n_hit, item_ids (sorted strings) of every row of `docs`."""
    found = common.staged(windows(items), "windows")
    own = common.staged(found.select("length", "words").distinct().withColumn("window", F.monotonically_increasing_id()), "windows-own")
    listed_by = common.staged(found.join(own, ["length", "words"]).filter("item_id IS NOT NULL").select("window", F.col("item_id").cast("string").alias("id")).distinct(), "windows-items")
    lengths = sorted(r.length for r in own.select("length").distinct().collect())  # ten values at most
    hashed = lambda w: F.transform(w, lambda x: F.hash(x))
    every = lambda h: F.concat(*[F.transform(fingerprints(h, m), _print(m)) for m in lengths]) if lengths else F.array().cast(PRINTS)
    prints = own.select(F.explode(_let(hashed(F.split("words", " ")), every)).alias("p"), "length").filter("p.length = length").select("length", print_of(F.col("p.gram")).alias("print"))
    prints = common.staged(prints.distinct(), "benchmark-prints")

    scanned = docs.select("doc_id", _key(), _let(words(), lambda w: F.struct(F.size(w).alias("n_words"), _let(hashed(w), every).alias("prints"))).alias("s"))
    scanned = common.staged(scanned.select("doc_id", "key", "s.n_words", "s.prints"), "document-prints")
    each = scanned.select("key", F.explode("prints").alias("p")).select("key", "p.length", print_of(F.col("p.gram")).alias("print"), place_of(F.col("p.gram")).alias("place"))
    places = each.join(_bounded(prints), ["length", "print"]).groupBy("key").agg(F.collect_set(F.struct("length", "place")).alias("at"))
    places = common.staged(places, "print-places")
    # copies meet in their own tasks first, so a large group of them is moved and searched as a few
    candidates = common.staged(places.select("key"), "candidates")
    texts = docs.select(_key(), "text").join(_bounded(candidates), "key", "left_semi").groupBy("key").agg(F.min("text").alias("text"))
    cut = texts.join(places, "key").select("key", words().alias("w"), "at")
    around = F.transform(_around(F.col("at"), F.size("w"), lengths), lambda x: F.struct(x["length"].alias("length"), x["start"].alias("start"), F.array_join(F.slice(F.col("w"), x["start"] + 1, x["length"]), " ").alias("words"))) if lengths else F.array().cast("array<struct<length:int,start:int,words:string>>")
    hits = cut.select("key", F.explode(around).alias("x")).select("key", "x.length", "x.start", "x.words")
    hits = common.staged(hits.join(_bounded(own), ["length", "words"]).select("key", "window", "length", "start"), "hits")
    covered = hits.groupBy("key").agg(_covered(F.collect_set(F.struct("start", "length"))).alias("n_hit"))
    listed = hits.select("key", "window").distinct().join(_bounded(listed_by), "window").groupBy("key").agg(F.array_sort(F.collect_set("id")).alias("item_ids"))
    # written first: the last join is then dealt out anew on both sides, and Spark can split a large group of copies
    by_text = common.staged(covered.join(listed, "key", "left"), "contaminated")
    common.drop(found, own, listed_by, prints, places, candidates, hits)
    return scanned.select("doc_id", "key", "n_words").join(by_text, "key", "left").select("doc_id", "key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))


def digests(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of `docs` whose text holds no window of an item."""
    bad = find(docs, items).filter("n_hit > 0").select(F.col("key").alias("__bad_key")).distinct()
    digest = F.md5(F.coalesce(docs["text"], F.lit("")))
    return docs.join(bad, digest == bad["__bad_key"], "left_anti")


SQL = """
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[p : p + least(len(w), 10) - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM i WHERE len(w) > 0)),
gr AS (SELECT doc_id, m, p, array_to_string(w[p : p + m - 1], ' ') AS g FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM d, (SELECT DISTINCT m FROM win) WHERE len(w) >= m)),
hit AS (SELECT DISTINCT doc_id, p, m, item_id FROM gr JOIN win USING (m, g)),
n AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + m)) AS q FROM hit) GROUP BY doc_id),
l AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hit GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN l USING (doc_id)
"""
