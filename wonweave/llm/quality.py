"""Operator 9: quality statistics, and a decision list that is learned from labelled ones.

Statistics are of whole texts, however long. The list is learned by sequential covering: a rule grows, one
threshold at a time, by the gain in information on two thirds of the labelled rows, is pruned
on the other third, and is kept if it is precise enough there; what it covers leaves. The rules
become conditional Spark expressions, tried in order; the first that holds gives the verdict,
and what none covers is kept.

Labelled rows are a bounded sample, about TRAIN_ROWS by a hash of doc_id and never over twice as
many; of conditions that gain as much the first in order counts; labels of one doc_id that
disagree, and nulls, don't count. A null or empty text has no words, so it fails the base rules.
Repeated rows each return. Empty tables give empty results, empty labels an empty list, with
which everything is kept that passes the base rules. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wonweave.llm import common

TRAIN_ROWS = 20_000
#: A rule's precision on the rows that it is pruned on, and how many bad rows it must cover in all.
LEAST_PRECISION, LEAST_COVERED, MOST_CONDITIONS = 0.95, 8, 3
WINDOW = 5
SYMBOLS = "#*$%&|<>"
#: Statistics that rules may test; the rest of STATS are what they are made of.
TESTED = ("n_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share", "distinct_share", "longest_word", "words_per_line", "stop_share")
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *TESTED[1:])


def _repeated(words: list[bytes]) -> int:
    """Words in windows of WINDOW words that are found twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    # windows are numbered exactly: pairs of numbers are numbered anew, of 2, 4 and then 5 words
    two = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)[1]
    four = np.unique(two[:-2] * (int(two.max()) + 1) + two[2:], return_inverse=True)[1]
    _, five, count = np.unique(four[:-1] * len(numbers) + ids[4:], return_inverse=True, return_counts=True)
    again = np.flatnonzero(count[five] > 1)
    if not len(again):
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + WINDOW, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def statistics_of(text: str | None) -> list[float]:
    text = text or ""
    words = text.encode().split()
    n = len(words)
    spaces = sum(map(text.count, " \t\n\v\f\r"))
    word_chars = len(text) - spaces
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    dup, repeat, distinct = len(lines) - len(set(lines)), _repeated(words), set(words)
    short = sum(len(w) <= 3 for w in words)
    upper = sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    digits = sum(map(text.count, "0123456789"))
    chars, some = max(word_chars, 1), max(n, 1)
    return [n, word_chars, symbols, dup, repeat, word_chars / some, symbols / chars, dup / max(len(lines), 1), repeat / some, upper / chars, digits / chars, len(distinct) / some, max(map(len, distinct), default=0), n / max(len(lines), 1), short / some]


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and STATS of every row."""
    counts = STATS[:5]
    schema = pa.schema([("doc_id", pa.int64()), *[(s, pa.int64() if s in counts else pa.float64()) for s in STATS]])

    def work(columns: list[list]) -> list:
        rows = [statistics_of(t) for t in columns[1]]
        return [columns[0], *([r[i] for r in rows] for i in range(len(STATS)))]

    ddl = ", ".join(["doc_id long", *(f"{s} {'long' if s in counts else 'double'}" for s in STATS)])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(common.by_slice(schema, work), ddl)


@dataclass(frozen=True)
class Condition:
    stat: str
    above: bool
    level: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.stat] > self.level if self.above else x[self.stat] <= self.level

    def column(self) -> Column:
        return F.col(self.stat) > self.level if self.above else F.col(self.stat) <= self.level


Rule = tuple[Condition, ...]


def _covers(rule: Rule, x: dict[str, np.ndarray]) -> np.ndarray:
    out = np.ones(len(next(iter(x.values()))), bool)
    for c in rule:
        out &= c.holds(x)
    return out


def _best_condition(x: dict[str, np.ndarray], bad: np.ndarray) -> tuple[float, Condition | None]:
    """The threshold of the most information gain (bad rows covered, times what their share gains in bits)."""
    n_bad, n = int(bad.sum()), len(bad)
    before = np.log2(max(n_bad, 1) / max(n, 1))
    best: tuple[float, Condition | None] = (0.0, None)
    for stat in TESTED:
        order = np.argsort(x[stat], kind="stable")
        v, b = x[stat][order], np.cumsum(bad[order])
        at = np.flatnonzero(v[1:] > v[:-1])  # cut behind these
        if not len(at):
            continue
        for above in (False, True):
            p = (n_bad - b[at] if above else b[at]).astype(float)
            t = (n - at - 1 if above else at + 1).astype(float)
            gain = p * (np.log2(np.maximum(p, 1e-9) / t) - before)
            k = int(gain.argmax())
            if gain[k] > best[0] + 1e-9:
                best = (float(gain[k]), Condition(stat, above, float((v[at[k]] + v[at[k] + 1]) / 2)))
    return best


def _take(x: dict[str, np.ndarray], keep: np.ndarray) -> dict[str, np.ndarray]:
    return {k: v[keep] for k, v in x.items()}


def learn(x: dict[str, np.ndarray], bad: np.ndarray) -> list[Rule]:
    """Ordered rules for bad rows."""
    rules: list[Rule] = []
    prune = np.arange(len(bad)) % 3 == 2
    while True:
        gx, gb, px, pb = _take(x, ~prune), bad[~prune], _take(x, prune), bad[prune]
        if gb.sum() < LEAST_COVERED:
            return rules
        rule: Rule = ()
        inside = np.ones(len(gb), bool)
        while len(rule) < MOST_CONDITIONS and not gb[inside].all():
            _, c = _best_condition(_take(gx, inside), gb[inside])
            if c is None:
                break
            rule += (c,)
            inside &= c.holds(gx)

        def worth(r: Rule) -> tuple[float, int]:
            got = _covers(r, px)
            p, t = int(pb[got].sum()), int(got.sum())
            return ((2 * p - t) / t if t else -1.0, p)

        rule = max((rule[:k] for k in range(1, len(rule) + 1)), key=worth, default=())
        if not rule:
            return rules
        held, all_held = _covers(rule, px), _covers(rule, x)
        precise = pb[held].sum() >= LEAST_PRECISION * max(held.sum(), 1) and bad[all_held].sum() >= LEAST_PRECISION * all_held.sum()
        if not precise or bad[all_held].sum() < LEAST_COVERED or not held.any():
            return rules
        rules.append(rule)
        x, bad, prune = _take(x, ~all_held), bad[~all_held], prune[~all_held]


def train(stats: DataFrame, labels: DataFrame) -> list[Rule]:
    """Rules from `labels` (doc_id, quality 0 or 1)."""
    agreed = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).filter("quality = most").select("doc_id", "quality")
    n = agreed.count()
    if not n:
        return []
    draw = common.draw(F.col("doc_id"), 9)
    # about TRAIN_ROWS rows, and never over twice as many, whatever n
    sampled = agreed.filter(draw < min(1.0, TRAIN_ROWS / n)).orderBy(draw, "doc_id").limit(2 * TRAIN_ROWS)
    # one row of each doc_id, so that the sample is as large as it says
    one = stats.join(sampled, "doc_id").groupBy("doc_id", "quality").agg(F.min(F.struct(*TESTED)).alias("s"))
    rows = one.select("doc_id", "quality", "s.*").withColumn("draw", draw).collect()
    if not rows:
        return []
    rows.sort(key=lambda r: (r.draw, r.doc_id, *(r[s] for s in TESTED)))
    return learn({s: np.array([r[s] for r in rows], float) for s in TESTED}, np.array([r.quality == 0 for r in rows]))


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that holds, null if none."""
    out = None
    for i, rule in enumerate(rules):
        holds = F.lit(True)
        for c in rule:
            holds = holds & c.column()
        out = F.when(holds, i) if out is None else out.when(holds, i)
    return (out if out is not None else F.lit(None)).cast("int")


def judge(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, list[Rule]]:
    """doc_id, STATS, base_failed, rule (that covers it, from 0), kept of every row; and the rules."""
    stats = common.staged(statistics(docs), "statistics")
    rules = train(stats, labels)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    judged = stats.withColumn("base_failed", failed).withColumn("rule", verdict(rules))
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()), rules


def digests(judged: DataFrame) -> DataFrame:
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
