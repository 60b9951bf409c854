"""From documents to token ids: five stages, each of all that the one before it kept.

All stages take nulls in any column, empty and very long texts, repeated rows, empty tables and
further columns; but for the last they return the columns that they get. What each makes of
such rows is said below and, in full, in the operators' modules.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wonweave.llm import bpe, common, decontaminate, language, near, queries, substrings

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text has a language stay: null and empty texts, and those without a letter, go. Repeated rows stay. Where nothing can be learned, all rows with a letter stay."""
    common.bounded(spark)
    return language.drop_unknown(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies (Jaccard similarity of five-word shingles of 0.8 or more) stays.

    It is the one of the least doc_id (null last), of equal ones the least by the text's digest, then
    by the other columns; rows that share a doc_id but not a text are told apart. Texts without words
    are one group. Operator 6 links first, what it can't reach is completed, see wonweave.llm.near.
    """
    common.bounded(spark)
    return near.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose every string of 200 bytes that is found twice; rows stay, also those whose texts become empty; a null text stays null. n_chars follows the text."""
    common.bounded(spark)
    return substrings.without_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds a window of a benchmark item go. Null and empty texts hold none; an empty benchmark leaves all rows."""
    return decontaminate.drop_contaminated(docs, common.table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids and the digest of what these decode to, of every row; a null text has no ids."""
    common.bounded(spark)
    return bpe.encode(docs, queries.vocabulary("byte_bpe_50k.tiktoken"), queries.pattern(), ("doc_id", "lang", "source"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("token_ids", token_ids),
]
#: Neither language ID, links of near copies nor BPE can be said in SQL; tests hold run() against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
