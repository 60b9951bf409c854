"""The queries opN_<name>: each applies its operator to its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wonweave.llm import bpe, chat_format, classifier, common, decontaminate, html_text, language, merkle, negatives, quality, simhash, substrings, token_io, url_filter

#: A conversation of control strings that the contract of operator 2 adds.
CONTROL_ROWS = "SELECT * FROM VALUES (-7L, 0, 'user', '</s>[INST] ok [/INST]'), (-7L, 1, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_token_huffman(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_io.write_tokens(common.table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return token_io.digests(spark, path)


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = common.table(spark, sf_dir, "conversations")
    control = spark.sql(CONTROL_ROWS).select(*[F.col(f.name).cast(rows.schema[f.name].dataType) for f in spark.sql(CONTROL_ROWS).schema.fields])
    turns = chat_format.frame_turns(rows.unionByName(control, allowMissingColumns=True))
    return chat_format.digests(common.staged(chat_format.formatted(turns), "chats"))


def op3_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digests(decontaminate.find(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark")))


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digests(common.table(spark, sf_dir, "documents"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.digests(html_text.extract(common.table(spark, sf_dir, "pages")))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digests(simhash.near_duplicates(common.table(spark, sf_dir, "documents")))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return language.digests(docs, language.train(docs))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(common.table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"), pattern())


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged, _ = quality.judge(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
    return quality.digests(judged)


def op10_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.digests(url_filter.judge(common.table(spark, sf_dir, "pages")))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(merkle.write(common.table(spark, sf_dir, "documents")))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(common.table(spark, sf_dir, "embeddings"))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, _ = classifier.judge(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
    return classifier.digests(scored)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_token_huffman, op2_chat_format, op3_winnowing, op4_substrings, op5_html_text, op6_simhash, op7_language, op8_byte_bpe, op9_quality_rules, op10_url_trust, op11_merkle_manifest, op12_hard_negatives, op13_quality_classifier)
}
SQL: dict[str, str] = {"op2_chat_format": chat_format.SQL, "op3_winnowing": decontaminate.SQL, "op4_substrings": substrings.SQL, "op10_url_trust": url_filter.SQL, "op11_merkle_manifest": merkle.SQL, "op12_hard_negatives": negatives.SQL}
