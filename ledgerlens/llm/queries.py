"""The operators' queries over the driver tables, and SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import chat, common, decontaminate, fertility, html, langid, lattice, neardup, ngram_lm, pii, rans


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_range_ans(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return rans.op1(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_tokenizer_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.op2(_read(spark, sf_dir, "documents"))


def op3_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.op3(_read(spark, sf_dir, "pages"))


def op4_sentencepiece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return lattice.op4(_read(spark, sf_dir, "documents"), lattice.load(public_tokenizers.path("piece_bpe_32k.model")))


def op5_bayes_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.join(_read(spark, sf_dir, "documents"))


def op6_chat_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = common.cut(chat.examples(chat.with_probe(_read(spark, sf_dir, "conversations"))), "chat")
    return chat.digest(chat.read_back(written))


def op7_prefix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.op7(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op8_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.op8(_read(spark, sf_dir, "documents"))


def op9_language_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.op9(_read(spark, sf_dir, "documents"))


def op10_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.op10(_read(spark, sf_dir, "documents"), pii.session_key(spark))


QUERIES = {
    f.__name__: f
    for f in (
        op1_range_ans,
        op2_tokenizer_fertility,
        op3_html_blocks,
        op4_sentencepiece_lattice,
        op5_bayes_jaccard_join,
        op6_chat_prefix_targets,
        op7_prefix_decontamination,
        op8_bloom_lm,
        op9_language_compression,
        op10_pii_surrogates,
    )
}

ORACLE_SQL: dict[str, str] = {"op7_prefix_decontamination": decontaminate.SQL}
