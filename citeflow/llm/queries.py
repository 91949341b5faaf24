"""The corpus operators as queries over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from citeflow.llm import conversations, decontaminate, gru_lm, langid, mixing, near_dedup, oracles, pii, span_dedup, token_counts, token_output, topk, toxicity, whitening
from citeflow.llm.common import table


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), size=2)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.token_output(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), "id % 50 = 0")


def op7_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All that goes by the operator's own rule, three sentences or fifty words, and which of it repeated runs of fifty words cover."""
    return span_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.probabilities(table(spark, sf_dir, "documents"))


def op10_gru_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gru_lm.scores(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    return conversations.digests(conversations.damage(given), given)


QUERIES = {
    f.__name__: f
    for f in (
        op1_near_dedup, op2_token_counts, op3_pii, op4_token_output, op5_decontaminate, op6_topk, op7_span_dedup, op8_langid, op9_mixing, op10_gru_lm,
        op11_whitening, op12_toxicity, op13_conversations,
    )
}

ORACLE_SQL = {"op5_decontaminate": oracles.OP5, "op6_topk": oracles.OP6, "op9_mixing": oracles.op9(), "op13_conversations": oracles.op13()}
