"""The corpus pipeline: identify, deduplicate, decontaminate, mix, and write token ids.

Each stage takes what its predecessor kept, as a table with the columns of ``documents``; the last returns what it
read back from the token files.

Defined results: a null or empty text has no language and goes in the first stage; texts of any length are read whole;
rows with a null doc_id take part everywhere but teach no language; exact copies of a row, and rows without an id but
with one text, leave one row; of near duplicates the smallest doc_id stays; rows that share an id are drawn together;
null languages and sources are values of their own; further columns go through the stages, whatever their names; an
empty table gives no rows, and so do all stages after one that keeps nothing.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeflow.llm import decontaminate, langid, mixing, near_dedup, token_output
from citeflow.llm.common import crc_bucket, shared_path, table

#: Calibrated scores below this are no language that the model knows.
LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language: texts without letters and those with a low calibrated score go."""
    model = langid.train(docs.where(F.coalesce(crc_bucket("doc_id", 5) != 0, F.lit(False))))
    judged, names = langid.identify(docs, model, docs.columns)
    return judged.where((F.col(names["lang"]) != langid.UNKNOWN) & (F.col(names["score"]) >= LEAST_SCORE)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8 or more."""
    return near_dedup.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with less than a twentieth of their words in benchmark windows."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample in which small sources, languages and topics weigh more."""
    return mixing.mix(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 as read back from the shards."""
    return token_output.token_output(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("mixing", mix_sources),
    ("token_output", write_token_ids),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's output written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
