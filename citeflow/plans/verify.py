"""The whole way: documents and a registry to verified mentions.

The documents go once through the kernel of the normaliser, and their mentions once; what a mention needs later is cut
from the document's row before mentions are folded, so neither is read a second time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeflow.functions.text import without_accents
from citeflow.operators import evaluate, overlap
from citeflow.operators.decide import decide
from citeflow.operators.fields import read_fields
from citeflow.operators.normalise import body_in_norm, original_end, original_start, with_norm
from citeflow.operators.patterns import forms
from citeflow.operators.spans import all_matches, header_end
from citeflow.operators.tagger import tagger_mentions

LOOKED_UP = ("court", "case_class", "appeal_chain", "number", "state", "law_key", "article")


def prepare(docs: DataFrame) -> DataFrame:
    """doc_id, text, body_start, norm, map."""
    return with_norm(docs.select("doc_id", "text", header_end("text", labels=True).alias("body_start")))


def extract(prepared: DataFrame, with_vague: bool = False) -> DataFrame:
    """Mentions of the running text: doc_id, start, end (original), form, origins, snippet."""
    rows = prepared.withColumn("__at", body_in_norm(F.col("body_start"))).withColumn("__body", without_accents(F.expr("substring(norm, __at + 1)")))
    found = rows.select("doc_id", "text", "map", "body_start", "__at", F.inline(all_matches("__body", forms(with_vague))))
    found = found.select("doc_id", "text", "body_start", original_start(F.col("start") + F.col("__at")).alias("start"), original_end(F.col("end") + F.col("__at")).alias("end"), "form")
    kept = found.where((F.col("start") >= F.col("body_start")) & (F.col("end") > F.col("start")))
    spans = kept.select("doc_id", "start", "end", "form", F.array(F.lit("regex")).alias("origins"), F.expr("substring(text, start + 1, end - start)").alias("snippet"))
    return overlap.resolve_overlaps(spans, carry=("snippet",))


def with_fields(mentions: DataFrame) -> DataFrame:
    """``mentions`` with ``fields``, a tagger's ones only if their fields can be read; these say where they come from."""
    read = read_fields(with_norm(mentions, "snippet").drop("map")).drop("norm")
    tagged = F.array_contains("origins", "encoder")
    return read.where(~tagged | F.col("fields").isNotNull()).withColumn("fields", F.when(tagged, F.col("fields").withField("source", F.lit("encoder"))).otherwise(F.col("fields")))


def verify(docs: DataFrame, registry: DataFrame, with_vague: bool = False, tagger: DataFrame | None = None) -> DataFrame:
    """Every mention with its fields, path, verdict and target. ``tagger``: spans of one's own, doc_id, start, end, label."""
    prepared = prepare(docs)
    mentions = extract(prepared, with_vague)
    if tagger is not None:
        mentions = mentions.unionByName(tagger_mentions(tagger, prepared, mentions))
    mentions = with_fields(mentions).withColumn("mention_id", F.concat_ws(":", "doc_id", "start", "end")).withColumn("fields_read", F.col("fields").isNotNull())
    kind = F.when(F.col("form") == "lei_artigo", "lei").otherwise("jurisprudencia").alias("type")
    asked = mentions.select("mention_id", "doc_id", "start", "end", "snippet", "form", F.col("form").alias("stated_form"), kind, "fields", "fields_read", *(F.col(f"fields.{c}").alias(c) for c in LOOKED_UP))
    decided = decide(asked, registry, keep=("doc_id", "start", "end", "snippet", "type", "fields", "stated_form"))
    return decided.select("doc_id", "start", "end", "snippet", F.col("stated_form").alias("form"), "type", "fields", "path", "verdict", "canonical_id")


def with_rates(verified: DataFrame, cells: DataFrame, classes: DataFrame) -> DataFrame:
    """``verified`` with the confidence that the calibration (path, ocr_fixed, source; verdict) gives."""
    keyed = verified.withColumn("ocr_fixed", F.coalesce("fields.ocr_fixed", F.lit(False))).withColumn("source", F.coalesce("fields.source", F.lit("regras")))
    return evaluate.verdict_confidence(keyed, cells, classes).drop("ocr_fixed", "source")
