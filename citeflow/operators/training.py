"""Training examples for a tagger: labels, integrity, mixes, paraphrases and the choice between two models."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeflow.functions.intervals import touching
from citeflow.operators.sequence import overlapping_neighbours
from citeflow.operators.splits import repeated_mix

EXAMPLE = "origin string, document string, side string, text string, spans array<struct<start: int, end: int, label: string>>, ignored array<struct<start: int, end: int>>"

# How far around a span its scope is read, and what puts a span out of scope.
AROUND = 40


def with_sides(labels: DataFrame, sides: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Labels with the side their document is on; a document without a side fails the job."""
    joined = labels.join(sides.select(doc, "side"), doc, "left")
    return joined.withColumn("side", F.when(F.col("side").isNull(), F.raise_error(F.concat(F.lit("no side for "), F.col(doc)))).otherwise(F.col("side")))


def mapped_label(label: Column, snippet: Column, before: Column, after: Column, own_number: str, out_of_scope: str) -> Column:
    """citacao, proprio (the document's own number), fora (out of scope by what stands around), or ambigua (no digit)."""
    around = F.concat_ws(" ", F.substring(before, -AROUND, AROUND), F.substring(after, 1, AROUND))
    own = F.coalesce(snippet.rlike(own_number), F.lit(False))
    return F.when(own, "proprio").when(around.rlike(out_of_scope), "fora").when(~snippet.rlike("[0-9]"), "ambigua").when(label.isNotNull(), "citacao")


def overlapping_examples(examples: DataFrame) -> DataFrame:
    """Examples in which a span or an ignored region begins before its predecessor ends."""
    regions = F.concat(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))), "ignored")
    flat = examples.select("document", F.inline(regions)).withColumnRenamed("document", "doc_id")
    return overlapping_neighbours(flat)


def summary(examples: DataFrame) -> DataFrame:
    """origin, side, documents, spans, ignored."""
    return examples.groupBy("origin", "side").agg(F.count("*").alias("documents"), F.sum(F.size("spans")).alias("spans"), F.sum(F.size("ignored")).alias("ignored"))


def mixed(windows: DataFrame, copies: Mapping[str, int], empty_share: int = 3) -> DataFrame:
    """Training windows (side, origin, key, empty): each origin as often as ``copies`` says, one in ``empty_share`` of those without any label."""
    times = F.lit(1)
    for origin, n in copies.items():
        times = F.when(F.col("origin") == origin, n).otherwise(times)
    keep = (F.col("side") == "treino") & (~F.col("empty") | (F.pmod(F.xxhash64("key"), F.lit(empty_share)) == 0))
    return repeated_mix(windows.where(keep), times)


def challenger_wins(dev_gain: float, control_change: float, least_gain: float = 1.0) -> bool:
    """A new model replaces the old one if it gains more than ``least_gain`` on dev and loses nothing on control."""
    return dev_gain > least_gain and control_change >= 0


def paraphrased(rows: DataFrame, marker: str) -> DataFrame:
    """Usable paraphrases: ``rows`` (text, start, end, sentence_start, sentence_end, paraphrase) with new text and places.

    The paraphrase replaces the sentence and must hold the marker, which stands for the span, exactly once, and only
    Latin letters; rows that fail are left out. Places shift by what came in before them.
    """
    clean = F.size(F.split(F.col("paraphrase"), f"\\Q{marker}\\E", -1)) == 2
    latin = ~F.regexp_replace("paraphrase", f"\\Q{marker}\\E", "").rlike(r"[\p{L}&&[^\p{IsLatin}]]")
    snippet = F.expr("substring(text, start + 1, end - start)")
    at = F.col("sentence_start") + F.instr("paraphrase", marker) - 1
    text = F.concat(F.expr("substring(text, 1, sentence_start)"), F.replace("paraphrase", F.lit(marker), snippet), F.expr("substring(text, sentence_end + 1)"))
    good = rows.where(clean & latin).withColumn("new_text", text).withColumn("new_start", at).withColumn("new_end", at + F.col("end") - F.col("start"))
    return good.drop("text", "start", "end").withColumnsRenamed({"new_text": "text", "new_start": "start", "new_end": "end"})


def paraphrased_documents(docs: DataFrame, spans: DataFrame, paraphrases: DataFrame, marker: str) -> tuple[DataFrame, DataFrame]:
    """Documents with all usable paraphrases put in, and all their spans at their new places.

    ``docs``: doc_id, text. ``spans``: doc_id, start, end and more. ``paraphrases``: doc_id, sentence_start, sentence_end,
    paraphrase; a sentence is replaced if it holds one whole span and touches no other, begins where all that begin before
    it have ended, and its paraphrase passes as in ``paraphrased``. A span after replaced sentences moves by the running sum of
    their changes in length; the span within one goes to the marker's place.
    """
    clean = F.size(F.split(F.col("paraphrase"), f"\\Q{marker}\\E", -1)) == 2
    latin = ~F.regexp_replace("paraphrase", f"\\Q{marker}\\E", "").rlike(r"[\p{L}&&[^\p{IsLatin}]]")
    by = Window.partitionBy("doc_id").orderBy("sentence_start", "sentence_end", "paraphrase")
    every = by.rowsBetween(Window.unboundedPreceding, -1)
    usable = paraphrases.select("doc_id", "sentence_start", "sentence_end", "paraphrase").where(clean & latin)
    alone = usable.withColumn("__before", F.max("sentence_end").over(every)).where("__before IS NULL OR __before <= sentence_start").drop("__before")
    places = spans.select(F.col("doc_id").alias("__doc"), F.col("start").alias("s"), F.col("end").alias("e"))
    inside = (F.col("s") >= F.col("sentence_start")) & (F.col("e") <= F.col("sentence_end"))
    keys = ["doc_id", "sentence_start", "sentence_end", "paraphrase"]
    held = alone.join(places, (F.col("doc_id") == F.col("__doc")) & (F.col("s") < F.col("sentence_end")) & (F.col("e") > F.col("sentence_start")))
    held = held.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(inside).alias("whole"), F.min("s").alias("s"), F.min("e").alias("e")).where("n = 1 AND whole = 1")
    put = F.replace("paraphrase", F.lit(marker), F.expr("substring(text, s + 1, e - s)"))
    edits = held.join(docs.select("doc_id", "text"), "doc_id").select("doc_id", F.col("sentence_start").alias("at"), F.col("sentence_end").alias("stop"), put.alias("put"), (F.instr("paraphrase", marker) - 1).alias("offset"), "s")
    listed = edits.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("at", "stop", "put"))).alias("edits"))
    pieces = F.transform("edits", lambda x, i: F.concat(F.expr("text").substr(F.when(i == 0, 0).otherwise(F.get("edits", i - 1)["stop"]) + 1, x["at"] - F.when(i == 0, 0).otherwise(F.get("edits", i - 1)["stop"])), x["put"]))
    tail = F.expr("substring(text, element_at(edits, -1).stop + 1)")
    new_docs = docs.join(listed, "doc_id", "left").withColumn("text", F.when(F.col("edits").isNull(), F.col("text")).otherwise(F.concat(F.array_join(pieces, ""), tail))).drop("edits")
    change = (F.length("put") - (F.col("stop") - F.col("at"))).alias("change")
    events = edits.select("doc_id", F.col("at").alias("place"), change, F.struct("at", "offset", "s").alias("edit"), F.lit(None).cast(spans.select(F.struct(*spans.columns).alias("x")).schema["x"].dataType).alias("span"))
    moved = spans.select("doc_id", F.col("start").alias("place"), F.lit(0).alias("change"), F.lit(None).cast("struct<at: int, offset: int, s: int>").alias("edit"), F.struct(*spans.columns).alias("span"))
    order = Window.partitionBy("doc_id").orderBy("place", F.col("span").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    run = events.unionByName(moved).withColumn("shift", F.sum("change").over(order)).withColumn("last", F.last("edit", True).over(order)).withColumn("own", F.last(F.when(F.col("edit").isNotNull(), F.col("change")), True).over(order))
    within = F.coalesce(F.col("last.s") == F.col("span.start"), F.lit(False))
    start = F.when(within, F.col("last.at") + F.col("shift") - F.col("own") + F.col("last.offset")).otherwise(F.col("span.start") + F.col("shift"))
    out = run.where("span IS NOT NULL").select("span.*", start.cast("int").alias("__start"))
    return new_docs, out.withColumn("end", (F.col("__start") + F.col("end") - F.col("start")).cast("int")).withColumn("start", F.col("__start")).drop("__start")


def ignored_tokens(tokens: DataFrame, ignored: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Tokens with ``masked``: empty ones, and those that touch an ignored region."""
    regions = ignored.select(doc, F.col("start").alias("__start"), F.col("end").alias("__end"))
    hit = touching(tokens, regions, [doc], "start", "end", "__start", "__end").select(doc, "token").distinct()
    marked = tokens.join(hit.withColumn("__hit", F.lit(True)), [doc, "token"], "left")
    return marked.withColumn("masked", F.coalesce("__hit", F.lit(False)) | (F.col("start") >= F.col("end"))).drop("__hit")
