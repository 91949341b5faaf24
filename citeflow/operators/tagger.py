"""Spans from a tagger of one's own: the gates they pass, how they are counted, and tokens laid on raw text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeflow.functions.intervals import half_covered, overlap, touching
from citeflow.functions.text import without_accents
from citeflow.operators.fields import law_key
from citeflow.operators.overlap import outside_of
from citeflow.operators.patterns import CLASS
from citeflow.operators.spans import matches

_EDGE = " \t\n,;:()"


def trimmed(spans: DataFrame) -> DataFrame:
    """Spans (doc_id, start, end, label, text of the document) without white space and marks at their edges."""
    raw = F.expr("substring(text, start + 1, end - start)")
    edge = "[" + _EDGE.replace("(", "\\(").replace(")", "\\)") + "]*"
    lead, tail = F.length(F.regexp_extract("raw", f"^{edge}", 0)), F.length(F.regexp_extract("raw", f"{edge}$", 0))
    out = spans.withColumn("raw", raw).withColumn("start", F.col("start") + lead).withColumn("end", F.col("end") - tail)
    return out.where("end > start").withColumn("snippet", F.expr("substring(text, start + 1, end - start)")).drop("raw")


def gated(spans: DataFrame, regex_spans: DataFrame) -> DataFrame:
    """Tagger spans that add to the patterns' ones: in the body, touching no pattern span, and with something to look up."""
    s = F.col("snippet")
    plain = without_accents(s)
    ruling = (plain.rlike("(?i)sumula") & ~plain.rlike("(?i)administrativ")) | plain.rlike(f"(?i){CLASS}")
    statute = s.rlike("(?iu)^art") & law_key(F.regexp_extract(s, r"(?iu)\bd[oa]s?\s+(.+)$", 1)).isNotNull()
    anchored = s.rlike("[0-9]") & F.when(F.col("label") == "LEI", statute).otherwise(ruling)
    inside = trimmed(spans).where(F.col("start") >= F.col("body_start")).where(anchored)
    return outside_of(inside, regex_spans)


def tagger_mentions(spans: DataFrame, prepared: DataFrame, mentions: DataFrame) -> DataFrame:
    """Mentions (as ``mentions``) from tagger ``spans`` (doc_id, start, end, label) that pass the gates, with their own origin.

    Whether their fields can be read, the last gate, shows once they are read.
    """
    with_text = spans.join(prepared.select("doc_id", "text", "body_start"), "doc_id")
    kept = gated(with_text, mentions.select("doc_id", "start", "end"))
    precedent = F.col("snippet").rlike("(?iu)s[úu]mula")
    form = F.when(F.col("label") == "LEI", "lei_artigo").when(precedent, "sumula").otherwise("com_numero")
    return kept.select("doc_id", "start", "end", form.alias("form"), F.array(F.lit("encoder")).alias("origins"), "snippet")


def tag_counts(gold: DataFrame, found: DataFrame, ignored: DataFrame) -> DataFrame:
    """label, gold, matched, predicted, correct at half overlap; predictions that touch ignored regions do not count."""
    kept = outside_of(found, ignored)
    g = gold.select("doc_id", "label", F.col("start").alias("g_start"), F.col("end").alias("g_end"))
    p = kept.select("doc_id", "label", F.col("start").alias("p_start"), F.col("end").alias("p_end"))
    pairs = touching(g, p, ["doc_id", "label"], "g_start", "g_end", "p_start", "p_end").where(half_covered(F.col("g_start"), F.col("g_end"), F.col("p_start"), F.col("p_end")))
    counts = [
        g.groupBy("label").agg(F.count("*").alias("gold")),
        pairs.select("doc_id", "label", "g_start", "g_end").distinct().groupBy("label").agg(F.count("*").alias("matched")),
        p.groupBy("label").agg(F.count("*").alias("predicted")),
        pairs.select("doc_id", "label", "p_start", "p_end").distinct().groupBy("label").agg(F.count("*").alias("correct")),
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.join(c, "label", "full")
    return out.select("label", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("gold", "matched", "predicted", "correct")))


def recall(gold: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id, start, end of every gold span with whether some found one touches it, and whether one covers half."""
    p = found.select("doc_id", F.col("start").alias("p_start"), F.col("end").alias("p_end"))
    span = (F.col("start"), F.col("end"), F.col("p_start"), F.col("p_end"))
    met = touching(gold.select("doc_id", "start", "end").distinct(), p, ["doc_id"], "start", "end", "p_start", "p_end")
    found_half = met.groupBy("doc_id", "start", "end").agg(F.max(half_covered(*span)).alias("half"))
    rows = gold.select("doc_id", "start", "end").distinct().join(found_half, ["doc_id", "start", "end"], "left")
    return rows.select("doc_id", "start", "end", F.col("half").isNotNull().alias("touched"), F.coalesce("half", F.lit(False)).alias("half"))


def forgiven(gold: DataFrame, found: DataFrame) -> DataFrame:
    """Found spans nine tenths of which lie in one gold span: unmatched, they are not counted as wrong."""
    g = gold.select("doc_id", F.col("start").alias("g_start"), F.col("end").alias("g_end"))
    common = overlap(F.col("start"), F.col("end"), F.col("g_start"), F.col("g_end"))
    return touching(found, g, ["doc_id"], "start", "end", "g_start", "g_end").where(10 * common >= 9 * (F.col("end") - F.col("start"))).select(*found.columns).distinct()


def laid_on(tokens: Column, text: Column, look_ahead: int = 200) -> Column:
    """array<struct<start, end>>: each token's place in the text after the one before; null beyond ``look_ahead``."""
    empty = F.expr("named_struct('at', 0, 'out', CAST(array() AS array<struct<start: int, end: int>>))")

    def step(a: Column, token: Column) -> Column:
        found = F.instr(F.substring(text, a["at"] + 1, F.length(token) + look_ahead), token)
        start = a["at"] + found - 1
        place = F.when(found > 0, F.struct(start.cast("int").alias("start"), (start + F.length(token)).cast("int").alias("end")))
        return F.struct(F.when(found > 0, (start + F.length(token)).cast("int")).otherwise(a["at"]).alias("at"), F.array_append(a["out"], place).alias("out"))

    return F.aggregate(tokens, empty, step, lambda a: a["out"])


def words_with_places(column: str) -> Column:
    """The tokens of a text, words or single marks, with their places."""
    return matches(column, r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]")
