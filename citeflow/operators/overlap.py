"""Interval operators within a document: overlap resolution, one-to-one matching, run differences.

A document's spans are folded as one sorted array; documents are the parallelism, and a document has few spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeflow.functions.intervals import half_covered, iou, strictly_inside, touching
from citeflow.schema import FORM_RANK


def form_rank(form: Column) -> Column:
    rank = F.lit(0)
    for name, value in FORM_RANK.items():
        rank = F.when(form == name, value).otherwise(rank)
    return rank


def resolve_overlaps(mentions: DataFrame, doc: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """Mentions (doc, start, end, form, origins, and the columns to ``carry``) that stand after overlaps are resolved.

    The more specific form goes first, then the one with more origins, the longer, the earlier. A mention within a
    chosen one goes; so does one that covers half of a chosen one's union; chosen ones within the new one give way.
    """
    item = F.struct(
        (-form_rank(F.col("form"))).alias("a"),
        (-F.size("origins")).alias("b"),
        (F.col("start") - F.col("end")).alias("c"),
        F.col("start").alias("start"),
        F.col("end").alias("end"),
        F.col("form").alias("form"),
        F.col("origins").alias("origins"),
        *carry,
    )

    def step(chosen: Column, x: Column) -> Column:
        within = F.exists(chosen, lambda y: strictly_inside(x["start"], x["end"], y["start"], y["end"]))
        rival = F.exists(chosen, lambda y: ~strictly_inside(y["start"], y["end"], x["start"], x["end"]) & half_covered(x["start"], x["end"], y["start"], y["end"]))
        left = F.filter(chosen, lambda y: ~strictly_inside(y["start"], y["end"], x["start"], x["end"]))
        return F.when(within | rival, chosen).otherwise(F.array_append(left, x))

    grouped = mentions.groupBy(doc).agg(F.array_sort(F.collect_list(item)).alias("items"))
    kept = F.aggregate("items", F.filter("items", lambda x: F.lit(False)), step)
    return grouped.select(doc, F.inline(kept)).select(doc, "start", "end", "form", "origins", *carry)


def matched_pairs(gold: DataFrame, found: DataFrame, doc: str = "doc_id") -> DataFrame:
    """All pairs (doc, gold_id, found_id, iou) of one document that share at least half of their union."""
    g = gold.select(doc, F.col("id").alias("gold_id"), F.col("start").alias("g_start"), F.col("end").alias("g_end"))
    p = found.select(doc, F.col("id").alias("found_id"), F.col("start").alias("p_start"), F.col("end").alias("p_end"))
    span = (F.col("g_start"), F.col("g_end"), F.col("p_start"), F.col("p_end"))
    return touching(g, p, [doc], "g_start", "g_end", "p_start", "p_end").where(half_covered(*span)).select(doc, "gold_id", "found_id", "g_start", "p_start", iou(*span).alias("iou"))


def match_one_to_one(gold: DataFrame, found: DataFrame, doc: str = "doc_id", by_gold: bool = False) -> DataFrame:
    """doc, gold_id, found_id, iou: greedy, the best pair first, each side at most once.

    Ties go to the earlier gold, then the earlier found interval. With ``by_gold`` the gold intervals choose in their
    own order instead, which is how two runs are compared.
    """
    first = (F.col("g_start"), -F.col("iou")) if by_gold else (-F.col("iou"), F.col("g_start"))
    item = F.struct(first[0].alias("a"), first[1].alias("b"), "p_start", "gold_id", "found_id", "iou")

    def step(taken: Column, x: Column) -> Column:
        used = F.exists(taken, lambda y: (y["gold_id"] == x["gold_id"]) | (y["found_id"] == x["found_id"]))
        return F.when(used, taken).otherwise(F.array_append(taken, x))

    pairs = matched_pairs(gold, found, doc).groupBy(doc).agg(F.array_sort(F.collect_list(item)).alias("items"))
    kept = F.aggregate("items", F.filter("items", lambda x: F.lit(False)), step)
    return pairs.select(doc, F.inline(kept)).select(doc, "gold_id", "found_id", "iou")


def outside_of(candidates: DataFrame, others: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Candidates that touch none of the others in their document (interval anti join)."""
    at, o = candidates.select(doc, "start", "end").distinct(), others.select(doc, F.col("start").alias("__start"), F.col("end").alias("__end"))
    met = touching(at, o, [doc], "start", "end", "__start", "__end").select(doc, "start", "end").distinct()
    return candidates.join(met, [doc, "start", "end"], "left_anti").select(*candidates.columns)


def run_difference(a: DataFrame, b: DataFrame, doc: str = "doc_id") -> DataFrame:
    """doc, change (gone, appeared, changed, same), a_id, b_id of two runs (id, start, end, label, target)."""
    pairs = match_one_to_one(a, b, doc, by_gold=True).select(doc, F.col("gold_id").alias("a_id"), F.col("found_id").alias("b_id"))
    left = a.select(doc, F.col("id").alias("a_id"), F.col("label").alias("a_label"), F.col("target").alias("a_target"))
    right = b.select(doc, F.col("id").alias("b_id"), F.col("label").alias("b_label"), F.col("target").alias("b_target"))
    both = left.join(pairs, [doc, "a_id"], "left").join(right, [doc, "b_id"], "full")
    same = F.col("a_label").eqNullSafe(F.col("b_label")) & F.col("a_target").eqNullSafe(F.col("b_target"))
    change = F.when(F.col("a_id").isNull(), "appeared").when(F.col("b_id").isNull(), "gone").when(same, "same").otherwise("changed")
    return both.select(doc, change.alias("change"), "a_id", "b_id")
