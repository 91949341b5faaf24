"""Scoring against gold labels, calibration of hit rates, and their lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeflow.functions.intervals import overlap, touching
from citeflow.operators.decide import class_of
from citeflow.operators.overlap import match_one_to_one
from citeflow.schema import LEAST_SEEN, PRIOR, SMOOTHING, VERDICT_CLASSES


def confusion(pairs: DataFrame) -> DataFrame:
    """gold_class, found_class, n; a missing side counts as ``espurio`` (no gold) or ``sem_span`` (not found)."""
    gold, found = F.coalesce("gold_class", F.lit("espurio")), F.coalesce("found_class", F.lit("sem_span"))
    return pairs.groupBy(gold.alias("gold_class"), found.alias("found_class")).agg(F.count("*").alias("n"))


def first_errors(pairs: DataFrame, most: int = 40, by: str = "doc_id") -> DataFrame:
    """The first ``most`` errors of each kind, numbered by k: a ranking with a limit, so no kind is ever listed whole."""
    wrong = pairs.where(~F.col("gold_class").eqNullSafe(F.col("found_class")))
    order = Window.partitionBy("gold_class", "found_class").orderBy(by)
    return wrong.withColumn("k", F.row_number().over(order)).where(F.col("k") <= most)


def _n(condition: Column) -> Column:
    return F.sum(F.coalesce(condition.cast("long"), F.lit(0)))


def class_scores(pairs: DataFrame, tier: str = "tier") -> DataFrame:
    """tier, class, tp, fp, fn, f1 of each verdict class.

    ``pairs`` has gold_class, found_class, gold_target, found_target. A ``real`` counts only with the right target; a
    wrong class costs both classes; a wrong target among two ``real`` costs one false positive.
    """
    g, p = F.col("gold_class"), F.col("found_class")
    right_target = F.coalesce(F.col("gold_target") == F.col("found_target"), F.lit(False))
    sides = pairs.withColumn("class", F.explode(F.array(*map(F.lit, VERDICT_CLASSES))))
    c = F.col("class")
    both = F.coalesce((g == c) & (p == c), F.lit(False))
    hit = both & ((c != "real") | right_target)
    extra = (F.coalesce(p == c, F.lit(False)) & ~both) | (both & ~hit)
    missed = F.coalesce(g == c, F.lit(False)) & ~both
    out = sides.groupBy(tier, "class").agg(_n(hit).alias("tp"), _n(extra).alias("fp"), _n(missed).alias("fn"), _n(g == c).alias("in_gold"))
    f1 = F.coalesce(F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), F.lit(0.0))
    return out.where("in_gold > 0").select(tier, "class", "tp", "fp", "fn", f1.alias("f1"))


def tier_scores(pairs: DataFrame, tier: str = "tier", bonus: float = 0.10) -> DataFrame:
    """tier, macro_f1, tau, brier, score: score = macro_f1 (1 - tau / 2) (1 + bonus (1 - brier))."""
    means = class_scores(pairs, tier).groupBy(tier).agg(F.avg("f1").alias("macro_f1"))
    invented = F.col("gold_class") == "inventada"
    right = (F.col("gold_class") == F.col("found_class")) & ((F.col("gold_class") != "real") | F.coalesce(F.col("gold_target") == F.col("found_target"), F.lit(False)))
    matched = F.col("gold_class").isNotNull() & F.col("found_class").isNotNull() & F.col("confidence").isNotNull()
    rest = pairs.groupBy(tier).agg(
        F.coalesce(F.avg(F.when(invented, F.coalesce(F.col("found_class") == "real", F.lit(False)).cast("double"))), F.lit(0.0)).alias("tau"),
        F.avg(F.when(matched, F.pow(F.col("confidence") - right.cast("double"), F.lit(2)))).alias("brier"),
    )
    share = F.when(F.col("brier").isNull(), F.lit(1.0)).otherwise(1 + bonus * (1 - F.col("brier")))
    return means.join(rest, tier).withColumn("score", F.col("macro_f1") * (1 - F.col("tau") / 2) * share)


def overall_score(tiers: DataFrame, tier: str = "tier") -> DataFrame:
    """Tiers weigh as their numbers: (1 first + 2 second) / 3."""
    return tiers.agg((F.sum(F.col(tier) * F.col("score")) / F.sum(tier)).alias("score"))


def smoothed_rate(hits: Column, n: Column) -> Column:
    return (hits + SMOOTHING * PRIOR) / (n + SMOOTHING)


def calibrate(observations: DataFrame, cell: list[str], hit: str = "hit") -> DataFrame:
    """``cell`` columns, n, hits, rate, uses_constant: the own smoothed rate where it beats the pooled one.

    A cell's squared error at rate r is hits (1 - r)^2 + misses r^2, so counts are all that is shuffled.
    """
    counts = observations.groupBy(*cell).agg(F.count("*").alias("n"), F.sum(F.col(hit).cast("long")).alias("hits"))
    pooled = counts.agg(smoothed_rate(F.sum("hits"), F.sum("n")).alias("pooled"))

    def error(r: Column) -> Column:
        return F.col("hits") * F.pow(1 - r, F.lit(2)) + (F.col("n") - F.col("hits")) * F.pow(r, F.lit(2))

    own = smoothed_rate(F.col("hits"), F.col("n"))
    rated = counts.join(F.broadcast(pooled)).withColumn("own", own).withColumn("uses_constant", error(F.col("own")) >= error(F.col("pooled")))
    return rated.select(*cell, "n", "hits", F.when(F.col("uses_constant"), F.col("pooled")).otherwise(F.col("own")).alias("rate"), "uses_constant")


def class_rates(observations: DataFrame, by: str, hit: str = "hit") -> DataFrame:
    return observations.groupBy(by).agg(smoothed_rate(F.sum(F.col(hit).cast("long")), F.count("*")).alias("class_rate"))


def with_confidence(rows: DataFrame, cells: DataFrame, classes: DataFrame, cell: list[str], by: str) -> DataFrame:
    """Confidence from the row's cell, else from its class, else null."""
    return rows.join(cells.select(*cell, "rate"), cell, "left").join(classes, by, "left").withColumn("confidence", F.coalesce("rate", "class_rate")).drop("rate", "class_rate")


def verdict_confidence(verdicts: DataFrame, cells: DataFrame, classes: DataFrame) -> DataFrame:
    """The lookup for verdicts: by path, misreading and source, else by the path's class."""
    named = verdicts.withColumn("verdict", class_of(F.col("path")))
    return with_confidence(named, cells, classes, ["path", "ocr_fixed", "source"], "verdict")


def aligned_pairs(gold: DataFrame, found: DataFrame, share: float = 0.9) -> DataFrame:
    """doc_id, gold_id, found_id of a run against gold (id, start, end): matched pairs, and what either side has alone.

    A found span without a partner is forgiven, and left out, if ``share`` of it lies in a gold span that has one.
    """
    pairs = match_one_to_one(gold, found).select("doc_id", "gold_id", "found_id")
    missed = gold.select("doc_id", F.col("id").alias("gold_id")).join(pairs.select("doc_id", "gold_id"), ["doc_id", "gold_id"], "left_anti")
    extra = found.withColumnRenamed("id", "found_id").join(pairs.select("doc_id", "found_id"), ["doc_id", "found_id"], "left_anti")
    taken = gold.select("doc_id", F.col("id").alias("gold_id"), F.col("start").alias("g_start"), F.col("end").alias("g_end")).join(pairs.select("doc_id", "gold_id"), ["doc_id", "gold_id"], "left_semi")
    held = overlap(F.col("start"), F.col("end"), F.col("g_start"), F.col("g_end")) >= share * (F.col("end") - F.col("start"))
    within = touching(extra.select("doc_id", "found_id", "start", "end"), taken.drop("gold_id"), ["doc_id"], "start", "end", "g_start", "g_end").where(held)
    extra = extra.join(within.select("doc_id", "found_id"), ["doc_id", "found_id"], "left_anti")
    nothing = F.lit(None)
    return pairs.unionByName(missed.withColumn("found_id", nothing.cast(found.schema["id"].dataType))).unionByName(extra.select("doc_id", nothing.cast(gold.schema["id"].dataType).alias("gold_id"), "found_id"))


def span_scores(pairs: DataFrame, *by: str) -> DataFrame:
    """Matched, gold and found spans with recall and precision; null where there is nothing to divide by."""
    matched = F.col("gold_id").isNotNull() & F.col("found_id").isNotNull()
    out = pairs.groupBy(*by).agg(F.count_if(matched).alias("matched"), F.count("gold_id").alias("gold"), F.count("found_id").alias("found"))
    return out.withColumn("recall", F.try_divide("matched", "gold")).withColumn("precision", F.try_divide("matched", "found"))


def observations(pairs: DataFrame, gold: DataFrame, found: DataFrame) -> DataFrame:
    """path, ocr_fixed, source, verdict and whether each matched mention's verdict (and target, if real) is right."""
    g = gold.select("doc_id", F.col("id").alias("gold_id"), F.col("verdict").alias("g_verdict"), F.col("canonical_id").alias("g_target"))
    f = found.select("doc_id", F.col("id").alias("found_id"), "path", "ocr_fixed", "source", "verdict", "canonical_id")
    right = (F.col("verdict") == F.col("g_verdict")) & ((F.col("g_verdict") != "real") | F.coalesce(F.col("canonical_id") == F.col("g_target"), F.lit(False)))
    matched = pairs.where("gold_id IS NOT NULL AND found_id IS NOT NULL")
    return matched.join(g, ["doc_id", "gold_id"]).join(f, ["doc_id", "found_id"]).select("path", "ocr_fixed", "source", "verdict", right.alias("hit"))


def calibration_summary(cells: DataFrame) -> DataFrame:
    """Of the cells of ``calibrate``: n, the Brier scores of the table and of the constant, cells seen too seldom, and whether to send confidences."""
    constant = smoothed_rate(F.sum("hits"), F.sum("n"))
    totals = cells.agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"), constant.alias("constant"), F.count_if(F.col("n") < LEAST_SEEN).alias("seldom"), F.sum(_squares(F.col("rate"))).alias("squares"))
    brier, flat = F.bround(F.try_divide("squares", "n"), 6), F.bround(F.try_divide(_squares(F.col("constant")), F.col("n")), 6)
    return totals.select("n", brier.alias("brier"), flat.alias("constant_brier"), "seldom", (brier <= flat).alias("send"))


def _squares(rate: Column) -> Column:
    return F.col("hits") * F.pow(1 - rate, F.lit(2)) + (F.col("n") - F.col("hits")) * F.pow(rate, F.lit(2))


def with_context(errors: DataFrame, trace: DataFrame, snippets: DataFrame) -> DataFrame:
    """Errors (doc_id, start, end) with the path of the trace and the snippet of the same place, where there are any."""
    at = ["doc_id", "start", "end"]
    return errors.join(trace.select(*at, "path"), at, "left").join(snippets.select(*at, "snippet"), at, "left")
