"""Scores, calibration, splits and mixes. ``labels`` plays the gold classes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeflow.operators import evaluate, splits
from citeflow.plans.catalog import query, table

_PAIRS_SQL = """pairs AS (
  SELECT l.doc_id, l.doc_id % 2 + 1 AS tier, ['real', 'inventada', 'incompleta'][CAST((l.quality + l.toxic * 2) % 3 + 1 AS INTEGER)] AS gold_class,
         ['real', 'inventada', 'incompleta'][CAST(CASE WHEN d.n_chars % 5 = 0 THEN (l.doc_id + 1) % 3 ELSE (l.quality + l.toxic * 2) % 3 END + 1 AS INTEGER)] AS found_class,
         l.doc_id AS gold_target, CASE WHEN d.n_chars % 7 = 0 THEN l.doc_id + 1 ELSE l.doc_id END AS found_target, (50 + l.doc_id % 50) / 100.0::DOUBLE AS confidence, d.lang, d.source
  FROM labels AS l JOIN documents AS d ON l.doc_id = d.doc_id
)"""


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source")
    names = F.array(F.lit("real"), F.lit("inventada"), F.lit("incompleta"))
    true = (F.col("quality") + F.col("toxic") * 2) % 3
    found = F.when(F.col("n_chars") % 5 == 0, (F.col("doc_id") + 1) % 3).otherwise(true)
    return table(spark, sf_dir, "labels").join(docs, "doc_id").select(
        "doc_id",
        (F.col("doc_id") % 2 + 1).alias("tier"),
        F.element_at(names, (true + 1).cast("int")).alias("gold_class"),
        F.element_at(names, (found + 1).cast("int")).alias("found_class"),
        F.col("doc_id").alias("gold_target"),
        F.when(F.col("n_chars") % 7 == 0, F.col("doc_id") + 1).otherwise(F.col("doc_id")).alias("found_target"),
        ((50 + F.col("doc_id") % 50) / 100.0).alias("confidence"),
        "lang",
        "source",
    )


@query(f"WITH {_PAIRS_SQL} SELECT gold_class, found_class, count(*) AS n FROM pairs GROUP BY gold_class, found_class")
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion(_pairs(spark, sf_dir))


_SCORES_SQL = f"""{_PAIRS_SQL}, c AS (SELECT unnest(['real', 'inventada', 'incompleta']) AS class), s AS (
  SELECT tier, class, sum(CASE WHEN gold_class = class AND found_class = class AND (class <> 'real' OR gold_target = found_target) THEN 1 ELSE 0 END) AS tp,
         sum(CASE WHEN found_class = class AND (gold_class <> class OR (class = 'real' AND gold_target <> found_target)) THEN 1 ELSE 0 END) AS fp,
         sum(CASE WHEN gold_class = class AND found_class <> class THEN 1 ELSE 0 END) AS fn, sum(CASE WHEN gold_class = class THEN 1 ELSE 0 END) AS g
  FROM pairs CROSS JOIN c GROUP BY tier, class
), f AS (SELECT *, coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS f1 FROM s WHERE g > 0)"""


@query(f"WITH {_SCORES_SQL} SELECT tier, class, tp::BIGINT AS tp, fp::BIGINT AS fp, fn::BIGINT AS fn, round(f1, 6)::DOUBLE AS f1 FROM f")
def class_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.class_scores(_pairs(spark, sf_dir)).withColumn("f1", F.round("f1", 6))


_TIERS_SQL = f"""{_SCORES_SQL}, t AS (
  SELECT tier, coalesce(avg(CASE WHEN gold_class = 'inventada' THEN CASE WHEN found_class = 'real' THEN 1.0 ELSE 0.0 END END), 0) AS tau,
         avg(pow(confidence - CASE WHEN gold_class = found_class AND (gold_class <> 'real' OR gold_target = found_target) THEN 1 ELSE 0 END, 2)) AS brier
  FROM pairs GROUP BY tier
), x AS (SELECT t.tier, avg(f1) AS macro_f1, any_value(tau) AS tau, any_value(brier) AS brier FROM f JOIN t ON f.tier = t.tier GROUP BY t.tier),
y AS (SELECT *, macro_f1 * (1 - tau / 2) * (1 + 0.1 * (1 - brier)) AS score FROM x)"""


@query(f"WITH {_TIERS_SQL} SELECT tier, round(macro_f1, 6)::DOUBLE AS macro_f1, round(tau, 6)::DOUBLE AS tau, round(brier, 6)::DOUBLE AS brier, round(score, 6)::DOUBLE AS score FROM y")
def macro_f1_tau_brier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = evaluate.tier_scores(_pairs(spark, sf_dir))
    return scores.select("tier", *(F.round(c, 6).alias(c) for c in ("macro_f1", "tau", "brier", "score")))


@query(f"WITH {_TIERS_SQL} SELECT round(sum(tier * score) / sum(tier), 6)::DOUBLE AS score FROM y")
def overall_tier_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.overall_score(evaluate.tier_scores(_pairs(spark, sf_dir))).select(F.round("score", 6).alias("score"))


_CALIBRATED_SQL = f"""{_PAIRS_SQL}, o AS (SELECT lang, source, gold_class, CASE WHEN gold_class = found_class THEN 1 ELSE 0 END AS hit FROM pairs),
n AS (SELECT lang, source, count(*) AS n, sum(hit) AS hits FROM o GROUP BY lang, source),
k AS (SELECT (sum(hits) + 6.79) / (sum(n) + 7.0) AS pooled FROM n),
r AS (SELECT n.*, (hits + 6.79) / (n + 7.0) AS own, pooled FROM n CROSS JOIN k),
u AS (SELECT *, hits * pow(1 - own, 2) + (n - hits) * pow(own, 2) >= hits * pow(1 - pooled, 2) + (n - hits) * pow(pooled, 2) AS uses_constant FROM r)"""


@query(f"WITH {_CALIBRATED_SQL} SELECT lang, source, n, hits::BIGINT AS hits, round(CASE WHEN uses_constant THEN pooled ELSE own END, 6)::DOUBLE AS rate, uses_constant FROM u")
def calibration_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.calibrate(_observed(spark, sf_dir), ["lang", "source"]).withColumn("rate", F.round("rate", 6))


def _observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).withColumn("hit", (F.col("gold_class") == F.col("found_class")).cast("long"))


@query(f"""WITH {_CALIBRATED_SQL}, g AS (SELECT lang, (sum(hit) + 6.79) / (count(*) + 7.0) AS class_rate FROM o GROUP BY lang)
SELECT d.doc_id, round(coalesce(CASE WHEN uses_constant THEN pooled ELSE own END, class_rate), 6)::DOUBLE AS confidence
FROM documents AS d LEFT JOIN u ON d.lang = u.lang AND d.source = u.source LEFT JOIN g ON d.lang = g.lang""")
def confidence_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    observed = _observed(spark, sf_dir)
    cells, classes = evaluate.calibrate(observed, ["lang", "source"]), evaluate.class_rates(observed, "lang")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return evaluate.with_confidence(docs, cells, classes, ["lang", "source"], "lang").select("doc_id", F.round("confidence", 6).alias("confidence"))


@query(f"""WITH {_PAIRS_SQL}, e AS (SELECT doc_id, gold_class, found_class, row_number() OVER (PARTITION BY gold_class, found_class ORDER BY doc_id) AS k FROM pairs WHERE gold_class <> found_class)
SELECT doc_id, gold_class, found_class, CAST(k AS INTEGER) AS k FROM e WHERE k <= 40""")
def topk_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 40 errors of each kind, as the error report lists them."""
    return evaluate.first_errors(_pairs(spark, sf_dir)).select("doc_id", "gold_class", "found_class", "k")


_KEYED = "(((doc_id % 1000003) + 3) * 48271) % 2147483647 % 2147483647"


@query(f"SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {_KEYED}, doc_id) <= 6 AS control FROM documents")
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return splits.stratified_control(docs, "lang", "doc_id", 6, seed=3)


@query("WITH n AS (SELECT count(DISTINCT doc_id // 2) AS n FROM documents) SELECT doc_id, doc_id // 2 AS pair, doc_id // 2 >= n - CAST(ceil(n * 0.2) AS BIGINT) AS control FROM documents CROSS JOIN n")
def twin_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.floor(F.col("doc_id") / 2).alias("pair"))
    pairs = docs.agg(F.countDistinct("pair")).first()[0]
    return docs.select("doc_id", "pair", splits.twin_split(F.col("pair"), pairs).alias("control"))


# Weights of the generator's constructions, which add up to 100.
CONSTRUCTIONS = {
    "real_acordao": 28, "inventada_numero": 4, "emprestada": 10, "mesmo_caso_outro_estagio": 12, "ambigua": 8, "real_sumula": 6,
    "sumula_inventada": 4, "real_lei": 3, "lei_inventada": 6, "lei_desconhecida": 2, "sem_numero": 15, "tema": 2,
}


def _choice_sql() -> str:
    total, cases = 0, []
    for name, w in CONSTRUCTIONS.items():
        total += w
        cases.append(f"WHEN h < {total} THEN '{name}'")
    return f"WITH k AS (SELECT event_id, (((event_id % 1000003) + 1) * 48271) % 2147483647 % {total} AS h FROM events) SELECT event_id, CASE {' '.join(cases)} END AS construction FROM k"


@query(_choice_sql())
def weighted_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = splits.keyed(F.col("event_id"), sum(CONSTRUCTIONS.values()), seed=1)
    return table(spark, sf_dir, "events").select("event_id", splits.weighted_choice(drawn, CONSTRUCTIONS).alias("construction"))


@query("""
SELECT doc_id, source, CAST(unnest(range(1, CASE WHEN source = 'src0' THEN 5 WHEN doc_id % 3 = 0 THEN 2 ELSE 1 END)) AS INTEGER) AS copy FROM documents
""")
def train_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source four times, a third of the others once."""
    times = F.when(F.col("source") == "src0", 4).when(F.col("doc_id") % 3 == 0, 1).otherwise(0)
    return splits.repeated_mix(table(spark, sf_dir, "documents").select("doc_id", "source"), times)


@query("""
SELECT d.source, d.lang, count(*) AS docs, count(l.doc_id) AS labelled, CAST(coalesce(sum(l.quality), 0) AS BIGINT) AS good, CAST(coalesce(sum(l.toxic), 0) AS BIGINT) AS toxic
FROM documents AS d LEFT JOIN labels AS l ON d.doc_id = l.doc_id GROUP BY CUBE (d.source, d.lang)
""")
def dataset_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "l_id")
    joined = table(spark, sf_dir, "documents").select("doc_id", "source", "lang").join(labels, F.col("doc_id") == F.col("l_id"), "left")
    return joined.cube("source", "lang").agg(
        F.count("*").alias("docs"), F.count("l_id").alias("labelled"), F.coalesce(F.sum("quality"), F.lit(0)).cast("long").alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).cast("long").alias("toxic")
    )
