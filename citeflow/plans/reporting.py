"""Reports: a run against gold, observations for calibration, splits, firsts and most frequent keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citeflow.operators import evaluate, splits
from citeflow.plans.catalog import query, table

_CLASSES = ("real", "inventada", "incompleta")
_SPANS = """o AS (
  SELECT o_orderkey AS k, o_custkey AS doc_id, 100 * row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS a, o_orderkey % 3 + 1 AS cls FROM orders
)"""


def _spans(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Gold spans of 20 characters, and found ones: the same, moved a little, moved too far, none, or a part of them besides."""
    order = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    k, c = F.col("k"), F.array(*map(F.lit, _CLASSES))
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("doc_id"), (100 * F.row_number().over(order)).alias("a"))
    kind = k % 4
    gold = rows.select("doc_id", k.alias("id"), F.col("a").alias("start"), (F.col("a") + 20).alias("end"), F.element_at(c, (k % 3 + 1).cast("int")).alias("verdict"), k.cast("string").alias("canonical_id"))
    moved = F.element_at(F.array(*map(F.lit, (0, 5, 15))), (kind + 1).cast("int"))
    whole = rows.where(kind < 3).select("doc_id", k.alias("id"), (F.col("a") + moved).alias("start"), (F.col("a") + moved + 20).alias("end"))
    part = rows.where(k % 8 == 0).select("doc_id", (-k - 1).alias("id"), (F.col("a") + 2).alias("start"), (F.col("a") + 12).alias("end"))
    found = whole.unionAll(part).withColumn("verdict", F.when(F.abs("id") % 7 == 0, "real").otherwise(F.element_at(c, (F.abs("id") % 3 + 1).cast("int")))).withColumn("canonical_id", F.abs("id").cast("string"))
    path = F.when(F.abs("id") % 2 == 0, "numero_unico").otherwise("numero_ausente")
    return gold, found.withColumns({"path": path, "ocr_fixed": F.abs("id") % 5 == 0, "source": F.lit("regras")})


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.aligned_pairs(*_spans(spark, sf_dir))


_PAIRS = f"""{_SPANS}, pairs AS (
  SELECT doc_id, k AS gold_id, k AS found_id FROM o WHERE k % 4 < 2
  UNION ALL SELECT doc_id, k, NULL FROM o WHERE k % 4 >= 2
  UNION ALL SELECT doc_id, NULL, k FROM o WHERE k % 4 = 2
)"""


@query(f"WITH {_PAIRS} SELECT * FROM pairs")
def report_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches, and both sides' rests; parts of matched spans are forgiven."""
    return _pairs(spark, sf_dir)


@query(f"""WITH {_PAIRS} SELECT count(*) FILTER (WHERE gold_id IS NOT NULL AND found_id IS NOT NULL) AS matched, count(gold_id) AS gold, count(found_id) AS found,
  count(*) FILTER (WHERE gold_id IS NOT NULL AND found_id IS NOT NULL) / count(gold_id)::DOUBLE AS recall, count(*) FILTER (WHERE gold_id IS NOT NULL AND found_id IS NOT NULL) / count(found_id)::DOUBLE AS precision FROM pairs""")
def span_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.span_scores(_pairs(spark, sf_dir))


_OBSERVED = f"""{_PAIRS}, obs AS (
  SELECT CASE WHEN gold_id % 2 = 0 THEN 'numero_unico' ELSE 'numero_ausente' END AS path, gold_id % 5 = 0 AS ocr_fixed,
         gold_id % 7 <> 0 OR gold_id % 3 = 0 AS hit FROM pairs WHERE gold_id IS NOT NULL AND found_id IS NOT NULL
)"""


@query(f"WITH {_OBSERVED} SELECT path, ocr_fixed, 'regras' AS source, count(*) AS n, count(*) FILTER (WHERE hit) AS hits FROM obs GROUP BY path, ocr_fixed")
def trace_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each path was right, from spans laid on gold."""
    gold, found = _spans(spark, sf_dir)
    seen = evaluate.observations(evaluate.aligned_pairs(gold, found), gold, found)
    return seen.groupBy("path", "ocr_fixed", "source").agg(F.count("*").alias("n"), F.count_if("hit").alias("hits"))


@query(f"""
WITH {_OBSERVED}, c AS (SELECT path, ocr_fixed, count(*) AS n, count(*) FILTER (WHERE hit) AS hits FROM obs GROUP BY path, ocr_fixed),
t AS (SELECT *, (sum(hits) OVER () + 7 * 0.97) / (sum(n) OVER () + 7) AS pooled, (hits + 7 * 0.97) / (n + 7) AS own FROM c),
r AS (SELECT *, CASE WHEN hits * (1 - own) ** 2 + (n - hits) * own ** 2 >= hits * (1 - pooled) ** 2 + (n - hits) * pooled ** 2 THEN pooled ELSE own END AS rate FROM t),
s AS (SELECT sum(n)::BIGINT AS n, sum(hits * (1 - rate) ** 2 + (n - hits) * rate ** 2) / sum(n) AS brier, sum(hits * (1 - pooled) ** 2 + (n - hits) * pooled ** 2) / sum(n) AS flat, count(*) FILTER (WHERE n < 5) AS seldom FROM r)
SELECT n, round(brier, 6) AS brier, round(flat, 6) AS constant_brier, seldom, round(brier, 6) <= round(flat, 6) AS send FROM s
""")
def calibration_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold, found = _spans(spark, sf_dir)
    seen = evaluate.observations(evaluate.aligned_pairs(gold, found), gold, found)
    return evaluate.calibration_summary(evaluate.calibrate(seen, ["path", "ocr_fixed", "source"]))


@query(f"""
WITH {_SPANS} SELECT doc_id, CAST(a AS INTEGER) AS start, CAST(a + 20 AS INTEGER) AS "end", CASE WHEN k % 4 = 0 THEN CASE WHEN k % 2 = 0 THEN 'numero_unico' ELSE 'numero_ausente' END END AS path, CASE WHEN k % 6 = 0 THEN 'order ' || k END AS snippet
FROM o WHERE k % 7 = 0
""")
def error_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors with the path and the snippet of the same place, if there are any."""
    gold, found = _spans(spark, sf_dir)
    snippets = gold.where("id % 6 = 0").select("doc_id", "start", "end", F.concat(F.lit("order "), "id").alias("snippet"))
    return evaluate.with_context(gold.where("id % 7 = 0").select("doc_id", "start", "end"), found, snippets)


@query("""
WITH s AS (SELECT 'dev' AS split, doc_id FROM documents WHERE doc_id % 5 = 0 UNION ALL SELECT 'control', doc_id FROM documents WHERE doc_id % 10 = 3), g AS (SELECT DISTINCT doc_id FROM labels),
c AS (SELECT split, count(DISTINCT s.doc_id) AS documents, count(DISTINCT g.doc_id) AS in_gold FROM s LEFT JOIN g ON s.doc_id = g.doc_id GROUP BY split
UNION ALL SELECT '(none)', count(*), count(*) FROM g WHERE doc_id NOT IN (SELECT doc_id FROM s))
SELECT *, documents - in_gold AS only_split, documents = in_gold AS complete FROM c
""")
def split_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id")
    split = docs.where("doc_id % 5 = 0").select(F.lit("dev").alias("split"), "doc_id").unionAll(docs.where("doc_id % 10 = 3").select(F.lit("control"), "doc_id"))
    return splits.split_catalog(split, table(spark, sf_dir, "labels"))


@query("SELECT source, count(*) AS n FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) GROUP BY source")
def split_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "good").otherwise("other").alias("split"))
    return splits.of_split(table(spark, sf_dir, "documents"), split, "good").groupBy("source").agg(F.count("*").alias("n"))


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) = 1")
def first_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.first_per_key(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey"], ["l_linenumber", "l_partkey"])


@query("SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 1")
def most_frequent_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.most_frequent(table(spark, sf_dir, "lineitem"), "l_partkey")
