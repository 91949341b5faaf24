"""Registry lookups and decisions. ``lineitem`` plays the registry, ``orders`` the mentions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeflow.operators import registry as reg
from citeflow.operators import splits
from citeflow.operators.decide import decide
from citeflow.operators.truth import truth
from citeflow.plans.catalog import query, table

CLASSES = ["REsp", "AREsp", "RE", "ARE", "HC", "RHC"]
_CLASSES_SQL = "['REsp', 'AREsp', 'RE', 'ARE', 'HC', 'RHC']"


def _class(n: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, CLASSES)), (n % 6 + 1).cast("int"))


def lineitem_registry(lineitem: DataFrame) -> DataFrame:
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    return lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
        F.col("l_orderkey").cast("string").alias("number"),
        F.col("l_returnflag").alias("court"),
        _class(part).alias("case_class"),
        F.when(F.col("l_linenumber") % 3 == 0, F.array(F.lit("AgInt"))).otherwise(F.array().cast("array<string>")).alias("appeal_chain"),
        F.when(supp % 5 != 0, (supp % 27).cast("string")).alias("state"),
        F.lit(None).cast("string").alias("law_key"),
        F.lit(None).cast("string").alias("article"),
    )


def order_mentions(orders: DataFrame, shift: int = 1_000_000_000) -> DataFrame:
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return orders.select(
        key.alias("mention_id"),
        F.when(key % 20 == 0, "sem_numero").when(key % 20 == 1, "referencia_vaga").otherwise("com_numero").alias("form"),
        F.when(key % 4 == 0, F.element_at(F.array(F.lit("A"), F.lit("N"), F.lit("R")), (cust % 3 + 1).cast("int"))).alias("court"),
        F.when(key % 7 != 3, _class(cust)).alias("case_class"),
        F.when(cust % 4 == 1, F.array(F.lit("AgInt"))).otherwise(F.array().cast("array<string>")).alias("appeal_chain"),
        F.when(cust % 10 == 0, key + shift).otherwise(key).cast("string").alias("number"),
        F.lit(None).cast("string").alias("state"),
        F.lit(None).cast("string").alias("law_key"),
        F.lit(None).cast("string").alias("article"),
        (key % 23 != 5).alias("fields_read"),
    )


_RESOLVE = f"""
WITH r AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id, l_orderkey AS num, l_returnflag AS court,
         {_CLASSES_SQL}[CAST(l_partkey % 6 + 1 AS INTEGER)] AS cls, CAST(l_partkey % 6 AS INTEGER) // 2 AS fam,
         CASE WHEN l_linenumber % 3 = 0 THEN 'AgInt' ELSE '' END AS chain
  FROM lineitem
), m AS (
  SELECT o_orderkey AS mention_id, CASE WHEN o_custkey % 10 = 0 THEN o_orderkey + 1000000000 ELSE o_orderkey END AS num,
         CASE WHEN o_orderkey % 20 = 0 THEN 'sem_numero' WHEN o_orderkey % 20 = 1 THEN 'referencia_vaga' ELSE 'com_numero' END AS form,
         CASE WHEN o_orderkey % 4 = 0 THEN ['A', 'N', 'R'][CAST(o_custkey % 3 + 1 AS INTEGER)] END AS court,
         CASE WHEN o_orderkey % 7 <> 3 THEN {_CLASSES_SQL}[CAST(o_custkey % 6 + 1 AS INTEGER)] END AS cls,
         CASE WHEN o_orderkey % 7 <> 3 THEN CAST(o_custkey % 6 AS INTEGER) // 2 END AS fam,
         CASE WHEN o_custkey % 4 = 1 THEN 'AgInt' ELSE '' END AS chain, o_orderkey % 23 <> 5 AS fields_read
  FROM orders
), c AS (
  SELECT m.*, r.id, r.court AS r_court, r.cls AS r_cls, r.fam AS r_fam, r.chain AS r_chain, count(r.id) OVER (PARTITION BY m.mention_id) AS n_cand
  FROM m LEFT JOIN r ON m.num = r.num AND m.form = 'com_numero' AND m.cls IS NOT NULL
), k AS (
  SELECT *, id IS NOT NULL AND coalesce(court = r_court, true)
    AND coalesce(CASE WHEN n_cand = 1 THEN cls = r_cls OR fam = r_fam ELSE cls = r_cls END, true)
    AND (chain = '' OR chain = r_chain OR (n_cand = 1 AND coalesce(cls <> r_cls AND fam = r_fam, false))) AS ok
  FROM c
), a AS (
  SELECT mention_id, any_value(form) AS form, bool_and(fields_read) AS fields_read, max(n_cand) AS n_candidates,
         sum(CASE WHEN ok THEN 1 ELSE 0 END) AS n_consistent, min(CASE WHEN ok THEN id END) AS only_id
  FROM k GROUP BY mention_id
), p AS (
  SELECT *, CASE WHEN NOT fields_read THEN 'campos_nao_lidos' WHEN form <> 'com_numero' THEN form WHEN n_candidates = 0 THEN 'numero_ausente'
    WHEN n_consistent = 0 THEN 'numero_contradito' WHEN n_consistent > 1 THEN 'numero_ambiguo'
    WHEN n_candidates > 1 THEN 'numero_desempatado' ELSE 'numero_unico' END AS path
  FROM a
), v AS (
  SELECT *, CASE WHEN path IN ('numero_unico', 'numero_desempatado') THEN 'real' WHEN path IN ('numero_ausente', 'numero_contradito') THEN 'inventada' ELSE 'incompleta' END AS verdict
  FROM p
)
SELECT mention_id, path, verdict, CASE WHEN verdict = 'real' THEN only_id END AS canonical_id, CAST(n_candidates AS BIGINT) AS n_candidates, CAST(n_consistent AS BIGINT) AS n_consistent FROM v
"""


@query(_RESOLVE)
def resolve_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decide(order_mentions(table(spark, sf_dir, "orders")), lineitem_registry(table(spark, sf_dir, "lineitem")))


@query(f"SELECT path, verdict, count(*) AS n FROM ({_RESOLVE}) GROUP BY path, verdict")
def path_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve_mentions(spark, sf_dir).groupBy("path", "verdict").agg(F.count("*").alias("n"))


@query("""
WITH r AS (
  SELECT s_suppkey, CAST(s_nationkey AS VARCHAR) AS law, CAST(s_suppkey % 5 AS VARCHAR) AS art FROM supplier
), n AS (
  SELECT law, art, count(*) AS n, min(CAST(s_suppkey AS VARCHAR)) AS id FROM r GROUP BY law, art
), m AS (
  SELECT c_custkey AS mention_id, CASE WHEN c_custkey % 11 <> 0 THEN CAST(c_nationkey AS VARCHAR) END AS law, CAST(c_custkey % 6 AS VARCHAR) AS art FROM customer
), p AS (
  SELECT mention_id, coalesce(n, 0) AS n, id, CASE WHEN m.law IS NULL THEN 'lei_apelido_desconhecido' WHEN n IS NULL THEN 'lei_ausente' WHEN n > 1 THEN 'lei_ambigua' ELSE 'lei_unica' END AS path
  FROM m LEFT JOIN n ON m.law = n.law AND m.art = n.art
)
SELECT mention_id, path, CASE path WHEN 'lei_unica' THEN 'real' WHEN 'lei_ambigua' THEN 'incompleta' ELSE 'inventada' END AS verdict,
       CASE WHEN path = 'lei_unica' THEN id END AS canonical_id, CAST(n AS BIGINT) AS n_candidates, CAST(n AS BIGINT) AS n_consistent FROM p
""")
def resolve_statutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nothing, none = F.lit(None).cast("string"), F.array().cast("array<string>")
    registry = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("id"), nothing.alias("court"), nothing.alias("number"), nothing.alias("case_class"), none.alias("appeal_chain"), nothing.alias("state"),
        F.col("s_nationkey").cast("string").alias("law_key"), (F.col("s_suppkey") % 5).cast("string").alias("article"),
    )
    mentions = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("mention_id"), F.lit("lei_artigo").alias("form"), nothing.alias("court"), nothing.alias("case_class"), none.alias("appeal_chain"), nothing.alias("number"), nothing.alias("state"),
        F.when(F.col("c_custkey") % 11 != 0, F.col("c_nationkey").cast("string")).alias("law_key"), (F.col("c_custkey") % 6).cast("string").alias("article"), F.lit(True).alias("fields_read"),
    )
    return decide(mentions, registry)


@query("SELECT l_orderkey AS number, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1")
def registry_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reg.duplicated_numbers(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("number")))


@query("SELECT o_orderkey AS id, o_orderpriority AS nature FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) ON o_orderkey = l_orderkey WHERE l_orderkey IS NULL")
def registry_unidentified(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("number")).distinct()
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("nature"))
    rows = orders.join(numbers, F.col("id") == F.col("number"), "left").withColumn("law_key", F.lit(None).cast("string")).withColumn("article", F.lit(None).cast("string"))
    return reg.unidentified(rows).select("id", "nature")


@query("SELECT p_brand, p_type, count(*) AS n, CAST(grouping_id(p_brand, p_type) AS BIGINT) AS level FROM part GROUP BY ROLLUP (p_brand, p_type)")
def registry_diagnostics_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reg.counts_by(table(spark, sf_dir, "part"), "p_brand", "p_type")


@query("SELECT o_orderkey + 7 AS number FROM orders WHERE o_orderkey + 7 NOT IN (SELECT l_orderkey FROM lineitem)")
def negative_key_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    candidates = table(spark, sf_dir, "orders").select((F.col("o_orderkey") + 7).alias("number"))
    return splits.absent_keys(candidates, table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("number")), "number")


@query(f"SELECT mention_id, verdict, canonical_id FROM ({_RESOLVE})")
def truth_of_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same mentions classified by elimination, without any of the decision's code."""
    rows = order_mentions(table(spark, sf_dir, "orders"))
    unnumbered = (F.col("form") != "com_numero") | ~F.col("fields_read")
    key = F.when(~unnumbered, F.when(F.col("case_class").isNotNull(), F.col("number")).otherwise(""))
    return truth(rows.withColumn("key", key), lineitem_registry(table(spark, sf_dir, "lineitem")), "mention_id")
