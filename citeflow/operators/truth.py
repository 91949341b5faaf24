"""What a citation means by the registry alone: a second classification, by elimination, that shares nothing with ``decide``.

Records that bear a citation's key are its candidates, and how many bear it is counted on the registry's side. Candidates
that the citation contradicts are struck out, and what is left is counted; a stage of the same kind of case is found by a
join with the pairs of such classes. Only the closed tables of classes and their families are common to both ways.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeflow.schema import CLASS_FAMILIES

#: What a citation states of itself, besides its id and its key; null or empty where it states nothing.
STATED = "court string, state string, case_class string, appeal_chain array<string>"


def by_key(registry: DataFrame) -> DataFrame:
    """key, id and attributes of every record that a citation can name: number, or law and article."""
    numbers = registry.where("coalesce(number, '') <> ''").withColumn("key", F.col("number"))
    laws = registry.where("coalesce(law_key, '') <> '' AND coalesce(article, '') <> ''").withColumn("key", F.concat_ws("|", "law_key", "article"))
    every = numbers.unionByName(laws)
    blank = {c: F.nullif(F.col(c), F.lit("")) for c in ("court", "state", "case_class")}
    chain = F.coalesce("appeal_chain", F.array().cast("array<string>"))
    return every.select("key", F.col("id").alias("r_id"), *(c.alias(f"r_{name}") for name, c in blank.items()), chain.alias("r_chain"))


def families(spark: SparkSession) -> DataFrame:
    """one, other: two classes that are stages of one kind of case."""
    pairs = [(a, b) for family in CLASS_FAMILIES for a in family for b in family if a != b]
    return spark.createDataFrame(sorted({*pairs}), "one string, other string")


def _differs(a: str, b: str) -> Column:
    """Both are known, and not the same."""
    return F.coalesce(F.col(a) != F.col(b), F.lit(False))


def truth(citations: DataFrame, registry: DataFrame, cite_id: str = "cite_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """``cite_id``, verdict, canonical_id and the columns to ``keep``. ``citations``: cite_id, key and what is ``STATED``.

    Without a key, which then can't be looked up, a citation is incomplete. Nothing left of its candidates: invented. One:
    real. More: incomplete. ``citations`` is read once.
    """
    blank = [F.nullif(F.col(c), F.lit("")).alias(c) for c in ("court", "state", "case_class")]
    chain = F.coalesce("appeal_chain", F.array().cast("array<string>")).alias("chain")
    own = F.coalesce("key", F.concat(F.lit("?|"), F.col(cite_id).cast("string"))).alias("key")
    carried = [F.struct(*keep).alias("carried")] if keep else []
    stated = citations.select(cite_id, own, F.col("key").isNull().alias("unkeyed"), *blank, chain, *carried)
    records = by_key(registry)
    held = records.groupBy("key").agg(F.count("*").alias("holders"))
    stages = F.broadcast(families(citations.sparkSession))
    pairs = stated.join(records.join(held, "key"), "key", "left").join(stages, (F.col("case_class") == F.col("one")) & (F.col("r_case_class") == F.col("other")), "left")
    other_case = _differs("case_class", "r_case_class") | ((F.size("chain") > 0) & F.coalesce(F.col("chain") != F.col("r_chain"), F.lit(False)))
    other_stage = (F.col("holders") == 1) & F.col("one").isNotNull()
    struck = _differs("court", "r_court") | _differs("state", "r_state") | (other_case & ~other_stage)
    left = F.col("r_id").isNotNull() & ~struck
    counted = pairs.groupBy(cite_id).agg(F.count_if(left).alias("n"), F.min(F.when(left, F.col("r_id"))).alias("only"), F.any_value("unkeyed").alias("unkeyed"), *([F.any_value("carried").alias("carried")] if keep else []))
    verdict = F.when(F.col("unkeyed") | (F.col("n") > 1), "incompleta").when(F.col("n") == 1, "real").otherwise("inventada")
    return counted.select(cite_id, verdict.alias("verdict"), F.when((F.col("n") == 1) & ~F.col("unkeyed"), F.col("only")).alias("canonical_id"), *(["carried.*"] if keep else []))
