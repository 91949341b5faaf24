"""The decision: which registry rows a mention may mean, which of them nothing contradicts, and what follows.

Lookup is one equi join on one key column, so a registry of any size is joined by its key: Spark broadcasts it when it
is small, and splits hot numbers when it is not. Records of one key that state the same are counted and reduced first, with
map-side sums, so a mention meets each different statement once; records are never listed beyond the ids a verdict carries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeflow.schema import CLASS_FAMILIES, PATH_CLASS


#: What a record is known by.
RECORD = ("number", "law_key", "article")


def _stated(c: Column) -> Column:
    """Empty strings count as absent."""
    return F.nullif(c, F.lit(""))


def precedent_key(number: Column) -> Column:
    """S083 to S83: precedent numbers are kept without leading zeros."""
    return F.when(number.rlike("^SV?[0-9]+$"), F.regexp_replace(number, "^(SV?)0*([0-9])", "$1$2")).otherwise(number)


def same_family(a: Column, b: Column) -> Column:
    """Equal classes, or stages of one kind of case."""
    shared = F.lit(False)
    for family in CLASS_FAMILIES:
        shared = shared | (a.isin(family) & b.isin(family))
    return (a == b) | shared


def mention_key() -> Column:
    """What a mention is looked up by; null if its form or fields allow no lookup."""
    number, law, article = _stated(F.col("number")), _stated(F.col("law_key")), _stated(F.col("article"))
    return (
        F.when((F.col("form") == "com_numero") & _stated(F.col("case_class")).isNotNull(), F.concat(F.lit("n|"), number))
        .when(F.col("form") == "sumula", F.concat(F.lit("n|"), precedent_key(number)))
        .when(F.col("form") == "lei_artigo", F.concat(F.lit("l|"), law, F.lit("|"), article))
    )


def registry_keys(registry: DataFrame) -> DataFrame:
    """Each registry row under its number, or under law and article."""
    number = F.concat(F.lit("n|"), _stated(F.col("number")))
    law = F.concat(F.lit("l|"), _stated(F.col("law_key")), F.lit("|"), _stated(F.col("article")))
    keys = F.filter(F.array(number, law), lambda k: k.isNotNull())
    return registry.select(
        F.explode(keys).alias("key"),
        F.col("id").alias("r_id"),
        *(F.col(c).alias(f"r_{c}") for c in RECORD),
        *(_stated(F.col(c)).alias(f"r_{c}") for c in ("court", "state", "case_class")),
        F.coalesce("appeal_chain", F.array().cast("array<string>")).alias("r_chain"),
    )


#: What a mention is compared with: records that agree in it are one candidate's statement, with their number.
STATEMENT = ("court", "state", "case_class", "chain")


def statements(keys: DataFrame, with_ids: bool) -> DataFrame:
    """key, n_candidates, records: the different statements of its records, each with its number of ids and its first record."""
    ids = [F.collect_set("r_id").alias("ids")] if with_ids else []
    first = F.min(F.when(F.col("r_id").isNotNull(), F.struct("r_id", *(f"r_{c}" for c in RECORD)))).alias("first")
    alike = keys.groupBy("key", *(f"r_{c}" for c in STATEMENT)).agg(F.count("*").alias("rows"), F.count("r_id").alias("n"), first, *ids)
    record = F.struct(*(F.col(f"r_{c}").alias(c) for c in STATEMENT), "n", "first", *(["ids"] if with_ids else []))
    return alike.groupBy("key").agg(F.sum("rows").alias("n_candidates"), F.collect_list(record).alias("records"))


def _consistent(record: Column) -> Column:
    """Nothing that mention and record both state contradicts; one candidate alone may be another stage of its family."""
    cls, other = _stated(F.col("case_class")), record["case_class"]
    agree = F.coalesce(_stated(F.col("court")) == record["court"], F.lit(True)) & F.coalesce(_stated(F.col("state")) == record["state"], F.lit(True))
    single = F.col("n_candidates") == 1
    by_class = F.coalesce(F.when(single, same_family(cls, other)).otherwise(cls == other), F.lit(True))
    chain = F.coalesce("appeal_chain", F.array().cast("array<string>"))
    other_stage = single & F.coalesce((cls != other) & same_family(cls, other), F.lit(False))
    return agree & by_class & ((F.size(chain) == 0) | (chain == record["chain"]) | other_stage)


def path_of() -> Column:
    law = F.col("form") == "lei_artigo"
    return (
        F.when(~F.coalesce("fields_read", F.lit(True)), "campos_nao_lidos")
        .when(F.col("form") == "sem_numero", "sem_numero")
        .when(F.col("form") == "referencia_vaga", "referencia_vaga")
        .when(law & _stated(F.col("law_key")).isNull(), "lei_apelido_desconhecido")
        .when(F.col("n_candidates") == 0, F.when(law, "lei_ausente").otherwise("numero_ausente"))
        .when(F.col("n_consistent") == 0, "numero_contradito")
        .when(F.col("n_consistent") > 1, F.when(law, "lei_ambigua").otherwise("numero_ambiguo"))
        .when(law, "lei_unica")
        .when(F.col("n_candidates") > 1, "numero_desempatado")
        .otherwise("numero_unico")
    )


def class_of(path: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, verdict in PATH_CLASS.items():
        out = F.when(path == name, verdict).otherwise(out)
    return out


def write_index(registry: DataFrame, name: str, buckets: int = 64) -> DataFrame:
    """The registry's keys as a table bucketed and sorted by key, so that runs which look up in it don't shuffle it."""
    registry_keys(registry).write.bucketBy(buckets, "key").sortBy("key").mode("overwrite").saveAsTable(name)
    return registry.sparkSession.table(name)


def decide(mentions: DataFrame, registry: DataFrame | None, mention_id: str = "mention_id", with_ids: bool = False, keep: tuple[str, ...] = (), index: DataFrame | None = None, with_record: bool = False, strict: bool = False) -> DataFrame:
    """mention_id, path, verdict, canonical_id, n_candidates, n_consistent and the columns to ``keep`` for every mention.

    ``mentions``: mention_id, form, court, case_class, appeal_chain, number, state, law_key, article, fields_read.
    ``registry``: id, court, number, case_class, appeal_chain, state, law_key, article.
    ``with_ids`` adds the sorted ids of candidates and of consistent ones, for registries in which few rows share a key.
    ``index``, a table of ``write_index``, stands for the registry. ``with_record`` adds what the mention states (``stated``)
    and what the chosen record is known by (``record``), for ``is_broken``; with ``strict`` a broken decision stops the job.
    A mention that can't be looked up gets a key of its own that no record has, so that these do not meet in one task.
    """
    keys = registry_keys(registry) if index is None else index
    with_record = with_record or strict
    known = statements(keys, with_ids)
    if index is not None:  # counted apart: the index is read by key, so a second scan costs no shuffle and no state
        known = known.drop("n_candidates").join(index.groupBy("key").agg(F.count("*").alias("n_candidates")), "key")
    own_key = F.coalesce(mention_key(), F.concat(F.lit("?|"), F.col(mention_id).cast("string")))
    asked = mentions.withColumn("key", own_key).join(known, "key", "left").withColumn("n_candidates", F.coalesce("n_candidates", F.lit(0)))
    joined = asked.withColumn("ok", F.filter("records", _consistent))
    n = F.coalesce(F.aggregate("ok", F.lit(0).cast("long"), lambda a, x: a + x["n"]), F.lit(0))
    kept = joined.withColumn("n_consistent", n).withColumn("chosen", F.array_min(F.transform("ok", lambda x: x["first"])))
    if with_record:
        kept = kept.withColumn("stated", F.struct(precedent_key(F.col("number")).alias("number"), "law_key", "article"))
    if with_ids:
        kept = kept.withColumns({c: F.array_sort(F.array_distinct(F.flatten(F.transform(of, lambda x: x["ids"])))) for c, of in (("candidates", "records"), ("consistent", "ok"))})
    decided = kept.withColumn("path", path_of()).withColumn("verdict", class_of(F.col("path")))
    listed = [F.coalesce(c, F.array().cast("array<string>")).alias(c) for c in ("candidates", "consistent")] if with_ids else []
    real = F.col("verdict") == "real"
    canonical = F.when(real, F.col("chosen.r_id")).alias("canonical_id")
    record = ["stated", F.when(real, F.struct(*(F.col(f"chosen.r_{c}").alias(c) for c in RECORD))).alias("record")] if with_record else []
    out = decided.select(mention_id, "path", "verdict", canonical, F.col("n_candidates").cast("long").alias("n_candidates"), "n_consistent", *listed, *record, *keep)
    if not strict:
        return out
    told = F.raise_error(F.concat(F.lit("broken decision: "), F.col(mention_id).cast("string")))
    return out.withColumn("path", F.when(is_broken(with_record=True), told).otherwise(F.col("path"))).drop("stated", "record")


def is_broken(with_record: bool = False) -> Column:
    """Whether a decision contradicts itself: a real one without its record, a record without a real verdict, no known path.

    ``with_record``: also a chosen record that bears neither the number nor the law and article that the mention states.
    """
    is_real = F.coalesce(F.col("verdict") == "real", F.lit(False))
    broken = (is_real != F.col("canonical_id").isNotNull()) | F.col("verdict").isNull() | (is_real & (F.coalesce("n_consistent", F.lit(0)) != 1))
    if not with_record:
        return broken
    number = F.col("record.number") == F.col("stated.number")
    law = (F.col("record.law_key") == F.col("stated.law_key")) & (F.col("record.article") == F.col("stated.article"))
    return broken | (is_real & ~F.coalesce(number, F.lit(False)) & ~F.coalesce(law, F.lit(False)))
