"""Splits, samples and mixes, all keyed by ids, so that they are the same wherever and whenever they run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Control rows of a stratum up to this many are broadcast.
MOST_CONTROL = 1000


def keyed(key: Column, modulus: int, seed: int = 0) -> Column:
    """A number below ``modulus`` from a key, by multiplication: any engine gives the same."""
    return F.pmod((F.pmod(key, F.lit(1_000_003)) + seed) * 48_271, F.lit(2_147_483_647)) % modulus


def stratified_control(rows: DataFrame, stratum: str, key: str, n: int, seed: int = 0) -> DataFrame:
    """``control``: whether a row is among the n first of its stratum in the keyed order."""
    order = Window.partitionBy(stratum).orderBy("__order", key)
    ranked = rows.select(stratum, key, keyed(F.col(key), 2_147_483_647, seed).alias("__order")).withColumn("__k", F.row_number().over(order)).where(F.col("__k") <= n)
    chosen = ranked.select(F.col(stratum).alias("__stratum"), F.col(key).alias("__key"), F.lit(True).alias("__in"))
    same = F.col(stratum).eqNullSafe(F.col("__stratum")) & (F.col(key) == F.col("__key"))
    return rows.join(F.broadcast(chosen) if n <= MOST_CONTROL else chosen, same, "left").withColumn("control", F.coalesce("__in", F.lit(False))).drop("__stratum", "__key", "__in")


def twin_split(pair: Column, pairs: int, share: float = 0.2) -> Column:
    """The last fifth of the pairs (rounded up) is for control; both twins of a pair go together."""
    return pair >= F.lit(pairs) - F.ceil(F.lit(pairs * share))


def weighted_choice(drawn: Column, weights: dict[str, int]) -> Column:
    """The name whose share of the cumulated weights holds ``drawn`` (0 up to the sum of weights)."""
    out, total = F.lit(None).cast("string"), sum(weights.values())
    for name, w in reversed(weights.items()):
        out = F.when(drawn < total, name).otherwise(out)
        total -= w
    return out


def absent_keys(candidates: DataFrame, registry: DataFrame, key: str) -> DataFrame:
    """Candidates whose key the registry does not have."""
    return candidates.join(registry.select(key).distinct(), key, "left_anti")


def repeated_mix(rows: DataFrame, times: Column) -> DataFrame:
    """Every row as often as ``times`` says; 0 drops it."""
    return rows.withColumn("copy", F.explode(F.when(times > 0, F.sequence(F.lit(1), times.cast("int"))).otherwise(F.array().cast("array<int>"))))


def of_split(rows: DataFrame, split: DataFrame, name: str, key: str = "doc_id") -> DataFrame:
    """The rows of the documents that ``split`` (key, split) puts into ``name``."""
    return rows.join(split.where(F.col("split") == name).select(key), key, "left_semi")


def split_catalog(split: DataFrame, gold: DataFrame, key: str = "doc_id") -> DataFrame:
    """split, documents, in_gold, only_split, complete of each split, and of ``gold`` itself under its own name: all by sets of keys."""
    ids = split.select("split", key).distinct()
    known = gold.select(key).distinct().withColumn("known", F.lit(True))
    counted = ids.join(known, key, "left").groupBy("split").agg(F.count("*").alias("documents"), F.count("known").alias("in_gold"))
    rest = known.join(ids, key, "left_anti").agg(F.count("*").alias("documents")).select(F.lit("(none)").alias("split"), "documents", F.col("documents").alias("in_gold"))
    return counted.unionByName(rest).withColumn("only_split", F.col("documents") - F.col("in_gold")).withColumn("complete", F.col("only_split") == 0)


def first_per_key(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row for each key, the first by ``order``: a map-side combined minimum, so a key of any size is no group in one task."""
    rest = [c for c in rows.columns if c not in {*key, *order}]
    first = F.min(F.struct(*order, *rest)).alias("__first")
    return rows.groupBy(*key).agg(first).select(*key, "__first.*").select(*rows.columns)


def most_frequent(rows: DataFrame, key: str) -> DataFrame:
    """The key with the most rows (of equals the smallest) and their number."""
    counted = rows.groupBy(key).agg(F.count("*").alias("n"))
    best = counted.agg(F.max(F.struct("n", (-F.col(key)).alias("__key"))).alias("best"))
    return best.select((-F.col("best.__key")).alias(key), F.col("best.n").alias("n"))
