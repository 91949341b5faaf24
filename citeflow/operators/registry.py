"""Registry diagnostics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unidentified(registry: DataFrame) -> DataFrame:
    """Rows that neither a number nor a law with an article identifies."""
    return registry.where(F.col("number").isNull() & (F.col("law_key").isNull() | F.col("article").isNull()))


def duplicated_numbers(registry: DataFrame, number: str = "number") -> DataFrame:
    return registry.where(F.col(number).isNotNull()).groupBy(number).agg(F.count("*").alias("n")).where("n > 1")


def counts_by(registry: DataFrame, *columns: str) -> DataFrame:
    """Counts on all levels of the columns, with the level's number."""
    return registry.rollup(*columns).agg(F.count("*").alias("n"), F.grouping_id().cast("long").alias("level"))
