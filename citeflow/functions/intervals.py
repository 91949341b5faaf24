"""Half-open intervals as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Width of the buckets in which intervals of one document meet.
BUCKET = 1024


def overlap(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Length of the common part, 0 if there is none."""
    return F.greatest(F.least(a_end, b_end) - F.greatest(a_start, b_start), F.lit(0))


def iou(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Common length over joint length; 0 for disjoint intervals."""
    common = overlap(a_start, a_end, b_start, b_end)
    joint = (a_end - a_start) + (b_end - b_start) - common
    return F.when(common > 0, common / joint).otherwise(F.lit(0.0))


def half_covered(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Whether the intersection over union is at least one half, in whole numbers."""
    common = overlap(a_start, a_end, b_start, b_end)
    return (common > 0) & (2 * common >= (a_end - a_start) + (b_end - b_start) - common)


def strictly_inside(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """a lies within b and is not b."""
    return (a_start >= b_start) & (a_end <= b_end) & ((a_start != b_start) | (a_end != b_end))


def touches(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    return (a_start < b_end) & (b_start < a_end)


def in_buckets(rows: DataFrame, start: str, end: str) -> DataFrame:
    """A row for each bucket of positions that an interval covers, as ``__bucket``."""
    last = F.greatest(F.col(end) - 1, F.col(start))
    return rows.withColumn("__bucket", F.explode(F.sequence(F.floor(F.col(start) / BUCKET), F.floor(last / BUCKET))))


def touching(a: DataFrame, b: DataFrame, keys: list[str], a_start: str, a_end: str, b_start: str, b_end: str) -> DataFrame:
    """Pairs of rows of equal ``keys`` whose intervals overlap, each once.

    They meet by bucket, in the one where their common part begins, so the pairs of a long document are not all tried.
    """
    met = in_buckets(a, a_start, a_end).join(in_buckets(b, b_start, b_end), [*keys, "__bucket"])
    common = F.floor(F.greatest(a_start, b_start) / BUCKET)
    return met.where(touches(F.col(a_start), F.col(a_end), F.col(b_start), F.col(b_end)) & (F.col("__bucket") == common)).drop("__bucket")
