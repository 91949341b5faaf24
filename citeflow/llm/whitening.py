"""Whitening of embeddings through the exact characteristic polynomial of their integer scatter.

Entries become whole numbers; the distinct vectors, the fit list, are written once. Their sums and the products of their
centred entries add up exactly over partitions, so the scatter is a matrix of whole numbers that no partitioning changes.
Its characteristic polynomial comes from one reduction a prime, the primes dealt over the executors, and Chinese
remainders; its largest roots are isolated exactly; each gets its eigenvectors by inverse iteration in long decimals, again
one task a root. What reaches the driver and the tasks is bounded by the dimension: d * d numbers, d for each prime.

Defined results. Rows whose vector is null, empty, or holds null or non-finite entries take no part, nor do vectors of
another length than the commonest of the fit list (the longer on ties). Entries beyond 2**40 in size after scaling count as
2**40. Repeated rows and ids each get their own rows, a null id too; further columns are left out. A component of variance
zero has no whitened value, so there are as many components as the rank, ``COMPONENTS`` at most; equal vectors only, or no
rows, give no rows. ``deviation`` is null where it doesn't fit 63 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeflow.llm import charpoly
from citeflow.llm.common import slices, written

COMPONENTS = 16
SCALE, OFFSET, LARGEST = 64, 1000000, 2**40
#: Rows of one exact product, and the bits of its factors: 2**(2 * 20 + 11) stays below 2**53.
ROWS, LIMB = 2048, 20
SCHEMA = "vec_id {}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def integer_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, x: whole numbers floor(64 * c) + 1000000 for the rows that take part."""
    usable = "size(embedding) > 0 AND forall(embedding, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < double('infinity'))"
    x = f"transform(embedding, c -> floor(greatest(least({SCALE}D * double(c), {LARGEST}D), -{LARGEST}D)) + {OFFSET}L)"
    return embeddings.where(usable).selectExpr("vec_id", f"{x} AS x")


def _matrix(column, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, d)


def _limbs(z: np.ndarray) -> list[np.ndarray]:
    """``z`` as sums of float arrays times powers of 2**LIMB, each small enough for exact products."""
    out = []
    while z.any():
        low = ((z + (1 << (LIMB - 1))) & ((1 << LIMB) - 1)) - (1 << (LIMB - 1))
        out.append(low.astype(np.float64))
        z = (z - low) >> LIMB
    return out


def scatter(fit: DataFrame, d: int, centre: list[int]) -> list[list[int]]:
    """Sums over the vectors of the products of (x - centre), exact."""
    middle = np.array(centre, dtype=np.int64)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums, held = np.zeros((d, d), dtype=object), {}, 0
        for piece in slices(batches, ROWS):
            limbs = _limbs(_matrix(piece.column(0), d) - middle)
            for i, a in enumerate(limbs):
                for j, b in enumerate(limbs):
                    sums[i + j] = sums.get(i + j, 0) + (a.T @ b).astype(np.int64)
            held += 1
            if held == 256:
                total, sums, held = _added(total, sums), {}, 0
        total = _added(total, sums)
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([str(v) for v in total[i, j]])], ["i", "j", "v"])

    found = fit.select("x").mapInArrow(parts, "i int, j int, v string").groupBy("i", "j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()
    out = [[0] * d for _ in range(d)]
    for i, j, v in found:
        out[i][j] = out[j][i] = int(v)
    return out


def _added(total: np.ndarray, sums: dict[int, np.ndarray]) -> np.ndarray:
    for k, v in sums.items():
        total = total + v.astype(object) * (1 << (LIMB * k))
    return total


def _polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    primes = charpoly.primes_beyond(2 * charpoly.coefficient_bound(matrix))

    def residues(frames):
        for frame in frames:
            yield frame.assign(c=[charpoly.polynomial_mod(matrix, int(p)) for p in frame["p"]])

    dealt = spark.createDataFrame([(p,) for p in primes], "p bigint").repartition(min(len(primes), 4 * spark.sparkContext.defaultParallelism))
    return charpoly.combined({p: list(c) for p, c in dealt.mapInPandas(residues, "p bigint, c array<bigint>").collect()})


def components(spark: SparkSession, matrix: list[list[int]], most: int) -> list[tuple[Fraction, list[float]]]:
    """The largest positive eigenvalues, falling, each with a unit vector; vectors of one eigenvalue are orthogonal."""
    roots = charpoly.largest_roots(_polynomial(spark, matrix), most)
    if not roots:
        return []

    def vectors(frames):
        for frame in frames:
            for k, top, bottom, m in frame.itertuples(index=False):
                found = charpoly.null_space(matrix, Fraction(int(top), int(bottom)), int(m))
                yield frame.iloc[:0][["k"]].reindex(range(len(found))).assign(k=int(k), v=found)

    rows = [(k, str(r.numerator), str(r.denominator), m) for k, (r, m) in enumerate(roots)]
    dealt = spark.createDataFrame(rows, "k int, top string, bottom string, m int").repartition(len(rows), "k")
    found: dict[int, list[list[float]]] = {}
    for k, v in dealt.mapInPandas(vectors, "k int, v array<double>").collect():
        found.setdefault(k, []).append(list(v))
    return [(root, v) for k, (root, _) in enumerate(roots) for v in found[k]][:most]


def whitened(embeddings: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for each row that takes part and component."""
    spark = embeddings.sparkSession
    rows = integer_vectors(embeddings)
    schema = SCHEMA.format(rows.schema["vec_id"].dataType.simpleString())
    fit = written(rows.select("x").distinct(), "whitening-fit")
    sizes = fit.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).head()
    if sizes is None:
        return spark.createDataFrame([], schema)
    d, n = sizes
    same = F.size("x") == d
    fit = fit.where(same)
    sums = [int(r[0]) for r in fit.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum(F.col("v").cast("decimal(20,0)")).alias("s")).orderBy("i").select("s").collect()]
    centre = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * c for s, c in zip(sums, centre, strict=True)]
    products = scatter(fit, d, centre)
    matrix = [[n * products[i][j] - rest[i] * rest[j] for j in range(d)] for i in range(d)]  # n * n times the covariance
    trace = sum(matrix[i][i] for i in range(d))
    found = components(spark, matrix, most) if trace else []
    if not found:
        return spark.createDataFrame([], schema)
    to_white = np.array([v for _, v in found]).T / np.sqrt([float(e / n**2) for e, _ in found])
    project = _projection(d, n, np.array(centre, dtype=np.int64), rest, to_white)
    error = _identity_error(fit, n, project, len(found))
    shares = F.array(*(F.lit(float(e / trace)) for e, _ in found))

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, ROWS):
            deviation, white = project(piece.column(1))
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(deviation, pa.int64()), pa.array(list(white), pa.list_(pa.float64()))], ["vec_id", "deviation", "w"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    return (
        rows.where(same)
        .mapInArrow(values, f"vec_id {kind}, deviation bigint, w array<double>")
        .select("vec_id", "deviation", F.posexplode("w").alias("k", "whitened"))
        .select(
            "vec_id",
            (F.col("k") + 1).alias("component"),
            F.lit(n).cast("long").alias("n"),
            "deviation",
            "whitened",
            F.element_at(shares, F.col("k") + 1).alias("explained"),
            F.lit(error).alias("identity_error"),
        )
    )


def _projection(d: int, n: int, centre: np.ndarray, rest: list[int], to_white: np.ndarray):
    """A function of a column of vectors: their exact deviations (None beyond 63 bits) and their whitened values."""

    def project(column) -> tuple[list, np.ndarray]:
        z = _matrix(column, d) - centre
        largest = n * int(np.abs(z).max(initial=0)) + max(map(abs, rest))
        if d * largest**2 < 2**63:
            y = n * z - np.array(rest, dtype=np.int64)
            deviation = (y * y).sum(axis=1).tolist()
        else:
            y = n * z.astype(object) - np.array(rest, dtype=object)
            deviation = [int(v) if v < 2**63 else None for v in (y * y).sum(axis=1)]
        return deviation, (y / n).astype(np.float64) @ to_white

    return project


def _identity_error(fit: DataFrame, n: int, project, k: int) -> float:
    """The largest entry of the whitened fit list's covariance minus the identity."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for piece in slices(batches, ROWS):
            w = project(piece.column(0))[1]
            total[:k] += w.T @ w
            total[k] += w.sum(axis=0)
        i, j = np.indices(total.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel())], ["i", "j", "v"])

    total = np.zeros((k + 1, k))
    for i, j, v in fit.select("x").mapInArrow(parts, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v")).collect():
        total[i, j] = v
    mean = total[k] / n
    return float(np.abs(total[:k] / n - np.outer(mean, mean) - np.eye(k)).max())
