"""Exact top-k by inner product with a pivot-distance index.

Components become floor(256 x). Inner products are ranked through distances: with one more component, the root of
(largest squared norm - own squared norm), all rows lie on one sphere, and the larger the inner product with a query
(whose extra component is 0) the smaller the distance. Every row is keyed by its nearest pivot and its distance from
it; rows are dealt out in ranges of (pivot, distance, id), so a pivot with many rows, or many equal rows, spreads over
tasks, and packed into blocks, each an annulus of one pivot.

A query first looks into the annuli where its own pivot and distance put it, which gives a score that five rows reach.
Then every task walks its annuli, nearest first, and leaves a query out of an annulus, and of all farther ones, when
the triangle inequality shows that no row there can reach the query's score. Queries go out in blocks of at most
``QUERY_BLOCK``, each a job of its own that reads the written index and adds its answers to a table; of a task only the
k best rows of a query come back, if they reach its score.

Defined results: vectors that are null or hold a null or non-finite component take no part, neither as query nor as
candidate, and so give no rows; shorter vectors count as padded with zeros; rows that share an id are candidates one
by one (a query leaves out all rows of its id), and queries with one id are each answered under it; equal scores rank
by the smaller id; fewer candidates than k give fewer rows; an empty table gives none; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citeflow.llm.common import cut, shared_path

SCALE = 256
PIVOTS = 32
#: The pivots come from this many rows at most; every row is indexed.
PIVOT_SAMPLE = 2048
BLOCK_ROWS = 1024
KEPT_ROWS = 1 << 20
QUERY_BLOCK = 8192

_INDEX = "pivot int, low double, high double, ids binary, vectors binary"


def _usable(vector: str):
    """Not null, no null and no non-finite component."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.col(vector).isNotNull() & good


def _pivots(sample: np.ndarray) -> np.ndarray:
    """Rows of the sample far from each other, taken greedily."""
    chosen = [0]
    distance = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < min(PIVOTS, len(sample)) and distance.max() > 0:
        chosen.append(int(distance.argmax()))
        distance = np.minimum(distance, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


class _Space:
    """What all tasks know: pivots with the extra component, dimensions, and the largest squared norm."""

    def __init__(self, pivots: np.ndarray, largest: float):
        self.pivots, self.largest, self.dimensions = pivots, largest, pivots.shape[1] - 1

    def matrix(self, vectors: list[list[float]]) -> np.ndarray:
        out = np.zeros((len(vectors), self.dimensions))
        for k, v in enumerate(vectors):
            out[k, : len(v)] = v
        return out

    def distances(self, rows: np.ndarray, query: bool = False) -> np.ndarray:
        """From every row to every pivot."""
        norms = (rows**2).sum(axis=1)
        if query:
            lifted, squared = np.hstack([rows, np.zeros((len(rows), 1))]), norms
        else:
            lifted, squared = np.hstack([rows, np.sqrt(np.maximum(self.largest - norms, 0))[:, None]]), np.full(len(rows), self.largest)
        squares = squared[:, None] + (self.pivots**2).sum(axis=1) - 2 * lifted @ self.pivots.T
        return np.sqrt(np.maximum(squares, 0))


def _key(space: _Space) -> Callable[[Iterator], Iterator]:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                to = space.distances(space.matrix(batch.column("vector").to_pylist()))
                near = to.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("vector"), pa.array(near, pa.int32()), pa.array(to[np.arange(len(near)), near])],
                    names=["id", "vector", "pivot", "distance"],
                )

    return run


def _pack(space: _Space) -> Callable[[Iterator], Iterator]:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            pivot, distance, ids = (batch.column(c).to_numpy() for c in ("pivot", "distance", "id"))
            rows = space.matrix(batch.column("vector").to_pylist())
            edges = np.flatnonzero(np.append(True, pivot[1:] != pivot[:-1])) if len(pivot) else []
            out = []
            for a, b in zip(edges, [*edges[1:], len(pivot)], strict=True):
                for k in range(a, b, BLOCK_ROWS):
                    own = slice(k, min(b, k + BLOCK_ROWS))
                    out.append((int(pivot[k]), float(distance[own].min()), float(distance[own].max()), ids[own].astype("<i8").tobytes(), rows[own].tobytes()))
            columns = list(zip(*out, strict=True)) if out else [()] * 5
            kinds = [pa.int32(), pa.float64(), pa.float64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["pivot", "low", "high", "ids", "vectors"])

    return run


def _exact(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products; doubles hold them while they stay under 2**53."""
    bound = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * max(1, rows.shape[1])
    if bound < 2**53:
        return (queries @ rows.T).astype(np.int64)
    return np.array([[sum(int(a) * int(b) for a, b in zip(q, r, strict=True)) for r in rows] for q in queries], dtype=np.int64).reshape(len(queries), len(rows))


class _Queries:
    def __init__(self, space: _Space, ids: np.ndarray, rows: np.ndarray, k: int):
        self.space, self.ids, self.rows, self.k = space, ids, rows, k
        self.to_pivots = space.distances(rows, query=True)
        self.squared = (rows**2).sum(axis=1)
        #: The score, and the id that goes with it, which k candidates are known to reach.
        self.least = np.full(len(ids), np.iinfo(np.int64).min, dtype=np.int64)
        self.least_id = np.full(len(ids), np.iinfo(np.int64).max, dtype=np.int64)

    def fits(self, at: int, ids: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Candidates that can be among the k best: above the bound, or on it with an id that is not larger."""
        good = (score > self.least[at]) | ((score == self.least[at]) & (ids <= self.least_id[at]))
        return np.flatnonzero(good & (ids != self.ids[at]))

    def bound(self, at: int, score: int, id: int) -> None:
        """There are k candidates up to this one."""
        if score > self.least[at] or (score == self.least[at] and id < self.least_id[at]):
            self.least[at], self.least_id[at] = score, id

    def reach(self) -> np.ndarray:
        """The distance within which a row can still reach the query's score, with room for rounding."""
        score = self.least.astype(np.float64)
        reach = np.sqrt(np.maximum(self.squared + self.space.largest - 2 * score, 0))
        return np.where(self.least == np.iinfo(np.int64).min, np.inf, reach * (1 + 1e-9) + 1e-3)

    def apart(self, pivot: int, low: float, high: float) -> np.ndarray:
        """At least this far is every row of the annulus from each query."""
        own = self.to_pivots[:, pivot]
        return np.maximum(np.maximum(low - own, own - high), 0)


def _blocks(batches: Iterator):
    for batch in batches:
        yield from batch.to_pylist()


def _first(queries: _Queries) -> Callable[[Iterator], Iterator]:
    """Scores from the annuli in which a query itself lies: enough for a first bound, not yet the answer."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        nearest, kept = queries.to_pivots.argmin(axis=1), _Kept(queries.k)
        for block in _blocks(batches):
            own = np.flatnonzero((nearest == block["pivot"]) & (queries.apart(block["pivot"], block["low"], block["high"]) <= 0.05 * queries.to_pivots[:, block["pivot"]]))
            if len(own):
                kept.add(_best(queries, own, *_unpacked(queries, block)))
        yield kept.batch(pa)

    return run


def _unpacked(queries: _Queries, block: dict) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(block["ids"], "<i8")
    return ids, np.frombuffer(block["vectors"], np.float64).reshape(len(ids), -1)


def _best(queries: _Queries, own: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """(query, id, score) of the k best of one block for each of these queries, if they reach its bound; raises the bound."""
    out = [np.empty((3, 0), dtype=np.int64)]
    for at, score in zip(own.tolist(), _exact(queries.rows[own], rows), strict=True):
        fit = queries.fits(at, ids, score)
        fit = fit[np.lexsort((ids[fit], -score[fit]))[: queries.k]]
        if len(fit) == queries.k:
            queries.bound(at, int(score[fit[-1]]), int(ids[fit[-1]]))
        out.append(np.stack([np.full(len(fit), at), ids[fit], score[fit]]))
    return np.concatenate(out, axis=1)


class _Kept:
    """What a task has found, cut down to k rows a query now and then."""

    def __init__(self, k: int):
        self.k, self.found, self.size = k, [], 0

    def add(self, rows: np.ndarray) -> None:
        self.found.append(rows)
        self.size += rows.shape[1]
        if self.size > KEPT_ROWS:
            self.found = [self.rows()]
            self.size = self.found[0].shape[1] // 2

    def rows(self) -> np.ndarray:
        every = np.concatenate([np.empty((3, 0), dtype=np.int64), *self.found], axis=1)
        query, ids, score = every = every[:, np.lexsort((every[1], -every[2], every[0]))]
        first = np.searchsorted(query, query, "left")
        return every[:, np.arange(len(query)) - first < self.k]

    def batch(self, pa):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in self.rows()], names=["query", "vec_id", "score"])


def _walk(queries: _Queries) -> Callable[[Iterator], Iterator]:
    """Annuli of the task, for all queries at once, nearest first; an annulus out of a query's reach is left out."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kept = _Kept(queries.k)
        for batch in batches:
            blocks = batch.to_pylist()
            apart = np.array([queries.apart(b["pivot"], b["low"], b["high"]) for b in blocks]).reshape(len(blocks), len(queries.ids))
            for k in np.argsort(apart.min(axis=1, initial=np.inf)):
                own = np.flatnonzero(apart[k] <= queries.reach())
                if len(own):
                    kept.add(_best(queries, own, *_unpacked(queries, blocks[k])))
        yield kept.batch(pa)

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query. A task sends k rows a query at most, so no group is larger than k times the tasks."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: str, k: int = 5, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of each query row's k best other rows; ``is_query`` is a SQL condition on its ``id``."""
    spark = vectors.sparkSession
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("double"))
    usable = vectors.where(F.col(id).isNotNull() & _usable(vector))
    rows = usable.select(F.col(id).cast("long").alias("id"), scaled.alias("vector")).withColumn("asks", F.expr(is_query))
    squared = F.aggregate("vector", F.lit(0.0), lambda n, x: n + x * x)
    seen = rows.agg(F.max(F.size("vector")), F.max(squared), F.count(F.when(F.col("asks"), 1))).first()
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    if not seen[2]:
        return spark.createDataFrame([], schema)
    sample = rows.select("vector").orderBy(F.xxhash64("id")).limit(PIVOT_SAMPLE).collect()
    bare = _Space(np.zeros((1, seen[0] + 1)), float(seen[1]))
    taken = bare.matrix([r["vector"] for r in sample])
    space = _Space(_pivots(np.hstack([taken, np.sqrt(np.maximum(bare.largest - (taken**2).sum(axis=1), 0))[:, None]])), bare.largest)

    keyed = rows.select("id", "vector").mapInArrow(_key(space), "id bigint, vector array<double>, pivot int, distance double")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = keyed.repartitionByRange(parts, "pivot", "distance", "id").sortWithinPartitions("pivot", "distance", "id")
    index = cut(dealt.mapInArrow(_pack(space), _INDEX))

    path = shared_path(spark, "top-k")
    blocks = math.ceil(seen[2] / QUERY_BLOCK)
    for b in range(blocks):
        asked = rows.where("asks").where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).select("id", "vector").orderBy("id").collect()
        queries = _Queries(space, np.array([r["id"] for r in asked], dtype=np.int64), space.matrix([r["vector"] for r in asked]), k)
        bounds = _ranked(index.mapInArrow(_first(queries), "query bigint, vec_id bigint, score bigint"), k).where(F.col("rank") == k).select("query", "score", "vec_id").collect()
        for r in bounds:
            queries.bound(r["query"], r["score"], r["vec_id"])
        names = spark.createDataFrame(list(enumerate(queries.ids.tolist())), "query bigint, query_id bigint")
        best = _ranked(index.mapInArrow(_walk(queries), "query bigint, vec_id bigint, score bigint"), k)
        best.join(F.broadcast(names), "query").select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)
