import math

import numpy as np
import pytest

from citeflow.llm import queries, topk


def brute(rows, asks, k=5):
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in good:
        if asks(q):
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q)
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def test_table(spark, sf):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert sorted(map(tuple, queries.op6_topk(spark, sf).collect())) == brute(rows, lambda q: q % 50 == 0)


@pytest.mark.parametrize("block", [7, 8192])
def test_ties_nulls_and_clusters(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "QUERY_BLOCK", block)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 8)) * 3
    rows = [(k, (centres[k % 6] + 0.05 * rng.normal(size=8)).tolist()) for k in range(400)]
    rows += [(1000 + k, [1.0] * 8) for k in range(60)] + [(2000, None), (2050, [float("nan")] * 8), (2100, [None] * 8), (2150, [float("inf")] * 8), (2200, []), (2250, [0.0] * 8), (2300, [1e4] * 8), (None, [1.0] * 8)]
    frame = spark.createDataFrame([(*r, "x", 3) for r in rows], "vec_id bigint, embedding array<float>, rank string, score int")
    got = sorted(map(tuple, topk.top_k(frame, "id % 50 = 0").collect()))
    assert got == brute(rows, lambda q: q % 50 == 0)


def test_few_rows_and_none(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert topk.top_k(spark.createDataFrame([], schema), "true").count() == 0
    assert topk.top_k(spark.createDataFrame([(0, [1.0])], schema), "true").count() == 0
    got = topk.top_k(spark.createDataFrame([(0, [1.0, 2.0]), (1, [-1.0, 0.5]), (2, [0.25, 0.0])], schema), "id = 0").collect()
    assert [tuple(r) for r in sorted(got)] == [(0, 1, 2, 64 * 256), (0, 2, 1, -256 * 256 + 512 * 128)]


def test_few_annuli_are_walked():
    """On clustered rows the bounds leave most blocks out."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(16, 8)) * 1000
    rows = np.floor(np.repeat(centres, 50, axis=0) + rng.normal(size=(800, 8)))
    largest = float((rows**2).sum(axis=1).max())
    space = topk._Space(np.hstack([centres, np.sqrt(np.maximum(largest - (centres**2).sum(axis=1), 0))[:, None]]), largest)
    asked = topk._Queries(space, np.arange(1), rows[:1], 5)
    asked.least[:] = np.sort(topk._exact(rows[:1], rows)[0])[-6]
    to = space.distances(rows)
    near = to.argmin(axis=1)
    reached = [p for p in range(16) if (asked.apart(p, to[near == p, p].min(), to[near == p, p].max()) <= asked.reach())[0]]
    assert len(reached) < 8
