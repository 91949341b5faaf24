import random

import numpy as np
import pytest
from tests.llm.cases import awkward, empty

from citeflow.llm import near_dedup, queries
from citeflow.llm.components import components


def _set(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[k : k + size]) for k in range(len(words) - size + 1))


def brute(rows, size, percent=80):
    sets = [(i, _set(t, size)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for k, (_, s) in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(k)
    seen = set()
    for same in holders.values():
        for p, k in enumerate(same):
            for m in same[p + 1 :]:
                if (k, m) not in seen and None not in (sets[k][0], sets[m][0]):
                    seen.add((k, m))
                    a, b = sets[k][1], sets[m][1]
                    if 100 * len(a & b) >= percent * len(a | b):
                        x, y = sorted((root(sets[k][0]), root(sets[m][0])))
                        parent[y] = x
    return sorted(((i, len(s), None if i is None else root(i), i is None or root(i) == i) for i, s in sets), key=str)


def _rows(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_equals_brute_force_on_the_table(spark, sf):
    want = brute(_rows(spark.read.parquet(f"{sf}/documents.parquet")), 2)
    got = sorted(map(tuple, queries.op1_near_dedup(spark, sf).collect()), key=str)
    assert got == want
    assert sum(r[3] for r in want) < len(want)


@pytest.mark.parametrize("size", [2, 5])
def test_awkward_rows(spark, size):
    docs = awkward(spark)
    got = sorted(map(tuple, near_dedup.near_duplicates(docs, size).collect()), key=str)
    assert got == brute(_rows(docs), size)
    kept = near_dedup.drop_near_duplicates(docs, size)
    assert kept.columns == docs.columns
    assert near_dedup.near_duplicates(empty(spark)).count() == 0


def test_family_at_the_threshold(spark, monkeypatch):
    """One text edited again and again: many pairs just below and above 0.8, in groups of several blocks."""
    monkeypatch.setattr(near_dedup, "BLOCK_NODES", 16)
    rng = random.Random(5)
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    rows = []
    for k in range(150):
        words = base[:]
        for _ in range(rng.choice([2, 4, 8, 9, 10, 11, 12])):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        rows.append((1000 - k, " ".join(words)))
    rows += [(5000 + k, " ".join(f"w{rng.randrange(4000)}" for _ in range(600))) for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(map(tuple, near_dedup.near_duplicates(docs, 2).collect()), key=str)
    assert got == brute(rows, 2)


def test_one_id_for_two_texts_joins_their_groups(spark):
    a, b = "a b c d e f g h i j k l", "p q r s t u v w x y z"
    docs = spark.createDataFrame([(1, a), (2, b), (3, a), (3, b), (4, "alone")], "doc_id bigint, text string")
    got = {(r["doc_id"], r["component_id"]) for r in near_dedup.near_duplicates(docs, 2).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 4)}


def test_estimate_is_near_the_similarity():
    rng = np.random.default_rng(3)
    for n in (3000, 300, 20):
        errors = []
        for _ in range(60):
            x = rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2)
            y = np.concatenate([x[: n * 9 // 10], rng.integers(0, 2**63, n // 10, dtype=np.uint64) * np.uint64(2)])
            true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
            errors.append(near_dedup.estimate(near_dedup.registers(np.unique(x)), near_dedup.registers(np.unique(y))) - true)
        assert abs(np.mean(errors)) < 0.02 and np.max(np.abs(errors)) < near_dedup.SLACK


def test_components_of_chains_and_hubs(spark):
    chain = [(k, k + 1) for k in range(0, 400)]
    hub = [(1000, 1000 + k) for k in range(1, 300)]
    out = {r["node"]: r["component"] for r in components(spark.createDataFrame([*chain, *hub, (7, 7)], "a bigint, b bigint")).collect()}
    assert out == {**{k: 0 for k in range(401)}, **{1000 + k: 1000 for k in range(300)}}


def test_rows_that_are_exact_copies_stay_once(spark):
    rows = [(1, "a b c d e f", "x"), (1, "a b c d e f", "y"), (1, "q r s t u v w", "x"), (2, "a b c d e f", "x"), (3, None, "x"), (3, None, "x")]
    rows += [(None, "no id", "x"), (None, "no id", "x"), (None, "other", "x"), (None, None, "x"), (None, None, "x"), (4, "alone", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = sorted(map(tuple, near_dedup.drop_near_duplicates(docs).collect()), key=str)
    want = [r for r in set(rows) if r not in ((1, "a b c d e f", "y"), (2, "a b c d e f", "x"))]
    assert got == sorted(want, key=str)


def test_estimates_are_made_of_small_slices(monkeypatch):
    import pyarrow as pa

    sizes, plain = [], near_dedup._matrix
    monkeypatch.setattr(near_dedup, "_matrix", lambda column: sizes.append(len(column)) or plain(column))
    one, other = (near_dedup.registers(np.sort(np.random.default_rng(k).integers(0, 1 << 63, 3000).astype(np.uint64))).tobytes() for k in range(2))
    n = 2500
    pairs = pa.table({"a": range(n), "b": range(n), "a_registers": [one] * n, "b_registers": [one if k % 5 else other for k in range(n)]})
    got = [x for batch in near_dedup._close_pairs(0.7)(iter(pairs.to_batches())) for x in batch.column("a").to_pylist()]
    assert got == [k for k in range(n) if k % 5]
    assert max(sizes) <= 1024 and sum(sizes) == 2 * n
