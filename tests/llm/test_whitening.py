from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from citeflow.llm import charpoly, whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int, component string"


def _brute(vectors, most=16):
    """Whitened values by numpy's own eigenvectors, and the shares, over distinct whole vectors."""
    x = np.floor(64 * np.array(vectors, dtype=np.float32).astype(float)) + 1000000
    fit = np.unique(x, axis=0)
    values, axes = np.linalg.eigh(np.cov(fit.T, bias=True))
    values, axes = values[::-1][:most], axes[:, ::-1][:, :most]
    n = len(fit)
    deviation = ((n * x - fit.sum(axis=0)) ** 2).sum(axis=1)
    return n, deviation, (x - fit.mean(axis=0)) @ axes / np.sqrt(values), values / np.trace(np.cov(fit.T, bias=True))


def test_equals_numpy_up_to_the_sign_of_a_component(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = table.orderBy("vec_id").collect()
    n, deviation, white, shares = _brute([r.embedding for r in rows])
    got = whitening.whitened(table).toPandas()
    assert set(got["n"]) == {n} and set(got["component"]) == set(range(1, 17)) and len(got) == 16 * len(rows)
    assert got["identity_error"].nunique() == 1 and 0 <= got["identity_error"].iloc[0] < 1e-12
    values = got.pivot(index="vec_id", columns="component", values="whitened").loc[[r.vec_id for r in rows]].to_numpy()
    signs = np.sign((values * white).sum(axis=0))
    assert np.abs(values * signs - white).max() < 1e-8
    assert np.allclose(got.groupby("component")["explained"].first(), shares, rtol=1e-10)
    assert got.groupby("vec_id")["deviation"].first().loc[[r.vec_id for r in rows]].tolist() == deviation.tolist()


def test_odd_rows(spark):
    vectors = [[0.5, -1.0, 3.0], [2.0, 0.25, -1.0], [1.0, 1.0, 1.0], [4.0, -2.0, 0.0]]
    rows = [(i, v, 0, "x") for i, v in enumerate(vectors)] + [(2, vectors[2], 0, "x"), (None, vectors[0], 0, None)]
    odd = [(10, None), (11, [1.0, None, 2.0]), (12, [1.0, float("nan"), 2.0]), (13, [1.0, float("inf"), 0.0]), (14, []), (15, [1.0, 2.0])]
    got = whitening.whitened(spark.createDataFrame(rows + [(i, v, 0, None) for i, v in odd], SCHEMA))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = got.collect()
    n, deviation, white, shares = _brute(vectors)
    assert {r.n for r in got} == {n} and {r.component for r in got} == {1, 2, 3}
    assert sorted((str(r.vec_id), r.component) for r in got) == sorted((str(r[0]), c) for r in rows for c in (1, 2, 3))
    for r in got:
        k = 0 if r.vec_id is None else r.vec_id
        assert r.deviation == deviation[k] and abs(abs(r.whitened) - abs(white[k, r.component - 1])) < 1e-9
        assert abs(r.explained - shares[r.component - 1]) < 1e-12 and r.identity_error < 1e-12


def test_no_rows_and_no_variance(spark):
    assert whitening.whitened(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whitened(spark.createDataFrame([(1, [1.0, 2.0], 0, "")] * 3, SCHEMA)).count() == 0
    flat = whitening.whitened(spark.createDataFrame([(i, [float(i), 5.0, 0.0], 0, "") for i in range(4)], SCHEMA)).collect()
    assert [r.component for r in flat] == [1] * 4 and {r.explained for r in flat} == {1.0}


def test_very_large_entries_stay_exact(spark):
    vectors = [[3e38, 1.0], [-3e38, 2.0], [1.0, 3.0]]
    got = whitening.whitened(spark.createDataFrame([(i, v, 0, "") for i, v in enumerate(vectors)], SCHEMA), 1).orderBy("vec_id").collect()
    x = [[min(max(int(64 * c), -(2**40)), 2**40) + 1000000 for c in v] for v in vectors]
    for r in got:
        exact = sum((3 * x[r.vec_id][k] - sum(v[k] for v in x)) ** 2 for k in range(2))
        assert r.deviation == (exact if exact < 2**63 else None)
    assert {r.identity_error < 1e-9 for r in got} == {True}


def _determinant(matrix):
    a, out = [[Fraction(v) for v in row] for row in matrix], Fraction(1)
    for k in range(len(a)):
        r = next((i for i in range(k, len(a)) if a[i][k]), None)
        if r is None:
            return Fraction(0)
        if r != k:
            a[k], a[r], out = a[r], a[k], -out
        out *= a[k][k]
        for i in range(k + 1, len(a)):
            f = a[i][k] / a[k][k]
            a[i] = [x - f * y for x, y in zip(a[i], a[k], strict=True)]
    return out


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 6).flatmap(lambda d: st.lists(st.lists(st.integers(-50, 50), min_size=d, max_size=d), min_size=1, max_size=7)))
def test_polynomial_and_roots_of_grams(rows):
    d = len(rows[0])
    gram = [[sum(r[i] * r[j] for r in rows) for j in range(d)] for i in range(d)]
    primes = charpoly.primes_beyond(2 * charpoly.coefficient_bound(gram))
    coefficients = charpoly.combined({p: charpoly.polynomial_mod(gram, p) for p in primes})
    for at in (-3, 0, 1, 7, 10**6):
        assert sum(c * at**k for k, c in enumerate(coefficients)) == _determinant([[(at if i == j else 0) - gram[i][j] for j in range(d)] for i in range(d)])
    roots = charpoly.largest_roots(coefficients, d)
    rank = np.linalg.matrix_rank(np.array(gram, dtype=float)) if any(map(any, gram)) else 0
    flat = [float(r) for r, m in roots for _ in range(m)]
    assert len(flat) >= rank and np.allclose(flat[:rank], np.linalg.eigvalsh(np.array(gram, dtype=float))[::-1][:rank], rtol=1e-6, atol=1e-6)
    for root, m in roots:
        for v in charpoly.null_space(gram, root, m):
            assert np.allclose(np.array(gram, dtype=float) @ v, float(root) * np.array(v), atol=1e-9 * float(roots[0][0]))


def test_repeated_roots_get_orthogonal_vectors():
    matrix = [[4, 0, 0, 0], [0, 9, 0, 0], [0, 0, 9, 0], [0, 0, 0, 0]]
    primes = charpoly.primes_beyond(2 * charpoly.coefficient_bound(matrix))
    roots = charpoly.largest_roots(charpoly.combined({p: charpoly.polynomial_mod(matrix, p) for p in primes}), 4)
    assert [(pytest.approx(float(r), rel=1e-25), m) for r, m in roots] == [(9, 2), (4, 1)]
    pair = np.array(charpoly.null_space(matrix, *roots[0]))
    assert np.allclose(pair @ pair.T, np.eye(2), atol=1e-14) and np.allclose(pair[:, [0, 3]], 0)


def test_components_number_from_the_largest(spark):
    got = whitening.components(spark, [[1, 0, 0], [0, 5, 0], [0, 0, 3]], 2)
    assert [round(float(e), 9) for e, _ in got] == [5, 3] and [np.argmax(np.abs(v)) for _, v in got] == [1, 2]


def test_primes():
    assert [n for n in range(60) if charpoly.is_prime(n)] == [2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37, 41, 43, 47, 53, 59]
    assert charpoly.is_prime(2**31 - 1) and not charpoly.is_prime(46337 * 46337)
