from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gaugeworks.llm import queries, spectrum, whitening


def polynomial(matrix):
    bits = spectrum.coefficient_bits(matrix)
    parts = [(p, spectrum.polynomial_modulo(np.array([[x % p for x in r] for r in matrix]), p)) for p in spectrum.primes_below(1 << 31, bits)]
    return spectrum.by_remainders(parts)


def plain_polynomial(matrix):
    """By the traces of powers (Newton's identities), in fractions."""
    d, power, sums = len(matrix), [[Fraction(int(i == j)) for j in range(len(matrix))] for i in range(len(matrix))], []
    for _ in range(d):
        power = [[sum(power[i][k] * matrix[k][j] for k in range(d)) for j in range(d)] for i in range(d)]
        sums.append(sum(power[i][i] for i in range(d)))
    c = [Fraction(1)]
    for k in range(1, d + 1):
        c.append(-sum(c[k - i] * sums[i - 1] for i in range(1, k + 1)) / k)
    return [int(x) for x in c]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(-(10**6), 10**6), min_size=4, max_size=4), min_size=1, max_size=6))
def test_polynomial_of_scatters(rows):
    x = np.array(rows, object)
    scatter = x.T.dot(x).tolist()
    assert polynomial(scatter) == plain_polynomial(scatter)


def test_multiple_zero_and_close_roots():
    spread = [[5, 0, 0, 0], [0, 5, 0, 0], [0, 0, 0, 0], [0, 0, 0, 5]]
    values, vectors = spectrum.components(spread, polynomial(spread), 16)
    assert [float(v) for v in values] == [5.0] * 3 and np.allclose(vectors @ vectors.T, np.eye(3)) and np.abs(vectors[:, 2]).max() < 1e-60
    near = [[10**30, 1, 0], [1, 10**30 + 1, 0], [0, 0, 10**30 + 2]]  # gaps of 1e-30 of the values
    values, vectors = spectrum.components(near, polynomial(near), 3)
    block = np.linalg.eigh(np.array([[0.0, 1], [1, 1]]))
    gaps = sorted([*block[0], 2.0])[::-1]
    assert np.allclose([float(v - 10**30) for v in values], gaps, rtol=1e-12)
    assert np.allclose(np.abs(vectors[2][:2]), np.abs(block[1][:, 0]), rtol=1e-12)
    nothing = [[0, 0], [0, 0]]
    assert spectrum.components(nothing, polynomial(nothing), 2)[0] == []


def test_whole_table_against_doubles(spark, sf_small):
    rows = spark.read.parquet(f"{sf_small}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.floor(64 * np.array([r.embedding for r in rows])).astype(np.int64) + 1_000_000
    fitted = np.unique(x, axis=0)
    n, total = len(fitted), fitted.sum(axis=0)
    centred = fitted - total / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    got = queries.op12_whitening(spark, sf_small).toPandas().sort_values(["vec_id", "component"])
    assert len(got) == 16 * len(rows) and got["n"].eq(n).all() and got["identity_error"].between(0, 1e-9).all()
    assert got["deviation"].tolist() == np.repeat(((n * x - total) ** 2).sum(axis=1), 16).tolist()
    assert np.allclose(got["explained"][:16], values[::-1][:16] / values.sum(), rtol=1e-10)
    want = (x - total / n) @ vectors[:, ::-1][:, :16] / np.sqrt(values[::-1][:16])
    assert np.allclose(np.abs(got["whitened"].to_numpy().reshape(-1, 16)), np.abs(want), atol=1e-7)


def test_odd_rows(spark):
    rows = [
        (1, [1.0, 2.0], 5), (2, None, 5), (3, [float("nan"), 1.0], 5), (4, [None, 1.0], 5), (5, [1.0, 2.0], 5), (6, [], 5), (7, [1e300, 0.0], 5),
        (8, [1.0], 5), (9, [3.0, -7.5], 1), (None, [0.001, -0.001], 1), (11, [float("-inf"), 1.0], 5),
    ]
    odd = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component int")
    got = whitening.whiten(odd).collect()
    assert sorted((r.vec_id or 0, r.component) for r in got) == [(i, c) for i in (0, 1, 5, 9) for c in (1, 2)]
    assert {r.n for r in got} == {3} and got[0].identity_error < 1e-12
    x = np.array([[64, 128], [192, -480], [0, -1]])
    want = ((3 * x - x.sum(axis=0)) ** 2).sum(axis=1).tolist()
    assert {(r.vec_id, int(r.deviation)) for r in got} == {(1, want[0]), (5, want[0]), (9, want[1]), (None, want[2])}
    for none in (odd.limit(0), odd.where("vec_id in (1, 5)"), odd.where("vec_id in (2, 6)")):
        assert whitening.whiten(none).collect() == []


@pytest.mark.parametrize("top", [3, 1 << 19, 1 << 45])
def test_sums_of_products_are_exact(top):
    y = np.random.default_rng(5).integers(-top, top, (5000, 3))
    sums, products = whitening.scatter_parts(y)
    big = y.astype(object)
    assert sums == big.sum(axis=0).tolist() and products == big.T.dot(big).tolist()
