"""Whitening against dense eigenvectors and exact arithmetic."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from kpiloom.llm import queries, whitening
from kpiloom.llm.whitening import fitted, identity_error, whitened

FOLDER = "/root/testdata/sf0.001"


def frame(session, vectors):
    return session.createDataFrame(list(enumerate(vectors)), "vec_id BIGINT, embedding ARRAY<FLOAT>")


def integers(vectors) -> np.ndarray:
    return np.floor(64 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 1_000_000


def test_registered_query_against_dense_eigenvectors(session, small):
    rows = small("embeddings").select("vec_id", "embedding").collect()
    x = integers([r.embedding for r in rows])
    n, sums = len(x), x.sum(axis=0)
    covariance = np.cov(x.T, bias=True)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:32], vectors[:, ::-1][:, :32]
    projected = (x - sums / n) @ vectors / np.sqrt(values)
    got = queries.queries()["op12_exact_whitening"](session, FOLDER).collect()
    table = {(r.vec_id, r.component): r for r in got}
    assert len(table) == len(got) == n * 32
    signs = {c: math.copysign(1, table[rows[0].vec_id, c].whitened * projected[0, c - 1]) for c in range(1, 33)}
    for i, row in enumerate(rows):
        deviation = sum(int(d) ** 2 for d in n * x[i] - sums)
        for c in range(1, 33):
            r = table[row.vec_id, c]
            assert (r.n, r.deviation) == (n, deviation)
            assert r.whitened == pytest.approx(signs[c] * projected[i, c - 1], abs=1e-8)
            assert r.explained == pytest.approx(values[c - 1] / np.trace(covariance), rel=1e-10)
            assert 0 <= r.identity_error < 1e-9


def random_symmetric(rng: random.Random, size: int, rank: int) -> np.ndarray:
    rows = np.array([[rng.randint(-9, 9) for _ in range(size)] for _ in range(rank)], object)
    return rows.T @ rows


@pytest.mark.parametrize("size, rank", [(1, 1), (3, 3), (6, 6), (6, 4), (9, 12)])
def test_characteristic_polynomial_is_exact(session, size, rank):
    """Against the sums of principal minors, as fractions."""
    matrix = random_symmetric(random.Random(size * 31 + rank), size, rank)
    got = whitening.characteristic(session, matrix)
    # Faddeev and Le Verrier's recursion, with whole numbers.
    coefficients, power = [1], np.zeros((size, size), object)
    for k in range(1, size + 1):
        power = matrix @ power + coefficients[-1] * np.eye(size, dtype=int).astype(object)
        coefficients.append(-sum(int(v) for v in np.diag(matrix @ power)) // k)
    assert got == coefficients[::-1]


def test_hessenberg_keeps_the_polynomial_with_zero_pivots():
    p = whitening.primes(1)[0]
    for matrix in ([[0, 1, 0], [0, 0, 1], [5, 0, 0]], [[1, 0, 2], [0, 3, 0], [2, 0, 4]], [[2, 0], [0, 2]]):
        matrix = np.array(matrix, object)
        reduced = whitening.hessenberg(matrix, p)
        assert not np.tril(reduced, -2).any()
        value = 17
        shifted = [[Fraction(value * (i == j) - int(matrix[i, j])) for j in range(len(matrix))] for i in range(len(matrix))]
        polynomial = whitening.polynomial_modulo(matrix, p)
        assert sum(c * value**k for k, c in enumerate(polynomial)) % p == determinant(shifted) % p


def determinant(rows: list[list[Fraction]]) -> int:
    if not rows:
        return 1
    return int(sum((-1) ** j * rows[0][j] * determinant([[*r[:j], *r[j + 1 :]] for r in rows[1:]]) for j in range(len(rows))))


def times(roots: list[int]) -> list[int]:
    polynomial = [1]
    for root in roots:
        polynomial = [a - root * b for a, b in zip([0, *polynomial], [*polynomial, 0], strict=True)]
    return polynomial


def test_roots_are_isolated_with_their_multiplicity():
    for roots in ([5], [1, 2, 3], [0, 0, 7, 7, 7, 8], [10**12, 10**12 + 1, 1], [4, 4], [0, 0]):
        found = whitening.isolated(times(roots))
        assert [m for _, m in found] == [roots.count(r) for r in sorted({*roots} - {0}, reverse=True)]
        for ((low, high), _), root in zip(found, sorted({*roots} - {0}, reverse=True), strict=True):
            assert low < root <= high or low == high == root
        for x in (0, 1, 6, 10**12):
            assert whitening.roots_above(times(roots), Fraction(x)) == sum(r > x for r in roots)


def test_close_and_repeated_eigenvalues(session):
    """Eigenvalues that doubles can hardly tell apart, and equal ones, have orthonormal components."""
    big = 10**9
    matrix = np.array([[big, 1, 0, 0], [1, big, 0, 0], [0, 0, 7, 0], [0, 0, 0, 7]], object)
    roots, vectors = whitening.eigen(session, matrix, 4)
    assert roots[2] == roots[3] and [round(float(r)) for r in roots] == [big + 1, big - 1, 7, 7]
    assert np.abs(vectors @ vectors.T - np.eye(4)).max() < 1e-15
    assert np.abs(np.abs(vectors[:2, :2]) - math.sqrt(0.5)).max() < 1e-15
    assert len(whitening.eigen(session, matrix, 3)[0]) == 3


def test_dependent_dimensions_have_fewer_components(session):
    rng = random.Random(5)
    vectors = [(a := rng.random(), b := rng.random(), a, 1.0, b) for _ in range(50)]
    rows = frame(session, vectors)
    model = fitted(rows)
    assert len(model.components) == 2 and model.explained.sum() == pytest.approx(1)
    assert identity_error(whitened(rows, model), 2) < 1e-12


def test_exact_sums_of_large_entries(session):
    """Entries whose products are far over 64 bits: the scatter has no rounding."""
    vectors = [(2.0**40, 1.0), (2.0**40 + 2**20, -2.0**41), (-3.0, 5.5)]
    rows = session.createDataFrame([(v,) for v in vectors], "embedding ARRAY<DOUBLE>")
    n, sums, matrix = whitening.scatter(rows, "embedding", 2)
    x = np.array([[math.floor(64 * c) for c in v] for v in vectors], object)
    assert n == 3 and sums == list(x.sum(axis=0))
    assert (matrix == 3 * (x.T @ x) - np.outer(x.sum(axis=0), x.sum(axis=0))).all()
    with pytest.raises(Exception, match="too large"):
        whitening.scatter(session.createDataFrame([([2.0**60],)], "embedding ARRAY<DOUBLE>"), "embedding", 1)


def test_odd_rows(session):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0]), (2, None), (3, [0.5, None]), (4, [nan, 1.0]), (5, [1.0, inf]), (None, [1.0, 0.0]), (1, [0.5, 1.0]), (6, [])]
    rows = [(i, v, "x", -1.0) for i, v in rows]
    table = session.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>, whitened STRING, deviation DOUBLE")
    model = fitted(table)
    got = whitened(table, model).collect()
    assert model.n == 3 and sorted((r.vec_id or 0) for r in got) == [0, 1, 1]
    assert len(model.components) == 1 and all(len(r.whitened) == 1 for r in got)
    x = integers([[0.5, 1.0], [1.0, 0.0], [0.5, 1.0]])
    deviations = {tuple(map(int, v)): sum(int(d) ** 2 for d in 3 * v - x.sum(axis=0)) for v in x}
    assert sorted(r.deviation for r in got) == sorted(deviations[tuple(map(int, v))] for v in x)


def test_nothing_to_learn(session):
    for vectors in ([], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 3):
        rows = frame(session, vectors) if vectors else frame(session, [[1.0]]).limit(0)
        model = fitted(rows)
        got = whitened(rows, model)
        assert len(model.components) == 0 and identity_error(got, 0) is None
        assert all(r.whitened == [] and r.deviation == 0 for r in got.collect())
        assert got.count() == len([v for v in vectors if v])


def test_vectors_of_different_lengths_are_an_error(session):
    with pytest.raises(ValueError, match="2 to 3"):
        fitted(frame(session, [[1.0, 2.0], [1.0, 2.0, 3.0]]))
    with pytest.raises(ValueError, match="over 2"):
        fitted(frame(session, [[1.0, 2.0, 3.0]]), most_dimensions=2)
