"""Whitening against a dense eigendecomposition."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from gleanery.llm.whitening import _deviations, bidiagonalise, whiten

SCHEMA = "vec_id bigint, embedding array<float>, label int, n bigint, whitened string, vector string, key string"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 1, 2, "w", "v", "k") for i, v in vectors], SCHEMA).repartition(3)


def whole(vectors) -> np.ndarray:
    return np.array([[math.floor(64 * float(np.float32(c))) + 1000000 for c in v] for v in vectors])


def dense(x: np.ndarray):
    centred = x - x.mean(axis=0)
    e, v = np.linalg.eigh(centred.T @ centred / len(x))
    return centred, e[::-1], v[:, ::-1]


def test_against_a_dense_decomposition(spark):
    rng = np.random.default_rng(3)
    v = (rng.standard_normal((700, 40)) * np.linspace(3, 0.3, 40) + rng.standard_normal(40)).tolist()
    odd = [(1000, None), (1001, []), (1002, [1.0] * 39 + [None]), (1003, [1.0] * 39 + [float("nan")]), (1004, [float("inf")] + [0.0] * 39), (1005, [1.0, 2.0])]
    repeated = [(0, v[0]), (0, v[1]), (None, v[2])]
    every = list(enumerate(v)) + repeated
    got = whiten(table(spark, every + odd)).collect()
    x = whole([row for _, row in every])
    centred, e, vectors = dense(x)
    assert len(got) == len(every) and {r.n for r in got} == {len(every)}
    assert got[0].identity_error < 1e-10 and len({r.identity_error for r in got}) == 1
    np.testing.assert_allclose(got[0].explained, (e / e.sum())[:32], rtol=1e-11)
    by_id = {r.vec_id: r for r in got if r.vec_id and r.vec_id > 0}
    want = centred @ vectors[:, :32] / np.sqrt(e[:32])
    found = np.array([by_id[i].whitened for i in range(1, 700)])
    sign = np.sign((found * want[1:700]).sum(axis=0))
    np.testing.assert_allclose(found * sign, want[1:700], atol=1e-9)
    sums = x.sum(axis=0)
    assert all(by_id[i].deviation == sum((len(x) * int(c) - int(s)) ** 2 for c, s in zip(x[i], sums)) for i in range(1, 700))


def test_few_or_equal_rows(spark):
    assert whiten(table(spark, [])).count() == 0
    assert whiten(table(spark, [(1, None)])).count() == 0
    assert whiten(table(spark, [(1, [1.0, 2.0])])).count() == 0
    assert whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    got = whiten(table(spark, [(1, [1.0, 2.0, 0.0]), (2, [1.0, 2.0, 0.0]), (3, [2.0, 2.0, 0.0])]), key="vec_id").collect()
    assert {len(r.whitened) for r in got} == {1} and {r.n for r in got} == {3}
    assert {(r.vec_id, round(r.whitened[0], 9)) for r in got} == {(1, round(-math.sqrt(0.5), 9)), (2, round(-math.sqrt(0.5), 9)), (3, round(math.sqrt(2), 9))}


def products(c):
    def of(a, makers):
        u = c @ a
        return u @ u, (c @ makers).T @ u, c.T @ u

    return of


_RNG = np.random.default_rng(1)
_WIDE = _RNG.standard_normal((20, 64))


@pytest.mark.parametrize(
    "rows",
    [
        _RNG.standard_normal((300, 30)),
        _RNG.standard_normal((300, 30)) * np.logspace(0, -5, 30),
        _RNG.standard_normal((300, 4)) @ _RNG.standard_normal((4, 30)),
        np.eye(30)[_RNG.integers(0, 30, 900)],
        np.vstack([np.eye(30)] * 3),
        _WIDE - _WIDE.mean(axis=0),
        np.zeros((4, 6)),
    ],
    ids=["full", "graded", "low rank", "nearly equal", "equal", "wide", "none"],
)
def test_bidiagonal_form(rows):
    b, right = bidiagonalise(products(rows), rows.shape[1])
    want = np.linalg.svd(rows, compute_uv=False)
    want = want[want > 1e-10 * max(want[0], 1e-300)]
    assert len(b) >= len(want) and np.array_equal(b, np.triu(np.tril(b, 1)))
    np.testing.assert_allclose(right.T @ right, np.eye(len(b)), atol=1e-13)
    if len(b):
        _, s, q = np.linalg.svd(b)
        np.testing.assert_allclose(s[: len(want)], want, atol=1e-13 * want[0])
        vectors = right @ q.T
        np.testing.assert_allclose(rows.T @ (rows @ vectors), vectors * s**2, atol=1e-12 * want[0] ** 2)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(-(2**33), 2**33), min_size=3, max_size=3), min_size=1, max_size=5), st.integers(1, 2**25))
def test_deviations_are_exact(x, n):
    sums = np.array([7, -5, 2**40])
    want = [sum((n * c - s) ** 2 for c, s in zip(row, sums.tolist())) for row in x]
    assert [Fraction(v) for v in _deviations(np.array(x), n, sums).to_pylist()] == want


def test_repeated_passes_agree(spark):
    """A second run, other partitions and other columns give the same components."""
    rng = np.random.default_rng(4)
    v = list(enumerate((rng.standard_normal((200, 8)) * np.arange(1, 9)).tolist()))
    one = {r.vec_id: r.whitened for r in whiten(table(spark, v)).collect()}
    two = {r.vec_id: r.whitened for r in whiten(table(spark, v).select("embedding", "vec_id").coalesce(1)).collect()}
    for i in one:
        np.testing.assert_allclose(one[i], two[i], atol=1e-10)
