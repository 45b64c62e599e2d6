"""Whitening against exact sums and a library's eigenvectors."""

from __future__ import annotations

import math

import numpy as np
import pytest

from ledgerlight.llm import whitening
from ledgerlight.llm.queries import QUERIES

from .test_operators import SF


def plain(vectors, k=8):
    """n, exact deviations, eigenvalues, shares and whitened entries up to their signs."""
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for v in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, sums, strict=True)] for v in x])
    values, unit = np.linalg.eigh(centred.T @ centred / n)
    values, unit = values[::-1][:k], unit[:, ::-1][:, :k]
    return n, deviations, values, values / (centred**2).sum(axis=1).mean(), centred @ unit / np.sqrt(values)


def test_given_rows(spark):
    given = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    n, deviations, _, shares, whitened = plain([r.embedding for r in given])
    got = {(r.vec_id, r.component): r for r in QUERIES["op11_cholesky_jacobi"](spark, SF).collect()}
    assert set(got) == {(r.vec_id, c) for r in given for c in range(1, 9)}
    for c in range(8):
        column = np.array([got[r.vec_id, c + 1].whitened for r in given])
        sign = np.sign(column @ whitened[:, c])
        assert np.abs(column - sign * whitened[:, c]).max() < 1e-9
    for k, r in enumerate(given):
        assert all(got[r.vec_id, c].deviation == deviations[k] and got[r.vec_id, c].n == n for c in range(1, 9))
    assert np.allclose([got[given[0].vec_id, c + 1].explained for c in range(8)], shares, rtol=1e-10)
    errors = {r.identity_error for r in got.values()}
    assert len(errors) == 1 and errors.pop() < 1e-10


@pytest.mark.parametrize("seed", range(3))
def test_factors(seed):
    r = np.random.default_rng(seed)
    for d, rank in ((1, 1), (5, 5), (24, 24), (30, 7), (65, 64), (9, 0)):
        half = r.normal(size=(d, rank)) * np.exp(r.normal(size=rank) * 3)
        scatter = half @ half.T if rank else np.zeros((d, d))
        order, factor = whitening.pivoted_cholesky(scatter)
        assert factor.shape[1] == rank and (np.diff(np.diag(factor)) <= 1e-9 * factor.max(initial=1)).all()
        assert np.allclose(factor @ factor.T, scatter[np.ix_(order, order)], rtol=1e-10, atol=1e-12 * np.trace(scatter))
        values, unit = whitening.components_of(scatter, d)
        expected = np.linalg.eigvalsh(scatter)[::-1][: len(values)]
        assert np.allclose(values, expected, rtol=1e-8, atol=1e-12 * np.trace(scatter))
        assert np.abs(unit.T @ unit - np.eye(len(values))).max(initial=0) < 1e-10
        assert np.abs(scatter @ unit - unit * values).max(initial=0) <= 1e-12 * max(1, np.trace(scatter))


def test_equal_eigenvalues():
    values, unit = whitening.components_of(np.eye(12) * 4.0, 8)
    assert np.allclose(values, 4) and np.abs(unit.T @ unit - np.eye(8)).max() < 1e-15


ODD = [
    (1, [0.5, -0.25, 1.0]), (2, None), (3, [0.5, None, 1.0]), (4, [0.5, float("nan"), 1.0]), (5, [float("inf"), 0.0, 0.0]), (6, []),
    (7, [1.0, 2.0]), (8, [3e15, 0.0, 0.0]), (9, [-2.5, 0.125, 7.0]), (9, [-2.5, 0.125, 7.0]), (None, [0.001, -0.001, 0.0]), (11, [4.0, 4.0, -9.5]),
    (12, [0.0, 0.0, 0.0]),
]


def test_odd_rows(spark):
    clash = "n long, deviation string, whitened int, vector int, component int"
    rows = spark.createDataFrame([(*r, 1, "", 2, 3, 4) for r in ODD], f"vec_id long, embedding array<double>, {clash}").repartition(3)
    usable = [r for r in ODD if r[0] in (1, 9, None, 11, 12)]
    n, deviations, values, shares, _ = plain([v for _, v in usable], 3)
    fitted = whitening.fit(rows)
    assert fitted.n == n == 6 and np.allclose(fitted.eigenvalues, values) and np.allclose(fitted.eigenvalues / fitted.trace, shares)
    got = whitening.whiten(rows, fitted)
    assert got.columns == ["vec_id", "deviation", "whitened"]
    assert sorted(((r.vec_id, int(r.deviation)) for r in got.collect()), key=repr) == sorted(zip([i for i, _ in usable], deviations, strict=True), key=repr)
    assert whitening.identity_error(got, 3) < 1e-12
    as_text = rows.selectExpr("vec_id", "transform(embedding, x -> cast(x as decimal(30, 6))) as embedding").where("vec_id in (1, 9, 11)")
    assert whitening.fit(as_text).n == 4


def test_tables_without_variance(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.fit(spark.createDataFrame([], schema)) is None
    assert whitening.fit(spark.createDataFrame([(1, None), (2, [])], schema)) is None
    for vectors in ([[1.0, 2.0]], [[1.0, 2.0]] * 4):
        rows = spark.createDataFrame(list(enumerate(vectors)), schema)
        fitted = whitening.fit(rows)
        assert len(fitted.eigenvalues) == 0
        assert [(int(r.deviation), r.whitened) for r in whitening.whiten(rows, fitted).collect()] == [(0, [])] * len(vectors)
    one = spark.createDataFrame([(k, [float(k), 5.0]) for k in range(5)], schema)
    assert len(whitening.fit(one).eigenvalues) == 1


def test_query_on_an_empty_table(spark, folder):
    for name, rows in (("none", []), ("same", [(1, [0.5, 0.5], 0), (2, [0.5, 0.5], 0)])):
        spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/{name}/embeddings.parquet")
        got = QUERIES["op11_cholesky_jacobi"](spark, f"{folder}/{name}")
        assert got.collect() == [] and got.columns[-1] == "identity_error"


def test_large_numbers_stay_exact():
    """Counts and entries beyond what 64 bits hold of the square sums."""
    x = np.array([[100_000, 7], [-(1 << 45), 3], [1 << 60, -5], [5, 99]], dtype=np.int64)
    for n in (4, 10**7, 10**11):
        sums = [int(c) * (n // 4) + k for k, c in enumerate(x.astype(object).sum(axis=0))]
        fitted = whitening.Fit(n, sums, 1.0, np.array([]), np.zeros((2, 0)))
        for rows in (x[:1], x[:2], x):
            got = whitening._deviations(rows, n, *fitted.centre()).to_pylist()
            exact = [sum((n * int(c) - s) ** 2 for c, s in zip(v, sums, strict=True)) for v in rows]
            assert [None if g is None else int(g) for g in got] == [e if e < 10**38 else None for e in exact]
