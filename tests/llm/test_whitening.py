"""Whitening against a library's eigenpairs and exact integers."""

from __future__ import annotations

import numpy as np
import pytest

from ledgerlight.llm import whitening as W


def test_inertia_counts_signs():
    rng = np.random.default_rng(1)
    for d in (1, 2, 5, 40):
        a = rng.standard_normal((d, d))
        a = a + a.T
        np.fill_diagonal(a, 0 if d > 1 else 1)  # needs pivots of two rows
        values = np.linalg.eigvalsh(a)
        assert W.inertia(a) == ((values > 0).sum(), 0, (values < 0).sum())
    assert W.inertia(np.diag([3.0, 0.0, -1.0, 0.0])) == (1, 2, 1)


@pytest.mark.parametrize("spectrum", [
    [9.0, 7, 5, 3, 1], [5.0] * 15 + [1] * 3, [5.0, 4, 3] + [2] * 11 + [1], [1e12, 1, 1e-3, 0, 0], [1.0] * 30, [0.0] * 6, [2.0],
    list(np.geomspace(1, 1e-6, 60)), [1 + 1e-9 * i for i in range(20)],
])
def test_leading_eigenpairs(spectrum):
    d = len(spectrum)
    q, _ = np.linalg.qr(np.random.default_rng(2).standard_normal((d, d)))
    v = q * spectrum @ q.T
    v = (v + v.T) / 2
    k, norm = min(4, d), max(spectrum)
    values, vectors = W.leading(v, k)
    assert np.allclose(values, sorted(spectrum)[::-1][:k], rtol=0, atol=1e-14 * d * norm)
    assert np.abs(vectors @ vectors.T - np.eye(k)).max() < 1e-12
    assert np.linalg.norm(v @ vectors.T - vectors.T * values) <= 1e-13 * d * norm


def test_query_equals_plain_computation(spark):
    rng = np.random.default_rng(4)
    body = (rng.standard_normal((300, 7)) * [3, 2.5, 2, 1.5, 1, 1, 1]).astype(np.float32)
    body[200:] = body[7]  # a third of all rows are copies
    df = spark.createDataFrame([(i, v.tolist(), 5) for i, v in enumerate(body)], "vec_id long, embedding array<float>, n int")
    x0 = np.floor(256 * body.astype(float)).astype(int)
    x = np.unique(x0, axis=0)
    centred = x - x.sum(axis=0) / len(x)
    v = centred.T @ centred / len(x)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:4], vectors[:, ::-1][:, :4]
    want = (x0 - x.sum(axis=0) / len(x)) @ vectors / np.sqrt(values)
    rows = W.report(df).collect()
    got = np.zeros_like(want)
    for r in rows:
        got[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert r["n"] == len(x) and r["identity_error"] < 1e-12
        assert r["deviation"] == sum((len(x) * int(a) - int(s)) ** 2 for a, s in zip(x0[r["vec_id"]], x.sum(axis=0)))
        assert abs(r["explained"] - values[r["component"] - 1] / np.trace(v)) < 1e-12
    assert len(rows) == 1200
    signs = np.sign(got[0] * want[0])
    assert np.abs(got * signs - want).max() < 1e-10


def test_defined_results(spark):
    nan, inf = float("nan"), float("inf")
    kept = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [0.5, -1.0]), (2, [3.0, 0.0]), (3, [0.25]), (10, [2.0, 2.0, 2.0]), (11, [2.0, 2.0, 2.0])]
    dropped = [(4, None), (5, []), (6, [nan, 1.0]), (7, [-inf, 1.0]), (8, [None, 1.0])]
    df = spark.createDataFrame(kept + dropped, "vec_id long, embedding array<double>")
    rows = W.report(df).collect()
    assert len(rows) == sum(len(v) for _, v in kept)
    assert {(r["vec_id"], r["n"]) for r in rows} == {(1, 3), (None, 3), (2, 3), (3, 1), (10, 1), (11, 1)}
    assert all(r["whitened"] is None and r["explained"] is None and r["identity_error"] is None for r in rows if r["n"] == 1)
    assert all(r["identity_error"] < 1e-12 for r in rows if r["n"] == 3)
    assert W.report(df.where("false")).count() == 0
    wide = W.report(spark.createDataFrame([(1, [1e300, 0.0]), (2, [0.0, 1.0])], df.schema)).collect()
    assert {r["deviation"] for r in wide} == {2**63 - 1}
