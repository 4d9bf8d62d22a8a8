"""Whitening against numpy's symmetric eigensolver, exact deviations, and edge cases."""

import math

import numpy as np

from tallyfold.llm import whitening
from tallyfold.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute(vectors):
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors], dtype=np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    cov = ((fit - s / n).T @ (fit - s / n)) / n
    e, u = np.linalg.eigh(cov)
    return x, n, s, e[::-1], u[:, ::-1], np.trace(cov)


def test_query_equals_eigh(spark):
    raw = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    got = QUERIES["op11_embedding_whitening"](spark, SF).collect()
    x, n, s, e, u, trace = brute([r.embedding for r in raw])
    assert len(got) == 16 * len(raw)
    by = {(r.vec_id, r.component): r for r in got}
    for i, r in enumerate(raw):
        dev = sum((int(n) * int(a) - int(b)) ** 2 for a, b in zip(x[i], s))
        for k in range(1, 17):
            row = by[r.vec_id, k]
            assert row.n == n and row.deviation == dev
            assert abs(row.explained - e[k - 1] / trace) <= 1e-4 * e[k - 1] / trace
            want = (x[i] - s / n) @ u[:, k - 1] / math.sqrt(e[k - 1])
            assert abs(abs(row.whitened) - abs(want)) < 1e-6
            assert row.identity_error <= 1e-4


def test_edge_cases(spark):
    rows = [
        (1, [0.5, 0.25, -1.0]), (2, [0.0, 1.0, 2.0]), (3, None), (4, [1.0, None, 2.0]), (5, [float("nan"), 1.0, 1.0]),
        (6, [float("inf"), 1.0, 1.0]), (None, [1.0, 1.0, 0.0]), (7, [0.5, 0.25, -1.0]), (8, [3.0]), (9, [2.0, 2.0, 2.0]),
    ]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<float>, x string")
    got = whitening.whiten(df).collect()
    # Rows 3-6 are invalid, 8 has another length; 1 and 7 repeat one vector, so the fit list has four.
    assert sorted({r.vec_id for r in got}, key=str) == sorted({1, 2, 7, 9, None}, key=str)
    assert {r.n for r in got} == {4} and max(r.component for r in got) == 3
    assert all(r.identity_error <= 1e-4 for r in got)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert whitening.whiten(empty).collect() == []
    one = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert whitening.whiten(one).collect() == []


def test_factor_and_rotations():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(40, 6)) @ rng.normal(size=(6, 9))
    c = a.T @ a / 40
    g = whitening.pivoted_cholesky(c)
    assert g.shape == (9, 6) and np.allclose(g @ g.T, c)
    values, vectors = whitening.one_sided_jacobi(g)
    want = np.linalg.eigvalsh(c)[::-1][:6]
    assert np.allclose(values, want, rtol=1e-10)
    assert np.allclose(c @ vectors, vectors * values, atol=1e-9)
