from __future__ import annotations

import math

import numpy as np
import pytest

from ledgersieve.llm.whitening import whiten

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, components=16, width=None):
    """Distinct quantised vectors, numpy's eigenvectors of their covariance, exact deviations."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [(i, tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v)) for i, v in good]
    x = [(i, v) for i, v in x if width is None or len(v) == width]
    fit_list = sorted({v for _, v in x})
    n, a = len(fit_list), np.array(fit_list, np.float64)
    sums = [sum(v[d] for v in fit_list) for d in range(a.shape[1])]
    mean = np.array([s / n for s in sums])
    covariance = (a - mean).T @ (a - mean) / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    deviation = {(i, v): sum((n * c - s) ** 2 for c, s in zip(v, sums)) for i, v in x}
    return n, x, deviation, (np.array([v for _, v in x]) - mean) @ vectors / np.sqrt(np.maximum(values, 1e-300)), values / np.trace(covariance)


def some_rows(n, width, seed=1):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(n, width)) * np.linspace(2.0, 0.2, width) @ np.linalg.qr(rng.normal(size=(width, width)))[0]
    return [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(mixed)]


def test_equals_brute_force(spark):
    rows = some_rows(400, 24)
    rows += [(1000 + i, rows[7][1]) for i in range(300)]  # a hot vector counts once
    rows += [(2000, None), (2001, []), (2002, [None] * 24), (2003, [float("nan")] + [0.0] * 23), (2004, [float("-inf")] + [0.0] * 23)]
    rows += [(None, rows[3][1]), (3, rows[3][1])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).repartition(5)
    out, model = whiten(df)
    n, x, deviation, expected, explained = brute(rows)
    assert model.n == n and model.identity_error < 1e-10
    assert np.allclose(model.explained, explained, rtol=1e-9)
    got = sorted(((repr(r.vec_id), r.deviation, tuple(r.whitened)) for r in out.collect()))
    signs = np.sign(np.sum(expected * expected[:1], axis=0))
    wanted = sorted((repr(i), deviation[i, v], tuple(e)) for (i, v), e in zip(x, expected))
    assert [g[:2] for g in got] == [w[:2] for w in wanted]
    a, b = np.array([g[2] for g in got]), np.array([w[2] for w in wanted])
    assert np.allclose(a * np.sign((a * b).sum(axis=0)), b, atol=1e-8)
    assert signs.shape == (16,)


def test_directions_without_variance(spark):
    rows = [(i, [c, 1.5, c, 2 * d]) for i, (_, (c, d)) in enumerate(some_rows(60, 2))]
    out, model = whiten(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA))
    assert model.n == 60 and model.identity_error < 1e-10
    n, x, _, expected, explained = brute(rows)
    varied = model.eigenvalues > 0
    assert varied.tolist() in ([True, True, True, False], [True, True, False, False])
    assert np.allclose(model.explained, explained, atol=1e-9)
    for row in out.collect():
        assert [w is not None for w in row.whitened] == varied.tolist()


@pytest.mark.parametrize("rows, expected", [
    ([], 0), ([(1, None), (2, [])], 0), ([(1, [0.5, 0.25]), (2, [0.5, 0.25])], 2), ([(1, [3e38, -3e38]), (2, [0.0, 1.0])], 2)])
def test_small_tables(spark, rows, expected):
    out, model = whiten(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA))
    assert out.count() == expected
    assert model.n == len({tuple(v) for _, v in rows if v})


def test_commonest_length_counts(spark):
    rows = some_rows(30, 3) + [(100, [1.0, 2.0]), (101, [1.0])]
    out, model = whiten(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA))
    assert (out.count(), model.n, model.basis.shape) == (30, 30, (3, 3))


def test_clashing_columns_are_not_read(spark):
    df = spark.createDataFrame([(i, v, 0) for i, v in some_rows(20, 3)], SCHEMA).withColumnsRenamed({"label": "x"})
    out, _ = whiten(df.selectExpr("*", "1 AS id", "2 AS whitened", "3 AS deviation"))
    assert out.columns == ["vec_id", "deviation", "whitened"] and out.count() == 20


def test_large_numbers_stay_exact(spark):
    rows = [(0, [2.0**40, 0.0]), (1, [-(2.0**40), 1.0]), (2, [2.0**20, 3.0])]
    out, model = whiten(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA))
    _, x, deviation, _, _ = brute(rows)
    assert {r.vec_id: r.deviation for r in out.collect()} == {
        i: d if d < 2**63 else None for (i, _), d in deviation.items()}
    assert model.sums == tuple(sum(v[d] for _, v in x) for d in range(2))
