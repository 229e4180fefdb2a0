"""Whitening against an eigendecomposition of the whole covariance."""

from __future__ import annotations

import math

import numpy as np
import pytest

from encore.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, y long, e double, `a.b` int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2.0, 3) for i, v in rows], SCHEMA).repartition(4)


def check(rows, got, components=16):
    """Every row's columns against numpy's eigh of the exact covariance."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    size = max(len(v) for _, v in kept)
    kept = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in kept if len(v) == size]
    fit = np.array(sorted({tuple(x) for _, x in kept}), dtype=np.int64)
    n, S = len(fit), fit.sum(axis=0)
    X = (n * fit - S) / n
    values, vectors = np.linalg.eigh(X.T @ X / n)
    order = np.argsort(-values)[:components]
    order = [k for k in order if values[k] > 1e-12 * values.max()]
    assert len(got) == len(kept) * len(order)
    by_row = {}
    for r in got:
        by_row.setdefault((r.vec_id, r.deviation), []).append(r)
    signs = np.zeros(len(order))
    for i, x in kept:
        deviation = sum((n * a - int(b)) ** 2 for a, b in zip(x, S))
        mine = by_row[i, deviation]
        for r in mine[:len(order)] if len(mine) == len(order) else []:
            c = r.component - 1
            want = ((n * np.array(x) - S) / n) @ vectors[:, order[c]] / math.sqrt(values[order[c]])
            if not signs[c] and abs(want) > 1e-3:
                signs[c] = math.copysign(1, want * r.whitened)
            assert abs(r.whitened - signs[c] * want) < 1e-8 or not signs[c] and abs(r.whitened) < 2e-3
            assert r.n == n and abs(r.explained - values[order[c]] / values.sum()) < 1e-10
            assert r.identity_error < 1e-9


def test_against_eigh(spark):
    rng = np.random.default_rng(3)
    spread = rng.standard_normal((24, 24)) * np.linspace(3, 0.4, 24)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rng.standard_normal((400, 24)) @ spread)]
    rows += [(i, rows[7][1]) for i in range(1000, 1200)]  # one vector with a third of all rows
    rows += [(None, rows[8][1]), (5000, None), (5001, [None] * 24), (5002, [math.nan] * 24), (5003, [math.inf] + [0.0] * 23), (5004, [1.0]), (5005, [])]
    check(rows, whitening.whiten(frame(spark, rows)).collect())


def test_many_dimensions_stop_early(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rng.standard_normal((300, 60)) * 8 * 0.8 ** np.arange(60) + 5)]
    check(rows, whitening.whiten(frame(spark, rows), components=4).collect(), components=4)


@pytest.mark.parametrize("rows, n_components", [
    ([(1, [0.5, 0.25])], 0), ([], 0), ([(1, []), (2, [])], 0), ([(1, None)], 0),
    ([(1, [0.0, 0.0, 1.0]), (2, [1.0, 0.0, 1.0]), (3, [3.0, 0.0, 1.0])], 1),  # one dimension varies
    ([(i, [float(i == k) for k in range(5)]) for i in range(5)], 4)])  # equal eigenvalues
def test_few_components(spark, rows, n_components):
    got = whitening.whiten(frame(spark, rows)).collect()
    assert {r.component for r in got} == set(range(1, n_components + 1))
    assert all(r.identity_error < 1e-9 for r in got)


def test_deviation_beyond_a_long_is_refused(spark):
    with pytest.raises(OverflowError):
        whitening.whiten(frame(spark, [(i, [1e9 * i, 1.0]) for i in range(9)]))
