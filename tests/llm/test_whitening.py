"""Incremental eigendecomposition against a direct one, and the contract's columns against brute force."""

import math
from collections import Counter
from decimal import Decimal

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hearth.llm import queries, whitening


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 12), st.integers(0, 10**6), st.floats(-12, 3))
def test_secular_roots(m, seed, spread):
    rng = np.random.default_rng(seed)
    d = np.cumsum(10.0 ** rng.uniform(spread, 3, m))
    z = rng.choice([-1, 1], m) * 10.0 ** rng.uniform(-3, 2, m)
    roots, apart = whitening.secular_roots(d, z)
    want = np.linalg.eigvalsh(np.diag(d) + np.outer(z, z))
    assert np.allclose(roots, want, rtol=1e-11, atol=1e-12 * want[-1])
    assert np.all(roots >= d) and np.all(roots[:-1] <= d[1:]) and np.all(np.diag(apart) < 0)


def check(spectrum, x):
    centred = x - x.mean(axis=0)
    scatter = centred.T @ centred
    u, d = spectrum.vectors, spectrum.values
    size = max(scatter.max(), 1)
    assert np.allclose(u.T @ u, np.eye(u.shape[1]), atol=1e-11)
    assert np.allclose((u * d) @ u.T, scatter, atol=1e-11 * size * len(x))
    assert np.allclose(spectrum.mean, x.mean(axis=0)) and spectrum.n == len(x)


SHAPES = [lambda r: r.integers(-40, 40, (200, 9)), lambda r: r.integers(-2, 3, (90, 6)), lambda r: np.zeros((30, 4), int),
          lambda r: np.outer(r.integers(-9, 9, 50), np.arange(1, 8)), lambda r: np.eye(12, dtype=int).repeat(5, axis=0),
          lambda r: r.integers(-10**6, 10**6, (5, 20)), lambda r: np.full((1, 3), 7), lambda r: r.integers(-5, 5, (400, 1)),
          lambda r: np.column_stack([r.integers(-10**8, 10**8, 80), r.integers(-1, 2, 80), np.full(80, 3)])]


@pytest.mark.parametrize("shape", range(len(SHAPES)))
def test_vectors_one_by_one(shape):
    x = SHAPES[shape](np.random.default_rng(shape))
    s = whitening.Spectrum(x.shape[1])
    for v in x.astype(float):
        s.add(v)
    check(s, x)


@pytest.mark.parametrize("shape", range(len(SHAPES)))
def test_spectra_combine(shape):
    x = SHAPES[shape](np.random.default_rng(shape + 50))
    parts = np.array_split(x, min(4, len(x)))
    spectra = []
    for p in parts:
        s = whitening.Spectrum(x.shape[1])
        s.sums = whitening.exact_sums(p)
        for v in p.astype(float):
            s.add(v)
        spectra.append(s)
    total, *rest = spectra
    for s in rest:
        total.combine(s)
    check(total, x)
    assert total.sums == x.sum(axis=0).tolist()


def brute(rows, components=16):
    """``vec_id -> [(component, n, deviation, |whitened|, explained)]`` by a direct decomposition of each length."""
    kept = []
    for vec_id, e in rows:
        if e and all(c is not None and math.isfinite(c) and abs(c) < 2**55 for c in e):
            kept.append((vec_id, tuple(math.floor(64 * c) + 1_000_000 for c in e)))
    out = []
    for dim in {len(x) for _, x in kept}:
        fit = sorted({x for _, x in kept if len(x) == dim})
        n, sums = len(fit), [sum(c) for c in zip(*fit)]
        centred = np.array([[float(Decimal(n * a - s) / n) for a, s in zip(x, sums)] for x in fit])
        v = centred.T @ centred / n
        values, vectors = np.linalg.eigh(v)
        order = np.argsort(-values)[:components]
        order = order[values[order] > 1e-12 * max(values.max(), 1e-300)]
        for vec_id, x in kept:
            if len(x) == dim:
                scaled = [n * a - s for a, s in zip(x, sums)]
                deviation = sum(a * a for a in scaled)
                white = np.array([a / n for a in scaled]) @ vectors[:, order] / np.sqrt(values[order])
                out += [(vec_id, c + 1, n, deviation if deviation < 2**63 else None, abs(white[c]),
                         values[order[c]] / np.trace(v)) for c in range(len(order))]
    return out


def compare(got, want, tol=1e-7):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2], r[3] or 0, r[4])
    got = sorted(((r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in got), key=key)
    want = sorted(want, key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert np.allclose([r[4:] for r in got], [r[4:] for r in want], rtol=tol, atol=tol)


def test_op11_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = queries.op11_whitening(spark, sf).collect()
    compare(got, brute(rows))
    assert len({r.identity_error for r in got}) == 1 and 0 < got[0].identity_error <= 1e-10


def test_one_sign_for_all_rows_and_unit_covariance(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(700, 20)) * np.geomspace(40, 0.2, 20)
    rows = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<float>, x int")
    got = whitening.whiten(rows.repartition(7)).collect()
    table = np.zeros((700, 16))
    for r in got:
        table[r.vec_id, r.component - 1] = r.whitened
    assert np.allclose(table.T @ table / 700, np.eye(16), atol=1e-9)
    assert np.allclose(table.mean(axis=0), 0, atol=1e-9)


ODD = [(1, [1.0, 2.0, 3.0]), (2, [1.0, 2.0, 3.0]), (2, [1.0, 2.0, 3.0]), (3, [0.5, -2.25, 8.0]), (4, [9.0, 1.0, -1.0]),
       (5, None), (6, []), (7, [1.0, None, 2.0]), (8, [float("nan"), 1.0, 2.0]), (9, [float("inf"), 1.0, 2.0]),
       (None, [4.0, 4.0, 4.5]), (10, [1.0, 2.0]), (11, [3.0, 5.0]), (12, [7.0]), (13, [1e300, 0.0, 0.0])]


def test_odd_rows(spark):
    rows = spark.createDataFrame([(i, e, 1, 2, 3, 4) for i, e in ODD],
                                 "vec_id long, embedding array<double>, x int, dim int, n int, component int")
    got = whitening.whiten(rows).collect()
    compare(got, brute(ODD))
    assert {r.vec_id for r in got} == {1, 2, 3, 4, None, 10, 11}


def test_empty_and_single(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, schema)).collect() == []


def test_huge_entries_keep_exact_deviations(spark):
    rows = [(i, [float(2**k), float(i), -float(2**(k // 2))]) for i, k in enumerate((3, 20, 28, 20, 5, 40, 54))]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    want = brute(rows)
    seen = Counter((r.vec_id, r.component, r.n, r.deviation) for r in got if r.component == 1)
    assert seen == Counter(w[:4] for w in want if w[1] == 1)
    assert any(r.deviation is None for r in got)


def test_tree_of_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(whitening, "TASK_ROWS", 4)
    monkeypatch.setattr(whitening, "FAN", 2)
    rng = np.random.default_rng(8)
    rows = [(i, (rng.normal(size=5) * 3).tolist()) for i in range(120)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    compare(got, brute(rows))
