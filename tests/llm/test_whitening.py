"""Whitening: inertia, slices and components against numpy's dense solver, the
operator against a plain version of its contract, and odd inputs."""

import math

import numpy as np
import pytest

from tokenmill.llm import tables
from tokenmill.llm import whitening as W


def test_inertia_counts_signs():
    r = np.random.default_rng(0)
    for t in range(300):
        n = int(r.integers(1, 40))
        a = r.standard_normal((n, n))
        a = a + a.T
        a = np.round(a) if t % 3 == 0 else a
        a = a - np.diag(np.diag(a)) if t % 5 == 0 else a
        e = np.linalg.eigvalsh(a)
        if np.abs(e).min() > 1e-9:
            assert W.inertia(a) == ((e < 0).sum(), 0, (e > 0).sum())
    assert W.inertia(np.zeros((3, 3))) == (0, 3, 0)


def test_contour_is_a_projector():
    a = np.diag([1.0, 2, 3, 4, 5])
    p = sum(2 * (w * np.linalg.inv(z * np.eye(5) - a)).real for z, w in W.contour(1.5, 4.5, 16))
    assert np.allclose(p, np.diag([0, 1, 1, 1, 0]), atol=1e-5)


def spectra():
    r = np.random.default_rng(1)
    yield "spread", 10.0 ** r.uniform(-6, 3, 30)
    yield "flat", np.ones(20)
    yield "pairs", np.repeat([5.0, 4.0, 3.0, 2.0, 1.0], 4)
    yield "close", 1 + 1e-9 * np.arange(24)
    yield "low rank", np.concatenate([[9.0, 4.0, 1.0], np.zeros(17)])
    yield "small", np.array([3.0, 2.0])
    yield "one", np.array([7.0])
    yield "many", np.linspace(1, 2, 60)


@pytest.mark.parametrize("name, e", list(spectra()), ids=lambda x: x if isinstance(x, str) else "")
def test_no_component_is_missed(spark, name, e):
    tables.ready(spark)
    r = np.random.default_rng(2)
    q, _ = np.linalg.qr(r.standard_normal((len(e), len(e))))
    v = (q * e) @ q.T
    v = (v + v.T) / 2
    got, u = W.Spectrum(spark, v).largest(8)
    want = np.sort(e)[::-1][:8]
    assert len(got) == len(want) and np.allclose(got, want, rtol=1e-10, atol=1e-11 * want[0])
    assert np.allclose(u.T @ u, np.eye(len(got)), atol=1e-9)
    assert np.linalg.norm(v @ u - u * got) <= 1e-10 * want[0]


def plain(rows, k=8):
    """{(place of the row): values}: n, deviation, and per component whitened and explained."""
    ok = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in ok]
    n = len(x)
    s = [sum(c) for c in zip(*x)]
    y = [[n * c - t for c, t in zip(v, s)] for v in x]
    z = np.array(y, float) / n
    cov = z.T @ z / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    keep = e > 1e-10 * np.trace(cov)
    e, u = e[keep], u[:, keep]
    return [(i, n, sum(c * c for c in v), w, e / np.trace(cov)) for (i, _), v, w in zip(ok, y, z @ u / np.sqrt(e))]


def check(got, rows):
    want = plain(rows)
    k = len(want[0][3]) if want else 0
    assert len(got) == len(want) * k
    assert sorted({r.component for r in got}) == list(range(1, k + 1))
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.component), []).append(r)
    signs = None
    for i, n, deviation, w, explained in want:
        mine = [by[i, c][0] for c in range(1, k + 1)]
        assert all(r.n == n and r.deviation == deviation for r in mine)
        assert np.allclose([r.explained for r in mine], explained, rtol=1e-6)
        row = np.array([r.whitened for r in mine])
        if signs is None and np.abs(w).min() > 1e-3:
            signs = np.sign(row) * np.sign(w)
    for i, _, _, w, _ in want:
        row = np.array([by[i, c][0].whitened for c in range(1, k + 1)])
        assert np.allclose(row * signs, w, atol=1e-7)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error <= 1e-4
    values = np.array([[by[i, c][0].whitened for c in range(1, k + 1)] for i, *_ in want])
    assert np.abs(values.T @ values / len(values) - np.eye(k)).max() <= 1e-4


def test_whitening_equals_the_plain_version(spark):
    r = np.random.default_rng(3)
    mix = r.standard_normal((12, 12)) * (2.0 ** -np.arange(12))
    rows = [(k, (r.standard_normal(12) @ mix).tolist()) for k in range(300)]
    rows += [(1000, None), (1001, [None] + [0.5] * 11), (1002, [float("nan")] + [0.5] * 11), (1003, [float("inf")] * 12), (7, rows[7][1]), (1004, rows[5][1])]
    df = spark.createDataFrame([(i, v, 1, "x", 2.0) for i, v in rows], "vec_id long, embedding array<float>, n long, x string, w double")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    check(W.whiten(df).collect(), rows)


def test_odd_tables(spark):
    kind = "vec_id long, embedding array<double>"
    frame = lambda rows: spark.createDataFrame(rows, kind)
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [0.5]), (2, [0.5])], [(1, []), (2, [])]):
        assert W.whiten(frame(rows)).count() == 0
    got = W.whiten(frame([(1, [0.0]), (2, [1.0]), (None, [2.0])])).collect()
    assert len(got) == 3 and all(r.explained == 1 and r.component == 1 for r in got)
    assert sum(r.whitened for r in got) == pytest.approx(0) and sum(r.whitened ** 2 for r in got) == pytest.approx(3)
    # finite but huge, and of another length: no part
    rows = [(k, [float(k % 5), float(k % 3)]) for k in range(15)]
    assert W.whiten(frame(rows + [(99, [1e30, 1.0]), (98, [1.0, 2.0, 3.0])])).count() == W.whiten(frame(rows)).count() == 30
    # deviations beyond 64 bits are null, whitened values stay
    far = [(k, [1e9 * (k % 5), float(k % 3)]) for k in range(3000)]
    got = W.whiten(frame(far)).where("component = 1").collect()
    assert any(r.deviation is None for r in got) and all(abs(r.whitened) < 3 for r in got)
