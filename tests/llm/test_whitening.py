"""Spectral divide-and-conquer and whitening against numpy's eigensolver."""

from __future__ import annotations

import numpy as np
import pytest

from studylake.llm import qdwh, whitening

SCHEMA = "vec_id long, embedding array<float>, n int, component string"


def plain(vectors):
    x = np.floor(1024 * np.array(vectors, np.float32).astype(float)) + 100_000
    n, total = len(x), x.sum(axis=0)
    e, v = np.linalg.eigh(np.cov(x.T, bias=True).reshape(x.shape[1], -1))
    e, v = e[::-1], v[:, ::-1]
    return e, (x - total / n) @ v, [sum(int(n * a - s) ** 2 for a, s in zip(r, total)) for r in x]


@pytest.mark.parametrize("n", [1, 2, 5, 64, 130])
@pytest.mark.parametrize("kind", ["random", "geometric", "ties", "low rank", "identity"])
def test_leading_eigenpairs(n, kind):
    rng = np.random.default_rng(n)
    e = {"random": rng.standard_normal(n) * 10, "geometric": 10.0 ** -np.linspace(0, 12, n), "ties": np.repeat([3.0, 2, 1], -(-n // 3))[:n],
         "low rank": (np.arange(n) < 3) * 1.0, "identity": np.ones(n)}[kind]
    q, _ = np.linalg.qr(rng.standard_normal((n, n)))
    a = (q * e) @ q.T
    got, v = qdwh.leading(a, 8)
    size = np.abs(e).max()
    assert np.allclose(got, np.sort(e)[::-1][:8], atol=1e-13 * n * size)
    assert np.linalg.norm(a @ v - v * got) < 1e-12 * n * size and np.linalg.norm(v.T @ v - np.eye(v.shape[1])) < 1e-12 * n


def test_polar_factor():
    a = np.random.default_rng(3).standard_normal((20, 20))
    a = a + a.T
    e, v = np.linalg.eigh(a)
    assert np.allclose(qdwh.polar(a), (v * np.sign(e)) @ v.T, atol=1e-12)


def test_equals_eigensolver(spark):
    rng = np.random.default_rng(8)
    vectors = (rng.standard_normal((500, 24)) * np.linspace(1, 3, 24)).astype(np.float32).tolist()
    df = spark.createDataFrame([(i, v, 1, "c") for i, v in enumerate(vectors)], SCHEMA).repartition(7)
    e, z, deviation = plain(vectors)
    rows = whitening.whiten(df).collect()
    assert len(rows) == 500 * 8 and {r["n"] for r in rows} == {500} and len({r["identity_error"] for r in rows}) == 1
    got = np.zeros((500, 8))
    for r in rows:
        got[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert r["deviation"] == deviation[r["vec_id"]] and abs(r["explained"] - e[r["component"] - 1] / e.sum()) < 1e-12
    want = z[:, :8] / np.sqrt(e[:8])
    assert np.allclose(got * np.sign((got * want).sum(axis=0)), want, atol=1e-9)
    assert np.abs(np.cov(got.T, bias=True) - np.eye(8)).max() < 1e-9 and rows[0]["identity_error"] < 1e-9


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0, 0.5]), (2, [0.0, 1.0, 0.5]), (2, [0.0, 1.0, 0.5]), (None, [3.0, 1.0, 0.5]), (4, None), (5, [1.0, None, 0.5]),
            (6, [nan, 0.0, 0.5]), (7, [inf, 0.0, 0.5]), (8, []), (9, [1.0, 2.0]), (10, [3e38, 0.0, 0.5]), (11, [-0.5, -0.001, 0.5])]
    got = whitening.whiten(spark.createDataFrame([(*r, 3, "c") for r in rows], SCHEMA)).collect()
    three = [r for r in got if r["vec_id"] != 9]
    assert sorted(str(r["vec_id"]) for r in three if r["component"] == 1) == ["1", "11", "2", "2", "None"]
    assert {r["n"] for r in three} == {5} and {r["component"] for r in three} == {1, 2, 3}
    # the third dimension is constant: two components have variance, the third none
    assert all((r["whitened"] is None) == (r["component"] == 3) and (r["explained"] > 0) == (r["component"] < 3) for r in three)
    assert max(r["identity_error"] for r in three) < 1e-9
    one = [r for r in got if r["vec_id"] == 9]  # the only one of its length
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(1, 0, None, 0.0, 0.0)] * 2
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0


def test_deviation_is_exact_beyond_doubles():
    x = np.array([[1 << 40, 5], [-(1 << 40), 7]])
    assert whitening.deviations(x, 2, [0, 12]) == [v if v < 1 << 63 else None for v in ((2 * (1 << 40)) ** 2 + 4,) * 2]
    small = np.array([[100_003, 99_000], [100_001, 101_000]])
    assert whitening.deviations(small, 2, [200_004, 200_000]) == [4 + 2000**2, 4 + 2000**2]
