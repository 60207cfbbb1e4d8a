"""Secular updates against dense eigensolvers; the operator against a brute-force whitening with exact integers."""

import math

import numpy as np
import pytest

from starmart.llm import whitening
from starmart.llm.whitening import Spectrum, rank_one, secular_roots, whiten

SCHEMA = "vec_id long, embedding array<float>, label int"


def test_secular_roots_are_the_eigenvalues():
    r = np.random.default_rng(1)
    for k in (1, 2, 7, 40):
        d, z = np.sort(r.normal(size=k)) * 10.0 ** r.integers(-4, 5), r.normal(size=k)
        z = np.where(np.abs(z) < 1e-3, 1e-3, z)
        roots, apart = secular_roots(d, z, 0.7)
        want = np.linalg.eigvalsh(np.diag(d) + 0.7 * np.outer(z, z))
        assert np.allclose(roots, want, rtol=1e-12, atol=1e-12 * np.abs(want).max())
        assert (np.sign(apart) == np.where(np.arange(k)[None, :] <= np.arange(k)[:, None], -1, 1)).all()


@pytest.mark.parametrize("case", ["plain", "equal values", "zero coordinates", "new direction", "wide range"])
def test_rank_one_update(case):
    r = np.random.default_rng(2)
    basis, values = np.linalg.qr(r.normal(size=(12, 12)))[0], np.sort(r.random(12))
    v = r.normal(size=12)
    if case == "equal values":
        values = np.repeat([0.0, 1.0, 1.0, 5.0], 3)
    if case == "zero coordinates":
        v = basis[:, :4] @ r.normal(size=4)
    if case == "new direction":
        basis, values = basis[:, :5], values[:5]
    if case == "wide range":
        values = 10.0 ** np.linspace(-12, 6, 12)
    got, turned = rank_one(values, basis, v, 2.0)
    want = basis @ np.diag(values) @ basis.T + 2.0 * np.outer(v, v)
    assert np.abs(turned.T @ turned - np.eye(len(got))).max() < 1e-13
    assert np.abs(turned @ np.diag(got) @ turned.T - want).max() < 1e-13 * np.abs(want).max() * 12


def test_merged_spectra_are_the_spectrum_of_all():
    x = np.random.default_rng(3).normal(size=(500, 9)) * 10.0 ** np.arange(-2, 7)
    a, b = Spectrum.empty(9), Spectrum.empty(9)
    for row in x[:180]:
        a.add(row)
    for row in x[180:]:
        b.add(row)
    a.merge(b)
    y = x - x.mean(0)
    want = y.T @ y
    assert a.n == 500 and np.allclose(a.mean, x.mean(0))
    assert np.abs(a.basis @ np.diag(a.values) @ a.basis.T - want).max() < 1e-10 * np.abs(want).max()


def brute(rows, top=32):
    """Exact sums and deviations by Python integers, components by a dense solver."""
    kept = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in e]) for i, e in rows]
    n, size = len(kept), len(kept[0][1])
    s = [sum(x[j] for _, x in kept) for j in range(size)]
    y = np.array([[(n * x[j] - s[j]) / n for j in range(size)] for _, x in kept])
    e, q = np.linalg.eigh(y.T @ y / n)
    e, q = e[::-1], q[:, ::-1]
    dev = [sum((n * x[j] - s[j]) ** 2 for j in range(size)) for _, x in kept]
    return n, dev, y @ q[:, :top] / np.sqrt(e[:top]), e[:top] / e.sum()


def test_against_brute_force(spark):
    r = np.random.default_rng(4)
    x = (r.normal(size=(700, 40)) @ r.normal(size=(40, 40))).astype(np.float32)
    x[100:300] = x[7]  # one vector many times
    rows = [(i, x[i].tolist(), 0) for i in range(len(x))]
    bad = [(900, None, 1), (901, [None] + x[0].tolist()[1:], 1), (902, [float("nan")] * 40, 1), (903, [float("inf")] * 40, 1),
           (904, [], 1), (905, [1.0], 1), (906, [3e38] * 40, 1)]
    extra = [(None, x[3].tolist(), 1), (5, x[5].tolist(), 1)]  # no id, a repeated row
    df = spark.createDataFrame(rows + bad + extra, SCHEMA).repartition(7).selectExpr("*", "1 AS component", "2 AS x", "3 AS n")
    got = whiten(df).toPandas()
    n, dev, want, explained = brute([(i, e) for i, e, _ in rows + extra])
    assert len(got) == n * 32 and set(got.n) == {n} and got.identity_error.max() < 1e-8
    assert got.deviation_wide.isna().all()
    at = {i: k for k, (i, *_) in enumerate(rows)}
    one = got[got.vec_id.notna()].drop_duplicates(["vec_id", "component"]).sort_values(["vec_id", "component"])
    assert set(one.vec_id) == set(at)
    assert one.groupby("vec_id").deviation.first().tolist() == dev[: len(rows)]
    y = one.whitened.to_numpy().reshape(-1, 32)
    sign = np.sign((y * want[: len(rows)]).sum(0))
    assert np.abs(y * sign - want[: len(rows)]).max() < 1e-8
    assert np.allclose(one.explained.to_numpy().reshape(-1, 32)[0], explained, rtol=1e-9)
    assert len(got[got.vec_id == 5]) == 64 and got.vec_id.isna().sum() == 32


def test_deviations_beyond_64_bits(spark):
    left = [3, 0, 10**12 - 1]
    x = np.array([[2**52, 5, -(2**52)], [1, 2, 3]], np.int64)
    n, whole = 10**12, [0, 1, 2]
    want = [sum((n * int(x[i, j]) - (whole[j] * n + left[j])) ** 2 for j in range(3)) for i in range(2)]
    assert whitening.deviations(x, whole, left, n) == want and want[0] > 1 << 63
    big = spark.createDataFrame([(1, [2.0**46], 0), (2, [-(2.0**46)], 0), (3, [0.0], 0)], "vec_id long, embedding array<double>, label int")
    rows = {r["vec_id"]: r for r in whiten(big).collect()}
    assert rows[1]["deviation"] is None and int(rows[1]["deviation_wide"]) == (3 * 2**52) ** 2
    assert rows[3]["deviation"] == 0 and rows[3]["deviation_wide"] is None


def test_empty_constant_and_single(spark):
    assert whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whiten(spark.createDataFrame([(1, None, 0)], SCHEMA)).count() == 0
    same = whiten(spark.createDataFrame([(i, [1.0, 2.0], 0) for i in range(5)], SCHEMA)).collect()
    assert len(same) == 10 and all(r["whitened"] is None and r["explained"] == 0 and r["deviation"] == 0 for r in same)
    line = whiten(spark.createDataFrame([(i, [float(i), 0.0], 0) for i in range(5)], SCHEMA)).collect()
    assert {r["component"] for r in line if r["whitened"] is not None} == {1}
