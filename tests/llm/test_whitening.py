import math

import numpy as np
import pytest

from textloom.llm import queries, whitening

SF = "/root/testdata/sf0.001"


def plain_version(vectors, components=16):
    """{row: (n, deviation, whitened without sign, explained)} with numpy's eigenvectors of the covariance."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]
    fit = np.array(sorted(set(map(tuple, x))))
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    centred = fit - np.array(sums) / n
    cov = centred.T @ centred / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:components], v[:, ::-1][:, :components]
    white = (np.array(x) - np.array(sums) / n) @ v / np.sqrt(e)
    return n, [sum((n * a - s) ** 2 for a, s in zip(r, sums)) for r in x], white, e / np.trace(cov)


@pytest.mark.parametrize("d", [1, 2, 3, 8, 40])
@pytest.mark.parametrize("kind", ["plain", "graded", "upwards", "equal", "split", "zero"])
def test_values_and_directions(d, kind):
    rng = np.random.default_rng(d)
    a = rng.normal(size=(d, d))
    if kind == "graded":
        a = a @ np.diag(10.0 ** -np.linspace(0, 7, d))
    elif kind == "upwards":
        a = np.diag(10.0 ** np.linspace(-5, 0, d)) @ a
    elif kind == "equal":
        a = np.linalg.qr(a)[0]
    elif kind == "split":
        a = np.diag(np.arange(1.0, d + 1))
    elif kind == "zero":
        a[:, d // 2] = a[:, 0]
    r = np.linalg.qr(a, mode="r")
    diagonal, above, w = whitening.bidiagonal(r)
    assert np.allclose(w.T @ w, np.eye(d), atol=1e-13)
    values = whitening.squared_values(diagonal, above)
    want = np.linalg.svd(a, compute_uv=False)
    assert np.allclose(np.sqrt(values), want, rtol=1e-9, atol=1e-13 * want[0])
    count = int((want > 1e-8 * want[0]).sum())
    v = w @ whitening.directions(diagonal, above, values, count)
    assert np.allclose(v.T @ v, np.eye(count), atol=1e-8)
    assert np.allclose(a.T @ (a @ v), v * values[:count], atol=1e-12 * values[0])


def test_relative_accuracy():
    """Small values of a bidiagonal matrix come out with all their digits."""
    diagonal, above = 10.0 ** -np.arange(8.0), np.full(7, 1e-9)
    values = whitening.squared_values(diagonal, above)
    product = 1.0
    for x in values:
        product *= x
    assert abs(product / float(np.prod(diagonal)) ** 2 - 1) < 1e-13


def check(got, vectors, components=16):
    n, deviation, white, explained = plain_version(vectors, components)
    found = [r for r in sorted(got, key=lambda r: r["vec_id"])]
    assert [r["n"] for r in found] == [n] * len(found) and [r["deviation"] for r in found] == deviation
    w = np.array([r["whitened"] for r in found])
    sign = np.sign((w * white).sum(axis=0))
    assert np.allclose(w * sign, white, atol=1e-7)
    assert np.allclose(found[0]["explained"], explained, rtol=1e-9) and found[0]["identity_error"] < 1e-9


def test_table(llm):
    rng = np.random.default_rng(1)
    vectors = (rng.normal(size=(500, 20)) @ rng.normal(size=(20, 20))).astype(np.float32).astype(float).tolist()
    vectors += vectors[:100] * 3
    rows = [(i, v, 1, "x") for i, v in enumerate(vectors)]
    df = llm.createDataFrame(rows, "vec_id bigint, embedding array<double>, n int, x string").repartition(7)
    got = whitening.whiten(df)
    assert got.columns == ["vec_id", "embedding", "x", *(f.name for f in whitening.RESULT)]
    check(got.collect(), vectors)


def test_odd_rows(llm):
    nan, inf = float("nan"), float("inf")
    sound = [(1, [1.0, 2.0, 0.5]), (2, [0.0, 2.5, 1.5]), (2, [0.0, 2.5, 1.5]), (None, [3.0, -1.0, 0.0]), (4, [1.0, 1.0, 1.0])]
    rows = [*sound, (5, None), (6, []), (7, [1.0, None, 2.0]), (8, [nan, 1.0, 1.0]), (9, [inf, 0.0, 0.0]), (10, [1.0, 2.0])]
    got = whitening.whiten(llm.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert sorted((r["vec_id"] or 0 for r in got)) == [0, 1, 2, 2, 4] and {r["n"] for r in got} == {4}
    n, deviation, white, _ = plain_version([v for _, v in sorted(sound, key=lambda r: r[0] or 0)], 3)
    found = sorted(got, key=lambda r: r["vec_id"] or 0)
    assert [r["deviation"] for r in found] == deviation
    assert np.allclose(np.abs([r["whitened"] for r in found]), np.abs(white), atol=1e-7)


def test_few_directions(llm):
    same = llm.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id bigint, embedding array<double>")
    assert [(r["n"], r["deviation"], r["whitened"]) for r in whitening.whiten(same).collect()] == [(1, 0, [])] * 2
    line = llm.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(5)], "vec_id bigint, embedding array<double>")
    got = whitening.whiten(line).collect()
    assert {len(r["whitened"]) for r in got} == {1} and got[0]["explained"] == [pytest.approx(1)]
    assert whitening.whiten(same.limit(0)).collect() == []


def test_wide_numbers(llm):
    """Deviations beyond 64 bits are null, and what fits is exact."""
    rows = [(0, [1e7, 0.0]), (1, [-1e7, 3.0]), (2, [0.5, 2.0])]
    model = whitening.Whitening(10**6, (0, 0), np.ones(0), np.zeros((2, 0)), 1.0)
    assert model.deviation(np.array([[10**13, 1], [3, 4]])) == [None, 25 * 10**12]
    got = whitening.whiten(llm.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert sorted(r["deviation"] for r in got) == sorted(plain_version([v for _, v in rows], 2)[1])


def test_query(llm):
    df = llm.read.parquet(f"{SF}/embeddings.parquet")
    rows = sorted((r["vec_id"], r["embedding"]) for r in df.collect())
    n, deviation, white, explained = plain_version([v for _, v in rows])
    got = sorted(map(tuple, queries.op13_whitening(llm, SF).collect()))
    assert [g[:4] for g in got] == [(i, c + 1, n, dev) for (i, _), dev in zip(rows, deviation) for c in range(16)]
    w = np.array([g[4] for g in got]).reshape(-1, 16)
    assert np.allclose(w * np.sign((w * white).sum(axis=0)), white, atol=1e-7)
    assert np.allclose([g[5] for g in got[:16]], explained, rtol=1e-9) and max(g[6] for g in got) < 1e-9
