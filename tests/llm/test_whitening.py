from __future__ import annotations

import math

import numpy as np
import pytest

from tidings.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema).repartition(3)


def brute(rows, k=8):
    """Per (vec_id, component): deviation, whitened up to its sign, explained."""
    fit = [(i, v) for i, v in rows if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * c) + 100000 for c in np.array(v, np.float32).astype(float).tolist()] for _, v in fit]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    centred = np.array([[float(n * c - s) / n for c, s in zip(row, sums)] for row in x])
    v = centred.T @ centred / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    return {
        (fit[r][0], c + 1): (n, sum((n * a - s) ** 2 for a, s in zip(x[r], sums)), centred[r] @ q[:, c] / math.sqrt(e[c]), e[c] / np.trace(v))
        for r in range(n) for c in range(min(k, len(e)))
    }


def test_report_against_eigh(spark):
    rng = np.random.default_rng(1)
    rows = [(k, [float(c) for c in rng.standard_normal(12) * (1 + np.arange(12))]) for k in range(300)]
    rows += [(400, None), (401, [1.0] * 11 + [None]), (402, [float("nan")] * 12), (403, [float("inf")] + [0.0] * 11), (404, []), (7, rows[7][1]), (None, rows[8][1])]
    got = whitening.report(table(spark, rows)).collect()
    want = brute(rows)
    assert {(r["vec_id"], r["component"]) for r in got} == set(want) and len(got) == 302 * 8
    signs = {}
    for r in got:
        n, deviation, whitened, explained = want[r["vec_id"], r["component"]]
        sign = signs.setdefault(r["component"], np.sign(r["whitened"] * whitened))
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert r["whitened"] == pytest.approx(sign * whitened, abs=1e-9)
        assert r["explained"] == pytest.approx(explained, rel=1e-10)
    assert len({r["identity_error"] for r in got}) == 1 and 0 <= got[0]["identity_error"] < 1e-9


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("n", [1, 2, 3, 5, 40])
def test_leading_against_eigh(n, seed):
    rng = np.random.default_rng(seed)
    a = rng.standard_normal((n + 3, n))
    for m in (a.T @ a, np.eye(n) * 3, np.diag(np.arange(n) // 2 + 1.0), np.ones((n, n)), 1e-9 * a.T @ a, np.zeros((n, n))):
        k = min(n, 6)
        values, vectors = whitening.leading(m, k)
        want = np.linalg.eigvalsh(m)[::-1][:k]
        size = np.abs(m).max() + 1e-300
        assert np.allclose(values, want, rtol=1e-12, atol=1e-12 * size)
        assert np.allclose(vectors @ vectors.T, np.eye(k), atol=1e-9)
        assert np.abs(m @ vectors.T - vectors.T * values).max() <= 1e-11 * size


def test_clusters_of_eigenvalues_give_orthonormal_vectors():
    rng = np.random.default_rng(5)
    q, _ = np.linalg.qr(rng.standard_normal((30, 30)))
    m = q @ np.diag([9.0] * 4 + [9 - 1e-9] * 4 + [1.0] * 22) @ q.T
    values, vectors = whitening.leading((m + m.T) / 2, 8)
    assert np.allclose(vectors @ vectors.T, np.eye(8), atol=1e-12) and np.allclose(values, [9] * 8, atol=1e-8)
    # They span what belongs to the cluster.
    assert np.allclose(np.linalg.norm(vectors @ q[:, :8], axis=1), 1, atol=1e-9)


def test_sturm_counts_against_eigenvalues():
    rng = np.random.default_rng(6)
    diag, off = rng.standard_normal(20), rng.standard_normal(19)
    off[4] = 0
    e = np.linalg.eigvalsh(np.diag(diag) + np.diag(off, 1) + np.diag(off, -1))
    x = np.concatenate((e - 1e-6, e + 1e-6, [-99, 99]))
    assert whitening.below(diag, off, x).tolist() == [(e < v).sum() for v in x]


def test_no_variance_and_empty_tables(spark):
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], [(1, None)], [(1, [])], [(1, [0.5, 2.0])], [(k, [0.5, 2.0]) for k in range(5)]):
        out = whitening.report(table(spark, rows))
        assert out.columns == columns and out.count() == 0
        assert [t for _, t in out.dtypes] == ["bigint", "int", "bigint", "bigint", "double", "double", "double"]
    line = [(k, [float(k), 2.0 * k, 1.0]) for k in range(9)]  # rank one
    assert {r["component"] for r in whitening.report(table(spark, line)).collect()} == {1}


def test_other_lengths_and_sizes_are_left_out(spark):
    rng = np.random.default_rng(2)
    rows = [(k, [float(c) for c in rng.standard_normal(4)]) for k in range(30)]
    odd = [(100, [1.0] * 5), (101, [1.0]), (102, [1e30, 0.0, 0.0, 0.0])]
    got = whitening.report(table(spark, rows + odd)).collect()
    assert {r["vec_id"] for r in got} == set(range(30)) and {r["component"] for r in got} == {1, 2, 3, 4}


def test_doubles_of_great_spread_stay_exact(spark):
    rows = [(k, [1e8 * (-1) ** k + k, float(k * k), 3.0 * k]) for k in range(40)]
    done = whitening.fit(table(spark, rows, "vec_id long, embedding array<double>"))
    x = np.array([[math.floor(1024 * c) for c in v] for _, v in rows], np.int64)
    sums = [int(s) + 40 * whitening.SHIFT for s in x.sum(axis=0)]
    assert done.sums == tuple(sums)
    want = [sum((40 * (int(c) + whitening.SHIFT) - s) ** 2 for c, s in zip(row, sums)) for row in x]
    assert done.deviations(x) == want and max(want) > 1 << 63


def test_transform_keeps_other_columns(spark):
    rows = table(spark, [(k, [float(k), float(k % 3)], f"t{k}", k) for k in range(12)], "vec_id long, embedding array<float>, dim string, n long")
    model = whitening.fit(rows)
    out = whitening.transform(rows, model)
    assert out.columns == ["vec_id", "dim", "n", "whitening"] and out.count() == 12
    assert {(r["vec_id"], r["dim"], r["n"]) for r in out.collect()} == {(k, f"t{k}", k) for k in range(12)}
    with pytest.raises(ValueError):
        whitening.transform(rows, model, name="dim")
