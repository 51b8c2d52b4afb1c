"""Whitening against the eigenvectors of the covariance made whole."""

import math

import numpy as np
import pytest

from gradmesh.llm import whitening as W

SCHEMA = "vec_id bigint, embedding array<float>, n int"


def brute(vectors, p=8):
    """Components, and per vector the deviation and the whitened values (up to sign)."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    off = [[n * c - s for c, s in zip(row, sums, strict=True)] for row in x]
    centred = np.array(off, float) / n
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1][:p], u[:, ::-1][:, :p]
    return n, [sum(d * d for d in row) for row in off], centred @ u / np.sqrt(e), e / np.trace(centred.T @ centred / n)


@pytest.mark.parametrize("k", [64, 5])
def test_equals_brute_force(spark, k):
    rng = np.random.default_rng(2)
    vectors = (rng.standard_normal((400, k)) * np.linspace(3, 1, k)).astype(np.float32).tolist()
    vectors += [vectors[0]] * 150  # a hot vector, and repeated ids
    rows = [(None if i == 7 else i % 500, v, 1) for i, v in enumerate(vectors)]
    dropped = [(900, None, 1), (901, [None] + [1.0] * (k - 1), 1), (902, [math.nan] * k, 1), (903, [math.inf] * k, 1), (904, [1.0] * (k + 1), 1), (905, [], 1)]
    got = W.whitened(spark.createDataFrame(rows + dropped, SCHEMA).repartition(6)).collect()
    n, deviation, whitened, explained = brute(vectors)
    p = min(8, k)
    assert len(got) == len(vectors) * p and not {r["vec_id"] for r in got} & {900, 901, 902, 903, 904, 905}
    assert {r["n"] for r in got} == {n} and len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-10
    sign = {}
    for r in got:
        if r["vec_id"] is None:
            continue
        i, c = r["vec_id"], r["component"] - 1
        assert r["explained"] == pytest.approx(explained[c], rel=1e-10)
        same = [j for j in range(len(vectors)) if rows[j][0] == i]
        if len(same) == 1:
            j = same[0]
            assert r["deviation"] == deviation[j]
            sign.setdefault(c, np.sign(whitened[j, c] * r["whitened"]))
            assert r["whitened"] * sign[c] == pytest.approx(whitened[j, c], abs=1e-8)


def test_residuals_reach_double_precision():
    rng = np.random.default_rng(3)
    a = rng.standard_normal((900, 300)) * np.linspace(2, 1, 300)
    v, passes = a.T @ a / 900, []

    def product(block):
        passes.append(block.shape[1])
        return v @ block

    e, u, residuals = W.jacobi_davidson(product, 300, 8)
    want, vecs = np.linalg.eigh(v)
    assert np.abs(e / want[::-1][:8] - 1).max() < 1e-13 and residuals.max() < 1e-13 * e[0]
    assert np.abs(np.abs((u * vecs[:, ::-1][:, :8]).sum(axis=0)) - 1).max() < 1e-12
    assert len(passes) < 200


def test_equal_and_close_values():
    q, _ = np.linalg.qr(np.random.default_rng(4).standard_normal((60, 60)))
    d = np.array([5.0] * 3 + [4.0, 4.0 - 1e-9] + [1.0] * 30 + [0.0] * 25)
    v = q * d @ q.T
    e, u, residuals = W.jacobi_davidson(lambda b: v @ b, 60, 8)
    assert np.allclose(e, d[:8], rtol=1e-12) and residuals.max() < 1e-12 and np.abs(u.T @ u - np.eye(8)).max() < 1e-13


def test_minres_solves_shifted_systems_in_step():
    rng = np.random.default_rng(5)
    a = rng.standard_normal((30, 30))
    a, b, shift = a + a.T, rng.standard_normal((30, 3)), np.array([0.0, 1.5, -2.0])
    x = W.minres(lambda t: a @ t - t * shift, b, 60)
    assert np.allclose(a @ x - x * shift, b, atol=1e-6)


def test_few_and_equal_vectors(spark):
    frame = lambda rows: W.whitened(spark.createDataFrame([(i, v, 0) for i, v in enumerate(rows)], SCHEMA)).collect()
    assert frame([]) == [] and frame([[1.0, 2.0]]) == [] and frame([[1.0, 2.0]] * 9) == []
    line = frame([[float(k), 2.0 * k, 0.0] for k in range(10)])  # one direction varies
    assert {r["component"] for r in line} == {1} and line[0]["explained"] == pytest.approx(1.0)


def test_large_entries_and_deviations(spark):
    got = W.whitened(spark.createDataFrame([(0, [3e38, 0.0], 0), (1, [-3e38, 1.0], 0), (2, [0.0, 5.0], 0)], SCHEMA)).collect()
    assert {r["deviation"] for r in got if r["vec_id"] < 2} == {None} and all(math.isfinite(r["whitened"]) for r in got)
    big = np.array([[1 << 31, 5], [0, 7]], np.int64) + 100_000
    facts = W.Vectors(None, 2, 2, big.sum(axis=0) // 2, (big.sum(axis=0) % 2).tolist())
    assert W._deviations(facts, big) == [2**62 + 4] * 2  # beyond the quick bound, within 64 bits
