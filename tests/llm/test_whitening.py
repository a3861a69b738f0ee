"""Whitening against plain integer sums and numpy's covariance."""

import math

import numpy as np
import pytest

from cohortlens.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, n int, whitened string"


def brute(rows, k=4):
    """{(vec_id, component, occurrence): values} by definition, a fit for each length."""
    keep = [(i, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v in rows
            if v is not None and all(x is not None and math.isfinite(np.float32(x)) for x in v)]
    out = []
    for d in {len(x) for _, x in keep}:
        fit = np.array(sorted({x for _, x in keep if len(x) == d}), np.int64).reshape(-1, d)
        n, s = len(fit), fit.sum(0)
        if not d:
            continue
        centred = fit - s / n
        v = centred.T @ centred / n
        e, q = np.linalg.eigh(v)
        order = [i for i in np.argsort(-e)[:k] if e[i] > W.TOL * np.trace(v)]
        w_fit = centred @ q[:, order] / np.sqrt(e[order])
        error = np.abs(np.cov(w_fit.T, bias=True).reshape(len(order), -1) - np.eye(len(order))).max(initial=0)
        for i, x in keep:
            if len(x) == d:
                deviation = min(sum((n * a - int(b)) ** 2 for a, b in zip(x, s)), (1 << 63) - 1)
                w = (np.array(x) - s / n) @ q[:, order] / np.sqrt(e[order])
                out += [(i, c + 1, n, deviation, abs(w[c]), e[order[c]] / np.trace(v), error) for c in range(len(order))]
    return sorted(out, key=str)


def run(spark, rows, **more):
    v = W.quantized(spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA))
    return W.whitened(v, W.fit(v), **more).collect()


def compare(got, want):
    got = sorted([(r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained, r.identity_error) for r in got], key=str)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    for g, w in zip(got, want):
        assert g[4:6] == pytest.approx(w[4:6], rel=1e-7, abs=1e-7)
        assert g[6] < 1e-6 and w[6] < 1e-6


@pytest.mark.parametrize("dims", [1, 3, 20])
def test_against_numpy(spark, dims):
    rng = np.random.default_rng(dims)
    rows = [(i, (rng.normal(size=dims) * (1 + np.arange(dims))).astype(np.float32).tolist()) for i in range(300)]
    rows += [(7, rows[3][1]), (None, rows[4][1]), (None, rows[4][1]), (900, [0.001] * dims), (901, None),
             (902, [float("nan")] + [0.0] * (dims - 1)), (903, [float("inf")] * dims), (904, [None] * dims), (905, [-0.0] * dims)]
    compare(run(spark, rows), brute(rows))


def test_scatter_is_exact():
    rng = np.random.default_rng(0)
    for x in (rng.integers(-300, 300, (5000, 7)), rng.integers(-1 << 63, 1 << 63, (200, 5), dtype=np.int64), np.full((3, 2), -1 << 63), np.zeros((1, 4), np.int64),
              np.column_stack([np.arange(70) << 40, np.full(70, 5), -(np.arange(70) << 20)])):
        s, ss = W.scatter(x)
        y = x.astype(object)
        assert s.tolist() == y.sum(0).tolist()
        assert ss.tolist() == (y.T @ y).tolist()


def test_limbs():
    for v in (0, -1, 1 << 170, -(1 << 170), 12345678901234567890):
        assert sum(x << (32 * i) for i, x in enumerate(W._limbs(v))) == v


def test_huge_values_and_lengths(spark):
    """Components at the ends of a long, several lengths in several passes, axes orthonormal."""
    rows = [(1, [3e38, -3e38]), (2, [-3e38, 3e38]), (3, [0.0, 1.0]), (4, [1.0]), (5, [2.0]), (6, []), (7, [5.0, 6.0, 7.0])]
    got = run(spark, rows, model_cells=3)
    assert {(r.vec_id, r.n) for r in got} == {(1, 3), (2, 3), (3, 3), (4, 2), (5, 2)}  # one vector of length 3: no variance
    assert {r.deviation for r in got if r.vec_id == 1} == {(1 << 63) - 1}
    one = {r.vec_id: r.whitened for r in got if r.vec_id in (4, 5)}
    assert one[4] == -one[5] and abs(one[4]) == pytest.approx(1.0)


def test_hot_vector_and_ties(spark):
    """A third of all rows repeat one vector; two dimensions with equal variance."""
    rows = [(i, [1.0, 1.0]) for i in range(500)] + [(i, [0.0, 0.0]) for i in range(500)] + [(1000, [1.0, 0.0]), (1001, [0.0, 1.0])]
    got = run(spark, rows)
    assert len(got) == 2 * len(rows) and {r.n for r in got} == {4}
    assert {round(r.explained, 9) for r in got} == {0.5} and {r.identity_error < 1e-9 for r in got} == {True}


def test_empty_and_single(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None)]) == []


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = W.op12_whitening(spark, folder).collect()
    assert len(got) == 4 * len(rows)
    compare(got, brute(rows))
    w = {}
    for r in got:
        w.setdefault(r.component, {})[r.vec_id] = r.whitened
    # one sign for all rows: the components are uncorrelated as they stand
    m = np.array([[w[c][i] for i in sorted(w[c])] for c in sorted(w)])
    if len({tuple(v) for _, v in rows}) == len(rows):
        assert np.abs(np.cov(m, bias=True) - np.eye(4)).max() < 1e-6
