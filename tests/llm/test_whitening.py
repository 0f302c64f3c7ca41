from fractions import Fraction

import numpy as np
import pytest

from ledgerline.llm import whitening as W
from ledgerline.llm.queries import op11_embedding_whitening


def brute(x):
    """From the covariance and its eigenvectors: (whitened for all components, shares)."""
    centred = x - x.mean(0)
    e, v = np.linalg.eigh(centred.T @ centred / len(x))
    e, v = e[::-1], v[:, ::-1]
    return centred @ v / np.sqrt(e), e / e.sum()


def integers(vectors):
    return np.floor(np.array(vectors, float) * 1024).astype(np.int64) + 100_000


def test_query_equals_eigenvectors(spark, sf_dir):
    own = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    x = integers([r.embedding for r in own])
    white, share = brute(x)
    sums, n = x.sum(0), len(x)
    rows = {(r.vec_id, r.component): r for r in op11_embedding_whitening(spark, sf_dir).collect()}
    assert len(rows) == 8 * n and {c for _, c in rows} == set(range(1, 9))
    got = np.array([[rows[r.vec_id, c].whitened for c in range(1, 9)] for r in own])
    sign = np.sign((got * white[:, :8]).sum(0))
    assert np.abs(got * sign - white[:, :8]).max() < 1e-9
    for i, r in enumerate(own):
        assert rows[r.vec_id, 1].deviation == sum(int(n * v - s) ** 2 for v, s in zip(x[i].tolist(), sums.tolist()))
    first = rows[own[0].vec_id, 1]
    assert first.n == n and first.identity_error < 1e-9 and len({r.identity_error for r in rows.values()}) == 1
    for c in range(8):
        assert rows[own[0].vec_id, c + 1].explained == pytest.approx(share[c], rel=1e-9)


@pytest.mark.parametrize("shape", [(1, 1), (3, 2), (5, 5), (40, 7), (300, 64)])
def test_rotations_equal_a_singular_value_decomposition(shape):
    r = np.linalg.qr(np.random.default_rng(shape[0]).normal(size=shape), mode="r")
    components, norms = W.rotated(r)
    assert np.allclose(norms[: min(shape)], np.linalg.svd(r, compute_uv=False)[: min(shape)], rtol=1e-12)
    assert np.abs(components.T @ components - np.eye(shape[1])).max() < 1e-12
    gram = (r @ components).T @ (r @ components)
    assert np.abs(gram - np.diag(np.diag(gram))).max() < 1e-12 * max(1, gram.max())


def test_small_deviations_keep_their_digits():
    """Standard deviations of 1 and 1e-9: their squares would be lost in a covariance matrix."""
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.normal(size=(500, 6)))[0]
    turn = np.linalg.qr(rng.normal(size=(6, 6)))[0]
    true = np.array([1, 0.5, 1e-3, 1e-6, 1e-8, 1e-9])
    _, norms = W.rotated(np.linalg.qr(q * true @ turn.T, mode="r"))
    assert np.allclose(norms, true, rtol=1e-6)


def frame(spark, vectors, parts=3):
    rows = [(i, v, "a", 1.5) for i, v in vectors]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, `whitened` string, `a.b` double").repartition(parts)


def test_edges(spark):
    rng = np.random.default_rng(1)
    good = [(i, rng.normal(size=3).round(3).tolist()) for i in range(30)]
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [1.0, float("nan"), 0.0]), (104, [float("inf"), 0.0, 0.0]), (105, [1.0, 2.0])]
    same = [(None, good[0][1]), (7, good[7][1]), (7, good[7][1])]
    rows = W.digest(frame(spark, good + odd + same)).collect()
    assert len(rows) == 3 * 33 and {r.n for r in rows} == {33}
    x = integers(np.array([v for _, v in good + same], np.float32))
    white, _ = brute(x)
    by = sorted((tuple(abs(r.whitened) for r in sorted(rows, key=lambda r: r.component) if r.vec_id == 3), ))
    assert np.allclose(by[0], np.abs(white[3]), atol=1e-9)
    assert sum(r.vec_id is None for r in rows) == 3 and sum(r.vec_id == 7 for r in rows) == 9
    assert {r.vec_id for r in rows if r.vec_id is not None} == set(range(30))


def test_results_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(2)
    vectors = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(400, 5)) * [5, 4, 3, 2, 1])]
    told = lambda parts: {(r.vec_id, r.component): (r.deviation, abs(r.whitened)) for r in W.digest(frame(spark, vectors, parts)).collect()}
    one, many = told(1), told(40)
    assert all(one[k][0] == many[k][0] and one[k][1] == pytest.approx(many[k][1], abs=1e-9) for k in one) and len(one) == len(many) == 2000


@pytest.mark.parametrize("vectors", [[[1.0, 2.0]], [[1.0, 2.0]] * 4])
def test_no_variance(spark, vectors):
    rows = W.digest(frame(spark, list(enumerate(vectors)))).collect()
    assert len(rows) == 2 * len(vectors)
    assert all(r.whitened is None and r.explained is None and r.identity_error is None and r.deviation == 0 for r in rows)


def test_a_flat_dimension_and_very_large_entries(spark):
    rows = W.digest(frame(spark, [(i, [float(i), 1.0, float(-i)]) for i in range(5)])).collect()
    assert {(r.component, r.whitened is None) for r in rows} == {(1, False), (2, True), (3, True)}
    assert rows[0].identity_error < 1e-9
    huge = {r.vec_id: r for r in W.digest(frame(spark, [(0, [3e38, 0.0]), (1, [-3e38, 0.0]), (2, [1.0, 1.0])])).collect() if r.component == 1}
    assert huge[0].deviation is None and np.isfinite(huge[2].whitened)


def test_exact_deviations_beyond_quick_arithmetic():
    model = W.Model(10**6, [10**11 + 5, 3 * 10**10], np.eye(2), np.ones(2))
    x = np.array([[103_000, 28_900], [10**9, 0]])
    exact = [sum((10**6 * int(v) - s) ** 2 for v, s in zip(row, model.sums)) for row in x]
    assert model.deviation(x) == [v if v < 2**63 else None for v in exact] and model.deviation(x)[1] is None
    assert model.centred(x)[0, 0] == float(Fraction(103_000) - Fraction(10**11 + 5, 10**6))


def test_empty_table(spark):
    assert W.digest(frame(spark, [])).collect() == []
