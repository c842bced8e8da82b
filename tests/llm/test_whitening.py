"""Chebyshev-filtered subspace iteration against dense eigenvectors."""

import numpy as np
import pytest

from martweave.llm import whitening as wh

SMALL = "/root/testdata/sf0.001"


class Dense:
    """A covariance held in memory."""

    def __init__(self, v):
        self.v, self.dim, self.passes = v, len(v), 0

    def times(self, block):
        self.passes += 1
        return self.v @ block


def spectra():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((4000, 64))
    low = rng.standard_normal((90, 5))
    full = rng.standard_normal((90, 16))
    return {
        "nearly flat": x.T @ x / 4000,
        "identity": np.eye(70),
        "decaying": np.diag(np.exp(-np.arange(120) / 4.0)),
        "rank 5": low @ low.T,
        "rank 16": full @ full.T,
        "equal leading": np.diag([5.0] * 20 + [1.0] * 60),
        "one giant": np.diag([1e8, *np.linspace(0.5, 1, 100)]),
        "small": np.diag([3.0, 2.0, 1.0]),
        "single": np.array([[4.0]]),
    }


@pytest.mark.parametrize("name", list(spectra()))
def test_leading_pairs(name):
    v = spectra()[name]
    values, vectors = wh.leading(Dense(v))
    true = np.linalg.eigvalsh(v)[::-1]
    rank = int((true > 1e-10 * true[0]).sum())
    assert len(values) == min(16, len(v), rank)
    assert np.abs(values - true[: len(values)]).max() <= 1e-13 * true[0]
    assert np.abs(values / true[: len(values)] - 1).max() <= 1e-6
    assert np.abs(v @ vectors - vectors * values).max() <= 1e-13 * true[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13


def test_no_variance():
    assert len(wh.leading(Dense(np.zeros((40, 40))))[0]) == 0


def expected(vectors):
    """n, S, whole numbers and dense whitening of plain lists."""
    x = np.array([[int(np.floor(64 * c)) + 1000000 for c in v] for v in vectors], object)
    fit = np.unique(x.astype(np.int64), axis=0)
    n, s = len(fit), [int(t) for t in fit.astype(object).sum(axis=0)]
    centred = lambda y: np.array([[(n * int(a) - t) / n for a, t in zip(r, s)] for r in y])
    values, turned = np.linalg.eigh(centred(fit).T @ centred(fit) / n)
    values, turned = values[::-1], turned[:, ::-1]
    white = centred(x) @ turned[:, :16] / np.sqrt(np.maximum(values[:16], 1e-300))
    return n, [sum((n * a - t) ** 2 for a, t in zip(r, s)) for r in x], white, values[:16] / values.sum()


def against(got, ids, vectors):
    n, deviations, white, explained = expected(vectors)
    rows = {(r.vec_id, r.component): r for r in got}
    components = max(c for _, c in rows)
    assert len(rows) == len(set(ids)) * components
    for i, d, w in zip(ids, deviations, white):
        mine = np.array([rows[i, k + 1].whitened for k in range(components)])
        assert np.abs(np.abs(mine) - np.abs(w[:components])).max() < 1e-8
        assert {rows[i, k + 1].deviation for k in range(components)} == {d}
    some = [rows[ids[0], k + 1] for k in range(components)]
    assert np.allclose([r.explained for r in some], explained[:components], rtol=1e-10)
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-10


def test_registered_query(spark):
    from martweave.llm.queries import QUERIES

    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    got = QUERIES["op12_whitening"](spark, SMALL).collect()
    against(got, [r.vec_id for r in table], [r.embedding for r in table])


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    sound = [(i, [float(x) for x in rng.standard_normal(6) * [9, 7, 5, 3, 2, 1]]) for i in range(40)]
    sound += [(40, sound[0][1]), (41, [0.0] * 6), (42, [-3.5] * 6)]
    bad = [(50, None), (51, []), (52, [1.0] * 5), (53, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (54, [float("nan")] * 6), (55, [float("inf")] + [0.0] * 5), (56, [1e300] + [0.0] * 5)]
    # a table with clashing columns, dealt over many tasks
    rows = spark.createDataFrame(sound + bad, "vec_id long, embedding array<double>").selectExpr("*", "'a' AS _x", "'b' AS n", "1 AS _doc").repartition(7)
    done = wh.whiten(rows)
    assert done.columns == ["vec_id", "embedding", "_x", "_doc", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    against(done.collect(), [i for i, _ in sound], [v for _, v in sound])
    twice = wh.whiten(spark.createDataFrame(sound[:20] * 2, "vec_id long, embedding array<double>"), carry=["vec_id"])
    assert twice.count() == 2 * 20 * 6


def test_without_variance_or_rows(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        done = wh.whiten(spark.createDataFrame(rows, schema), carry=["vec_id"])
        assert done.collect() == [] and done.columns[-1] == "identity_error"


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(1, [1e9, 0.0]), (2, [-1e9, 1.0]), (3, [0.0, 3.0])]
    done = wh.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), carry=["vec_id"]).collect()
    exact = dict(zip([1, 2, 3], expected([v for _, v in rows])[1]))
    assert all(r.deviation == (exact[r.vec_id] if exact[r.vec_id] < 2**62 else None) for r in done)
    assert {r.deviation is None for r in done} == {True, False}
