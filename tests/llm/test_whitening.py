"""Embedding whitening against the eigenvectors of the covariance, worked out in one piece."""

import math

import numpy as np
import pytest

from salescompass.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, deviation string, Whitened string, x int, both int"


def table(spark, vectors, parts=3):
    rows = [(i, v, "own", "own", i, -i) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def plain(vectors):
    """Steps, exact deviations, eigenvalues and projections of the usable vectors."""
    usable = {i: v for i, v in enumerate(vectors) if v and all(e is not None and math.isfinite(e) for e in v)}
    x = {i: [math.floor(256 * e) for e in v] for i, v in usable.items()}
    sizes = [len(v) for v in {tuple(v) for v in x.values()}]
    d = max(set(sizes), key=lambda s: (sizes.count(s), s))
    x = {i: v for i, v in x.items() if len(v) == d}
    fit = sorted({tuple(v) for v in x.values()})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    deviation = {i: sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True)) for i, v in x.items()}
    centred = lambda v: np.array([n * a - s for a, s in zip(v, sums, strict=True)], float) / n
    cov = sum(np.outer(centred(v), centred(v)) for v in fit) / n
    values, vectors = np.linalg.eigh(cov)
    return n, deviation, values[::-1], {i: centred(v) @ vectors[:, ::-1] for i, v in x.items()}, cov


def check(rows, vectors, components):
    n, deviation, values, projected, cov = plain(vectors)
    assert sorted({r["vec_id"] for r in rows}) == sorted(deviation) and len(rows) == components * len(deviation)
    for k in range(components):
        mine = {r["vec_id"]: r for r in rows if r["component"] == k + 1}
        got = np.array([mine[i]["whitened"] for i in sorted(mine)])
        want = np.array([projected[i][k] for i in sorted(mine)]) / values[k] ** 0.5
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-7
        assert all(r["n"] == n and r["deviation"] == deviation[i] for i, r in mine.items())
        assert all(abs(r["explained"] * cov.trace() / values[k] - 1) < 1e-9 and r["identity_error"] < 1e-9 for r in mine.values())


def awkward_vectors():
    rng = np.random.default_rng(2)
    good = (rng.normal(size=(60, 6)) * [9, 5, 3, 1, 0.5, 0.2]).tolist()
    return [
        *good, good[0], good[0], [e + 1e-9 for e in good[1]], None, [], [None] * 6, [*good[2][:5], None], [math.nan] * 6,
        [*good[3][:5], math.inf], [*good[3][:5], -math.inf], [1.0, 2.0], [0.0] * 6, [-0.0] * 6,
    ]


def test_awkward_vectors(spark):
    vectors = awkward_vectors()
    check(whitening.components_of(table(spark, vectors)).collect(), vectors, 4)


def test_own_columns_stay(spark):
    df = table(spark, awkward_vectors())
    fit = whitening.distinct_steps(df)
    out = whitening.whitened(df, whitening.fit_whitening(fit))
    assert out.columns == ["vec_id", "embedding", "x", "both", "deviation", "whitened"]
    assert all((r["x"], r["both"]) == (r["vec_id"], -r["vec_id"]) and len(r["whitened"]) == 4 for r in out.collect())


def test_fewer_components_than_dimensions(spark):
    """A constant dimension, one that repeats another, and one that is the sum of two: three directions are left."""
    rng = np.random.default_rng(3)
    a = np.floor(rng.normal(size=(50, 3)) * 900) / 256
    vectors = np.hstack([a, a[:, :1], np.full((50, 1), 2.0), a[:, 1:2] + a[:, 2:]]).tolist()
    check(whitening.components_of(table(spark, vectors)).collect(), vectors, 3)


def test_badly_conditioned_columns(spark):
    rng = np.random.default_rng(4)
    q = np.linalg.qr(rng.normal(size=(5, 5)))[0]
    vectors = (rng.normal(size=(300, 5)) * [1e6, 1e4, 1e2, 1, 0.1] @ q).tolist()
    df = table(spark, vectors)
    fit = whitening.distinct_steps(df)
    model = whitening.fit_whitening(fit)
    x = np.floor(np.array(vectors) * 256)
    singular = np.linalg.svd(x - x.mean(axis=0), compute_uv=False)
    assert np.allclose(model.eigenvalues, singular**2 / 300, rtol=1e-6) and model.passes <= 5
    assert whitening.identity_error(fit, model, 5) < 1e-4


@pytest.mark.parametrize("vectors", [[], [None, []], [[1.0, 2.0]], [[1.0, 2.0]] * 3])
def test_nothing_varies(spark, vectors):
    df = table(spark, vectors)
    assert whitening.components_of(df).collect() == []
    out = whitening.whitened(df, whitening.fit_whitening(whitening.distinct_steps(df))).collect()
    assert [(int(r["deviation"]), r["whitened"]) for r in out] == [(0, [])] * len([v for v in vectors if v])


def test_whole_numbers_beyond_64_bits(spark):
    vectors = [[4e15, 1.0], [-1e15, 2.0], [5e15, -4.0], [6e15, 9.0], [1e300, 0.0]]
    df = table(spark, vectors[:4])
    n, deviation, *_ = plain(vectors[:4])
    out = whitening.whitened(df, whitening.fit_whitening(whitening.distinct_steps(df)))
    assert {r["vec_id"]: int(r["deviation"]) for r in out.collect()} == deviation and max(deviation.values()) > 2**63
    assert all(r["deviation"] is None for r in whitening.components_of(df).collect())
    assert whitening.components_of(table(spark, vectors)).count() > 0  # entries beyond 64 bits become the largest


def test_a_third_of_the_rows_is_one_vector(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(200, 4)).tolist()
    vectors += [vectors[7]] * 100
    check(whitening.components_of(table(spark, vectors, 5)).collect(), vectors, 4)


def test_pivoted_factors():
    rng = np.random.default_rng(6)
    a = rng.normal(size=(9, 3)) @ rng.normal(size=(3, 7))
    order, rows = whitening.pivoted_cholesky(a.T @ a, 1e-10)
    assert len(order) == 3 and np.allclose(rows.T @ rows, a.T @ a) and np.allclose(np.tril(rows[:, order], -1), 0)
    q = whitening.orthogonalised(a, [(order, np.triu(rows[:, order]))])
    assert np.allclose(q.T @ q, np.eye(3))
