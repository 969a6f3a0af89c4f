import math

import numpy as np
import pytest

from pitlane.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, n long, whitened string, component string"


def frame(spark, vectors, first=0):
    """Vectors with extra columns whose names clash with those of the result."""
    return spark.createDataFrame([(first + i, v, None, "x", "y") for i, v in enumerate(vectors)], SCHEMA)


def symmetric(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))
    v = q @ np.diag(values) @ q.T
    return (v + v.T) / 2


@pytest.mark.parametrize("values", [
    [3.0], [1.0, 1.0], [5.0, 5, 1, 1, 0], [-1.0, 0, 1], [0.0] * 6, list(np.repeat([1.0, 2, 3, 4], 16)), [1e9, 1, 1e-9],
    list(np.random.default_rng(3).normal(size=64) ** 2), list(10.0 ** -np.arange(40))])
def test_components_match_eigh(values):
    v = symmetric(values)
    found, vectors = W.leading_components(v, 16)
    want = np.linalg.eigvalsh(v)[::-1][:16]
    size = max(1e-300, np.abs(v).max())
    assert len(found) == min(16, len(v)) and np.abs(found - want).max() <= 1e-13 * size * len(v)
    assert np.abs(v @ vectors - vectors * found).max() <= 1e-13 * size * len(v)
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-13


def test_polar_factor_has_the_signs_of_the_eigenvalues():
    v = symmetric([4.0, 1e-3, -2.0, -1e-6])
    u = W.polar_factor(v)
    assert np.abs(u @ u - np.eye(4)).max() < 1e-13 and abs(np.trace(u)) < 1e-12
    assert np.linalg.eigvalsh(u @ v).min() > 0


def brute(vectors, components=16):
    """Plain version: {id: (deviation, whitened by component)}, n, explained."""
    width = max(map(len, vectors), default=0)
    x = [tuple(math.floor(64 * c) + 1000000 for c in [*v, *[0.0] * (width - len(v))]) for v in vectors]
    fit = sorted(set(x))
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    mean = np.array([t / n for t in s])
    c = np.array(fit) - mean
    v = c.T @ c / n
    e, p = np.linalg.eigh(v)
    e, p = e[::-1][:components], p[:, ::-1][:, :components]
    return [sum((n * a - b) ** 2 for a, b in zip(r, s)) for r in x], (np.array(x) - mean) @ p / np.sqrt(e), n, e / np.trace(v)


def test_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    vectors = [[float(np.float32(c)) for c in r] for r in rng.normal(size=(300, 20)) * np.linspace(0.2, 2, 20)]
    vectors += [vectors[5]] * 60 + [vectors[7][:12]]  # copies, and a shorter one
    odd = [None, [None] * 20, [math.nan] * 20, [math.inf, *[0.0] * 19]]
    got = W.whiten(frame(spark, vectors).union(frame(spark, odd, 900)).union(frame(spark, vectors[:2])), components=6).toPandas()
    dev, white, n, explained = brute(vectors, 6)
    assert len(got) == (len(vectors) + 2) * 6 and (got.n == n).all() and got.vec_id.max() < 900
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-12
    once = got.drop_duplicates(["vec_id", "component"]).sort_values(["vec_id", "component"])
    assert (once.deviation.to_numpy().reshape(-1, 6) == np.array(dev)[:, None]).all()
    found = once.whitened.to_numpy().reshape(-1, 6)
    assert np.abs(found * np.sign((found * white).sum(axis=0)) - white).max() < 1e-10
    assert np.abs(once.explained.to_numpy()[:6] - explained).max() < 1e-14


def test_no_rows_no_spread_and_large_entries(spark):
    assert W.whiten(frame(spark, [])).count() == 0
    assert W.whiten(frame(spark, [None, []])).count() == 0
    assert W.whiten(frame(spark, [[1.0, 2.0]] * 5)).count() == 0
    one = W.whiten(frame(spark, [[0.0, 0.0], [1.0, 0.0], [2.0, 0.0]])).collect()
    assert [(r.component, r.n, r.explained) for r in one] == [(1, 3, 1.0)] * 3  # the second has no spread
    big = W.whiten(frame(spark, [[3e38, 0.0], [0.0, 1.0], [-3e38, 5.0]]), components=1).collect()
    assert len(big) == 3 and all(math.isfinite(r.whitened) for r in big)
    assert sorted(r.deviation is None for r in big) == [False, True, True]


def test_query_matches_brute_force(spark):
    import duckdb

    from pitlane.llm import queries
    from tests.conftest import SF001
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF001}/embeddings.parquet' ORDER BY vec_id").fetchall()
    got = queries.QUERIES["op11_qdwh_whitening"](spark, SF001).toPandas().sort_values(["vec_id", "component"])
    dev, white, n, explained = brute([list(map(float, v)) for _, v in rows])
    assert got.vec_id.tolist() == [i for i, _ in rows for _ in range(16)] and (got.n == n).all()
    assert got.deviation.tolist() == [d for d in dev for _ in range(16)]
    found = got.whitened.to_numpy().reshape(-1, 16)
    assert np.abs(found * np.sign((found * white).sum(axis=0)) - white).max() < 1e-9
    assert np.abs(got.explained.to_numpy()[:16] / explained - 1).max() < 1e-10 and got.identity_error.max() < 1e-10
