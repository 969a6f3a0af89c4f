import math

import numpy as np
import pyarrow as pa
import pytest

from pitlane.llm import pstable as P
from pitlane.llm.common import join_hot, land

SCHEMA = "vec_id long, embedding array<float>, n_links string, no long, kept string, key string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "a", None, "b", "c")
                                  for i, v in rows], SCHEMA)


def brute(rows, least=0.95):
    """Plain version over all pairs: {(id, row): (links, component)} in row order."""
    def usable(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)

    width = max((len(v) for _, v in rows if v), default=0)
    x = np.zeros((len(rows), width))
    for k, (_, v) in enumerate(rows):
        if usable(v):
            x[k, :len(v)] = np.array(v, np.float32)
    norm = np.linalg.norm(x, axis=1)
    near = (x / np.where(norm > 0, norm, 1)[:, None]) @ (x / np.where(norm > 0, norm, 1)[:, None]).T >= least
    np.fill_diagonal(near, False)
    out = []
    for k in range(len(rows)):
        seen, queue = {k}, [k]
        while queue:
            for j in np.flatnonzero(near[queue.pop()]):
                if j not in seen:
                    seen.add(int(j))
                    queue.append(int(j))
        low = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((rows[k][0], int(near[k].sum()), low, rows[k][0] == low))
    return sorted(out, key=repr)


def found(df, **kw):
    return sorted((tuple(r) for r in P.near_duplicates(df, **kw).collect()), key=repr)


def test_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(120, 24))
    rows = [(i, v) for i, v in enumerate(base)]
    rows += [(200 + i, base[i % 9] + rng.normal(size=24) * 0.1) for i in range(60)]  # near copies
    rows += [(300 + i, base[3]) for i in range(90)]  # a third of all rows are one vector
    rows += [(400, base[5] * 1000), (401, base[5] * 1e-30), (402, np.append(base[6], [0.0, 0.0])), (403, base[7][:23])]
    rows += [(500, None), (501, []), (502, [0.0] * 24), (503, [None] * 24), (504, [math.nan] * 24), (505, [math.inf] * 24),
             (None, base[8]), (None, base[8]), (None, rng.normal(size=24)), rows[0], (3, base[11])]
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    for p in (P.PStableParams(), P.PStableParams(tile_rows=16)):
        assert found(frame(spark, rows), p=p) == brute(rows)


def test_empty_and_alone(spark):
    assert found(frame(spark, [])) == []
    assert found(frame(spark, [(4, None)])) == [(4, 0, 4, True)]
    assert found(frame(spark, [(4, [1.0]), (2, [2.0]), (1, [-1.0])])) == [(1, 0, 1, True), (2, 1, 2, True), (4, 1, 2, False)]


def test_recall_at_the_threshold():
    """Pairs just above the threshold are missed no more often than stated."""
    rng, p = np.random.default_rng(5), P.PStableParams()
    for n in (100, 100_000):
        tables, hashes = P.pick_tables(n, p)
        of = P.Tables(32, tables, hashes, p)
        a = rng.normal(size=(3000, 32))
        a /= np.linalg.norm(a, axis=1)[:, None]
        b = rng.normal(size=a.shape)
        b -= (a * b).sum(axis=1)[:, None] * a
        b /= np.linalg.norm(b, axis=1)[:, None]
        near = p.least * a + math.sqrt(1 - p.least ** 2) * b
        missed = 1 - (of(a) == of(near)).any(axis=1).mean()
        assert missed <= 3 * p.miss
        far = (of(a) == of(b)).mean()
        assert far <= 4 / (p.spare * n)


def test_keys_do_not_depend_on_the_batch():
    x = P.unit_rows(pa.array(np.random.default_rng(0).normal(size=(1100, 17)).tolist()), 17)
    of = P.Tables(17, 9, 5, P.PStableParams())
    whole = of(x)
    assert all((of(x[a:b]) == whole[a:b]).all() for a, b in ((0, 1), (3, 700), (513, 1100)))


@pytest.mark.parametrize("n,pairs", [(4, []), (6, [(0, 5), (5, 2), (2, 4)]), (5, [(3, 4), (4, 1), (0, 2)])])
def test_roots(n, pairs):
    a, b = (np.array([p[k] for p in pairs], np.int64) for k in (0, 1))
    want = list(range(n))
    for _ in range(n):
        for i, j in pairs:
            want[i] = want[j] = min(want[i], want[j])
    assert P._roots(n, a, b).tolist() == want


def test_join_hot_splits_and_keeps_all_rows(spark):
    big = land(spark.range(3000).selectExpr("if(id % 3 = 0, 7, if(id % 100 = 1, NULL, id)) AS key", "id"), "test-big")
    small = land(spark.range(0, 3000, 2).selectExpr("id AS key", "-id AS other").union(
        spark.createDataFrame([(7, -7), (None, 1)], "key long, other long")), "test-small")
    got = sorted(map(tuple, join_hot(big, small, "key").collect()))
    assert got == sorted(map(tuple, big.join(small, "key").collect()))
    assert sum(r[0] == 7 for r in got) == 1001
