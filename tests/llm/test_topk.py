import math
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from pitlane.llm import topk as K
from pitlane.llm.common import land


def plain(rows, every, k):
    ok = sorted({(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows
                 if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)})
    out = {}
    for q, w in ok:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(w, u)), i) for i, u in ok if i != q)
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def run(spark, rows, every=5, k=5, **kw):
    df = spark.createDataFrame([(i, v, "c", "c") for i, v in rows], "vec_id long, embedding array<float>, score string, rank string")
    found = land(K.sparse_rows(df, "vec_id", "embedding"), "vectors")
    got = {}
    for r in sorted(K.exact_top_k(found, found.where(f"vec_id % {every} = 0"), k, **kw).collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    return got


def test_matches_plain(spark):
    rng = random.Random(0)
    rows = [(i, [np.float32(rng.choice([0, rng.uniform(-1, 1)])).item() for _ in range(8)]) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 420)]  # a group of equal vectors: ties
    rows += [(420, None), (421, [None] * 8), (422, [float("nan")] * 8), (423, [float("inf")] * 8), (None, [1.0] * 8),
             (425, []), (430, [1.0, 2.0]), rows[0], (435, [0.0] * 8)]
    for blocks in ({}, {"query_block": 7, "candidate_block": 50}):
        assert run(spark, rows, **blocks) == plain(rows, 5, 5)


def test_few_candidates_and_none(spark):
    assert run(spark, [(0, [1.0]), (1, [2.0]), (2, [-1.0])]) == {0: [(1, 256 * 512), (2, -65536)]}
    assert run(spark, [(0, [1.0])]) == {}
    assert run(spark, []) == {}
    assert run(spark, [(1, [1.0]), (2, [1.0])]) == {}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(-5, 5), max_size=30), st.integers(1, 7))
def test_partition_selection(scores, k):
    s, ids = np.array(scores, np.int64), np.arange(len(scores))[::-1].copy()
    got = K.select_top(s, ids, k)
    want = sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i]))[:k]
    assert got.tolist() == want
