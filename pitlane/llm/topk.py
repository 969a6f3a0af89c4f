"""Exact top-k search by exhaustive term-at-a-time accumulation.

A vector is a sparse row: dimension (term) -> integer weight.  Candidates are
packed into blocks; a block holds one postings list per term.  Query rows, in
blocks too, are run against every candidate block: each query scatters
``query weight * posting weight`` into a dense score array, one term at a time,
a partition selection keeps the k best of the block, and a merge over blocks
keeps the k best of all.

Every row is scored against every query, so the work is queries x candidates;
a task holds one block of each, whatever the size of the tables.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCALE = 256
QUERY_BLOCK = 2048
CANDIDATE_BLOCK = 8192


def sparse_rows(df: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, weights): ``floor(scale * x)`` of each component, x as double.

    Left out: a null id, a null vector, and a vector with a null or non-finite
    component.  A repeated row (same id, same weights) counts once; rows that
    share an id but not a vector all stay.  An empty vector has no terms and
    scores 0 against everything.
    """
    x = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x")).where(
        F.col("vec_id").isNotNull() & F.col("x").isNotNull()
        & F.forall("x", lambda v: F.coalesce((F.abs(v) < float("inf")) & ~F.isnan(v), F.lit(False))))
    return rows.select("vec_id", F.transform("x", lambda v: F.floor(v * F.lit(float(scale)))).alias("weights")).distinct()


def _block_scores(postings: list[tuple[np.ndarray, np.ndarray]], query: np.ndarray, n: int) -> np.ndarray:
    """Dense scores of one query against a block: one scatter per non-zero term."""
    scores = np.zeros(n, np.int64)
    for term in np.flatnonzero(query[:len(postings)]):
        rows, weights = postings[term]
        scores[rows] += query[term] * weights
    return scores


def build_postings(vectors: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per term the rows that have it, ascending, and their weights."""
    width = max((len(v) for v in vectors), default=0)
    dense = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        dense[i, :len(v)] = v
    return [(rows := np.flatnonzero(dense[:, t]), np.ascontiguousarray(dense[rows, t])) for t in range(width)]


def select_top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best scores, ties to the smaller id, by partition selection."""
    if len(scores) > k:
        at_least = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= at_least)
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((ids[keep], -scores[keep]))][:k]


def _search_tile(candidates: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best of one candidate block for each query of one query block."""
    ids = candidates["vec_id"].to_numpy(np.int64)
    postings = build_postings(list(candidates["weights"]))
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for q, weights in zip(queries["vec_id"].to_numpy(np.int64), queries["weights"], strict=True):
        scores = _block_scores(postings, np.asarray(weights, np.int64), len(ids))
        others = np.flatnonzero(ids != q)
        best = others[select_top(scores[others], ids[others], k)]
        out.append((np.full(len(best), q), ids[best], scores[best]))
    cols = [np.concatenate(c) if out else np.empty(0, np.int64) for c in (zip(*out) if out else ((), (), ()))]
    return pd.DataFrame({"query_id": cols[0], "vec_id": cols[1], "score": cols[2]})


def exact_top_k(rows: DataFrame, queries: DataFrame, k: int = 5, query_block: int = QUERY_BLOCK,
                candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """The k best candidates of each query: (query_id, rank, vec_id, score).

    ``rows`` and ``queries`` have (vec_id, weights) as ``sparse_rows`` makes them.
    A row with the query's own id is no candidate of it.  Ties go to the smaller
    vec_id.  If an id repeats with other vectors, each such row is a candidate of
    its own, and as a query the id gets the k best over its rows.  With no queries
    or no candidates the result is empty; a query with fewer than k candidates
    gets all of them.
    """
    n_rows, n_queries = rows.count(), queries.count()
    c_blocks, q_blocks = max(1, -(-n_rows // candidate_block)), max(1, -(-n_queries // query_block))
    deal = lambda df, name, n: df.withColumn(name, F.pmod(F.xxhash64("vec_id", "weights"), F.lit(n)))
    # each block meets every block of the other side once: rows are copied per block, never per pair
    c = deal(rows, "c", c_blocks).withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
    q = deal(queries, "q", q_blocks).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1))))
    keyed = [F.col("c").cast("int").alias("c"), F.col("q").cast("int").alias("q"), "vec_id", "weights"]
    tiles = c.select(*keyed).groupBy("c", "q").cogroup(q.select(*keyed).groupBy("c", "q")).applyInPandas(
        lambda left, right: _search_tile(left, right, k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return tiles.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
