"""Embedding whitening by QDWH spectral divide and conquer.

Vectors become integers, so counts and sums are exact.  The covariance is summed
in Spark from centred rows, one partial matrix per partition, added up row by row.
Its eigenvectors come from recursive splits: the polar factor U of ``A - shift I``
(QDWH: dynamically weighted Halley steps) has the signs of the shifted eigenvalues,
so ``(U + I) / 2`` projects on the eigenvectors above the shift.  Bases of both
ranges carry A to two smaller problems, down to single components.  The matrix is
dimensions squared, whatever the number of rows; the few components that are asked
for are broadcast, and every row is projected where it lies.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.llm.common import finite, land

EPS = float(np.finfo(np.float64).eps)
#: Integers are held to this size, so that n * x fits a long for up to 2^31 rows.
MOST = (1 << 31) - 1


# -- spectral divide and conquer -------------------------------------------------------------------


def polar_factor(a: np.ndarray, steps: int = 30) -> np.ndarray:
    """The orthogonal polar factor of a symmetric ``a`` without eigenvalues at 0."""
    m = len(a)
    x = a / np.linalg.norm(a)
    low = EPS  # a lower bound of the smallest singular value; too low costs steps, not accuracy
    for _ in range(steps):
        s = low * low
        d = np.cbrt(4 * (1 - s) / (s * s)) if s < 1 else 0.0
        r = math.sqrt(1 + d)
        wa = r + math.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - s) / (s * r))) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:  # far from orthogonal: by QR, which stays accurate
            q, _ = np.linalg.qr(np.concatenate([math.sqrt(wc) * x, np.eye(m)]))
            new = wb / wc * x + (wa - wb / wc) / math.sqrt(wc) * (q[:m] @ q[m:].T)
        else:
            new = wb / wc * x + (wa - wb / wc) * np.linalg.solve(np.eye(m) + wc * (x.T @ x), x.T).T
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x, low = new, min(1.0, low * (wa + wb * s) / (1 + wc * s))
        if moved <= math.sqrt(m) * 1e-14 or (low >= 1 - 10 * EPS and moved <= EPS ** (1 / 3)):
            break
    return x


def _range(projector: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """An orthonormal basis of the range of a projector of rank k."""
    q = rng.normal(size=(len(projector), k))
    for _ in range(3):
        q, _ = np.linalg.qr(projector @ q)
    return q


def split(a: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the invariant subspaces above and below the mean eigenvalue; None if all are equal.

    The mean lies between the extremes, so neither side is empty.  If an eigenvalue
    meets the shift, the polar factor is none, and the shift moves a little.
    """
    m = len(a)
    mean = np.trace(a) / m
    spread = np.linalg.norm(a - mean * np.eye(m)) / math.sqrt(m)
    size = np.linalg.norm(a)
    if spread <= 4 * EPS * size:
        return None
    best: tuple[float, np.ndarray, np.ndarray] | None = None
    for nudge in (0.0, 0.03, -0.05, 0.11, -0.17, 0.29, -0.37, 0.47):
        u = polar_factor(a - (mean + nudge * spread) * np.eye(m))
        upper = (u + np.eye(m)) / 2
        k = round(float(np.trace(upper)))
        if not 0 < k < m:
            continue
        v = _range(upper, k, rng)
        w = _range(np.eye(m) - upper, m - k, rng)
        whole, _ = np.linalg.qr(np.concatenate([v, w], axis=1))
        v, w = whole[:, :k], whole[:, k:]
        off = float(np.linalg.norm(w.T @ a @ v))
        if best is None or off < best[0]:
            best = off, v, w
        if off <= 8 * m * EPS * size:
            break
    return None if best is None else best[1:]


def leading_components(v: np.ndarray, want: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``want`` largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors in columns.

    A side is only split on while it may hold one of them.  The entry of the largest
    size of each vector is positive.
    """
    rng = np.random.default_rng(0)
    found: list[np.ndarray] = []
    stack = [(v, np.eye(len(v)))]
    while stack and len(found) < want:
        a, basis = stack.pop()
        parts = split(a, rng) if len(a) > 1 else None
        if parts is None:
            found.extend(basis.T)  # one component, or a space of equal eigenvalues
            continue
        for side in reversed(parts):  # the upper side comes off the stack first
            inner = side.T @ a @ side
            stack.append(((inner + inner.T) / 2, basis @ side))
    if not found:
        return np.empty(0), np.empty((len(v), 0))
    vectors, _ = np.linalg.qr(np.stack(found[:max(want, 1)], axis=1))
    values = np.einsum("ij,ij->j", vectors, v @ vectors)
    order = np.argsort(-values, kind="stable")[:want]
    vectors = vectors[:, order]
    top = vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))]
    return values[order], vectors * np.where(top < 0, -1.0, 1.0)


# -- statistics in Spark ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Whitener:
    """Statistics of the fit list and the components kept; ``values`` are their eigenvalues."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n, from the exact n * x - S."""
        return (self.n * x - self.sums) / self.n

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows: one column per component."""
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))


def integer_vectors(df: DataFrame, vector_col: str, scale: float = 64.0) -> F.Column:
    """floor(scale * c) of each entry as a double; null for a vector that is null or holds null or non-finite entries."""
    x = F.transform(F.col(vector_col), lambda v: F.floor(F.greatest(
        F.lit(-float(MOST)), F.least(F.lit(float(MOST)), v.cast("double") * F.lit(float(scale))))))
    return F.when(finite(vector_col), x)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of ``width`` integers, shorter lists filled with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy()
    return out


def _summed_rows(fit: DataFrame, width: int, term: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The sum of ``term`` (a size x size matrix of a block of rows) over the fit list.

    Each partition adds up its own; the matrices' rows are then summed by row number.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            total += term(_matrix(batch.column(0), width))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(size, TaskContext.get().partitionId(), np.int64)), pa.array(np.arange(size, dtype=np.int32)),
             pa.array([r.tobytes() for r in total], pa.binary())], names=["part", "i", "row"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        rows = np.stack([np.frombuffer(r) for _, r in sorted(zip(group["part"], group["row"], strict=True))])
        return pd.DataFrame({"i": group["i"].iloc[:1], "row": [rows.sum(axis=0).tobytes()]})

    summed = fit.mapInArrow(run, "part long, i int, row binary").groupBy("i").applyInPandas(add, "i int, row binary")
    out = np.zeros((size, size))
    for r in summed.collect():  # one row per dimension
        out[r["i"]] = np.frombuffer(r["row"])
    return out


def fit_whitener(fit: DataFrame, components: int = 16) -> Whitener | None:
    """Statistics and components of a written table of distinct integer vectors; None if it is empty.

    Components without spread (an eigenvalue of at most 1e-12 of the trace) are left out.
    """
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(0, np.int64)
        for batch in batches:
            column = batch.column(0)
            wide = max(len(total), int(np.diff(column.offsets.to_numpy()).max(initial=0)))
            total = np.pad(total, (0, wide - len(total))) + _matrix(column, wide).sum(axis=0)
            n += len(column)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(total), dtype=np.int32)),
                                          pa.array(np.concatenate([[n], total]).astype(np.int64))], names=["i", "s"])

    found = {r["i"]: r["s"] for r in fit.mapInArrow(sums, "i int, s long").groupBy("i").agg(F.sum("s").alias("s")).collect()}
    n, width = found.pop(-1, 0), len(found)
    if not n:
        return None
    base = Whitener(n, np.array([found[i] for i in range(width)], np.int64), np.empty((width, 0)), np.empty(0), 0.0)
    if not width:
        return base
    v = _summed_rows(fit, width, lambda x: (c := base.centred(x)).T @ c, width) / n
    v = (v + v.T) / 2
    trace = float(np.trace(v))
    values, vectors = leading_components(v, min(components, width))
    some = values > 1e-12 * trace
    out = Whitener(n, base.sums, vectors[:, some], values[some], trace)
    k = int(some.sum())
    if not k:
        return out
    cov = _summed_rows(fit, width, lambda x: (w := out(x)).T @ w, k) / n
    return Whitener(n, base.sums, out.vectors, out.values, trace, float(np.abs(cov - np.eye(k)).max()))


def _deviations(model: Whitener, x: np.ndarray) -> pa.Array:
    """Per row the exact sum of (n * x - S)^2; null where it does not fit a long."""
    off = model.n * x - model.sums
    rough = np.square(off.astype(np.float64)).sum(axis=1)
    exact = (off * off).sum(axis=1).astype(object)
    for i in np.flatnonzero(rough >= 2.0 ** 62):
        total = sum(int(d) ** 2 for d in off[i])
        exact[i] = total if total < 1 << 63 else None
    return pa.array(exact.tolist(), pa.int64())


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 16,
           scale: float = 64.0) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per row and component.

    Fits on each distinct integer vector once, then projects every row.  Left out are
    rows whose vector is null or holds null or non-finite entries.  A shorter vector
    counts as filled up with zeros to the longest.  Repeated rows each have their own
    result, a null id stays null.  Scaled entries are held to 2^31 - 1 in size.  A
    constant added to every integer changes no column.  ``deviation`` is null where the
    exact sum does not fit a long.  With no row, or without any spread, the result is
    empty; components without spread are left out.  Other columns are not read.
    """
    rows = df.select(F.col(id_col).alias("vec_id"), integer_vectors(df, vector_col, scale).alias("x")).where("x IS NOT NULL")
    model = fit_whitener(land(rows.select("x").distinct(), "fit"), components)
    schema = (f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, component int, n long, deviation long, "
              "whitened double, explained double, identity_error double")
    if model is None or not len(model.values):
        return df.sparkSession.createDataFrame([], schema)
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        k, width = len(m.values), len(m.sums)
        for batch in batches:
            x = _matrix(batch.column(1), width)
            each = pa.array(np.repeat(np.arange(len(x)), k))
            size = len(x) * k
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(size, m.n)), _deviations(m, x).take(each), pa.array(m(x).ravel()),
                 pa.array(np.tile(m.values / m.trace, len(x))), pa.array(np.full(size, m.identity_error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)
