"""Embedding near-duplicates by Euclidean p-stable hashing.

Normalised vectors are projected on Gaussian directions and quantised: a table's
bucket is the tuple of ``floor((a . x + b) / width)`` over its ``hashes`` directions.
The number of directions follows the number of vectors, so that unrelated vectors
seldom meet; the number of tables follows from it and from the chance allowed to
miss a pair just at the threshold.  Everything is integer arithmetic inside doubles,
so a vector falls into the same buckets wherever it is hashed.

Equal vectors are folded first.  A bucket is cut into chunks and each pair of chunks
is a tile, so a bucket of any size is spread over tasks.  A tile checks cosines in
double precision and counts a pair only in the first table where both vectors meet,
so links are counted without listing pairs; it gives back one row per linked vector.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.llm.common import finite, join_hot, land
from pitlane.llm.simhash import components

#: Bits of the whole numbers that stand for vector entries and for directions.
X_BITS, A_BITS = 24, 14


@dataclass(frozen=True)
class PStableParams:
    """Pairs of cosine ``least`` are missed with a chance of ``miss`` at most, closer ones much less often.

    ``spare`` unrelated vectors (at a right angle) would have to be there for each
    vector before one of them is expected in its bucket.
    """

    least: float = 0.95
    miss: float = 0.005
    spare: int = 32
    width_bits: int = 1  # buckets are 2 ** width_bits wide
    tile_rows: int = 1024
    seed: int = 11


def meet_chance(distance: float, width: float) -> float:
    """The chance that one quantised projection agrees for two vectors ``distance`` apart (Datar et al., 2004)."""
    if distance <= 0:
        return 1.0
    t = width / distance
    return math.erf(t / math.sqrt(2)) - math.sqrt(2 / math.pi) / t * (1 - math.exp(-t * t / 2))


def pick_tables(n: int, p: PStableParams) -> tuple[int, int]:
    """(tables, directions per table) for ``n`` vectors."""
    width = 2.0 ** p.width_bits
    far, near = meet_chance(math.sqrt(2), width), meet_chance(math.sqrt(2 - 2 * p.least), width)
    hashes = max(1, math.ceil(math.log(max(2, p.spare * n)) / -math.log(far)))
    return math.ceil(math.log(p.miss) / math.log1p(-near ** hashes)), hashes


class Tables:
    """Bucket keys of rows of unit vectors."""

    def __init__(self, width: int, tables: int, hashes: int, p: PStableParams):
        rng = np.random.default_rng([p.seed, tables, hashes])
        self.shape, self.shift = (tables, hashes), X_BITS + A_BITS + p.width_bits
        self.directions = np.rint(rng.normal(size=(tables * hashes, width)).T * (1 << A_BITS))
        self.offsets = rng.integers(0, 1 << self.shift, tables * hashes).astype(np.float64)
        self.odd = rng.integers(0, 1 << 62, tables * hashes, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        self.salt = rng.integers(0, 1 << 62, tables, dtype=np.int64).astype(np.uint64)

    def __call__(self, units: np.ndarray) -> np.ndarray:
        """One long per row and table.  All sums are of whole numbers below 2^53, hence exact in any order."""
        out = np.empty((len(units), self.shape[0]), np.int64)
        for at in range(0, len(units), 512):
            x = np.rint(units[at:at + 512] * (1 << X_BITS))
            cell = (x @ self.directions[:x.shape[1]] + self.offsets).astype(np.int64) >> self.shift
            key = (cell.view(np.uint64) * self.odd).reshape(len(x), *self.shape).sum(axis=2) + self.salt
            key = (key ^ (key >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
            out[at:at + 512] = (key ^ (key >> np.uint64(32))).view(np.int64)
        return out


def unit_rows(column: pa.Array, width: int) -> np.ndarray:
    """A list column as unit vectors in doubles, shorter lists filled with zeros; a zero vector stays zero."""
    lengths = np.diff(column.offsets.to_numpy())
    x = np.zeros((len(column), width))
    x[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    top = np.abs(x).max(axis=1, initial=0)[:, None]
    x /= np.where(top > 0, top, 1)  # so that no square is out of range
    norm = np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
    return x / np.where(norm > 0, norm, 1)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row reachable from each of ``n`` rows over the pairs (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _close_pairs(x: np.ndarray, left: np.ndarray, right: np.ndarray, same: bool, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of cosine ``least`` and more between rows ``left`` and ``right``, within one chunk each pair once."""
    close = x[left] @ x[right].T >= least
    a, b = np.nonzero(np.triu(close, 1) if same else close)
    return left[a], right[b]


def _check_tiles(rows: dict[str, np.ndarray], x: np.ndarray, tables: Tables, least: float, small: int = 16) -> pa.RecordBatch:
    """(no, more, low) for the linked rows of whole tiles, which follow each other.

    A pair is left to the first table where both vectors share a bucket.
    """
    tile = np.stack([rows[c] for c in ("t", "key", "i", "j")])
    new = np.ones(tile.shape[1], bool)
    new[1:] = (tile[:, 1:] != tile[:, :-1]).any(axis=0)
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(x)))
    owner, ends = np.repeat(starts, sizes), np.repeat(starts + sizes, sizes)
    little = np.flatnonzero(np.repeat(sizes <= small, sizes))
    pairs = []
    for lag in range(1, small):  # small tiles all at once; they have one chunk, or two of them
        little = little[little + lag < ends[little]]
        met = little[(rows["i"][little] == rows["j"][little]) | (rows["x"][little] != rows["x"][little + lag])]
        near = met[np.einsum("ij,ij->i", x[met], x[met + lag]) >= least]
        pairs.append((near, near + lag))
    for at, n in zip(starts[sizes > small], sizes[sizes > small], strict=True):
        own = np.arange(at, at + n)
        same = rows["i"][at] == rows["j"][at]
        first = rows["x"][own] == rows["i"][at]
        pairs.append(_close_pairs(x, own[first], own if same else own[~first], same, least))
    a, b = (np.concatenate(c) for c in zip(*pairs, strict=True))
    used, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    keys = tables(x[used])
    ka, kb, table = place[:len(a)], place[len(a):], rows["t"][a]
    left = np.arange(len(a))
    for t in range(int(table.max(initial=0))):  # those that met in an earlier table are counted there
        left = left[(table[left] <= t) | (keys[ka[left], t] != keys[kb[left], t])]
    a, b = a[left], b[left]
    more = np.bincount(a, rows["copies"][b], len(x)) + np.bincount(b, rows["copies"][a], len(x))
    linked = np.flatnonzero(more)
    low = _roots(len(x), a, b)[linked]
    return pa.RecordBatch.from_arrays([pa.array(rows["no"][linked]), pa.array(more[linked].astype(np.int64)), pa.array(rows["no"][low])],
                                      names=["no", "more", "low"])


def linked_vectors(vectors: DataFrame, p: PStableParams = PStableParams(), tables: int | None = None,
                   hashes: int | None = None) -> DataFrame:
    """(no, more, low): per tile the links found of a vector, and one number for all it is connected to there.

    ``vectors`` is a written table of distinct non-zero vectors: (no, copies, vector).
    ``more`` counts the copies of the vectors linked; the pairs of all tiles are disjoint.
    """
    n, width = vectors.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    picked = pick_tables(n, p)
    tables, hashes = tables or picked[0], hashes or picked[1]

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Tables(width, tables, hashes, p)
        for batch in batches:
            keys = of(unit_rows(batch.column(1), width))
            ends = pa.array(np.arange(len(keys) + 1, dtype=np.int32) * tables)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, pa.array(keys.ravel()))], names=["no", "keys"])

    hashed = land(vectors.select("no", "vector").mapInArrow(buckets, "no long, keys array<long>"), "buckets")
    placed = hashed.select("no", F.posexplode("keys").alias("t", "key"))
    met = land(placed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "met")
    members = join_hot(placed, met, ["t", "key"], met).withColumn("chunks", F.ceil(F.col("n") / p.tile_rows).cast("int"))
    tile = ["t", "key", "i", "j"]
    tiles = members.join(vectors, "no").withColumn("x", F.pmod(F.xxhash64("no"), F.col("chunks")).cast("int")).withColumn(
        "y", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "t", "key", F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j"), "x", "no", "copies", "vector")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Tiles follow each other in sorted order; the last of a batch may go on in the next."""
        of, held = Tables(width, tables, hashes, p), None
        for batch in batches:
            rows = {c: batch.column(c).to_numpy() for c in (*tile, "x", "no", "copies")}
            x = unit_rows(batch.column("vector"), width)
            if held is not None:
                rows, x = {c: np.concatenate([held[0][c], v]) for c, v in rows.items()}, np.concatenate([held[1], x])
            if not len(x):
                continue
            last = np.flatnonzero(np.any([rows[c] != rows[c][-1] for c in tile], axis=0))
            cut = int(last[-1]) + 1 if len(last) else 0
            held = {c: v[cut:] for c, v in rows.items()}, x[cut:]
            if cut:
                yield _check_tiles({c: v[:cut] for c, v in rows.items()}, x[:cut], of, p.least)
        if held is not None:
            yield _check_tiles(*held, of, p.least)

    return tiles.repartition(*tile).sortWithinPartitions(*tile).mapInArrow(check, "no long, more long, low long")


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", p: PStableParams = PStableParams(),
                    tables: int | None = None, hashes: int | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``df``; other columns are not read.

    ``n_links`` counts the other rows at a cosine of at least ``p.least`` that the
    tables bring together, equal vectors always; ``component_id`` is the smallest id
    reachable, itself included.  Null and zero vectors, and those with null or
    non-finite entries, link with nothing.  A shorter vector counts as filled up with
    zeros.  Repeated rows are vectors of their own, equal to each other.  A null id is
    no smallest id unless its component has no other, and is kept only then.  An empty
    table gives an empty result.
    """
    rows = df.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector")).withColumn(
        "good", finite("vector") & F.coalesce(F.exists("vector", lambda v: v != 0), F.lit(False)))
    good = rows.where("good").drop("good")
    vectors = land(good.groupBy("vector").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least")).withColumn(
        "no", F.monotonically_increasing_id()), "vectors")
    found = land(linked_vectors(vectors.select("no", "copies", "vector"), p, tables, hashes), "links")
    more = found.groupBy("no").agg(F.sum("more").alias("more"))
    roots = components(found.select(F.col("no").alias("a"), F.col("low").alias("b"))).select(F.col("node").alias("no"), "root")
    named = land(vectors.select("no", "copies", "least").join(more, "no", "left").join(roots, "no", "left").select(
        "no", "least", (F.col("copies") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"), F.coalesce("root", "no").alias("root")), "named")
    classes = named.groupBy("root").agg(F.min("least").alias("component_id"))
    result = join_hot(named, classes, "root").select("no", "n_links", "component_id")
    by_vector = land(vectors.select("no", "vector").join(result, "no").drop("no"), "classes")
    linked = join_hot(good, by_vector, "vector", vectors.select("vector", F.col("copies").alias("n"))).drop("vector")
    alone = rows.where(~F.col("good")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
