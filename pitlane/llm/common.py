"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import operator
import sys
import types
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlane.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; only Spark's readers touch the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts the lineage: later stages and retries after a lost executor read the
    files instead of running the work above them again.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(name: str, taken: Iterable[str]) -> str:
    """``name``, with underscores in front until no column of ``taken`` has it."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def check_new(df: DataFrame, name: str) -> None:
    """Refuse a new column whose name is taken: two of one name could not be told apart."""
    if name.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"there is a column {name!r} already: pass another name")


def in_training_fold(doc_id: str) -> F.Column:
    """True where labels may be learnt from: crc32(doc_id as text) mod 5 is not 0."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 != 0


def join_hot(big: DataFrame, small: DataFrame, key: str | list[str], counts: DataFrame | None = None,
             share: int = 1024) -> DataFrame:
    """Inner join; ``small`` has one row per key at most, both are written tables or cheap to read again.

    Keys that hold more than one in ``share`` of ``big``'s rows meet their row by
    broadcast: fewer than ``share`` rows, whatever the size.  All others go through a
    shuffle, in which no key is hot.  ``counts`` gives the rows of ``big`` per key as
    ``n`` if they are known.  Null keys meet nothing.
    """
    keys = [key] if isinstance(key, str) else key
    counts = big.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")) if counts is None else counts
    hot = F.broadcast(counts.where((F.col("n") * share > big.count()) & F.col(keys[0]).isNotNull()).select(*keys))
    few = F.broadcast(small.join(hot, keys, "left_semi"))
    return big.join(few, keys).unionByName(big.join(hot, keys, "left_anti").join(small, keys))


def finite(vector_col: str) -> F.Column:
    """True for an array without null, NaN or infinite entries; false for a null array."""
    ok = F.forall(vector_col, lambda v: F.coalesce((F.abs(v) < float("inf")) & ~F.isnan(v), F.lit(False)))
    return F.coalesce(ok, F.lit(False))


def append_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, name])


def extended(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(name, kind)])


def text_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column, empty for null."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


class NgramPresence:
    """Which hashed byte n-grams of the given orders a text has, as sorted ids.

    ids are below ``2**bits``.  Texts are read whole, in slices of ``slice_bytes``
    that overlap by the longest order less one: beside the text's own words, memory
    holds the hashes of one slice and the distinct ids so far.  With ``repeats``,
    n-grams of a second view count too: one byte per word, which tells whether the
    word is the same as the one before.
    """

    #: Odd multipliers of the rolling and the final hash (fixed so that models can be reused).
    STEP, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)

    def __init__(self, orders: tuple[int, ...], bits: int, slice_bytes: int = 1 << 20,
                 repeats: bool = False):
        self.orders, self.bits, self.slice_bytes, self.repeats = tuple(orders), bits, slice_bytes, repeats

    def _hashes(self, data: bytes, salt: int) -> list[np.ndarray]:
        """Ids of the n-grams of one slice, an array per order."""
        b, found = np.frombuffer(data, np.uint8).astype(np.uint64), []
        h = np.full(len(b), salt, np.uint64)
        for n in range(1, min(max(self.orders), len(b)) + 1):
            h = h[:len(b) - n + 1]
            h += b[n - 1:]
            h += np.uint64(n)
            h *= self.STEP
            if n in self.orders:
                mixed = h >> np.uint64(29)
                mixed ^= h
                mixed *= self.MIX
                mixed >>= np.uint64(64 - self.bits)
                found.append(mixed.astype(np.int32))
        return found

    def __call__(self, text: bytes) -> np.ndarray:
        low = text.lower() if text.isascii() else text.decode("utf-8", "replace").lower().encode()
        words, held, overlap = low.split(), np.empty(0, np.int32), max(self.orders) - 1
        views = [(b" " + b" ".join(words) + b" ", 0)]
        if self.repeats:
            views.append((bytes(map(operator.eq, words[1:], words)), 1 << 32))
        for data, salt in views:
            for at in range(0, len(data), self.slice_bytes):
                ids = np.concatenate([held, *self._hashes(data[at:at + self.slice_bytes + overlap], salt)])
                ids.sort()
                new = np.ones(len(ids), bool)
                np.not_equal(ids[1:], ids[:-1], out=new[1:])
                held = ids[new]
        return held


def per_worker(key: str, build):
    """``build()`` once per Python worker process, which many tasks share."""
    held = sys.modules.setdefault("_llm_per_worker", types.ModuleType("_llm_per_worker")).__dict__
    if key not in held:
        held[key] = build()
    return held[key]
