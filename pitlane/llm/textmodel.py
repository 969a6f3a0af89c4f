"""What the text classifiers of this subpackage share: presence rows and scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlane.llm.common import NgramPresence, append_column, check_new, extended, in_training_fold, text_bytes


def presence_rows(docs: DataFrame, text_col: str, name: str, present: NgramPresence) -> DataFrame:
    """``docs`` without its text, with the ids of the n-grams it has as little-endian int32 bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [present(t).tobytes() for t in text_bytes(batch.column(at))]
            yield append_column(batch, name, pa.array(ids, pa.binary())).select([*rest, name])

    at, rest = docs.columns.index(text_col), [c for c in docs.columns if c != text_col]
    return docs.mapInArrow(run, extended(docs.select(*rest).schema, name, T.BinaryType()))


def with_score(docs: DataFrame, text_col: str, name: str, present: NgramPresence,
               score: Callable[[np.ndarray], float]) -> DataFrame:
    """``docs`` with ``score`` of each text's n-gram ids as a double in the column ``name``, which it must not have."""
    check_new(docs, name)
    # 2**bits weights, whatever the data
    model = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(score))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = cloudpickle.loads(model.value)
        for batch in batches:
            yield append_column(batch, name, pa.array([of(present(t)) for t in text_bytes(batch.column(at))], pa.float64()))

    at = docs.columns.index(text_col)
    return docs.mapInArrow(run, extended(docs.schema, name, T.DoubleType()))


def votes(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """(doc_id, y) of the labels 0 and 1 in the training fold.  An id with both is left out: it confirms neither."""
    return labels.where(in_training_fold(id_col) & F.col(label_col).isin(0, 1)).groupBy(
        F.col(id_col).cast("long").alias("doc_id")).agg(F.min(label_col).alias("y"), F.max(label_col).alias("z")).where(
        "y = z and doc_id is not null").select("doc_id", "y")


def ids_of(docs: DataFrame, id_col: str) -> DataFrame:
    """The distinct ids of ``docs``: what joins with labels work on, so that no text is moved."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id")).where("doc_id is not null").distinct()


def bounded_sample(ids: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows, those whose doc_id has the smallest hash: the same at every run."""
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def texts_of(docs: DataFrame, sample: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``sample`` with the text of each id; of several texts the smallest, null as an empty one.

    ``sample`` comes from ``bounded_sample``, so it may be broadcast: the scan of the
    texts drops all other rows where it reads them.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rest = [c for c in sample.columns if c != "doc_id"]
    return rows.join(F.broadcast(sample), "doc_id").groupBy("doc_id", *rest).agg(F.min("text").alias("text"))


def collect_presence(rows: DataFrame, name: str) -> list[np.ndarray]:
    """The id arrays of a bounded sample, on the driver."""
    column = rows.select(name).toArrow().column(0)
    return [np.frombuffer(x.as_buffer(), np.int32) for chunk in column.chunks for x in chunk]


def sigmoid(x: float) -> float:
    return float(1.0 / (1.0 + np.exp(-np.clip(x, -500.0, 500.0))))
