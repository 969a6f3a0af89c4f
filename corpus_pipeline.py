"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns
a DataFrame.  All but the last return the columns of ``documents`` for the rows
they keep; the last returns one row per packed piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pitlane.llm import decontam, packing, quality, simhash, toxicity
from pitlane.llm.common import land, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores below 0.5."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model scores at 0.3 or above."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each SimHash group: 4-word shingles, 4 bits."""
    return simhash.keep_one_per_group(docs, words=4, max_bits=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verified overlap with a benchmark item."""
    return decontam.keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, cut and packed into sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, packing.public_vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("quality classifier", keep_good),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack),
]

#: SQL can't express the trained classifiers; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = land(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-').lower()}")
    return docs
