"""Structured Streaming ingest: lap files -> bronze and row-level silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from pitlane.operators import clean
from pitlane.schema import LAPS_SCHEMA
from pitlane.session import ensure_checkpoint_dir
from pitlane.sources.laps import bronze_laps


def silver_rows(df: DataFrame, tolerance: float = 0.1) -> DataFrame:
    """The row-local part of silver (C1-C3); session minima and dedup need the
    whole session and run in batch over the landed table."""
    return df.transform(clean.silver_filter).transform(clean.sector_mismatch, tolerance) \
        .transform(clean.compound_std)


def ingest_laps(spark: SparkSession, source_dir: str, bronze_path: str, silver_path: str,
                schema: StructType = LAPS_SCHEMA, fmt: str = "parquet", checkpoint: str | None = None,
                available_now: bool = True, max_files_per_trigger: int = 1000) -> StreamingQuery:
    """Stream new lap files into bronze and row-level silver, partitioned by batch and race.

    ``checkpoint`` defaults to a folder under ``spark.checkpoint.dir`` so a
    restarted or failed job resumes where it stopped.  With
    ``available_now`` the query drains what is there and stops.
    """
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.load(source_dir)
    bronze = bronze_laps(raw)
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/pitlane-ingest-laps"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # a batch that runs again after a failure replaces its own folders, so nothing is there twice
        written = batch.withColumn("BatchId", F.lit(batch_id).cast("long"))
        for rows, path in ((written, bronze_path), (silver_rows(written), silver_path)):
            (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("BatchId", "GrandPrix", "Session").parquet(path))

    writer = bronze.writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
