"""Sinks: table writes and the lap CSV export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The export columns, in the reference's order.
EXPORT_COLUMNS = (
    "GrandPrix", "Circuit", "Session", "Driver", "LapNumber",
    "LapTime", "Compound", "TyreLife", "Stint", "FreshTyre",
    "Sector1Time", "Sector2Time", "Sector3Time",
)


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: Sequence[str] | None = None, fmt: str = "parquet") -> str:
    """Save ``df`` (S4).  ``fmt='delta'`` passes through when that source is installed.

    Partitioning by GrandPrix/Session lets later reads prune whole races.
    """
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def export_columns(df: DataFrame) -> DataFrame:
    """The export columns that exist, in export order."""
    return df.select(*[c for c in EXPORT_COLUMNS if c in df.columns])


def read_export(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of an export, typed again."""
    return spark.read.schema(schema).option("header", True).csv(path)


def export_laps(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Write the export columns as CSV with a header (S5) and report lap/race counts.

    The report is computed from the written files, so it reflects what landed.
    """
    out = export_columns(df)
    out.write.mode(mode).option("header", True).csv(path)
    return read_export(df.sparkSession, path, out.schema).agg(F.count(F.lit(1)).alias("Laps"), F.countDistinct("GrandPrix").alias("Races"))
