"""Declared schemas (FIXTURES.md §A) and helpers to conform inputs to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)

LAPS_SCHEMA = StructType([
    StructField("GrandPrix", StringType(), False),
    StructField("Circuit", StringType(), True),
    StructField("Session", StringType(), False),
    StructField("Driver", StringType(), False),
    StructField("DriverNumber", StringType(), True),
    StructField("LapNumber", DoubleType(), False),
    StructField("Time", DoubleType(), True),
    StructField("LapTime", DoubleType(), True),
    StructField("Sector1Time", DoubleType(), True),
    StructField("Sector2Time", DoubleType(), True),
    StructField("Sector3Time", DoubleType(), True),
    StructField("Compound", StringType(), True),
    StructField("TyreLife", DoubleType(), True),
    StructField("Stint", DoubleType(), True),
    StructField("FreshTyre", BooleanType(), True),
    StructField("IsAccurate", BooleanType(), True),
    StructField("PitInTime", DoubleType(), True),
    StructField("PitOutTime", DoubleType(), True),
])

WEATHER_SCHEMA = StructType([
    StructField("GrandPrix", StringType(), False),
    StructField("Session", StringType(), False),
    StructField("WeatherId", LongType(), True),
    StructField("Time", DoubleType(), True),
    StructField("AirTemp", DoubleType(), True),
    StructField("TrackTemp", DoubleType(), True),
    StructField("Rainfall", BooleanType(), True),
])

TELEMETRY_SCHEMA = StructType([
    StructField("SampleId", LongType(), True),
    StructField("Speed", DoubleType(), False),
    StructField("Throttle", DoubleType(), True),
    StructField("Brake", DoubleType(), True),
    StructField("nGear", IntegerType(), True),
    StructField("RPM", DoubleType(), True),
])

STRATEGIES_SCHEMA = StructType([
    StructField("Strategy", StringType(), False),
    StructField("StintNo", IntegerType(), False),
    StructField("Compound", StringType(), True),
    StructField("StintLength", IntegerType(), False),
])

# The lap validation contract (column, type, nullable, lo, hi,
# allowed set) read from the reference's lap schema.  Bounds are inclusive.
LAP_RULES = (
    ("Driver", "string", False, None, None, None),
    ("LapNumber", "int", False, 0, None, None),  # strictly greater than 0
    ("LapTime", "float", False, 0, 200, None),
    ("Sector1Time", "float", True, 0, 100, None),
    ("Sector2Time", "float", True, 0, 100, None),
    ("Sector3Time", "float", True, 0, 100, None),
    ("Compound", "string", True, None, None, ("SOFT", "MEDIUM", "HARD", "INTERMEDIATE", "WET")),
    ("TyreLife", "int", True, 0, None, None),
    ("IsAccurate", "bool", True, None, None, None),
)
# Columns whose lower bound is exclusive (LapNumber > 0); all others are >= / <=.
LAP_RULES_EXCLUSIVE_LO = ("LapNumber",)

# The telemetry validation contract.
TELEMETRY_RULES = (
    ("Speed", "float", False, 0, 400, None),
    ("Throttle", "float", True, 0, 100, None),
    ("Brake", "float", True, 0, 100, None),
    ("nGear", "int", True, 0, 8, None),
    ("RPM", "float", True, 0, 20000, None),
)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the declared columns in order, adding absent ones as typed NULLs.

    Extra columns are kept after the declared ones (open schema).
    """
    present = set(df.columns)
    cols = [F.col(f.name).cast(f.dataType) if f.name in present
            else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    extra = [F.col(c) for c in df.columns if c not in {f.name for f in schema.fields}]
    return df.select(*cols, *extra)
