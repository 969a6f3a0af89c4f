"""Column-level helpers built only from JVM-side ``pyspark.sql.functions``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DayTimeIntervalType, DoubleType, FloatType

# The five tyre compounds the reference recognises, in its order.
KNOWN_COMPOUNDS = ("SOFT", "MEDIUM", "HARD", "INTERMEDIATE", "WET")
# The dry compounds the tyre analyses loop over.
DRY_COMPOUNDS = ("SOFT", "MEDIUM", "HARD")
# The bronze record source label.
DEFAULT_RECORD_SOURCE = "fastf1_api"
# Pd.cut edges and labels of the two feature bins (right-closed).
TYRE_LIFE_BINS = ((0, 5, "Fresh"), (5, 10, "Early"), (10, 15, "Mid"), (15, 20, "Late"), (20, 100, "VeryOld"))
PROGRESS_BINS = ((0.0, 0.25, "Early"), (0.25, 0.5, "EarlyMid"), (0.5, 0.75, "LateMid"), (0.75, 1.0, "Late"))


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: str | Column, den: str | Column) -> Column:
    """Division that yields NULL on a zero or NULL divisor (ANSI mode safe)."""
    return F.try_divide(col_(num), col_(den))


def nan_to_null(c: str | Column) -> Column:
    """NaN becomes NULL; NULL stays NULL (the bronze contract, SURVEY D1)."""
    return F.nanvl(col_(c), F.lit(None).cast("double"))


def interval_seconds(c: str | Column) -> Column:
    """Day-time interval to fractional seconds, exact to the microsecond."""
    return F.unix_micros(F.timestamp_micros(F.lit(0)) + col_(c)) / F.lit(1_000_000.0)


def as_seconds(df: DataFrame, name: str) -> Column:
    """Seconds as double whatever the column's type (interval, float, numeric)."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, DayTimeIntervalType):
        return nan_to_null(interval_seconds(name))
    if isinstance(dtype, (DoubleType, FloatType)):
        return nan_to_null(F.col(name).cast("double"))
    return F.col(name).cast("double")


def right_closed_bins(c: str | Column, bins) -> Column:
    """pd.cut semantics: (lo, hi] per bin, NULL outside."""
    c = col_(c)
    out = None
    for lo, hi, label in bins:
        cond = (c > F.lit(lo)) & (c <= F.lit(hi))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(None).cast("string"))


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column."""
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ])
