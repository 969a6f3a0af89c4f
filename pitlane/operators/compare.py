"""Race comparisons (R1-R7): per-race compound summaries, histograms, curves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitlane.functions.stats import group_quantiles, grouped_stats, null_safe_join


def compound_usage(valid: DataFrame, keys: Sequence[str] = ("GrandPrix",)) -> DataFrame:
    """Laps and median LapTime per compound (per race), most used first."""
    k = [*keys, "Compound"]
    df = valid.where(F.col("Compound").isNotNull())
    out = grouped_stats(df, k, "LapTime", {"MedianLapTime": 0.5}, {"Laps": ("rows", None)})
    return out.orderBy(*keys, F.desc("Laps"), "Compound")


def race_overview(valid: DataFrame, keys: Sequence[str] = ("GrandPrix",)) -> DataFrame:
    """R2: valid laps, distinct drivers and the sorted list of compounds per race."""
    return valid.where(F.col("Compound").isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("ValidLaps"),
        F.countDistinct("Driver").alias("Drivers"),
        F.array_join(F.array_sort(F.collect_set("Compound")), ", ").alias("Compounds"))


def race_tyre_summary(valid: DataFrame, keys: Sequence[str] = ("GrandPrix",)) -> DataFrame:
    """Per compound: laps, median and mean LapTime, mean and max stint length.

    Stint length = max TyreLife per (Driver, Stint); NULL stints are dropped.
    """
    k = [*keys, "Compound"]
    df = valid.where(F.col("Compound").isNotNull())
    laps = grouped_stats(df, k, "LapTime", {"MedianLapTime": 0.5},
                         {"Laps": ("rows", None), "MeanLapTime": ("avg", "LapTime")})
    stints = (df.where(F.col("Driver").isNotNull() & F.col("Stint").isNotNull())
              .groupBy(*k, "Driver", "Stint").agg(F.max("TyreLife").alias("_len"))
              .groupBy(*k).agg(F.avg("_len").alias("AvgStint"), F.max("_len").alias("MaxStint")))
    return null_safe_join(laps, stints, k, "left")


def fastest_lap_by_compound(valid: DataFrame, keys: Sequence[str] = ("GrandPrix",)) -> DataFrame:
    """Fastest lap per compound with its LapNumber and Driver (ties: Driver, LapNumber)."""
    k = [*keys, "Compound"]
    best = valid.where(F.col("Compound").isNotNull() & F.col("LapTime").isNotNull()).groupBy(*k).agg(
        F.min(F.struct("LapTime", "Driver", "LapNumber")).alias("_b"))
    return best.select(*k, "_b.LapTime", "_b.LapNumber", "_b.Driver")


def compare_races(valid: DataFrame, compounds: Sequence[str] | None = None,
                  races: Sequence[str] | None = None) -> DataFrame:
    """R5 generalised: per race and compound: laps, median LapTime, mean TyreLife.

    ``compounds`` and ``races`` narrow the comparison; None takes all.
    """
    df = valid.where(F.col("Compound").isNotNull())
    if compounds is not None:
        df = df.where(F.col("Compound").isin(list(compounds)))
    if races is not None:
        df = df.where(F.col("GrandPrix").isin(list(races)))
    return grouped_stats(df, ["GrandPrix", "Compound"], "LapTime", {"MedianLapTime": 0.5},
                         {"Laps": ("rows", None), "MeanTyreLife": ("avg", "TyreLife")})


def compare_two_races(valid: DataFrame, race1: str, race2: str, compound: str = "SOFT") -> DataFrame:
    """One compound at two races; empty unless both races have laps on it."""
    per = compare_races(valid, [compound], [race1, race2])
    # at most two rows, so the window over the compound is bounded
    return per.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("Compound"))).where(F.col("_n") == 2).drop("_n")


def laptime_histogram(valid: DataFrame, keys: Sequence[str] = ("GrandPrix",), bins: int = 30) -> DataFrame:
    """``bins`` equal-width LapTime bins per race between its own min and max.

    numpy semantics: the last bin is closed; a zero range widens to +-0.5.
    Every bin is emitted (empty ones with Count 0).
    """
    k = list(keys)
    df = valid.where(F.col("LapTime").isNotNull())
    rng = df.groupBy(*k).agg(F.min("LapTime").alias("_mn"), F.max("LapTime").alias("_mx"))
    rng = rng.select(*k, F.when(F.col("_mn") == F.col("_mx"), F.col("_mn") - 0.5).otherwise(F.col("_mn")).alias("_lo"),
                     F.when(F.col("_mn") == F.col("_mx"), F.col("_mx") + 0.5).otherwise(F.col("_mx")).alias("_hi"))
    j = null_safe_join(df.select(*k, "LapTime"), rng, k)
    b = F.least(F.width_bucket(F.col("LapTime"), F.col("_lo"), F.col("_hi"), F.lit(bins)), F.lit(bins)) - 1
    counts = j.groupBy(*k, b.cast("int").alias("Bin")).agg(F.count(F.lit(1)).alias("Count"))
    grid = rng.select(*k, "_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("Bin"))
    out = null_safe_join(grid, counts, k + ["Bin"], "left")
    width = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    return out.select(*k, "Bin", (F.col("_lo") + width * F.col("Bin")).alias("BinStart"),
                      (F.col("_lo") + width * (F.col("Bin") + 1)).alias("BinEnd"),
                      F.coalesce(F.col("Count"), F.lit(0)).alias("Count"))


def degradation_curves(valid: DataFrame, keys: Sequence[str] = ("GrandPrix", "Compound"),
                       min_laps: int = 10) -> DataFrame:
    """Median LapTime by tyre age per (race, compound) with more than ``min_laps`` laps."""
    k = list(keys)
    df = valid.where(F.col("Compound").isNotNull())
    curves = group_quantiles(df.where(F.col("TyreLife").isNotNull()), [*k, "TyreLife"], "LapTime", {"MedianLapTime": 0.5})
    # the groups' sizes are joined with the curves, not with the laps
    big = df.groupBy(*k).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > F.lit(min_laps)).select(*k)
    return null_safe_join(curves, big, k, "left_semi")
