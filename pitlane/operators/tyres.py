"""Tyre analyses (T1-T11): degradation, stint lengths, compound performance.

The reference loops over compounds in Python; here the compound is a group
key, so one plan covers every compound.  Medians and quartiles come from the
skew-safe exact ``group_quantiles`` (a compound holds a large share of laps).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitlane.functions.scalar import DRY_COMPOUNDS, KNOWN_COMPOUNDS
from pitlane.functions.stats import group_mode, group_quantiles, grouped_stats, null_safe_join

STINT_KEYS = ("GrandPrix", "Driver", "Stint")


def pace_by_age(valid: DataFrame, keys: Sequence[str] = ("Compound", "TyreLife"),
                min_count: int | None = None, max_age: float | None = None) -> DataFrame:
    """Mean, median, count and sample std of LapTime per (compound, tyre age).

    Rows with a NULL key are dropped (pandas groupby semantics).
    """
    k = list(keys)
    df = valid
    for c in k:
        df = df.where(F.col(c).isNotNull())
    if max_age is not None:
        df = df.where(F.col("TyreLife") <= F.lit(max_age))
    out = grouped_stats(df, k, "LapTime", {"MedianLapTime": 0.5}, {
        "MeanLapTime": ("avg", "LapTime"), "LapCount": ("count", "LapTime"), "StdLapTime": ("stddev", "LapTime")})
    if min_count is not None:
        out = out.where(F.col("LapCount") >= F.lit(min_count))
    return out.select(*k, "MeanLapTime", "LapCount", "StdLapTime", "MedianLapTime")


def tyre_degradation(valid: DataFrame, compounds: Sequence[str] = DRY_COMPOUNDS,
                     min_laps: int = 50, max_fit_age: float = 30, min_ages: int = 5) -> DataFrame:
    """Per dry compound with >= ``min_laps`` laps: volume, tyre age, pace and slope.

    DegradationRate is the least-squares slope of the per-age median LapTime on
    age, over ages <= ``max_fit_age``; NULL unless there are more than
    ``min_ages`` ages in total and more than ``min_ages`` in the fit.
    AvgStintLength is (as in the reference) the mean tyre age over laps.
    """
    df = valid.where(F.col("Compound").isin(list(compounds)))
    stats = grouped_stats(df, ["Compound"], "LapTime", {"MedianLapTime": 0.5}, {
        "TotalLaps": ("rows", None), "AvgStintLength": ("avg", "TyreLife"), "MaxStintLength": ("max", "TyreLife"),
        "AvgLapTime": ("avg", "LapTime")}).where(F.col("TotalLaps") >= F.lit(min_laps))
    per_age = group_quantiles(df.where(F.col("TyreLife").isNotNull()), ["Compound", "TyreLife"],
                              "LapTime", {"_med": 0.5})
    fit = F.col("TyreLife") <= F.lit(max_fit_age)
    slope = per_age.groupBy("Compound").agg(
        F.count(F.lit(1)).alias("_ages"), F.count_if(fit).alias("_fit"),
        F.regr_slope(F.when(fit, F.col("_med")), F.when(fit, F.col("TyreLife"))).alias("_slope"))
    slope = slope.select("Compound", F.when((F.col("_ages") > min_ages) & (F.col("_fit") > min_ages),
                                            F.col("_slope")).alias("DegradationRate"))
    out = stats.join(slope, "Compound", "left")
    return out.select("Compound", "TotalLaps", "AvgStintLength", "MaxStintLength",
                      "DegradationRate", "AvgLapTime", "MedianLapTime")


def degradation_band(deg: DataFrame, minimal: float = 0.05, high: float = 0.10) -> DataFrame:
    """Documented reading of the slope: minimal < 0.05 <= normal <= 0.10 < high."""
    r = F.col("DegradationRate")
    band = (F.when(r.isNull(), F.lit(None).cast("string"))
            .when(r < F.lit(minimal), F.lit("minimal"))
            .when(r <= F.lit(high), F.lit("normal"))
            .otherwise(F.lit("high")))
    return deg.select("Compound", "DegradationRate", band.alias("DegradationBand"))


def stint_stats(valid: DataFrame, keys: Sequence[str] = STINT_KEYS,
                by: Sequence[str] = ("Compound",)) -> DataFrame:
    """T4: per stint (within a compound): StintLength = max TyreLife, mean LapTime."""
    k = list(by) + list(keys)
    df = valid
    for c in k:
        df = df.where(F.col(c).isNotNull())
    return df.groupBy(*k).agg(F.max("TyreLife").alias("StintLength"),
                              F.avg("LapTime").alias("MeanLapTime"))


def pace_change(valid: DataFrame, min_age_count: int = 10, window: int = 3) -> DataFrame:
    """Per compound, change of the per-age median between consecutive kept ages
    (ages with >= ``min_age_count`` laps), smoothed by a full ``window``-row mean.

    The windows run over the small per-age table, one row per (compound, age).
    """
    pace = pace_by_age(valid, ["Compound", "TyreLife"], min_count=min_age_count)
    by_age = Window.partitionBy("Compound").orderBy("TyreLife")
    roll = by_age.rowsBetween(-(window - 1), 0)
    pace = pace.withColumn("MedianDiff", F.col("MedianLapTime") - F.lag("MedianLapTime").over(by_age))
    return pace.withColumn("PaceChange", F.when(F.count("MedianDiff").over(roll) == window,
                                                F.avg("MedianDiff").over(roll)))


def optimal_stint(valid: DataFrame, compounds: Sequence[str] = DRY_COMPOUNDS,
                  min_laps: int = 100, min_age_count: int = 10, min_ages: int = 5,
                  window: int = 3, threshold_q: float = 0.75) -> DataFrame:
    """The tyre age where degradation accelerates, plus stint statistics.

    Ages with at least ``min_age_count`` laps are kept (need ``min_ages`` of
    them); the change of the per-age median between consecutive *kept* ages is
    smoothed by a full ``window``-row mean; OptimalMaxAge is the first age whose
    smoothed change exceeds its ``threshold_q`` quantile, else the largest kept age.
    """
    df = valid.where(F.col("Compound").isin(list(compounds)))
    volume = df.groupBy("Compound").agg(F.count(F.lit(1)).alias("_laps"), F.max("TyreLife").alias("LongestStint"))
    volume = volume.where(F.col("_laps") >= F.lit(min_laps))

    pace = pace_change(df, min_age_count, window).withColumnRenamed("PaceChange", "_chg")
    thr = pace.groupBy("Compound").agg(
        F.count(F.lit(1)).alias("_ages"), F.max("TyreLife").alias("_maxage"),
        F.percentile("_chg", F.lit(threshold_q)).alias("_thr"))
    pace = pace.join(thr, "Compound")
    opt = pace.groupBy("Compound").agg(
        F.first("_ages").alias("_ages"), F.first("_maxage").alias("_maxage"),
        F.min(F.when(F.col("_chg") > F.col("_thr"), F.col("TyreLife"))).alias("_first"))
    opt = opt.where(F.col("_ages") >= F.lit(min_ages)).select(
        "Compound", F.coalesce("_first", "_maxage").alias("OptimalMaxAge"))

    stints = stint_stats(df)
    sagg = stints.groupBy("Compound").agg(F.avg("StintLength").alias("AverageStintLength"),
                                          F.count(F.lit(1)).alias("TotalStints"))
    mode = group_mode(stints, ["Compound"], "StintLength", "MostCommonStint")
    out = opt.join(volume, "Compound").join(sagg, "Compound", "left").join(mode, "Compound", "left")
    return out.select("Compound", "OptimalMaxAge", "AverageStintLength", "MostCommonStint",
                      "LongestStint", "TotalStints")


def compound_by_circuit(valid: DataFrame) -> DataFrame:
    """T5: per (GrandPrix, Compound): median and mean LapTime and lap count."""
    df = valid.where(F.col("Compound").isNotNull() & F.col("GrandPrix").isNotNull())
    out = grouped_stats(df, ["GrandPrix", "Compound"], "LapTime", {"MedianLapTime": 0.5}, {
        "MeanLapTime": ("avg", "LapTime"), "LapCount": ("count", "LapTime")})
    return out.select("GrandPrix", "Compound", "MeanLapTime", "LapCount", "MedianLapTime")


def fastest_compound(perf: DataFrame) -> DataFrame:
    """The compound with the smallest median per GrandPrix (ties: alphabetical)."""
    best = perf.groupBy("GrandPrix").agg(F.min(F.struct(
        "MedianLapTime", "Compound", "MeanLapTime", "LapCount")).alias("_b"))
    return best.select("GrandPrix", "_b.Compound", "_b.MedianLapTime", "_b.MeanLapTime", "_b.LapCount")


def compound_wins(fastest: DataFrame) -> DataFrame:
    """Number of circuits where each compound is fastest, most wins first."""
    return fastest.groupBy("Compound").agg(F.count(F.lit(1)).alias("Wins")).orderBy(
        F.desc("Wins"), "Compound")


def compound_usage_counts(valid: DataFrame) -> DataFrame:
    """T8 as a long table: laps per GrandPrix and compound label, whatever labels there are."""
    return valid.where(F.col("Compound").isNotNull()).groupBy("GrandPrix", "Compound").agg(F.count(F.lit(1)).alias("Laps"))


def compound_usage_pivot(counts: DataFrame, compounds: Sequence[str] = KNOWN_COMPOUNDS) -> DataFrame:
    """``compound_usage_counts`` with a column per label of ``compounds`` (missing = 0).

    The caller names the columns, so no extra pass discovers them; other labels
    stay in the long table.
    """
    return counts.groupBy("GrandPrix").pivot("Compound", list(compounds)).agg(F.sum("Laps")).fillna(0)


def box_stats(df: DataFrame, keys: Sequence[str], value: str, whisker: float = 1.5) -> DataFrame:
    """Box-plot numbers per group: quartiles, 1.5 IQR whiskers, outlier count."""
    k = list(keys)
    base = df.where(F.col(value).isNotNull())
    q = group_quantiles(base, k, value, {"Q1": 0.25, "Median": 0.5, "Q3": 0.75})
    q = q.withColumn("_lo", F.col("Q1") - F.lit(whisker) * (F.col("Q3") - F.col("Q1"))) \
         .withColumn("_hi", F.col("Q3") + F.lit(whisker) * (F.col("Q3") - F.col("Q1")))
    j = null_safe_join(base.select(*k, value), q, k)
    inside = (F.col(value) >= F.col("_lo")) & (F.col(value) <= F.col("_hi"))
    agg = j.groupBy(*k).agg(
        F.count(F.lit(1)).alias("N"),
        F.min(F.when(inside, F.col(value))).alias("LowerWhisker"),
        F.max(F.when(inside, F.col(value))).alias("UpperWhisker"),
        F.count_if(~inside).alias("Outliers"))
    return null_safe_join(q.drop("_lo", "_hi"), agg, k).select(
        *k, "N", "Q1", "Median", "Q3", "LowerWhisker", "UpperWhisker", "Outliers")


def stint_length_box(valid: DataFrame, compounds: Sequence[str] = DRY_COMPOUNDS) -> DataFrame:
    """Box-plot numbers of stint length (max tyre age per stint) per compound."""
    stints = stint_stats(valid.where(F.col("Compound").isin(list(compounds))))
    return box_stats(stints, ["Compound"], "StintLength")


def laptime_box(valid: DataFrame, keys: Sequence[str] = ("GrandPrix", "Compound")) -> DataFrame:
    """Box-plot numbers of LapTime per race and compound."""
    return box_stats(valid.where(F.col("Compound").isNotNull()), keys, "LapTime")
