"""Golden mini-tables (FIXTURES.md §B) with hand-derived results."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pitlane.functions import group_quantiles, round_doubles
from pitlane.operators import clean, features, gold, quality, strategy
from pitlane.schema import LAPS_SCHEMA, conform
from pitlane.sources import bronze_laps, from_pandas


def mini_laps(spark):
    rows = [("VER", "1", 1.0, 90.5, 30.1, 30.2, 30.2, "SOFT", 1.0),
            ("VER", "1", 2.0, 89.8, 29.8, 30.0, 30.0, "SOFT", 2.0),
            ("HAM", "44", 1.0, 91.2, 30.5, 30.4, 30.3, "MEDIUM", 1.0),
            ("HAM", "44", 2.0, 90.1, 30.0, 30.1, 30.0, "MEDIUM", 2.0)]
    df = spark.createDataFrame(rows, "Driver string, DriverNumber string, LapNumber double, LapTime double, "
                                     "Sector1Time double, Sector2Time double, Sector3Time double, "
                                     "Compound string, TyreLife double")
    df = df.withColumns({"IsAccurate": F.lit(True), "GrandPrix": F.lit("Bahrain GP"), "Session": F.lit("Race"),
                         "Circuit": F.lit("Bahrain")})
    return conform(df, LAPS_SCHEMA)


def test_silver_and_gold_b1(spark):
    silver = clean.silver_laps(mini_laps(spark))
    s = {(r.Driver, r.LapNumber): r for r in round_doubles(silver).collect()}
    assert len(s) == 4
    assert s[("VER", 1.0)].SectorSum == 90.5 and s[("HAM", 2.0)].SectorSum == 90.1
    assert not any(r.TimeMismatch for r in s.values())
    assert {r.FastestLapTime for r in s.values()} == {89.8}
    assert [s[k].DeltaToFastest for k in [("VER", 1.0), ("VER", 2.0), ("HAM", 1.0), ("HAM", 2.0)]] == [0.7, 0.0, 1.4, 0.3]
    d = {r.Driver: r for r in round_doubles(gold.driver_stats(silver)).collect()}
    ver, ham = d["VER"], d["HAM"]
    assert (ver.TotalLaps, ver.FastestLap, ver.AvgLapTime, ver.StdDevLapTime) == (2, 89.8, 90.15, 0.494975)
    assert (ver.AvgDeltaToFastest, ver.TireCompoundsUsed, ver.PitStops, ver.ConsistencyScore) == (0.35, 1, 0, 0.005491)
    assert (ham.TotalLaps, ham.FastestLap, ham.AvgLapTime, ham.StdDevLapTime) == (2, 90.1, 90.65, 0.777817)
    assert (ham.AvgDeltaToFastest, ham.ConsistencyScore) == (0.85, 0.00858)
    t = {r.CompoundStd: r for r in round_doubles(gold.tyre_stats(silver)).collect()}
    soft = t["SOFT"]
    assert (soft.LapCount, soft.AvgLapTime, soft.BestLapTime, soft.AvgTyreLife) == (2, 90.15, 89.8, 1.5)
    assert (soft.MaxTyreLife, soft.StdDevLapTime, soft.EstimatedDegradation) == (2.0, 0.494975, 0.329983)


def validator_laps(spark):
    lap_times = [92.1, 90.5, 89.8, 90.2, 90.1, 105.3, 91.2, 90.8, 90.5, 91.0]
    s1 = [30.0, 29.8, 29.7, 29.9, 29.8, 35.0, 30.1, 29.9, 29.8, 30.0]
    s2 = [31.0, 30.4, 30.1, 30.2, 30.2, 35.2, 30.8, 30.5, 30.4, 30.7]
    s3 = [31.1, 30.3, 30.0, 30.1, 30.1, 35.1, 30.3, 30.4, 30.3, 30.3]
    comp = ["SOFT"] * 6 + ["MEDIUM"] * 4
    life = [1, 2, 3, 4, 5, 1, 1, 2, 3, 4]
    stint = [1] * 5 + [2] * 5
    rows = [("VER", i + 1, lap_times[i], s1[i], s2[i], s3[i], comp[i], life[i], float(stint[i]),
             5400.0 if i == 5 else None) for i in range(10)]
    df = spark.createDataFrame(rows, "Driver string, LapNumber int, LapTime double, Sector1Time double, "
                                     "Sector2Time double, Sector3Time double, Compound string, TyreLife int, "
                                     "Stint double, PitInTime double")
    return df.withColumns({"IsAccurate": F.lit(True), "GrandPrix": F.lit("Bahrain GP"), "Session": F.lit("Race"),
                           "Circuit": F.lit("Bahrain"), "PitOutTime": F.lit(None).cast("double")})


def test_validator_b2(spark):
    df = validator_laps(spark)
    assert all(r.Passed for r in quality.lap_schema_check(df).collect())
    sc = quality.sector_correlation(df).first()
    assert (sc.Checked, sc.Mismatches, sc.Severity) == (10, 0, "ok")
    out = quality.lap_outliers(df).collect()
    assert [r.LapNumber for r in out] == [6]
    assert [r.OutlierCount for r in quality.outlier_counts(quality.lap_outliers(df)).collect()] == [1]
    bad = quality.tyre_progression(df).collect()
    assert [(r.GrandPrix, r.Driver, r.Stint) for r in bad] == [("Bahrain GP", "VER", 2.0)]
    pc = quality.pit_completeness(df).first()
    assert (pc.PitLaps, pc.PitLapsWithOut, pc.Completeness, pc.Severity) == (1, 0, 0.0, "warning")
    rep = quality.quality_report(df).first()
    assert (rep.TotalRows, rep.SchemaValid, rep.Issues, rep.Warnings, rep.Passed) == (10, True, 0, 3, True)
    assert quality.cross_compound(df).count() == 0


def test_outlier_bounds_b2(spark):
    df = validator_laps(spark)
    clean_laps = df.where(F.col("PitInTime").isNull())
    q = group_quantiles(clean_laps, ["Driver"], "LapTime", {"q1": 0.25, "q3": 0.75}).first()
    assert round(q.q1, 6) == 90.2 and round(q.q3, 6) == 91.0


def test_pace_prediction_b3(spark):
    curve = spark.createDataFrame([("SOFT", 2.0, 80.0), ("SOFT", 4.0, 81.0), ("SOFT", 5.0, 81.2)],
                                  "Compound string, TyreLife double, MedianLapTime double")
    req = spark.createDataFrame([("SOFT", a) for a in (1, 2, 3, 4, 5, 7)] + [("HYPER", 3)],
                                "Compound string, TyreAge int")
    got = {(r.Compound, r.TyreAge): r.PredictedLapTime
           for r in round_doubles(strategy.predict_pace(req, curve)).collect()}
    assert got[("SOFT", 1)] == 80.0 and got[("SOFT", 2)] == 80.0 and got[("SOFT", 3)] == 80.5
    assert got[("SOFT", 4)] == 81.0 and got[("SOFT", 5)] == 81.2 and got[("SOFT", 7)] == 81.3
    assert got[("HYPER", 3)] is None


def test_default_strategies_b3(spark):
    curve = spark.createDataFrame([(c, float(a), 80.0 + o + 0.05 * a) for c, o in (("SOFT", 0), ("MEDIUM", .4),
                                   ("HARD", .8)) for a in range(1, 41)],
                                  "Compound string, TyreLife double, MedianLapTime double")
    strat = spark.createDataFrame([("Conservative (1-stop)", 1, "HARD", 78), ("Standard (1-stop)", 1, "MEDIUM", 40),
                                   ("Standard (1-stop)", 2, "HARD", 38), ("Aggressive (2-stop)", 1, "SOFT", 25),
                                   ("Aggressive (2-stop)", 2, "MEDIUM", 28), ("Aggressive (2-stop)", 3, "MEDIUM", 25),
                                   ("Alternative (2-stop)", 1, "MEDIUM", 30), ("Alternative (2-stop)", 2, "SOFT", 20),
                                   ("Alternative (2-stop)", 3, "MEDIUM", 28)],
                                  "Strategy string, StintNo int, Compound string, StintLength int")
    res = {r.Strategy: r for r in strategy.compare_strategies(strat, curve).collect()}
    assert {k: (v.TotalLaps, v.NumStops) for k, v in res.items()} == {
        "Conservative (1-stop)": (78, 0), "Standard (1-stop)": (78, 1),
        "Aggressive (2-stop)": (78, 2), "Alternative (2-stop)": (78, 2)}
    assert min(r.TimeDelta for r in res.values()) == 0.0
    tl = strategy.strategy_timeline(strat, curve).where("Strategy = 'Standard (1-stop)'").orderBy("LapNo").collect()
    assert tl[40].CumulativeTime == pytest.approx(sum(r.LapTime for r in tl[:41]) + 25.0)


def test_edge_cases_b5(spark):
    pdf = pd.DataFrame({"GrandPrix": ["G"] * 4, "Session": ["Race"] * 4, "Driver": ["A", "A", "B", "B"],
                        "LapNumber": [1.0, 2.0, 1.0, 2.0],
                        "LapTime": [pd.Timedelta(seconds=90), pd.NaT, pd.Timedelta(seconds=91), pd.Timedelta(seconds=92)],
                        "Sector1Time": [pd.Timedelta(seconds=30)] * 4, "Sector2Time": [pd.NaT] * 4,
                        "Sector3Time": [pd.Timedelta(seconds=30)] * 4,
                        "Compound": [None, "C3", "soft", "SOFT"], "TyreLife": [0.0, 5.0, 6.0, 100.0],
                        "IsAccurate": [True, True, True, True]})
    bronze = bronze_laps(from_pandas(spark, pdf))
    assert bronze.schema["LapTime"].dataType.simpleString() == "double"
    silver = clean.silver_laps(conform(bronze, LAPS_SCHEMA)).collect()
    assert len(silver) == 3  # NaT lap time dropped
    assert {r.Compound: r.CompoundStd for r in silver} == {None: "UNKNOWN", "soft": "UNKNOWN", "SOFT": "SOFT"}
    assert not any(r.TimeMismatch for r in silver)  # NULL sector -> false
    f = {r.TyreLife: r.TyreLifeBin for r in features.tyre_features(conform(bronze, LAPS_SCHEMA)).collect()}
    assert f == {0.0: None, 5.0: "Fresh", 6.0: "Early", 100.0: "VeryOld"}


def test_nan_to_null_d1(spark):
    df = spark.createDataFrame([(float("nan"),), (1.5,)], "LapTime double")
    got = [r.LapTime for r in bronze_laps(df).collect()]
    assert got[0] is None and got[1] == 1.5


def test_one_lap_group_and_zero_divisor(spark):
    df = spark.createDataFrame([("G", "C", "SOFT", 90.0, 0.0, 1.0)],
                               "GrandPrix string, Circuit string, CompoundStd string, LapTime double, "
                               "TyreLife double, LapNumber double")
    r = gold.tyre_stats(df).first()
    assert r.StdDevLapTime is None and r.EstimatedDegradation is None


def test_cummin_with_null(spark):
    df = spark.createDataFrame([("G", "R", "A", 1.0, 91.0), ("G", "R", "A", 2.0, None), ("G", "R", "A", 3.0, 90.0)],
                               "GrandPrix string, Session string, Driver string, LapNumber double, LapTime double")
    got = [(r.BestLapSoFar, r.LapTime_Rolling3) for r in
           features.history_features(df).orderBy("LapNumber").collect()]
    assert got[0] == (91.0, 91.0) and got[1][0] is None and got[1][1] == 91.0 and got[2] == (90.0, 90.5)
    assert not math.isnan(got[2][1])
