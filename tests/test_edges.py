"""Edge rules from SURVEY §1.4: ties, bins, histogram edges, whiskers, pairs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pitlane.functions import round_doubles
from pitlane.functions.scalar import interval_seconds
from pitlane.operators import compare, features, tyres


def test_fastest_compound_tie_is_alphabetical_d11(spark):
    perf = spark.createDataFrame([("G", "SOFT", 90.0, 90.0, 5), ("G", "HARD", 90.0, 91.0, 5), ("G", "MEDIUM", 91.0, 91.0, 5)],
                                 "GrandPrix string, Compound string, MedianLapTime double, MeanLapTime double, LapCount long")
    assert tyres.fastest_compound(perf).first().Compound == "HARD"


def test_fastest_lap_tie_breaks_on_driver_then_lap_d12(spark):
    laps = spark.createDataFrame([("G", "SOFT", 80.0, 7.0, "ZED"), ("G", "SOFT", 80.0, 3.0, "ABE"),
                                  ("G", "SOFT", 80.0, 1.0, "ABE"), ("G", "SOFT", 81.0, 2.0, "AAA")],
                                 "GrandPrix string, Compound string, LapTime double, LapNumber double, Driver string")
    r = compare.fastest_lap_by_compound(laps).first()
    assert (r.Driver, r.LapNumber) == ("ABE", 1.0)


def test_progress_bins_right_closed_d10(spark):
    df = spark.createDataFrame([("G", "R", "A", float(n)) for n in (1, 2, 3, 4)],
                               "GrandPrix string, Session string, Driver string, LapNumber double")
    got = {r.LapNumber: r.LapNumberBin for r in features.progress_features(df).collect()}
    assert got == {1.0: "Early", 2.0: "EarlyMid", 3.0: "LateMid", 4.0: "Late"}


def test_histogram_last_bin_closed_and_zero_range(spark):
    df = spark.createDataFrame([("A", float(x)) for x in (0, 1, 2, 3)] + [("B", 5.0), ("B", 5.0)],
                               "GrandPrix string, LapTime double")
    h = {(r.GrandPrix, r.Bin): r.Count for r in compare.laptime_histogram(df, bins=3).collect()}
    assert [h[("A", b)] for b in range(3)] == [1, 1, 2]  # numpy: [0,1), [1,2), [2,3]
    assert [h[("B", b)] for b in range(3)] == [0, 2, 0]  # zero range widens to +-0.5


def test_box_whiskers_and_outliers(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([("X", v) for v in vals], "k string, v double")
    r = round_doubles(tyres.box_stats(df, ["k"], "v")).first()
    # Q1 2, Q3 4, IQR 2 -> whiskers within [-1, 7]
    assert (r.Q1, r.Median, r.Q3, r.LowerWhisker, r.UpperWhisker, r.Outliers, r.N) == (2.0, 3.0, 4.0, 1.0, 4.0, 1, 5)


def test_compare_two_races_needs_both(spark):
    df = spark.createDataFrame([("A", "SOFT", 90.0, 1.0), ("B", "SOFT", 91.0, 2.0), ("B", "HARD", 92.0, 3.0)],
                               "GrandPrix string, Compound string, LapTime double, TyreLife double")
    assert compare.compare_two_races(df, "A", "B", "SOFT").count() == 2
    assert compare.compare_two_races(df, "A", "B", "HARD").count() == 0


def test_interval_seconds_keeps_minutes_and_micros(spark):
    df = spark.createDataFrame([(dt.timedelta(minutes=1, seconds=30, microseconds=123456),)], "t interval day to second")
    assert df.select(interval_seconds("t").alias("s")).first().s == 90.123456


def test_degradation_band_edges(spark):
    deg = spark.createDataFrame([("A", 0.04999), ("B", 0.05), ("C", 0.10), ("D", 0.10001), ("E", None)],
                                "Compound string, DegradationRate double")
    got = {r.Compound: r.DegradationBand for r in tyres.degradation_band(deg).collect()}
    assert got == {"A": "minimal", "B": "normal", "C": "normal", "D": "high", "E": None}


def test_optimal_stint_falls_back_to_max_age(spark):
    # flat pace: no smoothed change exceeds its own 75% quantile -> largest kept age
    rows = [("SOFT", "G", "D", 1.0, float(a), 90.0) for a in range(1, 9) for _ in range(15)]
    df = spark.createDataFrame(rows, "Compound string, GrandPrix string, Driver string, Stint double, "
                                     "TyreLife double, LapTime double")
    r = tyres.optimal_stint(df).first()
    assert (r.OptimalMaxAge, r.LongestStint, r.TotalStints, r.MostCommonStint) == (8.0, 8.0, 1, 8.0)


def test_laps_into_stint_null_stint(spark):
    df = spark.createDataFrame([("G", "R", "A", 1.0, 1.0), ("G", "R", "A", 2.0, None), ("G", "R", "A", 3.0, 1.0)],
                               "GrandPrix string, Session string, Driver string, LapNumber double, Stint double")
    got = {r.LapNumber: r.LapsIntoStint for r in features.laps_into_stint(df).collect()}
    assert got == {1.0: 1, 2.0: None, 3.0: 2}


def test_track_evolution_skips_null_times(spark):
    df = spark.createDataFrame([("G", "R", "B", 1.0, 91.0), ("G", "R", "A", 1.0, 89.0), ("G", "R", "A", 2.0, None),
                                ("G", "R", "B", 2.0, 90.0)],
                               "GrandPrix string, Session string, Driver string, LapNumber double, LapTime double")
    got = {(r.Driver, r.LapNumber): r.TrackEvolution for r in features.track_evolution(df).collect()}
    assert got[("A", 1.0)] == 89.0 and got[("B", 1.0)] == 90.0 and got[("A", 2.0)] == 90.0
    assert got[("B", 2.0)] == 90.0


def test_pit_checks_follow_available_columns(spark):
    from pitlane.operators import quality
    df = spark.createDataFrame([(1.0, 5.0), (2.0, None)], "LapNumber double, PitInTime double")
    r = quality.pit_completeness(df).first()
    assert (r.PitLaps, r.PitLapsWithOut, r.Severity) == (1, None, "ok")
    r = quality.pit_completeness(df.drop("PitInTime")).first()
    assert r.Severity == "unavailable"


def test_label_codes_number_many_labels_without_one_task(spark):
    n = 200_000
    df = spark.range(n).selectExpr("concat('D', cast(id as string)) AS Driver", "if(id % 3 = 0, NULL, 'x') AS Team")
    codes = features.label_codes(df, ["Driver", "Team"], bucket_values=1024)
    got = codes.where("Field = 'Driver'")
    want = {name: i for i, name in enumerate(sorted(f"D{i}" for i in range(n)))}
    assert {r.Label: r.Code for r in got.collect()} == want
    assert sorted((r.Label, r.Code) for r in codes.where("Field = 'Team'").collect()) == [("None", 0), ("x", 1)]
    per_range = got.groupBy(F.floor(F.col("Code") / 8192)).count()
    assert per_range.count() == 25
    plan = codes._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_new_data_is_encoded_alike_and_an_unseen_label_raises(spark):
    rows = [("b", 1.0, 90.0), ("a", 2.0, 91.0), (None, None, 92.0)]
    df = spark.createDataFrame(rows, "Driver string, TyreLife double, LapTime double")
    out, codes, medians, inputs = features.encode_impute(df)
    assert inputs == ["Driver", "TyreLife"] and medians == {"TyreLife": 1.5}
    assert sorted((r.Driver or "", r.features.tolist()) for r in out.collect()) == [("", [0.0, 1.5]), ("a", [1.0, 2.0]), ("b", [2.0, 1.0])]
    again = features.encode_impute(df.where("Driver = 'b'"), codes, medians)[0].first()
    assert again.features.tolist() == [2.0, 1.0]
    new = spark.createDataFrame([("zzz", 1.0, 1.0)], df.schema)
    with pytest.raises(Exception, match="no code for this label of Driver"):
        features.encode_impute(new, codes, medians)[0].collect()
