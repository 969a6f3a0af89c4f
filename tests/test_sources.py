"""Sources and sinks: season loading, export columns, bronze intake."""

import os
import tempfile

from pyspark.sql import functions as F

from pitlane.plans import catalog
from pitlane.sources import export_columns, export_laps, load_season, season_2024, write_table
from tests.conftest import SF001


def test_load_season_skips_missing_races(spark):
    laps = catalog.laps(spark, SF001)
    base = tempfile.mkdtemp(prefix="pitlane-season-test-")
    races = [r.GrandPrix for r in laps.select("GrandPrix").distinct().limit(2).collect()]
    for gp in races:
        write_table(laps.where(F.col("GrandPrix") == gp), f"{base}/{gp}")
    got = load_season(spark, [f"{base}/{gp}" for gp in races] + [f"{base}/Atlantis"], session="Race")
    want = laps.where(F.col("GrandPrix").isin(races) & (F.col("Session") == "Race"))
    assert got.count() == want.count()
    assert load_season(spark, [f"{base}/Atlantis"]) is None


def test_load_season_partition_pruning(spark):
    laps = catalog.laps(spark, SF001)
    path = write_table(laps, tempfile.mkdtemp(prefix="pitlane-season-test-") + "/t", partition_by=["GrandPrix"])
    one = laps.select("GrandPrix").first().GrandPrix
    df = load_season(spark, path, races=[one])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and df.count() == laps.where(F.col("GrandPrix") == one).count()


def test_export_columns_and_counts(spark):
    laps = catalog.laps(spark, SF001)
    assert export_columns(laps.drop("Circuit", "FreshTyre")).columns == [
        "GrandPrix", "Session", "Driver", "LapNumber", "LapTime", "Compound", "TyreLife", "Stint",
        "Sector1Time", "Sector2Time", "Sector3Time"]
    r = export_laps(laps, tempfile.mkdtemp(prefix="pitlane-export-test-") + "/csv").first()
    assert r.Laps == laps.count() and r.Races == laps.select("GrandPrix").distinct().count()


def test_load_season_takes_partition_folders_and_skips_unreadable(spark):
    laps = catalog.laps(spark, SF001)
    base = tempfile.mkdtemp(prefix="pitlane-season-test-")
    path = write_table(laps, f"{base}/t", partition_by=["GrandPrix"])
    races = sorted(r.GrandPrix for r in laps.select("GrandPrix").distinct().collect())[:3]
    bad = f"{base}/t/GrandPrix=Broken"
    os.makedirs(bad)
    with open(f"{bad}/part-0.parquet", "wb") as f:
        f.write(b"PAR1 this is no parquet file")
    skipped = []
    got = load_season(spark, [f"{path}/GrandPrix={gp}" for gp in races] + [bad], races=races[:2], skipped=skipped)
    want = laps.where(F.col("GrandPrix").isin(races[:2]))
    assert got.select(*sorted(want.columns)).exceptAll(want.select(*sorted(want.columns))).count() == 0
    assert got.count() == want.count()
    assert [p for p, _ in skipped] == [bad] and skipped[0][1]


def test_default_season_filters_races_and_session(spark):
    laps = catalog.laps(spark, SF001).withColumn("GrandPrix", F.when(F.col("LapNumber") < 5, "Monaco").otherwise("Elsewhere"))
    got = season_2024(spark, laps)
    assert got.count() == laps.where("GrandPrix = 'Monaco' and Session = 'Race'").count()


def test_a_thousand_paths_take_a_bounded_number_of_jobs(spark):
    base = tempfile.mkdtemp(prefix="pitlane-season-test-")
    laps = catalog.laps(spark, SF001)
    gp = laps.first().GrandPrix
    one = write_table(laps.where(F.col("GrandPrix") == gp).limit(1).coalesce(1), f"{base}/one")
    part = next(f for f in os.listdir(one) if f.endswith(".parquet"))
    paths = [f"{base}/race %20+{i}" for i in range(1000)]
    for i, path in enumerate(paths):
        os.makedirs(path)
        if i != 998:
            os.link(f"{one}/{part}", f"{path}/{part}")
    with open(f"{paths[7]}/torn.parquet", "wb") as f:
        f.write(b"PAR1 this is no parquet file PAR1")
    empty = write_table(laps.limit(0), f"{base}/empty")
    tracker, group = spark.sparkContext.statusTracker(), "bounded-jobs"
    spark.sparkContext.setJobGroup(group, group)
    skipped = []
    got = load_season(spark, [*paths, empty, f"{base}/nowhere"], skipped=skipped)
    jobs = len(tracker.getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 12, jobs
    assert [p for p, _ in skipped] == [paths[7], paths[998], f"{base}/nowhere"]
    assert "arquet" in skipped[0][1] and got.count() == 998
