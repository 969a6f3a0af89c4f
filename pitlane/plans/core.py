"""Queries over the medallion layers: sources, silver, gold, joins (S, C, G, L, J, U)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitlane import fixtures as fx
from pitlane import sources as src
from pitlane.operators import clean, enrich, gold
from pitlane.plans.catalog import laps, query, race_laps
from pitlane.session import scratch_path
from pitlane.sources import sinks
from pitlane.plans.sqlparts import (
    lap_projection, r6, with_driver_stats, with_laps, with_silver,
)

SILVER_COLS = lap_projection() + ", " + r6("SectorSum") + ", TimeMismatch, CompoundStd, " + r6(
    "FastestLapTime", "DeltaToFastest")


@query("silver_filter", with_laps() + f"\nSELECT {lap_projection()} FROM laps "
       "WHERE LapTime IS NOT NULL AND LapTime > 0 AND IsAccurate")
def q_silver_filter(spark, sf):
    return clean.silver_filter(laps(spark, sf))


@query("sector_mismatch", with_laps() + f"""
SELECT {lap_projection()}, round(Sector1Time + Sector2Time + Sector3Time, 6) AS SectorSum,
  coalesce(abs(LapTime - (Sector1Time + Sector2Time + Sector3Time)) > 0.1, false) AS TimeMismatch
FROM laps""")
def q_sector_mismatch(spark, sf):
    return clean.sector_mismatch(laps(spark, sf))


@query("compound_std", with_laps() + """
SELECT Compound, CASE WHEN Compound IN ('SOFT', 'MEDIUM', 'HARD', 'INTERMEDIATE', 'WET')
  THEN Compound ELSE 'UNKNOWN' END AS CompoundStd, count(*) AS Laps
FROM laps GROUP BY ALL""")
def q_compound_std(spark, sf):
    return clean.compound_std(laps(spark, sf)).groupBy("Compound", "CompoundStd").agg(
        F.count(F.lit(1)).alias("Laps"))


@query("session_fastest", with_laps() + """
SELECT GrandPrix, Session, round(min(LapTime), 6) AS FastestLapTime, count(*) AS Laps
FROM laps GROUP BY GrandPrix, Session""")
def q_session_fastest(spark, sf):
    """W1 per session (the window value, one row per session)."""
    return clean.session_fastest(laps(spark, sf)).groupBy("GrandPrix", "Session").agg(
        F.first("FastestLapTime").alias("FastestLapTime"), F.count(F.lit(1)).alias("Laps"))


@query("delta_to_fastest", with_laps() + f"""
SELECT {lap_projection()}, round(min(LapTime) OVER (PARTITION BY GrandPrix, Session), 6) AS FastestLapTime,
  round(LapTime - min(LapTime) OVER (PARTITION BY GrandPrix, Session), 6) AS DeltaToFastest
FROM laps""")
def q_delta_to_fastest(spark, sf):
    return clean.delta_to_fastest(laps(spark, sf))


@query("dedup_laps", with_laps("laps_dup") + f"""
SELECT {lap_projection()} FROM (
  SELECT *, row_number() OVER (PARTITION BY GrandPrix, Session, Driver, LapNumber
    ORDER BY LapTime NULLS FIRST, Compound NULLS FIRST, TyreLife NULLS FIRST) AS rn FROM laps_dup)
WHERE rn = 1""")
def q_dedup_laps(spark, sf):
    return clean.dedup_laps(spark.sql(fx.LAPS_DUP_SQL, laps=laps(spark, sf)))


@query("silver_laps", with_silver() + f"\nSELECT {SILVER_COLS} FROM silver")
def q_silver_laps(spark, sf):
    return clean.silver_laps(laps(spark, sf))


@query("driver_stats", with_driver_stats() + """
SELECT GrandPrix, Session, Driver, DriverNumber, TotalLaps, round(FastestLap, 6) AS FastestLap,
  round(AvgLapTime, 6) AS AvgLapTime, round(StdDevLapTime, 6) AS StdDevLapTime,
  round(AvgDeltaToFastest, 6) AS AvgDeltaToFastest, TireCompoundsUsed, PitStops,
  round(ConsistencyScore, 6) AS ConsistencyScore
FROM driver_stats""")
def q_driver_stats(spark, sf):
    return gold.driver_stats(clean.silver_laps(laps(spark, sf)))


@query("tyre_stats", with_silver() + """
SELECT GrandPrix, Circuit, CompoundStd, count(LapNumber) AS LapCount, round(avg(LapTime), 6) AS AvgLapTime,
  round(min(LapTime), 6) AS BestLapTime, round(avg(TyreLife), 6) AS AvgTyreLife,
  round(max(TyreLife), 6) AS MaxTyreLife, round(stddev_samp(LapTime), 6) AS StdDevLapTime,
  round(stddev_samp(LapTime) / nullif(avg(TyreLife), 0), 6) AS EstimatedDegradation
FROM silver WHERE CompoundStd <> 'UNKNOWN' GROUP BY GrandPrix, Circuit, CompoundStd""")
def q_tyre_stats(spark, sf):
    return gold.tyre_stats(clean.silver_laps(laps(spark, sf)))


@query("top_drivers", with_driver_stats() + """
SELECT Driver, round(FastestLap, 6) AS FastestLap, round(AvgLapTime, 6) AS AvgLapTime,
  round(ConsistencyScore, 6) AS ConsistencyScore
FROM driver_stats ORDER BY FastestLap, Driver, GrandPrix, Session LIMIT 5""")
def q_top_drivers(spark, sf):
    return gold.top_drivers(gold.driver_stats(clean.silver_laps(laps(spark, sf))))


# ---- sources and sinks (S1, S3, S4, S5, C7, C8, U2) ----------------------------

@query("load_season", with_laps() + f"\nSELECT {lap_projection()} FROM laps WHERE Session = 'Race'")
def q_load_season(spark, sf):
    """S1 + U1: laps land partitioned by GrandPrix; one pruned read loads the season's races."""
    path = scratch_path(spark, "season")
    sinks.write_table(laps(spark, sf), path, partition_by=["GrandPrix"])
    return src.load_season(spark, path, races=None, session="Race")


@query("union_races", with_laps() + f"\nSELECT {lap_projection()} FROM laps")
def q_union_races(spark, sf):
    """One folder per race, loaded as a list of paths; a path that isn't there is left out."""
    path = scratch_path(spark, "races")
    sinks.write_table(laps(spark, sf), path, partition_by=["GrandPrix"])
    races = [r.GrandPrix for r in laps(spark, sf).select("GrandPrix").distinct().collect()]  # a season's races
    return src.load_season(spark, [f"{path}/GrandPrix={gp}" for gp in races] + [f"{path}/GrandPrix=Atlantis"])


@query("write_table", with_silver() + f"\nSELECT {SILVER_COLS} FROM silver")
def q_write_table(spark, sf):
    """Silver written partitioned by (GrandPrix, Session) and read back."""
    path = scratch_path(spark, "silver")
    sinks.write_table(clean.silver_laps(laps(spark, sf)), path, partition_by=["GrandPrix", "Session"])
    return spark.read.parquet(path)


@query("export_laps", with_silver() + "\nSELECT count(*) AS Laps, count(DISTINCT GrandPrix) AS Races FROM silver")
def q_export_laps(spark, sf):
    """CSV export of silver laps; lap and race counts read from the written files."""
    return sinks.export_laps(clean.silver_laps(laps(spark, sf)), scratch_path(spark, "export"))


@query("export_values", with_silver() + """
SELECT GrandPrix, Circuit, Session, Driver, round(LapNumber, 6) AS LapNumber, round(LapTime, 6) AS LapTime, Compound,
  round(TyreLife, 6) AS TyreLife, round(Stint, 6) AS Stint, FreshTyre, round(Sector1Time, 6) AS Sector1Time,
  round(Sector2Time, 6) AS Sector2Time, round(Sector3Time, 6) AS Sector3Time FROM silver""")
def q_export_values(spark, sf):
    """Every value of the export, read back from the CSV files."""
    silver, path = clean.silver_laps(laps(spark, sf)), scratch_path(spark, "export")
    sinks.export_laps(silver, path)
    return sinks.read_export(spark, path, sinks.export_columns(silver).schema)


def _interval_laps(spark, sf):
    """Laps as the upstream loader delivers them: lap and sector times as intervals."""
    df = laps(spark, sf)
    return df.withColumns({c: F.make_dt_interval(secs=F.col(c).cast("decimal(18,6)"))
                           for c in src.TIME_COLUMNS})


@query("bronze_laps", with_laps() + f"\nSELECT {lap_projection()}, 'fastf1_api' AS record_source FROM laps")
def q_bronze_laps(spark, sf):
    return src.bronze_laps(_interval_laps(spark, sf)).drop("ingestion_timestamp")


@query("to_seconds", with_laps() + "\nSELECT GrandPrix, Session, Driver, "
       + r6("LapNumber", "LapTime", "Sector1Time", "Sector2Time", "Sector3Time") + " FROM laps")
def q_to_seconds(spark, sf):
    return src.to_seconds(_interval_laps(spark, sf)).select(
        "GrandPrix", "Session", "Driver", "LapNumber", *src.TIME_COLUMNS)


@query("valid_laps", with_laps() + f"""
SELECT {lap_projection()} FROM laps WHERE Session = 'Race' AND LapTime IS NOT NULL AND IsAccurate
  AND Compound IS NOT NULL AND TyreLife IS NOT NULL AND TyreLife <= 40""")
def q_valid_laps(spark, sf):
    return clean.valid_laps(race_laps(spark, sf), need_compound=True, need_age=True, max_age=40)


@query("distinct_compounds", with_laps() + "\nSELECT DISTINCT GrandPrix, Session, Compound FROM laps")
def q_distinct_compounds(spark, sf):
    """Distinct values (the reference's unique() lists)."""
    return laps(spark, sf).select("GrandPrix", "Session", "Compound").distinct()


# ---- joins (J1, J2) ------------------------------------------------------------

@query("weather_join", with_laps("weather") + """
SELECT l.GrandPrix, l.Session, count(*) AS JoinedRows, count(w.WeatherId) AS MatchedRows,
  round(min(w.AirTemp), 6) AS MinAirTemp, round(max(w.TrackTemp), 6) AS MaxTrackTemp,
  count(*) FILTER (WHERE w.Rainfall) AS RainRows, round(avg(l.LapTime), 6) AS AvgLapTime
FROM laps l LEFT JOIN weather w ON l.GrandPrix = w.GrandPrix AND l.Session = w.Session
GROUP BY l.GrandPrix, l.Session""")
def q_weather_join(spark, sf):
    """J1 summarised per session; the oracle materialises the fan-out, Spark does not."""
    return enrich.weather_join_summary(laps(spark, sf), fx.view(spark, sf, "weather"))


@query("weather_asof", with_laps("weather") + """
SELECT GrandPrix, Session, Driver, round(LapNumber, 6) AS LapNumber, round(Time, 6) AS Time,
  round(WeatherTime, 6) AS WeatherTime, WeatherId, round(AirTemp, 6) AS AirTemp,
  round(TrackTemp, 6) AS TrackTemp, Rainfall
FROM (
  SELECT l.GrandPrix, l.Session, l.Driver, l.LapNumber, l.Time, w.Time AS WeatherTime, w.WeatherId,
    w.AirTemp, w.TrackTemp, w.Rainfall,
    row_number() OVER (PARTITION BY l.GrandPrix, l.Session, l.Driver, l.LapNumber
                       ORDER BY w.Time DESC NULLS LAST, w.WeatherId DESC NULLS LAST) AS rn
  FROM laps l LEFT JOIN weather w
    ON l.GrandPrix = w.GrandPrix AND l.Session = w.Session AND w.Time <= l.Time)
WHERE rn = 1""")
def q_weather_asof(spark, sf):
    out = enrich.weather_asof(laps(spark, sf), fx.view(spark, sf, "weather"))
    return out.select("GrandPrix", "Session", "Driver", "LapNumber", "Time", "WeatherTime", "WeatherId",
                      "AirTemp", "TrackTemp", "Rainfall")


@query("weather_nearest", with_laps("weather") + """,
best AS (SELECT GrandPrix, Session, Time AS WeatherTime, max(WeatherId) AS WeatherId FROM weather GROUP BY GrandPrix, Session, Time),
n AS (
  SELECT l.GrandPrix, l.Session, l.Driver, l.LapNumber, l.Time, a.WeatherTime AS t0, a.WeatherId AS w0, b.WeatherTime AS t1, b.WeatherId AS w1
  FROM laps l ASOF LEFT JOIN best a ON l.GrandPrix = a.GrandPrix AND l.Session = a.Session AND l.Time >= a.WeatherTime
  ASOF LEFT JOIN best b ON l.GrandPrix = b.GrandPrix AND l.Session = b.Session AND l.Time < b.WeatherTime),
c AS (SELECT *, CASE WHEN t1 IS NULL OR l_time - t0 <= t1 - l_time THEN w0 ELSE w1 END AS WeatherId FROM (SELECT *, Time AS l_time FROM n)),
m AS (SELECT c.GrandPrix, c.Session, c.Driver, c.LapNumber, c.l_time AS Time, w.Time AS WeatherTime, w.WeatherId, w.AirTemp, w.TrackTemp, w.Rainfall
      FROM c LEFT JOIN weather w ON c.WeatherId = w.WeatherId AND abs(w.Time - c.l_time) <= 600)
SELECT GrandPrix, Session, Driver, round(LapNumber, 6) AS LapNumber, round(Time, 6) AS Time, round(WeatherTime, 6) AS WeatherTime,
  WeatherId, round(AirTemp, 6) AS AirTemp, round(TrackTemp, 6) AS TrackTemp, Rainfall FROM m""")
def q_weather_nearest(spark, sf):
    """The sample nearest in time, within ten minutes."""
    out = enrich.weather_nearest(laps(spark, sf), fx.view(spark, sf, "weather"), tolerance=600.0)
    return out.select("GrandPrix", "Session", "Driver", "LapNumber", "Time", "WeatherTime", "WeatherId",
                      "AirTemp", "TrackTemp", "Rainfall")


@query("track_conditions", with_laps("weather") + """,
s AS (SELECT GrandPrix, Session, Time AS Start, arg_max(Rainfall, WeatherId) AS Status FROM weather GROUP BY GrandPrix, Session, Time),
g AS (SELECT *, lag(Status) OVER (PARTITION BY GrandPrix, Session ORDER BY Start) AS was FROM s),
iv AS (SELECT GrandPrix, Session, Status, Start, coalesce(lead(Start) OVER (PARTITION BY GrandPrix, Session ORDER BY Start), 1e18) AS Stop
       FROM g WHERE was IS NULL OR was <> Status),
x AS (
  SELECT l.GrandPrix, l.Session, l.Driver, l.LapNumber,
    sum(least(l.Time, iv.Stop) - greatest(l.Time - l.LapTime, iv.Start)) AS CoveredSeconds,
    sum(CASE WHEN Status THEN least(l.Time, iv.Stop) - greatest(l.Time - l.LapTime, iv.Start) ELSE 0 END) AS WetSeconds,
    count(*) AS n, count(*) FILTER (WHERE Status) AS n_wet
  FROM laps l JOIN iv ON l.GrandPrix = iv.GrandPrix AND l.Session = iv.Session AND l.LapTime > 0
    AND iv.Start < l.Time AND iv.Stop > l.Time - l.LapTime
  GROUP BY l.GrandPrix, l.Session, l.Driver, l.LapNumber),
c AS (SELECT l.GrandPrix, l.Session, l.Driver, l.LapNumber, l.Compound, x.CoveredSeconds, x.WetSeconds,
        CASE WHEN n IS NULL THEN 'unknown' WHEN n_wet = 0 THEN 'dry' WHEN n_wet = n THEN 'wet' ELSE 'mixed' END AS Condition
      FROM laps l LEFT JOIN x USING (GrandPrix, Session, Driver, LapNumber))
SELECT GrandPrix, Session, Driver, round(LapNumber, 6) AS LapNumber, Compound, round(CoveredSeconds, 6) AS CoveredSeconds,
  round(WetSeconds, 6) AS WetSeconds, Condition,
  CASE WHEN Condition = 'wet' AND Compound NOT IN ('INTERMEDIATE', 'WET') THEN 'dry-weather tyre on a wet track'
       WHEN Condition = 'dry' AND Compound IN ('INTERMEDIATE', 'WET') THEN 'wet-weather tyre on a dry track' END AS TyreIssue FROM c""")
def q_track_conditions(spark, sf):
    """Track condition validation: wet or dry while each lap was driven, and whether its tyre fits."""
    out = enrich.track_conditions(laps(spark, sf), fx.view(spark, sf, "weather"))
    return out.select("GrandPrix", "Session", "Driver", "LapNumber", "Compound", "CoveredSeconds", "WetSeconds", "Condition", "TyreIssue")
