"""DuckDB oracle building blocks: CTE texts for the derived lap layers."""

from __future__ import annotations

from pitlane import fixtures as fx

# double columns of the laps view, rounded in every oracle projection
LAP_DOUBLES = ("LapNumber", "Time", "LapTime", "Sector1Time", "Sector2Time", "Sector3Time",
               "TyreLife", "Stint", "PitInTime", "PitOutTime")
LAP_OTHERS = ("GrandPrix", "Circuit", "Session", "Driver", "DriverNumber", "Compound",
              "FreshTyre", "IsAccurate")


def r6(*cols: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


def lap_projection(prefix: str = "") -> str:
    return ", ".join([f"{prefix}{c} AS {c}" for c in LAP_OTHERS]
                     + [f"round({prefix}{c}, 6) AS {c}" for c in LAP_DOUBLES])


SILVER_CTES = """,
silver_m AS (
  SELECT *, Sector1Time + Sector2Time + Sector3Time AS SectorSum,
    coalesce(abs(LapTime - (Sector1Time + Sector2Time + Sector3Time)) > 0.1, false) AS TimeMismatch,
    CASE WHEN Compound IN ('SOFT', 'MEDIUM', 'HARD', 'INTERMEDIATE', 'WET') THEN Compound ELSE 'UNKNOWN' END AS CompoundStd,
    min(LapTime) OVER (PARTITION BY GrandPrix, Session) AS FastestLapTime
  FROM laps WHERE LapTime IS NOT NULL AND LapTime > 0 AND IsAccurate),
silver AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, LapTime - FastestLapTime AS DeltaToFastest,
      row_number() OVER (PARTITION BY GrandPrix, Session, Driver, LapNumber
                         ORDER BY LapTime, Compound NULLS FIRST, TyreLife NULLS FIRST) AS rn
    FROM silver_m) WHERE rn = 1)
"""

DRIVER_STATS_CTE = """,
driver_stats AS (
  SELECT GrandPrix, Session, Driver, DriverNumber,
    count(LapNumber) AS TotalLaps, min(LapTime) AS FastestLap, avg(LapTime) AS AvgLapTime,
    stddev_samp(LapTime) AS StdDevLapTime, avg(DeltaToFastest) AS AvgDeltaToFastest,
    count(DISTINCT CompoundStd) AS TireCompoundsUsed,
    CAST(sum(CASE WHEN PitInTime IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS PitStops,
    stddev_samp(LapTime) / nullif(avg(LapTime), 0) AS ConsistencyScore
  FROM silver GROUP BY GrandPrix, Session, Driver, DriverNumber)
"""


def with_laps(*extra_views: str) -> str:
    return fx.oracle_ctes("laps", *extra_views).rstrip()


def with_silver() -> str:
    return with_laps() + SILVER_CTES.rstrip()


def with_driver_stats() -> str:
    return with_silver() + DRIVER_STATS_CTE.rstrip()
