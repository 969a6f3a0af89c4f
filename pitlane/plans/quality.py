"""Queries for the data-quality checks (Q1-Q8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitlane import fixtures as fx
from pitlane.operators import quality
from pitlane.plans.catalog import laps, query, race_laps
from pitlane.plans.sqlparts import with_laps
from pitlane.schema import LAP_RULES, LAP_RULES_EXCLUSIVE_LO, TELEMETRY_RULES

_SQL_TYPES = {"int": "('INTEGER', 'BIGINT', 'SMALLINT', 'TINYINT')", "float": "('DOUBLE', 'FLOAT')",
              "string": "('VARCHAR')", "bool": "('BOOLEAN')"}


def schema_sql(table: str, rules, exclusive_lo=()) -> str:
    """The same rule table evaluated in DuckDB, one SELECT per rule."""
    parts = []
    for name, kind, nullable, lo, hi, allowed in rules:
        parts.append(f"SELECT '{name}' AS Field, 'present' AS Rule, true AS Passed, CAST(NULL AS BIGINT) AS Failures")
        parts.append(f"SELECT '{name}', 'dtype', (SELECT typeof({name}) FROM {table} LIMIT 1) IN {_SQL_TYPES[kind]}, NULL")
        if not nullable:
            parts.append(f"SELECT '{name}', 'nullable', count(*) FILTER (WHERE {name} IS NULL) = 0, "
                         f"count(*) FILTER (WHERE {name} IS NULL) FROM {table}")
        conds = []
        if lo is not None:
            conds.append(f"{name} <= {lo}" if name in exclusive_lo else f"{name} < {lo}")
        if hi is not None:
            conds.append(f"{name} > {hi}")
        check = "range"
        if allowed is not None:
            conds = [f"{name} NOT IN ({', '.join(repr(a) for a in allowed)})"]
            check = "isin"
        if conds:
            bad = f"{name} IS NOT NULL AND ({' OR '.join(conds)})"
            parts.append(f"SELECT '{name}', '{check}', count(*) FILTER (WHERE {bad}) = 0, "
                         f"count(*) FILTER (WHERE {bad}) FROM {table}")
    return "\nUNION ALL ".join(parts)


@query("lap_schema_check", with_laps() + "\n" + schema_sql("laps", LAP_RULES, LAP_RULES_EXCLUSIVE_LO))
def q_lap_schema_check(spark, sf):
    return quality.lap_schema_check(laps(spark, sf))


@query("telemetry_schema_check", with_laps("telemetry") + "\n" + schema_sql("telemetry", TELEMETRY_RULES))
def q_telemetry_schema_check(spark, sf):
    return quality.telemetry_schema_check(fx.view(spark, sf, "telemetry"))


Q3_SQL = """,
q3 AS (SELECT count(*) AS Checked,
         count(*) FILTER (WHERE abs(LapTime - (Sector1Time + coalesce(Sector2Time, 0) + coalesce(Sector3Time, 0))) > 0.5) AS Mismatches
       FROM laps WHERE Sector1Time IS NOT NULL),
q3s AS (SELECT *, CASE WHEN Mismatches > 0 THEN Mismatches / Checked * 100 END AS MismatchPct,
          CASE WHEN Mismatches > 0 AND Mismatches / Checked * 100 > 5 THEN 'issue'
               WHEN Mismatches > 0 THEN 'warning' ELSE 'ok' END AS Severity FROM q3)"""


@query("sector_correlation", with_laps() + Q3_SQL + """
SELECT Checked, Mismatches, round(MismatchPct, 6) AS MismatchPct, Severity FROM q3s""")
def q_sector_correlation(spark, sf):
    return quality.sector_correlation(laps(spark, sf))


Q4_SQL = """,
g AS (SELECT GrandPrix, Session, Driver FROM laps GROUP BY GrandPrix, Session, Driver
      HAVING count(*) >= 3 AND count(*) FILTER (WHERE IsAccurate AND PitInTime IS NULL) >= 3),
qq AS (SELECT GrandPrix, Session, Driver, quantile_cont(LapTime, 0.25) AS q1, quantile_cont(LapTime, 0.75) AS q3
       FROM laps WHERE IsAccurate AND PitInTime IS NULL GROUP BY GrandPrix, Session, Driver),
b AS (SELECT g.*, q1 - 3.0 * (q3 - q1) AS lo, q3 + 3.0 * (q3 - q1) AS hi FROM g JOIN qq USING (GrandPrix, Session, Driver)),
q4 AS (SELECT l.GrandPrix, l.Session, l.Driver, round(l.LapNumber, 6) AS LapNumber, round(l.LapTime, 6) AS LapTime
       FROM laps l JOIN b USING (GrandPrix, Session, Driver) WHERE l.LapTime < b.lo OR l.LapTime > b.hi)"""


@query("lap_outliers", with_laps() + Q4_SQL + "\nSELECT * FROM q4")
def q_lap_outliers(spark, sf):
    return quality.lap_outliers(laps(spark, sf))


@query("outlier_counts", with_laps() + Q4_SQL + """
SELECT GrandPrix, Session, Driver, count(*) AS OutlierCount FROM q4 GROUP BY GrandPrix, Session, Driver""")
def q_outlier_counts(spark, sf):
    return quality.outlier_counts(quality.lap_outliers(laps(spark, sf)))


Q5_SQL = """,
d AS (SELECT GrandPrix, Session, Driver, Stint, TyreLife - lag(TyreLife) OVER (
        PARTITION BY GrandPrix, Session, Driver, Stint ORDER BY LapNumber) AS dd
      FROM laps WHERE Stint IS NOT NULL),
q5 AS (SELECT GrandPrix, Session, Driver, Stint, 'Non-sequential tire life progression' AS Issue FROM d
       GROUP BY GrandPrix, Session, Driver, Stint
       HAVING count(*) >= 2 AND count(*) FILTER (WHERE dd IS NOT NULL AND dd <> 1) > 0)"""


@query("tyre_progression", with_laps() + Q5_SQL
       + "\nSELECT GrandPrix, Session, Driver, round(Stint, 6) AS Stint, Issue FROM q5")
def q_tyre_progression(spark, sf):
    return quality.tyre_progression(laps(spark, sf))


@query("tyre_rule_breaks", with_laps() + """,
p AS (SELECT *, row_number() OVER w > 1 AS seen, lag(Stint) OVER w AS s0, lag(TyreLife) OVER w AS t0, lag(Compound) OVER w AS c0,
        lag(PitInTime) OVER w IS NOT NULL AS pit
      FROM laps WINDOW w AS (PARTITION BY GrandPrix, Session, Driver ORDER BY LapNumber)),
m AS (SELECT *, coalesce(Compound <> c0, false) AS moved FROM p),
i AS (SELECT *, 1 + sum(CASE WHEN pit OR moved THEN 1 ELSE 0 END) OVER (
        PARTITION BY GrandPrix, Session, Driver ORDER BY LapNumber ROWS UNBOUNDED PRECEDING) AS DerivedStint FROM m),
b AS (
  SELECT *, 'stint change without pit stop' AS Issue FROM i WHERE NOT pit AND Stint <> s0
  UNION ALL SELECT *, 'pit stop without stint change' FROM i WHERE pit AND Stint = s0
  UNION ALL SELECT *, 'compound change without pit stop' FROM i WHERE NOT pit AND moved
  UNION ALL SELECT *, 'tyre life not reset after pit stop' FROM i WHERE pit AND TyreLife > t0
  UNION ALL SELECT *, 'tyre life reset without pit stop' FROM i WHERE NOT pit AND TyreLife < t0)
SELECT GrandPrix, Session, Driver, round(LapNumber, 6) AS LapNumber, CAST(DerivedStint AS BIGINT) AS DerivedStint,
  round(Stint, 6) AS Stint, round(TyreLife, 6) AS TyreLife, Issue FROM b""")
def q_tyre_rule_breaks(spark, sf):
    """Q5: contradictions between pit stops, compounds, stints and tyre ages."""
    return quality.tyre_rule_breaks(laps(spark, sf))


@query("pit_durations", with_laps() + """,
n AS (SELECT *, lead(PitOutTime) OVER (PARTITION BY GrandPrix, Session, Driver ORDER BY LapNumber) AS next_out FROM laps),
o AS (SELECT *, CASE WHEN PitOutTime >= PitInTime THEN PitOutTime ELSE next_out END AS ExitTime FROM n WHERE PitInTime IS NOT NULL)
SELECT GrandPrix, Session, Driver, round(LapNumber, 6) AS LapNumber, round(PitInTime, 6) AS PitInTime, round(ExitTime, 6) AS ExitTime,
  round(ExitTime - PitInTime, 6) AS Duration,
  CASE WHEN ExitTime IS NULL THEN 'open' WHEN ExitTime < PitInTime THEN 'negative' WHEN ExitTime - PitInTime < 15 THEN 'short'
       ELSE 'ok' END AS Verdict FROM o""")
def q_pit_durations(spark, sf):
    """Q6: every pit stop's duration, stops under 15 s marked."""
    return quality.pit_durations(laps(spark, sf))


Q6_SQL = """,
q6 AS (SELECT count(*) FILTER (WHERE PitInTime IS NOT NULL) AS PitLaps,
         count(*) FILTER (WHERE PitInTime IS NOT NULL AND PitOutTime IS NOT NULL) AS PitLapsWithOut FROM laps),
q6s AS (SELECT *, PitLapsWithOut / greatest(PitLaps, 1) AS Completeness,
          CASE WHEN PitLapsWithOut / greatest(PitLaps, 1) < 0.5 THEN 'warning' ELSE 'ok' END AS Severity FROM q6)"""


@query("pit_completeness", with_laps() + Q6_SQL + """
SELECT PitLaps, PitLapsWithOut, round(Completeness, 6) AS Completeness, Severity FROM q6s""")
def q_pit_completeness(spark, sf):
    return quality.pit_completeness(laps(spark, sf))


@query("quality_report", with_laps() + Q3_SQL + Q4_SQL + Q5_SQL + Q6_SQL + f""",
sch AS ({schema_sql("laps", LAP_RULES, LAP_RULES_EXCLUSIVE_LO)}),
f AS (
  SELECT 'schema' AS Rule, 'issue' AS Severity FROM sch HAVING count(*) FILTER (WHERE NOT Passed) > 0
  UNION ALL SELECT 'sector', CASE WHEN Severity = 'issue' THEN 'issue' ELSE 'warning' END FROM q3s WHERE Severity <> 'ok'
  UNION ALL SELECT 'outliers', 'warning' FROM q4 HAVING count(*) > 0
  UNION ALL SELECT 'progression', 'warning' FROM q5 HAVING count(*) > 0
  UNION ALL SELECT 'pits', 'warning' FROM q6s WHERE Severity <> 'ok')
SELECT (SELECT count(*) FROM laps) AS TotalRows,
  count(*) FILTER (WHERE Rule = 'schema') = 0 AS SchemaValid,
  count(*) FILTER (WHERE Severity = 'issue') AS Issues,
  count(*) FILTER (WHERE Severity = 'warning') AS Warnings,
  count(*) FILTER (WHERE Rule = 'schema') = 0 AND count(*) FILTER (WHERE Severity = 'issue') = 0 AS Passed
FROM f""")
def q_quality_report(spark, sf):
    return quality.quality_report(laps(spark, sf))


@query("cross_compound", with_laps() + """,
a AS (SELECT GrandPrix, Circuit, Compound, avg(LapTime) AS MeanLapTime, count(LapTime) AS LapCount,
        median(LapTime) AS MedianLapTime
      FROM laps WHERE GrandPrix IS NOT NULL AND Circuit IS NOT NULL AND Compound IS NOT NULL
      GROUP BY GrandPrix, Circuit, Compound HAVING count(LapTime) >= 5),
w AS (SELECT *, count(*) OVER (PARTITION BY GrandPrix, Circuit) AS CompoundsQualified,
        max(CASE WHEN Compound = 'SOFT' THEN MedianLapTime END) OVER (PARTITION BY GrandPrix, Circuit) AS s,
        max(CASE WHEN Compound = 'MEDIUM' THEN MedianLapTime END) OVER (PARTITION BY GrandPrix, Circuit) AS m,
        max(CASE WHEN Compound = 'HARD' THEN MedianLapTime END) OVER (PARTITION BY GrandPrix, Circuit) AS h FROM a)
SELECT GrandPrix, Circuit, Compound, round(MeanLapTime, 6) AS MeanLapTime, LapCount,
  round(MedianLapTime, 6) AS MedianLapTime, CompoundsQualified,
  CASE WHEN s IS NOT NULL AND m IS NOT NULL AND h IS NOT NULL THEN s < m AND m < h END AS ExpectedOrder
FROM w WHERE CompoundsQualified >= 2""")
def q_cross_compound(spark, sf):
    return quality.cross_compound(laps(spark, sf))
