"""Queries for the tyre analyses (T1-T11) and race comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitlane.functions.scalar import KNOWN_COMPOUNDS
from pitlane.operators import clean, compare, tyres
from pitlane.plans.catalog import query, race_laps
from pitlane.plans.sqlparts import with_laps

DRY = "('SOFT', 'MEDIUM', 'HARD')"
VALID_CA = ("valid_ca AS (SELECT * FROM laps WHERE Session = 'Race' AND LapTime IS NOT NULL AND IsAccurate"
            " AND Compound IS NOT NULL AND TyreLife IS NOT NULL)")
VALID_C = ("valid_c AS (SELECT * FROM laps WHERE Session = 'Race' AND LapTime IS NOT NULL AND IsAccurate"
           " AND Compound IS NOT NULL)")
BASE = with_laps() + ",\n" + VALID_CA + ",\n" + VALID_C


def valid_ca(spark, sf):
    return clean.valid_laps(race_laps(spark, sf), need_compound=True, need_age=True)


def valid_c(spark, sf):
    return clean.valid_laps(race_laps(spark, sf), need_compound=True)


T1_SQL = BASE + f""",
v AS (SELECT * FROM valid_ca WHERE Compound IN {DRY}),
st AS (SELECT Compound, count(*) AS TotalLaps, avg(TyreLife) AS AvgStintLength, max(TyreLife) AS MaxStintLength,
         avg(LapTime) AS AvgLapTime, median(LapTime) AS MedianLapTime FROM v GROUP BY Compound HAVING count(*) >= 50),
pa AS (SELECT Compound, TyreLife, median(LapTime) AS med FROM v GROUP BY Compound, TyreLife),
sl AS (SELECT Compound, CASE WHEN count(*) > 5 AND count(*) FILTER (WHERE TyreLife <= 30) > 5
         THEN regr_slope(med, TyreLife) FILTER (WHERE TyreLife <= 30) END AS DegradationRate
       FROM pa GROUP BY Compound),
t1 AS (SELECT st.*, sl.DegradationRate FROM st LEFT JOIN sl USING (Compound))"""


@query("tyre_degradation", T1_SQL + """
SELECT Compound, TotalLaps, round(AvgStintLength, 6) AS AvgStintLength, round(MaxStintLength, 6) AS MaxStintLength,
  round(DegradationRate, 6) AS DegradationRate, round(AvgLapTime, 6) AS AvgLapTime,
  round(MedianLapTime, 6) AS MedianLapTime FROM t1""")
def q_tyre_degradation(spark, sf):
    return tyres.tyre_degradation(valid_ca(spark, sf))


@query("degradation_band", T1_SQL + """
SELECT Compound, round(DegradationRate, 6) AS DegradationRate,
  CASE WHEN DegradationRate IS NULL THEN NULL WHEN DegradationRate < 0.05 THEN 'minimal'
       WHEN DegradationRate <= 0.10 THEN 'normal' ELSE 'high' END AS DegradationBand FROM t1""")
def q_degradation_band(spark, sf):
    return tyres.degradation_band(tyres.tyre_degradation(valid_ca(spark, sf)))


@query("pace_by_age", BASE + """
SELECT Compound, round(TyreLife, 6) AS TyreLife, round(avg(LapTime), 6) AS MeanLapTime,
  count(LapTime) AS LapCount, round(stddev_samp(LapTime), 6) AS StdLapTime,
  round(median(LapTime), 6) AS MedianLapTime
FROM valid_ca GROUP BY Compound, TyreLife""")
def q_pace_by_age(spark, sf):
    return tyres.pace_by_age(valid_ca(spark, sf))


T3_SQL = BASE + f""",
v AS (SELECT * FROM valid_ca WHERE Compound IN {DRY}),
vol AS (SELECT Compound, max(TyreLife) AS LongestStint FROM v GROUP BY Compound HAVING count(*) >= 100),
pa AS (SELECT Compound, TyreLife, median(LapTime) AS med FROM v GROUP BY Compound, TyreLife HAVING count(LapTime) >= 10),
d AS (SELECT *, med - lag(med) OVER (PARTITION BY Compound ORDER BY TyreLife) AS diff FROM pa),
r AS (SELECT *, CASE WHEN count(diff) OVER w = 3 THEN avg(diff) OVER w END AS chg FROM d
      WINDOW w AS (PARTITION BY Compound ORDER BY TyreLife ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
th AS (SELECT Compound, count(*) AS ages, max(TyreLife) AS maxage, quantile_cont(chg, 0.75) AS thr FROM r GROUP BY Compound),
opt AS (SELECT r.Compound, coalesce(min(CASE WHEN chg > thr THEN r.TyreLife END), max(maxage)) AS OptimalMaxAge
        FROM r JOIN th USING (Compound) WHERE ages >= 5 GROUP BY r.Compound),
stints AS (SELECT Compound, GrandPrix, Driver, Stint, max(TyreLife) AS len FROM v WHERE Stint IS NOT NULL
           GROUP BY Compound, GrandPrix, Driver, Stint),
sagg AS (SELECT Compound, avg(len) AS AverageStintLength, count(*) AS TotalStints FROM stints GROUP BY Compound),
md AS (SELECT Compound, len AS MostCommonStint FROM (
         SELECT Compound, len, row_number() OVER (PARTITION BY Compound ORDER BY count(*) DESC, len) AS rn
         FROM stints WHERE len IS NOT NULL GROUP BY Compound, len) WHERE rn = 1)"""


@query("optimal_stint", T3_SQL + """
SELECT opt.Compound, round(OptimalMaxAge, 6) AS OptimalMaxAge, round(AverageStintLength, 6) AS AverageStintLength,
  round(MostCommonStint, 6) AS MostCommonStint, round(LongestStint, 6) AS LongestStint, TotalStints
FROM opt JOIN vol USING (Compound) LEFT JOIN sagg USING (Compound) LEFT JOIN md USING (Compound)""")
def q_optimal_stint(spark, sf):
    return tyres.optimal_stint(valid_ca(spark, sf))


@query("pace_change", T3_SQL + """
SELECT r.Compound, round(r.TyreLife, 6) AS TyreLife, round(r.med, 6) AS MedianLapTime, round(r.diff, 6) AS MedianDiff,
  round(r.chg, 6) AS PaceChange FROM r JOIN vol USING (Compound)""")
def q_pace_change(spark, sf):
    """The smoothed median change T3 thresholds (dry compounds with >= 100 laps)."""
    df = valid_ca(spark, sf).where("Compound IN ('SOFT', 'MEDIUM', 'HARD')")
    vol = df.groupBy("Compound").count().where("count >= 100").select("Compound")
    return tyres.pace_change(df).join(vol, "Compound", "left_semi").select(
        "Compound", "TyreLife", "MedianLapTime", "MedianDiff", "PaceChange")


@query("stint_stats", BASE + """
SELECT Compound, GrandPrix, Driver, round(Stint, 6) AS Stint, round(max(TyreLife), 6) AS StintLength,
  round(avg(LapTime), 6) AS MeanLapTime
FROM valid_ca WHERE Stint IS NOT NULL GROUP BY Compound, GrandPrix, Driver, Stint""")
def q_stint_stats(spark, sf):
    return tyres.stint_stats(valid_ca(spark, sf))


T5_SQL = BASE + """,
t5 AS (SELECT GrandPrix, Compound, median(LapTime) AS MedianLapTime, avg(LapTime) AS MeanLapTime,
         count(LapTime) AS LapCount FROM valid_c GROUP BY GrandPrix, Compound),
t6 AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY GrandPrix ORDER BY MedianLapTime, Compound) AS rn
       FROM t5) WHERE rn = 1)"""


@query("compound_by_circuit", T5_SQL + """
SELECT GrandPrix, Compound, round(MedianLapTime, 6) AS MedianLapTime, round(MeanLapTime, 6) AS MeanLapTime, LapCount
FROM t5""")
def q_compound_by_circuit(spark, sf):
    return tyres.compound_by_circuit(valid_c(spark, sf))


@query("fastest_compound", T5_SQL + """
SELECT GrandPrix, Compound, round(MedianLapTime, 6) AS MedianLapTime, round(MeanLapTime, 6) AS MeanLapTime, LapCount
FROM t6""")
def q_fastest_compound(spark, sf):
    return tyres.fastest_compound(tyres.compound_by_circuit(valid_c(spark, sf)))


@query("compound_wins", T5_SQL + "\nSELECT Compound, count(*) AS Wins FROM t6 GROUP BY Compound")
def q_compound_wins(spark, sf):
    return tyres.compound_wins(tyres.fastest_compound(tyres.compound_by_circuit(valid_c(spark, sf))))


@query("compound_usage_pivot", BASE + """
SELECT GrandPrix, count(*) FILTER (WHERE Compound = 'SOFT') AS SOFT, count(*) FILTER (WHERE Compound = 'MEDIUM') AS MEDIUM,
  count(*) FILTER (WHERE Compound = 'HARD') AS HARD, count(*) FILTER (WHERE Compound = 'INTERMEDIATE') AS INTERMEDIATE,
  count(*) FILTER (WHERE Compound = 'WET') AS WET,
  count(*) FILTER (WHERE Compound = 'C3') AS C3
FROM valid_ca WHERE TyreLife <= 40 GROUP BY GrandPrix""")
def q_compound_usage_pivot(spark, sf):
    valid = clean.valid_laps(race_laps(spark, sf), need_compound=True, need_age=True, max_age=40)
    return tyres.compound_usage_pivot(tyres.compound_usage_counts(valid), (*KNOWN_COMPOUNDS, "C3"))


@query("compound_usage_counts", BASE + """
SELECT GrandPrix, Compound, count(*) AS Laps FROM valid_ca WHERE TyreLife <= 40 GROUP BY GrandPrix, Compound""")
def q_compound_usage_counts(spark, sf):
    return tyres.compound_usage_counts(
        clean.valid_laps(race_laps(spark, sf), need_compound=True, need_age=True, max_age=40))


def box_sql(source: str, keys: str, value: str) -> str:
    join = " AND ".join(f"s.{k.strip()} IS NOT DISTINCT FROM q.{k.strip()}" for k in keys.split(","))
    qk = ", ".join(f"q.{k.strip()}" for k in keys.split(","))
    inside = f"s.{value} >= q.Q1 - 1.5 * (q.Q3 - q.Q1) AND s.{value} <= q.Q3 + 1.5 * (q.Q3 - q.Q1)"
    return f""",
s AS ({source}),
q AS (SELECT {keys}, quantile_cont({value}, 0.25) AS Q1, median({value}) AS Median,
        quantile_cont({value}, 0.75) AS Q3 FROM s WHERE {value} IS NOT NULL GROUP BY {keys})
SELECT {qk}, count(*) AS N, round(q.Q1, 6) AS Q1, round(q.Median, 6) AS Median, round(q.Q3, 6) AS Q3,
  round(min(s.{value}) FILTER (WHERE {inside}), 6) AS LowerWhisker,
  round(max(s.{value}) FILTER (WHERE {inside}), 6) AS UpperWhisker,
  count(*) FILTER (WHERE NOT ({inside})) AS Outliers
FROM s JOIN q ON {join} WHERE s.{value} IS NOT NULL GROUP BY {qk}, q.Q1, q.Median, q.Q3"""


@query("stint_length_box", BASE + box_sql(
    f"SELECT Compound, GrandPrix, Driver, Stint, max(TyreLife) AS StintLength FROM valid_ca "
    f"WHERE TyreLife <= 40 AND Compound IN {DRY} AND Stint IS NOT NULL GROUP BY Compound, GrandPrix, Driver, Stint",
    "Compound", "StintLength"))
def q_stint_length_box(spark, sf):
    return tyres.stint_length_box(
        clean.valid_laps(race_laps(spark, sf), need_compound=True, need_age=True, max_age=40))


@query("laptime_box", BASE + box_sql("SELECT * FROM valid_c", "GrandPrix, Compound", "LapTime"))
def q_laptime_box(spark, sf):
    return tyres.laptime_box(valid_c(spark, sf))


# ---- race comparisons (R1-R7) ----------------------------------------------------

@query("compound_usage", BASE + """
SELECT GrandPrix, Compound, count(*) AS Laps, round(median(LapTime), 6) AS MedianLapTime
FROM valid_c GROUP BY GrandPrix, Compound""")
def q_compound_usage(spark, sf):
    return compare.compound_usage(valid_c(spark, sf))


@query("race_overview", BASE + """
SELECT GrandPrix, count(*) AS ValidLaps, count(DISTINCT Driver) AS Drivers,
  array_to_string(list_sort(list_distinct(list(Compound))), ', ') AS Compounds
FROM valid_c GROUP BY GrandPrix""")
def q_race_overview(spark, sf):
    return compare.race_overview(valid_c(spark, sf))


@query("race_tyre_summary", BASE + """,
laps_agg AS (SELECT GrandPrix, Compound, count(*) AS Laps, avg(LapTime) AS MeanLapTime, median(LapTime) AS MedianLapTime
             FROM valid_c GROUP BY GrandPrix, Compound),
st AS (SELECT GrandPrix, Compound, Driver, Stint, max(TyreLife) AS len FROM valid_c WHERE Stint IS NOT NULL
       GROUP BY GrandPrix, Compound, Driver, Stint),
sa AS (SELECT GrandPrix, Compound, avg(len) AS AvgStint, max(len) AS MaxStint FROM st GROUP BY GrandPrix, Compound)
SELECT GrandPrix, Compound, Laps, round(MeanLapTime, 6) AS MeanLapTime, round(MedianLapTime, 6) AS MedianLapTime,
  round(AvgStint, 6) AS AvgStint, round(MaxStint, 6) AS MaxStint
FROM laps_agg LEFT JOIN sa USING (GrandPrix, Compound)""")
def q_race_tyre_summary(spark, sf):
    return compare.race_tyre_summary(valid_c(spark, sf))


@query("fastest_lap_by_compound", BASE + """
SELECT GrandPrix, Compound, round(LapTime, 6) AS LapTime, round(LapNumber, 6) AS LapNumber, Driver FROM (
  SELECT *, row_number() OVER (PARTITION BY GrandPrix, Compound ORDER BY LapTime, Driver, LapNumber) AS rn
  FROM valid_c) WHERE rn = 1""")
def q_fastest_lap_by_compound(spark, sf):
    return compare.fastest_lap_by_compound(valid_c(spark, sf))


@query("compare_races", BASE + """
SELECT GrandPrix, Compound, count(*) AS Laps, round(avg(TyreLife), 6) AS MeanTyreLife,
  round(median(LapTime), 6) AS MedianLapTime
FROM valid_c GROUP BY GrandPrix, Compound""")
def q_compare_races(spark, sf):
    """R5 over every race and compound: a two-race comparison is this table restricted to a pair."""
    return compare.compare_races(valid_c(spark, sf))


@query("compare_two_races", BASE + """,
two AS (SELECT min(GrandPrix) AS a, max(GrandPrix) AS b FROM valid_c),
r AS (SELECT GrandPrix, Compound, count(*) AS Laps, round(avg(TyreLife), 6) AS MeanTyreLife,
        round(median(LapTime), 6) AS MedianLapTime
      FROM valid_c WHERE Compound = 'SOFT' AND GrandPrix IN (SELECT a FROM two UNION SELECT b FROM two)
      GROUP BY GrandPrix, Compound)
SELECT * FROM r WHERE (SELECT count(*) FROM r) = 2""")
def q_compare_two_races(spark, sf):
    """R5 as a pair, SOFT tyres at the first and last race by name; nothing if either has no such laps."""
    valid = valid_c(spark, sf)
    ends = valid.agg(F.min("GrandPrix").alias("a"), F.max("GrandPrix").alias("b")).first()
    return compare.compare_two_races(valid, ends["a"], ends["b"])


@query("laptime_histogram", BASE + """,
v AS (SELECT * FROM valid_c),
rng AS (SELECT GrandPrix, Compound, CASE WHEN min(LapTime) = max(LapTime) THEN min(LapTime) - 0.5 ELSE min(LapTime) END AS lo,
          CASE WHEN min(LapTime) = max(LapTime) THEN max(LapTime) + 0.5 ELSE max(LapTime) END AS hi
        FROM v GROUP BY GrandPrix, Compound),
b AS (SELECT GrandPrix, Compound, CAST(least(floor(30 * (LapTime - lo) / (hi - lo)) + 1, 30) - 1 AS INTEGER) AS Bin
      FROM v JOIN rng USING (GrandPrix, Compound)),
c AS (SELECT GrandPrix, Compound, Bin, count(*) AS Count FROM b GROUP BY GrandPrix, Compound, Bin),
g AS (SELECT GrandPrix, Compound, lo, hi, CAST(UNNEST(range(0, 30)) AS INTEGER) AS Bin FROM rng)
SELECT g.GrandPrix, g.Compound, g.Bin, round(lo + (hi - lo) / 30 * g.Bin, 6) AS BinStart,
  round(lo + (hi - lo) / 30 * (g.Bin + 1), 6) AS BinEnd, coalesce(c.Count, 0) AS Count
FROM g LEFT JOIN c ON g.GrandPrix = c.GrandPrix AND g.Compound = c.Compound AND g.Bin = c.Bin""")
def q_laptime_histogram(spark, sf):
    return compare.laptime_histogram(valid_c(spark, sf), ("GrandPrix", "Compound"))


@query("degradation_curves", BASE + """,
big AS (SELECT GrandPrix, Compound FROM valid_c GROUP BY GrandPrix, Compound HAVING count(*) > 10)
SELECT GrandPrix, Compound, round(TyreLife, 6) AS TyreLife, round(median(LapTime), 6) AS MedianLapTime
FROM valid_c SEMI JOIN big USING (GrandPrix, Compound) WHERE TyreLife IS NOT NULL
GROUP BY GrandPrix, Compound, TyreLife""")
def q_degradation_curves(spark, sf):
    return compare.degradation_curves(valid_c(spark, sf))
