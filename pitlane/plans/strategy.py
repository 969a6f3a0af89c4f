"""Queries for strategy scoring."""

from __future__ import annotations

from pitlane import fixtures as fx
from pitlane.operators import clean, strategy
from pitlane.plans.catalog import query, race_laps
from pitlane.plans.sqlparts import with_laps

CURVE = """,
v AS (SELECT * FROM laps WHERE Session = 'Race' AND LapTime IS NOT NULL AND IsAccurate
        AND Compound IS NOT NULL AND TyreLife IS NOT NULL),
pa AS (SELECT Compound, TyreLife, median(LapTime) AS MedianLapTime, count(LapTime) AS LapCount
       FROM v GROUP BY Compound, TyreLife HAVING count(LapTime) >= 3),
curve AS (SELECT *, arg_min(MedianLapTime, TyreLife) OVER (PARTITION BY Compound) AS BaseTime,
            max(TyreLife) OVER (PARTITION BY Compound) AS MaxAge,
            count(*) OVER (PARTITION BY Compound) AS n_ages FROM pa),
c AS (SELECT Compound, TyreLife, MedianLapTime FROM curve WHERE n_ages >= 3),
ends AS (SELECT Compound, min(TyreLife) AS a1, arg_min(MedianLapTime, TyreLife) AS m1,
           max(TyreLife) AS an, arg_max(MedianLapTime, TyreLife) AS mn FROM c GROUP BY Compound)"""

BASE = with_laps("strategies") + CURVE + """,
st AS (SELECT *, coalesce(sum(StintLength) OVER (PARTITION BY Strategy ORDER BY StintNo
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM strategies),
req AS (SELECT Strategy, StintNo, Compound, CAST(TyreAge AS INTEGER) AS TyreAge, CAST(start + TyreAge AS INTEGER) AS LapNo
        FROM (SELECT *, UNNEST(range(1, StintLength + 1)) AS TyreAge FROM st)),
lo AS (SELECT r.*, c.TyreLife AS alo, c.MedianLapTime AS mlo FROM req r
       ASOF LEFT JOIN c ON r.Compound = c.Compound AND r.TyreAge >= c.TyreLife),
hi AS (SELECT l.*, c.TyreLife AS ahi, c.MedianLapTime AS mhi FROM lo l
       ASOF LEFT JOIN (SELECT Compound, -TyreLife AS nt, TyreLife, MedianLapTime FROM c) c
       ON l.Compound = c.Compound AND -l.TyreAge > c.nt),
pred AS (SELECT h.Strategy, h.StintNo, h.Compound, h.TyreAge, h.LapNo,
           CASE WHEN e.a1 IS NULL THEN NULL WHEN h.TyreAge < e.a1 THEN e.m1
                WHEN h.TyreAge >= e.an THEN e.mn + 0.05 * (h.TyreAge - e.an)
                ELSE h.mlo + (h.mhi - h.mlo) * (h.TyreAge - h.alo) / (h.ahi - h.alo) END AS PredictedLapTime
         FROM hi h LEFT JOIN ends e ON h.Compound = e.Compound),
scored AS (SELECT p.Strategy, sum(PredictedLapTime) + 25.0 * (any_value(k.n) - 1) AS RaceTime,
             avg(PredictedLapTime) AS AvgLapTime, any_value(k.n) - 1 AS NumStops, count(*) AS TotalLaps
           FROM pred p JOIN (SELECT Strategy, count(*) AS n FROM strategies GROUP BY Strategy) k USING (Strategy)
           GROUP BY p.Strategy HAVING count(*) FILTER (WHERE PredictedLapTime IS NULL) = 0)"""


def curve(spark, sf):
    return strategy.pace_curve(clean.valid_laps(race_laps(spark, sf), need_compound=True, need_age=True))


@query("pace_curve", BASE + """
SELECT Compound, round(TyreLife, 6) AS TyreLife, LapCount, round(MedianLapTime, 6) AS MedianLapTime,
  round(BaseTime, 6) AS BaseTime, round(MaxAge, 6) AS MaxAge FROM curve WHERE n_ages >= 3""")
def q_pace_curve(spark, sf):
    return curve(spark, sf).select("Compound", "TyreLife", "LapCount", "MedianLapTime", "BaseTime", "MaxAge")


@query("expand_strategy", BASE + "\nSELECT * FROM req")
def q_expand_strategy(spark, sf):
    return strategy.expand_strategy(fx.view(spark, sf, "strategies"))


@query("predict_pace", BASE + "\nSELECT Strategy, StintNo, Compound, TyreAge, LapNo, "
       "round(PredictedLapTime, 6) AS PredictedLapTime FROM pred")
def q_predict_pace(spark, sf):
    return strategy.predict_pace(strategy.expand_strategy(fx.view(spark, sf, "strategies")), curve(spark, sf))


@query("compare_strategies", BASE + """
SELECT Strategy, round(RaceTime, 6) AS RaceTime, round(AvgLapTime, 6) AS AvgLapTime, NumStops, TotalLaps,
  round(RaceTime - min(RaceTime) OVER (), 6) AS TimeDelta FROM scored""")
def q_compare_strategies(spark, sf):
    return strategy.compare_strategies(fx.view(spark, sf, "strategies"), curve(spark, sf))


@query("strategy_timeline", BASE + """,
ok AS (SELECT Strategy FROM pred GROUP BY Strategy HAVING count(*) FILTER (WHERE PredictedLapTime IS NULL) = 0)
SELECT Strategy, LapNo, StintNo, Compound, TyreAge, round(PredictedLapTime, 6) AS LapTime,
  round(sum(PredictedLapTime) OVER (PARTITION BY Strategy ORDER BY LapNo ROWS UNBOUNDED PRECEDING)
        + 25.0 * (StintNo - 1), 6) AS CumulativeTime
FROM pred SEMI JOIN ok USING (Strategy)""")
def q_strategy_timeline(spark, sf):
    return strategy.strategy_timeline(fx.view(spark, sf, "strategies"), curve(spark, sf))


DEFAULTS_SQL = with_laps() + CURVE + """,
strategies AS (SELECT * FROM (VALUES
  ('Conservative (1-stop)', 1, 'HARD', 78),
  ('Standard (1-stop)', 1, 'MEDIUM', 40), ('Standard (1-stop)', 2, 'HARD', 38),
  ('Aggressive (2-stop)', 1, 'SOFT', 25), ('Aggressive (2-stop)', 2, 'MEDIUM', 28), ('Aggressive (2-stop)', 3, 'MEDIUM', 25),
  ('Alternative (2-stop)', 1, 'MEDIUM', 30), ('Alternative (2-stop)', 2, 'SOFT', 20), ('Alternative (2-stop)', 3, 'MEDIUM', 28)
) AS t(Strategy, StintNo, Compound, StintLength))""" + BASE[len(with_laps("strategies") + CURVE):]


@query("default_strategies", DEFAULTS_SQL + """
SELECT Strategy, round(RaceTime, 6) AS RaceTime, round(AvgLapTime, 6) AS AvgLapTime, NumStops, TotalLaps,
  round(RaceTime - min(RaceTime) OVER (), 6) AS TimeDelta FROM scored""")
def q_default_strategies(spark, sf):
    """S2 + P4: the reference's default strategy dict (pandas intake) priced on the laps' pace curve."""
    return strategy.compare_strategies(strategy.strategies_frame(spark), curve(spark, sf))
