"""Race-strategy scoring (P1-P5): a strategies *table* scored against a pace curve.

The reference simulates a handful of strategies in a Python loop; here any
number of strategies is expanded to laps, priced by a join against the pace
curve and aggregated, all in one Spark plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitlane.functions.stats import grouped_stats, null_safe_join

PIT_LOSS = 25.0       # seconds per stop
EXTRA_DEG = 0.05      # seconds per lap beyond the curve's last age

# The reference's default strategies, {name: [(compound, stint laps), ...]}.
DEFAULT_STRATEGIES = {
    "Conservative (1-stop)": [("HARD", 78)],
    "Standard (1-stop)": [("MEDIUM", 40), ("HARD", 38)],
    "Aggressive (2-stop)": [("SOFT", 25), ("MEDIUM", 28), ("MEDIUM", 25)],
    "Alternative (2-stop)": [("MEDIUM", 30), ("SOFT", 20), ("MEDIUM", 28)],
}


def strategies_frame(spark, strategies: dict | None = None) -> DataFrame:
    """A strategies parameter table ``{name: [(compound, laps), ...]}`` as a DataFrame.

    This is the S2 intake (pandas -> Spark with a declared schema); such
    tables are a handful of rows written by an analyst, not lap data.
    """
    import pandas as pd

    from pitlane.schema import STRATEGIES_SCHEMA
    from pitlane.sources.laps import from_pandas
    rows = [(name, i + 1, comp, int(n)) for name, stints in (strategies or DEFAULT_STRATEGIES).items()
            for i, (comp, n) in enumerate(stints)]
    pdf = pd.DataFrame(rows, columns=[f.name for f in STRATEGIES_SCHEMA.fields])
    return from_pandas(spark, pdf, STRATEGIES_SCHEMA)


def pace_curve(valid: DataFrame, keys: Sequence[str] = ("Compound",), min_count: int = 3,
               min_ages: int = 3) -> DataFrame:
    """Per compound, median LapTime by tyre age over ages with >= ``min_count`` laps.

    Compounds need >= ``min_ages`` such ages.  BaseTime is the median at the
    lowest kept age; MaxAge the highest kept age.
    """
    k = [*keys, "TyreLife"]
    df = valid
    for c in k:
        df = df.where(F.col(c).isNotNull())
    curve = grouped_stats(df, k, "LapTime", {"MedianLapTime": 0.5}, {"LapCount": ("count", "LapTime")}).where(
        F.col("LapCount") >= min_count).select(*k, "LapCount", "MedianLapTime")
    per = Window.partitionBy(*keys)
    curve = curve.withColumn("_ages", F.count(F.lit(1)).over(per)) \
        .withColumn("BaseTime", F.min_by("MedianLapTime", "TyreLife").over(per)) \
        .withColumn("MaxAge", F.max("TyreLife").over(per))
    return curve.where(F.col("_ages") >= min_ages).drop("_ages")


def predict_pace(requests: DataFrame, curve: DataFrame, age: str = "TyreAge",
                 keys: Sequence[str] = ("Compound",), extra_deg: float = EXTRA_DEG) -> DataFrame:
    """Add ``PredictedLapTime`` for each (compound, age) request.

    Exact age -> its median; between two ages -> linear interpolation; below the
    first -> first median; above the last -> last median + ``extra_deg`` per lap;
    unknown compound -> NULL.

    Only the distinct (key, age) pairs are priced: they fold map-side, whatever the
    number of requests.  For them the curve becomes one row per key with its points
    in order of age (one entry per distinct age, never one per lap), in which a pair
    finds its neighbours.  The prices are then joined to the requests.
    """
    k = list(keys)
    return null_safe_join(requests, _prices(requests.select(*k, age).distinct(), curve, age, k, extra_deg), [*k, age], "left")


def _prices(pairs: DataFrame, curve: DataFrame, age: str, k: Sequence[str], extra_deg: float) -> DataFrame:
    """Distinct (keys, age) pairs with their ``PredictedLapTime``."""
    points = curve.groupBy(*k).agg(F.array_sort(F.collect_list(
        F.struct(F.col("TyreLife").alias("a"), F.col("MedianLapTime").alias("m")))).alias("_pts"))
    x = F.col(age)
    # a NULL key has no curve; a plain join keeps the curve's own partitioning by key
    j = pairs.join(points, k, "left").withColumn("_i", F.size(F.filter("_pts", lambda p: p["a"] <= x)))
    at = lambda i: F.get("_pts", i)  # noqa: E731  0-based, NULL beyond the ends
    first, last, low, high = at(F.lit(0)), at(F.size("_pts") - 1), at(F.col("_i") - 1), at(F.col("_i"))
    pred = (F.when(F.col("_pts").isNull() | x.isNull(), F.lit(None).cast("double"))
            .when(x < first["a"], first["m"])
            .when(x >= last["a"], last["m"] + F.lit(extra_deg) * (x - last["a"]))
            .otherwise(low["m"] + (high["m"] - low["m"]) * (x - low["a"]) / (high["a"] - low["a"])))
    return j.select(*k, age, pred.alias("PredictedLapTime"))


def stint_prices(strategies: DataFrame, curve: DataFrame, extra_deg: float = EXTRA_DEG) -> DataFrame:
    """(Compound, TyreAge, PredictedLapTime, StintTime): each lap's price and the cumulative price up to it.

    One row per compound and age, up to the longest stint asked for: a stint's time is
    one lookup, so no stint is expanded to laps to be priced.
    """
    ages = strategies.where(F.col("StintLength") >= 1).groupBy("Compound").agg(F.max("StintLength").alias("_n")).select(
        "Compound", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("TyreAge"))
    upto = Window.partitionBy("Compound").orderBy("TyreAge").rowsBetween(Window.unboundedPreceding, 0)
    return _prices(ages, curve, "TyreAge", ["Compound"], extra_deg).withColumn("StintTime", F.sum("PredictedLapTime").over(upto))


def _priced_stints(strategies: DataFrame, prices: DataFrame) -> DataFrame:
    """Stints with their number of laps, their time (0 without laps) and whether they can't be priced."""
    laps = F.greatest(F.coalesce("StintLength", F.lit(0)), F.lit(0))
    totals = prices.select("Compound", F.col("TyreAge").alias("_laps"), "StintTime")
    priced = strategies.withColumn("_laps", laps).join(totals, ["Compound", "_laps"], "left")
    return priced.withColumn("_miss", (F.col("_laps") > 0) & F.col("StintTime").isNull()).withColumn(
        "StintTime", F.coalesce("StintTime", F.lit(0.0)))


def expand_strategy(strategies: DataFrame) -> DataFrame:
    """One row per lap: TyreAge 1..StintLength and LapNo within the race."""
    before = Window.partitionBy("Strategy").orderBy("StintNo").rowsBetween(Window.unboundedPreceding, -1)
    s = strategies.withColumn("_start", F.coalesce(F.sum("StintLength").over(before), F.lit(0)))
    ages = F.when(F.col("StintLength") >= 1, F.sequence(F.lit(1), F.col("StintLength"))).otherwise(F.array())
    laps = s.withColumn("TyreAge", F.explode(ages))
    return laps.select("Strategy", "StintNo", "Compound", "TyreAge",
                       (F.col("_start") + F.col("TyreAge")).cast("int").alias("LapNo"))


def compare_strategies(strategies: DataFrame, curve: DataFrame, pit_loss: float = PIT_LOSS) -> DataFrame:
    """RaceTime, AvgLapTime, NumStops, TotalLaps, TimeDelta per strategy.

    A strategy with any unpredictable lap is dropped.  TimeDelta is measured
    against the fastest strategy through a scalar subquery (one value).
    """
    stints = _priced_stints(strategies, stint_prices(strategies, curve))
    j = stints.groupBy("Strategy").agg(
        F.sum("StintTime").alias("_sum"), F.sum("_laps").alias("TotalLaps"), F.count(F.lit(1)).alias("_stints"),
        F.count_if("_miss").alias("_missing")).where((F.col("_missing") == 0) & (F.col("TotalLaps") > 0))
    scored = j.select("Strategy", (F.col("_sum") + F.lit(pit_loss) * (F.col("_stints") - 1)).alias("RaceTime"),
                      (F.col("_sum") / F.col("TotalLaps")).alias("AvgLapTime"), (F.col("_stints") - 1).alias("NumStops"),
                      "TotalLaps")
    # all columns take part, so that the subquery's shuffles are the main plan's and are reused
    fastest = scored.agg(F.min(F.struct("RaceTime", *[c for c in scored.columns if c != "RaceTime"])).alias("m")).select(
        "m.RaceTime").scalar()
    return scored.withColumn("TimeDelta", F.col("RaceTime") - fastest).orderBy("RaceTime", "Strategy")


def strategy_timeline(strategies: DataFrame, curve: DataFrame, pit_loss: float = PIT_LOSS) -> DataFrame:
    """P5: per lap: predicted time and cumulative race time incl. earlier stops.

    Strategies with an unpredictable lap are left out (as the reference plots).
    """
    prices = stint_prices(strategies, curve)
    own = Window.partitionBy("Strategy")
    before = own.orderBy("StintNo").rowsBetween(Window.unboundedPreceding, -1)
    stints = _priced_stints(strategies, prices).withColumns({
        "_broken": F.max("_miss").over(own), "_start": F.coalesce(F.sum("StintTime").over(before), F.lit(0.0)),
        "_first": F.coalesce(F.sum("_laps").over(before), F.lit(0))}).where(~F.col("_broken") & (F.col("_laps") > 0))
    laps = stints.drop("StintTime").withColumn("TyreAge", F.explode(F.sequence(F.lit(1), F.col("_laps"))))
    return laps.join(prices, ["Compound", "TyreAge"]).select(
        "Strategy", (F.col("_first") + F.col("TyreAge")).cast("int").alias("LapNo"), "StintNo", "Compound", "TyreAge",
        F.col("PredictedLapTime").alias("LapTime"),
        (F.col("_start") + F.col("StintTime") + F.lit(pit_loss) * (F.col("StintNo") - 1)).alias("CumulativeTime"))
