"""Weather enrichment: the session equi-join (J1) and the as-of join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitlane.functions import scan
from pitlane.functions.stats import BUCKET_VALUES, null_safe_join

SESSION_KEYS = ("GrandPrix", "Session")


def _weather_payload(weather: DataFrame, keys: Sequence[str], laps_cols: Sequence[str]) -> DataFrame:
    """Weather columns renamed where they collide with lap columns (Time -> WeatherTime)."""
    return weather.select(*keys, *[
        F.col(c).alias(f"Weather{c}" if c in laps_cols else c)
        for c in weather.columns if c not in keys])


def weather_join(laps: DataFrame, weather: DataFrame | None = None,
                 keys: Sequence[str] = SESSION_KEYS) -> DataFrame:
    """Left equi-join of every lap to every weather row of its session.

    No weather -> laps unchanged.  Keys appear once and colliding weather
    columns are prefixed, so later selects stay unambiguous.  This multiplies
    laps by weather rows per session; use ``weather_asof`` for one row per lap,
    or ``weather_join_summary`` when only session aggregates are needed.
    """
    if weather is None:
        return laps
    return laps.join(_weather_payload(weather, keys, laps.columns), list(keys), "left")


def weather_join_summary(laps: DataFrame, weather: DataFrame,
                         keys: Sequence[str] = SESSION_KEYS) -> DataFrame:
    """Per-session aggregates of the J1 fan-out, computed without the fan-out.

    Both sides are aggregated per session first (map-side combined), then the
    two small aggregates are joined: the joined-row count is a product and each
    average over the product equals the average over its own side.
    """
    k = list(keys)
    lap_side = laps.groupBy(*k).agg(
        F.count(F.lit(1)).alias("_nl"), F.sum("LapTime").alias("_sl"), F.count("LapTime").alias("_cl"))
    w_side = weather.groupBy(*k).agg(
        F.count(F.lit(1)).alias("_nw"), F.min("AirTemp").alias("MinAirTemp"),
        F.max("TrackTemp").alias("MaxTrackTemp"), F.count_if(F.col("Rainfall")).alias("_nr"))
    j = null_safe_join(lap_side, w_side, k, "left")
    return j.select(
        *k,
        (F.col("_nl") * F.coalesce(F.col("_nw"), F.lit(1))).alias("JoinedRows"),
        (F.col("_nl") * F.coalesce(F.col("_nw"), F.lit(0))).alias("MatchedRows"),
        "MinAirTemp",
        "MaxTrackTemp",
        (F.col("_nl") * F.coalesce(F.col("_nr"), F.lit(0))).alias("RainRows"),
        F.try_divide(F.col("_sl"), F.col("_cl")).alias("AvgLapTime"),
    )


def weather_asof(laps: DataFrame, weather: DataFrame, keys: Sequence[str] = SESSION_KEYS,
                 time_col: str = "Time", bucket_values: int = BUCKET_VALUES) -> DataFrame:
    """Attach the latest weather row at or before each lap's ``time_col``.

    Ties on weather time go to the larger WeatherId.  Laps without an earlier
    weather sample (or without a time) get NULL weather columns.

    Skew-safe: the lookup runs over the distinct times of a session, so a burst of
    rows at one time folds map-side and the payload of a lap is never moved with
    it.  Times are cut into buckets at a hash sample of themselves, one in
    ``bucket_values`` on average, however long or uneven a session is; inside a
    bucket a running maximum finds the latest sample, and each bucket's last one is
    carried on through the small bucket table.  Laps then join on (session, time).
    """
    found = _neighbours(laps, weather, keys, time_col, bucket_values).select("_g", "_t", F.col("_back").alias("_m"))
    return _attach(laps, weather, found, keys, time_col)


def weather_nearest(laps: DataFrame, weather: DataFrame, keys: Sequence[str] = SESSION_KEYS, time_col: str = "Time",
                    tolerance: float | None = None, bucket_values: int = BUCKET_VALUES) -> DataFrame:
    """Attach the weather row nearest in time to each lap's ``time_col``, before or after.

    Of two equally near samples the earlier one counts; among samples of one time that
    with the larger WeatherId.  A sample further off than ``tolerance`` seconds is none:
    the weather columns are NULL then, as they are for laps without a time.  Found like
    ``weather_asof``, in the same pass over the distinct times, with a carry from each side.
    """
    t = F.col("_t")
    near = F.when(F.col("_next").isNull() | (t - F.col("_back.WeatherTime") <= F.col("_next.WeatherTime") - t),
                  F.col("_back")).otherwise(F.col("_next"))
    found = _neighbours(laps, weather, keys, time_col, bucket_values).select("_g", "_t", near.alias("_m"))
    if tolerance is not None:
        found = found.withColumn("_m", F.when(F.abs(F.col("_m.WeatherTime") - t) <= F.lit(float(tolerance)), F.col("_m")))
    return _attach(laps, weather, found, keys, time_col)


def _keyed(df: DataFrame, keys: Sequence[str], time_col: str) -> DataFrame:
    return df.where(F.col(time_col).isNotNull()).select("*", scan.group_key(keys).alias("_g"), F.col(time_col).alias("_t"))


def _payload_columns(weather: DataFrame, keys: Sequence[str], time_col: str) -> list[str]:
    return [c for c in weather.columns if c not in keys and c not in (time_col, "WeatherId")]


def _neighbours(laps: DataFrame, weather: DataFrame, keys: Sequence[str], time_col: str, bucket_values: int) -> DataFrame:
    """(_g, _t, _back, _next) per session and time that a lap asks for: the latest sample up to it, the first one after it."""
    k = list(keys)
    # one row per session and time: the best sample of that time, and whether a lap asks for it
    sample = F.struct(F.col("_t").alias("WeatherTime"), F.col("WeatherId"), *[F.col(c) for c in _payload_columns(weather, k, time_col)])
    samples = _keyed(weather, k, time_col).groupBy("_g", "_t").agg(F.max(sample).alias("_w")).withColumn("_asked", F.lit(False))
    asked = _keyed(laps, k, time_col).select("_g", "_t").distinct().withColumns(
        {"_w": F.lit(None).cast(samples.schema["_w"].dataType), "_asked": F.lit(True)})
    times = samples.unionByName(asked).groupBy("_g", "_t").agg(F.max("_w").alias("_w"), F.max("_asked").alias("_asked"))

    cuts = times.groupBy("_g").agg(F.array_sort(F.collect_list(F.when(
        F.pmod(F.xxhash64("_t"), F.lit(bucket_values)) == 0, F.col("_t")))).alias("_cuts"))
    cut = times.join(cuts, "_g").withColumn("_bk", F.size(F.filter("_cuts", lambda c: c < F.col("_t")))).drop("_cuts")
    # what follows is a running minimum from the end: a frame up to the last row is summed up anew for each row
    so_far, earlier = (Window.unboundedPreceding, 0), (Window.unboundedPreceding, -1)
    buckets = Window.partitionBy("_g")
    carried = cut.groupBy("_g", "_bk").agg(F.max("_w").alias("_last"), F.min("_w").alias("_first")).select(
        "_g", "_bk", F.max("_last").over(buckets.orderBy("_bk").rowsBetween(*earlier)).alias("_before"),
        F.min("_first").over(buckets.orderBy(F.desc("_bk")).rowsBetween(*earlier)).alias("_after"))
    inside = Window.partitionBy("_g", "_bk")
    return cut.join(carried, ["_g", "_bk"]).withColumns({
        "_back": F.coalesce(F.max("_w").over(inside.orderBy("_t").rowsBetween(*so_far)), F.col("_before")),
        "_next": F.coalesce(F.min("_w").over(inside.orderBy(F.desc("_t")).rowsBetween(*earlier)), F.col("_after"))}).where(
        "_asked").select("_g", "_t", "_back", "_next")


def _attach(laps: DataFrame, weather: DataFrame, found: DataFrame, keys: Sequence[str], time_col: str) -> DataFrame:
    """Laps with the sample ``_m`` found for their session and time."""
    new = ["WeatherTime", "WeatherId", *_payload_columns(weather, keys, time_col)]
    matched = _keyed(laps, keys, time_col).join(found, ["_g", "_t"]).select(*laps.columns, *[F.col(f"_m.{c}").alias(c) for c in new])
    kinds = {f.name: f.dataType for f in matched.schema.fields[len(laps.columns):]}
    untimed = laps.where(F.col(time_col).isNull()).select(
        *laps.columns, *[F.lit(None).cast(kinds[c]).alias(c) for c in new])
    return matched.unionByName(untimed)


# -- track conditions ------------------------------------------------------------------------------

WET_COMPOUNDS = ("INTERMEDIATE", "WET")


def status_intervals(samples: DataFrame, status: str, keys: Sequence[str] = SESSION_KEYS, time_col: str = "Time",
                     id_col: str = "WeatherId", width: float = scan.DEFAULT_WIDTH) -> DataFrame:
    """(keys, Status, Start, End): the spans between the change points of ``status`` in a session.

    A span lasts to the next change; the last has no End.  Of samples at one time that
    with the larger ``id_col`` counts.  Samples without a time or status are skipped.
    """
    k = list(keys)
    s = samples.where(F.col(time_col).isNotNull() & F.col(status).isNotNull()).groupBy(*k, F.col(time_col).alias("Start")).agg(
        F.max_by(status, id_col).alias("Status"))
    tasks = scan.tasks_for(s)
    changes = scan.lag(s, k, ["Start"], "Status", "_was", width, tasks).where(
        F.col("_was").isNull() | (F.col("_was") != F.col("Status"))).drop("_was")
    return scan.lead(changes, k, "Start", "Start", "End", width, tasks).select(*k, "Status", "Start", "End")


def track_conditions(laps: DataFrame, weather: DataFrame, keys: Sequence[str] = SESSION_KEYS, wet: str = "Rainfall",
                     bin_seconds: float = 900.0, share: int = 1024) -> DataFrame:
    """Laps with the track's condition while they were driven, and whether the tyre fits it.

    Change points of ``wet`` become intervals; a lap spans from ``Time - LapTime`` to
    ``Time`` and meets those that overlap it.  Added: CoveredSeconds and WetSeconds of the
    lap, Condition (``dry``, ``wet``, ``mixed``, or ``unknown`` without any sample before
    its end or without times) and TyreIssue: dry-weather tyres on a lap that was wet
    throughout, or wet-weather tyres on one that was dry throughout.

    Both sides are cut into time bins and joined on (session, bin); a pair counts in the
    first bin they share.  Only distinct spans of laps take part.  Bins that hold more
    than one in ``share`` of them are split, and their intervals copied to each part.
    """
    k = list(keys)
    bin_of = lambda c: F.floor(c / F.lit(float(bin_seconds)))
    start, end = F.col("Time") - F.col("LapTime"), F.col("Time")
    marked = laps.withColumn("_g", scan.group_key(k)).withColumns({"_s": F.when(F.col("LapTime") > 0, start), "_e": end})
    spans = marked.where("_s < _e").select("_g", "_s", "_e").distinct()
    placed = spans.withColumn("_bin", F.explode(F.sequence(bin_of(F.col("_s")), bin_of(F.col("_e")))))
    # a few bins at most hold so large a share
    counts = placed.groupBy("_g", "_bin").agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("t")).scalar()
    hot = F.broadcast(counts.where(F.col("_n") * share > total).select(
        "_g", "_bin", F.ceil(F.col("_n") * share / total).cast("int").alias("_parts")))
    mine = placed.join(hot, ["_g", "_bin"], "left").withColumn(
        "_part", F.pmod(F.xxhash64("_s", "_e"), F.coalesce("_parts", F.lit(1))).cast("int")).drop("_parts")
    last = spans.groupBy("_g").agg(F.max("_e").alias("_stop"))
    met = status_intervals(weather, wet, k).select(scan.group_key(k).alias("_g"), "Status", "Start", "End").join(last, "_g").withColumn(
        "End", F.least(F.col("_stop"), F.coalesce("End", "_stop"))).where(F.col("Start") < F.col("End"))
    met = met.withColumn("_bin", F.explode(F.sequence(bin_of(F.col("Start")), bin_of(F.col("End"))))).join(
        hot, ["_g", "_bin"], "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).select("_g", "_bin", "_part", "Status", "Start", "End")
    pairs = mine.join(met, ["_g", "_bin", "_part"]).where(
        (F.col("Start") < F.col("_e")) & (F.col("End") > F.col("_s")) & (F.col("_bin") == bin_of(F.greatest("_s", "Start"))))
    over = F.least("_e", "End") - F.greatest("_s", "Start")
    found = pairs.groupBy("_g", "_s", "_e").agg(
        F.sum(over).alias("CoveredSeconds"), F.sum(F.when(F.col("Status"), over).otherwise(0.0)).alias("WetSeconds"),
        F.count(F.lit(1)).alias("_all"), F.count_if("Status").alias("_wet"))
    condition = F.when(F.col("_all").isNull(), "unknown").when(F.col("_wet") == 0, "dry").when(
        F.col("_wet") == F.col("_all"), "wet").otherwise("mixed")
    wet_tyre = F.col("Compound").isin(*WET_COMPOUNDS)
    issue = F.when((F.col("Condition") == "wet") & ~wet_tyre, "dry-weather tyre on a wet track").when(
        (F.col("Condition") == "dry") & wet_tyre, "wet-weather tyre on a dry track")
    return marked.join(found, ["_g", "_s", "_e"], "left").withColumn("Condition", condition).withColumn(
        "TyreIssue", issue).select(*laps.columns, "CoveredSeconds", "WetSeconds", "Condition", "TyreIssue")
