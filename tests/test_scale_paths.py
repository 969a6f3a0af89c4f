"""The skew-safe paths give the same answers as the simple ones."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from pitlane.functions import group_mode, group_quantiles, scan
from pitlane.operators import clean, enrich, features
from pitlane.plans import catalog
from tests.conftest import SF001


def test_bucketed_quantiles_match_builtin(spark):
    laps = catalog.laps(spark, SF001)
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    for keys in (["Compound"], ["GrandPrix", "Compound"], []):
        ref = {tuple(r[k] for k in keys): r for r in
               laps.where("LapTime is not null").groupBy(*keys).agg(*[
                   F.percentile("LapTime", F.lit(p)).alias(n) for n, p in probs.items()]).collect()}
        got = {tuple(r[k] for k in keys): r for r in
               group_quantiles(laps, keys, "LapTime", probs, bucket_values=50).collect()}
        assert ref.keys() == got.keys()
        for k in ref:
            for p in probs:
                assert abs(ref[k][p] - got[k][p]) < 1e-9


def test_mode_ties_go_to_smallest(spark):
    df = spark.createDataFrame([("x", 3), ("x", 1), ("x", 3), ("x", 1), ("x", 2)], "k string, v int")
    assert group_mode(df, ["k"], "v", "m").first().m == 1


def test_dedup_matches_window(spark):
    dup = spark.sql(__import__("pitlane.fixtures", fromlist=["x"]).LAPS_DUP_SQL, laps=catalog.laps(spark, SF001))
    assert clean.dedup_laps(dup).count() == catalog.laps(spark, SF001).count()


def test_asof_bucket_width_irrelevant(spark):
    from pitlane import fixtures as fx
    from tests.conftest import SF01
    laps = catalog.laps(spark, SF01)
    w = fx.view(spark, SF01, "weather")
    cols = ("GrandPrix", "Driver", "LapNumber", "Session", "WeatherId")
    laps = laps.unionByName(laps.limit(50).withColumn("Time", F.lit(None).cast("double"))).withColumn("Id", F.monotonically_increasing_id())
    laps = laps.checkpoint()
    ref = enrich.weather_asof(laps, w, bucket_values=1 << 30).select(*cols, "Id")  # one bucket per session
    assert ref.count() == laps.count()
    for values in (1, 7, 1000):
        got = enrich.weather_asof(laps, w, bucket_values=values).select(*cols, "Id")
        assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0, values


def test_null_safe_full_join_keeps_right_keys(spark):
    from pitlane.functions import null_safe_join
    a = spark.createDataFrame([("x", 1)], "k string, a int")
    b = spark.createDataFrame([("y", 2), (None, 3)], "k string, b int")
    got = {(r.k, r.a, r.b) for r in null_safe_join(a, b, ["k"], "full").collect()}
    assert got == {("x", 1, None), ("y", None, 2), (None, None, 3)}


def test_repartition_invariance(spark):
    laps = catalog.laps(spark, SF001)
    a = clean.silver_laps(laps).groupBy().agg(F.sum("DeltaToFastest").alias("s")).first().s
    b = clean.silver_laps(laps.repartition(7)).groupBy().agg(F.sum("DeltaToFastest").alias("s")).first().s
    assert abs(a - b) < 1e-6


def test_no_python_udf_in_plans(spark):
    catalog.load_all()
    for name in ("silver_laps", "tyre_degradation", "weather_asof", "compare_strategies", "lap_features"):
        plan = catalog.QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_track_evolution_prefix_matches_window(spark):
    from pitlane.operators import features
    laps = catalog.laps(spark, SF001)
    a = features.track_evolution(laps, method="prefix").select("GrandPrix", "Session", "Driver", "LapNumber",
                                                               F.round("TrackEvolution", 9).alias("t"))
    b = features.track_evolution(laps, method="window").select("GrandPrix", "Session", "Driver", "LapNumber",
                                                               F.round("TrackEvolution", 9).alias("t"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_bucketed_scans_match_windows(spark):
    from pyspark.sql import Window
    from pitlane.functions import scan
    from tests.conftest import SF01
    laps = catalog.laps(spark, SF01)
    g = ["GrandPrix", "Session", "Driver"]
    k = g + ["LapNumber"]

    def same(a, b, c):
        a = a.select(*k, F.round(c, 9).alias(c))
        b = b.select(*k, F.round(c, 9).alias(c))
        return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

    w = Window.partitionBy(*g).orderBy("LapNumber")
    for width in (5.0, 64.0):
        assert same(scan.running(laps, g, "LapNumber", "LapTime", "min", "m", width),
                    laps.withColumn("m", F.min("LapTime").over(w.rowsBetween(Window.unboundedPreceding, 0))), "m")
        assert same(scan.rolling_mean(laps, g, ["LapNumber"], "LapTime", "r", 3, width),
                    laps.withColumn("r", F.avg("LapTime").over(w.rowsBetween(-2, 0))), "r")
        assert same(scan.lag(laps, g, ["LapNumber"], "TyreLife", "p", width),
                    laps.withColumn("p", F.lag("TyreLife").over(w)), "p")
        assert same(scan.running(laps, g, "LapNumber", None, "count", "c", width),
                    laps.withColumn("c", F.row_number().over(w).cast("long")), "c")


def _unclean(spark, rows):
    """Three quarters of the rows are one driver's, all on lap 7, a third of those copies of one row; null keys too."""
    return spark.range(rows).selectExpr(
        "'GP' GrandPrix", "'R' Session", "if(id % 4 > 0, 'HOT', if(id % 8 = 0, null, 'D')) Driver",
        "if(id % 4 > 0, 7, cast(pmod(id * 31, 60) as int)) LapNumber",
        "cast(if(id % 8 = 0, null, if(id % 4 > 0, if(id % 3 = 0, 80, 80 + pmod(id * 7919, 1000)), 90 + pmod(id, 13))) as double) LapTime",
        "if(id % 5 = 0 and id % 3 > 0, null, 1) Stint", "if(id % 3 = 0 and id % 4 > 0, 0D, cast(pmod(id, 17) as double)) TyreLife")


def test_ranges_bound_rows_when_one_lap_number_holds_most(spark):
    r = scan.ranged(_unclean(spark, 1_000_000), ["GrandPrix", "Session", "Driver"], ["LapNumber"], tasks=16)
    sizes = [row["count"] for row in r.groupBy(scan.RANGE).count().collect()]
    assert sum(sizes) == 1_000_000 and len(sizes) == 16
    assert max(sizes) < 2 * 1_000_000 / 16


def test_scans_over_ranges_equal_plain_windows(spark):
    keys, n = ["GrandPrix", "Session", "Driver"], 20_000
    r = scan.ranged(_unclean(spark, n), keys, ["LapNumber"], tasks=13).cache()
    w = Window.partitionBy(*keys).orderBy("LapNumber", *scan.TIES)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    want = r.select("_id", F.min("LapTime").over(upto).alias("low"), F.sum("LapTime").over(upto).alias("total"),
                    F.row_number().over(w).cast("long").alias("pos"), F.lag("TyreLife").over(w).alias("before"),
                    F.round(F.avg("LapTime").over(w.rowsBetween(-2, 0)), 9).alias("mean"))
    got = scan.running(r, keys, "LapNumber", "LapTime", "min", "low")
    got = scan.running(got, keys, "LapNumber", "LapTime", "sum", "total")
    got = scan.running(got, keys, "LapNumber", None, "count", "pos")
    got = scan.lag(got, keys, ["LapNumber"], "TyreLife", "before")
    got = scan.rolling_mean(got, keys, ["LapNumber"], "LapTime", "mean").withColumn("mean", F.round("mean", 9))
    got = got.select(*want.columns)
    assert got.count() == n
    assert got.exceptAll(want).count() == 0


def test_features_by_ranges_equal_windows_on_clean_laps(spark):
    laps = catalog.laps(spark, SF001).limit(3000).checkpoint()
    for f in (features.rolling3, features.best_so_far, features.laps_into_stint, features.tyre_age_diff):
        got, want = f(laps, method="ranged"), f(laps, method="window")
        assert got.columns == want.columns
        near = lambda d: d.select([F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in d.dtypes])
        assert near(got).exceptAll(near(want)).count() == 0 and got.count() == 3000, f.__name__
    empty = laps.limit(0)
    assert features.rolling3(empty, method="ranged").count() == 0
