"""Tier 3 invariants."""

from pyspark.sql import functions as F

from pitlane.operators import clean, gold
from pitlane.plans import catalog
from tests.conftest import SF001

KEY = ["GrandPrix", "Session", "Driver", "LapNumber"]


def test_silver_subset_of_bronze(spark):
    laps = catalog.laps(spark, SF001)
    silver = clean.silver_laps(laps)
    assert silver.select(*KEY).exceptAll(laps.select(*KEY)).count() == 0
    assert silver.count() == silver.select(*KEY).distinct().count()


def test_delta_to_fastest_non_negative_with_zero_per_session(spark):
    silver = clean.silver_laps(catalog.laps(spark, SF001))
    agg = silver.groupBy("GrandPrix", "Session").agg(F.min("DeltaToFastest").alias("m")).collect()
    assert all(r.m == 0.0 for r in agg)
    assert silver.where(F.col("DeltaToFastest") < 0).count() == 0


def test_total_laps_sum_to_silver_rows(spark):
    silver = clean.silver_laps(catalog.laps(spark, SF001))
    total = gold.driver_stats(silver).agg(F.sum("TotalLaps")).first()[0]
    assert total == silver.count()


def test_queries_unchanged_under_repartition(spark):
    from pitlane.operators import quality, tyres
    laps = catalog.laps(spark, SF001)
    for fn in (lambda d: tyres.compound_by_circuit(clean.valid_laps(d, need_compound=True)),
               quality.lap_outliers):
        a, b = fn(laps), fn(laps.repartition(5, "Driver"))
        cols = a.columns
        a = a.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in a.dtypes])
        b = b.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in b.dtypes]).select(*cols)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_medallion_observes_layer_counts(spark):
    from pitlane.plans.medallion import medallion
    from tests.conftest import SF01
    m = medallion(catalog.laps(spark, SF01))
    n = m.gold.agg(F.sum("TotalLaps")).first()[0]
    assert m.counts() == {"bronze": 60000, "silver": 44822} and n == 44822
