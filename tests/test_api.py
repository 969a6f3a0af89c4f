"""The object-style facade runs end to end on the fixture laps."""


from pitlane import api
from pitlane.plans import catalog
from tests.conftest import SF001


def test_facade_end_to_end(spark):
    laps = catalog.laps(spark, SF001)
    p = api.LapProcessor(spark)
    silver = p.silver(p.bronze(laps))
    assert p.gold_driver_stats(silver).count() > 0 and p.gold_tyre_stats(silver).count() > 0
    rep = api.QualityValidator().validate(laps).first()
    assert rep.TotalRows == laps.count() and rep.SchemaValid is False  # LapNumber is double
    fb = api.FeatureBuilder()
    prepared = fb.prepare(fb.engineer(silver))
    assert "features" in prepared.columns and len(fb.columns) > 10
    race = laps.where("Session = 'Race'")
    ta = api.TyreAnalyzer(spark)
    assert ta.degradation(race).count() > 0 and set(ta.chart_tables(race)) == {"pace_by_age", "stint_length_box", "usage"}
    sim = api.StrategySimulator(race)
    res = sim.compare(spark=spark).collect()
    assert {r.Strategy for r in res} <= {"Conservative (1-stop)", "Standard (1-stop)", "Aggressive (2-stop)",
                                          "Alternative (2-stop)"}
    gp = race.select("GrandPrix").first().GrandPrix
    assert api.quick_tyre_summary(race, gp)["overview"].count() == 1
    assert api.compounds_single_race(race, gp)["usage"].count() > 0
    two = api.compare_two_races(race, gp, gp, "SOFT")["summary"]
    assert two.count() == 0  # the same race twice is one group, so no comparison
