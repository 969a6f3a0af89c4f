"""Plan checks over every registered query: no cross joins, no Python UDFs."""

import re

import pytest

from pitlane.plans import catalog
from tests.conftest import SF001

catalog.load_all()
#: Their plans are built by fitting models first; test_oracle runs them.
FITTED = {"train_gbt", "train_rf", "predict", "feature_importance", "top_features", "tune", "compare_models", "model_roundtrip"}
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


@pytest.mark.parametrize("name", sorted(set(catalog.ORACLE) - FITTED))
def test_plan_has_no_cross_join_or_python(spark, name):
    df = catalog.QUERIES[name](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    bad = [op for op in FORBIDDEN if op in plan]
    assert not bad, f"{name}: {bad}"


def test_scans_are_pruned(spark):
    df = catalog.QUERIES["tyre_degradation"](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Session" in plan and "Session#" in plan
    assert "ReadSchema: struct<LapTime:double,Compound:string,TyreLife:double,IsAccurate:boolean>" in plan


def counts(df):
    """Exchanges and scans of the first physical plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"Exchange (?:hash|range|single|rebalance|RoundRobin)", plan)), plan.count("FileScan")


@pytest.mark.parametrize("name", ["pace_by_age", "compound_by_circuit", "compound_usage", "compare_races", "cross_compound"])
def test_single_quantile_plans_are_small(spark, name):
    exchanges, scans = counts(catalog.QUERIES[name](spark, SF001))
    assert exchanges <= 6 and scans <= 2


@pytest.mark.parametrize("name,most", [("tyre_degradation", (13, 4)), ("optimal_stint", (20, 8)), ("lap_features", (12, 6))])
def test_composed_plans_are_bounded(spark, name, most):
    exchanges, scans = counts(catalog.QUERIES[name](spark, SF001))
    assert exchanges <= most[0] and scans <= most[1]


@pytest.mark.parametrize("name", ["tyre_features", "progress_features", "history_features", "field_delta", "sector_pct",
                                  "stint_track_features", "pace_curve", "predict_pace", "compare_strategies",
                                  "strategy_timeline"])
def test_feature_and_strategy_plans_read_files_only(spark, name):
    plan = catalog.QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "Scan ExistingRDD" not in plan
