"""Object-style entry points mirroring the reference's public surface.

Each class is a thin, stateless-on-data facade over the DataFrame operators:
methods take and return Spark DataFrames (never pandas), hold no session of
their own, and trigger no actions except where a result is inherently a
model or a small report.  Use the operator modules directly for finer control.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlane.functions.scalar import DEFAULT_RECORD_SOURCE
from pitlane.operators import clean, compare, enrich, features, gold, model, quality, strategy, tyres
from pitlane.sources import bronze_laps, export_laps, from_pandas, load_season, write_table


class LapProcessor:
    """Medallion layers: bronze, silver, gold driver and tyre tables, enrichment, writes."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def to_spark(self, pdf, schema=None) -> DataFrame:
        return from_pandas(self.spark, pdf, schema)

    def bronze(self, laps: DataFrame, source: str = DEFAULT_RECORD_SOURCE) -> DataFrame:
        return bronze_laps(laps, source)

    def silver(self, bronze: DataFrame) -> DataFrame:
        return clean.silver_laps(bronze)

    def gold_driver_stats(self, silver: DataFrame) -> DataFrame:
        return gold.driver_stats(silver)

    def gold_tyre_stats(self, silver: DataFrame) -> DataFrame:
        return gold.tyre_stats(silver)

    def add_track_conditions(self, laps: DataFrame, weather: DataFrame | None = None,
                             asof: bool = True) -> DataFrame:
        """The latest weather sample of each lap; ``asof=False`` pairs every lap with every sample of its session."""
        if weather is None:
            return laps
        return enrich.weather_asof(laps, weather) if asof else enrich.weather_join(laps, weather)

    def write(self, df: DataFrame, path: str, mode: str = "overwrite",
              partition_by: Sequence[str] | None = None, fmt: str = "parquet") -> str:
        return write_table(df, path, mode, partition_by, fmt)


class QualityValidator:
    """Lap and telemetry validation; results are DataFrames, folded by ``validate``."""

    def validate(self, laps: DataFrame) -> DataFrame:
        """One row: TotalRows, SchemaValid, Issues, Warnings, Passed."""
        return quality.quality_report(laps)

    def findings(self, laps: DataFrame) -> DataFrame:
        return quality.quality_findings(laps)

    def lap_schema(self, laps: DataFrame) -> DataFrame:
        return quality.lap_schema_check(laps)

    def telemetry_schema(self, telemetry: DataFrame) -> DataFrame:
        return quality.telemetry_schema_check(telemetry)

    def outliers(self, laps: DataFrame) -> DataFrame:
        return quality.lap_outliers(laps)

    def cross_compound(self, laps: DataFrame) -> DataFrame:
        return quality.cross_compound(laps)


class FeatureBuilder:
    """Lap features and the encoded matrix; remembers encoders and medians once fitted."""

    def __init__(self):
        self.codes = None
        self.medians = None
        self.columns: list[str] = []

    def engineer(self, laps: DataFrame) -> DataFrame:
        return features.lap_features(laps)

    def prepare(self, feats: DataFrame, target: str = "LapTime", leak_free: bool = False) -> DataFrame:
        """Frame with ``features`` (vector) and ``label``; reuses fitted encoders."""
        out, self.codes, self.medians, self.columns = features.encode_impute(
            feats, self.codes, self.medians, target=target, leak_free=leak_free)
        return out


class LapTimeModel:
    """Distributed lap-time regressor: ``gbt`` (boosted trees) or ``rf`` (forest)."""

    def __init__(self, model_type: str = "gbt"):
        self.model_type = model_type
        self.model = None
        self.importance: list[tuple[str, float]] = []

    def train(self, train: DataFrame, feature_names: Sequence[str] = (), optimize: bool = False, **params):
        if optimize:
            self.model, _ = model.tune(train, self.model_type, **params)
        else:
            self.model = model.train(train, self.model_type, **params)
        if feature_names:
            self.importance = model.feature_importance(self.model, feature_names)
        return self

    def predict(self, df: DataFrame) -> DataFrame:
        return model.predict(self.model, df)

    def evaluate(self, test: DataFrame) -> DataFrame:
        return model.evaluate(self.predict(test))

    def save(self, path: str) -> str:
        return model.save_model(self.model, path, self.importance, self.model_type)

    def load(self, spark: SparkSession, path: str):
        self.model, self.importance, self.model_type = model.load_model(spark, path)
        return self


class TyreAnalyzer:
    """Season tyre analyses over valid laps of one session type."""

    def __init__(self, spark: SparkSession, session: str | None = "Race"):
        self.spark = spark
        self.session = session

    def load(self, source, races: Sequence[str] | None = None) -> DataFrame | None:
        return load_season(self.spark, source, races, self.session)

    def degradation(self, laps: DataFrame) -> DataFrame:
        return tyres.tyre_degradation(clean.valid_laps(laps, need_compound=True, need_age=True))

    def optimal_stint_length(self, laps: DataFrame) -> DataFrame:
        return tyres.optimal_stint(clean.valid_laps(laps, need_compound=True, need_age=True))

    def compound_by_circuit(self, laps: DataFrame) -> DataFrame:
        return tyres.compound_by_circuit(clean.valid_laps(laps, need_compound=True))

    def chart_tables(self, laps: DataFrame) -> dict[str, DataFrame]:
        """The numbers behind the reference's four-panel chart."""
        v = clean.valid_laps(laps, need_compound=True, need_age=True, max_age=40)
        return {"pace_by_age": tyres.pace_by_age(v), "stint_length_box": tyres.stint_length_box(v),
                "usage": tyres.compound_usage_counts(v)}

    def export(self, laps: DataFrame, path: str) -> DataFrame:
        return export_laps(laps, path)


class StrategySimulator:
    """Prices strategy tables against a pace curve built from one race's (or many races') laps."""

    def __init__(self, laps: DataFrame):
        valid = clean.valid_laps(laps, need_compound=True, need_age=True)
        self.curve = strategy.pace_curve(valid)

    def predict_lap_time(self, requests: DataFrame, age: str = "TyreAge") -> DataFrame:
        return strategy.predict_pace(requests, self.curve, age=age)

    def compare(self, strategies: DataFrame | None = None, spark: SparkSession | None = None) -> DataFrame:
        if strategies is None:
            strategies = strategy.strategies_frame(spark or SparkSession.getActiveSession())
        return strategy.compare_strategies(strategies, self.curve)

    def timeline(self, strategies: DataFrame) -> DataFrame:
        return strategy.strategy_timeline(strategies, self.curve)


def compounds_single_race(laps: DataFrame, race: str) -> dict[str, DataFrame]:
    """One race: compound usage, lap-time box numbers and degradation curves."""
    v = clean.valid_laps(laps.where(F.col("GrandPrix") == race), need_compound=True)
    return {"usage": compare.compound_usage(v), "box": tyres.laptime_box(v),
            "curves": compare.degradation_curves(v)}


def compare_two_races(laps: DataFrame, race1: str, race2: str, compound: str = "SOFT") -> dict[str, DataFrame]:
    """One compound at two races: summary (empty unless both have laps), histograms, curves."""
    v = clean.valid_laps(laps.where(F.col("GrandPrix").isin(race1, race2)), compound=compound)
    return {"summary": compare.compare_two_races(v, race1, race2, compound),
            "histogram": compare.laptime_histogram(v),
            "curves": compare.degradation_curves(v, keys=("GrandPrix",))}


def quick_tyre_summary(laps: DataFrame, race: str) -> dict[str, DataFrame]:
    """One race: overview, per-compound summary and fastest lap per compound."""
    v = clean.valid_laps(laps.where(F.col("GrandPrix") == race), need_compound=True)
    return {"overview": compare.race_overview(v), "compounds": compare.race_tyre_summary(v),
            "fastest": compare.fastest_lap_by_compound(v)}
