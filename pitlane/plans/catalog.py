"""Query registry: name -> Spark plan builder, name -> DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pitlane.functions.scalar import round_doubles

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a plan builder; every double in its output is rounded to 6 places."""
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return run
    return deco


def laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lap table: derived from the driver's tables once, then read as landed parquet."""
    from pitlane.sources.landing import land
    return land(spark, sf_dir, "laps")


def race_laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Race sessions only: the tyre analyses load one session type."""
    return laps(spark, sf_dir).where("Session = 'Race'")


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver layer, landed once: feature plans branch from its files."""
    from pitlane.operators import clean
    from pitlane.sources.landing import land_frame
    return land_frame(spark, sf_dir, "silver", lambda: clean.silver_laps(laps(spark, sf_dir)))


def lap_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table, landed once: the encoders, the medians and every model read it."""
    from pitlane.operators import features
    from pitlane.sources.landing import land_frame
    return land_frame(spark, sf_dir, "features", lambda: features.lap_features(silver(spark, sf_dir)))


def load_all() -> None:
    """Import every query module so its queries register."""
    from pitlane.plans import core, features, model, quality, strategy, tyres  # noqa: F401
