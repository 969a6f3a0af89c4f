"""Silver layer and lap filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.functions import scan
from pitlane.functions.scalar import KNOWN_COMPOUNDS
from pitlane.functions.stats import null_safe_join

SESSION_KEYS = ("GrandPrix", "Session")
LAP_KEYS = ("GrandPrix", "Session", "Driver", "LapNumber")


def silver_filter(df: DataFrame) -> DataFrame:
    """Keep laps with a positive LapTime flagged accurate (NULL counts as false)."""
    return df.where(F.col("LapTime").isNotNull() & (F.col("LapTime") > 0) & F.col("IsAccurate"))


def sector_mismatch(df: DataFrame, tolerance: float = 0.1) -> DataFrame:
    """SectorSum (NULL if any sector is NULL) and TimeMismatch (NULL -> false)."""
    s = F.col("Sector1Time") + F.col("Sector2Time") + F.col("Sector3Time")
    return df.withColumn("SectorSum", s).withColumn(
        "TimeMismatch", F.coalesce(F.abs(F.col("LapTime") - F.col("SectorSum")) > F.lit(tolerance), F.lit(False)))


def compound_std(df: DataFrame, known: Sequence[str] = KNOWN_COMPOUNDS) -> DataFrame:
    """Exact-match standard compound names; anything else (NULL too) is UNKNOWN."""
    return df.withColumn(
        "CompoundStd", F.when(F.col("Compound").isin(list(known)), F.col("Compound")).otherwise(F.lit("UNKNOWN")))


def session_fastest(df: DataFrame, keys: Sequence[str] = SESSION_KEYS,
                    value: str = "LapTime", name: str = "FastestLapTime", source: DataFrame | None = None) -> DataFrame:
    """The minimum ``value`` per session (of ``source``, if given) attached to every row.

    Computed as a partial aggregate joined back, not a window: a window would
    send a whole session to one task, while the aggregate is combined map-side
    and its tiny result, one row per session, is broadcast.  Left to AQE, the
    laps are shuffled before that result's size is known.
    """
    mins = (df if source is None else source).groupBy(*keys).agg(F.min(value).alias(name))
    return null_safe_join(df, F.broadcast(mins), list(keys), "left")


def delta_to_fastest(df: DataFrame, keys: Sequence[str] = SESSION_KEYS, source: DataFrame | None = None) -> DataFrame:
    """C4: FastestLapTime per session (of ``source``, if given) and DeltaToFastest = LapTime - FastestLapTime."""
    return session_fastest(df, keys, source=source).withColumn("DeltaToFastest", F.col("LapTime") - F.col("FastestLapTime"))


def dedup_laps(df: DataFrame, keys: Sequence[str] = LAP_KEYS,
               order: Sequence[str] = ("LapTime", "Compound", "TyreLife"), lazy: bool = False) -> DataFrame:
    """One row per lap key; keeps the row first by ``order`` (then by all columns).

    An aggregate (min over a struct led by the order columns) instead of a
    window: copies of a frequent key are folded map-side, so even a key repeated across a
    third of the input never lands whole in one task, and the kept row is repeatable.
    Laps of other keys are dealt over tasks that follow their number; ``lazy`` doesn't count
    them and leaves that to the shuffle partitions.
    """
    keys = list(keys)
    rest = [c for c in order if c not in keys] + [c for c in df.columns if c not in keys and c not in order]
    kinds = dict(df.dtypes)
    # -0.0 + 0.0 is 0.0, the same key
    key = F.xxhash64(*[F.col(k) + F.lit(0.0) if kinds[k] in ("double", "float") else F.col(k) for k in keys])

    def fold(rows: DataFrame, dealt: bool) -> DataFrame:
        by = ["_k", *keys] if dealt else keys
        return rows.groupBy(*by).agg(F.min(F.struct(*[F.col(c) for c in rest])).alias("_keep")).select(*keys, "_keep")

    picked = fold(df, False) if lazy else scan.by_frequency(df, key, fold)
    return picked.select(*[F.col(k) for k in keys], *[F.col(f"_keep.{c}").alias(c) for c in rest]).select(*df.columns)


def silver_laps(df: DataFrame, tolerance: float = 0.1, lazy: bool = False) -> DataFrame:
    """C1 to C5, the reference's silver layer; ``lazy`` as in ``dedup_laps``.

    Copies go (C5) before C2 to C4 add their columns, so that those aren't shuffled: they
    follow from a row and its session's fastest lap, which no copy changes.
    """
    kept = silver_filter(df)
    return (kept.transform(dedup_laps, lazy=lazy)
            .transform(sector_mismatch, tolerance)
            .transform(compound_std)
            .transform(delta_to_fastest, source=kept))


def valid_laps(df: DataFrame, need_compound: bool = False, need_age: bool = False,
               max_age: float | None = None, compound: str | None = None) -> DataFrame:
    """The analyses' lap filter: LapTime present and IsAccurate, plus options."""
    cond = F.col("LapTime").isNotNull() & F.col("IsAccurate")
    if need_compound:
        cond = cond & F.col("Compound").isNotNull()
    if need_age:
        cond = cond & F.col("TyreLife").isNotNull()
    if max_age is not None:
        cond = cond & (F.col("TyreLife") <= F.lit(max_age))
    if compound is not None:
        cond = cond & (F.col("Compound") == F.lit(compound))
    return df.where(cond)
