"""Data-quality checks (Q1-Q8).

Each check returns a detail DataFrame and can be folded into *findings*
``(Rule, Severity, N, Detail)``; ``quality_report`` unions the findings of all
checks and aggregates them once, so nothing is collected on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, ByteType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType,
)

from pitlane.functions import scan
from pitlane.functions.stats import grouped_stats, null_safe_join, small_group_stats
from pitlane.schema import LAP_RULES, LAP_RULES_EXCLUSIVE_LO, TELEMETRY_RULES

_TYPES = {
    "int": (IntegerType, LongType, ShortType, ByteType),
    "float": (DoubleType, FloatType),
    "string": (StringType,),
    "bool": (BooleanType,),
}
SECTORS = ("Sector1Time", "Sector2Time", "Sector3Time")
FINDING_COLS = ("Rule", "Severity", "N", "Detail")


def schema_check(df: DataFrame, rules=LAP_RULES, exclusive_lo: Sequence[str] = LAP_RULES_EXCLUSIVE_LO) -> DataFrame:
    """Q1/Q2: one row per (Field, Rule) with Passed and failing-row count.

    Checks: ``present``, ``dtype`` (schema level, Failures NULL), ``nullable``
    and ``range`` / ``isin`` (NULLs skip value checks; bounds inclusive except
    ``exclusive_lo``).  All rules are evaluated in one aggregate pass (lazy).
    """
    rows, aggs = _schema_parts(df, rules, exclusive_lo)
    base = df.agg(*aggs) if aggs else df.sparkSession.range(1).select()
    structs = [F.struct(F.lit(col).alias("Field"), F.lit(chk).alias("Rule"),
                        (passed if passed is not None else (n == 0)).alias("Passed"),
                        n.cast("long").alias("Failures"))
               for col, chk, passed, n in rows]
    return base.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def _schema_parts(df: DataFrame, rules, exclusive_lo: Sequence[str]):
    """The checks as (field, check, passed or None, failing rows or None), and the aggregates they refer to."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    rows, aggs = [], []
    for name, kind, nullable, lo, hi, allowed in rules:
        present = name in fields
        rows.append((name, "present", F.lit(present), F.lit(None).cast("long")))
        if not present:
            continue
        rows.append((name, "dtype", F.lit(isinstance(fields[name], _TYPES[kind])), F.lit(None).cast("long")))
        c = F.col(name)
        if not nullable:
            aggs.append(F.count_if(c.isNull()).alias(f"{name}__nullable"))
            rows.append((name, "nullable", None, F.col(f"{name}__nullable")))
        bad = None
        if lo is not None:
            bad = (c <= F.lit(lo)) if name in exclusive_lo else (c < F.lit(lo))
        if hi is not None:
            bad = (c > F.lit(hi)) if bad is None else (bad | (c > F.lit(hi)))
        if allowed is not None:
            bad = ~c.isin(list(allowed))
        if bad is not None:
            check = "isin" if allowed is not None else "range"
            aggs.append(F.count_if(c.isNotNull() & bad).alias(f"{name}__{check}"))
            rows.append((name, check, None, F.col(f"{name}__{check}")))
    return rows, aggs


def lap_schema_check(df: DataFrame) -> DataFrame:
    return schema_check(df, LAP_RULES)


def telemetry_schema_check(df: DataFrame) -> DataFrame:
    return schema_check(df, TELEMETRY_RULES, exclusive_lo=())


def sector_correlation(df: DataFrame, tolerance: float = 0.5, issue_pct: float = 5.0) -> DataFrame:
    """Q3: laps with Sector1 present whose |LapTime - sector sum| > tolerance.

    The sum skips NULL sectors (pandas row sum).  Severity: issue above
    ``issue_pct`` percent, warning if any, ok otherwise; 'unavailable' when
    sector columns are missing.
    """
    if not all(c in df.columns for c in SECTORS):
        return df.sparkSession.range(1).select(
            F.lit(0).cast("long").alias("Checked"), F.lit(0).cast("long").alias("Mismatches"),
            F.lit(None).cast("double").alias("MismatchPct"), F.lit("unavailable").alias("Severity"))
    pct, severity = _sector_verdict(issue_pct)
    return df.agg(*_sector_parts(tolerance)).select("Checked", "Mismatches", pct.alias("MismatchPct"), severity.alias("Severity"))


def _sector_parts(tolerance: float = 0.5) -> list[Column]:
    ssum = sum(F.coalesce(F.col(c), F.lit(0.0)) for c in SECTORS)
    timed = F.col("Sector1Time").isNotNull()
    return [F.count_if(timed).alias("Checked"),
            F.count_if(timed & (F.abs(F.col("LapTime") - ssum) > F.lit(tolerance))).alias("Mismatches")]


def _sector_verdict(issue_pct: float = 5.0) -> tuple[Column, Column]:
    pct = F.when(F.col("Mismatches") > 0, F.col("Mismatches") / F.col("Checked") * 100)
    return pct, F.when(pct > F.lit(issue_pct), "issue").when(F.col("Mismatches") > 0, "warning").otherwise("ok")


# Fixed value: the issue text of the reference.
PROGRESSION_ISSUE = "Non-sequential tire life progression"


def lap_outliers(df: DataFrame, keys: Sequence[str] = ("GrandPrix", "Session", "Driver"),
                 k: float = 3.0, min_laps: int = 3) -> DataFrame:
    """Q4: the laps outside [Q1 - k IQR, Q3 + k IQR] of their driver session, one row each.

    Quartiles come from accurate, non-pit laps (a group needs ``min_laps``
    rows, and ``min_laps`` such rows counted before NULL times drop out); every
    lap of the group is judged, pit and inaccurate laps included.
    """
    kk = list(keys)
    base = df
    for c in kk:
        base = base.where(F.col(c).isNotNull())
    clean_lap = F.col("IsAccurate") & F.col("PitInTime").isNull()

    def judge(rows: DataFrame, dealt: bool) -> DataFrame:
        stats, by = (small_group_stats, ["_k"]) if dealt else (grouped_stats, kk)
        marked = rows.select(*by, F.when(clean_lap, F.col("LapTime")).alias("_time"), F.when(clean_lap, 1).alias("_ok"))
        q = stats(marked, by, "_time", {"_q1": 0.25, "_q3": 0.75}, {"_rows": ("rows", None), "_clean": ("count", "_ok")})
        bounds = q.where((F.col("_rows") >= min_laps) & (F.col("_clean") >= min_laps)).select(
            *by, (F.col("_q1") - F.lit(k) * (F.col("_q3") - F.col("_q1"))).alias("_lo"),
            (F.col("_q3") + F.lit(k) * (F.col("_q3") - F.col("_q1"))).alias("_hi"))
        judged = rows.select(*dict.fromkeys([*by, *kk]), "LapNumber", "LapTime").join(bounds, by)
        return judged.where((F.col("LapTime") < F.col("_lo")) | (F.col("LapTime") > F.col("_hi"))).select(*kk, "LapNumber", "LapTime")

    return scan.by_frequency(base, scan.deal_key(base, kk), judge)


def outlier_counts(outliers: DataFrame, keys: Sequence[str] = ("GrandPrix", "Session", "Driver")) -> DataFrame:
    """Q4: outlier laps per driver session that has any."""
    return outliers.groupBy(*keys).agg(F.count(F.lit(1)).alias("OutlierCount"))


def outlier_findings(outliers: DataFrame) -> DataFrame:
    """One finding with the number of driver sessions that have outlier laps."""
    agg = outlier_counts(outliers).agg(F.count(F.lit(1)).alias("_n"))
    return agg.where(F.col("_n") > 0).select(
        F.lit("lap_outliers").alias("Rule"), F.lit("warning").alias("Severity"), F.col("_n").alias("N"),
        F.lit("driver sessions with lap time outliers").alias("Detail"))


def tyre_progression(df: DataFrame, keys: Sequence[str] = ("GrandPrix", "Session", "Driver"),
                     stint: str = "Stint") -> DataFrame:
    """Q5: stints (>= 2 laps) whose TyreLife does not step by exactly 1 per lap.

    Laps are ordered by LapNumber within the stint; NULL diffs are ignored and
    NULL stints skipped.  Session is part of the keys, so stints of different
    sessions with one number don't mix (SURVEY D13).
    """
    if "TyreLife" not in df.columns or stint not in df.columns:
        return df.sparkSession.range(0).select(*[F.lit(None).cast("string").alias(c) for c in keys],
                                               F.lit(None).cast("double").alias(stint),
                                               F.lit(None).cast("string").alias("Issue"))
    kk = [*keys, stint]
    base = df
    for c in kk:
        base = base.where(F.col(c).isNotNull())
    order = ["LapNumber"] + (["Session"] if "Session" in df.columns and "Session" not in kk else [])
    d = scan.lag(base, kk, order, "TyreLife", "_prev", tasks=scan.tasks_for(df)).withColumn("_d", F.col("TyreLife") - F.col("_prev"))
    agg = d.groupBy(*kk).agg(F.count(F.lit(1)).alias("_n"),
                             F.count_if(F.col("_d").isNotNull() & (F.col("_d") != 1)).alias("_bad"))
    return agg.where((F.col("_n") >= 2) & (F.col("_bad") > 0)).select(
        *kk, F.lit(PROGRESSION_ISSUE).alias("Issue"))


def progression_findings(bad: DataFrame) -> DataFrame:
    agg = bad.agg(F.count(F.lit(1)).alias("_n"))
    return agg.where(F.col("_n") > 0).select(
        F.lit("tyre_progression").alias("Rule"), F.lit("warning").alias("Severity"), F.col("_n").alias("N"),
        F.lit("stints with non-sequential tyre life").alias("Detail"))


def tyre_rule_breaks(df: DataFrame, keys: Sequence[str] = ("GrandPrix", "Session", "Driver"),
                     width: float = scan.DEFAULT_WIDTH) -> DataFrame:
    """Q5: laps where pit stops, compounds, stint numbers and tyre ages contradict each other.

    Stints are derived from what happened: a lap begins a new one (``DerivedStint``) if
    the driver's lap before it ended in the pits (it has a PitInTime) or was driven on
    another compound.  Against these are held the given Stint and TyreLife; each
    contradiction is one row, and a lap can have several:

    * ``stint change without pit stop``, ``pit stop without stint change``
    * ``compound change without pit stop``
    * ``tyre life not reset after pit stop`` (it went on rising), ``tyre life reset without pit stop``

    A NULL on either side of a comparison is no contradiction.  Rows without a key or
    lap number are skipped.  Laps are scanned in buckets of lap numbers.
    """
    kk = list(keys)
    base = df
    for c in (*kk, "LapNumber"):
        base = base.where(F.col(c).isNotNull())
    tasks = scan.tasks_for(df)
    seen = F.struct("Stint", "TyreLife", "Compound", F.col("PitInTime").isNotNull().alias("Pit"))
    d = scan.lag(base.select(*kk, "LapNumber", "Stint", "TyreLife", "Compound", "PitInTime").withColumn("_now", seen),
                 kk, ["LapNumber"], "_now", "_was", width, tasks)
    was = F.col("_was")
    pit, moved = F.coalesce(was["Pit"], F.lit(False)), F.coalesce(F.col("Compound") != was["Compound"], F.lit(False))
    d = d.select(*kk, "LapNumber", "Stint", "TyreLife", "Compound", "_was", pit.alias("_pit"), moved.alias("_moved"),
                 (pit | moved).cast("int").alias("_cut"))
    d = scan.running(d, kk, "LapNumber", "_cut", "sum", "_cuts", width, tasks=tasks)
    pit, other, same = F.col("_pit"), F.col("Stint") != was["Stint"], F.col("Stint") == was["Stint"]
    rules = [(~pit & other, "stint change without pit stop"), (pit & same, "pit stop without stint change"),
             (~pit & F.col("_moved"), "compound change without pit stop"),
             (pit & (F.col("TyreLife") > was["TyreLife"]), "tyre life not reset after pit stop"),
             (~pit & (F.col("TyreLife") < was["TyreLife"]), "tyre life reset without pit stop")]
    broken = F.array_compact(F.array(*[F.when(when, F.lit(name)) for when, name in rules]))
    return d.select(*kk, "LapNumber", (F.col("_cuts") + 1).alias("DerivedStint"), "Stint", "TyreLife", F.explode(broken).alias("Issue"))


def pit_durations(df: DataFrame, keys: Sequence[str] = ("GrandPrix", "Session", "Driver"), least: float = 15.0,
                  width: float = scan.DEFAULT_WIDTH) -> DataFrame:
    """Q6: one row per pit entry with its exit, the seconds between and a verdict.

    The exit is that of the same lap if it is not before the entry, else that of the
    driver's next lap, wherever its bucket lies.  Verdicts: ``open`` (no exit known),
    ``negative``, ``short`` (under ``least`` seconds) or ``ok``.  Rows without a key
    or lap number are skipped.
    """
    kk = list(keys)
    base = df
    for c in (*kk, "LapNumber"):
        base = base.where(F.col(c).isNotNull())
    d = scan.lead(base.select(*kk, "LapNumber", "PitInTime", "PitOutTime"), kk, "LapNumber", "PitOutTime", "_next", width,
                  scan.tasks_for(df))
    out = F.when(F.col("PitOutTime") >= F.col("PitInTime"), F.col("PitOutTime")).otherwise(F.col("_next"))
    stops = d.where(F.col("PitInTime").isNotNull()).select(*kk, "LapNumber", "PitInTime", out.alias("ExitTime"))
    took = F.col("ExitTime") - F.col("PitInTime")
    return stops.withColumn("Duration", took).withColumn(
        "Verdict", F.when(took.isNull(), "open").when(took < 0, "negative").when(took < F.lit(least), "short").otherwise("ok"))


def pit_completeness(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Q6: pit-in laps and the share that also have PitOutTime; < threshold warns.

    No PitInTime column -> 'unavailable' (a warning); no PitOutTime column ->
    the completeness check is skipped.
    """
    if "PitInTime" not in df.columns:
        return df.sparkSession.range(1).select(
            F.lit(0).cast("long").alias("PitLaps"), F.lit(0).cast("long").alias("PitLapsWithOut"),
            F.lit(None).cast("double").alias("Completeness"), F.lit("unavailable").alias("Severity"))
    pit = F.col("PitInTime").isNotNull()
    if "PitOutTime" not in df.columns:  # nothing to compare against: the check is skipped
        return df.agg(F.count_if(pit).alias("PitLaps")).select(
            "PitLaps", F.lit(None).cast("long").alias("PitLapsWithOut"),
            F.lit(None).cast("double").alias("Completeness"), F.lit("ok").alias("Severity"))
    comp, severity = _pit_verdict(threshold)
    return df.agg(*_pit_parts()).select("PitLaps", "PitLapsWithOut", comp.alias("Completeness"), severity.alias("Severity"))


def _pit_parts() -> list[Column]:
    pit, out = F.col("PitInTime").isNotNull(), F.col("PitOutTime").isNotNull()
    return [F.count_if(pit).alias("PitLaps"), F.count_if(pit & out).alias("PitLapsWithOut")]


def _pit_verdict(threshold: float = 0.5) -> tuple[Column, Column]:
    comp = F.col("PitLapsWithOut") / F.greatest(F.col("PitLaps"), F.lit(1))
    return comp, F.when(comp < F.lit(threshold), "warning").otherwise("ok")


def row_findings(df: DataFrame) -> DataFrame:
    """Q1, Q3 and Q6 as findings, and the row count as one of severity 'info': one aggregate over ``df``."""
    rows, aggs = _schema_parts(df, LAP_RULES, LAP_RULES_EXCLUSIVE_LO)
    bad = sum((F.when(passed if passed is not None else n == 0, 0).otherwise(1) for _, _, passed, n in rows), F.lit(0))
    finding = lambda rule, severity, n, detail: F.struct(
        F.lit(rule).alias("Rule"), severity.alias("Severity"), n.cast("long").alias("N"), F.lit(detail).alias("Detail"))
    ok = F.lit("ok")
    found = [finding("total_rows", F.lit("info"), F.col("TotalRows"), None),
             finding("schema", F.when(bad > 0, "issue").otherwise(ok), bad, "Some lap columns break their rules")]
    aggs = [*aggs, F.count(F.lit(1)).alias("TotalRows")]
    if all(c in df.columns for c in SECTORS):
        aggs += _sector_parts()
        found.append(finding("sector_correlation", _sector_verdict()[1], F.col("Mismatches"), "sector sum differs from lap time"))
    else:
        found.append(finding("sector_correlation", F.lit("warning"), F.lit(0), "no sector times to compare"))
    if "PitInTime" not in df.columns:
        found.append(finding("pit_completeness", F.lit("warning"), F.lit(0), "no pit entry times"))
    elif "PitOutTime" in df.columns:
        aggs += _pit_parts()
        found.append(finding("pit_completeness", _pit_verdict()[1], F.col("PitLaps"), "many pit laps lack an exit time"))
    one = df.agg(*aggs)
    return one.select(F.explode(F.array(*found)).alias("f")).select("f.*").where(F.col("Severity") != "ok")


def quality_findings(df: DataFrame) -> DataFrame:
    """All findings of Q1 and Q3-Q6 as one DataFrame, with the row count as a finding of severity 'info'."""
    return row_findings(df).unionByName(outlier_findings(lap_outliers(df))).unionByName(
        progression_findings(tyre_progression(df)))


def quality_report(df: DataFrame) -> DataFrame:
    """Q7: TotalRows, SchemaValid, Issues, Warnings, Passed in one row."""
    f = quality_findings(df)
    agg = f.agg(F.max(F.when(F.col("Rule") == "total_rows", F.col("N"))).alias("TotalRows"),
                (F.count_if(F.col("Rule") == "schema") == 0).alias("SchemaValid"),
                F.count_if(F.col("Severity") == "issue").alias("Issues"),
                F.count_if(F.col("Severity") == "warning").alias("Warnings"))
    return agg.withColumn("Passed", F.col("SchemaValid") & (F.col("Issues") == 0))


def cross_compound(df: DataFrame, keys: Sequence[str] = ("GrandPrix", "Circuit"),
                   min_laps: int = 5, min_compounds: int = 2) -> DataFrame:
    """Q8: per circuit, compounds with >= ``min_laps`` timed laps; ExpectedOrder.

    Emits one row per qualifying compound for circuits with at least
    ``min_compounds`` of them.  ExpectedOrder (soft < medium < hard medians,
    strict) is set only when all three dry compounds qualify.
    """
    kk = [*keys, "Compound"]
    base = df
    for c in kk:
        base = base.where(F.col(c).isNotNull())
    agg = grouped_stats(base, kk, "LapTime", {"MedianLapTime": 0.5}, {
        "MeanLapTime": ("avg", "LapTime"), "LapCount": ("count", "LapTime")}).where(F.col("LapCount") >= min_laps).select(
        *kk, "MeanLapTime", "LapCount", "MedianLapTime")
    w = Window.partitionBy(*keys)
    med = lambda c: F.max(F.when(F.col("Compound") == c, F.col("MedianLapTime"))).over(w)
    out = agg.withColumn("CompoundsQualified", F.count(F.lit(1)).over(w)) \
        .withColumn("_s", med("SOFT")).withColumn("_m", med("MEDIUM")).withColumn("_h", med("HARD"))
    all3 = F.col("_s").isNotNull() & F.col("_m").isNotNull() & F.col("_h").isNotNull()
    out = out.withColumn("ExpectedOrder", F.when(all3, (F.col("_s") < F.col("_m")) & (F.col("_m") < F.col("_h"))))
    return out.where(F.col("CompoundsQualified") >= min_compounds).drop("_s", "_m", "_h")
