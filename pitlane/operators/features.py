"""Lap-time model features (F1-F8) and the window operators behind them.

Row order is defined, not inherited (SURVEY D3): per driver session laps are
ordered by LapNumber; track evolution by (LapNumber, Driver).  Group maxima and
minima are aggregates joined back rather than windows, so a large session is
combined map-side instead of landing whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType

from pitlane.functions import scan
from pitlane.functions.scalar import PROGRESS_BINS, TYRE_LIFE_BINS, right_closed_bins, safe_div
from pitlane.functions.stats import BUCKET_VALUES, group_quantiles, null_safe_join
from pitlane.operators.clean import session_fastest
from pitlane.session import ensure_checkpoint_dir

DRIVER_KEYS = ("GrandPrix", "Session", "Driver")
SESSION_KEYS = ("GrandPrix", "Session")
SECTORS = ("Sector1Time", "Sector2Time", "Sector3Time")
# Columns the reference keeps out of the feature matrix.
EXCLUDED_COLUMNS = (
    "LapTime", "Time", "LapStartTime", "PitInTime", "PitOutTime",
    "TrackStatus", "IsAccurate", "Sector1Time", "Sector2Time",
    "Sector3Time", "FreshTyre", "ingestion_timestamp", "record_source",
)
# Features that are functions of the current LapTime (dropped when leak_free=True).
LEAKY_COLUMNS = ("DeltaToBest", "DeltaToSessionFastest", "LapTime_Rolling3", "Sector1Pct", "Sector2Pct",
                 "Sector3Pct", "SectorSum", "FastestLapTime", "DeltaToFastest", "BestLapSoFar",
                 "TrackEvolution", "TimeMismatch")
#: A field's label codes are broadcast up to this number (some 40 MB).
BROADCAST_LABELS = 500_000
CATEGORY_COLUMNS = ("TyreLifeBin", "LapNumberBin")  # pandas categoricals: NULL reads 'nan'


def _driver_window(keys: Sequence[str] = DRIVER_KEYS) -> Window:
    return Window.partitionBy(*keys).orderBy("LapNumber")


def tyre_features(df: DataFrame) -> DataFrame:
    """TyreLifeBin (right-closed bins) and IsFreshTyre (TyreLife <= 2, NULL -> 0)."""
    return df.withColumns({
        "TyreLifeBin": right_closed_bins("TyreLife", TYRE_LIFE_BINS),
        "IsFreshTyre": F.when(F.col("TyreLife") <= 2, 1).otherwise(0),
    })


def session_progress(df: DataFrame, keys: Sequence[str] = DRIVER_KEYS) -> DataFrame:
    """SessionProgress = LapNumber / max LapNumber of the driver session."""
    mx = df.groupBy(*keys).agg(F.max("LapNumber").alias("_maxlap"))
    return null_safe_join(df, mx, list(keys), "left").withColumn(
        "SessionProgress", safe_div("LapNumber", "_maxlap")).drop("_maxlap")


def progress_features(df: DataFrame) -> DataFrame:
    """SessionProgress (W6) and LapNumberBin quarters."""
    return session_progress(df).withColumn("LapNumberBin", right_closed_bins("SessionProgress", PROGRESS_BINS))


def rolling3(df: DataFrame, keys: Sequence[str] = DRIVER_KEYS, window: int = 3,
             method: str = "bucketed", tasks: int | None = None) -> DataFrame:
    """Mean LapTime of the last ``window`` laps including this one (>= 1 value).

    ``bucketed`` (default) orders only one LapNumber bucket at a time and
    carries the previous laps in as halo rows; ``ranged`` orders ranges of about
    equal numbers of rows instead, for input in which many rows share a lap number;
    ``window`` is one window per driver session.  ``tasks`` as in ``scan.running``.
    """
    if method == "window":
        w = _driver_window(keys).rowsBetween(-(window - 1), 0)
        return df.withColumn("LapTime_Rolling3", F.avg("LapTime").over(w))
    if method == "ranged":
        return scan.unranged(rolling3(scan.ranged(df, keys, ["LapNumber"]), keys, window))
    return scan.rolling_mean(df, keys, ["LapNumber"], "LapTime", "LapTime_Rolling3", rows=window, tasks=tasks)


def best_so_far(df: DataFrame, keys: Sequence[str] = DRIVER_KEYS, method: str = "bucketed",
                tasks: int | None = None) -> DataFrame:
    """Running minimum LapTime (NULL on rows without a time) and DeltaToBest; ``method``, ``tasks`` as in ``rolling3``."""
    if method == "ranged":
        return scan.unranged(best_so_far(scan.ranged(df, keys, ["LapNumber"]), keys))
    if method == "window":
        w = _driver_window(keys).rowsBetween(Window.unboundedPreceding, 0)
        df = df.withColumn("_run", F.min("LapTime").over(w))
    else:
        df = scan.running(df, keys, "LapNumber", "LapTime", "min", "_run", tasks=tasks)
    return df.withColumn("BestLapSoFar", F.when(F.col("LapTime").isNotNull(), F.col("_run"))).drop("_run") \
        .withColumn("DeltaToBest", F.col("LapTime") - F.col("BestLapSoFar"))


def history_features(df: DataFrame) -> DataFrame:
    """LapTime_Rolling3, BestLapSoFar, DeltaToBest."""
    tasks = scan.tasks_for(df)
    return best_so_far(rolling3(df, tasks=tasks), tasks=tasks)


def field_delta(df: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """DeltaToSessionFastest (W1 as aggregate + join); the aggregate is over ``source`` if given."""
    return session_fastest(df, name="_sfast", source=source).withColumn(
        "DeltaToSessionFastest", F.col("LapTime") - F.col("_sfast")).drop("_sfast")


def sector_pct(df: DataFrame) -> DataFrame:
    """each sector's share of LapTime x 100, only when all sectors exist."""
    if not all(c in df.columns for c in SECTORS):
        return df
    return df.withColumns({f"Sector{i}Pct": safe_div(f"Sector{i}Time", "LapTime") * 100 for i in (1, 2, 3)})


def laps_into_stint(df: DataFrame, keys: Sequence[str] = DRIVER_KEYS, stint: str = "Stint",
                    method: str = "bucketed", source: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """1-based lap position within the stint; NULL stint -> NULL; ``method``, ``tasks`` as in ``rolling3``."""
    if method == "ranged":
        return scan.unranged(laps_into_stint(scan.ranged(df, [*keys, stint], ["LapNumber"]), keys, stint))
    if method == "window":
        w = Window.partitionBy(*keys, stint).orderBy("LapNumber")
        df = df.withColumn("_pos", F.row_number().over(w).cast("long"))
    else:
        df = scan.running(df, [*keys, stint], "LapNumber", None, "count", "_pos", source=source, tasks=tasks)
    return df.withColumn("LapsIntoStint", F.when(F.col(stint).isNotNull(), F.col("_pos"))).drop("_pos")


def track_evolution(df: DataFrame, keys: Sequence[str] = SESSION_KEYS, method: str = "prefix",
                    source: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """Expanding mean LapTime per session in (LapNumber, Driver) order.

    ``prefix`` (default) never puts a session in one task: per-(session, lap
    number) totals form a small table whose running sums give each lap number
    its offset, and only the rows sharing one lap number of one session are
    ordered together (by Driver).  ``window`` is the direct session window.
    """
    k = list(keys)
    if method == "window":
        w = Window.partitionBy(*k).orderBy("LapNumber", "Driver").rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn("TrackEvolution", F.avg("LapTime").over(w))
    marked = lambda x: x.withColumn("_g", scan.deal_key(x, k)).withColumn("_gl", scan.deal_key(x, [*k, "LapNumber"]))
    source = df if source is None else source
    d = scan.deal(marked(df), scan.tasks_for(source) if tasks is None else tasks, "_gl")
    per_lap = marked(source).groupBy("_gl", "_g", "LapNumber").agg(F.sum("LapTime").alias("_s"), F.count("LapTime").alias("_c"))
    before = Window.partitionBy("_g").orderBy("LapNumber").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_lap.select("_gl", F.coalesce(F.sum("_s").over(before), F.lit(0.0)).alias("_os"),
                             F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_oc"))
    within = Window.partitionBy("_gl").orderBy("Driver").rowsBetween(Window.unboundedPreceding, 0)
    out = d.join(offsets, "_gl").withColumn("_rs", F.coalesce(F.sum("LapTime").over(within), F.lit(0.0))) \
        .withColumn("_rc", F.count("LapTime").over(within))
    return out.withColumn("TrackEvolution", F.try_divide(F.col("_os") + F.col("_rs"), F.col("_oc") + F.col("_rc"))) \
        .drop("_g", "_gl", "_rs", "_rc", "_os", "_oc")


def stint_track_features(df: DataFrame, source: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """LapsIntoStint (W4) and TrackEvolution (W5); totals come from ``source`` if given."""
    source = df if source is None else source
    tasks = scan.tasks_for(source) if tasks is None else tasks
    return track_evolution(laps_into_stint(df, source=source, tasks=tasks), source=source, tasks=tasks)


def tyre_age_diff(df: DataFrame, keys: Sequence[str] = ("GrandPrix", "Session", "Driver", "Stint"),
                  method: str = "bucketed") -> DataFrame:
    """TyreLife minus the previous lap's within the stint (ordered by LapNumber); ``method`` as in ``rolling3``."""
    order = ["LapNumber", *(["Session"] if "Session" in df.columns and "Session" not in keys else [])]
    if method == "window":
        w = Window.partitionBy(*keys).orderBy(*order)
        df = df.withColumn("_prev", F.lag("TyreLife").over(w))
    elif method == "ranged":
        df = scan.unranged(scan.lag(scan.ranged(df, keys, order), keys, order, "TyreLife", "_prev"))
    else:
        df = scan.lag(df, keys, order, "TyreLife", "_prev")
    return df.withColumn("TyreLifeDiff", F.col("TyreLife") - F.col("_prev")).drop("_prev")


def driver_history(df: DataFrame, keys: Sequence[str] = DRIVER_KEYS, tasks: int | None = None) -> DataFrame:
    """F2 and F3 (W2, W3, W6) together, from one bucketed pass over each driver session."""
    return _from_past(scan.history(df, keys, "LapNumber", "LapTime", tasks=tasks))


def _from_past(d: DataFrame) -> DataFrame:
    """F2 and F3 from the columns of ``scan.history``."""
    near = [F.col(c) for c in ("_p2", "_p1", "LapTime")]
    known = sum((F.when(c.isNotNull(), 1).otherwise(0) for c in near), F.lit(0))
    total = sum((F.coalesce(c, F.lit(0.0)) for c in near), F.lit(0.0))
    d = d.withColumns({
        "SessionProgress": safe_div("LapNumber", "_last"),
        "LapTime_Rolling3": F.try_divide(total, known),
        "BestLapSoFar": F.when(F.col("LapTime").isNotNull(), F.col("_min"))})
    return d.withColumns({
        "LapNumberBin": right_closed_bins("SessionProgress", PROGRESS_BINS),
        "DeltaToBest": F.col("LapTime") - F.col("BestLapSoFar")}).drop("_min", "_p1", "_p2", "_last")


def _track_seeds(df: DataFrame, tasks: int) -> DataFrame:
    """(GrandPrix, Session, Driver, LapNumber) with sum and count of the LapTimes before it in W5's order: ``_os``, ``_oc``."""
    marked = lambda x: x.withColumn("_gl", scan.deal_key(x, [*SESSION_KEYS, "LapNumber"]))
    totals = lambda x, *k: x.groupBy(*k).agg(
        F.min("LapNumber").alias("LapNumber"), F.sum("LapTime").alias("_s"), F.count("LapTime").alias("_c"))
    narrow = df.select(*DRIVER_KEYS, "LapNumber", "LapTime")
    own = totals(scan.deal(marked(narrow).select("_gl", "Driver", "LapNumber", "LapTime"), tasks, "_gl"), "_gl", "Driver")
    per_lap = totals(marked(narrow), "_gl")
    earlier = lambda w, c, zero: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(zero))
    laps = Window.partitionBy("_gl.GrandPrix", "_gl.Session").orderBy("LapNumber")
    offsets = per_lap.select("_gl", earlier(laps, "_s", 0.0).alias("_ls"), earlier(laps, "_c", 0).alias("_lc"))
    drivers = Window.partitionBy("_gl").orderBy("Driver")
    seeds = own.join(offsets, "_gl").select(
        "_gl", "Driver", "LapNumber", (F.col("_ls") + earlier(drivers, "_s", 0.0)).alias("_os"),
        (F.col("_lc") + earlier(drivers, "_c", 0)).alias("_oc"))
    return seeds.select(*[F.col(f"_gl.{k}").alias(k) for k in SESSION_KEYS], "Driver", "LapNumber", "_os", "_oc")


def lap_features(df: DataFrame) -> DataFrame:
    """F1-F6 composed; the rows of ``df`` are shuffled once, by driver session and bucket of lap numbers.

    What other rows add comes from side tables, aggregated from the few columns of
    ``df`` that they need: of a driver session's buckets before (F2, F3, W4), and for
    each lap of a driver the totals of the session's laps before it (W5), which join
    the rows as one more row per lap.  What follows from a row alone is added last.
    """
    tasks = scan.tasks_for(df)
    rows = df.withColumns({"_seed": F.lit(False), "_os": F.lit(None).cast("double"), "_oc": F.lit(None).cast("long")})
    seeds = _track_seeds(df, tasks).withColumn("_seed", F.lit(True))
    d = scan.keyed(rows.unionByName(seeds, allowMissingColumns=True), DRIVER_KEYS, "LapNumber")
    d = scan.deal(d, tasks, "_g", "_sb") if tasks else d.repartition("_g", "_sb")
    lap = Window.partitionBy("_g", "_sb", "LapNumber").orderBy(F.col("_seed").desc()).rowsBetween(Window.unboundedPreceding, 0)
    time, n = F.coalesce("_os", "LapTime", F.lit(0.0)), F.coalesce(F.col("_oc"), F.col("LapTime").isNotNull().cast("long"))
    d = d.withColumn("TrackEvolution", F.try_divide(F.sum(time).over(lap), F.sum(n).over(lap))).where(~F.col("_seed")).drop("_seed", "_os", "_oc")
    carried = scan.carry(df, DRIVER_KEYS, "LapNumber", "LapTime").join(
        scan.carry_places(df, DRIVER_KEYS, "Stint", "LapNumber"), ["_g", "_sb"], "left")
    d = scan.place(scan.past(d, carried, "LapNumber", "LapTime"), "Stint", "LapNumber", "LapsIntoStint").drop("_g", "_sb")
    out = d.transform(tyre_features).transform(_from_past).transform(field_delta, df).transform(sector_pct)
    last = ["LapsIntoStint", "TrackEvolution"]
    return out.select(*[c for c in out.columns if c not in last], *last)


def feature_columns(df: DataFrame, exclude: Sequence[str] = EXCLUDED_COLUMNS,
                    target: str = "LapTime", leak_free: bool = False) -> tuple[list[str], list[str]]:
    """(label-encoded columns, numeric columns) of the feature matrix, in frame order."""
    drop = set(exclude) | {target} | (set(LEAKY_COLUMNS) if leak_free else set())
    labels, numeric = [], []
    for f in df.schema.fields:
        if f.name in drop:
            continue
        if isinstance(f.dataType, StringType):
            labels.append(f.name)
        elif isinstance(f.dataType, (NumericType, BooleanType)):
            numeric.append(f.name)
    return labels, numeric


def _label_input(c: str) -> F.Column:
    return F.coalesce(F.col(c), F.lit("nan" if c in CATEGORY_COLUMNS else "None"))


def label_codes(df: DataFrame, labels: Sequence[str], bucket_values: int = BUCKET_VALUES) -> DataFrame:
    """(Field, Label, Code): each field's labels numbered from 0 in alphabetical order; NULL is a label of its own.

    Labels fold to distinct ones map-side.  A field's labels are cut into ranges at a
    hash sample of themselves, one in ``bucket_values``; a label's code is its place in
    its range plus the labels of the ranges before it.  So no field's labels meet in one
    task, and none pass through the driver.
    """
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("Field"), _label_input(c).alias("Label")) for c in labels])).alias("r")).select("r.*")
    distinct = long.distinct()
    cuts = distinct.groupBy("Field").agg(F.array_sort(F.collect_list(F.when(
        F.pmod(F.xxhash64("Label"), F.lit(bucket_values)) == 0, F.col("Label")))).alias("_cuts"))
    # one row per field, with one label in bucket_values
    placed = distinct.join(F.broadcast(cuts), "Field").withColumn(
        "_range", F.size(F.filter("_cuts", lambda c: c < F.col("Label")))).drop("_cuts")
    before = Window.partitionBy("Field").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("Field", "_range").agg(F.count(F.lit(1)).alias("_n")).select(
        "Field", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("Field", "_range").orderBy("Label")
    return placed.join(offsets, ["Field", "_range"]).select(
        "Field", "Label", (F.col("_before") + F.row_number().over(inside) - 1).cast("int").alias("Code"))


def numeric_medians(df: DataFrame, numeric: Sequence[str], spread: float = 0.001, accuracy: int = 10_000, **kw) -> DataFrame:
    """Exact median of every numeric column: (Field, Median); a column without values has no row.

    A sketch of each column gives two of its values between which the median must lie,
    ``spread`` of the rows to either side of it; ``accuracy`` is the sketch's.  The rows
    below are counted, and only values in between, some ``2 * spread`` of all, are folded,
    shuffled and ranked.  Should a sketch be so far off that the median lies elsewhere, that
    column's values are all ranked (``group_quantiles``, which takes ``kw``).
    """
    x = {c: F.col(c).cast("double") for c in numeric}
    if not x:
        return _field_medians(df, [], **kw)
    ends = df.agg(*[F.struct(F.count(v).alias("n"), F.percentile_approx(v, [0.5 - spread, 0.5 + spread], accuracy).alias("q"))
                    .alias(f"c{i}") for i, v in enumerate(x.values())]).first()
    known = {c: (e["n"], *e["q"]) for c, e in zip(x, ends, strict=True) if e["n"]}
    if not known:
        return _field_medians(df, list(numeric), **kw)
    counts = df.agg(*[F.struct(F.count_if(x[c] < lo).alias("below"), F.count_if(x[c] <= hi).alias("upto")).alias(f"c{i}")
                      for i, (c, (_, lo, hi)) in enumerate(known.items())]).first()
    ranks = {c: (known[c][0], e["below"], e["upto"]) for c, e in zip(known, counts, strict=True)}
    near = {c: r for c, r in ranks.items() if r[1] <= (r[0] - 1) // 2 and r[0] // 2 < r[2]}
    far = [c for c in known if c not in near]
    if not near:
        return _field_medians(df, far, **kw)
    between = F.array_compact(F.array(*[F.when((x[c] >= known[c][1]) & (x[c] <= known[c][2]), F.struct(
        F.lit(c).alias("Field"), x[c].alias("Value"))) for c in near]))
    hist = df.select(F.explode(between).alias("r")).select("r.*").groupBy("Field", "Value").agg(F.count(F.lit(1)).alias("_c"))
    spots = df.sparkSession.createDataFrame([(c, below, (n - 1) // 2 + 1, n // 2 + 1) for c, (n, below, _) in near.items()],
                                            "Field string, _below long, _a long, _b long")
    ranked = hist.join(F.broadcast(spots), "Field").withColumn("_upto", F.col("_below") + F.sum("_c").over(
        Window.partitionBy("Field").orderBy("Value").rowsBetween(Window.unboundedPreceding, 0)))
    at = lambda rank: F.max(F.when((F.col("_upto") - F.col("_c") < F.col(rank)) & (F.col(rank) <= F.col("_upto")), F.col("Value")))
    found = ranked.groupBy("Field").agg(at("_a").alias("_va"), at("_b").alias("_vb"), F.max(F.col("_b") - F.col("_a")).alias("_half")).select(
        "Field", (F.col("_va") + (F.col("_vb") - F.col("_va")) * F.when(F.col("_half") > 0, 0.5).otherwise(0.0)).alias("Median"))
    return found.unionByName(_field_medians(df, far, **kw)) if far else found


def _field_medians(df: DataFrame, numeric: Sequence[str], **kw) -> DataFrame:
    """(Field, Median) by ranking every value of the columns."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("Field"), F.col(c).cast("double").alias("Value")) for c in numeric])).alias("r")
    ).select("r.*")
    return group_quantiles(long, ["Field"], "Value", {"Median": 0.5}, **kw)


def encode_impute(df: DataFrame, codes: DataFrame | None = None, medians: dict[str, float] | None = None,
                  exclude: Sequence[str] = EXCLUDED_COLUMNS, target: str = "LapTime",
                  leak_free: bool = False, output: str = "features"):
    """F8: label-encode, fill NULLs with exact column medians, assemble a vector.

    Returns ``(frame with `output` and `label`, codes, medians, input columns)``.
    Pass ``codes`` (see ``label_codes``) and ``medians`` to encode new data the same way;
    a label that has no code raises.  Codes are joined to the rows, so a field may have
    any number of labels; those of a field with at most ``BROADCAST_LABELS`` are broadcast,
    as a join that is left to AQE shuffles the rows once per field before it knows their number.
    They are plain doubles (no nominal metadata), as in the
    reference, so trees treat them as ordered numbers and need no maxBins per category.
    """
    labels, numeric = feature_columns(df, exclude, target, leak_free)
    if codes is None:
        ensure_checkpoint_dir(df.sparkSession)
        codes = label_codes(df, labels).checkpoint()  # read once per label column
    if medians is None:
        medians = {r["Field"]: r["Median"] for r in numeric_medians(df, numeric).collect()}
    enc, sizes = df, {r["Field"]: r["count"] for r in codes.groupBy("Field").count().collect()}
    for c in labels:
        own = codes.where(F.col("Field") == c).select(F.col("Label").alias(f"{c}__lbl"), F.col("Code").alias(f"{c}__code"))
        own = F.broadcast(own) if sizes.get(c, 0) <= BROADCAST_LABELS else own
        enc = enc.withColumn(f"{c}__lbl", _label_input(c)).join(own, f"{c}__lbl", "left")
    cols = {c: F.when(F.col(f"{c}__code").isNotNull(), F.col(f"{c}__code").cast("double")).otherwise(
        F.raise_error(F.concat(F.lit(f"no code for this label of {c}: "), F.col(f"{c}__lbl"))).cast("double")) for c in labels}
    cols.update({c: F.coalesce(F.col(c).cast("double"), F.lit(medians.get(c))) for c in numeric})
    enc = enc.select(*df.columns, *[v.alias(f"{k}__x") for k, v in cols.items()])
    inputs = [f"{c}__x" for c in labels + numeric]
    assembled = VectorAssembler(inputCols=inputs, outputCol=output, handleInvalid="keep").transform(enc)
    out = assembled.withColumn("label", F.col(target).cast("double")).drop(*inputs)
    return out, codes, medians, labels + numeric
