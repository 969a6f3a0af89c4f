"""Grouped statistics that stay exact and stay balanced when one group is huge.

Spark's ``percentile`` aggregate keeps every distinct value of a group in one
task's memory.  Lap data has a handful of compounds, so a single group can hold
a third of all rows.  ``grouped_stats`` therefore works on a value histogram:
repeated values fold map-side, and hashing on (group, value) spreads a hot group.
Each group's histogram is cut into order-preserving buckets at a hash sample of
its own values, one in ``bucket_values`` on average, so a bucket's size doesn't
depend on the group's; a group with few values has one bucket.  Prefix sums over
the buckets give every bucket its rank offset, and quantiles are interpolated
linearly (pandas / DuckDB ``quantile_cont``).  Counts, sums, means, extremes and
deviations come out of the same histogram, so nothing is joined back.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_VALUES = 1 << 15


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   how: str = "inner") -> DataFrame:
    """Join on ``keys`` treating NULL = NULL (Spark groupBy keeps NULL groups)."""
    if not keys:
        raise ValueError("null_safe_join needs at least one key (no cross joins)")
    r = right
    for k in keys:
        r = r.withColumnRenamed(k, f"__r_{k}")
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        cond = c if cond is None else cond & c
    j = left.join(r, cond, how)
    if how.lower() in ("full", "outer", "fullouter", "full_outer", "right", "rightouter", "right_outer"):
        # right-only rows carry their keys on the right side
        j = j.withColumns({k: F.coalesce(F.col(k), F.col(f"__r_{k}")) for k in keys})
    return j.drop(*[f"__r_{k}" for k in keys])


#: Aggregates that ``grouped_stats`` can carry through the histogram: name -> parts of a column it needs.
_PARTS = {"rows": (), "count": ("n",), "sum": ("s",), "avg": ("s", "n"), "min": ("lo",), "max": ("hi",),
          "stddev": ("s", "q", "n")}


def _value_at(rank: Column) -> Column:
    """The bucket's value at a 1-based rank: the first whose running count reaches it."""
    return F.aggregate(
        "_vals", F.struct(F.lit(0).cast("long").alias("run"), F.lit(None).cast("double").alias("v")),
        lambda acc, e: F.struct(
            (acc["run"] + e["c"]).alias("run"),
            F.when(acc["v"].isNull() & (acc["run"] + e["c"] >= rank), e["v"]).otherwise(acc["v"]).alias("v")),
        lambda acc: acc["v"])


def grouped_stats(df: DataFrame, keys: Sequence[str], value: str | Column, probs: Mapping[str, float],
                  aggs: Mapping[str, tuple[str, str | None]] | None = None, *,
                  bucket_values: int = BUCKET_VALUES) -> DataFrame:
    """Exact quantiles of ``value`` and further aggregates per ``keys`` in one pass over ``df``.

    ``aggs`` maps an output name to (kind, column); kinds are rows (column None),
    count, sum, avg, min, max and stddev (of the sample).  Returns ``keys``, the
    ``probs`` and the ``aggs``, one row per group.  NULL values don't count for the
    quantiles; a group without values has NULL quantiles.
    """
    keys, aggs = list(keys), dict(aggs or {})
    if not keys:  # one global group: a constant key keeps the join an equi-join
        return grouped_stats(df.withColumn("_all", F.lit(0)), ["_all"], value, probs, aggs,
                             bucket_values=bucket_values).drop("_all")
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    cols = {c: f"_x{i}" for i, c in enumerate(dict.fromkeys(c for _, c in aggs.values() if c))}
    need = dict.fromkeys((x, part) for kind, c in aggs.values() for part in _PARTS[kind] for x in [cols.get(c)] if x)
    first = {"n": F.count, "s": F.sum, "q": lambda x: F.sum(F.col(x) * F.col(x)), "lo": F.min, "hi": F.max}
    merge = {"n": F.sum, "s": F.sum, "q": F.sum, "lo": F.min, "hi": F.max}

    # 1. value histogram
    base = df.select(*keys, v.alias("_v"), *[F.col(c).alias(x) for c, x in cols.items()])
    hist = base.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"), *[
        first[part](x).alias(f"{x}{part}") for x, part in need])

    # 2. per group: size, the other aggregates, and the sampled cut points
    sampled = F.pmod(F.xxhash64("_v"), F.lit(bucket_values)) == 0
    totals = hist.groupBy(*keys).agg(
        F.sum(F.when(F.col("_v").isNotNull(), F.col("_c")).otherwise(0)).alias("_n"), F.sum("_c").alias("_rows"),
        F.array_sort(F.collect_list(F.when(F.col("_v").isNotNull() & sampled, F.col("_v")))).alias("_cuts"),
        *[merge[part](f"{x}{part}").alias(f"{x}{part}") for x, part in need])

    # 3. one row per bucket: its values in order, its total, and the totals of those before it
    bucketed = null_safe_join(hist.select(*keys, "_v", "_c"), totals, keys).withColumn(
        "_bk", F.size(F.filter("_cuts", lambda x: x < F.col("_v"))))
    carried = ["_n", "_rows", *[f"{x}{part}" for x, part in need]]
    present = F.col("_v").isNotNull()
    buckets = bucketed.groupBy(*keys, "_bk").agg(
        F.sum(F.when(present, F.col("_c")).otherwise(0)).alias("_size"),
        F.array_sort(F.collect_list(F.when(present, F.struct(F.col("_v").alias("v"), F.col("_c").alias("c"))))).alias("_vals"),
        *[F.first(c).alias(c) for c in carried])
    before = Window.partitionBy(*keys).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.withColumn("_off", F.coalesce(F.sum("_size").over(before), F.lit(0)))

    # 4. the values at the ranks around p * (n - 1), from the buckets that hold them
    picks, out = [], []
    for i, (name, p) in enumerate(probs.items()):
        pos = F.lit(float(p)) * (F.col("_n") - 1)
        for side, rank in (("a", F.floor(pos) + 1), ("b", F.ceil(pos) + 1)):
            inside = (rank > F.col("_off")) & (rank <= F.col("_off") + F.col("_size"))
            picks.append(F.max(F.when(inside, _value_at(rank - F.col("_off")))).alias(f"_{side}{i}"))
        out.append((F.col(f"_a{i}") + (F.col(f"_b{i}") - F.col(f"_a{i}")) * (pos - F.floor(pos))).alias(name))
    for name, (kind, c) in aggs.items():
        n, s, q = (F.col(f"{cols.get(c)}{part}") for part in "nsq")
        out.append({"rows": F.col("_rows"), "count": n, "sum": s, "avg": F.try_divide(s, n),
                    "min": F.col(f"{cols.get(c)}lo"), "max": F.col(f"{cols.get(c)}hi"),
                    "stddev": F.when(n > 1, F.sqrt(F.greatest(F.lit(0.0), q - F.try_divide(s * s, n)) / (n - 1)))}[kind].alias(name))
    done = buckets.groupBy(*keys).agg(*picks, *[F.first(c).alias(c) for c in carried])
    return done.select(*keys, *out)


def small_group_stats(df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float],
                      aggs: Mapping[str, tuple[str, str | None]]) -> DataFrame:
    """What ``grouped_stats`` finds, where a task holds a group's values: they are sorted there, and rows dealt by ``keys`` aren't shuffled.

    ``aggs`` are of the kinds rows and count.
    """
    kinds = {"rows": lambda _: F.count(F.lit(1)), "count": F.count}
    found = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.col(value).cast("double"))).alias("_vals"),
                                  *[kinds[kind](c).alias(name) for name, (kind, c) in aggs.items()])
    out = []
    for name, p in probs.items():
        pos = F.lit(float(p)) * (F.size("_vals") - 1)
        a, b = F.get("_vals", F.floor(pos).cast("int")), F.get("_vals", F.ceil(pos).cast("int"))
        out.append((a + (b - a) * (pos - F.floor(pos))).alias(name))
    return found.select(*keys, *out, *aggs)


def group_quantiles(df: DataFrame, keys: Sequence[str], value: str | Column, probs: Mapping[str, float],
                    **kw) -> DataFrame:
    """Exact quantiles of ``value`` per ``keys``: one row per group with at least one value."""
    v = F.col(value) if isinstance(value, str) else value
    return grouped_stats(df.where(v.isNotNull()), keys, v, probs, **kw)


def group_mode(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Most frequent non-NULL value per group; ties go to the smallest value.

    Two partial aggregations, so a hot group never lands whole in one task.
    """
    counts = (df.where(F.col(value).isNotNull())
              .groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_cnt")))
    return counts.groupBy(*keys).agg(
        F.min_by(F.col(value), F.struct(-F.col("_cnt"), F.col(value))).alias(name))
