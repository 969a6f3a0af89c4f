"""Ordered scans (running aggregates, lag, rolling mean) without one task per group.

A plain ``Window.partitionBy(group).orderBy(o)`` sends each group to one task.
Here rows are cut into order-preserving buckets ``floor(o / width)``:

* running sum / count / min: per-bucket totals form a small table whose
  exclusive prefix (a window over buckets, one row per non-empty bucket) is
  each bucket's offset; inside a bucket an ordinary window adds the rest;
* lag / rolling mean over the previous ``n`` rows: each bucket's last ``n``
  rows (bounded: ``n`` values) are carried to the next non-empty buckets as
  halo rows, and the in-bucket window runs over halo + bucket rows.

Only rows of one bucket are ever ordered together, so a group holding a third
of all rows is spread over ``rows / width`` tasks.  Results equal the plain
window for any width (tested against it).

The rows of a scan are dealt to tasks by their bucket, in numbers that follow the rows
(``tasks_for``): neither few shuffle partitions nor adaptive execution, which merges
partitions by their compressed bytes, lets a task's memory grow with the input.

Such buckets bound order values, not rows.  Where many rows may share one order
value, ``ranged`` cuts the rows themselves into ranges of about equal size under a
total order; every scan here then works on those ranges instead.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitlane.session import scratch_path

DEFAULT_WIDTH = 256.0
#: Rows of one task of a scan.
TASK_ROWS = 250_000
#: ``by_frequency`` looks at so many rows per ``TASK_ROWS``; a key seen this often among them has some 16,000 rows or more.
SAMPLED, FREQUENT = 256, 16
#: Columns of a ranged frame: the range, and what orders rows of one group and order value.
RANGE, TIES = "_range", ("_tie", "_id")


def tasks_for(df: DataFrame) -> int:
    """Tasks for the rows of ``df``, at most ``TASK_ROWS`` each; 0 (as Spark deals them) if one would do.

    The rows are counted, which for landed tables reads the footers.  Not fewer than the
    shuffle partitions: Spark would shuffle dealt rows again to reach their number.
    """
    tasks = -(-df.count() // TASK_ROWS)
    return max(tasks, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))) if tasks > 1 else 0


def deal(df: DataFrame, tasks: int, *keys: str) -> DataFrame:
    """``df`` with its rows dealt over ``tasks`` by ``keys``; as it is if that is 0."""
    return df.repartition(tasks, *keys) if tasks else df


def by_frequency(df: DataFrame, key: Column, fold: Callable[[DataFrame, bool], DataFrame]) -> DataFrame:
    """``fold`` of the rows of ``df``, which have ``key`` as ``_k``: rare keys dealt over tasks by ``_k``, frequent ones apart.

    ``fold`` gets rows and whether they are dealt: then a key's rows lie in one task, few enough
    for it, and grouping by ``_k`` shuffles nothing more.  The rows of frequent keys, as a sample
    shows them, stay where they are, so that Spark folds them before it shuffles.  The sample
    decides only where a key is folded; every row is.  Rows that one task holds aren't dealt.
    """
    d, tasks = df.withColumn("_k", key), tasks_for(df)
    if not tasks:
        return fold(d, False)
    seen = d.select("_k").where(F.rand(0) * TASK_ROWS < SAMPLED).groupBy("_k").count()
    frequent = seen.where(F.col("count") >= FREQUENT).select("_k").collect()  # one of 16,000 rows at most
    if not frequent:
        return fold(deal(d, tasks, "_k"), True)
    few = F.broadcast(df.sparkSession.createDataFrame(frequent, d.select("_k").schema))
    return fold(deal(d.join(few, "_k", "left_anti"), tasks, "_k"), True).unionByName(fold(d.join(few, "_k", "left_semi"), False))


def _bucket(order: str, width: float) -> Column:
    return F.coalesce(F.floor(F.col(order) / F.lit(float(width))), F.lit(-(1 << 62)))


def ranged(df: DataFrame, group: Sequence[str], order: Sequence[str], tasks: int | None = None) -> DataFrame:
    """``df`` in ``tasks`` ranges of about equal size by (group, order, hash of the row, row number).

    The number of shuffle partitions if ``tasks`` is not given.  The ranges are written
    to the shared folder: a lost executor reads them again, so that no row changes its
    range between the passes over them.  A million rows with one order value, or a
    million copies of one row, spread like any others.  Rows that differ have a defined
    order; copies may swap places, which no result shows.  ``unranged`` drops the
    helper columns.  Map columns can't be hashed and are refused by Spark.
    """
    spark = df.sparkSession
    n = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = df.withColumns({"_tie": F.xxhash64(*df.columns), "_id": F.monotonically_increasing_id()})
    d = d.repartitionByRange(n, *group, *order, *TIES).withColumn(RANGE, F.spark_partition_id().cast("long"))
    path = scratch_path(spark, "ranged")
    d.write.parquet(path)
    return spark.read.schema(d.schema).parquet(path)


def unranged(df: DataFrame) -> DataFrame:
    return df.drop(RANGE, *TIES)


def _cut(df: DataFrame, order: Sequence[str], width: float) -> tuple[DataFrame, list[str]]:
    """``df`` with its bucket ``_sb``, and the columns that order rows inside: ranges and ties if it has them."""
    if RANGE in df.columns:
        return df.withColumn("_sb", F.col(RANGE)), [*order, *TIES]
    return df.withColumn("_sb", _bucket(order[0], width)), list(order)


def group_key(group: Sequence[str]) -> Column:
    """The group as one struct: equal also where keys are NULL, so joins and windows share one partitioning."""
    return F.struct(*[F.col(c) for c in group])


def deal_key(df: DataFrame, group: Sequence[str]) -> Column:
    """``group_key`` with floating numbers as text.

    Joins and windows normalise them (-0.0, NaN), after which rows that were dealt by the
    plain numbers would be shuffled once more.
    """
    kinds = dict(df.dtypes)
    text = lambda c: (F.col(c) + F.lit(0.0)).cast("string").alias(c)  # noqa: E731  -0.0 + 0.0 is 0.0
    return F.struct(*[text(c) if kinds[c] in ("double", "float") else F.col(c) for c in group])


def running(df: DataFrame, group: Sequence[str], order: str, value: str | None, kind: str, name: str,
            width: float = DEFAULT_WIDTH, source: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """Add ``name`` = running ``kind`` (sum, count, min) of ``value`` up to and
    including the current row, rows ordered by ``order`` within ``group``.
    Bucket totals come from ``source``, the same rows before other columns were added.
    ``tasks``: over how many the rows are dealt (``tasks_for`` them if not given).

    ``count`` with ``value=None`` counts rows (a 1-based row number).
    NULL values are skipped as by Spark's window aggregates.
    """
    v = F.lit(1) if value is None else F.col(value)
    agg = {"sum": F.sum, "count": F.count, "min": F.min}[kind]
    marked = lambda x: _cut(x.withColumn("_g", deal_key(x, group)), [order], width)
    d, by = marked(df)
    source = df if source is None else source
    d = deal(d, tasks_for(source) if tasks is None else tasks, "_g", "_sb")
    tot = marked(source)[0].groupBy("_g", "_sb").agg(agg(v).alias("_bt"))
    before = Window.partitionBy("_g").orderBy("_sb").rowsBetween(Window.unboundedPreceding, -1)
    prev = {"sum": F.sum, "count": F.sum, "min": F.min}[kind]("_bt").over(before)
    offs = tot.select("_g", "_sb", prev.alias("_off"))
    within = Window.partitionBy("_g", "_sb").orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
    d = d.join(offs, ["_g", "_sb"]).withColumn("_in", agg(v).over(within))
    if kind == "min":
        out = F.least(F.col("_in"), F.col("_off"))  # least() skips NULLs
    else:
        out = F.col("_in") + F.coalesce(F.col("_off"), F.lit(0))
    return d.withColumn(name, out).drop("_g", "_sb", "_in", "_off")


def _with_halo(df: DataFrame, group: Sequence[str], order: Sequence[str], cols: Sequence[str], n: int,
               width: float, tasks: int | None = None) -> DataFrame:
    """Rows plus, per bucket, the ``n`` rows that precede the bucket (flag ``_halo``), dealt by bucket (``_g``, ``_sb``)."""
    g = list(group)
    tasks = tasks_for(df) if tasks is None else tasks
    d, order = _cut(df, order, width)
    payload = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in cols])
    # each bucket's last n rows (at most n per bucket are collected; order columns lead the struct)
    last_first = Window.partitionBy(*g, "_sb").orderBy(*[F.col(c).desc() for c in order])
    tails = (d.withColumn("_rd", F.row_number().over(last_first)).where(F.col("_rd") <= n)
             .groupBy(*g, "_sb").agg(F.sort_array(F.collect_list(payload)).alias("_tail")))
    # the n rows before a bucket lie in at most the n previous non-empty buckets
    prev = Window.partitionBy(*g).orderBy("_sb").rowsBetween(-n, -1)
    halo = tails.select(*g, "_sb", F.flatten(F.collect_list("_tail").over(prev)).alias("_h"))
    # last n of the sorted list (a negative slice start would drop lists shorter than n)
    last_n = F.slice(F.sort_array("_h"), F.greatest(F.size("_h") - n + 1, F.lit(1)), n)
    halo = halo.select(*g, "_sb", F.explode(last_n).alias("_r")).select(
        *g, "_sb", *[F.col(f"_r.{c}").alias(c) for c in [*order, *cols]], F.lit(True).alias("_halo"))
    real = d.select(*g, "_sb", *order, *cols, *[c for c in df.columns if c not in {*g, *order, *cols}],
                    F.lit(False).alias("_halo"))
    u = real.unionByName(halo, allowMissingColumns=True)
    return deal(u.withColumn("_g", deal_key(u, g)), tasks, "_g", "_sb")


def lag(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, name: str,
        width: float = DEFAULT_WIDTH, tasks: int | None = None) -> DataFrame:
    """Add ``name`` = ``value`` of the previous row in (group, order); ``tasks`` as in ``running``."""
    u = _with_halo(df, group, order, [value], 1, width, tasks)
    order = [*order, *(TIES if RANGE in df.columns else ())]
    w = Window.partitionBy("_g", "_sb").orderBy(*[F.col(c) for c in order], F.col("_halo").desc())
    u = u.withColumn(name, F.lag(value).over(w))
    return u.where(~F.col("_halo")).drop("_sb", "_halo").select(*df.columns, name)


def lead(df: DataFrame, group: Sequence[str], order: str, value: str, name: str, width: float = DEFAULT_WIDTH,
         tasks: int | None = None) -> DataFrame:
    """Add ``name`` = ``value`` of the next row in (group, order): ``lag`` along the numeric ``order`` reversed."""
    back = df.withColumn("_back", -F.col(order))
    return lag(back, group, ["_back"], value, name, width, tasks).drop("_back")


def rolling_mean(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, name: str,
                 rows: int = 3, width: float = DEFAULT_WIDTH, tasks: int | None = None) -> DataFrame:
    """Add ``name`` = mean of ``value`` over this row and the ``rows - 1`` before it; ``tasks`` as in ``running``."""
    u = _with_halo(df, group, order, [value], rows - 1, width, tasks)
    order = [*order, *(TIES if RANGE in df.columns else ())]
    w = (Window.partitionBy("_g", "_sb").orderBy(*[F.col(c) for c in order], F.col("_halo").desc())
         .rowsBetween(-(rows - 1), 0))
    u = u.withColumn(name, F.avg(value).over(w))
    return u.where(~F.col("_halo")).drop("_sb", "_halo").select(*df.columns, name)


def keyed(df: DataFrame, group: Sequence[str], order: str, width: float = DEFAULT_WIDTH) -> DataFrame:
    """``df`` with its group ``_g`` and bucket ``_sb``."""
    return df.withColumn("_g", deal_key(df, group)).withColumn("_sb", _bucket(order, width))


def carry(df: DataFrame, group: Sequence[str], order: str, value: str, width: float = DEFAULT_WIDTH) -> DataFrame:
    """One row per group and bucket with what ``past`` needs of the rows before: ``_prev``, ``_halo``, and ``_last``."""
    newest = F.slice(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v"))), asc=False), 1, 2)
    tot = keyed(df, group, order, width).groupBy("_g", "_sb").agg(
        F.min(value).alias("_bmin"), F.max(order).alias("_bmax"), newest.alias("_tail"))
    all_ = Window.partitionBy("_g")
    by = all_.orderBy("_sb")
    return tot.select(
        "_g", "_sb", F.max("_bmax").over(all_).alias("_last"),
        F.min("_bmin").over(by.rowsBetween(Window.unboundedPreceding, -1)).alias("_prev"),
        # the two rows before a bucket lie in the two buckets before it
        F.sort_array(F.flatten(F.collect_list("_tail").over(by.rowsBetween(-2, -1))), asc=False).alias("_halo"))


def carry_places(df: DataFrame, group: Sequence[str], part: str, order: str, width: float = DEFAULT_WIDTH) -> DataFrame:
    """Per group and bucket ``_parts``: (value ``p`` of ``part``, number ``o`` of its rows in the group's buckets before).

    Only values that have such rows are listed; a bucket without any has no row.
    """
    tot = keyed(df.where(F.col(part).isNotNull()), group, order, width).groupBy("_g", "_sb", part).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_g", part).orderBy("_sb").rowsBetween(Window.unboundedPreceding, -1)
    return tot.withColumn("_o", F.sum("_n").over(before)).where(F.col("_o").isNotNull()).groupBy("_g", "_sb").agg(
        F.collect_list(F.struct(F.col(part).alias("p"), F.col("_o").alias("o"))).alias("_parts"))


def past(d: DataFrame, carried: DataFrame, order: str, value: str) -> DataFrame:
    """``_min``, ``_p1``, ``_p2`` and ``_last`` (see ``history``) for ``keyed`` rows, from ``carry``'s table."""
    inside = Window.partitionBy("_g", "_sb").orderBy(order)
    n, v = F.row_number().over(inside), F.col(value)
    halo = lambda i: F.get("_halo", F.lit(i))["v"]
    return d.join(carried, ["_g", "_sb"]).withColumns({
        "_min": F.least(F.min(v).over(inside.rowsBetween(Window.unboundedPreceding, 0)), F.col("_prev")),
        "_p1": F.when(n >= 2, F.lag(v, 1).over(inside)).otherwise(halo(0)),
        "_p2": F.when(n >= 3, F.lag(v, 2).over(inside)).when(n == 2, halo(0)).otherwise(halo(1))}).drop("_prev", "_halo")


def place(d: DataFrame, part: str, order: str, name: str) -> DataFrame:
    """Add ``name``: a row's 1-based place among those of its group and ``part`` (NULL if that is), from ``carry_places``."""
    inside = Window.partitionBy("_g", "_sb", part).orderBy(order)
    before = F.get(F.filter("_parts", lambda x: x["p"] == F.col(part)), F.lit(0))["o"]
    return d.withColumn(name, F.when(F.col(part).isNotNull(), F.row_number().over(inside) + F.coalesce(before, F.lit(0)))).drop("_parts")


def history(df: DataFrame, group: Sequence[str], order: str, value: str, width: float = DEFAULT_WIDTH,
            tasks: int | None = None) -> DataFrame:
    """Add ``_min`` (running minimum of ``value``), ``_p1`` and ``_p2`` (its values one and two rows
    before) and ``_last`` (the group's largest ``order``) in one bucketed pass.

    One aggregate per bucket, one window over the small bucket table, one join back,
    and one window inside the buckets.  ``tasks`` as in ``running``.
    """
    d = deal(keyed(df, group, order, width), tasks_for(df) if tasks is None else tasks, "_g", "_sb")
    return past(d, carry(df, group, order, value, width), order, value).drop("_g", "_sb")
