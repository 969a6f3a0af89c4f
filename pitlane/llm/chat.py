"""Chat formatting after cumulative-snapshot collapse, in DataFrame operations only.

Loggers write a conversation again after every turn, so the log holds prefixes of
conversations beside the longest form.  A rolling hash over each conversation's
turns names every prefix; a conversation whose whole hash is a proper prefix hash
of another is a snapshot of it, and an anti-join drops it.  Of equal conversations
the one with the smallest id stays.  What is left is rendered with role markers.

No step holds a whole conversation in one task: the turns are sorted by range over
all tasks, a conversation may go on over many ranges, and per-range totals carry
its position and hash from one to the next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitlane.llm.common import land

SEGMENT_TURNS = 1000
#: Markers around a turn, as text.
OPEN, MIDDLE, CLOSE = "<|", "|>\n", "\n<|end|>\n"


def ordered_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """(conv_id, pos, role, text, h1, h2) per turn, as a written table.

    Turns are ordered by turn number, null first, then role and text.  ``pos`` counts
    from 1.  (h1, h2) hash the turns up to this one, each with its position.  Repeated
    rows count once.  Null roles and texts are kept apart from empty ones.  Rows without
    a conversation id belong to none and are left out.
    """
    rows = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.col(role_col).alias("role"), F.col(text_col).alias("text")).distinct()
    order = ["conv_id", "turn", "role", "text"]
    ranged = land(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "turns")
    sizes = ranged.groupBy("conv_id", "range").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("conv_id", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy("conv_id", "range").orderBy("turn", "role", "text")
    placed = ranged.withColumn("own", F.row_number().over(inside)).join(starts, ["conv_id", "range"]).withColumn(
        "pos", F.col("start") + F.col("own"))
    # xxhash64 skips nulls, so their places go in as well
    content = [F.col("role").isNull(), F.col("text").isNull(), "role", "text"]
    hashed = land(placed.select("conv_id", "range", "pos", "role", "text", F.xxhash64("pos", *content).alias("t1"),
                                F.xxhash64(F.lit("second"), *content, "pos").alias("t2")), "placed")
    sums = hashed.groupBy("conv_id", "range").agg(F.bit_xor("t1").alias("t1"), F.bit_xor("t2").alias("t2"))
    carried = sums.select("conv_id", "range", *[
        F.coalesce(F.bit_xor(f"t{i}").over(earlier), F.lit(0)).alias(f"c{i}") for i in (1, 2)])
    upto = Window.partitionBy("conv_id", "range").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rolled = hashed.select("conv_id", "range", "pos", "role", "text", *[
        F.bit_xor(f"t{i}").over(upto).alias(f"r{i}") for i in (1, 2)]).join(carried, ["conv_id", "range"])
    return land(rolled.select("conv_id", "pos", "role", "text", *[
        F.col(f"r{i}").bitwiseXOR(F.col(f"c{i}")).alias(f"h{i}") for i in (1, 2)]), "rolled")


def maximal(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, copies, snapshots) of the conversations that stay, from ``ordered_turns``.

    ``copies`` counts the equal conversations this one stands for, itself included;
    ``snapshots`` the conversations that are equal to one of its proper prefixes.
    """
    slim = turns.select("conv_id", "pos", "h1", "h2")
    ends = slim.groupBy("conv_id").agg(F.max(F.struct("pos", "h1", "h2")).alias("last")).select(
        "conv_id", F.col("last.pos").alias("pos"), F.col("last.h1").alias("h1"), F.col("last.h2").alias("h2"))
    # equal conversations fold first, so a hot one is a single row in what follows
    kinds = land(ends.groupBy("pos", "h1", "h2").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies")),
                 "kinds")
    prefixes = slim.join(kinds.select("conv_id", F.col("pos").alias("n_turns")), "conv_id").where(
        F.col("pos") < F.col("n_turns"))
    key = ["pos", "h1", "h2"]
    proper = prefixes.select(*key).distinct()
    kept = kinds.join(proper, key, "left_anti")
    # which snapshots each kept conversation covers
    inside = prefixes.join(kinds.select(*key, F.col("copies").alias("same")), key).groupBy("conv_id").agg(
        F.sum("same").alias("snapshots"))
    return kept.select("conv_id", F.col("pos").alias("n_turns"), "copies").join(inside, "conv_id", "left").select(
        "conv_id", F.col("n_turns").cast("long"), "copies", F.coalesce("snapshots", F.lit(0)).alias("snapshots"))


def render_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), F.coalesce(role, F.lit("")), F.lit(MIDDLE), F.coalesce(text, F.lit("")), F.lit(CLOSE))


def render(turns: DataFrame, kept: DataFrame, segment_turns: int = SEGMENT_TURNS) -> DataFrame:
    """(conv_id, n_turns, copies, snapshots, segment, text) of the kept conversations.

    A conversation is one row, or one for every ``segment_turns`` turns: the texts of
    its segments in order, put together, are the conversation.  Null roles and texts
    are rendered as empty.
    """
    pieces = turns.select("conv_id", "pos", F.floor((F.col("pos") - 1) / segment_turns).alias("segment"),
                          render_turn(F.col("role"), F.col("text")).alias("piece"))
    joined = pieces.join(kept, "conv_id")
    return joined.groupBy("conv_id", "n_turns", "copies", "snapshots", "segment").agg(
        F.array_sort(F.collect_list(F.struct("pos", "piece"))).alias("pieces")).select(
        "conv_id", "n_turns", "copies", "snapshots", "segment", F.array_join("pieces.piece", "").alias("text"))


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", segment_turns: int = SEGMENT_TURNS) -> DataFrame:
    """Collapse snapshots and render what is left (see ``render``)."""
    rolled = ordered_turns(turns, conv_col, turn_col, role_col, text_col)
    return render(rolled, land(maximal(rolled), "kept"), segment_turns)
