"""Running positions and previous values over a message order, without one task per group.

A plain ``Window.partitionBy(group)`` sends a whole consumer to one task. Here the order column is
cut into blocks of at most ``BLOCK`` positions. Windows run inside a block, and what a block needs
from the blocks before it comes from a summary with one row per block, itself folded in two levels
so that no window ever sees more than ``BLOCK`` rows of a dense group.

The group is one struct column, which is never null itself: joins are plain equality on the columns
the windows partition by, so the rows shuffle once for both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 65_536


def _blocks(df: DataFrame, group: list[str], order: str, block: int) -> DataFrame:
    return df.withColumns({
        "_group": F.struct(*group), "_block": F.expr(f"`{order}` div {block}")
    })


def _attach(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join on the group and one more key."""
    right = right.withColumnsRenamed({"_group": "_rg", key: "_rk"})
    on = (left["_group"] == right["_rg"]) & (left[key] == right["_rk"])
    return left.join(right, on, "left").drop("_rg", "_rk")


def number_rows(
    df: DataFrame, group: list[str], order: str, into: str, block: int = BLOCK
) -> DataFrame:
    """Add ``into``: the exact 0-based position of each row in its group by ``order``.

    ``order`` is a whole number, not null and unique inside a group.
    """
    rows = _blocks(df, group, order, block)
    counts = (
        rows.groupBy("_group", "_block").agg(F.count("*").alias("_n"))
        .withColumn("_super", F.expr(f"_block div {block}"))
    )

    def before(by: str, *partition: str):
        """Sum of the counts of all earlier rows."""
        w = Window.partitionBy(*partition).orderBy(by)
        return F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    supers = (
        counts.groupBy("_group", "_super").agg(F.sum("_n").alias("_n"))
        .select("_group", "_super", before("_super", "_group").alias("_far"))
    )
    near = counts.select(
        "_group", "_super", "_block", before("_block", "_group", "_super").alias("_near")
    )
    starts = _attach(near, supers, "_super").select(
        "_group", "_block", (F.col("_near") + F.col("_far")).alias("_start")
    )
    place = F.row_number().over(Window.partitionBy("_group", "_block").orderBy(order))
    return (
        _attach(rows, starts, "_block")
        .withColumn(into, F.col("_start") + place - F.lit(1).cast("bigint"))
        .drop("_group", "_block", "_start")
    )


def previous_value(
    df: DataFrame, group: list[str], order: str, value: str, into: str, block: int = BLOCK
) -> DataFrame:
    """Add ``into``: ``value`` of the row just before, by ``order``, in the same group (or null)."""
    rows = _blocks(df, group, order, block)
    # The value sits in a struct so that a null value differs from "no row before".
    held = F.struct(F.col(value).alias("v"))
    tails = (
        rows.groupBy("_group", "_block").agg(F.max_by(held, F.col(order)).alias("_tail"))
        .withColumn("_super", F.expr(f"_block div {block}"))
    )

    def last(by: str, *partition: str):
        return F.lag("_tail").over(Window.partitionBy(*partition).orderBy(by))

    supers = (
        tails.groupBy("_group", "_super").agg(F.max_by("_tail", "_block").alias("_tail"))
        .select("_group", "_super", last("_super", "_group").alias("_far"))
    )
    near = tails.select(
        "_group", "_super", "_block", last("_block", "_group", "_super").alias("_near")
    )
    carried = _attach(near, supers, "_super").select(
        "_group", "_block", F.coalesce("_near", "_far").alias("_carried")
    )
    here = F.lag(held).over(Window.partitionBy("_group", "_block").orderBy(order))
    return (
        _attach(rows, carried, "_block")
        .withColumn(into, F.coalesce(here, F.col("_carried"))["v"])
        .drop("_group", "_block", "_carried")
    )


def earlier_max(
    df: DataFrame, group: list[str], order: str, value: str, into: str, block: int = BLOCK
) -> DataFrame:
    """Add ``into``: the largest ``value`` of all rows before, by ``order``, in the same group."""
    rows = _blocks(df, group, order, block)
    tops = (
        rows.groupBy("_group", "_block").agg(F.max(value).alias("_top"))
        .withColumn("_super", F.expr(f"_block div {block}"))
    )

    def before(what: str, by: str, *partition: str):
        w = Window.partitionBy(*partition).orderBy(by)
        return F.max(what).over(w.rowsBetween(Window.unboundedPreceding, -1))

    supers = (
        tops.groupBy("_group", "_super").agg(F.max("_top").alias("_top"))
        .select("_group", "_super", before("_top", "_super", "_group").alias("_far"))
    )
    near = tops.select(
        "_group", "_super", "_block", before("_top", "_block", "_group", "_super").alias("_near")
    )
    carried = _attach(near, supers, "_super").select(
        "_group", "_block", F.greatest("_near", "_far").alias("_carried")
    )
    here = before(value, order, "_group", "_block")
    return (
        _attach(rows, carried, "_block")
        .withColumn(into, F.greatest(here, F.col("_carried")))
        .drop("_group", "_block", "_carried")
    )
