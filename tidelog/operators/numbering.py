"""Gapless numbers for rows in two passes, without a task or a window that sees them all.

First rows are stored, each with the task that wrote it and its place in what that task wrote. Then
one row per task and group says how many rows come before; only that small table is added up in order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.operators.lookup import lookup_join
from tidelog.session import stage

_ROW_BITS = 33  # of monotonically_increasing_id: the task stands above them


def stage_rows(df: DataFrame, label: str = "rows") -> DataFrame:
    """Store rows with ``_part``, the task that wrote them, and ``_row``, their place in its output."""
    at = F.col("_at")
    placed = df.withColumn("_at", F.monotonically_increasing_id()).select(
        *[df[c] for c in df.columns],
        F.shiftright(at, _ROW_BITS).cast("int").alias("_part"),
        at.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_row"),
    )
    return stage(placed, label)


def part_starts(staged: DataFrame, group: list[str]) -> DataFrame:
    """Per group and task: ``_shift``, to be added to ``_row``, and ``_size``, the group's rows.

    A group's rows are neighbours in every task's output. A group has at most one row per task here.
    """
    counts = staged.groupBy(*group, "_part").agg(
        F.count("*").alias("_n"), F.min("_row").alias("_first")
    )
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        *group, "_part",
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(whole).alias("_size"),
    )


def number_staged(
    staged: DataFrame, group: list[str], into: str, size: str | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Add ``into``: each stored row's gapless 0-based number in its group (and the group's size)."""
    starts = stage(part_starts(staged, group), "starts")
    on = reduce(
        lambda a, b: a & b, [staged[c].eqNullSafe(starts[c]) for c in group],
        staged["_part"] == starts["_part"],
    )
    joined = lookup_join(staged, starts, on, "left", max_bytes)
    kept = [staged[c] for c in staged.columns if c not in ("_part", "_row")]
    more = [] if size is None else [starts["_size"].alias(size)]
    return joined.select(*kept, (staged["_row"] + starts["_shift"]).alias(into), *more)


def number_in_order(
    df: DataFrame, group: list[str], order: list[str], into: str, size: str | None = None,
    label: str = "ordered",
) -> DataFrame:
    """Number the rows of every group by ``order``, nulls first; a group may hold any share of them.

    Rows are dealt by ranges of group and order together. Rows that tie in both still spread, in an
    order of no meaning.
    """
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    keys = [*group, *order, "_tie"]
    dealt = tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    return number_staged(stage_rows(dealt, label), group, into, size)
