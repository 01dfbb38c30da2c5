"""Acknowledged positions as sets of intervals: exact for acknowledgements in any order.

A low watermark stands for everything before it, so with acknowledgements out of order it delivers again
what is above it. An interval set has a row per run of positions instead.

Positions are cut into blocks. Runs are joined inside a block first; only runs that touch a block's edge
can go on in the next one, and at most two of a block do, so the chain over blocks stays short however
many runs there are, and no task sees a whole group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Positions in a block when runs are joined, and when messages look for theirs.
BLOCK, SEARCH_BLOCK = 65_536, 4_096


def _pieces(intervals: DataFrame, group: list[str], block: int) -> DataFrame:
    """Intervals cut at the blocks' edges, with the block each piece is in."""
    cut = intervals.where("first <= last").select(
        *group, "first", "last",
        F.explode(F.sequence(F.expr(f"first div {block}"), F.expr(f"last div {block}"))).alias("_block"),
    )
    low = F.col("_block") * block
    return cut.select(
        *group, "_block", F.greatest("first", low).alias("first"),
        F.least("last", low + (block - 1)).alias("last"),
    )


def _joined(intervals: DataFrame, by: list[str]) -> DataFrame:
    """Runs of intervals that overlap or follow each other, inside each partition ``by``."""
    order = Window.partitionBy(*by).orderBy("first", "last")
    reached = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.coalesce(F.col("first") > reached + 1, F.lit(True))
    run = F.sum(F.col("_new").cast("long")).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    runs = intervals.withColumn("_new", starts).withColumn("_run", run)
    return runs.groupBy(*by, "_run").agg(
        F.min("first").alias("first"), F.max("last").alias("last")
    ).drop("_run")


def union_intervals(
    intervals: DataFrame, group: list[str] | None = None, block: int = BLOCK
) -> DataFrame:
    """The fewest intervals ``first, last`` per group that hold the same positions.

    Positions are whole numbers from 0 on; intervals with a null or the wrong way round hold none.
    """
    by = list(group or [])
    local = _joined(_pieces(intervals, by, block).distinct(), [*by, "_block"])
    low = F.col("_block") * block
    edge = (F.col("first") == low) | (F.col("last") == low + (block - 1))
    marked = local.withColumn("_edge", edge)
    inner = marked.where("NOT _edge").select(*by, "first", "last")
    # Without a group there is one chain, of at most two runs a block.
    chained = _joined(marked.where("_edge").select(*by, "first", "last").withColumn("_all", F.lit(0)),
                      [*by, "_all"]).select(*by, "first", "last")
    return inner.unionByName(chained)


def intervals_of(
    rows: DataFrame, group: list[str] | None = None, order: str = "spool_seq", block: int = BLOCK
) -> DataFrame:
    """The positions of rows as intervals; a position that comes again counts once."""
    by = list(group or [])
    single = rows.where(F.col(order).isNotNull()).select(
        *by, F.col(order).alias("first"), F.col(order).alias("last")
    )
    return union_intervals(single, by, block)


def merge_intervals(
    known: DataFrame, *more: DataFrame, group: list[str] | None = None, block: int = BLOCK
) -> DataFrame:
    """Interval sets of earlier batches and of new acknowledgements as one."""
    return union_intervals(reduce(DataFrame.unionByName, more, known), group, block)


def outside_intervals(
    rows: DataFrame,
    intervals: DataFrame,
    group: list[str] | None = None,
    order: str = "spool_seq",
    block: int = SEARCH_BLOCK,
) -> DataFrame:
    """Rows whose position is in none of their group's intervals: what is still to be delivered.

    Rows and pieces of intervals meet by group and block, where only they are compared. A row without a
    position, or of a group without intervals, stays.
    """
    by = list(group or [])
    names = {c: f"_of_{c}" for c in by}
    pieces = _pieces(intervals, by, block).withColumnsRenamed(
        {**names, "_block": "_at", "first": "_first", "last": "_last"}
    )
    same: list[Column] = [rows[c].eqNullSafe(pieces[n]) for c, n in names.items()]
    place = rows[order]
    on = reduce(
        lambda a, b: a & b, same,
        (F.expr(f"`{order}` div {block}") == pieces["_at"])
        & (place >= pieces["_first"]) & (place <= pieces["_last"]),
    )
    return rows.join(pieces, on, "left_anti")
