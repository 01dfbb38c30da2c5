"""Dealing a log to consumers and cutting it into bounded batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.messages import partition_key
from tidelog.operators.lookup import pick_by
from tidelog.operators.ordering import BLOCK, number_rows


def _check(partitions: int, batch_size: int) -> None:
    if partitions < 0:
        raise ValueError("partitions must be >= 0")
    if batch_size < 0:
        raise ValueError("batch size must be >= 0")


def consumer_count(df: DataFrame, partitions: int) -> int:
    """``partitions`` consumers; 0 means one per core the session offers."""
    _check(partitions, 0)
    return partitions or df.sparkSession.sparkContext.defaultParallelism


def assign_consumer(df: DataFrame, partitions: int = 1, order: str = "spool_seq") -> DataFrame:
    """Add ``consumer``: the log dealt in turn to ``partitions`` consumers."""
    n = consumer_count(df, partitions)
    return df.withColumn("consumer", F.pmod(F.col(order), F.lit(n)).cast("int"))


def assign_by_key(
    df: DataFrame, partitions: int, key: Column | None = None, order: str = "spool_seq"
) -> DataFrame:
    """Add ``consumer``: one for all messages of a partition key, so that their order is kept.

    Each consumer draws a number for the key, and the highest one has it. With another consumer only the
    keys that it draws highest move, about one of ``partitions + 1``; without the last one only its keys
    do. Messages without a key are dealt in turn. Nothing shuffles; a key is never split, so a hot key is
    its consumer's load.
    """
    n = consumer_count(df, partitions)
    name = partition_key() if key is None else key
    draws = [
        F.struct(F.md5(F.concat(name, F.lit(f"#{c}")).cast("binary")).alias("draw"), F.lit(c).alias("c"))
        for c in range(n)
    ]
    highest = (F.greatest(*draws) if n > 1 else draws[0])["c"]
    in_turn = F.pmod(F.col(order), F.lit(n)).cast("int")
    named = F.coalesce(name != "", F.lit(False))
    return df.withColumn("consumer", F.when(named, highest).otherwise(in_turn))


def plan_batches(
    df: DataFrame, partitions: int = 1, batch_size: int = 0, order: str = "spool_seq"
) -> DataFrame:
    """Add ``consumer`` and ``batch`` to a dense log: at most ``batch_size`` rows of each pair.

    Positions without gaps make the batch a division, so nothing shuffles. A batch size of 0 sets no
    bound: all is batch 0.
    """
    _check(partitions, batch_size)
    n = consumer_count(df, partitions)
    batch = F.expr(f"`{order}` div {n * batch_size}") if batch_size else F.lit(0).cast("bigint")
    return assign_consumer(df, n, order).withColumn("batch", batch)


def plan_batches_sparse(
    df: DataFrame,
    batch_size: int = 0,
    consumer: str = "consumer",
    order: str = "spool_seq",
    block: int = BLOCK,
) -> DataFrame:
    """Add ``batch`` to a log with gaps, by each row's exact position within its consumer."""
    _check(0, batch_size)
    if not batch_size:
        return df.withColumn("batch", F.lit(0).cast("bigint"))
    rows = number_rows(df, [consumer], order, "_row", block)
    return rows.withColumn("batch", F.expr(f"_row div {batch_size}")).drop("_row")


def batch_counts(df: DataFrame, *by: str) -> DataFrame:
    """Rows per batch."""
    return df.groupBy(*(by or ("batch",))).agg(F.count("*").alias("messages"))


def browse_head(df: DataFrame, by: str = "destination", order: str = "spool_seq") -> DataFrame:
    """First message of every topic, whole, without consuming it."""
    return pick_by(df, [by], order, last=False)


def is_empty(df: DataFrame) -> bool:
    """Whether a queue holds nothing; reads one row at most."""
    return df.isEmpty()
