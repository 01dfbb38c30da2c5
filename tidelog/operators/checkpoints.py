"""Consumer checkpoints: taking, merging and choosing them; last-value state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.operators.lookup import pick_by


def last_value(df: DataFrame, keys: list[str] | None = None, order: str = "spool_seq") -> DataFrame:
    """Newest row of every key (topic by default), whole."""
    return pick_by(df, keys or ["destination"], order, last=True)


def consumer_checkpoint(
    processed: DataFrame, partition: str, message_id: str = "Id", order: str = "spool_seq"
) -> DataFrame:
    """Last processed id per consumer or partition key, as (``partitionId``, ``messageIDs``)."""
    # The row is as narrow as its key, so one aggregate with map-side partials carries it whole.
    narrow = processed.where(F.col(order).isNotNull())
    return narrow.groupBy(F.col(partition).cast("string").alias("partitionId")).agg(
        F.max_by(message_id, order).alias("messageIDs")
    )


def merge_checkpoints(history: DataFrame, *more: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Newest checkpoint of every partition over any number of checkpoint tables.

    Rows are distinct by value. Two different checkpoints of one partition in one batch both stay.
    """
    for other in more:
        history = history.unionByName(other)
    newest = pick_by(history, ["partitionId"], batch)
    return newest.select("partitionId", "messageIDs").distinct()


def restart_state(state: DataFrame, offset_log: DataFrame) -> DataFrame:
    """The checkpoint to restart from: all of the state table, else all of the offset log.

    Adds ``source``: which one won. Both empty gives no rows, a fresh start.
    """
    columns = ["partitionId", "messageIDs"]
    from_log = offset_log.where(~state.exists())
    return state.select(*columns, F.lit("state").alias("source")).unionByName(
        from_log.select(*columns, F.lit("offset_log").alias("source"))
    )
