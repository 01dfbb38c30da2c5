"""Dropping messages a checkpoint shows as already processed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.messages import has_partition_key, partition_key
from tidelog.functions.offsets import explode_ids
from tidelog.operators.lookup import lookup_join, shuffle_join
from tidelog.session import stage

# A message is done when its id is <= every checkpointed id, that is <= the lowest of them.


def _floors(checkpoints: DataFrame) -> DataFrame:
    """Lowest id of each partition that has any id; a stored table."""
    ids = explode_ids(checkpoints.select("partitionId", "messageIDs"))
    return stage(ids.groupBy("partitionId").agg(F.min("messageId").alias("_floor")), "floors")


def _lowest(floors: DataFrame) -> str | None:
    return floors.agg(F.min("_floor")).first()[0]


def _after(message_id: str, lowest: str | None) -> Column:
    """Later than the lowest checkpointed id of all; without ids everything is."""
    return F.lit(True) if lowest is None else F.col(message_id) > F.lit(lowest)


def resume_unkeyed(raw: DataFrame, checkpoints: DataFrame, message_id: str = "rgmid") -> DataFrame:
    """Unkeyed rule for every message: keep those later than the lowest id of any checkpoint."""
    return raw.where(_after(message_id, _lowest(_floors(checkpoints))))


def _keyed(
    raw: DataFrame, floors: DataFrame, message_id: str, otherwise: Column, max_bytes: int | None
) -> DataFrame:
    lookup = floors.withColumnRenamed("partitionId", "_key")
    # An empty key never meets a checkpoint: its join key is null.
    key = F.when(has_partition_key() & (partition_key() != ""), partition_key())
    if raw.isStreaming:
        # A broadcast would be gathered on the driver again for every batch. Messages without a key
        # are spread by their ids, and meet nothing.
        keyed = raw.withColumn("_named", key.isNotNull()).withColumn(
            "_at", F.coalesce(key, F.col(message_id))
        )
        joined = shuffle_join(
            keyed, lookup, (keyed["_at"] == lookup["_key"]) & keyed["_named"], "left", max_bytes
        )
    else:
        keyed = raw.withColumn("_at", key)
        joined = lookup_join(keyed, lookup, keyed["_at"] == lookup["_key"], "left", max_bytes)
    keep = F.col("_floor").isNull() | (F.col(message_id) > F.col("_floor"))
    rule = F.when(~has_partition_key(), otherwise).otherwise(keep)
    return joined.where(rule).select(*raw.columns)


def resume_keyed(
    raw: DataFrame, checkpoints: DataFrame, message_id: str = "rgmid", max_bytes: int | None = None
) -> DataFrame:
    """Keyed rule: a message is compared with its own key's checkpoint; without one it stays."""
    return _keyed(raw, _floors(checkpoints), message_id, F.lit(True), max_bytes)


def resume_filter(
    raw: DataFrame,
    checkpoints: DataFrame,
    message_id: str = "rgmid",
    replay: bool = False,
    max_bytes: int | None = None,
) -> DataFrame:
    """The whole restart rule. Replay turns it off.

    A message without a partition key obeys the unkeyed rule over all checkpoints; one with a key
    obeys the keyed rule; an empty key always stays. ``message_id`` must order as text (fixed
    width). For other ids pass a position column and checkpoints from :func:`locate_ids`.
    """
    if replay:
        return raw
    floors = _floors(checkpoints)
    return _keyed(raw, floors, message_id, _after(message_id, _lowest(floors)), max_bytes)


def locate_ids(
    checkpoints: DataFrame,
    log: DataFrame,
    message_id: str,
    order: str = "spool_seq",
    width: int = 19,
) -> DataFrame:
    """Checkpoints with every id replaced by its position, zero-padded so that text order holds.

    An id that the log no longer holds counts as before everything in it, so it drops nothing.
    """
    ids = stage(explode_ids(checkpoints.select("partitionId", "messageIDs")), "ids")
    wanted = stage(ids.select(F.col("messageId").alias("_wanted")).distinct(), "wanted")
    narrow = log.select(F.col(message_id).alias("_id"), F.col(order).alias("_position"))
    found = stage(
        lookup_join(narrow, wanted, narrow["_id"] == wanted["_wanted"], "left_semi")
        .groupBy("_id").agg(F.min("_position").alias("_position")),
        "positions",
    )
    placed = lookup_join(ids, found, ids["messageId"] == found["_id"], "left")
    before_all = F.lit("-")  # sorts ahead of any digit
    return placed.select(
        "partitionId", F.coalesce(padded("_position", width), before_all).alias("messageIDs")
    )


def padded(order: str, width: int = 19) -> Column:
    """A position as text of fixed width."""
    return F.lpad(F.col(order).cast("string"), width, "0")
