"""Offset-log entries: decode, migrate the old format, and encode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.schema import CHECKPOINT, LEGACY_PARTITION_ID, OFFSET_ENTRY


def _entry(json: str) -> Column:
    return F.from_json(F.col(json), OFFSET_ENTRY)


def migrate_offsets(log: DataFrame, json: str = "json", strict: bool = False) -> DataFrame:
    """Add ``offset``, ``checkpoints`` and ``readable`` to a table of offset-log lines.

    An old entry becomes one checkpoint with the legacy partition id and its message ids, if any. A
    line without an offset is unreadable: flagged, or failing the query when ``strict``.
    """
    legacy = F.array(
        F.struct(
            F.lit(LEGACY_PARTITION_ID).alias("partitionId"),
            F.coalesce(F.col("_entry.messageIDs"), F.lit("")).alias("messageIDs"),
        )
    )
    parsed = log.withColumn("_entry", _entry(json))
    readable = F.col("_entry.offset").isNotNull()

    def value(column: Column, kind: str) -> Column:
        """The column of a readable line; else null, or the error."""
        unreadable = F.lit(None).cast(kind)
        if strict:
            unreadable = F.raise_error(
                F.lit("unreadable offset entry; delete the checkpoint and restart")
            ).cast(kind)
        return F.when(readable, column).otherwise(unreadable)

    checkpoints = F.coalesce(F.col("_entry.checkpoints"), legacy)
    return parsed.select(
        *log.columns,
        value(F.col("_entry.offset"), "bigint").alias("offset"),
        value(checkpoints, T.ArrayType(CHECKPOINT).simpleString()).alias("checkpoints"),
        readable.alias("readable"),
    )


def decode_offsets(log: DataFrame, json: str = "json", strict: bool = False) -> DataFrame:
    """One row per message id of every readable entry; empty ids are dropped."""
    entries = migrate_offsets(log, json, strict)
    keep = [c for c in log.columns if c != json]
    # An unreadable line has no checkpoints, so nothing needs filtering. The coalesce keeps the
    # optimizer from testing the array's size below the projection, which would parse lines again.
    each = F.explode(F.coalesce("checkpoints", F.array().cast(T.ArrayType(CHECKPOINT))))
    per_partition = entries.select(*keep, "offset", each.alias("_c"))
    return explode_ids(
        per_partition.select(
            *keep, "offset",
            F.col("_c.partitionId").alias("partitionId"),
            F.col("_c.messageIDs").alias("messageIDs"),
        )
    )


def explode_ids(checkpoints: DataFrame) -> DataFrame:
    """Split ``messageIDs`` into one ``messageId`` per row, without empty ids."""
    others = [c for c in checkpoints.columns if c != "messageIDs"]
    return checkpoints.select(
        *others, F.explode(F.split("messageIDs", ",")).alias("messageId")
    ).where("messageId <> ''")


def encode_offset(offset: Column) -> Column:
    """JSON line for one checkpoint row (``partitionId``, ``messageIDs``) at ``offset``."""
    return F.to_json(
        F.struct(
            offset.alias("offset"),
            F.array(F.struct("partitionId", "messageIDs")).alias("checkpoints"),
        )
    )
