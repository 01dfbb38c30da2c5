"""Reading a log again from its start, from a time, or after a message."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The replay strategy names and the start time format.
BEGINNING = "BEGINNING"
TIMEBASED = "TIMEBASED"
AFTER_MESSAGE = "REPLICATION-GROUP-MESSAGE-ID"
START_TIME_FORMAT = "%Y-%m-%dT%H:%M:%S"


def start_instant(start_time: str | None, timezone: str | None = "UTC") -> Column:
    """The instant of a wall-clock ``yyyy-MM-dd'T'HH:mm:ss`` in a named zone.

    A literal after constant folding whatever the session zone is, so it reaches the scan.
    """
    if not start_time:
        raise ValueError("time-based replay needs a start time")
    t = datetime.strptime(start_time, START_TIME_FORMAT)
    parts = (t.year, t.month, t.day, t.hour, t.minute, t.second)
    return F.make_timestamp(*[F.lit(p) for p in parts], F.lit(timezone or "UTC"))


def replay_beginning(df: DataFrame) -> DataFrame:
    return df


def replay_from_time(
    df: DataFrame,
    start_time: str | None,
    timezone: str | None = "UTC",
    time: str = "receive_ts",
) -> DataFrame:
    """Messages the broker received at or after the start."""
    return df.where(F.col(time) >= start_instant(start_time, timezone))


def replay_after_id(df: DataFrame, message_id: str | None, by: str = "rgmid") -> DataFrame:
    """Messages strictly after ``message_id``, for ids whose text order is message order."""
    if not message_id:
        raise ValueError("replay after a message needs its id")
    return df.where(F.col(by) > F.lit(message_id))


def replay_after_position_of(
    df: DataFrame, message_id: str | None, by: str = "rgmid", order: str = "spool_seq"
) -> DataFrame:
    """Messages strictly after ``message_id``, for ids of any form: by the position it has."""
    if not message_id:
        raise ValueError("replay after a message needs its id")
    found = df.where(F.col(by) == F.lit(message_id)).agg(F.min(order)).first()[0]
    if found is None:
        raise ValueError(f"message {message_id} is not in the log")
    return df.where(F.col(order) > F.lit(found))


def replay(
    df: DataFrame,
    strategy: str | None,
    start_time: str | None = None,
    timezone: str | None = "UTC",
    message_id: str | None = None,
) -> DataFrame:
    """Apply a replay strategy by name; ``None`` replays nothing and leaves the log as it is."""
    if strategy is None or strategy == BEGINNING:
        return df
    if strategy == TIMEBASED:
        return replay_from_time(df, start_time, timezone)
    if strategy == AFTER_MESSAGE:
        return replay_after_id(df, message_id)
    raise ValueError(f"unsupported replay strategy {strategy}")
