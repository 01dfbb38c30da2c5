"""Reader and writer by option name, for jobs that configure the queue with strings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from tidelog.functions.messages import MESSAGE_ID, envelope
from tidelog.operators.replay import AFTER_MESSAGE, BEGINNING, TIMEBASED, replay, start_instant
from tidelog.schema import DEFAULT_HEADER_PREFIX
from tidelog.sinks.publish import Publisher, publish, publish_stream
from tidelog.sources.spool import open_queue, position_of, read_queue, resume
from tidelog.streaming.jobs import committed_state

# Option names and defaults. `queue` is the log's folder, `headerPrefix` the broker's
# prefix for system headers; `state` is what ackLastProcessedMessages starts from: the folder a
# commit_publish job keeps its state in, or a data frame of checkpoints.
READ_DEFAULTS = {
    "queue": None,
    "batchSize": "0",
    "partitions": "1",
    "includeHeaders": "false",
    "offsetIndicator": MESSAGE_ID,
    "ackLastProcessedMessages": "false",
    "replayStrategy": None,
    "replayStartTime": None,
    "replayStartTimeTimezone": "UTC",
    "replayReplicationGroupMessageId": None,
    "headerPrefix": DEFAULT_HEADER_PREFIX,
    "state": None,
    "lvq.name": None,
    "lvq.topic": None,
    "checkpointLocation": None,
}
# Accepted and ignored: there is no broker session to configure.
CONNECTION_OPTIONS = (
    "host", "vpn", "username", "password", "connectRetries", "reconnectRetries",
    "connectRetriesPerHost", "reconnectRetryWaitInMillis", "connectIdleTimeoutInMillis",
    "connectIdleTimeoutCheckInMillis", "queue.receiveWaitTimeout",
    "closeReceiversOnPartitionClose",
)
WRITE_DEFAULTS = {
    "queue": None,
    "topic": None,
    "id": None,
    "includeHeaders": "false",
    "mode": "strict",
    "headerPrefix": DEFAULT_HEADER_PREFIX,
    "checkpointLocation": None,
}


# The queue's own dotted options; any other dotted or underscored name is a client property.
OWN_FAMILIES = ("lvq", "queue")


def _ignored(name: str) -> bool:
    """Whether an option configures a client, its login or its transport: ``<family>.<property>``."""
    family, dot, _ = name.replace("_", ".").lower().partition(".")
    return name in CONNECTION_OPTIONS or bool(dot) and family not in OWN_FAMILIES


def _merge(defaults: dict, options: dict) -> dict:
    options = {k: v for k, v in options.items() if k in defaults or not _ignored(k)}
    unknown = sorted(set(options) - set(defaults))
    if unknown:
        raise ValueError(f"unknown options: {', '.join(unknown)}")
    merged = {**defaults, **options}
    if not merged["queue"]:
        raise ValueError("option queue is missing")
    return merged


def _flag(value: object) -> bool:
    return str(value).lower() == "true"


def _count(options: dict, name: str) -> int:
    value = int(options[name])
    if value < 0:
        raise ValueError(f"option {name} must be >= 0")
    return value


class QueueReader:
    """``QueueReader(spark).option("queue", path)....load()`` or ``.loadBatch()``."""

    def __init__(self, spark: SparkSession):
        self._spark, self._options = spark, {}

    def option(self, name: str, value: object) -> QueueReader:
        self._options[name] = value
        return self

    def options(self, **options: object) -> QueueReader:
        self._options.update(options)
        return self

    def _checked(self) -> dict:
        o = _merge(READ_DEFAULTS, self._options)
        _count(o, "batchSize")
        _count(o, "partitions")
        strategy = o["replayStrategy"]
        if strategy not in (None, BEGINNING, TIMEBASED, AFTER_MESSAGE):
            raise ValueError(f"unsupported replay strategy {strategy}")
        if strategy == TIMEBASED:
            start_instant(o["replayStartTime"], o["replayStartTimeTimezone"])
        if strategy == AFTER_MESSAGE and not o["replayReplicationGroupMessageId"]:
            raise ValueError("replay after a message needs its id")
        # Jobs that keep their state in a last-value queue name it; here that is a folder.
        o["state"] = o["state"] or o["lvq.name"]
        if _flag(o["ackLastProcessedMessages"]) and not o["state"]:
            raise ValueError("ackLastProcessedMessages needs option state")
        return o

    def _state(self, o: dict) -> DataFrame | None:
        if not _flag(o["ackLastProcessedMessages"]):
            return None
        given = o["state"]
        return given if isinstance(given, DataFrame) else committed_state(self._spark, given)

    def load(self) -> DataFrame:
        """The queue as a stream (see ``stream_raw`` for what bounds a micro-batch)."""
        o = self._checked()
        return open_queue(
            self._spark,
            o["queue"],
            partitions=_count(o, "partitions"),
            batch_size=_count(o, "batchSize"),
            include_headers=_flag(o["includeHeaders"]),
            offset_indicator=o["offsetIndicator"],
            header_prefix=o["headerPrefix"],
            replay_strategy=o["replayStrategy"],
            replay_start_time=o["replayStartTime"],
            replay_timezone=o["replayStartTimeTimezone"],
            replay_message_id=o["replayReplicationGroupMessageId"],
            checkpoints=self._state(o),
        )

    def loadBatch(self) -> DataFrame:
        """The same rows as a bounded table; ``batchSize`` and ``partitions`` bound streams only."""
        o = self._checked()
        log = read_queue(self._spark, o["queue"])
        after = position_of(o["replayReplicationGroupMessageId"])
        skips = o["replayStrategy"] == AFTER_MESSAGE and after is not None
        raw = replay(
            read_queue(self._spark, o["queue"], after) if skips else log,
            o["replayStrategy"],
            o["replayStartTime"],
            o["replayStartTimeTimezone"],
            o["replayReplicationGroupMessageId"],
        )
        state = self._state(o)
        if state is not None:
            raw = resume(raw, state, log, o["offsetIndicator"], o["replayStrategy"] is not None)
        return envelope(
            raw, _flag(o["includeHeaders"]), o["offsetIndicator"], header_prefix=o["headerPrefix"]
        )


class QueueWriter:
    """``QueueWriter(df).option("queue", path)....save()`` or ``.writeStream()``."""

    def __init__(self, df: DataFrame):
        self._df, self._options = df, {}

    def option(self, name: str, value: object) -> QueueWriter:
        self._options[name] = value
        return self

    def options(self, **options: object) -> QueueWriter:
        self._options.update(options)
        return self

    def _publisher(self, o: dict) -> Publisher:
        return Publisher(
            topic=o["topic"],
            message_id=o["id"],
            include_headers=_flag(o["includeHeaders"]),
            header_prefix=o["headerPrefix"],
            mode=o["mode"],
        )

    def save(self) -> dict[str, int]:
        """Write all rows; returns how many were published, acknowledged and failed."""
        o = _merge(WRITE_DEFAULTS, self._options)
        return publish(self._df, o["queue"], self._publisher(o))

    def writeStream(self) -> DataStreamWriter:
        o = _merge(WRITE_DEFAULTS, self._options)
        if not o["checkpointLocation"]:
            raise ValueError("option checkpointLocation is missing")
        return publish_stream(self._df, o["queue"], o["checkpointLocation"], self._publisher(o))
