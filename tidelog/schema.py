"""Fixed schemas: the raw message log, the envelope, checkpoints and typed headers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The user property that carries the queue partition key (a JMS standard name), the
# partition id given to checkpoints migrated from the old offset format, and the priority a
# message gets when its publisher sets none.
PARTITION_KEY_PROPERTY = "JMSXGroupID"
LEGACY_PARTITION_ID = "old-checkpoint"
DEFAULT_PRIORITY = 4

# A published message's id: its position, of one width, so that ids order as positions do.
ID_PREFIX, PLACE_DIGITS = "rmid1:", 19
# What became of a published row.
OK, FAILED = "OK", "FAILED"

# System headers share a prefix that belongs to the broker, so it is a parameter everywhere.
DEFAULT_HEADER_PREFIX = "mq_"

RAW_MESSAGE = T.StructType([
    T.StructField("spool_seq", T.LongType()),
    T.StructField("rgmid", T.StringType()),
    T.StructField("correlation_id", T.StringType()),
    T.StructField("application_message_id", T.StringType()),
    T.StructField("destination", T.StringType()),
    T.StructField("reply_to", T.StringType()),
    T.StructField("sender_ts", T.TimestampType()),
    T.StructField("receive_ts", T.TimestampType()),
    T.StructField("expiration", T.LongType()),
    T.StructField("time_to_live", T.LongType()),
    T.StructField("priority", T.IntegerType()),
    T.StructField("redelivered", T.BooleanType()),
    T.StructField("sequence_number", T.LongType()),
    T.StructField("is_text", T.BooleanType()),
    T.StructField("text_body", T.StringType()),
    T.StructField("attachment", T.BinaryType()),
    T.StructField("content", T.BinaryType()),
    T.StructField("user_props", T.MapType(T.StringType(), T.StringType(), True)),
])

# What a published message has besides, and what was wrong with a row that could not be published.
# Logs from elsewhere may lack these columns; a reader takes a message without `status` as good.
PUBLISHED_FIELDS = T.StructType([
    T.StructField("correlation_key", T.StringType()),
    T.StructField("delivery_mode", T.StringType()),
    T.StructField("application_message_type", T.StringType()),
    T.StructField("dmq_eligible", T.BooleanType()),
    T.StructField("http_content_encoding", T.StringType()),
    T.StructField("http_content_type", T.StringType()),
    T.StructField("is_reply", T.BooleanType()),
    T.StructField("sender_id", T.StringType()),
    T.StructField("user_data", T.BinaryType()),
    T.StructField("status", T.StringType()),
    T.StructField("reason", T.StringType()),
])

_ENVELOPE = [
    T.StructField("Id", T.StringType()),
    T.StructField("Payload", T.BinaryType()),
    T.StructField("PartitionKey", T.StringType()),
    T.StructField("Topic", T.StringType()),
    T.StructField("TimeStamp", T.TimestampType()),
]
_HEADERS = T.StructField("Headers", T.MapType(T.StringType(), T.BinaryType(), False))


def envelope_schema(include_headers: bool = False) -> T.StructType:
    """The five envelope columns, or six with ``include_headers``."""
    return T.StructType(_ENVELOPE + ([_HEADERS] if include_headers else []))


CHECKPOINT = T.StructType([
    T.StructField("partitionId", T.StringType()),
    T.StructField("messageIDs", T.StringType()),
])

# One permissive shape reads both offset formats: the current one fills `checkpoints`, the old one
# fills `messageIDs` or neither.
OFFSET_ENTRY = T.StructType([
    T.StructField("offset", T.LongType()),
    T.StructField("checkpoints", T.ArrayType(CHECKPOINT)),
    T.StructField("messageIDs", T.StringType()),
])


@dataclass(frozen=True)
class Header:
    """One system header: its name after the prefix, its type and what may be done with it."""

    name: str
    type: str
    writable: bool = True
    default: object = None


# Header names, types, whether a publisher may set them, and defaults.
SYSTEM_HEADERS = (
    Header("applicationMessageId", "string"),
    Header("applicationMessageType", "string"),
    Header("correlationId", "string"),
    Header("deliveryCount", "int", writable=False),
    Header("destination", "destination", writable=False),
    Header("discardIndication", "boolean", writable=False),
    Header("dmqEligible", "boolean", default=True),
    Header("expiration", "long"),
    Header("httpContentEncoding", "string"),
    Header("isReply", "boolean"),
    Header("priority", "int"),
    Header("receiveTimestamp", "long", writable=False),
    Header("redelivered", "boolean", writable=False),
    Header("replicationGroupMessageId", "string", writable=False),
    Header("replyTo", "destination"),
    Header("senderId", "string"),
    Header("senderTimestamp", "long"),
    Header("sequenceNumber", "long"),
    Header("timeToLive", "long"),
    Header("userData", "binary"),
)
CONTENT_TYPE_HEADER = "content-type"
