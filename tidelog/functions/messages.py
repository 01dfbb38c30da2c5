"""Column expressions that turn a raw message into envelope fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.schema import DEFAULT_HEADER_PREFIX, PARTITION_KEY_PROPERTY

# Offset indicators with a column of their own; any other name is a user property.
MESSAGE_ID = "MESSAGE_ID"
CORRELATION_ID = "CORRELATION_ID"
APPLICATION_MESSAGE_ID = "APPLICATION_MESSAGE_ID"


def _nonempty(body: Column) -> Column:
    return F.when(F.octet_length(body) > 0, body)


def payload() -> Column:
    """Text, else content, else attachment for a text message; attachment, else content otherwise."""
    content, attachment = _nonempty(F.col("content")), _nonempty(F.col("attachment"))
    text = F.col("text_body").cast("binary")
    body = F.when(F.col("is_text"), F.coalesce(text, content, attachment)).otherwise(
        F.coalesce(attachment, content)
    )
    return F.coalesce(body, F.lit(b""))


def payload_text(column: str = "Payload") -> Column:
    """Payload as text. Bytes that are not UTF-8 pass as they are rather than fail the query."""
    return F.col(column).cast("string")


def raw_id(indicator: str = MESSAGE_ID) -> Column:
    """The value the offset indicator points at, as it is, possibly null or empty."""
    if not indicator:
        raise ValueError("the offset indicator must be named")
    columns = {
        MESSAGE_ID: "rgmid",
        CORRELATION_ID: "correlation_id",
        APPLICATION_MESSAGE_ID: "application_message_id",
    }
    if indicator in columns:
        return F.col(columns[indicator])
    return F.element_at("user_props", F.lit(indicator))


def id_status(indicator: str = MESSAGE_ID) -> Column:
    """``OK``, ``EMPTY`` (null or empty value) or ``MISSING`` (no such user property)."""
    value = raw_id(indicator)
    empty = value.isNull() | (value == "")
    if indicator == MESSAGE_ID:
        return F.lit("OK")
    if indicator in (CORRELATION_ID, APPLICATION_MESSAGE_ID):
        return F.when(empty, "EMPTY").otherwise("OK")
    present = F.coalesce(F.map_contains_key("user_props", F.lit(indicator)), F.lit(False))
    return F.when(~present, "MISSING").when(empty, "EMPTY").otherwise("OK")


def message_id(indicator: str = MESSAGE_ID, strict: bool = True) -> Column:
    """``Id`` by offset indicator. A bad value fails the query, or is null when not ``strict``."""
    status = id_status(indicator)
    if strict and indicator != MESSAGE_ID:
        problem = F.concat(F.lit(f"offset indicator {indicator} is "), F.lower(status))
        return F.when(status != "OK", F.raise_error(problem).cast("string")).otherwise(
            raw_id(indicator)
        )
    return F.when(status == "OK", raw_id(indicator))


def has_partition_key() -> Column:
    return F.coalesce(
        F.map_contains_key("user_props", F.lit(PARTITION_KEY_PROPERTY)), F.lit(False)
    )


def partition_key() -> Column:
    return F.coalesce(F.element_at("user_props", F.lit(PARTITION_KEY_PROPERTY)), F.lit(""))


def topic() -> Column:
    return F.col("destination")


def event_time() -> Column:
    """Sender time, or the broker's receive time where the sender set none (null or epoch)."""
    return F.coalesce(
        F.when(F.unix_micros("sender_ts") != 0, F.col("sender_ts")), F.col("receive_ts")
    )


def headers(prefix: str = DEFAULT_HEADER_PREFIX) -> Column:
    """User properties plus system headers as UTF-8 bytes; null values dropped, system keys win."""
    always = {
        "expiration": F.col("expiration"),
        "timeToLive": F.col("time_to_live"),
        "priority": F.col("priority"),
        "redelivered": F.col("redelivered"),
    }
    sequence_key = f"{prefix}sequenceNumber"
    has_sequence = F.col("sequence_number").isNotNull()
    system = {f"{prefix}{name}": value for name, value in always.items()}

    def kept(key: Column, value: Column) -> Column:
        shadowed = key.isin(*system) | ((key == sequence_key) & has_sequence)
        return value.isNotNull() & ~shadowed

    none = F.create_map().cast("map<string,string>")
    user = F.coalesce(F.map_filter("user_props", kept), none)
    pairs = [part for k, v in system.items() for part in (F.lit(k), v.cast("string"))]
    fixed = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())
    sequence = F.when(
        has_sequence, F.create_map(F.lit(sequence_key), F.col("sequence_number").cast("string"))
    ).otherwise(none)
    # No value is null by now; the coalesce states it in the schema.
    return F.transform_values(
        F.map_concat(user, fixed, sequence),
        lambda _, v: F.coalesce(v.cast("binary"), F.lit(b"")),
    )


def envelope(
    raw: DataFrame,
    include_headers: bool = False,
    offset_indicator: str = MESSAGE_ID,
    strict: bool = True,
    header_prefix: str = DEFAULT_HEADER_PREFIX,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Raw messages as the five envelope columns, or six with ``include_headers``.

    ``keep`` names raw columns to carry along after them, such as ``spool_seq``.
    """
    columns = [
        message_id(offset_indicator, strict).alias("Id"),
        payload().alias("Payload"),
        partition_key().alias("PartitionKey"),
        topic().alias("Topic"),
        event_time().alias("TimeStamp"),
    ]
    if include_headers:
        columns.append(headers(header_prefix).alias("Headers"))
    return raw.select(*columns, *keep)


def fingerprint() -> Column:
    """Digest of what makes two messages equal: properties, destination, flags and payload.

    Ids and times are left out. Map entries are sorted first, as entry order carries no meaning.
    """
    properties = F.to_json(F.array_sort(F.map_entries("user_props")))
    parts = F.struct(
        properties.alias("properties"),
        F.col("destination"),
        F.col("redelivered"),
        F.col("expiration"),
        F.col("priority"),
        F.sha2(payload(), 256).alias("payload"),
    )
    return F.sha2(F.to_json(parts, {"ignoreNullFields": "false"}), 256)
