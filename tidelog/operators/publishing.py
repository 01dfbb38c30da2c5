"""Rows to messages: binding, checking, typing and accounting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.headers import header_problem, typed_headers, user_properties
from tidelog.schema import (
    DEFAULT_HEADER_PREFIX,
    DEFAULT_PRIORITY,
    FAILED,
    ID_PREFIX,
    OK,
    PLACE_DIGITS,
    RAW_MESSAGE,
    envelope_schema,
)


def bind_columns(
    df: DataFrame,
    topic: str | None = None,
    message_id: str | None = None,
    include_headers: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Pick envelope columns by exact name, with ``topic`` and ``message_id`` set for every row.

    A missing optional column is null, extra columns are ignored unless named in ``keep``. ``Id``
    and ``Topic`` must exist unless given. A column of another type than the envelope's is refused.
    """
    fixed = {"Id": message_id, "Topic": topic}
    have = {f.name: f.dataType for f in df.schema.fields}
    columns = []
    for field in envelope_schema(include_headers).fields:
        if fixed.get(field.name) is not None:
            columns.append(F.lit(fixed[field.name]).alias(field.name))
        elif field.name in have:
            if not _same_type(have[field.name], field.dataType):
                raise ValueError(
                    f"column {field.name} is {have[field.name].simpleString()}, "
                    f"expected {field.dataType.simpleString()}"
                )
            columns.append(F.col(field.name))
        elif field.name in fixed:
            raise ValueError(f"column {field.name} is not in the data frame and no value is set")
        else:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
    return df.select(*columns, *keep)


def _same_type(a: T.DataType, b: T.DataType) -> bool:
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return a.keyType == b.keyType and a.valueType == b.valueType
    return a == b


def reject_reason(bound: DataFrame, header_prefix: str = DEFAULT_HEADER_PREFIX) -> Column:
    """Why a row cannot be published, or null when it can. The first problem counts."""
    checks = [
        F.when(F.col(name).isNull(), F.lit(f"{name} is null")) for name in ("Id", "Topic", "Payload")
    ]
    if "Headers" in bound.columns:
        problem = header_problem(header_prefix)
        checks.append(
            F.when(problem.isNotNull(), F.concat(F.lit("invalid header "), problem))
        )
    return F.coalesce(*checks)


def publish_validate(
    bound: DataFrame, header_prefix: str = DEFAULT_HEADER_PREFIX, strict: bool = False
) -> DataFrame:
    """Add ``status`` (OK or FAILED) and ``reason``; with ``strict`` a bad row fails the query."""
    reason = reject_reason(bound, header_prefix)
    checked = bound.withColumn("reason", reason)
    status = F.when(F.col("reason").isNull(), OK).otherwise(FAILED)
    if strict:
        problem = F.concat(F.lit("message "), F.coalesce("Id", F.lit("?")), F.lit(": "), "reason")
        status = F.when(F.col("reason").isNull(), F.lit(OK)).otherwise(
            F.raise_error(problem).cast("string")
        )
    return checked.withColumn("status", status)


def split_rejects(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Publishable rows without the check columns, and the rejects as (Id, status, reason)."""
    # Only `status` is tested: in strict mode that is the column that fails the query.
    good = checked.where(F.col("status") == OK).drop("status", "reason")
    return good, reject_report(checked)


def reject_report(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("status") == FAILED).select("Id", "status", "reason")


def publish_envelope(
    bound: DataFrame,
    header_prefix: str = DEFAULT_HEADER_PREFIX,
    strict_headers: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Bound rows as outgoing messages.

    ``Id`` becomes correlation id, correlation key and application message id. ``TimeStamp`` becomes
    the sender time in milliseconds when it is after the epoch, else a header may set it. The
    partition key travels as a user property. Delivery is persistent.
    """
    if "Headers" not in bound.columns:
        bound = bound.withColumn("Headers", F.lit(None).cast("map<string,binary>"))
    typed = typed_headers(header_prefix, strict=strict_headers)
    millis = F.unix_millis("TimeStamp")
    return bound.select(
        F.col("Id").alias("correlation_id"),
        F.col("Id").alias("correlation_key"),
        F.col("Id").alias("application_message_id"),
        F.col("Topic").alias("destination"),
        F.col("Payload").alias("payload"),
        F.coalesce(F.when(millis > 0, millis), typed["senderTimestamp"]).alias("sender_ts_ms"),
        F.lit("PERSISTENT").alias("delivery_mode"),
        typed["applicationMessageType"].alias("application_message_type"),
        typed["dmqEligible"].alias("dmq_eligible"),
        typed["expiration"].alias("expiration"),
        typed["httpContentEncoding"].alias("http_content_encoding"),
        typed["contentType"].alias("http_content_type"),
        typed["isReply"].alias("is_reply"),
        typed["priority"].alias("priority"),
        typed["senderId"].alias("sender_id"),
        typed["sequenceNumber"].alias("sequence_number"),
        typed["timeToLive"].alias("time_to_live"),
        typed["userData"].alias("user_data"),
        user_properties(header_prefix).alias("user_props"),
        *keep,
    )


def as_raw(
    messages: DataFrame,
    position: str,
    received: Column | None = None,
    message_id: Column | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Published messages as a log another consumer can read.

    ``position`` is a column that gives each message its place in the log, and its id unless
    ``message_id`` does. Unset fields take the broker's defaults.
    """
    place = F.col(position).cast("bigint")
    own_id = F.concat(F.lit(ID_PREFIX), F.lpad(place.cast("string"), PLACE_DIGITS, "0"))
    values = {
        "spool_seq": place,
        "rgmid": own_id if message_id is None else message_id,
        "correlation_id": F.col("correlation_id"),
        "application_message_id": F.col("application_message_id"),
        "destination": F.col("destination"),
        "sender_ts": F.timestamp_millis("sender_ts_ms"),
        "receive_ts": F.current_timestamp() if received is None else received,
        "expiration": F.coalesce("expiration", F.lit(0)),
        "time_to_live": F.coalesce("time_to_live", F.lit(0)),
        "priority": F.coalesce("priority", F.lit(DEFAULT_PRIORITY)),
        "redelivered": F.lit(False),
        "sequence_number": F.col("sequence_number"),
        "is_text": F.lit(False),
        "attachment": F.col("payload"),
        "user_props": F.transform_values(
            "user_props", lambda _, v: F.make_valid_utf8(v.cast("string"))
        ),
    }
    return messages.select([
        values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RAW_MESSAGE.fields
    ] + [F.col(c) for c in keep])


def publish_report(checked: DataFrame, *by: str) -> DataFrame:
    """Rows sent, acknowledged and failed per group (batch and topic by default)."""
    good = F.col("status") == OK
    return checked.groupBy(*(by or ("batch_id", "Topic"))).agg(
        F.count("*").alias("published"),
        F.count_if(good).alias("acknowledged"),
        F.count_if(~good).alias("failed"),
    )
