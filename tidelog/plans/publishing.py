"""Queries over the publishing side."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions import headers as h
from tidelog.functions import messages as m
from tidelog.operators import delivery
from tidelog.operators import publishing as pub
from tidelog.plans import fixtures as fx
from tidelog.plans.oracle import FAULTY, HDR, MSG, PREFIX
from tidelog.plans.reading import exploded
from tidelog.plans.registry import query
from tidelog.session import workspace
from tidelog.sinks.publish import Publisher, publish, read_rejects
from tidelog.sources.spool import read_queue

PUBLISHED_SQL = """SELECT id AS correlation_id, id AS application_message_id, topic AS destination,
  hex(encode(payload)) AS payload_hex, time_us // 1000 AS sender_ts_ms,
  'PERSISTENT' AS delivery_mode, CAST(e % 10 AS INTEGER) AS priority,
  CASE WHEN e % 4 <> 0 THEN e END AS sequence_number, (e % 3) * 1000 AS time_to_live,
  TRUE AS dmq_eligible, CASE WHEN pkey <> '' THEN pkey END AS key FROM faulty WHERE reason IS NULL"""


# What a log holds after publishing in report mode: all good rows as messages, all others as rejects.
STORED_SQL = """SELECT id AS correlation_id, topic AS destination,
  CASE WHEN reason IS NULL THEN hex(encode(payload)) END AS payload_hex,
  CASE WHEN reason IS NULL THEN time_us // 1000 END AS sender_ts_ms,
  CASE WHEN reason IS NULL THEN CAST(e % 10 AS INTEGER) END AS priority,
  CASE WHEN reason IS NULL AND e % 4 <> 0 THEN e END AS sequence_number,
  CASE WHEN reason IS NULL THEN (e % 3) * 1000 END AS time_to_live,
  CASE WHEN reason IS NULL AND pkey <> '' THEN pkey END AS key,
  CASE WHEN reason IS NULL THEN 'OK' ELSE 'FAILED' END AS status, reason FROM faulty"""


def stored_messages(spark: SparkSession, path: str) -> DataFrame:
    """Messages as the queue reader sees them, and the rejects beside them."""
    good = read_queue(spark, path).select(
        "correlation_id", "destination", F.hex(m.payload()).alias("payload_hex"),
        F.unix_millis("sender_ts").alias("sender_ts_ms"), "priority", "sequence_number",
        "time_to_live", F.when(m.partition_key() != "", m.partition_key()).alias("key"),
        F.lit("OK").alias("status"), F.lit(None).cast("string").alias("reason"),
    )
    bad = read_rejects(spark, path, "destination")
    return good.unionByName(bad.withColumnRenamed("Id", "correlation_id"), allowMissingColumns=True)


def checked(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    bound = pub.bind_columns(fx.publish_rows(spark, sf_dir), include_headers=True, keep=keep)
    return pub.publish_validate(bound)


def good_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelope rows that all can be published."""
    raw = fx.raw_messages(spark, sf_dir)
    return m.envelope(raw, include_headers=True, keep=("spool_seq",))


def scalar_messages(messages: DataFrame) -> DataFrame:
    key = F.decode(F.element_at("user_props", F.lit("JMSXGroupID")), "UTF-8")
    return messages.select(
        "correlation_id", "application_message_id", "destination",
        F.hex("payload").alias("payload_hex"), "sender_ts_ms", "delivery_mode", "priority",
        "sequence_number", "time_to_live", "dmq_eligible",
        F.when(key != "", key).alias("key"),
    )


@query("bind_columns", f"""WITH {MSG} SELECT rgmid AS Id, hex(encode(body)) AS payload_hex,
  CAST(NULL AS VARCHAR) AS PartitionKey, topic AS Topic, CAST(NULL AS BIGINT) AS time_us,
  CAST(NULL AS INTEGER) AS n_headers FROM msg""")
def bind_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing optional columns become null and an extra column is ignored."""
    rows = good_envelope(spark, sf_dir).drop("PartitionKey", "TimeStamp", "Headers")
    bound = pub.bind_columns(rows.withColumn("extra", F.lit(1)), include_headers=True)
    return bound.select(
        "Id", F.hex("Payload").alias("payload_hex"), "PartitionKey", "Topic",
        F.unix_micros("TimeStamp").alias("time_us"),
        F.when(F.col("Headers").isNotNull(), F.size("Headers")).alias("n_headers"),
    )


@query("topic_id_override", f"""WITH {MSG} SELECT 'fixed-id' AS Id, 'fixed/topic' AS Topic,
  body AS text FROM msg""")
def topic_id_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = good_envelope(spark, sf_dir).drop("Id")
    bound = pub.bind_columns(rows, topic="fixed/topic", message_id="fixed-id")
    return bound.select("Id", "Topic", m.payload_text().alias("text"))


@query("publish_validate", f"""WITH {MSG}, {FAULTY} SELECT e AS spool_seq, id AS Id, reason,
  CASE WHEN reason IS NULL THEN 'OK' ELSE 'FAILED' END AS status FROM faulty""")
def publish_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked(spark, sf_dir, "spool_seq").select("spool_seq", "Id", "reason", "status")


@query("reject_report", f"""WITH {MSG}, {FAULTY} SELECT id AS Id, 'FAILED' AS status, reason
  FROM faulty WHERE reason IS NOT NULL""")
def reject_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pub.reject_report(checked(spark, sf_dir))


@query("publish_report", f"""WITH {MSG}, {FAULTY} SELECT day_no AS batch_id, topic AS Topic,
  count(*) AS published, count(*) FILTER (WHERE reason IS NULL) AS acknowledged,
  count(*) FILTER (WHERE reason IS NOT NULL) AS failed FROM faulty GROUP BY 1, 2""")
def publish_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pub.publish_report(checked(spark, sf_dir, "batch_id"))


@query("publish_envelope", f"WITH {MSG}, {FAULTY} {PUBLISHED_SQL}")
def publish_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = pub.split_rejects(checked(spark, sf_dir))
    return scalar_messages(pub.publish_envelope(good))


@query("publish_batch", f"WITH {MSG}, {FAULTY} {STORED_SQL}")
def publish_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish to storage in report mode and read messages and rejects back."""
    path = workspace(spark, "published")
    publisher = Publisher(include_headers=True, mode="report")
    publish(fx.publish_rows(spark, sf_dir), path, publisher)
    return stored_messages(spark, path)


@query("headers_typed", f"""WITH {MSG} SELECT e AS spool_seq, CAST(0 AS BIGINT) AS expiration,
  (e % 3) * 1000 AS time_to_live,
  CASE WHEN e % 19 <> 0 THEN CAST(e % 10 AS INTEGER) END AS priority,
  CASE WHEN e % 4 <> 0 THEN e END AS sequence_number, TRUE AS dmq_eligible,
  CAST(NULL AS BOOLEAN) AS is_reply, CAST(NULL AS VARCHAR) AS sender_id,
  CAST(NULL AS VARCHAR) AS content_type FROM msg""")
def headers_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = h.typed_headers()
    return fx.publish_rows(spark, sf_dir).select(
        "spool_seq",
        typed["expiration"].alias("expiration"),
        typed["timeToLive"].alias("time_to_live"),
        typed["priority"].alias("priority"),
        typed["sequenceNumber"].alias("sequence_number"),
        typed["dmqEligible"].alias("dmq_eligible"),
        typed["isReply"].alias("is_reply"),
        typed["senderId"].alias("sender_id"),
        typed["contentType"].alias("content_type"),
    )


@query("user_properties_out", f"""WITH {MSG}, {HDR} SELECT e AS spool_seq, name, val FROM hdr
  WHERE name NOT LIKE '{PREFIX.replace('_', '^_')}%' ESCAPE '^'""")
def user_properties_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = good_envelope(spark, sf_dir).withColumn("props", h.user_properties())
    return exploded(rows, "props")


@query("headers_roundtrip", f"""WITH {MSG} SELECT e AS spool_seq, rgmid AS application_message_id,
  topic AS destination, body AS text, CAST(e % 10 AS INTEGER) AS priority,
  CAST(0 AS BIGINT) AS expiration, (e % 3) * 1000 AS time_to_live,
  CASE WHEN e % 4 <> 0 THEN e END AS sequence_number, FALSE AS redelivered,
  coalesce(pkey, '') AS PartitionKey, time_us // 1000 AS time_ms FROM msg""")
def headers_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source headers, published and read again by another source."""
    messages = Publisher(include_headers=True, keep=("spool_seq",)).messages(
        good_envelope(spark, sf_dir)
    )
    again = pub.as_raw(messages, "spool_seq")
    return again.select(
        "spool_seq", "application_message_id", "destination",
        F.decode(m.payload(), "UTF-8").alias("text"),
        "priority", "expiration", "time_to_live", "sequence_number", "redelivered",
        m.partition_key().alias("PartitionKey"),
        F.unix_millis(m.event_time()).alias("time_ms"),
    )


@query("missing_acks", f"""WITH {MSG} SELECT rgmid AS Id, topic AS Topic FROM msg
  WHERE e % 97 = 0""")
def missing_acks(spark: SparkSession, sf_dir: str) -> DataFrame:
    published = good_envelope(spark, sf_dir).select("Id", "Topic")
    return delivery.missing_acks(published, fx.acks(spark, sf_dir))


@query("missing_acks_one_id", f"""WITH {MSG} SELECT topic AS Topic, count(*) AS messages FROM msg
  WHERE topic <> 'events/view' GROUP BY 1""")
def missing_acks_one_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids shared by whole topics: shortfall is counted by message, however many share an id."""
    rows = good_envelope(spark, sf_dir).select(F.col("Topic").alias("Id"), "Topic")
    acked = rows.where(F.col("Topic") == "events/view").select("Id")
    missing = delivery.missing_acks(rows, acked)
    return missing.groupBy("Topic").agg(F.count("*").alias("messages"))
