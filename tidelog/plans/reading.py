"""Queries over the reading side: projections, batches, replay."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions import messages as m
from tidelog.operators import batching, replay
from tidelog.plans import fixtures as fx
from tidelog.plans.oracle import HDR, MSG, mid
from tidelog.plans.registry import query
from tidelog.session import workspace
from tidelog.sources.spool import read_queue

REPLAY_START, REPLAY_ZONE = "2024-01-09T19:30:00", "America/New_York"
REPLAY_START_UTC = "2024-01-10 00:30:00"
REPLAY_POSITION = 499
REPLAY_ID = f"rmid1:{REPLAY_POSITION:018d}"


def scalar_envelope(env: DataFrame) -> DataFrame:
    """Envelope rows with bytes as hex and time as microseconds."""
    return env.select(
        "Id",
        F.hex("Payload").alias("payload_hex"),
        "PartitionKey",
        "Topic",
        F.unix_micros("TimeStamp").alias("time_us"),
    )


ENVELOPE_SQL = """SELECT rgmid AS Id, hex(encode(body)) AS payload_hex,
  coalesce(pkey, '') AS PartitionKey, topic AS Topic, time_us FROM msg"""


@query("envelope", f"WITH {MSG} {ENVELOPE_SQL}")
def envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scalar_envelope(m.envelope(fx.raw_messages(spark, sf_dir)))


@query("queue_table", f"""WITH {MSG} SELECT e AS spool_seq, rgmid, topic AS destination,
  CAST(e % 10 AS INTEGER) AS priority, e % 25 = 0 AS redelivered,
  CASE WHEN e % 4 <> 0 THEN e END AS sequence_number, receive_us FROM msg""")
def queue_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "log")
    fx.raw_messages(spark, sf_dir).write.parquet(path)
    return read_queue(spark, path).select(
        "spool_seq", "rgmid", "destination", "priority", "redelivered", "sequence_number",
        F.unix_micros("receive_ts").alias("receive_us"),
    )


@query("payload_normalise",
       f"WITH {MSG} SELECT e AS spool_seq, hex(encode(body)) AS payload_hex FROM msg")
def payload_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.raw_messages(spark, sf_dir).select(
        "spool_seq", F.hex(m.payload()).alias("payload_hex")
    )


@query("payload_text", f"WITH {MSG} SELECT rgmid AS Id, body AS text FROM msg")
def payload_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    env = m.envelope(fx.raw_messages(spark, sf_dir))
    return env.select("Id", m.payload_text().alias("text"))


@query("payload_text_documents", f"""SELECT {mid('doc_id')} AS Id, 'documents/' || lang AS Topic,
  text, CAST(octet_length(encode(text)) AS BIGINT) AS n_bytes FROM documents""")
def payload_text_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long payloads, whole."""
    env = m.envelope(fx.document_messages(spark, sf_dir))
    return env.select(
        "Id", "Topic", m.payload_text().alias("text"),
        F.octet_length("Payload").cast("bigint").alias("n_bytes"),
    )


@query("message_id_select", f"""WITH {MSG} SELECT e AS spool_seq, rgmid AS message_id,
  CASE WHEN corr <> '' THEN corr END AS correlation_id, app AS application_message_id,
  CAST(e AS VARCHAR) AS by_property, CASE WHEN pkey <> '' THEN pkey END AS by_key FROM msg""")
def message_id_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    def chosen(indicator: str):
        return m.message_id(indicator, strict=False)

    return fx.raw_messages(spark, sf_dir).select(
        "spool_seq",
        chosen(m.MESSAGE_ID).alias("message_id"),
        chosen(m.CORRELATION_ID).alias("correlation_id"),
        chosen(m.APPLICATION_MESSAGE_ID).alias("application_message_id"),
        chosen("ordinal").alias("by_property"),
        chosen("JMSXGroupID").alias("by_key"),
    )


@query("offset_indicator_check", f"""WITH {MSG}, s AS (
  SELECT 'MESSAGE_ID' AS indicator, 'OK' AS status FROM msg
  UNION ALL SELECT 'CORRELATION_ID', CASE WHEN coalesce(corr, '') = '' THEN 'EMPTY' ELSE 'OK' END
    FROM msg
  UNION ALL SELECT 'APPLICATION_MESSAGE_ID', 'OK' FROM msg
  UNION ALL SELECT 'JMSXGroupID', CASE WHEN pkey IS NULL THEN 'MISSING' WHEN pkey = '' THEN 'EMPTY'
    ELSE 'OK' END FROM msg
  UNION ALL SELECT 'absent', 'EMPTY' FROM msg
  UNION ALL SELECT 'no-such-property', 'MISSING' FROM msg)
  SELECT indicator, status, count(*) AS messages FROM s GROUP BY 1, 2""")
def offset_indicator_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    indicators = (
        m.MESSAGE_ID, m.CORRELATION_ID, m.APPLICATION_MESSAGE_ID, "JMSXGroupID",
        "absent", "no-such-property",
    )
    each = F.explode(
        F.array(*[F.struct(F.lit(i).alias("indicator"), m.id_status(i).alias("status"))
                  for i in indicators])
    )
    return (
        fx.raw_messages(spark, sf_dir).select(each.alias("s")).select("s.*")
        .groupBy("indicator", "status").agg(F.count("*").alias("messages"))
    )


@query("partition_key",
       f"WITH {MSG} SELECT e AS spool_seq, coalesce(pkey, '') AS PartitionKey FROM msg")
def partition_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.raw_messages(spark, sf_dir).select(
        "spool_seq", m.partition_key().alias("PartitionKey")
    )


@query("topic_of", f"WITH {MSG} SELECT topic AS Topic, count(*) AS messages FROM msg GROUP BY 1")
def topic_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.raw_messages(spark, sf_dir)
    return raw.groupBy(m.topic().alias("Topic")).agg(F.count("*").alias("messages"))


@query("event_time", f"WITH {MSG} SELECT e AS spool_seq, time_us FROM msg")
def event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.raw_messages(spark, sf_dir).select(
        "spool_seq", F.unix_micros(m.event_time()).alias("time_us")
    )


def exploded(df: DataFrame, column: str) -> DataFrame:
    """One row per map entry, bytes as text."""
    return df.select("spool_seq", F.explode(column).alias("name", "bytes")).select(
        "spool_seq", "name", F.decode("bytes", "UTF-8").alias("val")
    )


@query("headers_map", f"WITH {MSG}, {HDR} SELECT e AS spool_seq, name, val FROM hdr")
def headers_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    env = m.envelope(fx.raw_messages(spark, sf_dir), include_headers=True, keep=("spool_seq",))
    return exploded(env, "Headers")


@query("header_toggle", f"""WITH {MSG}, {HDR} SELECT rgmid AS Id, 5 AS plain_columns,
  6 AS header_columns, n AS n_headers FROM msg JOIN
  (SELECT e, CAST(count(*) AS INTEGER) AS n FROM hdr GROUP BY e) USING (e)""")
def header_toggle(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.raw_messages(spark, sf_dir)
    plain, full = m.envelope(raw), m.envelope(raw, include_headers=True)
    return full.select(
        "Id",
        F.lit(len(plain.columns)).alias("plain_columns"),
        F.lit(len(full.columns)).alias("header_columns"),
        F.size("Headers").alias("n_headers"),
    )


@query("message_record_equality", """SELECT min(doc_id) AS first_seq, count(*) AS copies
  FROM documents GROUP BY text, lang""")
def message_record_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = fx.document_messages(spark, sf_dir)
    return (
        messages.select(m.fingerprint().alias("fingerprint"), "spool_seq")
        .groupBy("fingerprint")
        .agg(F.min("spool_seq").alias("first_seq"), F.count("*").alias("copies"))
        .drop("fingerprint")
    )


@query("consumer_split", f"""WITH {MSG} SELECT rgmid AS Id, CAST(e % 3 AS INTEGER) AS consumer
  FROM msg""")
def consumer_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = batching.assign_consumer(fx.raw_messages(spark, sf_dir), 3)
    return dealt.select(F.col("rgmid").alias("Id"), "consumer")


@query("batch_plan", """WITH n AS (SELECT event_id,
  row_number() OVER (PARTITION BY event_id % 2 ORDER BY event_id) - 1 AS place FROM events)
  SELECT event_id AS spool_seq, CAST(event_id % 2 AS INTEGER) AS consumer,
    place // 50 AS batch FROM n""")
def batch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = batching.plan_batches(fx.raw_messages(spark, sf_dir), fx.CONSUMERS, fx.BATCH_SIZE)
    return planned.select("spool_seq", "consumer", "batch")


@query("batch_plan_sparse", """WITH n AS (SELECT event_id, event_type,
  row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS place FROM events)
  SELECT event_id AS spool_seq, 'events/' || event_type AS consumer, place // 50 AS batch FROM n""")
def batch_plan_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A consumer per topic, so that each one's positions have gaps."""
    log = fx.raw_messages(spark, sf_dir).select("spool_seq", F.col("destination").alias("consumer"))
    return batching.plan_batches_sparse(log, fx.BATCH_SIZE)


@query("batch_counts", """SELECT event_id // 100 AS batch, count(*) AS messages FROM events
  GROUP BY 1""")
def batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = batching.plan_batches(fx.raw_messages(spark, sf_dir), fx.CONSUMERS, fx.BATCH_SIZE)
    return batching.batch_counts(planned)


@query("browse_head", f"""WITH {MSG} SELECT topic AS Topic, rgmid AS Id, body AS text FROM msg
  WHERE e IN (SELECT min(e) FROM msg GROUP BY topic)""")
def browse_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    head = batching.browse_head(fx.raw_messages(spark, sf_dir))
    return m.envelope(head).select("Topic", "Id", m.payload_text().alias("text"))


@query("browse_head_conversations", f"""WITH t AS (SELECT conv_id * 100000 + turn AS pos, * FROM
  conversations) SELECT {mid('pos')} AS Id, CAST(conv_id AS VARCHAR) AS PartitionKey, text FROM t
  WHERE (conv_id, turn) IN (SELECT conv_id, min(turn) FROM conversations GROUP BY conv_id)""")
def browse_head_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first message of every partition key."""
    log = fx.turn_messages(spark, sf_dir).withColumn("key", m.partition_key())
    head = batching.browse_head(log, by="key")
    return m.envelope(head).select("Id", "PartitionKey", m.payload_text().alias("text"))


@query("replay_beginning", f"WITH {MSG} {ENVELOPE_SQL}")
def replay_beginning(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = replay.replay(fx.raw_messages(spark, sf_dir), replay.BEGINNING)
    return scalar_envelope(m.envelope(raw))


def replayed_from_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.raw_messages(spark, sf_dir)
    return replay.replay(raw, replay.TIMEBASED, REPLAY_START, REPLAY_ZONE)


@query("replay_from_time", f"""WITH {MSG} {ENVELOPE_SQL}
  WHERE receive_us >= epoch_us(TIMESTAMP '{REPLAY_START_UTC}')""")
def replay_from_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scalar_envelope(m.envelope(replayed_from_time(spark, sf_dir)))


@query("replay_topic_counts", f"""WITH {MSG} SELECT topic AS Topic, count(*) AS messages,
  min(time_us) AS first_us, max(time_us) AS last_us, sum(octet_length(encode(body)))::BIGINT AS n_bytes
  FROM msg WHERE receive_us >= epoch_us(TIMESTAMP '{REPLAY_START_UTC}') GROUP BY 1""")
def replay_topic_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages and payload volume per topic since a replay start."""
    env = m.envelope(replayed_from_time(spark, sf_dir))
    return env.groupBy("Topic").agg(
        F.count("*").alias("messages"),
        F.unix_micros(F.min("TimeStamp")).alias("first_us"),
        F.unix_micros(F.max("TimeStamp")).alias("last_us"),
        F.sum(F.octet_length("Payload")).cast("bigint").alias("n_bytes"),
    )


@query("replay_after_id", f"WITH {MSG} {ENVELOPE_SQL} WHERE e > {REPLAY_POSITION}")
def replay_after_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = replay.replay(fx.raw_messages(spark, sf_dir), replay.AFTER_MESSAGE, message_id=REPLAY_ID)
    return scalar_envelope(m.envelope(raw))


@query("replay_after_position", f"WITH {MSG} {ENVELOPE_SQL} WHERE e > {REPLAY_POSITION}")
def replay_after_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for an id whose text order is not message order."""
    raw = fx.raw_messages(spark, sf_dir)
    after = replay.replay_after_position_of(
        raw, f"app-{REPLAY_POSITION}", by="application_message_id"
    )
    return scalar_envelope(m.envelope(after))
