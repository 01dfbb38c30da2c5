"""Streaming queries: each runs over a stored copy of the whole log and equals a batch query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import messages as m
from tidelog.operators import batching, delivery
from tidelog.operators.replay import TIMEBASED
from tidelog.options import QueueReader, QueueWriter
from tidelog.plans import fixtures as fx
from tidelog.plans.oracle import FAULTY, HIST, MSG
from tidelog.plans.publishing import STORED_SQL, stored_messages
from tidelog.plans.reading import (
    ENVELOPE_SQL,
    REPLAY_START,
    REPLAY_START_UTC,
    REPLAY_ZONE,
    scalar_envelope,
)
from tidelog.plans.recovery import KEPT, merged
from tidelog.plans.registry import query
from tidelog.schema import RAW_MESSAGE
from tidelog.session import workspace
from tidelog.sinks.publish import Publisher, publish_stream
from tidelog.sources.spool import open_queue, read_queue, stream_parquet, stream_raw
from tidelog.streaming import jobs as p
from tidelog.streaming.batches import read_batches

# Messages for each consumer in a micro-batch, and consumers.
BATCH_SIZE, PARTITIONS = 1000, 8
STEP = BATCH_SIZE * PARTITIONS
# Rows of a file of the stored log; batches and consumers end inside of files.
FILE_ROWS = 7_500


def spooled(spark: SparkSession, sf_dir: str) -> str:
    """The event log on storage."""
    path = workspace(spark, "log")
    fx.raw_messages(spark, sf_dir).write.option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    return path


def opened(spark: SparkSession, sf_dir: str, **options: object) -> DataFrame:
    return open_queue(
        spark, spooled(spark, sf_dir), partitions=PARTITIONS, batch_size=BATCH_SIZE, **options
    )


def raw_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_raw(spark, spooled(spark, sf_dir), PARTITIONS, BATCH_SIZE)


def landed(stream: DataFrame, large_state: bool = False, **options: bool) -> DataFrame:
    """Land a stream as Parquet and read it back."""
    spark = stream.sparkSession
    out = workspace(spark, "landed")
    writer = p.land_parquet(stream, out, workspace(spark, "checkpoint"))
    p.run_available(writer, large_state=large_state, **options)
    return spark.read.schema(stream.schema).parquet(out)


@query("queue_stream", f"WITH {MSG} {ENVELOPE_SQL}")
def queue_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scalar_envelope(landed(opened(spark, sf_dir)))


@query("queue_stream_replay", f"""WITH {MSG} {ENVELOPE_SQL}
  WHERE receive_us >= epoch_us(TIMESTAMP '{REPLAY_START_UTC}')""")
def queue_stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scalar_envelope(landed(opened(
        spark, sf_dir, replay_strategy=TIMEBASED, replay_start_time=REPLAY_START,
        replay_timezone=REPLAY_ZONE,
    )))


@query("queue_stream_resume",
       f"WITH {MSG}, {HIST} {ENVELOPE_SQL} LEFT JOIN ckpt ON pkey = part WHERE {KEPT}")
def queue_stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fresh stream that skips what a checkpoint covers."""
    resumed = opened(spark, sf_dir, checkpoints=merged(spark, sf_dir))
    return scalar_envelope(landed(resumed, adaptive=False))


@query("queue_stream_batches", f"""SELECT event_id // {STEP} AS batch_id,
  count(*) AS messages FROM events GROUP BY 1""")
def queue_stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = workspace(spark, "batches")
    stream = opened(spark, sf_dir)
    p.run_available(p.count_batches(stream, out, workspace(spark, "checkpoint")), adaptive=False)
    counts = T.StructType([T.StructField("messages", T.LongType())])
    return read_batches(spark, out, counts).drop("query")


@query("isempty_then_read", f"""SELECT event_id // {STEP} AS batch_id, FALSE AS empty,
  count(*) AS first_read, count(*) AS second_read FROM events GROUP BY 1""")
def isempty_then_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = workspace(spark, "probes")
    stream = opened(spark, sf_dir)
    p.run_available(p.probe_batches(stream, out, workspace(spark, "checkpoint")))
    return read_batches(spark, out, T.StructType([
        T.StructField("first_read", T.LongType()),
        T.StructField("second_read", T.LongType()),
        T.StructField("empty", T.BooleanType()),
    ])).drop("query")


@query("parquet_stream_in", "SELECT event_type, count(*) AS messages FROM events GROUP BY 1")
def parquet_stream_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plain Parquet folder as a stream, with the schema of a batch read."""
    folder = workspace(spark, "events")
    fx.events(spark, sf_dir).write.parquet(folder)
    rows = landed(stream_parquet(spark, folder))
    return rows.groupBy("event_type").agg(F.count("*").alias("messages"))


@query("land_parquet", f"""WITH {MSG} SELECT topic AS Topic, body AS text, count(*) AS messages
  FROM msg GROUP BY 1, 2""")
def land_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = landed(opened(spark, sf_dir, include_headers=True))
    return rows.groupBy("Topic", m.payload_text().alias("text")).agg(
        F.count("*").alias("messages")
    )


@query("restart_exactly_once", f"WITH {MSG} {ENVELOPE_SQL}")
def restart_exactly_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stop after half the log, add the rest, restart on the same checkpoint."""
    raw = fx.raw_messages(spark, sf_dir)
    first, last = raw.agg(F.min("spool_seq"), F.max("spool_seq")).first()
    rows = last - first + 1
    half = first + rows // 2
    path, out, checkpoint = (workspace(spark, n) for n in ("log", "out", "checkpoint"))
    for start, stop in ((first, half), (half, last + 1)):
        inside = (F.col("spool_seq") >= start) & (F.col("spool_seq") < stop)
        raw.where(inside).write.mode("append").option("maxRecordsPerFile", FILE_ROWS).parquet(path)
        stream = open_queue(spark, path, partitions=PARTITIONS, batch_size=BATCH_SIZE)
        p.run_available(p.land_parquet(stream, out, checkpoint))
    return scalar_envelope(spark.read.schema(stream.schema).parquet(out))


@query("stream_to_stream", f"""WITH {MSG} SELECT 'processed' AS Topic, rgmid AS Id,
  upper(body) AS text, CAST(4 AS INTEGER) AS priority FROM msg""")
def stream_to_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue, transform, publish under another topic, then read that queue as raw messages."""
    shouted = opened(spark, sf_dir, keep=("spool_seq",)).withColumn(
        "Payload", F.upper(m.payload_text()).cast("binary")
    )
    out = workspace(spark, "republished")
    p.run_available(p.stream_to_stream(
        shouted, out, workspace(spark, "checkpoint"), topic="processed"
    ))
    env = m.envelope(read_queue(spark, out), offset_indicator=m.APPLICATION_MESSAGE_ID, keep=("priority",))
    return env.select("Topic", "Id", m.payload_text().alias("text"), "priority")


@query("publish_stream", f"WITH {MSG}, {FAULTY} {STORED_SQL}")
def publish_stream_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faulty rows as a stream through the sink in report mode; none is lost."""
    rows = workspace(spark, "rows")
    fx.publish_rows(spark, sf_dir).write.parquet(rows)
    out = workspace(spark, "published")
    publisher = Publisher(include_headers=True, mode="report")
    p.run_available(publish_stream(
        stream_parquet(spark, rows), out, workspace(spark, "checkpoint"), publisher
    ))
    return stored_messages(spark, out)


THEN_READ_SQL = """SELECT rgmid AS Id, hex(encode(body)) AS payload_hex, coalesce(pkey, '') AS
  PartitionKey, 'again' AS Topic, time_us // 1000 AS time_ms, CAST(e % 10 AS VARCHAR) AS priority,
  CASE WHEN e % 4 <> 0 THEN CAST(e AS VARCHAR) END AS sequence, 'true' AS flag FROM msg"""


def _read_again(rows: DataFrame) -> DataFrame:
    def header(name: str):
        return F.element_at("Headers", F.lit(name)).cast("string")

    return rows.select(
        "Id", F.hex("Payload").alias("payload_hex"), "PartitionKey", "Topic",
        F.unix_millis("TimeStamp").alias("time_ms"), header("mq_priority").alias("priority"),
        header("mq_sequenceNumber").alias("sequence"), header("checked").alias("flag"),
    )


def _again(spark: SparkSession, path: str) -> QueueReader:
    return QueueReader(spark).options(
        queue=path, includeHeaders="true", offsetIndicator=m.APPLICATION_MESSAGE_ID
    )


@query("publish_then_read", f"WITH {MSG} {THEN_READ_SQL}")
def publish_then_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the writer stores, the reader gives back: by options alone, as tables."""
    env = m.envelope(fx.raw_messages(spark, sf_dir), include_headers=True)
    out = workspace(spark, "published")
    QueueWriter(env).options(queue=out, topic="again", includeHeaders="true").save()
    return _read_again(_again(spark, out).loadBatch())


@query("publish_stream_then_read", f"WITH {MSG} {THEN_READ_SQL}")
def publish_stream_then_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with both ends as streams."""
    out = workspace(spark, "published")
    p.run_available(QueueWriter(opened(spark, sf_dir, include_headers=True)).options(
        queue=out, topic="again", includeHeaders="true",
        checkpointLocation=workspace(spark, "checkpoint"),
    ).writeStream())
    return _read_again(landed(_again(spark, out).load()))


@query("foreach_batch_publish", f"""WITH {MSG} SELECT topic AS destination, rgmid AS correlation_id,
  body AS text, CAST(e % 10 AS INTEGER) AS priority FROM msg""")
def foreach_batch_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = workspace(spark, "published")
    stream = opened(spark, sf_dir, include_headers=True).drop("TimeStamp")
    p.run_available(p.foreach_batch_publish(
        stream, out, workspace(spark, "checkpoint"), Publisher(include_headers=True)
    ))
    return read_queue(spark, out).select(
        "destination", "correlation_id", F.decode(m.payload(), "UTF-8").alias("text"), "priority"
    )


@query("commit_publish", f"""WITH {MSG} SELECT CAST(consumer AS VARCHAR) AS partitionId,
  max(rgmid) AS messageIDs, count(*) AS messages FROM msg GROUP BY consumer""")
def commit_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and state after every batch; the final state is each consumer's last message."""
    rows_path, state_path = workspace(spark, "rows"), workspace(spark, "state")
    stream = batching.assign_consumer(
        opened(spark, sf_dir, keep=("spool_seq",)), fx.CONSUMERS
    )
    p.run_available(p.commit_publish(
        stream, rows_path, state_path, workspace(spark, "checkpoint")
    ), adaptive=False)
    counts = read_batches(spark, rows_path, stream.schema).groupBy(
        F.col("consumer").cast("string").alias("partitionId")
    ).agg(F.count("*").alias("messages"))
    return p.committed_state(spark, state_path).join(counts, "partitionId")


@query("last_value_stream", f"""WITH {MSG} SELECT topic AS Topic, rgmid AS Id, body AS text FROM msg
  WHERE e IN (SELECT max(e) FROM msg GROUP BY topic)""")
def last_value_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last value per topic, kept in Spark's state store and read back from there."""
    checkpoint, keys = workspace(spark, "checkpoint"), ["destination"]
    p.run_available(p.last_value_stream(raw_stream(spark, sf_dir), checkpoint, keys))
    newest = p.read_last_value(spark, checkpoint, RAW_MESSAGE, keys)
    return m.envelope(newest).select("Topic", "Id", m.payload_text().alias("text"))


@query("update_as_append", f"""WITH {MSG} SELECT topic AS Topic, count(*) AS messages,
  max(e) AS last_seq FROM msg GROUP BY 1""")
def update_as_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = raw_stream(spark, sf_dir).groupBy(F.col("destination").alias("Topic")).agg(
        F.count("*").alias("messages"), F.max("spool_seq").alias("last_seq")
    )
    out = workspace(spark, "updates")
    p.run_available(p.update_as_append(totals, out, workspace(spark, "checkpoint")))
    return p.read_updates(spark, out, totals.schema, ["Topic"])


@query("dedup_stream", f"WITH {MSG} {ENVELOPE_SQL}")
def dedup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message delivered twice, kept once, however old its own time is."""
    twice = opened(spark, sf_dir).withColumn(
        "attempt", F.explode(F.array(F.lit(1), F.lit(2)))
    ).drop("attempt")
    return scalar_envelope(landed(delivery.dedup_stream(twice), large_state=True))


@query("dedup_append", f"WITH {MSG} {ENVELOPE_SQL}")
def dedup_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without a watermark, against all that was written before."""
    stream = opened(spark, sf_dir, keep=("spool_seq",))
    twice = stream.withColumn("attempt", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn(
        "delivery", F.col("spool_seq") * 2 + F.col("attempt")
    )
    out = workspace(spark, "once")
    p.run_available(p.dedup_append(twice, out, workspace(spark, "checkpoint")), adaptive=False)
    return scalar_envelope(read_batches(spark, out, twice.schema))
