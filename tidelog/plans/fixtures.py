"""Message logs, checkpoints and publish rows that Spark derives from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.messages import envelope
from tidelog.operators.batching import assign_consumer
from tidelog.operators.delivery import ack_ledger
from tidelog.schema import DEFAULT_HEADER_PREFIX, PARTITION_KEY_PROPERTY, RAW_MESSAGE
from tidelog.session import stage

CONSUMERS = 2
BATCH_SIZE = 50
DAY_MICROS = 86_400_000_000

# `ts` holds UTC instants; reading it as such keeps results free of the session's time zone and
# leaves it a plain column, so time filters reach the scan.
_EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(_EVENTS).parquet(f"{sf_dir}/events.parquet")


def _every(n: int, rest: int = 0) -> Column:
    return F.pmod("event_id", F.lit(n)) == rest


def _id(prefix: str) -> Column:
    return F.concat(F.lit(prefix), F.col("event_id").cast("string"))


def message_id_of(position: Column) -> Column:
    return F.concat(F.lit("rmid1:"), F.lpad(position.cast("string"), 18, "0"))


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw message per event; the rules are listed in FIXTURES.md."""
    e = F.col("event_id")
    hundred = F.pmod(e, F.lit(100))
    user_key = F.when(F.col("event_type").isin("purchase", "signup"), F.col("user_id").cast("string"))
    key = F.when(F.col("event_type") == "error", "").otherwise(user_key)
    none = F.create_map().cast("map<string,string>")
    values = {
        "spool_seq": e,
        "rgmid": message_id_of(e),
        "correlation_id": F.when(_every(10, 1), "").when(~_every(10), _id("corr-")),
        "application_message_id": _id("app-"),
        "destination": F.concat(F.lit("events/"), F.col("event_type")),
        "reply_to": F.when(_every(5), F.concat(F.lit("replies/"), F.col("user_id").cast("string"))),
        "sender_ts": F.when(_every(7, 1), F.timestamp_micros(F.lit(0))).when(
            ~_every(7), F.col("ts") - F.expr("interval 1 second")
        ),
        "receive_ts": F.col("ts"),
        "expiration": F.lit(0),
        "time_to_live": F.pmod(e, F.lit(3)) * 1000,
        "priority": F.pmod(e, F.lit(10)),
        "redelivered": _every(25),
        "sequence_number": F.when(~_every(4), e),
        "is_text": hundred < 98,
        "text_body": F.when(hundred <= 90, F.col("props")),
        "attachment": F.when(
            hundred.between(91, 95) | (hundred == 98), F.concat(F.lit("att:"), F.col("props"))
        ),
        "content": F.when(hundred.between(96, 98), F.concat(F.lit("cnt:"), F.col("props"))),
        "user_props": F.map_concat(
            F.create_map(
                F.lit("colour"), F.lit("amber"),
                F.lit("checked"), F.lit("true"),
                F.lit("absent"), F.lit(None).cast("string"),
                F.lit("blank"), F.lit(""),
                F.lit("ordinal"), e.cast("string"),
            ),
            F.when(key.isNotNull(), F.create_map(F.lit(PARTITION_KEY_PROPERTY), key)).otherwise(none),
            F.when(
                _every(50), F.create_map(F.lit(f"{DEFAULT_HEADER_PREFIX}priority"), F.lit("99"))
            ).otherwise(none),
        ),
    }
    return events(spark, sf_dir).select(
        [values[f.name].cast(f.dataType).alias(f.name) for f in RAW_MESSAGE.fields]
    )


def document_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw message per document, its whole text as payload; copies are equal messages."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    doc = F.col("doc_id").cast("bigint")
    values = {
        "spool_seq": doc,
        "rgmid": message_id_of(doc),
        "destination": F.concat(F.lit("documents/"), F.col("lang")),
        "expiration": F.lit(0),
        "priority": F.lit(4),
        "redelivered": F.lit(False),
        "is_text": F.lit(True),
        "text_body": F.col("text"),
        "user_props": F.create_map(F.lit("lang"), F.col("lang")),
    }
    return docs.select(
        [values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RAW_MESSAGE.fields]
    )


def turn_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw message per conversation turn, keyed by conversation and ordered by turn.

    A conversation is a partition key, so positions leave gaps wherever it is short.
    """
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    position = F.col("conv_id").cast("bigint") * 100_000 + F.col("turn").cast("bigint")
    values = {
        "spool_seq": position,
        "rgmid": message_id_of(position),
        "destination": F.concat(F.lit("conversations/"), F.col("role")),
        "is_text": F.lit(True),
        "text_body": F.col("text"),
        "user_props": F.create_map(
            F.lit(PARTITION_KEY_PROPERTY), F.col("conv_id").cast("string")
        ),
    }
    return turns.select(
        [values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RAW_MESSAGE.fields]
    )


def day_of(time: str = "receive_ts") -> Column:
    return F.expr(f"unix_micros({time}) div {DAY_MICROS}")


def checkpoint_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A checkpoint of every consumer and of every partition key for every day of the log.

    A consumer's holds its last id of the day. A key's holds its first and last id of the day, as
    two consumers would leave it; keys that end in 7 have lost their ids.
    """
    raw = raw_messages(spark, sf_dir)
    consumers = (
        assign_consumer(raw, CONSUMERS)
        .groupBy("consumer", day_of().alias("batch_id"))
        .agg(F.max("spool_seq").alias("last"))
        .select(
            F.concat(F.lit("c-"), F.col("consumer").cast("string")).alias("partitionId"),
            message_id_of(F.col("last")).alias("messageIDs"),
            "batch_id",
        )
    )
    keyed = events(spark, sf_dir).where(F.col("event_type").isin("purchase", "signup"))
    ids = F.concat(message_id_of(F.col("first")), F.lit(","), message_id_of(F.col("last")))
    keys = (
        keyed.groupBy("user_id", day_of("ts").alias("batch_id"))
        .agg(F.min("event_id").alias("first"), F.max("event_id").alias("last"))
        .select(
            F.col("user_id").cast("string").alias("partitionId"),
            F.when(F.pmod("user_id", F.lit(10)) == 7, "").otherwise(ids).alias("messageIDs"),
            "batch_id",
        )
    )
    return stage(consumers.unionByName(keys), "history")


def offset_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One offset-log line per event, over all shapes: current, old, empty and unreadable."""
    e = F.col("event_id").cast("string")

    def line(*parts: str) -> Column:
        pieces = [x for p in parts for x in (F.lit(p), e)][:-1]
        return F.concat(*pieces)

    json = (
        F.when(_every(6, 0), line('{"offset":', ',"messageIDs":"a', ',b', '"}'))
        .when(_every(6, 1), line('{"offset":', "}"))
        .when(_every(6, 2), line('{"offset":', ',"checkpoints":[{"partitionId":"p1","messageIDs":"c',
                                 '"}]}'))
        .when(_every(6, 3), line('{"offset":', ',"checkpoints":[{"partitionId":"p1","messageIDs":"d',
                                 ',f', '"},{"partitionId":"p2","messageIDs":"g', ',h', '"}]}'))
        .when(_every(6, 4), line('{"offset":', ',"checkpoints":[]}'))
        .otherwise(line("junk ", ""))
    )
    return events(spark, sf_dir).select(F.col("event_id").alias("line_no"), json.alias("json"))


def acks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An acknowledgement for every message but each 97th."""
    return raw_messages(spark, sf_dir).where(F.pmod("spool_seq", F.lit(97)) != 0).select(
        F.col("rgmid").alias("Id")
    )


def publish_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelope rows with headers and faults: null Id, Topic or Payload, and a bad header."""
    seq = F.col("spool_seq")

    def faulty(name: str, n: int) -> Column:
        return F.when(F.pmod(seq, F.lit(n)) != 0, F.col(name)).alias(name)

    bad = F.create_map(F.lit(f"{DEFAULT_HEADER_PREFIX}priority"), F.lit("abc").cast("binary"))
    rest = F.map_filter("Headers", lambda k, _: k != f"{DEFAULT_HEADER_PREFIX}priority")
    rows = envelope(raw_messages(spark, sf_dir), include_headers=True, keep=("spool_seq", "receive_ts"))
    return rows.select(
        faulty("Id", 11),
        faulty("Payload", 17),
        "PartitionKey",
        faulty("Topic", 13),
        "TimeStamp",
        F.when(F.pmod(seq, F.lit(19)) == 0, F.map_concat(rest, bad)).otherwise(F.col("Headers")).alias(
            "Headers"
        ),
        "spool_seq",
        day_of().alias("batch_id"),
    )


def redeliver(batches: DataFrame, order: str = "spool_seq") -> DataFrame:
    """What arrives when every consumer fails: all messages, then the pending ones again.

    ``delivery`` orders the arrivals: a message's second delivery follows its first directly.
    """
    ledger = ack_ledger(batches)
    attempts = F.when(F.col("ack") == "PENDING", F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    twice = ledger.withColumn("_attempt", F.explode(attempts))
    return (
        twice.withColumn("delivery", F.col(order) * 2 + F.col("_attempt"))
        .withColumn("redelivered", F.col("redelivered") | (F.col("_attempt") == 1))
        .drop("_attempt", "ack")
    )
