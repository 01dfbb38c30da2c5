"""Queries over checkpoints, restart and delivery state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions import messages as m
from tidelog.functions import offsets
from tidelog.operators import batching, checkpoints, delivery, resume
from tidelog.plans import fixtures as fx
from tidelog.plans.oracle import HIST, MSG
from tidelog.plans.reading import ENVELOPE_SQL, scalar_envelope
from tidelog.plans.registry import query

# The fixture's offset log by shape of line, decoded by rule.
ENTRIES = """entries AS (
  SELECT event_id AS line_no, event_id AS off, 'old-checkpoint' AS part,
         'a' || event_id || ',b' || event_id AS ids FROM events WHERE event_id % 6 = 0
  UNION ALL SELECT event_id, event_id, 'old-checkpoint', '' FROM events WHERE event_id % 6 = 1
  UNION ALL SELECT event_id, event_id, 'p1', 'c' || event_id FROM events WHERE event_id % 6 = 2
  UNION ALL SELECT event_id, event_id, 'p1', 'd' || event_id || ',f' || event_id FROM events
    WHERE event_id % 6 = 3
  UNION ALL SELECT event_id, event_id, 'p2', 'g' || event_id || ',h' || event_id FROM events
    WHERE event_id % 6 = 3)"""

KEPT = """CASE WHEN pkey IS NULL THEN rgmid > (SELECT min(floor_id) FROM ckpt)
  WHEN pkey = '' THEN TRUE ELSE floor_id IS NULL OR rgmid > floor_id END"""


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checkpoints.merge_checkpoints(fx.checkpoint_history(spark, sf_dir))


def planned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batching.plan_batches(fx.raw_messages(spark, sf_dir), fx.CONSUMERS, fx.BATCH_SIZE)


@query("offset_decode", f"""WITH {ENTRIES} SELECT line_no, off AS "offset", part AS partitionId,
  unnest(string_split(ids, ',')) AS messageId FROM entries WHERE ids <> ''""")
def offset_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offsets.decode_offsets(fx.offset_log(spark, sf_dir))


@query("offset_migrate", f"""WITH {ENTRIES} SELECT line_no, off AS "offset", part AS partitionId,
  ids AS messageIDs, TRUE AS readable FROM entries
  UNION ALL SELECT event_id, event_id, NULL, NULL, TRUE FROM events WHERE event_id % 6 = 4
  UNION ALL SELECT event_id, NULL, NULL, NULL, FALSE FROM events WHERE event_id % 6 = 5""")
def offset_migrate(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = offsets.migrate_offsets(fx.offset_log(spark, sf_dir))
    return entries.select("line_no", "offset", F.explode_outer("checkpoints").alias("c"),
                          "readable").select(
        "line_no", "offset", "c.partitionId", "c.messageIDs", "readable"
    )


@query("consumer_checkpoint", f"""WITH {MSG} SELECT CAST(consumer AS VARCHAR) AS partitionId,
  max(rgmid) AS messageIDs FROM msg GROUP BY consumer""")
def consumer_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = batching.assign_consumer(fx.raw_messages(spark, sf_dir), fx.CONSUMERS)
    return checkpoints.consumer_checkpoint(dealt, "consumer", "rgmid")


@query("consumer_checkpoint_keyed", """WITH t AS (SELECT conv_id, max(turn) AS turn
  FROM conversations GROUP BY conv_id) SELECT CAST(conv_id AS VARCHAR) AS partitionId,
  'rmid1:' || lpad(CAST(conv_id * 100000 + turn AS VARCHAR), 18, '0') AS messageIDs FROM t""")
def consumer_checkpoint_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last processed message of every partition key."""
    log = fx.turn_messages(spark, sf_dir).withColumn("key", m.partition_key())
    return checkpoints.consumer_checkpoint(log, "key", "rgmid")


@query("checkpoint_merge", f"""WITH {MSG}, {HIST} SELECT part AS partitionId, ids AS messageIDs
  FROM ckpt""")
def checkpoint_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merged(spark, sf_dir)


@query("last_value", f"""WITH {MSG} SELECT topic AS Topic, rgmid AS Id, body AS text, time_us
  FROM msg WHERE e IN (SELECT max(e) FROM msg GROUP BY topic)""")
def last_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = checkpoints.last_value(fx.raw_messages(spark, sf_dir))
    env = m.envelope(newest)
    return env.select(
        "Topic", "Id", m.payload_text().alias("text"), F.unix_micros("TimeStamp").alias("time_us")
    )


@query("restart_state", f"""WITH {MSG}, {HIST}, {ENTRIES}
  SELECT 'both' AS scenario, part AS partitionId, ids AS messageIDs, 'state' AS source FROM ckpt
  UNION ALL SELECT 'log only', part, ids, 'offset_log' FROM (
    SELECT DISTINCT part, ids FROM entries WHERE (part, line_no) IN
      (SELECT part, max(line_no) FROM entries GROUP BY part))""")
def restart_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With state the state wins whole; before the first state is published the log decides."""
    state = merged(spark, sf_dir)
    lines = offsets.migrate_offsets(fx.offset_log(spark, sf_dir)).where("readable")
    per_partition = lines.select("line_no", F.explode("checkpoints").alias("c")).select(
        "line_no", "c.partitionId", "c.messageIDs"
    )
    log = checkpoints.merge_checkpoints(per_partition, batch="line_no")
    none = spark.createDataFrame([], state.schema)
    both = checkpoints.restart_state(state, log).withColumn("scenario", F.lit("both"))
    log_only = checkpoints.restart_state(none, log).withColumn("scenario", F.lit("log only"))
    fresh = checkpoints.restart_state(none, none).withColumn("scenario", F.lit("fresh"))
    return both.unionByName(log_only).unionByName(fresh).select(
        "scenario", "partitionId", "messageIDs", "source"
    )


@query("resume_filter_unkeyed", f"""WITH {MSG}, {HIST} {ENVELOPE_SQL}
  WHERE rgmid > (SELECT min(floor_id) FROM ckpt)""")
def resume_filter_unkeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = resume.resume_unkeyed(fx.raw_messages(spark, sf_dir), merged(spark, sf_dir))
    return scalar_envelope(m.envelope(kept))


@query("resume_filter_keyed", f"""WITH {MSG}, {HIST} {ENVELOPE_SQL} LEFT JOIN ckpt ON pkey = part
  WHERE coalesce(pkey, '') = '' OR floor_id IS NULL OR rgmid > floor_id""")
def resume_filter_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = resume.resume_keyed(fx.raw_messages(spark, sf_dir), merged(spark, sf_dir))
    return scalar_envelope(m.envelope(kept))


@query("resume_filter",
       f"WITH {MSG}, {HIST} {ENVELOPE_SQL} LEFT JOIN ckpt ON pkey = part WHERE {KEPT}")
def resume_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = resume.resume_filter(fx.raw_messages(spark, sf_dir), merged(spark, sf_dir))
    return scalar_envelope(m.envelope(kept))


@query("resume_filter_by_position",
       f"WITH {MSG}, {HIST} {ENVELOPE_SQL} LEFT JOIN ckpt ON pkey = part WHERE {KEPT}")
def resume_filter_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same restart with application ids, whose text order is not message order."""
    raw = fx.raw_messages(spark, sf_dir)
    as_app = F.transform(
        F.split("messageIDs", ","),
        lambda i: F.when(i == "", i).otherwise(
            F.concat(F.lit("app-"), F.substring_index(i, ":", -1).cast("bigint").cast("string"))
        ),
    )
    state = merged(spark, sf_dir).withColumn("messageIDs", F.array_join(as_app, ","))
    located = resume.locate_ids(state, raw, "application_message_id")
    placed = raw.withColumn("position", resume.padded("spool_seq"))
    kept = resume.resume_filter(placed, located, message_id="position")
    return scalar_envelope(m.envelope(kept))


@query("resume_filter_replay", f"WITH {MSG} {ENVELOPE_SQL}")
def resume_filter_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replay switches the restart filter off."""
    raw = fx.raw_messages(spark, sf_dir)
    return scalar_envelope(
        m.envelope(resume.resume_filter(raw, merged(spark, sf_dir), replay=True))
    )


@query("ack_ledger", f"""WITH {MSG}, newest AS (SELECT consumer, max(batch) AS newest FROM msg
  GROUP BY consumer) SELECT rgmid AS Id, CAST(consumer AS INTEGER) AS consumer, batch,
  CASE WHEN batch < newest THEN 'ACKED' ELSE 'PENDING' END AS ack FROM msg JOIN newest
  USING (consumer)""")
def ack_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = delivery.ack_ledger(planned(spark, sf_dir))
    return ledger.select(F.col("rgmid").alias("Id"), "consumer", "batch", "ack")


def redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.redeliver(planned(spark, sf_dir))


@query("redelivery_dedup", f"""WITH {MSG} SELECT rgmid AS Id, body AS text, e % 25 = 0 AS redelivered
  FROM msg""")
def redelivery_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Redelivered messages dropped by id: what is left is the log as it was."""
    once = delivery.dedup_by_id(redelivered(spark, sf_dir), "rgmid", "delivery")
    return once.select(
        F.col("rgmid").alias("Id"), F.decode(m.payload(), "UTF-8").alias("text"), "redelivered"
    )


@query("dedup_by_id", f"""WITH {MSG} SELECT corr AS Id, min(e) AS spool_seq FROM msg
  WHERE corr <> '' GROUP BY 1 UNION ALL SELECT corr, e FROM msg WHERE corr IS NULL OR corr = ''""")
def dedup_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By correlation id, which a fifth of the log has not: those are different messages."""
    log = fx.raw_messages(spark, sf_dir).withColumn("Id", F.col("correlation_id"))
    return delivery.dedup_by_id(log.unionByName(log.where("Id <> ''").withColumn(
        "spool_seq", F.col("spool_seq") + (1 << 40)
    ))).select("Id", "spool_seq")


ARRIVALS = """newest AS (SELECT consumer, max(batch) AS newest FROM msg GROUP BY consumer),
  arrivals AS (
  SELECT e * 2 AS delivery, rgmid, consumer FROM msg
  UNION ALL SELECT e * 2 + 1, rgmid, {second} FROM msg JOIN newest USING (consumer)
    WHERE batch = newest),
  lasting AS (SELECT *, coalesce(lead(delivery) OVER (PARTITION BY consumer ORDER BY delivery),
    9223372036854775807) AS until FROM arrivals),
  seen AS (SELECT *, max(until) OVER (PARTITION BY rgmid ORDER BY delivery
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest FROM lasting)
  SELECT delivery, rgmid AS Id, CAST(consumer AS INTEGER) AS consumer FROM seen
  WHERE latest IS NULL OR latest < delivery"""


def _arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redelivered(spark, sf_dir).select(
        "delivery", F.col("rgmid").alias("Id"), "consumer"
    )


@query("skip_repeat", f"WITH {MSG}, {ARRIVALS.format(second='consumer')}")
def skip_repeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.skip_repeat(_arrivals(spark, sf_dir), order="delivery")


@query("skip_repeat_any", f"WITH {MSG}, {ARRIVALS.format(second='1 - consumer')}")
def skip_repeat_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What fails at one consumer comes again at the other one."""
    arrivals = _arrivals(spark, sf_dir)
    other = F.when(F.col("delivery") % 2 == 1, 1 - F.col("consumer")).otherwise(F.col("consumer"))
    moved = arrivals.withColumn("consumer", other.cast("int"))
    return delivery.skip_repeat(moved, order="delivery")


@query("unacked", f"""WITH {MSG} SELECT rgmid AS Id, CAST(consumer AS INTEGER) AS consumer, batch
  FROM msg WHERE e % 97 = 0""")
def unacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    delivered = planned(spark, sf_dir).select(F.col("rgmid").alias("Id"), "consumer", "batch")
    return delivery.unacked(delivered, fx.acks(spark, sf_dir))


@query("consumers_by_key", f"""WITH {MSG}, draws AS (
    SELECT pkey, c, row_number() OVER (PARTITION BY pkey ORDER BY md5(pkey || '#' || CAST(c AS VARCHAR)) DESC)
      AS place
    FROM (SELECT DISTINCT pkey FROM msg WHERE pkey <> ''), (SELECT unnest(range(5)) AS c))
  SELECT rgmid AS Id, CAST(coalesce(c, e % 5) AS INTEGER) AS consumer
  FROM msg LEFT JOIN draws ON draws.pkey = msg.pkey AND place = 1""")
def consumers_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five consumers, each with its own partition keys; messages without a key in turn."""
    dealt = batching.assign_by_key(fx.raw_messages(spark, sf_dir), 5)
    return dealt.select(F.col("rgmid").alias("Id"), "consumer")
