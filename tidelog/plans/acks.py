"""Queries over acknowledgements: interval sets, and messages whose acknowledgement never came."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions import messages as m
from tidelog.operators import delivery
from tidelog.operators.intervals import intervals_of, merge_intervals, outside_intervals
from tidelog.plans import fixtures as fx
from tidelog.plans.oracle import MSG
from tidelog.plans.registry import query
from tidelog.plans.streams import BATCH_SIZE, FILE_ROWS, PARTITIONS, landed, opened
from tidelog.schema import RAW_MESSAGE
from tidelog.session import workspace
from tidelog.sources.spool import stream_raw

# Out of order: every 97th message is never acknowledged, and eleven of every thousand are open.
ACKED = "e % 97 <> 0 AND e % 1000 NOT BETWEEN 300 AND 310"


def _acked(raw: DataFrame) -> DataFrame:
    return raw.where(ACKED.replace("e %", "spool_seq %"))


def _islands(rows: str, by: str = "") -> str:
    over = f"PARTITION BY {by} " if by else ""
    names = f"{by}, " if by else ""
    return f"""SELECT {names}min(e) AS first, max(e) AS last FROM (
      SELECT {names}e, e - row_number() OVER ({over}ORDER BY e) AS island FROM ({rows}))
    GROUP BY {names}island"""


@query("ack_intervals", f"WITH {MSG} {_islands(f'SELECT e FROM msg WHERE {ACKED}')}")
def ack_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals_of(_acked(fx.raw_messages(spark, sf_dir)))


@query("ack_intervals_by_topic", f"WITH {MSG} {_islands(f'SELECT topic, e FROM msg WHERE {ACKED}', 'topic')}")
def ack_intervals_by_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _acked(fx.raw_messages(spark, sf_dir)).withColumnRenamed("destination", "topic")
    return intervals_of(rows, ["topic"])


@query("ack_intervals_merged", f"WITH {MSG} {_islands(f'SELECT e FROM msg WHERE {ACKED}')}")
def ack_intervals_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three consumers acknowledge in turn; each batch's intervals are merged into those known."""
    acked = _acked(fx.raw_messages(spark, sf_dir))
    known, *more = (intervals_of(acked.where(F.pmod("spool_seq", F.lit(3)) == i)) for i in range(3))
    return merge_intervals(known, *more)


@query("resume_exact", f"""WITH {MSG} SELECT rgmid AS Id, topic AS Topic FROM msg
  WHERE NOT ({ACKED})""")
def resume_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A restart from interval sets: exactly what was not acknowledged, however late in the log."""
    raw = fx.raw_messages(spark, sf_dir)
    left = outside_intervals(raw, intervals_of(_acked(raw)))
    return m.envelope(left).select("Id", "Topic")


WITHIN, DELAY = 3600, 60


@query("unacked_stream", f"""WITH {MSG}, seen AS (
    SELECT least(max(receive_us), max(receive_us + CASE WHEN e % 89 = 0 THEN {WITHIN + 1} ELSE 2 END
      * CAST(1000000 AS BIGINT)) FILTER (e % 97 <> 0)) AS until FROM msg)
  SELECT rgmid AS Id, topic AS Topic FROM msg, seen
  WHERE (e % 97 = 0 OR e % 89 = 0)
    AND receive_us // 1000 + {WITHIN * 1000} < until // 1000 - {DELAY * 1000}""")
def unacked_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages and acknowledgements as two streams; each 89th acknowledgement comes too late.

    Acknowledgements are a log as well, in the order of their messages and read in batches of as many. So
    they keep ahead of the messages, by little: none is late whose message is not, and the join's state,
    which every batch searches, holds those of the time that is open and not of the whole log.
    """
    path, sent = workspace(spark, "acks"), F.col("receive_ts")
    late = F.when(F.pmod("spool_seq", F.lit(89)) == 0, F.lit(WITHIN + 1)).otherwise(F.lit(2)).cast("long")
    held = {
        "spool_seq": F.col("spool_seq"), "rgmid": F.col("rgmid"),
        "receive_ts": F.timestamp_micros(F.unix_micros(sent) + late * 1_000_000),
    }
    fx.raw_messages(spark, sf_dir).where(F.pmod("spool_seq", F.lit(97)) != 0).select(
        [held.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RAW_MESSAGE.fields]
    ).write.option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    acks = stream_raw(spark, path, PARTITIONS, BATCH_SIZE, ["rgmid", "receive_ts"]).select(
        F.col("rgmid").alias("Id"), F.col("receive_ts").alias("acked_at")
    )
    delivered = opened(spark, sf_dir, keep=("receive_ts",))
    missing = delivery.unacked_stream(
        delivered, acks, f"{WITHIN} seconds", f"{DELAY} seconds", sent="receive_ts",
    )
    return landed(missing.select("Id", "Topic"), large_state=True)
