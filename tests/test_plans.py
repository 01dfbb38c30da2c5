"""What the plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from tidelog.functions import messages as m
from tidelog.operators import batching, checkpoints, delivery, replay, resume
from tidelog.plans import QUERIES
from tidelog.plans import fixtures as fx
from tidelog.session import stage, workspace
from tidelog.sources.spool import read_queue

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return plan(df).count("Exchange hashpartitioning")


@pytest.fixture(scope="module")
def log(spark):
    raw = fx.raw_messages(spark, SMALL)
    path = workspace(spark, "spool")
    raw.write.parquet(path)
    return read_queue(spark, path)


STREAMS = ("tidelog.plans.streams", "tidelog.plans.published")
TABLE_QUERIES = [n for n, q in sorted(QUERIES.items()) if q.__module__ not in STREAMS]


@pytest.mark.parametrize("name", TABLE_QUERIES)
def test_no_cross_join_and_no_python_in_any_query(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    for bad in ("CartesianProduct", "NestedLoopJoin", "Python", "InPandas"):
        assert bad not in text


def test_replay_bounds_reach_the_scan(log):
    by_time = plan(replay.replay_from_time(log, "2024-01-02T00:00:00", "UTC"))
    assert "GreaterThanOrEqual(receive_ts" in by_time
    by_id = plan(replay.replay_after_id(log, "rmid1:000000000000000499"))
    assert "GreaterThan(rgmid" in by_id
    by_place = plan(replay.replay_after_position_of(log, "app-499", "application_message_id"))
    assert "GreaterThan(spool_seq,499)" in by_place


def test_unused_columns_are_not_read(log):
    text = plan(m.envelope(log, include_headers=True).groupBy("Topic").count())
    assert "ReadSchema: struct<destination:string,status:string>" in text


def test_projections_and_dense_batches_do_not_shuffle(log):
    assert "Exchange" not in plan(m.envelope(log, include_headers=True))
    assert "Exchange" not in plan(batching.plan_batches(log, 4, 50))


def test_unkeyed_restart_is_a_pushed_filter(spark, log):
    state = spark.createDataFrame(
        [("c-0", "rmid1:000000000000000300")], "partitionId string, messageIDs string")
    text = plan(resume.resume_unkeyed(log, state))
    assert "GreaterThan(rgmid,rmid1:000000000000000300)" in text
    assert "Exchange" not in text


def test_last_value_reads_the_tail_and_moves_no_payload(log):
    text = plan(checkpoints.last_value(log))
    assert "GreaterThanOrEqual(spool_seq,ScalarSubquery" in text
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_dedup_moves_payload_only_beyond_the_bound(spark, log):
    doubled = log.unionByName(log.withColumn("spool_seq", F.col("spool_seq") + 10_000))
    assert shuffles(delivery.dedup_by_id(doubled, "rgmid")) == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        beyond = delivery.dedup_by_id(doubled, "rgmid", max_bytes=0)
        assert "BroadcastHashJoin" not in plan(beyond)
        assert beyond.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_numbering_shuffles_the_rows_once(spark, log):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = stage(log.select("spool_seq", F.col("destination").alias("consumer"), "rgmid"), "r")
        text = plan(batching.plan_batches_sparse(rows, 50))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    window = text.index("Window [row_number()")
    join = text.index("SortMergeJoin", window)
    assert "Exchange" not in text[window:join]
