"""Interval sets against plain sets, and acknowledgements as a stream."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import START, frame, message
from tidelog.functions import messages as m
from tidelog.operators.delivery import missing_acks, unacked_stream
from tidelog.operators.intervals import intervals_of, merge_intervals, outside_intervals, union_intervals
from tidelog.operators.resume import resume_unkeyed
from tidelog.session import workspace
from tidelog.sources.spool import open_queue, stream_parquet
from tidelog.streaming import jobs as p


def runs(points):
    out = []
    for x in sorted(set(points)):
        if out and out[-1][1] == x - 1:
            out[-1][1] = x
        else:
            out.append([x, x])
    return [tuple(r) for r in out]


def rows_of(df, *more):
    return sorted(tuple(r) for r in df.select(*more, "first", "last").collect())


@pytest.mark.parametrize("block", [1, 4, 7, 65_536])
def test_random_intervals_in_any_block_size(spark, block):
    rng = random.Random(block)
    pairs = [(g, a, a + rng.randint(-1, 12)) for g in ("a", "b", None) for a in
             (rng.randint(0, 150) for _ in range(20))]
    frame_ = spark.createDataFrame([*pairs, ("c", None, 4), ("c", 3, None)], "g string, first long, last long")
    want = {g: runs(x for h, a, b in pairs if h == g for x in range(a, b + 1)) for g in ("a", "b", None)}
    got = rows_of(union_intervals(frame_, ["g"], block), F.coalesce("g", F.lit("null")))
    assert got == sorted((g or "null", *r) for g, rs in want.items() for r in rs)
    every = runs(x for rs in want.values() for a, b in rs for x in range(a, b + 1))
    assert rows_of(union_intervals(frame_, block=block)) == every


@pytest.mark.parametrize("block", [3, 4096])
def test_rows_outside_intervals(spark, block):
    acked = {(g, x) for g in ("a", "b") for x in range(200) if (x // 5 + ord(g)) % 3}
    rows = spark.createDataFrame(
        [(g, x, "first") for g in ("a", "b", "none", None) for x in range(200)] + [("a", None, "x")],
        "g string, spool_seq long, first string")
    acks = spark.createDataFrame(sorted(acked), "g string, spool_seq long")
    left = outside_intervals(rows, intervals_of(acks, ["g"]), ["g"], block=block)
    got = {(r.g, r.spool_seq) for r in left.collect()}
    assert got == {(r.g, r.spool_seq) for r in rows.collect()} - acked and left.columns == rows.columns


def test_a_whole_log_is_one_interval_and_nothing_is_none(spark):
    rows = spark.range(300_000).select(F.col("id").alias("spool_seq"))
    whole = intervals_of(rows.repartition(5))
    assert rows_of(whole) == [(0, 299_999)]
    assert outside_intervals(rows, whole).count() == 0
    none = intervals_of(rows.limit(0))
    assert rows_of(none) == [] and outside_intervals(rows.limit(9), none).count() == 9
    odd = intervals_of(rows.where("spool_seq % 2 = 1"))
    assert odd.count() == 150_000
    assert rows_of(merge_intervals(odd, intervals_of(rows.where("spool_seq % 2 = 0")))) == [(0, 299_999)]


def test_a_low_watermark_delivers_again_what_intervals_do_not(spark, hundred):
    """Messages 0 to 89 acknowledged out of order, all but 10: nothing but that and the rest comes."""
    acked = hundred.where("spool_seq < 90 AND spool_seq <> 10")
    left = outside_intervals(hundred, intervals_of(acked))
    assert sorted(r.spool_seq for r in left.collect()) == [10, *range(90, 100)]
    low = spark.createDataFrame([("c-0", "rmid1:" + "9".zfill(18))], "partitionId string, messageIDs string")
    assert resume_unkeyed(hundred, low).count() == 90


def test_missing_acknowledgements_of_a_stream(spark):
    """Equal to the batch anti join for all that can no longer be acknowledged in time."""
    def at(i, seconds=0):
        return START + timedelta(seconds=60 * i + seconds)

    log = frame(spark, [message(i, receive_ts=at(i), correlation_id=None if i == 20 else f"id-{i}")
                        for i in range(200)])
    ids = [(f"id-{i}", at(i, {0: 1, 1: 900, 2: -5}.get(i % 50, 30))) for i in range(200) if i % 30 and i != 20]
    acks = spark.createDataFrame([*ids, *ids[50:60], (None, at(199))], "Id string, acked_at timestamp")
    path, side, out, checkpoint = (workspace(spark, n) for n in ("log", "acks", "out", "cp"))
    log.write.parquet(path)
    acks.repartition(2).write.parquet(side)
    stream = open_queue(spark, path, 2, 20, offset_indicator="CORRELATION_ID", strict=False,
                        keep=("receive_ts", "spool_seq"))
    missing = unacked_stream(stream, stream_parquet(spark, side), "10 minutes", "2 minutes", sent="receive_ts")
    p.run_available(p.land_parquet(missing, out, checkpoint))
    got = sorted(r.spool_seq for r in spark.read.parquet(out).collect())
    in_time = spark.createDataFrame([a for a in ids if at(0) <= a[1]], "Id string, acked_at timestamp")
    env = m.envelope(log, offset_indicator="CORRELATION_ID", strict=False, keep=("receive_ts", "spool_seq"))
    good = env.join(in_time, "Id").where(
        "acked_at >= receive_ts AND acked_at <= receive_ts + interval 10 minutes").select("Id")
    want = sorted(r.spool_seq for r in missing_acks(env, good).collect())
    assert got == [i for i in want if i < 199 - 12]
    assert {0, 20, 30, 51, 52} <= set(got)
