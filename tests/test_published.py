"""Positions of published logs, bounded reads of any log, and what a failed publish leaves."""

import os
import threading
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import frame, message
from tidelog import QueueReader, QueueWriter
from tidelog.functions import messages as m
from tidelog.operators import batching, checkpoints
from tidelog.plans import fixtures as fx
from tidelog.session import workspace
from tidelog.sinks.publish import Publisher, publish, publish_counts, publish_stream, read_rejects
from tidelog.sources import logfiles
from tidelog.sources.datasource import FORMAT, register
from tidelog.sources.spool import open_queue, position_of, read_queue, stream_raw
from tidelog.streaming import jobs as p

SMALL = "/root/testdata/sf0.001"


def local(path):
    return Path(path.removeprefix("file:"))


def places(spark, path):
    rows = read_queue(spark, path).select("spool_seq", "rgmid").collect()
    assert all(r.rgmid == f"rmid1:{r.spool_seq:019d}" for r in rows)
    return sorted(r.spool_seq for r in rows)


@pytest.fixture(scope="module")
def events(spark):
    path = workspace(spark, "events")
    fx.raw_messages(spark, SMALL).write.parquet(path)
    return path


@pytest.fixture(scope="module")
def sent(spark, events):
    """1,000 events over five topics, published as a stream of ten micro-batches."""
    out = workspace(spark, "sent")
    stream = open_queue(spark, events, partitions=2, batch_size=50)
    QueueWriter(stream)  # the options form is tested elsewhere
    p.run_available(publish_stream(stream, out, workspace(spark, "cp")))
    return out


def test_a_published_stream_has_positions_of_its_own(spark, sent):
    assert places(spark, sent) == list(range(1000))
    last = checkpoints.last_value(read_queue(spark, sent)).collect()
    assert len(last) == len({r.destination for r in last}) == 5
    dealt = batching.assign_consumer(read_queue(spark, sent), 4).groupBy("consumer").count()
    assert sorted(map(tuple, dealt.collect())) == [(i, 250) for i in range(4)]


def test_a_restart_on_a_published_log_delivers_nothing_twice(spark, sent):
    rows, state = workspace(spark, "rows"), workspace(spark, "state")
    stream = open_queue(spark, sent, partitions=1, batch_size=100, keep=("spool_seq",))
    one = stream.withColumn("consumer", F.lit("c-0")).withColumn("PartitionKey", F.lit(""))
    p.run_available(p.commit_publish(one, rows, state, workspace(spark, "cp")))
    left = QueueReader(spark).options(
        queue=sent, ackLastProcessedMessages="true", state=state).loadBatch()
    # Messages with a partition key ask for a checkpoint of their own key, and there is none.
    assert left.where("PartitionKey = ''").count() == 0


def test_every_batch_publisher_goes_on_where_the_last_ended(spark, events):
    out = workspace(spark, "out")
    stream = open_queue(spark, events, partitions=1, batch_size=100)
    p.run_available(p.foreach_batch_publish(stream, out, workspace(spark, "cp")))
    assert places(spark, out) == list(range(1000))
    counts = publish_counts(spark, out).orderBy("batch").collect()
    assert [(r.batch, r.first_position, r.published) for r in counts] == [
        (i, 100 * i, 100) for i in range(10)]
    assert len({r.writer for r in counts}) == 1


def test_streams_and_jobs_share_a_log_over_restarts(spark, events, hundred):
    out, checkpoint = workspace(spark, "out"), workspace(spark, "cp")
    for stop in (400, 1000):
        part = workspace(spark, "part") if stop == 400 else part
        rows = spark.read.parquet(events).where(
            (F.col("spool_seq") < stop) & (F.col("spool_seq") >= stop - 600))
        rows.write.mode("append").parquet(part)
        stream = open_queue(spark, part, partitions=2, batch_size=70)
        p.run_available(publish_stream(stream, out, checkpoint))
        publish(m.envelope(hundred), out)
    assert places(spark, out) == list(range(1200))


def test_a_batch_that_runs_again_adds_nothing(spark, hundred):
    out, rows = workspace(spark, "out"), m.envelope(hundred)
    for batch in (0, 1, 1, 0, 2):
        publish(rows, out, writer="stream-a", batch=batch)
    publish(rows, out, writer="stream-b", batch=0)
    assert places(spark, out) == list(range(400))
    assert not list(local(out).glob("_staging/*"))


@pytest.mark.parametrize("lost", ["note", "behind", "staging"])
def test_a_writer_that_died_at_any_point_leaves_a_log_that_goes_on(spark, hundred, lost):
    out, rows = workspace(spark, "out"), m.envelope(hundred)
    publish(rows, out, writer="w", batch=0)
    note = local(out) / "_next.json"
    old = note.read_text()
    publish(rows, out, writer="w", batch=1)
    if lost == "note":
        note.unlink()
    elif lost == "behind":  # the commit is there, the note was not written any more
        note.write_text(old)
    else:
        (local(out) / "_staging" / "dead-0").mkdir()
        (local(out) / "_staging" / "dead-0" / "x.parquet").write_bytes(b"half")
    publish(rows, out, writer="w", batch=1)
    assert places(spark, out) == list(range(200))
    publish(rows, out, writer="w", batch=2)
    assert places(spark, out) == list(range(300))


def test_writers_at_the_same_time_share_no_position(tmp_path):
    """Eight writers reach for the same places; every commit gets some of its own."""
    root, got, errors = str(tmp_path / "log"), [], []

    def run(writer):
        try:
            for batch in range(5):
                staged = f"{root}/_staging/{writer}-{batch}"
                os.makedirs(staged)
                files = []
                for i in range(2):
                    table = pa.table({"status": ["OK"] * (writer + i + 1)})
                    pq.write_table(table, f"{staged}/{i}.parquet")
                    files.append(logfiles.Staged(f"{i}.parquet", table.num_rows, 0))
                got.append(logfiles.commit(root, staged, files, f"w{writer}", batch))
        except Exception as e:  # shown by the main thread
            errors.append(e)

    threads = [threading.Thread(target=run, args=(i,)) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and len(set(got)) == 40
    log = logfiles.Log(root)
    log.refresh()
    units = log.units
    assert sum(u.rows for u in units) == sum(5 * (2 * w + 3) for w in range(8)) == log.end()
    assert all(a.high + 1 == b.low for a, b in zip(units, units[1:], strict=False)) and units[0].low == 0


def test_strict_publishing_names_all_bad_rows_and_leaves_nothing(spark, hundred):
    out, rows = workspace(spark, "out"), m.envelope(hundred, keep=("spool_seq",))
    publish(rows, out)
    bad = rows.repartition(4).withColumn("Topic", F.when(F.col("spool_seq") % 10 != 3, F.col("Topic")))
    with pytest.raises(Exception, match="10 rows cannot be published") as e:
        publish(bad, out)
    assert all(f"rmid1:{i:018d}: Topic is null" in str(e.value) for i in range(3, 100, 10))
    assert places(spark, out) == list(range(100)) and not list(local(out).glob("_staging/*"))
    assert read_rejects(spark, out).count() == 0


def test_a_strict_stream_stops_before_the_bad_batch_and_goes_on_when_mended(spark, hundred):
    log, out, checkpoint = (workspace(spark, n) for n in ("log", "out", "cp"))
    hundred.write.parquet(log)

    def run(bad):
        stream = open_queue(spark, log, partitions=1, batch_size=25, keep=("spool_seq",))
        topic = F.when(~F.col("spool_seq").isin(bad), F.col("Topic"))
        p.run_available(publish_stream(stream.withColumn("Topic", topic), out, checkpoint))

    with pytest.raises(Exception, match="2 rows cannot be published") as e:
        run([60, 70])
    assert "rmid1:000000000000000060" in str(e.value) and "rmid1:000000000000000070" in str(e.value)
    assert places(spark, out) == list(range(50))
    run([-1])
    assert places(spark, out) == list(range(100))


def test_a_log_with_positions_of_its_own_takes_no_commits(spark, hundred):
    path = workspace(spark, "foreign")
    hundred.write.parquet(path)
    with pytest.raises(Exception, match="positions of their own"):
        publish(m.envelope(hundred), path)
    assert read_queue(spark, path).count() == 100


def test_a_table_that_is_no_message_is_refused(spark):
    register(spark)
    with pytest.raises(Exception, match="rows that a Publisher made"):
        spark.range(3).write.format(FORMAT).mode("append").option("path", workspace(spark, "x")).save()


@pytest.mark.parametrize("published", [True, False])
def test_by_format_name(spark, sent, events, published):
    register(spark)
    path = sent if published else events
    batch = spark.read.format("tidelog").option("path", path).load()
    assert sorted(r.spool_seq for r in batch.select("spool_seq").collect()) == list(range(1000))
    stream = spark.readStream.format("tidelog").options(
        path=path, batchSize=300, columns="spool_seq,destination").load()
    assert stream.columns == ["spool_seq", "destination"]
    out = workspace(spark, "out")
    p.run_available(p.land_parquet(stream, out, workspace(spark, "cp")))
    assert spark.read.parquet(out).count() == 1000
    for bad in ({}, {"path": path, "columns": "nothing"}, {"path": path, "partitions": "0"}):
        with pytest.raises(Exception, match="option path|no columns nothing|partitions above 0"):
            broken = spark.readStream.format("tidelog").options(**bad).load()
            p.run_available(p.land_parquet(broken, workspace(spark, "o"), workspace(spark, "cp")))


def test_stream_and_table_give_the_same_messages(spark, sent, events):
    for path in (sent, events):
        out = workspace(spark, "out")
        p.run_available(p.land_parquet(stream_raw(spark, path, 3, 70), out, workspace(spark, "cp")))
        flat = [F.to_json("user_props").alias("user_props") if c == "user_props" else c
                for c in read_queue(spark, path).columns]
        got, want = (sorted(map(repr, f.select(flat).collect()))
                     for f in (spark.read.parquet(out), read_queue(spark, path)))
        assert got == want and len(got) == 1000


def test_reading_after_a_position_opens_no_earlier_file(spark, hundred):
    out = workspace(spark, "out")
    for _ in range(4):
        publish(m.envelope(hundred), out)
    for file in local(out).glob("commit=0000000000000000100/*.parquet"):
        file.write_bytes(b"not a file")
    last = read_queue(spark, out, after=249)
    assert sorted(r.spool_seq for r in last.select("spool_seq").collect()) == list(range(250, 400))
    options = {"queue": out, "replayStrategy": "REPLICATION-GROUP-MESSAGE-ID",
               "replayReplicationGroupMessageId": f"rmid1:{249:019d}", "batchSize": "40"}
    assert QueueReader(spark).options(**options).loadBatch().count() == 150
    landed = workspace(spark, "landed")
    stream = QueueReader(spark).options(**options).load()
    p.run_available(p.land_parquet(stream, landed, workspace(spark, "cp")))
    assert spark.read.parquet(landed).count() == 150


def test_ids_of_other_logs_are_no_positions():
    assert position_of("rmid1:" + "7".zfill(19)) == 7
    for other in (None, "", "rmid1:7", "app-7", "rmid2:" + "7".zfill(19), "rmid1:" + "x".zfill(19)):
        assert position_of(other) is None


def test_batches_are_exact_on_one_long_file(spark, hundred):
    path, sizes = workspace(spark, "log"), []
    rows = [message(3 * i + i % 2) for i in range(500)]  # positions with gaps
    frame(spark, rows).coalesce(1).write.parquet(path)
    stream = stream_raw(spark, path, 4, 30)

    def note(batch, _):
        parts = batch.select(F.spark_partition_id().alias("part")).groupBy("part").count().collect()
        sizes.append(sorted(r["count"] for r in parts))

    p.run_available(stream.writeStream.option(
        "checkpointLocation", workspace(spark, "cp")).foreachBatch(note))
    assert sizes == [[30] * 4] * 4 + [[20]]


positions = st.lists(st.lists(st.integers(0, 60), min_size=1, max_size=25, unique=True),
                     min_size=1, max_size=4)


@settings(max_examples=60, deadline=None)
@given(files=positions, size=st.integers(1, 9), consumers=st.integers(1, 4), start=st.integers(0, 50),
       groups=st.integers(1, 10))
def test_cuts_and_slices_against_plain_lists(tmp_path_factory, files, size, consumers, start, groups):
    """Files in any order, with gaps, overlaps and repeated positions."""
    folder = tmp_path_factory.mktemp("log")
    for i, file in enumerate(files):
        table = pa.table({"spool_seq": pa.array(file, pa.int64()), "destination": ["d"] * len(file)})
        pq.write_table(table, folder / f"{i}.parquet", row_group_size=groups)
    log = logfiles.Log(str(folder))
    log.refresh()
    left = sorted(x for f in files for x in f if x >= start)
    seen, at = [], start
    while cuts := log.cuts(at, size, consumers):
        assert len(cuts) <= consumers and cuts == sorted(set(cuts))
        for low, high in zip([at, *cuts], cuts, strict=False):
            part = [x for b in logfiles.read_between(str(folder), log.between(low, high), low, high, ["spool_seq"])
                    for x in b.column("spool_seq").to_pylist()]
            assert sorted(part) == [x for x in left if low <= x < high]
            if len(set(left)) == len(left):
                assert len(part) == min(size, sum(x >= low for x in left))
            seen += part
        at = cuts[-1]
    assert sorted(seen) == left


def test_a_gap_between_files_is_no_end(spark):
    """Positions far apart, read by positions held in one column only."""
    log = logfiles.Log("/nowhere")
    log._known = {"a": [logfiles.Unit("a", None, 10, 0, 9)], "b": [logfiles.Unit("b", None, 10, 10**12, 10**12 + 9)]}
    assert log.cuts(0, 4, 3) == [4, 8, 10**12 + 2]
    assert log.end() == 10**12 + 10 and log.cuts(10**12 + 10, 4, 3) == []
    assert np.array_equal([u.path for u in log.between(9, 10**12)], ["a"])


def test_hidden_files_are_no_messages(tmp_path):
    for name in ("_staging/x/1.parquet", ".tmp.parquet", "a/_part.parquet", "x.crc"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"junk")
    log = logfiles.Log(str(tmp_path))
    assert log.refresh() == [] and log.end() == 0 and os.listdir(tmp_path)
