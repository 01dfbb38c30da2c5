import os
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidelog import QueueReader, QueueWriter
from tidelog.functions import messages as m
from tidelog.operators import batching, delivery
from tidelog.schema import RAW_MESSAGE
from tidelog.session import workspace
from tidelog.sinks.publish import Publisher, read_rejects
from tidelog.sources.spool import open_queue, read_queue, stream_raw
from tidelog.streaming import jobs as p
from tidelog.streaming.batches import read_batches

def store(raw, path, start=0, stop=10**9, files=1):
    """Append the messages from one position to before another, in so many files."""
    inside = raw.where((F.col("spool_seq") >= start) & (F.col("spool_seq") < stop))
    inside.repartitionByRange(files, "spool_seq").write.mode("append").parquet(path)


@pytest.fixture(scope="module")
def spool(spark, hundred):
    path = workspace(spark, "spool")
    store(hundred, path, files=3)
    return path


def seqs(df):
    return sorted(r.spool_seq for r in df.select("spool_seq").collect())


def test_files_of_any_age_are_read(spark, hundred):
    path, out, checkpoint = (workspace(spark, n) for n in ("old", "out", "cp"))
    for i, days in enumerate((0, 30)):
        half = hundred.where(F.expr(f"spool_seq div 50 = {i}"))
        before = set(Path(path).glob("*.parquet")) if i else set()
        half.coalesce(1).write.mode("append").parquet(path)
        for file in set(Path(path).glob("*.parquet")) - before:
            when = time.time() - days * 86_400
            os.utime(file, (when, when))
        p.run_available(p.land_parquet(stream_raw(spark, path, 1, 50), out, checkpoint))
    assert seqs(spark.read.parquet(out)) == list(range(100))


def test_another_folder_is_refused(spark, hundred):
    path = workspace(spark, "other")
    hundred.select("spool_seq", F.col("rgmid").alias("Id")).write.parquet(path)
    for load in ("load", "loadBatch"):
        with pytest.raises(ValueError, match="not a message log"):
            getattr(QueueReader(spark).options(queue=path), load)()


def test_dedup_stream_keeps_late_first_deliveries(spark, hundred):
    path, out = workspace(spark, "late"), workspace(spark, "out")
    for i in (3, 2, 1, 0, 3, 1):  # time runs backwards, and two blocks come again
        block = hundred.where(F.expr(f"spool_seq div 25 = {i}")).withColumn(
            "sender_ts", F.expr(f"sender_ts + interval {40 * i} days"))
        none = F.when(F.col("spool_seq") % 25 != 7, F.col("correlation_id"))
        block.withColumn("correlation_id", none).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    stream = open_queue(spark, path, 1, 25, offset_indicator="CORRELATION_ID", strict=False,
                        keep=("spool_seq",))
    p.run_available(p.land_parquet(delivery.dedup_stream(stream), out, workspace(spark, "cp")))
    assert seqs(spark.read.parquet(out)) == sorted([*range(100), 82, 32])


@pytest.mark.parametrize(("options", "sizes"), [
    ({"partitions": 2, "batch_size": 25}, [50, 50]),
    ({"partitions": 1, "batch_size": 25}, [25] * 4),
    ({"partitions": 3, "batch_size": 25}, [75, 25]),
    ({"partitions": 1, "batch_size": 0}, [100]),
])
def test_batches_are_bounded(spark, spool, options, sizes):
    out = workspace(spark, "counts")
    stream = open_queue(spark, spool, **options)
    p.run_available(p.count_batches(stream, out, workspace(spark, "cp")))
    got = spark.read.parquet(out).orderBy("batch_id").collect()
    assert [r.messages for r in got] == sizes


def test_batches_come_in_message_order(spark, spool):
    out = workspace(spark, "order")
    stream = stream_raw(spark, spool, 2, 25)
    p.run_available(p.update_as_append(stream.select("spool_seq"), out, workspace(spark, "cp")))
    spans = spark.read.parquet(out).groupBy("batch_id").agg(
        F.min("spool_seq"), F.max("spool_seq")).orderBy("batch_id").collect()
    assert [tuple(r) for r in spans] == [(0, 0, 49), (1, 50, 99)]


def test_same_checkpoint_starts_no_batch_until_messages_come(spark, hundred):
    path, out, checkpoint = (workspace(spark, n) for n in ("spool", "out", "cp"))
    store(hundred, path, 0, 50)

    def run():
        stream = open_queue(spark, path, partitions=2, batch_size=25, keep=("spool_seq",))
        p.run_available(p.land_parquet(stream, out, checkpoint))
        return seqs(spark.read.parquet(out))

    assert run() == run() == list(range(50))
    store(hundred, path, 50, 100)
    assert run() == list(range(100))


def dealt(spark, path, **options):
    stream = open_queue(spark, path, partitions=1, batch_size=25, keep=("spool_seq",), **options)
    return batching.assign_consumer(stream, 2)


def test_lost_checkpoint_recovers_from_published_state(spark, hundred):
    """Three quarters of the log, the stream's own checkpoint is lost, then the rest."""
    path, rows, state = (workspace(spark, n) for n in ("spool", "rows", "state"))
    store(hundred, path, 0, 75)
    stream = dealt(spark, path)
    p.run_available(p.commit_publish(stream, rows, state, workspace(spark, "cp")))
    committed = p.committed_state(spark, state)
    assert sorted((r.partitionId, r.messageIDs[-2:]) for r in committed.collect()) == [
        ("0", "74"), ("1", "73")]
    store(hundred, path, 75, 100)
    left = QueueReader(spark).options(
        queue=path, ackLastProcessedMessages="true", state=state, host="tcp://unused"
    ).loadBatch()
    assert left.count() == 26
    again = dealt(spark, path, checkpoints=committed)
    p.run_available(p.commit_publish(again, rows, state, workspace(spark, "cp")))
    # The new stream counts from batch 0 as a query of its own. The unkeyed rule keeps what is after
    # the lowest checkpoint, so 74 comes a second time.
    written = read_batches(spark, rows, stream.schema)
    queries = [r[0] for r in written.groupBy("query").count().orderBy("count").select("query").collect()]
    assert seqs(written.where(F.col("query") == queries[1])) == list(range(75))
    assert seqs(written.where(F.col("query") == queries[0])) == list(range(74, 100))
    latest = p.committed_state(spark, state).collect()
    assert sorted((r.partitionId, r.messageIDs[-2:]) for r in latest) == [("0", "98"), ("1", "99")]


def test_late_repeats_are_dropped(spark, hundred):
    path, out = workspace(spark, "spool"), workspace(spark, "out")
    hot = hundred.withColumn(
        "rgmid", F.when(F.col("spool_seq") % 3 == 0, "hot").otherwise(F.col("rgmid")))
    store(hot, path)
    stream = open_queue(spark, path, partitions=1, batch_size=25, keep=("spool_seq",))
    twice = stream.withColumn("attempt", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn(
        "delivery", F.col("spool_seq") * 2 + F.col("attempt"))
    p.run_available(p.dedup_append(twice, out, workspace(spark, "cp")))
    got = read_batches(spark, out, twice.schema).collect()
    want = [0] + [i for i in range(100) if i % 3]
    assert sorted(r.delivery for r in got) == [2 * i for i in want]


def test_batches_without_rows_keep_the_state(spark, hundred):
    path, rows, state = (workspace(spark, n) for n in ("spool", "rows", "state"))
    store(hundred, path)
    few = dealt(spark, path).where("spool_seq < 30")
    p.run_available(p.commit_publish(few, rows, state, workspace(spark, "cp")))
    committed = p.committed_state(spark, state).collect()
    assert sorted(r.messageIDs[-2:] for r in committed) == ["28", "29"]


def test_files_that_were_written_out_of_order_are_read_in_order(spark, hundred):
    path, rows, state = (workspace(spark, n) for n in ("spool", "rows", "state"))
    for start in (50, 25, 75, 0):
        store(hundred, path, start, start + 25)
    p.run_available(p.commit_publish(dealt(spark, path), rows, state, workspace(spark, "cp")))
    committed = p.committed_state(spark, state).collect()
    assert sorted(r.messageIDs[-2:] for r in committed) == ["98", "99"]


def test_positions_that_a_stream_has_passed_fail_it(spark, hundred):
    path, out = workspace(spark, "spool"), workspace(spark, "out")
    store(hundred, path, 50, 100)
    query = p.land_parquet(stream_raw(spark, path, 1, 25), out, workspace(spark, "cp")).start()
    try:
        query.processAllAvailable()
        store(hundred, path, 0, 25)
        with pytest.raises(Exception, match="holds position 0, but the stream is at 100"):
            query.processAllAvailable()
    finally:
        query.stop()


def test_a_failed_batch_runs_again_and_replaces_itself(spark, spool):
    out, checkpoint = workspace(spark, "out"), workspace(spark, "cp")
    stream = open_queue(spark, spool, partitions=1, batch_size=25, keep=("spool_seq",))
    failures = []

    def handle(rows, batch_id):
        rows.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        if batch_id == 2 and not failures:
            failures.append(batch_id)
            raise RuntimeError("lost")

    def writer():
        return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(handle)

    with pytest.raises(Exception, match="lost"):
        p.run_available(writer())
    p.run_available(writer())
    assert seqs(spark.read.parquet(out)) == list(range(100))


def test_foreach_batch_publish_with_rejects(spark, spool):
    out = workspace(spark, "published")
    stream = open_queue(spark, spool, partitions=2, batch_size=25, keep=("spool_seq",))
    faulty = stream.withColumn("Topic", F.when(F.col("spool_seq") % 10 != 0, F.col("Topic")))
    p.run_available(p.foreach_batch_publish(
        faulty, out, workspace(spark, "cp"), Publisher(mode="report")))
    assert read_queue(spark, out).count() == 90
    assert read_rejects(spark, out).groupBy("reason").count().collect() == [("Topic is null", 10)]


@pytest.mark.parametrize(("mode", "sizes"), [("update", [3, 3, 3, 3]), ("complete", [3, 6, 9, 12])])
def test_changed_or_whole_results_are_appended(spark, hundred, mode, sizes):
    path, out = workspace(spark, "spool"), workspace(spark, "out")
    store(hundred, path)
    key = (F.expr("spool_seq div 25") * 3 + F.col("spool_seq") % 3).alias("key")
    totals = stream_raw(spark, path, 1, 25).groupBy(key).agg(F.count("*").alias("n"))
    p.run_available(p.update_as_append(totals, out, workspace(spark, "cp"), mode))
    counts = read_batches(spark, out, totals.schema).groupBy("batch_id").count().collect()
    assert [r["count"] for r in sorted(counts)] == sizes
    newest = p.read_updates(spark, out, totals.schema, ["key"])
    assert newest.agg(F.count("*"), F.sum("n")).first() == (12, 100)


def test_last_value_stream_and_empty_state(spark, hundred):
    path, checkpoint, keys = workspace(spark, "spool"), workspace(spark, "cp"), ["destination"]
    assert p.read_last_value(spark, checkpoint, RAW_MESSAGE, keys).count() == 0
    topic = F.when(F.col("spool_seq") % 7 != 3, F.concat(F.lit("t"), F.col("spool_seq") % 7))
    store(hundred.withColumn("destination", topic), path, 0, 60)
    for stop, want in ((60, range(53, 60)), (100, range(93, 100))):
        store(hundred.withColumn("destination", topic), path, 60, stop)
        p.run_available(p.last_value_stream(stream_raw(spark, path, 1, 25), checkpoint, keys))
        newest = p.read_last_value(spark, checkpoint, RAW_MESSAGE, keys)
        assert seqs(newest) == list(want) and newest.schema.names == RAW_MESSAGE.names
        flat = [F.to_json("user_props").alias("user_props") if c == "user_props" else c for c in newest.columns]
        whole = read_queue(spark, path).where(F.col("spool_seq").isin(list(want)))
        assert sorted(map(repr, newest.select(flat).collect())) == sorted(map(repr, whole.select(flat).collect()))


def test_batches_leave_no_staged_tables(spark, hundred):
    path, rows, state, checkpoint = (workspace(spark, n) for n in ("spool", "rows", "state", "cp"))
    store(hundred, path)
    base = Path(path).parent
    before = set(os.listdir(base))
    stream = dealt(spark, path)
    p.run_available(p.commit_publish(stream, rows, state, checkpoint))
    left = {n.rsplit("-", 1)[0] for n in set(os.listdir(base)) - before}
    assert left <= {"rows", "state", "cp"}


def test_state_is_published_once_however_often_a_batch_runs(spark, hundred, monkeypatch):
    """The rows of a batch are written, then its state fails, then the stream is started again."""
    path, rows, state, checkpoint = (workspace(spark, n) for n in ("spool", "rows", "state", "cp"))
    store(hundred, path)
    real, calls = p.publish, []

    def flaky(*args, **options):
        calls.append(options["batch"])
        got = real(*args, **options)
        if len(calls) in (2, 4):  # once published, once more before the batch is noted as done
            raise RuntimeError("lost")
        return got

    monkeypatch.setattr(p, "publish", flaky)
    stream = dealt(spark, path)
    for _ in range(2):
        with pytest.raises(Exception, match="lost"):
            p.run_available(p.commit_publish(stream, rows, state, checkpoint))
    p.run_available(p.commit_publish(stream, rows, state, checkpoint))
    assert calls == [0, 1, 1, 2, 2, 3]
    assert read_queue(spark, state).count() == 8
    assert seqs(read_batches(spark, rows, stream.schema)) == list(range(100))
    got = p.committed_state(spark, state).collect()
    assert sorted((r.partitionId, r.messageIDs[-2:]) for r in got) == [("0", "98"), ("1", "99")]


def test_reader_by_options(spark, spool, hundred):
    reader = QueueReader(spark).option("queue", spool).options(
        partitions="2", batchSize="25", includeHeaders="true", offsetIndicator="CORRELATION_ID")
    out = workspace(spark, "out")
    stream = reader.load()
    assert stream.isStreaming
    p.run_available(p.land_parquet(stream, out, workspace(spark, "cp")))
    same = spark.read.parquet(out)
    columns = ["Id", "Topic", "PartitionKey", "TimeStamp", m.payload_text().alias("t")]
    assert sorted(same.select(columns).collect()) == sorted(
        reader.loadBatch().select(columns).collect())
    assert "Headers" in same.columns


def test_reader_replay_and_resume_by_options(spark, spool):
    base = {"queue": spool}
    after = {"replayStrategy": "REPLICATION-GROUP-MESSAGE-ID",
             "replayReplicationGroupMessageId": "rmid1:" + "50".zfill(18)}
    since = {"replayStrategy": "TIMEBASED", "replayStartTime": "2024-03-01T09:00:51",
             "replayStartTimeTimezone": "Asia/Tokyo"}
    state = spark.createDataFrame([("c-0", "rmid1:" + "29".zfill(18))], "partitionId string, messageIDs string")
    resume = {"ackLastProcessedMessages": "true", "state": state}
    counts = {49: after, 50: since, 70: resume, 100: {"replayStrategy": "BEGINNING", **resume}}
    for want, options in counts.items():
        assert QueueReader(spark).options(**base, **options).loadBatch().count() == want


def test_resume_with_another_indicator_compares_positions(spark, spool):
    state = spark.createDataFrame([("c-0", "app-29")], "partitionId string, messageIDs string")
    options = {"queue": spool, "offsetIndicator": "APPLICATION_MESSAGE_ID",
               "ackLastProcessedMessages": "true", "state": state}
    ids = QueueReader(spark).options(**options).loadBatch().select("Id").collect()
    assert sorted(r.Id for r in ids) == sorted(f"app-{i}" for i in range(30, 100))
    out = workspace(spark, "out")
    stream = QueueReader(spark).options(**options).load()
    p.run_available(p.land_parquet(stream, out, workspace(spark, "cp")))
    assert spark.read.parquet(out).count() == 70


@pytest.mark.parametrize("options", [
    {},
    {"queue": ""},
    {"queue": "q", "batchSize": "-1"},
    {"queue": "q", "partitions": "-1"},
    {"queue": "q", "batchSize": "many"},
    {"queue": "q", "replayStrategy": "NEVER"},
    {"queue": "q", "replayStrategy": "TIMEBASED"},
    {"queue": "q", "replayStrategy": "REPLICATION-GROUP-MESSAGE-ID"},
    {"queue": "q", "ackLastProcessedMessages": "true"},
    {"queue": "q", "surprise": "1"},
    {"queue": "q", "lvq.names": "1"},
])
def test_bad_reader_options_are_refused(spark, options):
    for load in ("load", "loadBatch"):
        with pytest.raises(ValueError):
            getattr(QueueReader(spark).options(**options), load)()


def test_options_of_existing_jobs_are_accepted(spark, spool):
    given = {
        "queue": spool, "host": "tcp://x", "checkpointLocation": "/cp", "lvq.topic": "t",
        "lvq.name": workspace(spark, "state"), "broker.oauth.client.auth-server-url": "u",
        "broker.apiProperties.sub_ack_window_size": "50", "batchSize": "25",
    }
    assert QueueReader(spark).options(**given).loadBatch().count() == 100


def test_writer_by_options(spark, spool, hundred):
    env = m.envelope(hundred).drop("Id")
    out = workspace(spark, "out")
    QueueWriter(env).options(queue=out, topic="t", id="i").save()
    got = spark.read.parquet(out).select("destination", "correlation_id").distinct().collect()
    assert got == [("t", "i")]
    with pytest.raises(ValueError, match="Id"):
        QueueWriter(env).options(queue=out).save()
    with pytest.raises(ValueError, match="queue"):
        QueueWriter(env).save()


def test_stream_writer_by_options(spark, spool):
    stream = open_queue(spark, spool, partitions=2, batch_size=25, include_headers=True)
    out = workspace(spark, "out")
    with pytest.raises(ValueError, match="checkpointLocation"):
        QueueWriter(stream).options(queue=out).writeStream()
    p.run_available(QueueWriter(stream).options(
        queue=out, topic="second", includeHeaders="true", checkpointLocation=workspace(spark, "cp"),
    ).writeStream())
    back = read_queue(spark, out)
    assert back.select("rgmid").distinct().count() == 100
    assert m.envelope(back).groupBy("Topic").count().collect() == [("second", 100)]
    assert back.select("priority").distinct().collect() == [(1,)]


def test_workspace_is_new_and_shared(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = workspace(spark, "x"), workspace(spark, "x")
    assert one != two and one.startswith(base)
