"""What a micro-batch costs does not grow with the session's shuffles or with the batches before it."""

from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tests.test_streams import store
from tidelog.operators import delivery
from tidelog.plans import acks, published, streams
from tidelog.session import workspace
from tidelog.sinks.publish import Publisher
from tidelog.sources import logfiles
from tidelog.sources.datasource import QueueStream
from tidelog.sources.spool import open_queue, read_queue, stream_raw
from tidelog.streaming import jobs as p

CHECKPOINT_FILES = "spark.sql.streaming.checkpointFileManagerClass"
BY_FILE_SYSTEM = (
    "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"
)


def local(path):
    return Path(path.removeprefix("file:"))


def test_state_has_a_partition_per_core_at_most(spark, hundred):
    path, checkpoint = workspace(spark, "spool"), workspace(spark, "cp")
    store(hundred, path)
    before = spark.conf.get(p.SHUFFLES)
    spark.conf.set(p.SHUFFLES, "37")
    try:
        p.run_available(p.last_value_stream(stream_raw(spark, path, 2, 25), checkpoint, ["destination"]))
        assert spark.conf.get(p.SHUFFLES) == "37"
    finally:
        spark.conf.set(p.SHUFFLES, before)
    parts = [d for d in (local(checkpoint) / "state" / "0").iterdir() if d.name.isdigit()]
    assert len(parts) == spark.sparkContext.defaultParallelism


def test_state_that_holds_the_messages_is_written_by_its_changes(spark, hundred):
    path, out, checkpoint = (workspace(spark, n) for n in ("spool", "out", "cp"))
    store(hundred, path)
    stream = open_queue(spark, path, partitions=1, batch_size=25, keep=("spool_seq",))
    twice = stream.withColumn("n", F.explode(F.array(F.lit(1), F.lit(2)))).drop("n")
    p.run_available(p.land_parquet(delivery.dedup_stream(twice), out, checkpoint), large_state=True)
    assert sorted(r.spool_seq for r in spark.read.parquet(out).collect()) == list(range(100))
    assert list((local(checkpoint) / "state").rglob("*.changelog"))


def test_a_probe_for_emptiness_reads_to_the_end(spark, hundred, monkeypatch):
    path, out = workspace(spark, "spool"), workspace(spark, "out")
    store(hundred, path)

    def stops_early(rows):
        raise AssertionError("a read that stops early ends its Python worker")

    monkeypatch.setattr(DataFrame, "isEmpty", stops_early)
    stream = open_queue(spark, path, partitions=2, batch_size=25, keep=("spool_seq",))
    p.run_available(p.probe_batches(stream, out, workspace(spark, "cp")))
    none = stream.where("spool_seq < 50")
    p.run_available(p.probe_batches(none, out, workspace(spark, "cp")))
    got = spark.read.parquet(out).select("batch_id", "empty", "first_read", "second_read").collect()
    assert sorted(map(tuple, got)) == [
        (0, False, 50, 50), (0, False, 50, 50), (1, False, 50, 50), (1, True, 0, 0)]


def test_both_halves_of_a_restarted_log_are_in_bounded_files(spark, monkeypatch):
    made = []

    def note(session, label):
        made.append(workspace(session, label))
        return made[-1]

    monkeypatch.setattr(streams, "workspace", note)
    monkeypatch.setattr(streams, "FILE_ROWS", 200)
    assert streams.restart_exactly_once(spark, "/root/testdata/sf0.001").count() == 1000
    rows = [pq.read_metadata(f).num_rows for f in local(made[0]).glob("*.parquet")]
    assert sum(rows) == 1000 and max(rows) <= 200


def commit_files(root, writer, batch, *sizes):
    staged = root / "_staging" / f"{writer}-{batch}"
    staged.mkdir(parents=True)
    files = []
    for i, n in enumerate(sizes):
        pq.write_table(pa.table({"status": ["OK"] * n}), staged / f"{i}.parquet")
        files.append(logfiles.Staged(f"{i}.parquet", n, 0))
    logfiles.commit(str(root), str(staged), files, writer, batch)


def test_a_published_log_is_listed_only_when_a_batch_needs_more(tmp_path, monkeypatch):
    root, listed = tmp_path / "log", []
    refresh = logfiles.Log.refresh
    monkeypatch.setattr(logfiles.Log, "refresh", lambda log: listed.append(1) or refresh(log))
    for batch in range(10):
        commit_files(root, "w", batch, 60, 40)
    stream = QueueStream(str(root), ["spool_seq"], 35, 2, 0)
    ends = []

    def drain():
        while (end := stream.latestOffset()["position"]) > (ends[-1] if ends else 0):
            stream.partitions({"position": ends[-1] if ends else 0}, {"position": end})
            ends.append(end)

    drain()
    assert ends == [*range(70, 1000, 70), 1000] and len(listed) <= 3
    commit_files(root, "w", 10, 100)
    drain()
    assert ends[15:] == [1070, 1100]


def positions_file(path, positions):
    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table({"spool_seq": pa.array(positions, pa.int64())}), path)


def listings(monkeypatch):
    """Notes every listing of a log, whose folders' times count at once."""
    listed, refresh = [], logfiles.Log.refresh
    monkeypatch.setattr(logfiles.Log, "refresh", lambda log: listed.append(1) or refresh(log))
    monkeypatch.setattr(logfiles, "SETTLED", 0, raising=False)
    return listed


def take(stream, ends, batches):
    for _ in range(batches):
        start, end = {"position": ends[-1] if ends else 0}, stream.latestOffset()
        stream.partitions(start, end)
        ends.append(end["position"])


def test_a_log_with_its_own_positions_is_listed_when_its_folders_changed(tmp_path, monkeypatch):
    listed, ends = listings(monkeypatch), []
    for i in range(10):
        positions_file(tmp_path / f"part={i % 2}" / f"{i}.parquet", range(i * 100, i * 100 + 100))
    stream = QueueStream(str(tmp_path), ["spool_seq"], 10, 2, 0)
    take(stream, ends, 40)
    assert ends == list(range(20, 801, 20)) and len(listed) <= 3
    # A file below one of the folders is found before the stream has passed its positions, a new folder's too.
    positions_file(tmp_path / "part=1" / "new.parquet", range(990, 1010))
    positions_file(tmp_path / "part=9" / "new.parquet", range(1010, 1030))
    take(stream, ends, 11)
    assert ends[-1] == 1010 and len(listed) <= 8
    positions_file(tmp_path / "part=0" / "late.parquet", range(500, 510))
    with pytest.raises(ValueError, match="late.parquet holds position 500"):
        take(stream, ends, 3)


def test_times_of_folders_count_only_once_they_stand(tmp_path, monkeypatch):
    clock = [100.0]
    monkeypatch.setattr(logfiles.time, "monotonic", lambda: clock[0])
    positions_file(tmp_path / "a.parquet", range(100))
    log = logfiles.Log(str(tmp_path))
    log.refresh()
    assert not log.unchanged()
    clock[0] += logfiles.SETTLED
    assert not log.unchanged()  # the last listing is as young as the folder's time
    log.refresh()
    assert log.unchanged()
    positions_file(tmp_path / "b.parquet", range(100, 200))
    assert not log.unchanged()


def test_rows_behind_the_last_wanted_are_not_decoded(tmp_path, monkeypatch):
    path = tmp_path / "a.parquet"
    positions_file(path, [*range(3999, -1, -1), *range(4000, 8000)])
    decoded, messages = [], logfiles._messages
    monkeypatch.setattr(
        logfiles, "_messages", lambda batch, *a: decoded.append(batch.num_rows) or messages(batch, *a)
    )
    unit = logfiles.Unit(str(path), 0, 8000, 0, 7999)
    for low, high, most in ((3000, 4000, 1024), (0, 1000, 4096), (4000, 4010, 5120), (8000, 9000, 0)):
        decoded.clear()
        got = logfiles.read_between(str(tmp_path), [unit], low, high, ["spool_seq"])
        seen = sorted(i for b in got for i in b.column("spool_seq").to_pylist())
        assert seen == list(range(low, min(high, 8000))) and sum(decoded) <= most


def test_counts_of_batches_are_planned_once(spark, hundred, monkeypatch):
    path, asked = workspace(spark, "spool"), []
    store(hundred, path)

    def handle(rows, batch_id):
        asked.append(rows.sparkSession.conf.get("spark.sql.adaptive.enabled"))

    def start(**options):
        stream = open_queue(spark, path, partitions=1, batch_size=100)
        p.run_available(stream.writeStream.option(
            "checkpointLocation", workspace(spark, "cp")).foreachBatch(handle), **options)

    start()
    start(adaptive=False)
    assert asked == ["true", "false"] and spark.conf.get("spark.sql.adaptive.enabled") == "true"
    options = []
    monkeypatch.setattr(p, "run_available", lambda writer, **o: options.append(o))
    streams.queue_stream_batches(spark, "/root/testdata/sf0.001")
    assert options == [{"adaptive": False}]


def test_order_of_units_follows_new_files(tmp_path):
    log = logfiles.Log(str(tmp_path))
    for name, positions in (("b", range(50, 60)), ("a", range(0, 100, 3)), ("c", range(70, 75))):
        pq.write_table(pa.table({"spool_seq": pa.array(positions, pa.int64())}), tmp_path / f"{name}.parquet")
        log.refresh()
        assert [u.low for u in log.units] == sorted(u.low for us in log._known.values() for u in us)
    assert [u.low for u in log.between(72, 73)] == [0, 70] and log.end() == 100


def test_messages_are_put_together_once_and_not_for_every_batch(spark, hundred, monkeypatch):
    path, out = workspace(spark, "spool"), workspace(spark, "published")
    store(hundred, path)
    made, log_rows = [], Publisher.log_rows
    monkeypatch.setattr(Publisher, "log_rows", lambda *a: made.append(1) or log_rows(*a))
    stream = open_queue(spark, path, partitions=1, batch_size=25, include_headers=True)
    p.run_available(p.foreach_batch_publish(stream, out, workspace(spark, "cp")))
    assert len(made) == 1 and len(list(local(out).glob("commit=*"))) == 4
    assert sorted(r.spool_seq for r in read_queue(spark, out).collect()) == list(range(100))


def test_an_unbounded_batch_has_a_task_per_span_of_rows(tmp_path, monkeypatch):
    root = tmp_path / "log"
    for batch in range(10):
        commit_files(root, "w", batch, 60, 40)
    monkeypatch.setattr(logfiles, "SPAN_ROWS", 250)
    stream = QueueStream(str(root), ["spool_seq"], 0, 1, 0)
    slices = stream.partitions({"position": 0}, stream.latestOffset())
    assert len(slices) >= 4 and max(s.high - s.low for s in slices) <= 250
    read = [stream.read(s) for s in slices]
    assert [i for s in read for b in s for i in b.column("spool_seq").to_pylist()] == list(range(1000))


def test_checkpoint_files_on_local_disk_start_no_commands(spark, hundred, monkeypatch):
    path = workspace(spark, "spool")
    store(hundred, path)
    used = []

    def run():
        def handle(rows, batch_id):
            used.append(rows.sparkSession.conf.get(CHECKPOINT_FILES, None))

        stream = open_queue(spark, path, partitions=1, batch_size=100)
        p.run_available(stream.writeStream.option(
            "checkpointLocation", workspace(spark, "cp")).foreachBatch(handle))

    run()
    assert spark.conf.get(CHECKPOINT_FILES, None) is None
    own = BY_FILE_SYSTEM.replace("FileSystemBased", "FileContextBased")
    spark.conf.set(CHECKPOINT_FILES, own)
    try:
        run()
    finally:
        spark.conf.unset(CHECKPOINT_FILES)
    assert used == [BY_FILE_SYSTEM, own]


def test_checkpoints_are_not_gathered_on_the_driver_for_every_batch(spark, hundred):
    path, out = workspace(spark, "spool"), workspace(spark, "out")
    keys = F.when(F.col("spool_seq") % 2 == 0, F.concat(F.lit("k"), F.col("spool_seq") % 10))
    props = F.when(keys.isNotNull(), F.create_map(F.lit("JMSXGroupID"), keys)).otherwise(F.col("user_props"))
    store(hundred.withColumn("user_props", props), path)
    # A key may read like a message's id; a message without a key still meets no checkpoint.
    done = spark.createDataFrame(
        [("k2", f"rmid1:{41:018d}"), ("c-0", f"rmid1:{20:018d}"), (f"rmid1:{31:018d}", f"rmid1:{99:018d}")],
        "partitionId string, messageIDs string",
    )
    stream = open_queue(spark, path, partitions=1, batch_size=25, checkpoints=done, keep=("spool_seq",))
    assert "broadcast" not in stream._jdf.queryExecution().logical().toString()
    p.run_available(p.land_parquet(stream, out, workspace(spark, "cp")))
    want = [i for i in range(100) if (i > 20 if i % 2 else i % 10 != 2 or i > 41)]
    assert sorted(r.spool_seq for r in spark.read.parquet(out).collect()) == want


def test_state_of_all_acknowledgements_is_written_by_its_changes(spark, monkeypatch):
    asked = []

    def landed(stream, large_state=False):
        asked.append(large_state)
        return stream

    monkeypatch.setattr(acks, "landed", landed)
    acks.unacked_stream(spark, "/root/testdata/sf0.001")
    assert asked == [True]


def test_acknowledgements_are_read_in_step_with_their_messages(spark, monkeypatch):
    started, start = [], DataStreamWriter.start
    monkeypatch.setattr(DataStreamWriter, "start", lambda *a, **o: started.append(start(*a, **o)) or started[-1])
    for module in (streams, acks):
        monkeypatch.setattr(module, "BATCH_SIZE", 25, raising=False)
    rows = acks.unacked_stream(spark, "/root/testdata/sf0.001").collect()
    assert len({r.Id for r in rows}) == len(rows) > 15
    batches = [b for b in started[0].recentProgress if b["numInputRows"]]
    assert max(s["numInputRows"] for b in batches for s in b["sources"]) == 25 * streams.PARTITIONS
    assert max(b["stateOperators"][0]["numRowsTotal"] for b in batches) < 600


@pytest.mark.parametrize("run", [
    streams.queue_stream_resume, streams.commit_publish, published.published_bounded_read,
])
def test_bounded_batches_that_shuffle_are_planned_once(spark, monkeypatch, run):
    planned, run_available = [], p.run_available

    def noted(writer, **options):
        planned.append(options.get("adaptive", True))
        run_available(writer, **options)

    monkeypatch.setattr(p, "run_available", noted)
    assert run(spark, "/root/testdata/sf0.001").count() > 0
    assert planned[-1] is False
