import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import frame, message
from tidelog.functions import offsets
from tidelog.operators import replay, resume

SCHEMA = "partitionId string, messageIDs string"


def ident(i):
    return f"rmid1:{i:018d}"


def kept_by_rule(checkpoints, seq, props):
    """The restart rule for one message, id by id."""
    def later(ids):
        return not ids or not all(seq <= i for i in ids)

    if not checkpoints:
        return True
    if "JMSXGroupID" not in props:
        return later([i for _, ids in checkpoints for i in ids])
    key = props["JMSXGroupID"]
    mine = [ids for part, ids in checkpoints if part == key]
    return not key or not mine or later(mine[0])


def make(rng, n=300):
    rows = []
    for i in range(n):
        roll = rng.random()
        if roll < 1 / 3:
            props = {"JMSXGroupID": "hot"}
        elif roll < 0.6:
            props = {"JMSXGroupID": rng.choice(["k1", "k2", "k3", "", None])}
        else:
            props = {"x": "y"}
        rows.append(message(i, user_props=props))
    return rows


@pytest.mark.parametrize("max_bytes", [None, 0])
@pytest.mark.parametrize("seed", range(4))
def test_whole_rule_against_one_message_at_a_time(spark, seed, max_bytes):
    rng = random.Random(seed)
    rows = make(rng)
    state = [(p, rng.sample(range(300), rng.choice([0, 1, 2])))
             for p in ("c-0", "hot", "k1", "k2") if rng.random() < 0.8]
    table = spark.createDataFrame(
        [(p, ",".join(ident(i) for i in ids)) for p, ids in state], SCHEMA)
    got = resume.resume_filter(frame(spark, rows), table, max_bytes=max_bytes)
    want = [r["spool_seq"] for r in rows if kept_by_rule(state, r["spool_seq"], r["user_props"])]
    assert sorted(r.spool_seq for r in got.select("spool_seq").collect()) == want
    assert got.columns == frame(spark, rows).columns

    as_apps = spark.createDataFrame(
        [(p, ",".join(f"app-{i}" for i in ids)) for p, ids in state], SCHEMA)
    log = frame(spark, rows).withColumn("position", resume.padded("spool_seq"))
    located = resume.locate_ids(as_apps, log, "application_message_id")
    by_place = resume.resume_filter(log, located, "position", max_bytes=max_bytes)
    assert sorted(r.spool_seq for r in by_place.collect()) == want


def test_an_id_gone_from_the_log_drops_nothing(spark):
    log = frame(spark, [message(i) for i in range(10)]).withColumn(
        "position", resume.padded("spool_seq"))
    state = spark.createDataFrame([("c-0", "app-5"), ("c-1", "gone")], SCHEMA)
    located = resume.locate_ids(state, log, "application_message_id")
    assert resume.resume_filter(log, located, "position").count() == 10


def test_single_rules(spark):
    rows = [message(0), message(1, user_props={"JMSXGroupID": "k"}), message(2),
            message(3, user_props={"JMSXGroupID": "k"})]
    state = spark.createDataFrame([("k", ident(1)), ("c-0", ident(0))], SCHEMA)
    log = frame(spark, rows)

    def seqs(df):
        return sorted(r.spool_seq for r in df.collect())

    assert seqs(resume.resume_unkeyed(log, state)) == [1, 2, 3]
    assert seqs(resume.resume_keyed(log, state)) == [0, 2, 3]
    assert seqs(resume.resume_filter(log, state)) == [2, 3]
    assert seqs(resume.resume_filter(log, state, replay=True)) == [0, 1, 2, 3]
    none = spark.createDataFrame([], SCHEMA)
    assert seqs(resume.resume_filter(log, none)) == [0, 1, 2, 3]


OFFSETS = [
    ('{"offset":7,"checkpoints":[{"partitionId":"p1","messageIDs":"c"}]}', [(7, "p1", "c")]),
    ('{"offset":8,"checkpoints":[{"partitionId":"p1","messageIDs":"a,b"},'
     '{"partitionId":"p2","messageIDs":"d,,e"}]}',
     [(8, "p1", "a"), (8, "p1", "b"), (8, "p2", "d"), (8, "p2", "e")]),
    ('{"offset":5,"messageIDs":"a,b"}', [(5, "old-checkpoint", "a"), (5, "old-checkpoint", "b")]),
    ('{"offset":9}', []),
    ('{"offset":9,"checkpoints":[]}', []),
    ("junk", []),
    ('{"checkpoints":[]}', []),
]


@pytest.mark.parametrize(("line", "want"), OFFSETS)
def test_offset_shapes(spark, line, want):
    log = spark.createDataFrame([(line,)], "json string")
    got = offsets.decode_offsets(log).collect()
    assert sorted(tuple(r) for r in got) == want


def test_old_entry_without_ids_becomes_an_empty_checkpoint(spark):
    log = spark.createDataFrame([('{"offset":9}',)], "json string")
    row = offsets.migrate_offsets(log).first()
    assert [tuple(c) for c in row.checkpoints] == [("old-checkpoint", "")]


def test_unreadable_entry_fails_when_strict(spark):
    log = spark.createDataFrame([("junk",)], "json string")
    assert offsets.migrate_offsets(log).first().readable is False
    with pytest.raises(Exception, match="delete the checkpoint"):
        offsets.migrate_offsets(log, strict=True).collect()


def test_offset_line_round_trip(spark):
    rows = spark.createDataFrame([("p", "a,b")], SCHEMA)
    lines = rows.select(offsets.encode_offset(F.lit(3).cast("bigint")).alias("json"))
    assert sorted(tuple(r) for r in offsets.decode_offsets(lines).collect()) == [
        (3, "p", "a"), (3, "p", "b")]


def test_replay_from_time_is_in_the_named_zone(hundred):
    # Receipt of message i is 2024-03-01 00:00:01 UTC plus i seconds; Tokyo is nine hours ahead.
    for text, zone in (("2024-03-01T00:00:51", "UTC"), ("2024-03-01T09:00:51", "Asia/Tokyo")):
        got = replay.replay(hundred, "TIMEBASED", text, zone)
        assert got.count() == 50
        assert got.agg(F.min("spool_seq")).first()[0] == 50


def test_replay_after_id_is_strict(hundred):
    assert replay.replay(hundred, "REPLICATION-GROUP-MESSAGE-ID", message_id=ident(50)).count() == 49
    got = replay.replay_after_position_of(hundred, "app-50", "application_message_id")
    assert got.count() == 49


def test_replay_beginning_and_none(hundred):
    assert replay.replay(hundred, "BEGINNING").count() == 100
    assert replay.replay(hundred, None).count() == 100


@pytest.mark.parametrize(("strategy", "options"), [
    ("SOMETIMES", {}),
    ("TIMEBASED", {}),
    ("TIMEBASED", {"start_time": ""}),
    ("TIMEBASED", {"start_time": "yesterday"}),
    ("REPLICATION-GROUP-MESSAGE-ID", {}),
    ("REPLICATION-GROUP-MESSAGE-ID", {"message_id": ""}),
])
def test_bad_replay_is_refused(hundred, strategy, options):
    with pytest.raises(ValueError):
        replay.replay(hundred, strategy, **options)


def test_replay_after_unknown_id_is_refused(hundred):
    with pytest.raises(ValueError, match="not in the log"):
        replay.replay_after_position_of(hundred, "nope")
