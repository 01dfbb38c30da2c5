import pytest
from pyspark.sql import functions as F

from tests.conftest import START, frame, message
from tidelog.functions import headers as h
from tidelog.functions import messages as m
from tidelog.operators import publishing as pub
from tidelog.session import workspace
from tidelog.sinks.publish import Publisher, publish, read_rejects
from tidelog.sources.spool import read_queue


def headers_row(spark, **headers):
    pairs = {f"mq_{k}" if k != "content-type" else k: bytearray(v) for k, v in headers.items()}
    return spark.createDataFrame([(pairs,)], "Headers map<string,binary>")


def typed(spark, strict=False, **headers):
    columns = [c.alias(n) for n, c in h.typed_headers(strict=strict).items()]
    return headers_row(spark, **headers).select(columns).first()


def test_headers_by_type(spark):
    row = typed(
        spark, expiration=b"12", priority=b"-3", isReply=b"TRUE", dmqEligible=b"no",
        senderId=b"me", userData=b"\x00\xff", sequenceNumber=b"9223372036854775807",
        redelivered=b"true", deliveryCount=b"4",
    )
    assert (row.expiration, row.priority, row.isReply, row.dmqEligible) == (12, -3, True, False)
    assert (row.senderId, bytes(row.userData)) == ("me", b"\x00\xff")
    assert row.sequenceNumber == 2**63 - 1
    assert "redelivered" not in row.asDict() and "deliveryCount" not in row.asDict()


def test_absent_headers(spark):
    row = typed(spark, senderId=b"x").asDict()
    assert row.pop("dmqEligible") is True
    assert row.pop("senderId") == "x"
    assert set(row.values()) == {None}


@pytest.mark.parametrize(("name", "value"), [
    ("priority", b"abc"), ("priority", b""), ("priority", b" 1"), ("priority", b"1.5"),
    ("priority", b"2147483648"), ("timeToLive", b"9223372036854775808"), ("replyTo", b"topic"),
])
def test_headers_that_cannot_be_set(spark, name, value):
    assert headers_row(spark, **{name: value}).select(h.header_problem()).first()[0] == name
    with pytest.raises(Exception, match=name):
        typed(spark, strict=True, **{name: value})


def test_first_header_problem_by_name(spark):
    df = headers_row(spark, timeToLive=b"x", expiration=b"y", senderId=b"z")
    assert df.select(h.header_problem()).first()[0] == "expiration"
    assert headers_row(spark, expiration=b"1").select(h.header_problem()).first()[0] is None


def test_bytes_that_are_not_utf8_do_not_fail(spark):
    row = typed(spark, senderId=b"a\xff", priority=b"\xff")
    assert (row.senderId, row.priority) == ("a\ufffd", None)
    payload = spark.createDataFrame([(bytearray(b"a\xff"),)], "Payload binary")
    assert payload.select(F.length(m.payload_text())).first()[0] == 2


def test_content_type_is_decoded(spark):
    assert typed(spark, **{"content-type": b"text/plain"}).contentType == "text/plain"


@pytest.fixture
def envelope(hundred):
    return m.envelope(hundred, include_headers=True, keep=("spool_seq",))


def test_optional_columns_may_be_missing(envelope):
    bound = pub.bind_columns(envelope.select("Payload", "Topic", "Id", "spool_seq"), include_headers=True)
    assert bound.columns == ["Id", "Payload", "PartitionKey", "Topic", "TimeStamp", "Headers"]
    assert bound.where("Headers is null and PartitionKey is null and TimeStamp is null").count() == 100


@pytest.mark.parametrize("name", ["Id", "Topic"])
def test_id_and_topic_must_exist_or_be_set(envelope, name):
    rows = envelope.drop(name)
    with pytest.raises(ValueError, match=name):
        pub.bind_columns(rows)
    fixed = {"Id": {"message_id": "x"}, "Topic": {"topic": "x"}}[name]
    assert pub.bind_columns(rows, **fixed).select(name).distinct().collect() == [("x",)]


@pytest.mark.parametrize("name", ["Id", "Topic", "Payload", "TimeStamp", "Headers", "PartitionKey"])
def test_column_types_are_checked(envelope, name):
    rows = envelope.withColumn(name, F.lit(1))
    with pytest.raises(ValueError, match=name):
        pub.bind_columns(rows, include_headers=True)


def test_missing_payload_is_a_reject(spark, envelope):
    rows = envelope.drop("Payload")
    report = Publisher(mode="report")
    assert report.messages(rows).count() == 0
    got = report.rejects(rows).select("status", "reason").distinct().collect()
    assert [tuple(r) for r in got] == [("FAILED", "Payload is null")]
    with pytest.raises(Exception, match="Payload is null"):
        publish(rows, workspace(spark, "never"))


@pytest.mark.parametrize("name", ["Id", "Topic", "Payload"])
def test_strict_publish_fails_on_a_bad_row(spark, envelope, name):
    rows = envelope.withColumn(name, F.when(F.col("spool_seq") != 42, F.col(name)))
    with pytest.raises(Exception, match=f"{name} is null"):
        publish(rows, workspace(spark, "never"))


def test_strict_publish_fails_on_a_bad_header(spark, envelope):
    bad = F.create_map(F.lit("mq_priority"), F.lit("x").cast("binary"))
    rows = envelope.withColumn("Headers", F.when(F.col("spool_seq") == 42, bad).otherwise(F.col("Headers")))
    with pytest.raises(Exception, match="invalid header priority"):
        publish(rows, workspace(spark, "never"), Publisher(include_headers=True))
    out = workspace(spark, "some")
    counts = publish(rows, out, Publisher(include_headers=True, mode="report"))
    assert counts == {"published": 100, "acknowledged": 99, "failed": 1}
    assert read_queue(spark, out).count() == 99
    assert [r.reason for r in read_rejects(spark, out).collect()] == ["invalid header priority"]


def test_publishing_appends_or_replaces(spark, envelope):
    out = workspace(spark, "appends")
    for _ in range(2):
        publish(envelope, out)
    assert spark.read.parquet(out).count() == 200
    publish(envelope, out, save_mode="overwrite")
    assert spark.read.parquet(out).count() == 100


def test_positions_go_on_after_the_log(spark, envelope):
    out = workspace(spark, "places")
    for _ in range(3):
        publish(envelope.drop("spool_seq"), out)
    ids = read_queue(spark, out).select("spool_seq", "rgmid").collect()
    assert len({r.spool_seq for r in ids}) == len({r.rgmid for r in ids}) == 300
    assert [r.rgmid for r in sorted(ids)] == sorted(r.rgmid for r in ids)


def test_rejects_depend_on_one_reading_of_the_rows(spark, envelope):
    """Rows whose fate is random: each is a message or a reject, never both or neither."""
    rows = envelope.withColumn("Topic", F.when(F.rand() < 0.5, F.col("Topic")))
    out = workspace(spark, "random")
    counts = publish(rows, out, Publisher(mode="report"))
    good, bad = read_queue(spark, out), read_rejects(spark, out)
    assert (good.count(), bad.count()) == (counts["acknowledged"], counts["failed"])
    ids = [r[0] for r in good.select("correlation_id").union(bad.select("Id")).collect()]
    assert len(ids) == len(set(ids)) == 100


def test_round_trip_keeps_headers(spark):
    log = frame(spark, [message(
        7, priority=1, time_to_live=5, expiration=6, sequence_number=8, redelivered=True,
        user_props={"JMSXGroupID": "k", "a": "b"},
    )])
    env = m.envelope(log, include_headers=True, keep=("spool_seq",))
    for include, priority in ((True, 1), (False, 4)):
        sent = Publisher(include_headers=include, keep=("spool_seq",)).messages(env)
        back = pub.as_raw(sent, "spool_seq").first()
        assert back.priority == priority
        assert (back.time_to_live, back.expiration) == ((5, 6) if include else (0, 0))
        assert back.sequence_number == (8 if include else None)
        assert back.redelivered is False
        assert back.user_props == ({"JMSXGroupID": "k", "a": "b"} if include else {"JMSXGroupID": "k"})
        assert bytes(back.attachment) == b"a plain body"
        assert back.application_message_id == back.correlation_id == "rmid1:" + "7".zfill(18)


def test_sender_time_is_millis_and_falls_back_to_the_header(spark):
    stamp = bytearray(b"1234")
    df = spark.createDataFrame(
        [("a", bytearray(b"p"), "t", START, {"mq_senderTimestamp": stamp}),
         ("b", bytearray(b"p"), "t", None, {"mq_senderTimestamp": stamp}),
         ("c", bytearray(b"p"), "t", None, {})],
        "Id string, Payload binary, Topic string, TimeStamp timestamp, Headers map<string,binary>",
    )
    sent = Publisher(include_headers=True).messages(df).collect()
    assert {r.correlation_id: r.sender_ts_ms for r in sent} == {
        "a": int(START.timestamp() * 1000), "b": 1234, "c": None}


def test_report_counts_by_row(hundred):
    env = m.envelope(hundred, keep=("spool_seq",))
    rows = env.withColumn("batch_id", F.expr("spool_seq div 50")).withColumn(
        "Payload", F.when(F.col("spool_seq") != 3, F.col("Payload")))
    bound = pub.bind_columns(rows, message_id="constant", keep=("batch_id",))
    report = pub.publish_report(pub.publish_validate(bound)).collect()
    assert sorted(tuple(r) for r in report) == [
        (0, "orders/new", 50, 49, 1), (1, "orders/new", 50, 50, 0)]


def test_unknown_mode_is_refused():
    with pytest.raises(ValueError):
        Publisher(mode="hope")
