"""Ids seen before: the bits never miss one, and a stream without repeats reads none of them."""

import pytest
from pyspark.sql import functions as F

from tidelog.functions import messages as m
from tidelog.operators import seen
from tidelog.operators.delivery import dedup_by_id
from tidelog.session import stage, workspace
from tidelog.sources.spool import open_queue
from tidelog.streaming import jobs as p
from tidelog.streaming.batches import read_batches, write_batch

from tests.test_streams import store


def ids(spark, low, high):
    return spark.range(low, high).select(F.concat(F.lit("id-"), "id").alias("Id"))


@pytest.mark.parametrize("segments", [1, 7, 64])
def test_bits_know_every_id_and_doubt_few_others(spark, segments):
    bits = stage(seen.seen_bits(ids(spark, 0, 2_000), segments=segments), "bits")
    assert bits.count() == segments and bits.where(F.octet_length("bits") != 4096).count() == 0
    known = seen.maybe_seen(ids(spark, 0, 2_000), bits, segments=segments)
    assert known.distinct().count() == 2_000 and known.columns == ["Id"]
    others = seen.maybe_seen(ids(spark, 5_000, 9_000), bits, segments=segments).count()
    assert others < 4_000 * 0.02


def test_merged_bits_are_those_of_all_ids(spark):
    whole = seen.seen_bits(ids(spark, 0, 900), segments=5)
    parts = seen.seen_bits(ids(spark, 0, 500), segments=5).unionByName(
        seen.seen_bits(ids(spark, 400, 900), segments=5))
    assert sorted(seen.merge_bits(parts).collect()) == sorted(whole.collect())


def test_no_id_sets_no_bit_and_is_never_doubtful(spark):
    none = spark.createDataFrame([(None,), ("",)], "Id string")
    assert seen.seen_bits(none).count() == 0
    bits = stage(seen.seen_bits(ids(spark, 0, 10), segments=1), "bits")
    assert seen.maybe_seen(none, bits, segments=1).count() == 0
    assert seen.maybe_seen(ids(spark, 0, 10), bits.limit(0), segments=1).count() == 0


def test_buckets_are_alike_with_and_without_ids(spark):
    rows = spark.range(8_000).withColumnRenamed("id", "delivery")
    rows = rows.withColumn("Id", F.when(F.col("delivery") % 2 == 0, F.concat(F.lit("i"), "delivery")))
    rows = rows.withColumn("b", seen.id_bucket("Id", "delivery", 16))
    sizes = [r["count"] for r in rows.groupBy("b").count().collect()]
    assert len(sizes) == 16 and min(sizes) > 400 and max(sizes) < 600


def deliveries(spark, path):
    """Batches of 25; a third of the ids are one id, some are null or empty, and all come again."""
    seq = F.col("spool_seq")
    stream = open_queue(spark, path, partitions=1, batch_size=25, keep=("spool_seq",))
    named = F.when(seq % 10 == 1, F.lit(None)).when(seq % 10 == 2, "").when(seq % 3 == 0, "hot")
    return stream.withColumn("Id", named.otherwise(F.concat(F.lit("i"), seq % 50))).withColumnRenamed(
        "spool_seq", "delivery")


def appended(spark, stream, out, checkpoint=None, **options):
    p.run_available(p.dedup_append(stream, out, checkpoint or workspace(spark, "cp"), **options))
    return sorted(r.delivery for r in read_batches(spark, out, stream.schema).collect())


@pytest.mark.parametrize("options", [{}, {"segments": 1, "buckets": 1}, {"buckets": 3}])
def test_dedup_append_equals_the_batch_dedup(spark, hundred, options):
    path, out = workspace(spark, "spool"), workspace(spark, "once")
    store(hundred, path)
    whole = deliveries(spark, path)
    landed = workspace(spark, "landed")
    p.run_available(p.land_parquet(whole, landed, workspace(spark, "cp")))
    want = dedup_by_id(spark.read.schema(whole.schema).parquet(landed), "Id", "delivery")
    got = appended(spark, whole, out, **options)
    assert got == sorted(r.delivery for r in want.collect()) and len(got) > 40


def test_another_query_with_other_numbers_still_knows_all_ids(spark, hundred):
    """A stream that lost its checkpoint reads everything again; only messages without id repeat."""
    path, out = workspace(spark, "spool"), workspace(spark, "once")
    store(hundred, path)
    first = appended(spark, deliveries(spark, path), out)
    again = appended(spark, deliveries(spark, path), out, segments=3, buckets=5)
    assert sorted(set(again)) == first
    twice = [d for d in set(again) if again.count(d) > 1]
    assert twice and all(d % 10 in (1, 2) for d in twice)


def test_a_batch_lost_after_its_bits_loses_no_row(spark, hundred, monkeypatch):
    path, out, checkpoint = (workspace(spark, n) for n in ("spool", "once", "cp"))
    store(hundred, path)
    want = appended(spark, deliveries(spark, path), workspace(spark, "other"))
    real, failed = p.write_batch, []

    def flaky(rows, folder, query, batch_id, *by):
        if folder == out and batch_id == 2 and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost")
        real(rows, folder, query, batch_id, *by)

    monkeypatch.setattr(p, "write_batch", flaky)
    stream = deliveries(spark, path)
    with pytest.raises(Exception, match="lost"):
        appended(spark, stream, out, checkpoint)
    assert appended(spark, stream, out, checkpoint) == want
    versions = spark.read.parquet(f"{out}/{p.SEEN_FOLDER}").select("batch_id").distinct()
    assert sorted(r.batch_id for r in versions.collect()) == [2, 3]


def test_earlier_rows_are_read_only_for_doubtful_ids(spark, hundred, monkeypatch):
    """Which buckets of earlier rows a batch asks for: none without repeats, one for one repeat."""
    path, out = workspace(spark, "spool"), workspace(spark, "once")
    store(hundred, path)
    read, asked = p.read_batches, []

    class Watched:
        def __init__(self, df):
            self.df = df

        def where(self, condition):
            asked.append(str(condition))
            return self.df.where(condition)

    def watch(session, folder, schema):
        rows = read(session, folder, schema)
        return Watched(rows) if folder == out else rows

    monkeypatch.setattr(p, "read_batches", watch)
    seq = F.col("spool_seq")
    once = open_queue(spark, path, partitions=1, batch_size=25, keep=("spool_seq",))
    once = once.withColumnRenamed("spool_seq", "delivery")
    p.run_available(p.dedup_append(once, out, workspace(spark, "cp")))
    assert asked == []
    late = open_queue(spark, path, partitions=1, batch_size=25, keep=("spool_seq",)).where(
        seq == 60).withColumnRenamed("spool_seq", "delivery")
    p.run_available(p.dedup_append(late, out, workspace(spark, "cp")))
    assert len(asked) == 1
    stored = read(spark, out, p.T.StructType(
        [*once.schema.fields, p.T.StructField(p.BUCKET, p.T.IntegerType())]))
    assert stored.count() == 100
    [bucket] = stored.where("delivery = 60").select(p.BUCKET).first()
    plan = stored.where(F.col(p.BUCKET).isin([bucket])).select("Id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(id_bucket" in text and "ReadSchema: struct<Id:string>" in text


def test_rows_without_bits_are_refused(spark, hundred):
    path, out = workspace(spark, "spool"), workspace(spark, "once")
    store(hundred, path)
    stream = deliveries(spark, path)
    rows = spark.createDataFrame([], stream.schema).union(
        spark.range(3).select(*[
            F.lit("i1" if f.name == "Id" else None).cast(f.dataType).alias(f.name) for f in stream.schema
        ]))
    write_batch(rows, out, "another", 0)
    with pytest.raises(Exception, match="without bits"):
        appended(spark, stream, out)


def test_bits_that_hold_enough_ids_are_put_aside(spark, hundred, monkeypatch):
    """However many ids come, few of one set of bits are set; ids in those put aside are still known."""
    path, out, checkpoint = (workspace(spark, n) for n in ("spool", "once", "cp"))
    store(hundred, path)
    want = appended(spark, deliveries(spark, path), workspace(spark, "other"))
    monkeypatch.setattr(p, "SEGMENT_IDS", 10, raising=False)
    real, failed = p.write_batch, []

    def flaky(rows, folder, query, batch_id, *by):
        if folder == out and batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost")
        real(rows, folder, query, batch_id, *by)

    monkeypatch.setattr(p, "write_batch", flaky)
    stream = deliveries(spark, path)
    with pytest.raises(Exception, match="lost"):
        appended(spark, stream, out, checkpoint, segments=1)
    assert appended(spark, stream, out, checkpoint, segments=1) == want
    full = spark.read.parquet(f"{out}/{p.FULL_FOLDER}").select("batch_id", "bits", "ids").collect()
    assert sorted(r.batch_id for r in full) == [1, 2, 3]
    assert all(sum(b.bit_count() for b in r.bits) <= r.ids * seen.BITS_AN_ID <= 25 * 8 for r in full)


def test_bits_of_three_an_id_still_know_their_ids(spark, monkeypatch):
    monkeypatch.setattr(seen, "BITS_AN_ID", 3)
    bits = stage(seen.seen_bits(ids(spark, 0, 500), segments=2), "bits")
    monkeypatch.undo()
    old = bits.withColumn("bits_an_id", F.lit(None).cast("int"))
    new = stage(seen.seen_bits(ids(spark, 500, 1_000), segments=2), "bits").withColumn(
        "bits_an_id", F.lit(seen.BITS_AN_ID))
    for few in (False, True):
        known = seen.maybe_seen(ids(spark, 0, 1_000), old.unionByName(new), segments=2, few_ids=few)
        assert known.distinct().count() == 1_000
