import random
from collections import Counter, defaultdict

import pytest

from tests.conftest import frame, message
from tidelog.functions import messages as m
from tidelog.operators import batching, checkpoints, delivery
from tidelog.operators.lookup import pick_by, stored_bytes
from tidelog.operators.ordering import number_rows, previous_value
from tidelog.plans.fixtures import redeliver


def hot_log(spark, n=1200, seed=3):
    """Rows in random order; one group holds a third of them, and a null group exists."""
    rng = random.Random(seed)
    seqs = rng.sample(range(n * 4), n)
    rows = []
    for seq in seqs:
        group = "hot" if rng.random() < 1 / 3 else rng.choice(["a", "b", "c", None])
        rows.append((group, seq, rng.choice([None, "x", "y"])))
    return rows, spark.createDataFrame(rows, "g string, o bigint, v string")


@pytest.mark.parametrize("block", [3, 50, 65_536])
def test_numbering_and_previous_value_match_a_plain_walk(spark, block):
    rows, df = hot_log(spark)
    want, count, last = {}, Counter(), defaultdict(lambda: None)
    for g, o, v in sorted(rows, key=lambda r: r[1]):
        want[o] = (count[g], last[g])
        count[g] += 1
        last[g] = v
    numbered = {r.o: r.n for r in number_rows(df, ["g"], "o", "n", block).collect()}
    before = {r.o: r.p for r in previous_value(df, ["g"], "o", "v", "p", block).collect()}
    assert numbered == {o: w[0] for o, w in want.items()}
    assert before == {o: w[1] for o, w in want.items()}


@pytest.mark.parametrize("max_bytes", [None, 0])
@pytest.mark.parametrize("last", [True, False])
def test_pick_by_finds_whole_rows(spark, last, max_bytes):
    rows, df = hot_log(spark)
    want = {}
    for g, o, v in rows:
        if g not in want or (o > want[g][0]) == last:
            want[g] = (o, v)
    got = pick_by(df, ["g"], "o", last, max_bytes).collect()
    assert sorted(((r.g, r.o, r.v) for r in got), key=repr) == sorted(
        ((g, o, v) for g, (o, v) in want.items()), key=repr)


def test_pick_by_on_an_empty_log(spark):
    empty = spark.createDataFrame([], "g string, o bigint")
    assert pick_by(empty, ["g"], "o").count() == 0


def test_stored_bytes_counts_text(spark):
    df = spark.createDataFrame([("abcd", 1), (None, 2)], "a string, b bigint")
    assert stored_bytes(df) == 2 * 2 * 16 + 4


def test_dense_batches_equal_counted_ones(hundred):
    planned = batching.plan_batches(hundred, 2, 20)
    sparse = batching.plan_batches_sparse(planned.drop("batch"), 20, block=7)
    assert sorted(planned.select("spool_seq", "consumer", "batch").collect()) == sorted(
        sparse.select("spool_seq", "consumer", "batch").collect())
    sizes = batching.batch_counts(planned, "consumer", "batch").collect()
    assert max(r["messages"] for r in sizes) == 20


def test_batch_size_zero_is_one_batch(hundred):
    for planned in (
        batching.plan_batches(hundred, 3, 0),
        batching.plan_batches_sparse(batching.assign_consumer(hundred, 3), 0),
    ):
        assert [r["batch"] for r in planned.select("batch").distinct().collect()] == [0]


def test_zero_partitions_take_the_sessions_cores(spark, hundred):
    dealt = batching.assign_consumer(hundred, 0)
    n = spark.sparkContext.defaultParallelism
    assert dealt.select("consumer").distinct().count() == n


@pytest.mark.parametrize(("partitions", "size"), [(-1, 1), (1, -1)])
def test_negative_bounds_are_refused(hundred, partitions, size):
    with pytest.raises(ValueError, match=">= 0"):
        batching.plan_batches(hundred, partitions, size)


def test_queue_probe(hundred):
    assert not batching.is_empty(hundred)
    assert batching.is_empty(hundred.where("spool_seq < 0"))


def test_merge_takes_the_newest_distinct_checkpoint(spark):
    schema = "partitionId string, messageIDs string, batch_id bigint"
    one = spark.createDataFrame([("c-0", "3", 1), ("c-0", "4", 2), ("c-1", "9", 2)], schema)
    two = spark.createDataFrame([("c-1", "9", 2), ("7", "", 2), ("c-0", "5", 1)], schema)
    got = checkpoints.merge_checkpoints(one, two).collect()
    assert sorted(tuple(r) for r in got) == [("7", ""), ("c-0", "4"), ("c-1", "9")]


def test_restart_prefers_state_whole(spark):
    schema = "partitionId string, messageIDs string"
    state = spark.createDataFrame([("a", "1")], schema)
    log = spark.createDataFrame([("a", "2"), ("b", "3")], schema)
    none = spark.createDataFrame([], schema)

    def rows(df):
        return sorted(tuple(r) for r in df.collect())

    assert rows(checkpoints.restart_state(state, log)) == [("a", "1", "state")]
    assert rows(checkpoints.restart_state(none, log)) == [
        ("a", "2", "offset_log"), ("b", "3", "offset_log")]
    assert rows(checkpoints.restart_state(none, none)) == []


@pytest.mark.parametrize("max_bytes", [None, 0])
def test_dedup_keeps_the_first_of_a_hot_id(spark, max_bytes):
    rng = random.Random(5)
    rows = [("hot" if i % 3 == 0 else None if i % 50 == 1 else f"id{i}", i) for i in range(900)]
    rows += [(a, b + 1000) for a, b in rng.sample(rows, 200)]
    rng.shuffle(rows)
    want = {}
    for a, b in rows:
        key = a or ("none", b)  # messages without an id are all different
        want[key] = min(b, want.get(key, b))
    df = spark.createDataFrame(rows, "Id string, spool_seq bigint")
    got = delivery.dedup_by_id(df, max_bytes=max_bytes).collect()
    assert {r.Id or ("none", r.spool_seq): r.spool_seq for r in got} == want
    assert len(got) == len(want)
    assert len(got) == len(want)


def test_skip_repeat_drops_only_consecutive_ids(spark):
    rows = [(0, 1, "a"), (0, 2, "a"), (0, 3, "b"), (0, 4, "a"), (1, 5, "a"), (1, 900, "a")]
    df = spark.createDataFrame(rows, "consumer int, spool_seq bigint, Id string")
    got = delivery.skip_repeat(df, block=2).collect()
    assert sorted(r.spool_seq for r in got) == [1, 3, 4]


@pytest.mark.parametrize("block", [3, 40, 65_536])
def test_skip_repeat_looks_at_every_consumer(spark, block):
    rng = random.Random(block)
    rows = [(rng.randrange(3), seq, rng.choice(["a", "a", "b", "c", "d", "", None]))
            for seq in rng.sample(range(2000), 600)]
    last, want = {}, []
    for consumer, seq, name in sorted(rows, key=lambda r: r[1]):
        if not name or name not in last.values():
            want.append(seq)
        if name:
            last[consumer] = name
    df = spark.createDataFrame(rows, "consumer int, spool_seq bigint, Id string")
    got = delivery.skip_repeat(df, block=block).collect()
    assert sorted(r.spool_seq for r in got) == want


def test_messages_without_an_id_are_no_repeats(spark):
    rows = [(i, [None, "", "x", f"y{i}"][i % 4]) for i in range(200)]
    df = spark.createDataFrame(rows, "spool_seq bigint, Id string")
    got = sorted(r.spool_seq for r in delivery.dedup_by_id(df).collect())
    assert got == [i for i, name in rows if name != "x" or i == 2]


def test_missing_acks_move_ids_only(spark):
    rows = [(i, f"m{i % 90}" if i % 10 else None, "p" * 50) for i in range(100)]
    df = spark.createDataFrame(rows, "spool_seq bigint, Id string, body string")
    acks = spark.createDataFrame([(f"m{i}",) for i in range(0, 90, 2)] + [(None,)], "Id string")
    got = sorted(r.spool_seq for r in delivery.missing_acks(df, acks).collect())
    assert got == [i for i, name, _ in rows if name is None or int(name[1:]) % 2]


def test_redelivery_then_dedup_is_the_log(hundred):
    planned = batching.plan_batches(hundred, 2, 20)
    arrivals = redeliver(planned)
    assert arrivals.count() == 120
    assert arrivals.where("redelivered").count() == 20
    once = delivery.dedup_by_id(arrivals, "rgmid", "delivery")
    columns = ["spool_seq", "rgmid", "redelivered"]
    assert sorted(once.select(columns).collect()) == sorted(hundred.select(columns).collect())


def test_ack_ledger_leaves_the_newest_batch_pending(hundred):
    ledger = delivery.ack_ledger(batching.plan_batches(hundred, 2, 30))
    got = ledger.groupBy("ack", "batch").count().collect()
    assert sorted((r["ack"], r["batch"], r["count"]) for r in got) == [
        ("ACKED", 0, 60), ("PENDING", 1, 40)]


def test_missing_acks_count_rows_of_a_shared_id(spark):
    published = spark.createDataFrame([("same",)] * 5 + [("other",)] * 2, "Id string")
    acks = spark.createDataFrame([("other",), ("other",)], "Id string")
    assert delivery.missing_acks(published, acks).count() == 5


def test_checkpoint_per_consumer(spark):
    log = frame(spark, [message(i) for i in range(10)])
    dealt = batching.assign_consumer(log, 2)
    got = checkpoints.consumer_checkpoint(dealt, "consumer", "application_message_id").collect()
    assert sorted(tuple(r) for r in got) == [("0", "app-8"), ("1", "app-9")]


def test_last_value_is_the_whole_newest_message(hundred):
    row = checkpoints.last_value(hundred).select("spool_seq", "content").collect()
    assert [(r.spool_seq, bytes(r.content)) for r in row] == [(99, b"a plain body")]


def test_keys_have_one_consumer_and_few_move_with_another(spark):
    rows = [message(i, user_props={"JMSXGroupID": f"k{i % 700}"}) for i in range(1400)]
    rows += [message(1400, user_props={}), message(1401, user_props={"JMSXGroupID": ""}), message(1402, user_props=None)]
    log = frame(spark, rows)

    def owners(n):
        got = batching.assign_by_key(log, n).select(m.partition_key().alias("k"), "spool_seq", "consumer").collect()
        assert all(0 <= r.consumer < n for r in got) and len(got) == 1403
        assert all(r.consumer == r.spool_seq % n for r in got if r.k == "")
        by_key = {}
        for r in got:
            if r.k:
                by_key.setdefault(r.k, set()).add(r.consumer)
        assert all(len(c) == 1 for c in by_key.values())
        return {k: min(c) for k, c in by_key.items()}

    seven, eight = owners(7), owners(8)
    moved = {k for k in seven if seven[k] != eight[k]}
    assert all(eight[k] == 7 for k in moved) and 0.5 * 700 / 8 < len(moved) < 1.6 * 700 / 8
    assert all(sum(c == i for c in seven.values()) > 50 for i in range(7)) and set(owners(1).values()) == {0}
