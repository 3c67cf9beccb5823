from datetime import timedelta

import pytest
from helpers import T0, log_of, message, pairs, sample
from pyspark.sql import functions as F

from subjectlog.operators import attach as attach_module
from subjectlog.operators import bound
from subjectlog.operators.attach import attach
from subjectlog.operators.subscribe import positioned, subscribe
from subjectlog.operators.subscriptions import subscriptions
from subjectlog.schema import ACK, PROGRESS


def one(spark, **extra):
    return subscriptions(spark, [{"stream": "s", "subject": "a.*"} | extra])


def seqs(df):
    return sorted(r.seq for r in df.select("seq").collect())


A = [i for i in range(1, 61) if i % 3 != 0]  # sequence numbers of a.x and a.y


def saved(spark, subs, last, messages=0, finished=False):
    return spark.createDataFrame([(subs.head().split_id, last, "r", messages, finished)], PROGRESS)


@pytest.mark.parametrize("limit", [None, 0])
def test_start_positions(spark, limit):
    log = sample(spark)
    assert seqs(subscribe(log, one(spark), limit=limit)) == A
    assert seqs(subscribe(log, one(spark, start_sequence=10), limit=limit)) == [i for i in A if i >= 10]
    at = T0 + timedelta(seconds=20)
    assert seqs(subscribe(log, one(spark, start_time=at), limit=limit)) == [i for i in A if i >= 20]
    assert seqs(subscribe(log, one(spark, start_sequence=0), limit=limit)) == A


@pytest.mark.parametrize("limit", [None, 0])
def test_saved_position_beats_start_options(spark, limit):
    log = sample(spark)
    for extra in ({"start_sequence": 50}, {"start_time": T0 + timedelta(days=1)}):
        subs = one(spark, **extra)
        assert seqs(subscribe(log, subs, saved(spark, subs, 30), limit=limit)) == [i for i in A if i > 30]
        # A split that has emitted nothing still starts where it was told to.
        fresh = subscribe(log, subs, saved(spark, subs, -1), limit=limit)
        assert seqs(fresh) == ([i for i in A if i >= 50] if "start_sequence" in extra else [])


@pytest.mark.parametrize("limit", [None, 0])
def test_bound_counts_what_was_emitted_before(spark, limit):
    log = sample(spark)
    subs = one(spark, max_messages_to_read=10)
    assert seqs(subscribe(log, subs, limit=limit)) == A[:10]
    assert seqs(subscribe(log, subs, saved(spark, subs, A[5], messages=6), limit=limit)) == A[6:10]
    assert seqs(subscribe(log, subs, saved(spark, subs, A[9], messages=10), limit=limit)) == []
    assert seqs(subscribe(log, subs, saved(spark, subs, A[5], 6, finished=True), limit=limit)) == []
    assert seqs(subscribe(log, one(spark, max_messages_to_read=1000), limit=limit)) == A


@pytest.mark.parametrize("limit", [None, 0])
def test_durable_position_is_the_ledger(spark, limit):
    log = sample(spark)
    acks = spark.createDataFrame([("d", "s", n, T0) for n in (4, 7, 20)] + [("other", "s", 50, T0)], ACK)
    for behavior, want in {
        "AckAll": [i for i in A if i > 20],
        "AllButDoNotAck": [i for i in A if i > 20],
        "ExplicitButDoNotAck": [i for i in A if i not in (4, 7, 20)],
    }.items():
        subs = one(spark, ack_behavior=behavior, durable_name="d", start_sequence=55)
        # Neither the start option nor the split's position moves a durable consumer.
        got = subscribe(log, subs, saved(spark, subs, 40), acks, limit=limit)
        assert seqs(got) == want, behavior
    fresh = one(spark, ack_behavior="AckAll", durable_name="new")
    assert seqs(subscribe(log, fresh, acks=acks, limit=limit)) == A


def test_overlapping_subscriptions_repeat_messages(spark):
    subs = subscriptions(spark, [{"stream": "s", "subject": p} for p in ("a.*", "a.x", ">", "a.x")])
    got = subscribe(sample(spark, 6), subs)
    assert pairs(got.groupBy("seq").count(), "seq", "count") == [(1, 3), (2, 2), (3, 1), (4, 3), (5, 2), (6, 1)]


def test_positions_drop_duplicates(spark):
    subs = one(spark)
    assert positioned(subs.unionByName(subs)).count() == 1


def brute_first_n(rows):
    kept = {}
    for split, seq, n in sorted(rows):
        if n is None or n < 1 or len(kept.setdefault(split, [])) < n:
            kept.setdefault(split, []).append(seq)
    return sorted((k, s) for k, v in kept.items() for s in v)


@pytest.mark.parametrize("bucket", [4, 7, 1 << 20])
@pytest.mark.parametrize("limit", [None, 0])
def test_first_n_against_brute_force(spark, monkeypatch, bucket, limit):
    monkeypatch.setattr(bound, "SEQ_BUCKET", bucket)
    if limit is not None:
        monkeypatch.setattr(attach_module, "BROADCAST_ROWS", limit)
    rows = []
    for split, (step, n) in enumerate([(1, 5), (1, 8), (3, 4), (2, None), (1, -1), (5, 100), (1, 40), (1, 1)]):
        rows += [(split, seq, n) for seq in range(1, 41, step)]
    df = spark.createDataFrame(rows, "split_id long, seq long, n long")
    assert pairs(bound.first_n(df, "n"), "split_id", "seq") == brute_first_n(rows)
    few = [r for r in rows if r[2] and r[2] > 0]
    small = spark.createDataFrame(few, df.schema)
    assert pairs(bound.first_n(small, "n"), "split_id", "seq") == brute_first_n(few)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot", [10**6, 0])
def test_attach_by_shuffle_equals_broadcast(spark, monkeypatch, how, hot):
    """Within the limits of rows and bytes, and beyond either; two keys are hot, one without partner."""
    monkeypatch.setattr(attach_module, "BROADCAST_BYTES", hot)
    big = spark.range(500).select(
        F.when(F.col("id") < 150, 0).when(F.col("id") < 300, 7).otherwise(F.col("id") % 5).cast("long").alias("k"),
        F.col("id").alias("seq"),
    )
    small = spark.createDataFrame([("a", 0), ("b", 1), ("c", 1), ("d", 9)], "v string, k long")
    got = [pairs(attach(big, small, ["k"], how, limit=n).fillna("-"), "k", "seq", "v") for n in (10, 2)]
    assert got[0] == got[1] and len(got[0]) == (270 if how == "inner" else 540)


def test_read_of_a_stream_nobody_wrote_to(spark):
    log = log_of(spark, [message("other", "a.x", 1)])
    assert seqs(subscribe(log, one(spark, max_messages_to_read=3))) == []
