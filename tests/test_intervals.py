"""Explicit acknowledgements as intervals; redelivery by due hours; subscriptions joined by rank."""

import random
from datetime import timedelta

import pytest
from helpers import T0, pairs, sample
from pyspark.sql import functions as F

from subjectlog.functions.times import local_time
from subjectlog.operators.acks import pending_explicit, redelivery_due
from subjectlog.operators.intervals import compacted_ledger, explicit_floor, pending_intervals
from subjectlog.operators.subscribe import subscribe
from subjectlog.operators.subscriptions import subscriptions
from subjectlog.schema import ACK, DELIVERY
from subjectlog.scratch import scratch_path
from subjectlog.sinks.publish import append_acks, read_acks
from subjectlog.sources.files import Folder
from subjectlog.sources.log import store
from subjectlog.streaming.redelivery import due_folders, redeliver_round


def plain_runs(sent, acked):
    runs, floors = [], {}
    for who in {k[:2] for k in sent}:
        held, run, floor, whole = sorted({k[2] for k in sent if k[:2] == who}), [], 0, True
        for n in [*held, None]:
            if n is not None and (*who, n) in acked:
                run.append(n)
                floor = n if whole else floor
                continue
            whole = False
            if run:
                runs.append((*who, run[0], run[-1], len(run)))
            run = []
        floors[who] = floor
    return sorted(runs), sorted((*w, f) for w, f in floors.items())


@pytest.mark.parametrize("seed", range(4))
def test_intervals(spark, seed, monkeypatch):
    monkeypatch.setattr("subjectlog.operators.intervals.SEQ_BUCKET", 10)
    draw = random.Random(seed)
    sent = [(c, "s", n) for c in "abc" for n in draw.sample(range(1, 200), 80)]
    acked = [k for k in sent if draw.random() < (0.95, 0.5, 0.99, 0.1)[seed]] + [("z", "s", 1)]
    deliveries = spark.createDataFrame([(*k, T0, a) for k in sent for a in (1, 2)], DELIVERY)
    acks = spark.createDataFrame([(*k, T0) for k in acked * 2], ACK)
    ledger = compacted_ledger(deliveries, acks)
    runs, floors = plain_runs(sent, set(acked))
    assert pairs(ledger, "consumer", "stream", "low", "high", "messages") == runs
    assert pairs(explicit_floor(deliveries, ledger), "consumer", "stream", "floor") == floors
    want = pairs(pending_explicit(deliveries, acks), "consumer", "seq", "attempt")
    assert pairs(pending_intervals(deliveries, ledger), "consumer", "seq", "attempt") == want


def test_intervals_of_nothing(spark):
    none = spark.createDataFrame([], DELIVERY)
    ledger = compacted_ledger(none, spark.createDataFrame([], ACK))
    assert ledger.collect() == [] and explicit_floor(none, ledger).collect() == []
    one = spark.createDataFrame([("c", "s", 5, T0, 1)], DELIVERY)
    assert pairs(explicit_floor(one, ledger), "consumer", "floor") == [("c", 0)]


def test_rounds_like_plain_and_what_they_read(spark):
    """Twelve rounds with new acknowledgements and deliveries; each reads about as much as the others."""
    draw = random.Random(5)
    sent, done = scratch_path(spark, "sent"), scratch_path(spark, "done")
    at = lambda h: T0 + timedelta(hours=h, minutes=7)
    first = [("c", "s", n, T0 + timedelta(minutes=n), 1) for n in range(1, 60)]
    store(spark.createDataFrame(first, DELIVERY).withColumn("batch", F.lit(0).cast("long")), sent, "batch")
    known, acked, folders, wait = {(r[2]): (r[3], 1) for r in first}, set(), [], timedelta(hours=2)
    folder = Folder(spark, f"{sent}/_due")
    for number in range(1, 13):
        hour = 2 * number
        fresh = [n for n in known if n not in acked and draw.random() < 0.3]
        if fresh:
            append_acks(spark.createDataFrame([("c", "s", n, at(hour)) for n in fresh], ACK), done)
            acked.update(fresh)
        new = [("c", "s", 1000 * number + n, at(hour) - timedelta(minutes=5), 1) for n in range(8)]
        want = []
        known.update({r[2]: (r[3], 1) for r in new})
        for n, (when, attempt) in list(known.items()):
            if n not in acked and when + wait <= at(hour):
                want.append((n, attempt + 1))
        for _ in range(2 if number % 5 == 0 else 1):  # some rounds twice, as after a failure
            redeliver_round(spark, sent, done, F.lit(7_200_000_000_000), local_time(at(hour)), number, spark.createDataFrame(new, DELIVERY))
        got = spark.read.parquet(sent).where(f"batch = {number}")
        assert pairs(got, "seq", "attempt") == sorted(want)
        known.update({n: (at(hour), a) for n, a in want})
        state = max(int(n.removesuffix(".json")) for n in folder.names("_rounds"))
        import json

        open_hour = json.loads(folder.read(f"_rounds/{state}.json"))["open"]
        ahead = at(hour + 2)
        folders.append(len(due_folders(folder, open_hour, state, int((ahead - T0).total_seconds() // 3600) + int(T0.timestamp() // 3600) + 24, number + 1)))
    assert max(folders) <= 12 and len(folder.names("pending")) <= 12


def test_round_equals_the_whole_ledger(spark):
    """The first round, and one after a long silence, against everything grouped at once."""
    sent, done = scratch_path(spark, "sent"), scratch_path(spark, "done")
    rows = [("c", "s", n, T0 + timedelta(hours=n), 1) for n in range(1, 40)]
    store(spark.createDataFrame(rows, DELIVERY).withColumn("batch", F.lit(0).cast("long")), sent, "batch")
    append_acks(spark.createDataFrame([("c", "s", n, T0) for n in range(1, 40, 3)], ACK), done)
    wait = F.lit(3_600_000_000_000)
    for number, hour in ((1, 20), (2, 500)):
        now = local_time(T0 + timedelta(hours=hour))
        before = spark.read.schema("consumer string, stream string, seq long, delivered_at timestamp_ntz, attempt int, batch long").parquet(sent)
        want = redelivery_due(before.where(f"batch < {number}"), read_acks(spark, done), wait, now)
        want = pairs(want, "seq", "delivered_at", "attempt")
        redeliver_round(spark, sent, done, wait, now, number)
        assert pairs(spark.read.parquet(sent).where(f"batch = {number}"), "seq", "delivered_at", "attempt") == want and want


@pytest.mark.parametrize("seed", range(2))
def test_many_by_rank(spark, seed, monkeypatch):
    from subjectlog.operators import attach

    monkeypatch.setattr("subjectlog.operators.ranges.SEQ_BUCKET", 16)
    draw, log = random.Random(seed), sample(spark, 90)
    given = []
    for k in range(30):
        given.append({"stream": "s", "subject": draw.choice(["a.x", "a.*", ">", "b.x", "*.x", "no.*"]), "consumer_name_prefix": f"p{k}"})
        given[-1] |= {"max_messages_to_read": draw.choice([1, 2, 3, 7, 50, 500])}
        given[-1] |= {"start_sequence": draw.randint(1, 95)} if draw.random() < 0.7 else {"start_time": T0 + timedelta(seconds=40)}
    subs = subscriptions(spark, given)
    want = pairs(subscribe(log, subs), "split_id", "seq")
    monkeypatch.setattr(attach, "BROADCAST_ROWS", 2)
    assert pairs(subscribe(log, subs), "split_id", "seq") == want
    text = subscribe(log, subs)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
