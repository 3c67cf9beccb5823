"""Slots, records and notes of a log; pulls cut from them; counts."""

import json
import random
import threading

import pytest
from helpers import log_of, message, pairs, sample
from pyspark.sql import functions as F

from subjectlog.operators.directory import ends_by_counts, progress_by_counts, subscribe_stored
from subjectlog.operators.progress import split_progress
from subjectlog.operators.subscribe import positioned, subscribe
from subjectlog.operators.subscriptions import subscriptions
from subjectlog.schema import ACK
from subjectlog.scratch import scratch_path
from subjectlog.sinks.publish import publish_core, publish_durable
from subjectlog.sources import log as log_module
from subjectlog.sources.files import Folder
from subjectlog.sources.log import Ledger, finished_batches, noted_batches, read_counts, read_log, write_log
from subjectlog.streaming.consume import emitted, start_consumer
from subjectlog.streaming.pulls import ranges


@pytest.fixture(params=["mounted", "store"])
def folder(request, spark):
    made = Folder(spark, scratch_path(spark, "files"))
    made.mounted = request.param == "mounted"
    return made


def test_one_of_several_creates_a_file(folder):
    won = []
    threads = [threading.Thread(target=lambda k=k: won.append(k) if folder.create("a/x.json", str(k)) else None) for k in range(8 if folder.mounted else 1)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and folder.read("a/x.json") == str(won[0]) and not folder.create("a/x.json", "late")
    assert folder.read("a/none") is None and folder.names("none") == [] and folder.names("a") == ["x.json"]
    folder.replace("a/x.json", "new é")
    assert folder.read("a/x.json") == "new é"
    at = folder.written_at("a/x.json") + 5_000_000
    assert folder.create("a/y.json", "", after=at) and folder.written_at("a/y.json") > at and folder.written_at("a/z") == 0
    folder.remove("a")
    assert not folder.exists("a/x.json")


def test_claims_at_once(spark):
    path, got = scratch_path(spark, "claims"), []
    claim = lambda w: [got.append((w, b, Ledger(spark, path).claim("s", w, b, 10 + b))) for b in range(4)]
    threads = [threading.Thread(target=claim, args=(f"w{k}",)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    numbers = sorted(n for _, _, r in got for n in range(r.first, r.last + 1))
    assert numbers == list(range(1, len(numbers) + 1)) and len(numbers) == 4 * (10 + 11 + 12 + 13)
    assert sorted(r.slot for _, _, r in got) == list(range(1, 17)) and Ledger(spark, path).top("s") == 16
    for writer, batch, record in got:  # asked again, as after a failure
        assert Ledger(spark, path).claim("s", writer, batch, 10 + batch) == record


def test_a_writer_that_died_finds_its_slot(spark):
    path = scratch_path(spark, "claims")
    ledger = Ledger(spark, path)
    ledger._keep("s", "w", 0, log_module.Record(1, 0, 5, 1, 5))  # died before the slot was there
    assert ledger.claim("s", "v", 0, 3) == (1, 0, 3, 1, 3, False, False)
    assert ledger.claim("s", "w", 0, 5) == (2, 3, 5, 4, 8, False, False)
    ledger._keep("s", "u", 0, log_module.Record(3, 8, 2, 9, 10))  # died behind it
    ledger.files.create(ledger._slot("s", 3), json.dumps({"writer": "u", "batch": 0, "last": 10}))
    assert ledger.claim("s", "u", 0, 2) == (3, 8, 2, 9, 10, False, False)


def test_notes_wait_for_lower_numbers(spark):
    path = scratch_path(spark, "notes")
    ledger = Ledger(spark, path)
    held = {w: ledger.claim("s", w, 0, 2) for w in "abc"}
    noted = lambda: [r["writer"] for r in noted_batches(spark, path).orderBy("slot").collect()] if ledger.files.exists("_finished") else []
    ledger.settle("s", "c", 0, held["c"])
    ledger.settle("s", "b", 0, held["b"])
    assert noted() == []
    ledger.settle("s", "a", 0, held["a"])  # notes those that wait behind it too
    assert noted() == ["a", "b", "c"]
    ledger.settle("s", "a", 0, held["a"])
    assert noted() == ["a", "b", "c"]
    dates = [ledger.files.written_at(ledger._note("s", k)) for k in (1, 2, 3)]
    assert dates == sorted(set(dates))


def test_a_claim_that_is_given_up(spark):
    path = scratch_path(spark, "notes")
    ledger = Ledger(spark, path)
    held = {w: ledger.claim("s", w, 0, 2) for w in "abc"}
    ledger.settle("s", "c", 0, held["c"])
    ledger.give_up("s", "b", 0)  # a is not there yet
    ledger.give_up("s", "c", 0)  # is complete
    noted = lambda: [(r["writer"], r["first"]) for r in noted_batches(spark, path).where("writer IS NOT NULL").orderBy("slot").collect()]
    assert noted() == []
    ledger.settle("s", "a", 0, held["a"])
    assert noted() == [("a", 1), ("c", 5)]
    with pytest.raises(RuntimeError, match="given up"):  # it was only slow
        ledger.settle("s", "b", 0, held["b"])
    again = ledger.claim("s", "b", 0, 2)
    assert (again.slot, again.first) == (4, 7)
    ledger.settle("s", "b", 0, again)
    assert noted() == [("a", 1), ("c", 5), ("b", 7)]


def test_any_batch_again(spark):
    path, log = scratch_path(spark, "t"), sample(spark, 30)
    for batch, (low, high) in enumerate([(0, 10), (10, 20), (20, 30)]):
        publish_durable(log.where(f"seq > {low} AND seq <= {high}"), path, "one", ["seq"], F.col("ts"), batch)
    publish_durable(log, path, "two", ["seq"], F.col("ts"), 0)
    for batch, (low, high) in enumerate([(0, 10), (10, 20)]):
        publish_durable(log.where(f"seq > {low} AND seq <= {high}"), path, "one", ["seq"], F.col("ts"), batch)
    assert pairs(read_log(spark, path).where("stream = 'one'"), "seq") == [(n,) for n in range(1, 31)]
    told = pairs(finished_batches(spark, path), "stream", "batch", "first", "last", "rows")
    assert told == [("one", 0, 1, 10, 10), ("one", 1, 11, 20, 10), ("one", 2, 21, 30, 10), ("two", 0, 1, 30, 30)]
    assert pairs(noted_batches(spark, path), "stream", "batch", "first", "last", "rows") == told
    with pytest.raises(ValueError, match="had 10 messages"):
        publish_durable(log, path, "one", ["seq"], F.col("ts"), 1)
    publish_durable(log.limit(0), path, "one", ["seq"], F.col("ts"), 9)
    assert read_log(spark, path).count() == 60 and noted_batches(spark, path).count() == 4


def test_a_longer_batch_in_place_of_another(spark):
    path, log = scratch_path(spark, "t"), sample(spark, 30)
    write_log(log.where("seq <= 10"), path, 0)
    write_log(log, path, 0)
    publish_core(log, path, "s", F.col("ts"), writer="core")
    publish_durable(log, path, "s", ["seq"], F.col("ts"), writer="more")
    assert pairs(read_log(spark, path).where("seq IS NOT NULL"), "seq") == [(n,) for n in range(1, 61)]
    assert pairs(noted_batches(spark, path).where("writer IS NOT NULL"), "writer", "rows") == [("core", 30), ("main", 10), ("more", 30)]
    assert pairs(finished_batches(spark, path), "writer", "rows") == [("core", 30), ("main", 30), ("more", 30)]


def test_counts(spark, monkeypatch):
    monkeypatch.setattr(log_module, "COUNT_BUCKET", 8)
    path = scratch_path(spark, "t")
    write_log(sample(spark, 30), path)
    got = read_counts(spark, path).groupBy("subject", "bucket").agg(F.sum("rows").alias("n"), F.min("first").alias("low"))
    want = {}
    for i in range(30):
        want.setdefault((["a.x", "a.y", "b.x"][i % 3], (i + 1) // 8), []).append(i + 1)
    assert pairs(got, "subject", "bucket", "n", "low") == sorted((*k, len(v), min(v)) for k, v in want.items())


@pytest.mark.parametrize("seed", range(5))
def test_ranges_of_pulls(seed):
    draw, at, parts, numbers = random.Random(seed), 1, [], []
    for _ in range(20):
        own = sorted(draw.sample(range(at, at + 50), draw.randint(1, 40)))
        parts.append((len(own), own[0], own[-1]))
        numbers += own
        at += 50
    most = draw.randint(3, 90)
    cut = list(ranges(parts, most))
    assert all(a[1] < b[0] for a, b in zip(cut, cut[1:]))
    held = [sum(low <= n <= high for n in numbers) for low, high in cut]
    assert sum(held) == len(numbers) and max(held) <= most


@pytest.mark.parametrize("gaps", [False, True])
def test_pulls_take_part_of_a_batch(spark, gaps, monkeypatch):
    monkeypatch.setattr(log_module, "COUNT_BUCKET", 16)
    path, out, state = (scratch_path(spark, n) for n in ("log", "out", "checkpoint"))
    log = log_of(spark, [message("s", "a.x", n * (37 if gaps else 1)) for n in range(1, 101)])
    write_log(log.where("seq <= 2000"), path)
    subs = subscriptions(spark, [{"stream": "s", "subject": "a.*", "batch_size": b} for b in (30, 80)])
    start_consumer(spark, path, subs, out, state, F.lit(None).cast("timestamp_ntz")).awaitTermination()
    write_log(log.where("seq > 2000"), path)
    publish_core(log, path, "t", F.col("ts"))  # of another stream, without numbers
    start_consumer(spark, path, subs, out, state, F.lit(None).cast("timestamp_ntz")).awaitTermination()
    sizes = [r["count"] for r in spark.read.parquet(f"{out}/data").groupBy("batch", "split_id").count().collect()]
    assert max(sizes) <= 30 and len(sizes) >= 4
    assert pairs(emitted(spark, out), "split_id", "seq") == pairs(subscribe(log, subs), "split_id", "seq")


def test_pulls_while_running(spark):
    import time

    path, out, state = (scratch_path(spark, n) for n in ("log", "out", "checkpoint"))
    log = sample(spark, 60)
    write_log(log.where("seq <= 30"), path)
    subs = subscriptions(spark, [{"stream": "s", "subject": ">", "batch_size": 10}])
    query = start_consumer(spark, path, subs, out, state, F.lit(None).cast("timestamp_ntz"), available_now=False, interval="200 milliseconds")
    write_log(log.where("seq > 30"), path)
    until = time.monotonic() + 90
    while emitted(spark, out).count() < 60 and time.monotonic() < until:
        time.sleep(0.5)
    query.stop()
    assert emitted(spark, out).count() == 60
    while spark.streams.active and time.monotonic() < until:  # the cutting ends with it
        time.sleep(0.2)
    assert not spark.streams.active


@pytest.mark.parametrize("bound", [3, 16, 500])
def test_ends_by_counts(spark, bound, monkeypatch):
    for module in ("subjectlog.sources.log.COUNT_BUCKET", "subjectlog.operators.directory.COUNT_BUCKET"):
        monkeypatch.setattr(module, 8)
    monkeypatch.setattr("subjectlog.operators.directory._COARSE", 4)
    path, log = scratch_path(spark, "log"), sample(spark, 300)
    for low in (0, 100, 200):
        write_log(log.where(f"seq > {low} AND seq <= {low + 100}"), path)
    given = [{"subject": "a.*"}, {"subject": "a.x", "start_sequence": 21}, {"subject": ">", "start_sequence": 150}, {"subject": "b.x", "start_sequence": 299}]
    subs = subscriptions(spark, [{"stream": "s", "max_messages_to_read": bound} | g for g in given])
    assert pairs(subscribe_stored(spark, path, subs), "split_id", "seq") == pairs(subscribe(log, subs), "split_id", "seq")
    _, read = ends_by_counts(spark, path, positioned(subs))
    assert all(r["n"] == 1 for r in read.groupBy("split_id").agg(F.count_distinct("bucket").alias("n")).collect())
    saved = split_progress(subscribe(log.where("seq <= 60"), subs))
    assert pairs(subscribe_stored(spark, path, subs, saved), "split_id", "seq") == pairs(subscribe(log, subs, saved), "split_id", "seq")


def test_stored_subscriptions_of_all_kinds(spark):
    from helpers import T0
    from datetime import timedelta

    path, log = scratch_path(spark, "log"), sample(spark, 60)
    write_log(log, path)
    given = [
        {"subject": "a.*", "start_time": T0 + timedelta(seconds=20), "max_messages_to_read": 5},
        {"subject": "b.x", "max_messages_to_read": 4}, {"subject": "a.y", "durable_name": "d", "ack_behavior": "ExplicitButDoNotAck", "max_messages_to_read": 6},
    ]
    subs = subscriptions(spark, [{"stream": "s"} | g for g in given])
    acks = spark.createDataFrame([("d", "s", 5, T0), ("d", "s", 8, T0)], ACK)
    assert pairs(subscribe_stored(spark, path, subs, acks=acks), "split_id", "seq") == pairs(subscribe(log, subs, acks=acks), "split_id", "seq")
    one = subscriptions(spark, [{"stream": "s", "subject": "a.x"}])
    told = progress_by_counts(spark, path, one, 31).head()
    assert (told["last_emitted_seq"], told["messages"]) == (31, 11)
