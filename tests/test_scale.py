"""Work that must not grow with the input in one place: broadcasts, triggers, state calls, patterns."""

import os
import re
import time
from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from helpers import T0, log_of, message, pairs
from pyspark.sql import functions as F

from subjectlog import scratch
from subjectlog.functions import text
from subjectlog.operators import attach as attach_module
from subjectlog.operators import ranges
from subjectlog.operators import subscribe as subscribing
from subjectlog.operators.attach import attach, small_rows
from subjectlog.operators.ranges import take_ranges
from subjectlog.operators.subscribe import positioned, subscribe
from subjectlog.operators.subscriptions import packed, subscriptions, unpacked
from subjectlog.plans.queries import QUERIES
from subjectlog.schema import ACK, DELIVERY
from subjectlog.scratch import scratch_path
from subjectlog.sources.log import write_log
from subjectlog.streaming import pulls, redelivery
from subjectlog.streaming.consume import emitted, start_consumer


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def events_in(spark, n=300):
    path = scratch_path(spark, "tables")
    kinds = ["click", "view", "error", "signup"]
    rows = [(i, T0 + timedelta(minutes=i), i % 100, kinds[i % 4], float(i), f'{{"k": {i % 90}}}') for i in range(n)]
    names = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(rows, names).write.parquet(f"{path}/events.parquet")
    return path


def test_documents_are_not_broadcast(spark):
    found = QUERIES["source_documents"](spark, events_in(spark))
    assert "Broadcast" not in plan(found)
    # of the rows that have a stream and a subject
    assert found.count() == sum(i % 90 not in (7, 11) for i in range(300))


def test_large_sides_are_not_broadcast(spark):
    big, small = spark.range(100), spark.range(50).withColumn("x", F.lit(1))
    assert "Broadcast" not in plan(attach(big, small, ["id"], limit=10))
    assert "Broadcast" in plan(attach(big, small, ["id"], limit=50))


class Handle:
    """One key's state and timers, counting the calls."""

    def __init__(self):
        self.value, self.timers, self.calls = None, [], 0

    def getValueState(self, name, schema, ttl=None):
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def registerTimer(self, at):
        self.calls += 1
        self.timers.append(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.remove(at)


class Clock:
    def __init__(self, processing, watermark=0):
        self.processing, self.watermark = processing, watermark

    def getCurrentProcessingTimeInMs(self):
        return self.processing

    def getCurrentWatermarkInMs(self):
        return self.watermark


class Went:
    def __init__(self, at):
        self.at = at

    def getExpiryTimeInMs(self):
        return self.at


def timed(event_time, ttl=1000):
    handle = Handle()
    made = redelivery._Redeliver(10, ttl, event_time)
    made.init(handle)
    return made, handle


def rows(*given):
    return iter([pd.DataFrame([(seq, attempt, acked, at) for seq, attempt, acked, at in given], columns=["seq", "attempt", "acked", "at_ms"])])


def test_timers_of_a_bucket(spark):
    made, handle = timed(True)
    made.handleInputRows(("c", "s", 0), rows(*[(n, 1, False, 100 + n) for n in range(500)], *[(n, 0, True, 0) for n in range(0, 500, 2)]), Clock(0))
    assert handle.calls <= 4 and handle.timers == [111]  # of message 1, sent at 101
    out = pd.concat(made.handleExpiredTimer(("c", "s", 0), Clock(0, 116), Went(111)))
    assert out.values.tolist() == [["s", 1, "c", 2, 111], ["s", 3, "c", 2, 113], ["s", 5, "c", 2, 115]]
    assert handle.timers == [111, 117]  # Spark removes the one that went off
    handle.timers.remove(111)
    # an older attempt changes nothing, an acknowledgement ends it, a delivery later on starts again
    made.handleInputRows(("c", "s", 0), rows((1, 1, False, 900), (7, 0, True, 0), (9, 2, False, 200)), Clock(0))
    assert handle.timers == [121]
    out = pd.concat(made.handleExpiredTimer(("c", "s", 0), Clock(0, 127), Went(121)))
    assert out[["seq", "attempt"]].values.tolist() == [[1, 3], [3, 3], [5, 3], [11, 2], [13, 2], [15, 2]]


def test_timers_on_the_clock_forget_what_is_settled(spark):
    made, handle = timed(False, ttl=50)
    made.handleInputRows(("c", "s", 0), rows((1, 0, True, 0), (2, 1, False, 0)), Clock(100))
    made.handleInputRows(("c", "s", 0), rows((3, 1, False, 0)), Clock(140))
    assert len(handle.value[0]) == 3 * np.dtype(redelivery._MESSAGE).itemsize and handle.timers == [110]
    made.handleInputRows(("c", "s", 0), rows((1, 1, False, 0)), Clock(145))  # its acknowledgement came first
    assert handle.timers == [110]
    made.handleInputRows(("c", "s", 0), rows((3, 1, False, 0)), Clock(200))
    assert np.frombuffer(handle.value[0], redelivery._MESSAGE)["seq"].tolist() == [2, 3]


def test_timers_keep_keys_apart(spark):
    """Consumers, streams and buckets, and messages without a number, as a stream."""
    sent, done = scratch_path(spark, "sent"), scratch_path(spark, "acked")
    out, state = scratch_path(spark, "again"), scratch_path(spark, "checkpoint")
    seqs = [1, redelivery._TIMED - 1, redelivery._TIMED, 5 * redelivery._TIMED, None]
    given = [(c, s, n, T0 + timedelta(seconds=k), 1) for c in "ab" for s in "xy" for k, n in enumerate(seqs)]
    acked = [("a", "x", 1, T0), ("b", "y", redelivery._TIMED, T0), ("b", "x", None, T0), ("a", "x", 9, T0 + timedelta(seconds=500))]
    spark.createDataFrame(given, DELIVERY).write.parquet(sent)
    spark.createDataFrame(acked, ACK).write.parquet(done)
    streams = [spark.readStream.schema(s).parquet(p) for s, p in ((DELIVERY, sent), (ACK, done))]
    with redelivery.state_settings(spark):
        again = redelivery.redeliver_on_timers(*streams, 10_000, "EventTime")
        writer = again.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
        writer.trigger(availableNow=True).start().awaitTermination()
    got = {tuple(r) for r in spark.read.schema(again.schema).parquet(out).select("consumer", "stream", "seq").collect()}
    assert got == {g[:3] for g in given} - {a[:3] for a in acked}


@pytest.mark.parametrize("together", [1, 3])
def test_joined_pulls(together):
    cut = [(0, 1, 5), (0, 6, 10), (1, None, None), (2, 11, 15), (2, 16, 20), (2, 21, 22)]
    found = list(pulls.joined(iter(cut), together))
    want = {1: [[c] for c in cut], 3: [[(0, 1, 10), (1, None, None)], [(2, 11, 22)]]}
    assert found == want[together]


def test_triggers_do_not_grow_with_the_backlog(spark):
    path, out, state = (scratch_path(spark, n) for n in ("log", "out", "checkpoint"))
    log = log_of(spark, [message("s", "a.x", n) for n in range(1, 61)])
    write_log(log, path)
    subs = subscriptions(spark, [{"stream": "s", "subject": "a.*", "ack_behavior": "ExplicitButDoNotAck", "durable_name": "d", "batch_size": 2}])
    acks = log.where("seq % 3 = 0").select(F.lit("d").alias("consumer"), "stream", "seq", F.lit(T0).cast("timestamp_ntz").alias("acked_at"))
    start_consumer(spark, path, subs, out, state, F.lit(None).cast("timestamp_ntz"), acks=acks).awaitTermination()
    assert pairs(emitted(spark, out), "seq") == [(n,) for n in range(1, 61) if n % 3]
    assert spark.read.parquet(f"{out}/data").select("batch").distinct().count() <= pulls.PULLS_APART


def test_many_positions_are_written_once(spark):
    log = log_of(spark, [message("s", f"a.{i % 3}", i + 1) for i in range(40)])
    given = {"stream": "s", "max_messages_to_read": 3}
    subs = subscriptions(spark, [given | {"subject": s, "start_sequence": k} for s in ("a.0", "a.1", "a.*") for k in range(1, 30)])
    positions, rows_ = subscribing.settled(positioned(subs), 10)
    assert rows_ is None and "FileScan parquet" in plan(positions)
    assert "Broadcast" not in plan(take_ranges(log, positions, limit=0))
    assert pairs(subscribe(log, subs, limit=10), "split_id", "seq") == pairs(subscribe(log, subs), "split_id", "seq")


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = manager.getAllFiles().mkString(" ").split()
    return {n for n in names if n.endswith(".data") and "/shuffle_" in n}


def soon(found, seconds=20):
    """Files are removed beside the work."""
    end = time.monotonic() + seconds
    while not found() and time.monotonic() < end:
        time.sleep(0.2)
    return found()


def test_what_is_written_leaves_no_shuffles(spark):
    before, setting = shuffle_files(spark), spark.conf.get(scratch._FREED)
    halves = spark.range(1000).groupBy((F.col("id") % 500).alias("half")).count()
    kept = scratch.materialise(halves, scratch_path(spark, "halves"), lean=True)
    assert small_rows(halves, 10) is None
    assert soon(lambda: not shuffle_files(spark) - before)
    assert kept.count() == 500 and spark.conf.get(scratch._FREED) == setting


def test_ids_are_moved_packed(spark):
    digest = "0123456789abcdef" * 2
    own = [f"{crc}-{digest}" for crc in ("0", "1", "ABC", "A00", "10000000", "FFFFFFFF")]
    others = [f"{crc}-{digest}" for crc in ("", "0ABC", "abc", "123456789")] + [own[1] + "\n", own[1].upper(), "", "x", "\x01x", "\u00e9", None]
    ids = spark.createDataFrame([(s,) for s in own + others], "split_id string")
    moved = ids.select(F.col("split_id").alias("given"), packed())
    back = moved.select("given", F.length("split_id").alias("bytes"), unpacked()).collect()
    assert [r.split_id for r in back] == [r.given for r in back] == own + others
    assert [r.bytes for r in back][: len(own)] == [21] * len(own)
    log = log_of(spark, [message("s", f"a.{i % 3}", i + 1) for i in range(40)])
    subs = subscriptions(spark, [{"stream": "s", "subject": "a.*", "start_sequence": k, "max_messages_to_read": 3} for k in range(1, 30)])
    met = ranges._taken(log, positioned(subs), 0)
    assert dict(met.dtypes)["split_id"] == "binary"
    assert pairs(take_ranges(log, positioned(subs), 0), "split_id", "seq") == pairs(subscribe(log, subs), "split_id", "seq")


def test_many_subscriptions_keep_little(spark, monkeypatch):
    """What many subscriptions take on disk is gone when it was read, but for the tables that are asked for."""
    path, root = events_in(spark, 60), scratch.scratch_root(spark).removeprefix("file:")
    before, shuffles = set(os.listdir(root)), shuffle_files(spark)
    monkeypatch.setattr(attach_module, "BROADCAST_ROWS", 10)
    got = QUERIES["many_subscriptions"](spark, path)
    left = lambda: {n.split("-")[0] for n in set(os.listdir(root)) - before}
    assert soon(lambda: left() <= {"subscriptions", "log", "consumer", "checkpoint", "batch"})
    assert soon(lambda: not shuffle_files(spark) - shuffles)
    kinds = [i % 4 for i in range(60)]
    want = []
    for i in range(60):
        same = [j for j in range(i, 60) if kinds[j] == kinds[i]]
        for way in ("batch", "stream"):
            want += [(way, bound, i + 1, j + 1) for bound in (1, 2) for j in same[:bound]]
    assert sorted(map(tuple, got.select("way", "bound", "low", "seq").collect())) == sorted(want)


@pytest.mark.parametrize("charset", ["windows-1252", "KOI8-R", "cp437", "cp037", "ISO-8859-7"])
def test_single_byte_patterns_are_short(spark, charset):
    table = text._single_byte(charset)
    known = text._known(table)
    assert len(re.findall(r"-", known)) < len([c for c in set(table) if c]) / 2  # ranges, not characters
    given = ["", "plain ascii \x00\x7f", "café € жЖ │ α", "\U0001f600x\x85", "-]^[&&\\", "".join(c for c in table if c), None]
    frame = spark.createDataFrame([(k, s) for k, s in enumerate(given)], "k int, s string")
    made = frame.select("k", text.encode_charset(F.col("s"), charset).alias("b")).orderBy("k").collect()
    want = [None if s is None else s.encode(charset, "replace") for s in given]
    assert [None if r.b is None else bytes(r.b) for r in made] == want
    raw = [bytes(range(256)), bytes(range(128)), b"", b"\xe9\x80abc"]
    read = spark.createDataFrame([(k, b) for k, b in enumerate(raw)], "k int, b binary")
    got = read.select("k", text.decode_charset(F.col("b"), charset).alias("s")).orderBy("k").collect()
    assert [r.s for r in got] == [b.decode(charset, "replace") for b in raw]
