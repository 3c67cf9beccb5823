import time
from datetime import datetime, timedelta

import pytest
from helpers import T0, pairs, sample
from pyspark.sql import functions as F

from subjectlog.operators.subscribe import subscribe
from subjectlog.operators.subscriptions import subscriptions
from subjectlog.schema import ACK, DELIVERY
from subjectlog.scratch import scratch_path
from subjectlog.sources.lines import stream_lines
from subjectlog.sources.log import read_log, stream_log, write_log
from subjectlog.streaming import consume
from subjectlog.streaming.consume import all_finished, emitted, ledger, progress, run_to_bound, start_consumer
from subjectlog.streaming.quiet import run_until_quiet
from subjectlog.streaming.redelivery import redeliver, redeliver_on_timers, state_settings
from subjectlog.streaming.relay import start_relay
from subjectlog.streaming.tail import live_tail


def settled_at():
    return F.lit(datetime(2024, 6, 1)).cast("timestamp_ntz")


@pytest.fixture
def paths(spark):
    return [scratch_path(spark, n) for n in ("log", "out", "checkpoint")]


def stored(spark, path, n=60):
    log = sample(spark, n)
    for batch in range(4):
        write_log(log.where(F.col("seq") > batch * n // 4).where(F.col("seq") <= (batch + 1) * n // 4), path, batch)
    return log


@pytest.mark.parametrize(
    "given",
    [
        [{"subject": "a.*", "start_sequence": 7}, {"subject": "a.x"}],
        [{"subject": "a.*", "ack_behavior": "NoAckUnordered"}],
        [{"subject": ">", "start_time": T0 + timedelta(seconds=31)}],
    ],
)
def test_stream_equals_batch(spark, paths, given):
    path, out, state = paths
    log = stored(spark, path)
    subs = subscriptions(spark, [{"stream": "s"} | g for g in given])
    start_consumer(spark, path, subs, out, state, settled_at(), batches_per_trigger=1).awaitTermination()
    want = pairs(subscribe(log, subs), "split_id", "seq")
    assert pairs(emitted(spark, out), "split_id", "seq") == want
    assert sum(r.messages for r in progress(spark, out).collect()) == len(want)
    assert ledger(spark, out).count() == 0


def test_bound_holds_across_batches_and_restarts(spark, paths):
    path, out, state = paths
    log = sample(spark)
    subs = subscriptions(spark, [{"stream": "s", "subject": t, "max_messages_to_read": 12} for t in ("a.x", "a.*", "b.x")])
    for batch, (low, high) in enumerate([(0, 20), (20, 30), (30, 60)]):
        write_log(log.where((F.col("seq") > low) & (F.col("seq") <= high)), path, batch)
        start_consumer(spark, path, subs, out, state, settled_at()).awaitTermination()
        assert all_finished(spark, out, subs) == (high == 60)
    assert pairs(emitted(spark, out), "split_id", "seq") == pairs(subscribe(log, subs), "split_id", "seq")
    assert [r.messages for r in progress(spark, out).collect()] == [12, 12, 12]


def test_crash_between_data_and_acknowledgement(spark, paths, monkeypatch):
    path, out, state = paths
    log = stored(spark, path)
    subs = subscriptions(
        spark,
        [{"stream": "s", "subject": "a.*", "ack_behavior": "AckAll", "durable_name": "d", "max_messages_to_read": 25}],
    )
    settle, calls = consume._settle, []

    def crash(*args):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("killed after the data was stored")
        settle(*args)

    monkeypatch.setattr(consume, "_settle", crash)
    with pytest.raises(Exception, match="killed"):
        start_consumer(spark, path, subs, out, state, settled_at(), batches_per_trigger=1).awaitTermination()
    stored_so_far = emitted(spark, out).count()
    floor = ledger(spark, out).agg(F.max("seq")).head()[0]
    assert stored_so_far > progress(spark, out).head().messages
    assert floor < emitted(spark, out).agg(F.max("seq")).head()[0]  # nothing acknowledged too early
    monkeypatch.setattr(consume, "_settle", settle)
    start_consumer(spark, path, subs, out, state, settled_at(), batches_per_trigger=1).awaitTermination()
    want = pairs(subscribe(log, subs), "seq")
    assert pairs(emitted(spark, out), "seq") == want
    row = progress(spark, out).head()
    assert (row.messages, row.last_emitted_seq, row.finished) == (25, want[-1][0], True)
    assert ledger(spark, out).where("consumer = 'd'").agg(F.max("seq")).head()[0] == want[-1][0]


def test_next_consumer_resumes_from_saved_state(spark, paths):
    path, out, state = paths
    log = stored(spark, path)
    subs = subscriptions(spark, [{"stream": "s", "subject": "a.*", "max_messages_to_read": 30}])
    half = subscribe(log.where("seq <= 20"), subs)
    from subjectlog.operators.progress import split_progress

    saved = split_progress(half)
    start_consumer(spark, path, subs, out, state, settled_at(), saved=saved).awaitTermination()
    both = pairs(half, "seq") + pairs(emitted(spark, out), "seq")
    assert both == pairs(subscribe(log, subs), "seq")


def test_bounded_consumer_stops_by_itself(spark, paths):
    path, out, state = paths
    stored(spark, path)
    subs = subscriptions(spark, [{"stream": "s", "subject": "a.x", "max_messages_to_read": 5}])
    query = start_consumer(spark, path, subs, out, state, settled_at(), available_now=False, interval="1 second")
    run_to_bound(query, spark, out, subs)
    assert not query.isActive
    assert emitted(spark, out).count() == 5


def test_live_subjects_see_only_what_comes_after(spark, paths):
    path, out, state = paths
    log = sample(spark)
    write_log(log.where("seq <= 30"), path, 0)
    live_tail(spark, path, "s", ["a.*", "a.x"], state)

    def run():
        live = live_tail(spark, path, "s", ["a.*", "a.x"], state)  # as a new process would
        writer = live.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
        writer.trigger(availableNow=True).start().awaitTermination()
        return pairs(spark.read.schema(live.schema).parquet(out), "seq")

    assert run() == []
    write_log(log.where("seq > 30"), path, 1)
    got = run()
    assert got == sorted([(i,) for i in range(31, 61) if i % 3] + [(i,) for i in range(31, 61) if i % 3 == 1])
    assert run() == got  # down and up again: nothing twice


def test_many_subscriptions_and_files_out_of_order(spark, paths, monkeypatch):
    """More subscriptions than a local table may have, and log files whose times are not their order."""
    import os

    from subjectlog.operators import attach

    path, out, state = paths
    log = sample(spark)
    monkeypatch.setattr(attach, "BROADCAST_ROWS", 2)
    for low in (0, 30):
        write_log(log.where((F.col("seq") > low) & (F.col("seq") <= low + 30)).repartition(4), path)
    root = path.removeprefix("file:")
    files = sorted(os.path.join(d, f) for d, _, names in os.walk(root) if "_" not in os.path.basename(d)[:1] for f in names if f.endswith(".parquet") and "_finished" not in d)
    for k, f in enumerate(files):
        os.utime(f, (1_700_000_000 - k * 100,) * 2)
    subs = subscriptions(spark, [{"stream": "s", "subject": t, "max_messages_to_read": 7} for t in ("a.x", "a.*", "b.x", ">")])
    start_consumer(spark, path, subs, out, state, settled_at(), batches_per_trigger=1).awaitTermination()
    assert pairs(emitted(spark, out), "split_id", "seq") == pairs(subscribe(log, subs), "split_id", "seq")


def test_new_checkpoint_adds_to_the_output(spark, paths):
    path, out, state = paths
    log = stored(spark, path)
    subs = subscriptions(spark, [{"stream": "s", "subject": "a.x"}])
    for checkpoint in (state, state + "-2"):
        start_consumer(spark, path, subs, out, checkpoint, settled_at()).awaitTermination()
    assert emitted(spark, out).count() == 2 * subscribe(log, subs).count()
    assert [r.messages for r in progress(spark, out).collect()] == [20]


def test_explicit_acknowledgements_count_on_streams(spark, paths):
    path, out, state = paths
    log = stored(spark, path)
    given = {"stream": "s", "subject": "a.*", "ack_behavior": "ExplicitButDoNotAck", "durable_name": "d", "batch_size": 20}
    subs = subscriptions(spark, [given])
    acks = log.where("seq % 2 = 0").select(F.lit("d").alias("consumer"), "stream", "seq", settled_at().alias("acked_at"))
    start_consumer(spark, path, subs, out, state, settled_at(), acks=acks).awaitTermination()
    assert pairs(emitted(spark, out), "seq") == pairs(subscribe(log, subs, acks=acks), "seq") == [
        (n,) for n in range(1, 61, 2) if n % 3
    ]
    assert spark.read.parquet(f"{out}/data").select("batch").distinct().count() > 1  # batch_size 20: a log batch each


def test_unnumbered_messages(spark, paths):
    from subjectlog.sinks.publish import publish_core

    path, out, state = paths
    publish_core(sample(spark, 30), path, "s", F.col("ts"))
    log = read_log(spark, path)
    read = lambda **given: subscribe(log, subscriptions(spark, [{"stream": "s", "subject": "a.*"} | given])).count()
    assert (read(), read(start_sequence=2), read(max_messages_to_read=5)) == (20, 0, 0)
    assert read(start_time=T0 + timedelta(seconds=16)) == 10


@pytest.mark.parametrize("durable", [True, False])
def test_relay_restarts_without_duplicates(spark, paths, durable, monkeypatch):
    path, out, state = paths
    log = stored(spark, path)
    from subjectlog.streaming import relay as relay_module

    name = "publish_durable" if durable else "publish_core"
    publish, calls = getattr(relay_module, name), []

    def crash(*args, **kwargs):
        publish(*args, **kwargs)
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("killed after publishing")

    monkeypatch.setattr(relay_module, name, crash)
    start = lambda: start_relay(stream_log(spark, path, 1), out, "out", ["o.a", "o.b"], state, durable=durable)
    with pytest.raises(Exception, match="killed"):
        start().awaitTermination()
    start().awaitTermination()
    got = read_log(spark, out)
    assert got.count() == 2 * log.count()
    if durable:
        assert pairs(got, "seq") == [(n,) for n in range(1, 121)]


def test_text_lines_to_subject_counts(spark, paths, tmp_path):
    _, out, state = paths
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "words.txt").write_text("One\ntwo\none\nTWO\nthree\none\n")
    lines = stream_lines(spark, str(tmp_path / "w"))
    records = lines.select(
        F.lit("in").alias("stream"), F.lit("words").alias("subject"), F.lit(0).cast("long").alias("seq"),
        F.lit(T0).cast("timestamp_ntz").alias("ts"), F.lit(None).cast("map<string,array<string>>").alias("headers"),
        F.lit(None).cast("string").alias("reply_to"), F.encode("value", "UTF-8").alias("data"),
    )
    start_relay(records, out, "sink", ["words.out"], state, order_by=["data", "target"]).awaitTermination()
    from subjectlog.operators.reports import word_count

    assert dict(word_count(read_log(spark, out), F.col("data").cast("string")).collect()) == {"one": 3, "two": 2, "three": 1}


def test_stops_when_quiet_or_complete(spark, paths):
    path, out, state = paths
    stored(spark, path)
    writer = stream_log(spark, path).writeStream.format("noop").option("checkpointLocation", state)
    query = writer.trigger(processingTime="200 milliseconds").start()
    assert run_until_quiet(query, quiet_seconds=60, expected=60) == 60
    began = time.monotonic()
    query = writer.trigger(processingTime="200 milliseconds").start()
    run_until_quiet(query, quiet_seconds=2)
    assert not query.isActive and time.monotonic() - began < 30


def ledger_files(spark):
    sent, done = scratch_path(spark, "sent"), scratch_path(spark, "acked")
    at = lambda s: T0 + timedelta(seconds=s)
    deliveries = [("c", "s", n, at(n), 1) for n in (1, 2, 3, 4)] + [("c", "s", 100, at(100), 1)]
    acks = [("c", "s", 2, at(3)), ("c", "s", 3, at(50)), ("c", "s", 100, at(100))]
    spark.createDataFrame(deliveries, DELIVERY).coalesce(1).write.parquet(sent)
    spark.createDataFrame(acks, ACK).coalesce(1).write.parquet(done)
    return spark.readStream.schema(DELIVERY).parquet(sent), spark.readStream.schema(ACK).parquet(done)


def run_append(spark, df):
    out, state = scratch_path(spark, "again"), scratch_path(spark, "checkpoint")
    writer = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


def test_redelivery_by_join(spark):
    again = redeliver(*ledger_files(spark), 10_000)
    # 2 was acknowledged in time; 3 too late, so it came again first.
    assert pairs(run_append(spark, again), "seq", "attempt") == [(1, 2), (3, 2), (4, 2)]


def test_redelivery_on_timers(spark):
    with state_settings(spark):
        again = redeliver_on_timers(*ledger_files(spark), 10_000, "EventTime")
        # One batch holds the late acknowledgement as well, so 3 is settled before its timer.
        assert pairs(run_append(spark, again).distinct(), "seq", "attempt") == [(1, 2), (4, 2)]
