from datetime import timedelta

from helpers import T0, log_of, message, pairs
from pyspark.sql import functions as F

from subjectlog.operators import acks as A
from subjectlog.operators.progress import merge_progress, progress_json, split_progress
from subjectlog.operators.reports import received_report, reconcile, word_count
from subjectlog.schema import ACK, DELIVERY, PROGRESS


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def now(seconds):
    return F.lit(at(seconds)).cast("timestamp_ntz")


def ledger(spark):
    sent = [("c", "s", n, at(n), 1) for n in range(1, 9)] + [("c", "s", 3, at(40), 2), ("e", "s", 1, at(1), 1)]
    acked = [("c", "s", 1, at(9)), ("c", "s", 5, at(9)), ("x", "s", 2, at(9)), ("c", "t", 8, at(9))]
    return spark.createDataFrame(sent, DELIVERY), spark.createDataFrame(acked, ACK)


def test_pending(spark):
    sent, acked = ledger(spark)
    explicit = [("c", n) for n in (2, 3, 3, 4, 6, 7, 8)] + [("e", 1)]
    assert pairs(A.pending_explicit(sent, acked), "consumer", "seq") == explicit
    for limit in (None, 0):
        cumulative = A.pending_cumulative(sent, acked, limit=limit)
        assert pairs(cumulative, "consumer", "seq") == [("c", 6), ("c", 7), ("c", 8), ("e", 1)]


def test_redelivery_counts_from_the_last_attempt(spark):
    sent, acked = ledger(spark)
    wait = F.lit(10_000_000_000)
    due = A.redelivery_due(sent, acked, wait, now(14))
    assert pairs(due, "consumer", "seq", "attempt") == [("c", 2, 2), ("c", 4, 2), ("e", 1, 2)]
    later = A.redelivery_due(sent, acked, wait, now(50))
    assert ("c", 3, 3) in pairs(later, "consumer", "seq", "attempt")


def test_expiry(spark):
    sent, _ = ledger(spark)
    registry = spark.createDataFrame([("c", 5_000_000_000), ("e", None), ("never", 1)], "consumer string, inactive_threshold long")
    assert A.expired_consumers(sent, registry, now(45)).count() == 0
    assert pairs(A.expired_consumers(sent, registry, now(46)), "consumer") == [("c",)]


def test_work_queue_and_ack_messages(spark):
    log = log_of(spark, [message("s", "a", n) for n in range(1, 5)])
    _, acked = ledger(spark)
    assert pairs(A.work_queue_remaining(log, acked), "seq") == [(3,), (4,)]
    sent = A.ack_messages(log.withColumn("reply_to", F.when(F.col("seq") > 1, F.col("reply_to"))))
    assert [(s, bytes(d)) for s, d in pairs(sent, "subject", "data")] == [(f"$ACK.s.{n}", b"+ACK") for n in (2, 3, 4)]
    last = A.ack_last(log, F.lit("c"), now(0))
    assert pairs(last, "consumer", "stream", "seq") == [("c", "s", 4)]


def test_progress_adds_up(spark):
    log = log_of(spark, [message("s", "a", n) for n in range(1, 8)]).withColumns({"split_id": F.lit("i"), "n": F.lit(5)})
    parts = [split_progress(log.where("seq <= 4"), bound="n"), split_progress(log.where("seq > 4"), bound="n")]
    assert [p.head().finished for p in parts] == [False, False]
    both = parts[0].unionByName(parts[1])
    subs = spark.createDataFrame([("i", 5)], "split_id string, max_messages_to_read long")
    assert tuple(merge_progress(both, subs).head()) == ("i", 7, "$ACK.s.7", 7, True)
    assert merge_progress(both).head().finished is False


def test_progress_json(spark):
    df = spark.createDataFrame([("i", -1, None, 0, False), ("j", 3, "r", 2, True)], PROGRESS)
    assert sorted(r[0] for r in df.select(progress_json()).collect()) == [
        '{"last_emitted_seq":3,"last_reply_to":"r","messages":2,"finished":true}',
        '{"messages":0}',
    ]


def test_reports(spark):
    log = log_of(spark, [message("s", t, i + 1) for i, t in enumerate(["b", "A", "a", "b", "C"])])
    listed = [(r.subject, r.n) for r in received_report(log).collect()]
    assert listed == [("A", 1), ("a", 1), ("b", 2), ("C", 1), ("TOTAL", 5)]
    lost = log.where("seq <> 4 and subject <> 'C'").unionByName(log_of(spark, [message("s", "new", 9)]))
    got = {r.subject: (r.expected, r.received) for r in reconcile(log, lost).collect()}
    assert got == {"b": (2, 1), "C": (1, None), "new": (None, 1)}
    words = spark.createDataFrame([("The cat, the Hat",), ("",)], "value string")
    assert dict(word_count(words, F.col("value")).collect()) == {"the": 2, "cat": 1, "hat": 1}
