"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time
from functools import reduce

from subjectlog.operators.subscribe import subscribe
from subjectlog.operators.subscriptions import subscriptions
from subjectlog.plans.queries import QUERIES
from subjectlog.scratch import scratch_path
from subjectlog.session import local_session
from subjectlog.sinks.fan_out import relay
from subjectlog.sources.log import read_log, stream_log, write_log
from subjectlog.streaming.relay import start_relay

HEADLINE = [
    "relay",
    "stream_scan",
    "subject_wildcard",
    "multi_subscription",
    "bounded_read",
    "resume_progress",
    "split_progress",
    "received_report",
    "word_count",
    "quiet_gaps",
    "decode_utf8",
    "ack_envelope",
    "pending_explicit",
    "redelivery_due",
    "work_queue_remaining",
    "validate_subscriptions",
    "parse_subscriptions",
    "publish_seq",
    "publish_durable",
    "stream_relay",
    "publish_twice",
    "stream_ordered",
    "redelivery_attempts",
    "many_subscriptions",
]
# Messages of the five-subscription workload: (stream, subject, messages).
DEMO = [("a", "ua", 100_000), ("b", "ub1", 30_000), ("b", "ub2", 70_000), ("b", "ub3", 50_000), ("b", "ub4", 90_000)]


def timed(run, times: int) -> float:
    seconds = []
    for _ in range(times):
        began = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - began)
    return statistics.median(seconds)


def demo_rates(spark) -> dict[str, float]:
    """Rows per second of copying 340,000 messages of five subscriptions to one subject: as a table, and as a stream
    that numbers them."""
    from pyspark.sql import functions as F

    parts = [
        spark.range(n).select(
            F.lit(stream).alias("stream"), F.lit(subject).alias("subject"), (F.col("id") + 1 + 10_000_000 * k).alias("seq"),
            F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("ts"),
            F.lit(None).cast("map<string,array<string>>").alias("headers"), F.lit(None).cast("string").alias("reply_to"),
            F.encode(F.concat(F.lit(f"data--{subject}--"), F.col("id").cast("string")), "UTF-8").alias("data"),
        )
        for k, (stream, subject, n) in enumerate(DEMO)
    ]
    path, total = scratch_path(spark, "demo"), sum(n for _, _, n in DEMO)
    write_log(reduce(lambda x, y: x.unionByName(y), parts), path)
    subs = subscriptions(spark, [{"stream": s, "subject": u} for s, u, _ in DEMO])

    def as_table() -> None:
        relay(subscribe(read_log(spark, path), subs), ["out"]).write.format("noop").mode("overwrite").save()

    def as_stream() -> None:
        sink, state = scratch_path(spark, "demo-sink"), scratch_path(spark, "demo-state")
        start_relay(stream_log(spark, path), sink, "sink", ["out"], state).awaitTermination()

    as_table(), as_stream()
    return {"relay_rows_per_sec": round(total / timed(as_table, 3)), "stream_rows_per_sec": round(total / timed(as_stream, 3))}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    wanted = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = local_session()
    seconds = {}
    for name in wanted:
        def run(name=name):
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

        run()  # warm up
        seconds[name] = round(timed(run, 3), 3)
    report = {
        "metric": "total seconds, headline queries, warm median",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "messages": sum(n for _, _, n in DEMO),
    }
    if not os.environ.get("BENCH_QUERIES"):
        report |= demo_rates(spark)
    print(json.dumps(report))


if __name__ == "__main__":
    main()
