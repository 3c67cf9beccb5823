"""Queries over the acknowledgement ledger."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import local_time
from ..operators.acks import (
    ack_floor,
    ack_rows,
    expired_consumers,
    pending_cumulative,
    pending_explicit,
    redelivery_due,
    work_queue_remaining,
)
from ..operators.intervals import compacted_ledger, explicit_floor, pending_intervals
from ..schema import ACK_BODY
from .catalog import query
from .sample_log import EV, LEDGER, NOW, acks, consumer, deliveries, events, table


def _now():
    return local_time(NOW)


@query("ack_floor", f"WITH {LEDGER} SELECT consumer, stream, max(seq) AS floor FROM ack GROUP BY 1, 2")
def ack_floor_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ack_floor(acks(spark, sf_dir))


@query(
    "pending_all",
    f"""WITH {LEDGER}, early AS (SELECT * FROM ack WHERE acked_at < TIMESTAMP '2024-01-16'),
    f AS (SELECT consumer, max(seq) AS floor FROM early GROUP BY 1)
    SELECT d.consumer, d.seq FROM delivery d LEFT JOIN f USING (consumer) WHERE d.seq > coalesce(f.floor, 0)""",
)
def pending_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    early = acks(spark, sf_dir).where(F.col("acked_at") < local_time(datetime(2024, 1, 16)))
    return pending_cumulative(deliveries(spark, sf_dir), early).select("consumer", "seq")


@query(
    "pending_explicit",
    f"WITH {LEDGER} SELECT d.consumer, d.seq FROM delivery d ANTI JOIN ack a ON a.seq = d.seq AND a.consumer = d.consumer",
)
def pending_explicit_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pending_explicit(deliveries(spark, sf_dir), acks(spark, sf_dir)).select("consumer", "seq")


_RUNS = """sent AS (SELECT d.consumer, d.stream, d.seq, (d.consumer, d.seq) IN (SELECT (consumer, seq) FROM ack) AS acked FROM delivery d),
  numbered AS (SELECT *, row_number() OVER (PARTITION BY consumer ORDER BY seq)
    - row_number() OVER (PARTITION BY consumer, acked ORDER BY seq) AS run FROM sent),
  runs AS (SELECT consumer, stream, min(seq) AS low, max(seq) AS high, count(*) AS messages FROM numbered WHERE acked
    GROUP BY consumer, stream, run)"""


@query("compacted_ledger", f"WITH {LEDGER}, {_RUNS} SELECT consumer, stream, low, high, messages FROM runs")
def compacted_ledger_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compacted_ledger(deliveries(spark, sf_dir), acks(spark, sf_dir))


@query(
    "explicit_floor",
    f"""WITH {LEDGER}, {_RUNS}, f AS (SELECT consumer, stream, min(seq) AS first FROM delivery GROUP BY 1, 2),
    p AS (SELECT d.consumer, d.seq FROM delivery d ANTI JOIN ack a ON a.seq = d.seq AND a.consumer = d.consumer)
    SELECT 'floor' AS what, consumer, coalesce((SELECT high FROM runs r WHERE r.consumer = f.consumer AND r.low = f.first), 0) AS seq FROM f
    UNION ALL SELECT 'pending', consumer, seq FROM p""",
)
def explicit_floor_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each consumer that acknowledges one by one: up to where all is done, and what is open, both from intervals."""
    sent = deliveries(spark, sf_dir)
    intervals = compacted_ledger(sent, acks(spark, sf_dir))
    floors = explicit_floor(sent, intervals).select(F.lit("floor").alias("what"), "consumer", F.col("floor").alias("seq"))
    return floors.unionByName(pending_intervals(sent, intervals).select(F.lit("pending").alias("what"), "consumer", "seq"))


@query(
    "redelivery_due",
    f"""WITH {LEDGER} SELECT d.consumer, d.stream, d.seq, TIMESTAMP '2024-01-20' AS delivered_at, CAST(2 AS INTEGER) AS attempt
    FROM delivery d ANTI JOIN ack a ON a.seq = d.seq AND a.consumer = d.consumer
    WHERE d.delivered_at + INTERVAL 30 SECOND <= TIMESTAMP '2024-01-20'""",
)
def redelivery_due_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    wait = F.lit(30_000_000_000)
    return redelivery_due(deliveries(spark, sf_dir), acks(spark, sf_dir), wait, _now())


_REGISTRY = """last AS (SELECT user_id, max(ts) AS last_active FROM events GROUP BY 1)"""


@query(
    "expired_consumers",
    f"""WITH {_REGISTRY} SELECT 'u' || user_id AS consumer, last_active FROM last
    WHERE last_active + to_milliseconds((user_id % 5) * 3600 * 1000) < TIMESTAMP '2024-01-30' AND user_id % 5 > 0""",
)
def expired_consumers_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user is a consumer, with a threshold of 1 to 4 hours, or none."""
    used = table(spark, sf_dir, "events")
    who = F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("consumer")
    activity = used.select(who, F.col("ts").alias("delivered_at"))
    hours = F.col("user_id") % 5
    threshold = F.when(hours > 0, hours * 3_600_000_000_000).alias("inactive_threshold")
    registry = used.select("user_id").distinct().select(who, threshold)
    now = local_time(datetime(2024, 1, 30))
    return expired_consumers(activity, registry, now).select("consumer", "last_active")


@query("work_queue_remaining", f"WITH {LEDGER} SELECT e.subject, e.seq FROM ev e ANTI JOIN ack a ON a.seq = e.seq")
def work_queue_remaining_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return work_queue_remaining(events(spark, sf_dir), acks(spark, sf_dir)).select("subject", "seq")


@query(
    "ack_append",
    f"""WITH {EV} SELECT 'c' || (user_id % 4) AS consumer, seq, ts AS acked_at, reply_to AS subject, '+ACK' AS body FROM ev""",
)
def ack_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger row of each message, beside the message that acknowledges it."""
    log = events(spark, sf_dir)
    rows = ack_rows(log.withColumn("who", consumer()), F.col("who"), F.col("ts"), "reply_to")
    return rows.select("consumer", "seq", "acked_at", F.col("reply_to").alias("subject"), F.lit(ACK_BODY).alias("body"))
