"""The acknowledgement ledger: floors, pending messages, redelivery, expiry, work queues.

Joins use (stream, seq, consumer): sequence numbers spread a busy consumer over all tasks.
``now`` is always an argument.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import encode_utf8
from ..functions.times import nanos_interval
from ..schema import ACK_BODY, CUMULATIVE
from .attach import attach
from .match import match

MESSAGE_KEY = ["stream", "seq", "consumer"]


def ack_floor(acks: DataFrame) -> DataFrame:
    """Cumulative acknowledgement: everything up to ``floor`` is acknowledged."""
    return acks.groupBy("consumer", "stream").agg(F.max("seq").alias("floor"))


def pending_cumulative(deliveries: DataFrame, acks: DataFrame, limit: int | None = None) -> DataFrame:
    known = attach(deliveries, ack_floor(acks), ["consumer", "stream"], "left", limit=limit)
    return known.where(F.col("seq") > F.coalesce("floor", F.lit(0))).drop("floor")


def pending_explicit(deliveries: DataFrame, acks: DataFrame) -> DataFrame:
    return deliveries.join(acks.select(*MESSAGE_KEY), MESSAGE_KEY, "left_anti")


def redelivery_due(deliveries: DataFrame, acks: DataFrame, ack_wait: Column, now: Column) -> DataFrame:
    """Unacknowledged messages whose last delivery is ``ack_wait`` nanoseconds old, as their
    next delivery."""
    last = deliveries.groupBy(*MESSAGE_KEY).agg(
        F.max("attempt").alias("attempt"), F.max("delivered_at").alias("delivered_at")
    )
    due = pending_explicit(last, acks).where(F.col("delivered_at") + nanos_interval(ack_wait) <= now)
    return due.select(
        "consumer", "stream", "seq", now.alias("delivered_at"), (F.col("attempt") + 1).cast("int").alias("attempt")
    )


def expired_consumers(activity: DataFrame, registry: DataFrame, now: Column) -> DataFrame:
    """Consumers of ``registry(consumer, inactive_threshold)`` idle for longer than their
    threshold; those without one, or never active, do not expire."""
    last = activity.groupBy("consumer").agg(F.max("delivered_at").alias("last_active"))
    idle = last.join(registry, "consumer").where(F.col("inactive_threshold") > 0)
    return idle.where(F.col("last_active") + nanos_interval(F.col("inactive_threshold")) < now)


def work_queue_remaining(messages: DataFrame, acks: DataFrame, consumers: DataFrame | None = None) -> DataFrame:
    """A work-queue stream keeps a message until any consumer acknowledges it.

    ``consumers`` are subscriptions with a durable name.  A consumer that acknowledges cumulatively has acknowledged
    all that its subject matches up to its floor; without ``consumers`` each row of ``acks`` is one message.
    """
    single = acks
    if consumers is not None:
        named = consumers.where("durable_name IS NOT NULL").select(
            F.col("durable_name").alias("consumer"), "stream", "subject", "ack_behavior"
        )
        cumulative = named.where(F.col("ack_behavior").isin(CUMULATIVE)).drop("ack_behavior")
        single = acks.join(cumulative.select("consumer", "stream").distinct(), ["consumer", "stream"], "left_anti")
        floors = ack_floor(acks).join(cumulative, ["consumer", "stream"]).drop("consumer")
        covered = match(messages.where("seq IS NOT NULL").select("stream", "subject", "seq"), floors)
        done = covered.where(F.col("seq") <= F.col("floor")).select("stream", "seq")
        messages = messages.join(done, ["stream", "seq"], "left_anti").select(*messages.columns)
    return messages.join(single.select("stream", "seq"), ["stream", "seq"], "left_anti").select(*messages.columns)


def ack_rows(emitted: DataFrame, consumer: Column, acked_at: Column, *extra: str) -> DataFrame:
    """One ledger row per message, for explicit acknowledgement."""
    return emitted.select(consumer.alias("consumer"), "stream", "seq", acked_at.alias("acked_at"), *extra)


def ack_last(emitted: DataFrame, consumer: Column, acked_at: Column) -> DataFrame:
    """One ledger row per consumer and stream: acknowledges everything up to it."""
    return (
        emitted.groupBy(consumer.alias("consumer"), "stream")
        .agg(F.max("seq").alias("seq"))
        .select("consumer", "stream", "seq", acked_at.alias("acked_at"))
    )


def ack_messages(emitted: DataFrame) -> DataFrame:
    """The acknowledgement message of each consumed message, addressed to its reply-to."""
    return emitted.where(F.col("reply_to").isNotNull()).select(
        F.col("reply_to").alias("subject"), encode_utf8(F.lit(ACK_BODY)).alias("data")
    )
