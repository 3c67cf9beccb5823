"""Explicit acknowledgements as intervals.

A consumer that acknowledges one by one leaves a row a message.  What is acknowledged without a break, among the messages
it was given, is one interval; a ledger kept so grows with the breaks, not with the messages.  Everything runs per
(consumer, stream, 2**20 numbers): only intervals that reach the edge of such a bucket, two at most, meet those of others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import SEQ_BUCKET
from .acks import MESSAGE_KEY

_WHO = ["consumer", "stream"]


def compacted_ledger(deliveries: DataFrame, acks: DataFrame) -> DataFrame:
    """(consumer, stream, low, high, messages): the longest runs of delivered messages that are all acknowledged, low and
    high being acknowledged messages.  Repeated rows count once; acknowledgements of what was not delivered do not count.
    """
    edges = _bucket_runs(deliveries, acks)
    inner = edges.where("NOT left AND NOT right").select(*_WHO, "low", "high", "messages")
    # Of buckets with any delivery, the one before: a run goes on if it reached that one's end.
    filled = edges.select(*_WHO, "bucket", "before").distinct()
    at_edge = edges.where("acked AND (left OR right)").drop("before").join(filled, [*_WHO, "bucket"])
    by_place = Window.partitionBy(*_WHO).orderBy("low")
    goes_on = F.col("left") & F.lag("right").over(by_place) & (F.lag("bucket").over(by_place) == F.col("before"))
    run = F.sum((~F.coalesce(goes_on, F.lit(False))).cast("long")).over(by_place)
    joined = at_edge.withColumn("run", run).groupBy(*_WHO, "run")
    long = joined.agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("messages").alias("messages")).drop("run")
    return long.unionByName(inner.where("low IS NOT NULL"))


def _bucket_runs(deliveries: DataFrame, acks: DataFrame) -> DataFrame:
    """Runs of acknowledged messages inside each bucket, with whether they hold its first (``left``) and last (``right``)
    delivered message, and the bucket with deliveries ``before``.  A bucket without a run has one row that is not ``acked``."""
    done = acks.select(*MESSAGE_KEY).distinct().withColumn("acked", F.lit(True))
    sent = deliveries.select(*MESSAGE_KEY).distinct().join(done, MESSAGE_KEY, "left")
    marked = sent.select(*MESSAGE_KEY, F.coalesce("acked", F.lit(False)).alias("acked"), F.floor(F.col("seq") / SEQ_BUCKET).alias("bucket"))
    inside = Window.partitionBy(*_WHO, "bucket").orderBy("seq")
    begins = F.col("acked") & ~F.coalesce(F.lag("acked").over(inside), F.lit(False))
    placed = marked.withColumns({"run": F.sum(begins.cast("long")).over(inside), "first": F.lag("seq").over(inside).isNull(), "end": F.lead("seq").over(inside).isNull()})
    runs = placed.where("acked").groupBy(*_WHO, "bucket", "run").agg(
        F.min("seq").alias("low"), F.max("seq").alias("high"), F.count("*").alias("messages"),
        F.bool_or("first").alias("left"), F.bool_or("end").alias("right"), F.lit(True).alias("acked"),
    ).drop("run")
    buckets = marked.select(*_WHO, "bucket").distinct()
    buckets = buckets.withColumn("before", F.lag("bucket").over(Window.partitionBy(*_WHO).orderBy("bucket")))
    found = buckets.join(runs, [*_WHO, "bucket"], "left")
    return found.fillna({"left": False, "right": False, "acked": False})


def explicit_floor(deliveries: DataFrame, ledger: DataFrame) -> DataFrame:
    """(consumer, stream, floor): up to it everything delivered is acknowledged; 0 if the first message is not.

    ``ledger`` has intervals of ``compacted_ledger``: the floor is the end of the first, if that begins with the first
    delivery.
    """
    first = deliveries.groupBy(*_WHO).agg(F.min("seq").alias("first"))
    begin = ledger.groupBy(*_WHO).agg(F.min(F.struct("low", "high")).alias("i"))
    held = first.join(begin, _WHO, "left")
    floor = F.when(F.col("i.low") == F.col("first"), F.col("i.high")).otherwise(F.lit(0).cast("long"))
    return held.select(*_WHO, floor.alias("floor"))


def pending_intervals(deliveries: DataFrame, ledger: DataFrame) -> DataFrame:
    """Deliveries that no interval covers.  An interval meets the deliveries of the buckets it reaches into, so a busy
    consumer is spread over many tasks."""
    bucket = F.floor(F.col("seq") / SEQ_BUCKET)
    reach = F.sequence(F.floor(F.col("low") / SEQ_BUCKET), F.floor(F.col("high") / SEQ_BUCKET))
    spread = ledger.select(*_WHO, "low", "high", F.explode(reach).alias("__bucket"))
    inside = [*[F.col(f"d.{c}") == F.col(f"i.{c}") for c in (*_WHO, "__bucket")], F.col("d.seq").between(F.col("i.low"), F.col("i.high"))]
    left = deliveries.withColumn("__bucket", bucket).alias("d").join(spread.alias("i"), inside, "left_anti")
    return left.drop("__bucket")
