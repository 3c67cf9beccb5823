"""A durable consumer as a streaming query: data, then acknowledgements, then progress.

The stream is that of the log's complete batches, or of pulls cut from them; a micro-batch reads the messages of those
it was given, as a table, so they come in order however their files were written, and any number of subscriptions can be
matched.

Each micro-batch writes three tables below ``out``, keyed by the query's id and its batch number, so that a
batch that is run again replaces what it wrote, and a query with a new checkpoint adds to it.  What a
batch does depends on earlier batches only, never on its own half-written results.
"""

from __future__ import annotations

import threading
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.acks import ack_last
from ..operators.attach import attach, local_frame
from ..operators.bound import first_n
from ..operators.progress import merge_progress, split_progress
from ..operators.ranges import read_ranges
from ..operators.subscribe import WITHIN_BOUND, explicit_rows, positioned, ranged, select_splits, settled, without_acked
from ..operators.subscriptions import packed, unpacked
from ..schema import ACK, MESSAGE, PROGRESS
from ..scratch import PACKING, discard, scratch_path, shuffles_freed
from ..sources.log import BATCH_KEY, messages_of, read_batches, store, stream_finished, writer_of
from .pulls import cut_pulls, stop_with, stream_pulls

_EMITTED = T.StructType([*MESSAGE, T.StructField("split_id", T.StringType()), *BATCH_KEY])


def emitted(spark: SparkSession, out: str) -> DataFrame:
    return read_batches(spark, f"{out}/data", _EMITTED).drop(*BATCH_KEY.names)


def ledger(spark: SparkSession, out: str) -> DataFrame:
    return read_batches(spark, f"{out}/acks", T.StructType([*ACK, *BATCH_KEY])).drop(*BATCH_KEY.names)


_PROGRESS = T.StructType([*PROGRESS, *BATCH_KEY])


def progress(spark: SparkSession, out: str) -> DataFrame:
    """The farthest progress of every split."""
    parts = read_batches(spark, f"{out}/progress", _PROGRESS)
    how_far = F.struct(F.coalesce("last_emitted_seq", F.lit(0)), "batch")
    newest = parts.groupBy("split_id").agg(F.max_by(F.struct(*PROGRESS.names[1:]), how_far).alias("p"))
    return newest.select("split_id", "p.*")


def _own(writer: str, number: int) -> str:
    return f"writer={writer}/batch={number}"


def _progress_before(spark: SparkSession, out: str, writer: str, number: int) -> DataFrame:
    """Progress after the batch before this one: one folder, whatever came earlier."""
    return read_batches(spark, f"{out}/progress", _PROGRESS, _own(writer, number - 1)).select(*PROGRESS.names)


def all_finished(spark: SparkSession, out: str, subs: DataFrame) -> bool:
    done = progress(spark, out).where("finished")
    return subs.join(done, "split_id", "left_anti").isEmpty()


def pull_size(subs: DataFrame) -> int | None:
    """The most messages that a trigger may take: the smallest ``batch_size`` of the subscriptions; None if none asks."""
    return subs.where("batch_size > 0").agg(F.min("batch_size")).head()[0]


def start_consumer(
    spark: SparkSession,
    log_path: str,
    subs: DataFrame,
    out: str,
    checkpoint: str,
    acked_at: Column,
    saved: DataFrame | None = None,
    acks: DataFrame | None = None,
    batches_per_trigger: int | None = None,
    available_now: bool = True,
    interval: str = "5 seconds",
) -> StreamingQuery:
    """Start reading ``subs`` from the log.  ``saved`` and ``acks`` are state of earlier
    consumers; this one's own position is its checkpoint.  What a durable consumer has acknowledged
    one by one in ``acks`` does not come again.  A trigger takes ``batches_per_trigger`` batches of the log, or, where
    subscriptions have a ``batch_size``, at most so many messages: part of a batch if need be."""
    kept_at = scratch_path(spark, "positions")
    positions, rows = settled(positioned(subs, saved, acks), path=kept_at)  # fixed for the life of the query
    told = positions.agg(
        F.count("remaining").alias("bounded"),
        F.bool_or(F.col("ack_behavior") != "NoAckUnordered").alias("ordered"),
        F.bool_or(F.col("ack_behavior") == "AckAll").alias("acks"),
    ).head()
    explicit = acks is not None and (rows is None or any(explicit_rows(r) for r in rows))
    schema, by_rank = positions.schema, ranged(acks is not None)
    most = None if batches_per_trigger else pull_size(subs)

    def write_batch(finished: DataFrame, number: int) -> None:
        session = finished.sparkSession
        writer = writer_of(session, checkpoint)
        splits = positions if rows is None else local_frame(session, rows, schema)
        messages = messages_of(session, log_path, finished)
        before = _progress_before(session, out, writer, number)
        rest = splits if rows is not None else splits.where(f"NOT {by_rank}")
        hits = select_splits(messages, rest, rows=rows)
        if explicit:
            hits = without_acked(hits, _within(finished, acks))
        hits = hits.select(*MESSAGE.names, "split_id", "remaining")
        if told["bounded"]:
            hits = _trim(hits, before)
        hits = hits.select(*MESSAGE.names, packed())
        key = [F.lit(writer).alias("writer"), F.lit(number).cast("long").alias("batch")]
        taken_at = scratch_path(session, "taken")
        try:
            if rows is None and told["bounded"]:  # joined by rank, like ``subscribe``
                still = _still_open(splits.where(by_rank), before)
                hits = hits.unionByName(read_ranges(messages, still, path=taken_at).select(*hits.columns))
            if told["ordered"]:  # per split, also across the files of a batch
                hits = hits.repartitionByRange("split_id", "seq").sortWithinPartitions("split_id", "seq")
            _store(hits.select(*MESSAGE.names, unpacked(), *key), f"{out}/data")
        finally:
            discard(session, taken_at)
        written = read_batches(session, f"{out}/data", _EMITTED, _own(writer, number))
        _settle(session, written, splits, bool(told["acks"]), out, writer, number, acked_at)

    cutter = None
    if most:
        pulls = f"{checkpoint.rstrip('/')}-pulls"
        cutter = cut_pulls(spark, log_path, pulls, most, available_now, interval)
        if available_now:
            cutter.awaitTermination()
        source = stream_pulls(spark, pulls)
    else:
        source = stream_finished(spark, log_path, batches_per_trigger)
    reading = source.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    reading = reading.trigger(availableNow=True) if available_now else reading.trigger(processingTime=interval)
    query = reading.start()
    if rows is None:
        _discard_after(query, spark, kept_at)
    if cutter is not None and not available_now:
        stop_with(query, cutter)
    return query


def _discard_after(query: StreamingQuery, spark: SparkSession, path: str) -> None:
    """Remove an intermediate of a query that has ended; started again it makes another."""

    def wait() -> None:
        try:
            query.awaitTermination()
        except Exception:  # whoever waits for the query itself is told
            pass
        try:
            discard(spark, path)
        except Exception:  # the session has ended as well
            pass

    threading.Thread(target=wait, daemon=True).start()


def _store(rows: DataFrame, path: str) -> None:
    """What a batch leaves, mostly ids, without the shuffles that made it."""
    with shuffles_freed(rows.sparkSession):
        store(rows, path, *BATCH_KEY.names, packing=PACKING)


def _within(finished: DataFrame, acks: DataFrame) -> DataFrame:
    """The acknowledgements that may be of the messages of some pulls, by number; all, where a whole batch was given."""
    if "low" not in finished.columns:
        return acks
    told = finished.agg(F.min("low").alias("low"), F.max("high").alias("high"), F.bool_or(F.col("low").isNull()).alias("whole")).head()
    return acks if told["whole"] else acks.where(F.col("seq").between(told["low"], told["high"]))


def _trim(batch: DataFrame, seen: DataFrame) -> DataFrame:
    """Cut a batch to what its bounded splits may still emit."""
    return first_n(_still_open(batch, seen).where(WITHIN_BOUND), "remaining")


def _still_open(rows: DataFrame, seen: DataFrame) -> DataFrame:
    """``remaining`` less what was read before."""
    left = F.greatest(F.col("remaining") - F.coalesce("messages", F.lit(0)), F.lit(0))
    known = attach(rows, seen.select("split_id", "messages"), ["split_id"], "left")
    return known.withColumn("remaining", left).drop("messages")


def _settle(
    session: SparkSession,
    written: DataFrame,
    positions: DataFrame,
    acknowledges: bool,
    out: str,
    writer: str,
    number: int,
    acked_at: Column,
) -> None:
    """Acknowledge and count the written rows; nothing is acknowledged before it is stored."""
    key = [F.lit(writer).alias("writer"), F.lit(number).cast("long").alias("batch")]
    if acknowledges:
        tell = positions.where(F.col("ack_behavior") == "AckAll")
        cumulative = written.join(tell.select("split_id", F.coalesce("durable_name", "split_id").alias("consumer")), "split_id")
        _store(ack_last(cumulative, F.col("consumer"), acked_at).select("*", *key), f"{out}/acks")
    # Every batch leaves the progress of all splits, so the next reads this folder alone.
    moved = split_progress(written.withColumn("split_id", packed()))
    before = _progress_before(session, out, writer, number)
    moved = moved.unionByName(before.withColumn("split_id", packed()))
    bounds = positions.select(packed(), F.col("remaining").alias("max_messages_to_read"))
    _store(merge_progress(moved, bounds).withColumn("split_id", unpacked()).select(*PROGRESS.names, *key), f"{out}/progress")


def run_to_bound(query: StreamingQuery, spark: SparkSession, out: str, subs: DataFrame, poll_seconds: float = 1.0) -> None:
    """Let a bounded consumer run until every split has what it asked for, then stop it."""
    while query.isActive:
        if all_finished(spark, out, subs):
            query.stop()
            return
        time.sleep(poll_seconds)
    query.awaitTermination()
