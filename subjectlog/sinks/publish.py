"""Publishing into a log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.payload import normalise_headers
from ..functions.subjects import literal_subject
from ..functions.text import payload_bytes
from ..operators.acks import work_queue_remaining
from ..operators.sequence import number_rows
from ..operators.subscriptions import require_subjects
from ..schema import ACK, MESSAGE
from ..scratch import discard
from ..sources.log import BATCH_KEY, WRITER, Ledger, read_batches, read_log, store, store_batch, write_log
from .fan_out import fan_out


def _as_messages(records: DataFrame, stream: str, published_at: Column) -> DataFrame:
    have = set(records.columns)
    optional = {
        "seq": F.lit(None).cast("long"),
        "headers": F.lit(None).cast(MESSAGE["headers"].dataType),
        "reply_to": F.lit(None).cast("string"),
    }
    columns = {name: F.col(name) if name in have else value for name, value in optional.items()}
    return records.select(
        F.lit(stream).alias("stream"),
        literal_subject(F.col("subject")).alias("subject"),
        columns["seq"].alias("seq"),
        published_at.alias("ts"),
        normalise_headers(columns["headers"]).alias("headers"),
        columns["reply_to"].alias("reply_to"),
        payload_bytes(F.col("data")).alias("data"),
    )


def publish_core(
    records: DataFrame, path: str, stream: str, published_at: Column, batch: int | None = None, writer: str = WRITER
) -> None:
    """Fire and forget: no sequence numbers, rows land where they are.  ``batch`` as in ``publish_durable``."""
    number = Ledger(records.sparkSession, path).next_batch(writer) if batch is None else batch
    store_batch(_as_messages(records.drop("seq"), stream, published_at), path, number, writer)


def publish_durable(
    records: DataFrame,
    path: str,
    stream: str,
    order_by: list[str],
    published_at: Column,
    batch: int | None = None,
    writer: str = WRITER,
    subjects: list[str] | None = None,
) -> None:
    """Numbered publish: sequence numbers continue the stream without gaps, in ``order_by``.

    With ``subjects`` each record goes to all of them, one after the other; records are ordered and staged once,
    not per copy.

    Every call adds to the stream, unless it names a batch of its writer that is there, however long ago: that one is
    replaced, under the numbers it had, so publishing a batch again after a failure changes nothing.  It must have as
    many records as before.  Any number of writers may publish to one stream at once: each claims a range of numbers
    when it has counted its records, and what it wrote is noted when all with lower numbers is there.  Without
    records nothing is claimed.
    """
    spark = records.sparkSession
    ledger = Ledger(spark, path)
    number = ledger.next_batch(writer) if batch is None else batch
    copies = 1 if subjects is None else len(require_subjects(subjects))
    numbered = number_rows(records, order_by, "__rank")
    total = numbered.last * copies
    held = ledger.record(stream, writer, number)
    if held.slot and held.rows != total:
        raise ValueError(f"batch {number} of {writer!r} had {held.rows} messages in {stream!r}, now {total}")
    if total:
        record = ledger.claim(stream, writer, number, total)
        rows, own = numbered.frame, F.col("__rank") + record.base
        if subjects is not None:
            rows = fan_out(rows, subjects)
            own = (F.col("__rank") - 1) * copies + F.col("target") + record.base + 1
        store_batch(_as_messages(rows.withColumn("seq", own), stream, published_at), path, number, writer, {stream: record})
    discard(spark, numbered.staged)


_LEDGER = T.StructType([*ACK, *BATCH_KEY])


def append_acks(acks: DataFrame, path: str, batch: int | None = None, writer: str = WRITER) -> None:
    """Add ACK rows to a ledger table; a batch that the writer has there is replaced."""
    spark = acks.sparkSession
    if batch is None:
        own = read_batches(spark, path, _LEDGER).where(F.col("writer") == writer)
        batch = own.agg(F.coalesce(F.max("batch") + 1, F.lit(0))).head()[0]
    key = [F.lit(writer).alias("writer"), F.lit(batch).cast("long").alias("batch")]
    store(acks.select(*ACK.names, *key), path, *BATCH_KEY.names)


def read_acks(spark: SparkSession, path: str) -> DataFrame:
    return read_batches(spark, path, _LEDGER).select(*ACK.names)


def compact_work_queue(
    spark: SparkSession, path: str, acks: DataFrame, target: str, consumers: DataFrame | None = None
) -> None:
    """Rewrite a work-queue log without its acknowledged messages, as a new log."""
    write_log(work_queue_remaining(read_log(spark, path), acks, consumers), target)
