"""Streaming copies from a source log into a sink log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.registry import SinkConverter, SourceConverter
from ..operators.acks import ack_rows
from ..operators.subscriptions import require_subjects
from ..sinks.fan_out import converted, fan_out
from ..sinks.publish import append_acks, publish_core, publish_durable
from ..sources.log import writer_of


def start_relay(
    messages: DataFrame,
    path: str,
    stream: str,
    subjects: list[str],
    checkpoint: str,
    source: str | SourceConverter = "utf8",
    sink: str | SinkConverter = "utf8",
    mapper: Callable[[DataFrame], DataFrame] | None = None,
    durable: bool = True,
    order_by: list[str] | None = None,
    published_at: Column | None = None,
    consumer: str | None = None,
    ack_path: str | None = None,
    available_now: bool = True,
    interval: str = "5 seconds",
) -> StreamingQuery:
    """Publish every message to every subject of ``stream`` in the log at ``path``.

    ``durable`` numbers the messages without gaps; otherwise they are appended as they come.
    Batch n of the query is batch n of the log under the query's id, so a repeated batch replaces
    itself, and a query with a new checkpoint adds to what is there.  With
    ``consumer`` and ``ack_path`` each message is acknowledged in that ledger once its copies
    are stored.
    """
    records = converted(messages, source, sink, mapper)
    require_subjects(subjects)
    order = [c for c in order_by or ["stream", "seq"] if c != "target"]
    at = F.col("ts") if published_at is None else published_at

    def write_batch(batch: DataFrame, number: int) -> None:
        writer = writer_of(batch.sparkSession, checkpoint)
        if durable:
            publish_durable(batch, path, stream, order, at, number, writer, subjects)
        else:
            publish_core(fan_out(batch, subjects), path, stream, at, number, writer)
        if ack_path is not None:
            append_acks(ack_rows(batch, F.lit(consumer), at), ack_path, number, writer)

    copying = records.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    copying = copying.trigger(availableNow=True) if available_now else copying.trigger(processingTime=interval)
    return copying.start()
