"""Records to messages: conversion, and one copy per target subject."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.registry import SinkConverter, SourceConverter, convert_sink, convert_source, never_null
from ..functions.subjects import literal_subject
from ..operators.subscriptions import require_subjects


def fan_out(messages: DataFrame, subjects: list[str], column: str = "subject") -> DataFrame:
    """Every message to every subject; ``target`` is the subject's place in the list.

    A wildcard among the subjects fails when the job runs.
    """
    targets = F.array(*[F.lit(s) for s in require_subjects(subjects)])
    rest = [c for c in messages.columns if c not in (column, "target")]
    copies = messages.select(*rest, F.posexplode(targets).alias("target", column))
    return copies.withColumn(column, literal_subject(F.col(column)))


def converted(
    messages: DataFrame,
    source: str | SourceConverter = "utf8",
    sink: str | SinkConverter = "utf8",
    mapper: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Messages to records: convert, map the ``value`` column if asked, convert back.

    The source subject stays as ``source_subject``; batch and streaming frames alike.
    """
    records = convert_source(messages, source).withColumnRenamed("subject", "source_subject")
    if mapper is not None:
        records = mapper(records)
    complete = mapper is None and never_null(source)
    return convert_sink(records, sink, complete=complete)


def relay(
    messages: DataFrame,
    subjects: list[str],
    source: str | SourceConverter = "utf8",
    sink: str | SinkConverter = "utf8",
    mapper: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Copy messages to ``subjects``: one row per record and subject."""
    return fan_out(converted(messages, source, sink, mapper), subjects)
