"""Pulls: the complete batches of a log, cut into ranges of numbers of at most so many messages.

A streaming query can take whole files only.  ``cut_pulls`` turns each note of a complete batch into small files that
name a range of its numbers each, in order; a consumer streams these and takes part of a batch in a trigger.  No message
is read for it: ranges of a dense batch are reckoned, those of a batch with gaps come from the log's counts.

Where more than ``PULLS_APART`` pulls are cut at once, a file names several that follow each other, so that the triggers of
a consumer do not grow with its backlog: each costs seconds, however little it reads.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Iterator
from itertools import groupby, islice

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..sources.files import Folder
from ..sources.log import BATCH_KEY, COUNTS, batch_folder, read_batches, stream_finished

PULL = T.StructType(
    [T.StructField("stream", T.StringType()), *BATCH_KEY, T.StructField("low", T.LongType()), T.StructField("high", T.LongType())]
)
NOTES_PER_TRIGGER = 100
# So many files at most come from the notes of a trigger.
PULLS_APART = 8


def ranges(parts: list[tuple[int, int, int]], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of numbers with at most ``most`` messages each, out of (rows, first, last) in order of numbers.

    Numbers are unique, so a part with more rows than that is cut by its numbers; smaller ones are joined.
    """
    low = high = held = 0
    for rows, first, last in parts:
        if held and held + rows > most:
            yield low, high
            held = 0
        if rows > most:
            for at in range(first, last + 1, most):
                yield at, min(at + most - 1, last)
            continue
        if not held:
            low = first
        high, held = last, held + rows
    if held:
        yield low, high


def _parts(spark: SparkSession, path: str, note: Row) -> list[tuple[int, int, int]]:
    if note["rows"] == note["last"] - note["first"] + 1:
        return [(note["rows"], note["first"], note["last"])]
    only = [batch_folder(spark, note["stream"], note["writer"], note["batch"])]
    counts = read_batches(spark, f"{path}/_counts", COUNTS, only).where("bucket IS NOT NULL").groupBy("bucket")
    told = counts.agg(F.sum("rows").alias("rows"), F.min("first").alias("first"), F.max("last").alias("last"))
    return [(r["rows"], r["first"], r["last"]) for r in told.orderBy("bucket").collect()]  # a row a bucket of numbers


def joined(pulls: Iterator[tuple[int, int | None, int | None]], together: int) -> Iterator[list[tuple[int, int | None, int | None]]]:
    """Runs of ``together`` pulls (note, low, high); those of one note become one range."""
    while run := list(islice(pulls, together)):
        yield [
            (note, own[0][1], own[-1][2]) for note, own in ((n, list(g)) for n, g in groupby(run, key=lambda p: p[0]))
        ]


def cut_pulls(
    spark: SparkSession, path: str, pulls: str, rows: int, available_now: bool = True, interval: str = "5 seconds"
) -> StreamingQuery:
    """Write the pulls of the log at ``path`` to ``pulls``, of at most ``rows`` messages: of as many as at the first start.
    Up to ``PULLS_APART`` that are cut at once have a file each, more of them share as many files.

    A trigger that is run again finds its files there and makes none twice.
    """
    folder = Folder(spark, pulls)
    folder.create("_size", str(rows))
    most = int(folder.read("_size"))

    def cut(notes: DataFrame, number: int) -> None:
        session, before = notes.sparkSession, 0
        found = sorted(notes.collect(), key=lambda r: (r["slot"], r["stream"]))  # of NOTES_PER_TRIGGER files
        # messages without numbers cannot be told apart
        parts = [None if note["first"] is None else _parts(session, path, note) for note in found]

        def cuts() -> Iterator[tuple[int, int | None, int | None]]:
            for k, part in enumerate(parts):
                yield from [(k, None, None)] if part is None else ((k, low, high) for low, high in ranges(part, most))

        together = -(-sum(1 for _ in cuts()) // PULLS_APART) or 1
        for n, run in enumerate(joined(cuts(), together)):
            rows = [
                {key: found[k][key] for key in ("stream", *BATCH_KEY.names)} | {"low": low, "high": high} for k, low, high in run
            ]
            name = f"{number:09d}-{n:09d}.json"
            folder.create(name, "\n".join(map(json.dumps, rows)), before)
            before = folder.written_at(name)

    cutting = stream_finished(spark, path, NOTES_PER_TRIGGER).writeStream.foreachBatch(cut)
    cutting = cutting.option("checkpointLocation", f"{pulls}/_cut")
    return (cutting.trigger(availableNow=True) if available_now else cutting.trigger(processingTime=interval)).start()


def stream_pulls(spark: SparkSession, pulls: str, per_trigger: int = 1) -> DataFrame:
    """PULL rows as they are cut, ``per_trigger`` files at a time."""
    return spark.readStream.schema(PULL).option("maxFilesPerTrigger", per_trigger).json(pulls)


def stop_with(query: StreamingQuery, other: StreamingQuery) -> None:
    """Stop ``other`` when ``query`` has ended."""

    def wait() -> None:
        try:
            query.awaitTermination()
        except Exception:  # whoever waits for the query itself is told
            pass
        other.stop()

    threading.Thread(target=wait, daemon=True).start()
