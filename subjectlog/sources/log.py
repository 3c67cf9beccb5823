"""The durable log as a Parquet table: ``<path>/stream=<name>/writer=<id>/batch=<n>/*.parquet``.

A batch belongs to a writer: a job that publishes under a name, or a streaming query under its own id.  Writing
a batch of a writer again replaces that batch and no other.  Beside the messages the log keeps

* ``_slots/<stream>/<k>``: who took the k-th range of a stream's numbers, and the last number then.  A slot is created
  once and never changes, so writers of one stream need not take turns.
* ``_records/<stream>/<writer>/<batch>``: the batch's slot, the number before its first, rows, first and last number.
* ``_counts``: messages per (stream, subject, ``COUNT_BUCKET`` numbers) of each batch.
* ``_finished/<stream>-<k>``: the note that the batch of slot k is complete.  Notes come in the order of the slots,
  hence of the numbers: whoever completes a batch notes it if the one before it is noted, and those behind it that wait.

A step costs the same whatever the log's history: all folders and files are named, none is searched for.
"""

from __future__ import annotations

import json
from typing import NamedTuple
from urllib.parse import quote

from pyspark.errors import AnalysisException, IllegalArgumentException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import MESSAGE
from .files import Folder

WRITER = "main"
COUNT_BUCKET = 1 << 12
NAMED_FOLDERS = 1000  # up to so many batches are read by the names of their folders

BATCH_KEY = T.StructType([T.StructField("writer", T.StringType()), T.StructField("batch", T.LongType())])
FINISHED = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        *BATCH_KEY,
        *[T.StructField(name, T.LongType()) for name in ("slot", "rows", "first", "last")],
    ]
)
COUNTS = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("subject", T.StringType()),
        *[T.StructField(name, T.LongType()) for name in ("bucket", "rows", "first", "last")],
        *BATCH_KEY,
    ]
)
_STORED = T.StructType([*MESSAGE, *BATCH_KEY])


def read_batches(
    spark: SparkSession, path: str, schema: T.StructType = _STORED, only: str | list[str] = ""
) -> DataFrame:
    """The stored rows with their batch number; a log nobody wrote to yet is empty.

    ``only`` names partition folders, and nothing else is listed.
    """
    reader = spark.read.schema(schema)
    if isinstance(only, list):
        if not only:
            return spark.createDataFrame([], schema)
        return reader.option("basePath", path).parquet(*[f"{path}/{o}" for o in only])
    try:
        return reader.option("basePath", path).parquet(f"{path}/{only}") if only else reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    except IllegalArgumentException as e:
        if "must be a directory" not in str(e):  # nor is there a base path yet
            raise
        return spark.createDataFrame([], schema)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """MESSAGE rows.  ``stream`` prunes directories; ``subject`` and ``seq`` reach the scan."""
    return read_batches(spark, path).select(*MESSAGE.names)


def stream_log(
    spark: SparkSession,
    path: str,
    files_per_trigger: int | None = None,
    bytes_per_trigger: str | None = None,
    with_batch: bool = False,
) -> DataFrame:
    """The log's files as a stream, in no particular order; ``with_batch`` adds writer and batch."""
    reader = spark.readStream.schema(_STORED)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    return reader.parquet(path).select(*(_STORED if with_batch else MESSAGE).names)


def finished_batches(spark: SparkSession, path: str) -> DataFrame:
    """FINISHED rows of the complete batches of a log, as they are now."""
    if not Folder(spark, f"{path}/_records").exists(""):
        return spark.createDataFrame([], FINISHED)
    kept = T.StructType([*FINISHED, T.StructField("done", T.BooleanType())])
    records = spark.read.schema(kept).option("recursiveFileLookup", "true").json(f"{path}/_records")
    return records.where("done").select(*FINISHED.names)


def noted_batches(spark: SparkSession, path: str) -> DataFrame:
    """FINISHED rows of the notes, as consumers are given them."""
    if not Folder(spark, f"{path}/_finished").exists(""):
        return spark.createDataFrame([], FINISHED)
    return spark.read.schema(FINISHED).json(f"{path}/_finished")


def stream_finished(spark: SparkSession, path: str, batches_per_trigger: int | None = None) -> DataFrame:
    """Complete batches as they come, one file each, those of a stream in the order of their numbers."""
    reader = spark.readStream.schema(FINISHED)
    if batches_per_trigger:
        reader = reader.option("maxFilesPerTrigger", batches_per_trigger)
    return reader.json(f"{path}/_finished")


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """COUNTS rows: how many messages each subject has in each bucket of a stream's numbers.  Messages without a
    number are in the null bucket."""
    return read_batches(spark, f"{path}/_counts", COUNTS)


def batch_folder(spark: SparkSession, stream: str, writer: str, batch: int) -> str:
    """The folder of one batch below a table that is partitioned by stream, writer and batch."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return f"stream={escape(stream)}/writer={escape(writer)}/batch={batch}"


def messages_of(spark: SparkSession, path: str, batches: DataFrame) -> DataFrame:
    """MESSAGE rows of some (stream, writer, batch).  Rows of ``batches`` with ``low`` and ``high`` take part of a batch
    only, by number; the same rows of a batch are never given twice."""
    keys = ["stream", *BATCH_KEY.names]
    cut = "low" in batches.columns
    rows = batches.limit(NAMED_FOLDERS + 1).collect()
    if len(rows) > NAMED_FOLDERS:
        stored = read_batches(spark, path).join(batches.distinct(), keys)
        return stored.where("low IS NULL OR seq BETWEEN low AND high" if cut else "true").select(*MESSAGE.names)
    stored = read_batches(spark, path, only=sorted({batch_folder(spark, *(r[k] for k in keys)) for r in rows}))
    if cut:
        if len(rows) == 1 and rows[0]["low"] is not None:  # the range reaches the scan
            stored = stored.where(F.col("seq").between(rows[0]["low"], rows[0]["high"]))
        else:
            parts = spark.createDataFrame(rows, batches.schema).distinct()
            stored = stored.join(F.broadcast(parts), keys).where("low IS NULL OR seq BETWEEN low AND high")
    return stored.select(*MESSAGE.names)


def writer_of(spark: SparkSession, checkpoint: str) -> str:
    """The id a streaming query keeps in its checkpoint; another checkpoint, even in the same place, has another."""
    return json.loads(Folder(spark, checkpoint).read("metadata"))["id"]


class Record(NamedTuple):
    """What is kept of one batch of one stream; ``slot`` 0: not in the log yet."""

    slot: int = 0
    base: int = 0
    rows: int = 0
    first: int | None = None
    last: int | None = None
    done: bool = False
    gone: bool = False  # given up


class Ledger:
    """Slots, records and notes of a log, for the driver of a job that writes to it."""

    def __init__(self, spark: SparkSession, path: str):
        self.files = Folder(spark, path)

    @staticmethod
    def _record(stream: str, writer: str, batch: int) -> str:
        return f"_records/{quote(stream, safe='')}/{quote(writer, safe='')}/{batch}.json"

    @staticmethod
    def _slot(stream: str, k: int) -> str:
        return f"_slots/{quote(stream, safe='')}/{k:012d}.json"

    @staticmethod
    def _note(stream: str, k: int) -> str:
        return f"_finished/{quote(stream, safe='')}-{k:012d}.json"

    def record(self, stream: str, writer: str, batch: int) -> Record:
        text = self.files.read(self._record(stream, writer, batch))
        held = json.loads(text) if text else {}
        return Record(**{k: held[k] for k in Record._fields if k in held})

    def _keep(self, stream: str, writer: str, batch: int, record: Record) -> None:
        row = {"stream": stream, "writer": writer, "batch": batch, **record._asdict()}
        self.files.replace(self._record(stream, writer, batch), json.dumps(row))

    def _taken(self, stream: str, k: int) -> dict | None:
        text = self.files.read(self._slot(stream, k)) if k else None
        return json.loads(text) if text else None

    def top(self, stream: str) -> int:
        """The highest slot taken, found by doubling and halving; slots have no gaps."""
        there = lambda k: self.files.exists(self._slot(stream, k))
        low, high = 0, 1
        while there(high):
            low, high = high, 2 * high
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if there(middle) else (low, middle)
        return low

    def last(self, stream: str) -> int:
        """The highest number that any batch has, or will have, in a stream."""
        held = self._taken(stream, self.top(stream))
        return held["last"] if held else 0

    def next_batch(self, writer: str) -> int:
        """The number after a writer's highest in any stream."""
        folders = [f"_records/{stream}/{quote(writer, safe='')}" for stream in self.files.names("_records")]
        return max((int(n.removesuffix(".json")) + 1 for f in folders for n in self.files.names(f)), default=0)

    def claim(self, stream: str, writer: str, batch: int, rows: int, last: int | None = None, numbered: bool = True) -> Record:
        """The record of a batch, whose slot is its own.  A batch that has one keeps it, whatever came later.

        A new one takes the ``rows`` numbers behind the stream's last; if not ``numbered``, only those up to ``last``
        that its messages have, if any.  The record names the slot before that is created, so a writer that died in
        between finds out whether it has it.  A slot that was given up is not taken again.
        """
        record = self.record(stream, writer, batch)
        while True:
            if record.slot:
                held = self._taken(stream, record.slot)
                if held is None:
                    end = max(record.base, record.last or 0)
                    self.files.create(self._slot(stream, record.slot), json.dumps({"writer": writer, "batch": batch, "last": end}))
                    held = self._taken(stream, record.slot)
                if (held["writer"], held["batch"]) == (writer, batch) and not record.gone:
                    return record
            k = self.top(stream)
            before = self._taken(stream, k)
            base = before["last"] if before else 0
            if numbered:
                record = Record(k + 1, base, rows, base + 1, base + rows)
            else:
                record = Record(k + 1, base, rows, None, last)
            self._keep(stream, writer, batch, record)

    def extend(self, stream: str, writer: str, batch: int, last: int) -> None:
        """Keep the numbers up to ``last`` from being given, for a batch that was replaced by a longer one."""
        while (k := self.top(stream)) and (before := self._taken(stream, k))["last"] < last:
            text = json.dumps({"writer": writer, "batch": batch, "last": last, "extends": True})
            self.files.create(self._slot(stream, k + 1), text)

    def settle(self, stream: str, writer: str, batch: int, record: Record) -> None:
        """Note that a batch is stored, as soon as all with lower numbers are."""
        self._keep(stream, writer, batch, record._replace(done=True))
        self._advance(stream, record.slot)
        if self.files.read(self._note(stream, record.slot)) == "":
            self._keep(stream, writer, batch, record._replace(done=False, gone=True))
            raise RuntimeError(f"the claim of batch {batch} of {writer!r} on {stream!r} was given up meanwhile")

    def give_up(self, stream: str, writer: str, batch: int) -> None:
        """Let later batches of a stream be noted though this one, whose writer is gone, is not complete.  Its numbers
        stay free; should the writer come back, it gets others."""
        record = self.record(stream, writer, batch)
        if record.slot and not record.done:
            self._keep(stream, writer, batch, record._replace(gone=True))
            self._advance(stream, record.slot)

    def _advance(self, stream: str, slot: int) -> None:
        """Note the batch of a slot and those behind it that are stored, if the one before is noted.  Slots without a batch
        have an empty note."""
        k, before = slot, 0
        if k > 1 and not (before := self.files.written_at(self._note(stream, k - 1))):
            return
        while (held := self._taken(stream, k)) is not None:
            own = self.record(stream, held["writer"], held["batch"])
            text = ""
            if not (held.get("extends") or own.gone or own.slot != k):
                if not own.done:
                    return
                kept = {name: getattr(own, name) for name in ("slot", "rows", "first", "last")}
                text = json.dumps({"stream": stream, "writer": held["writer"], "batch": held["batch"], **kept})
            # Streams of files are read in the order of their dates.
            if not self.files.create(self._note(stream, k), text, before) and k > slot:
                return
            before = max(before, self.files.written_at(self._note(stream, k)))
            k += 1


def write_log(messages: DataFrame, path: str, batch: int | None = None, writer: str = WRITER) -> None:
    """Store ``messages``, with the sequence numbers they have, as a batch of their streams.

    Without a number it is the writer's next batch; a number that is there is replaced.  Files are ranges of
    (stream, seq): a busy stream has many, each with a narrow sequence range that a start position can skip.
    """
    ranged = messages.repartitionByRange("stream", "seq").sortWithinPartitions("stream", "seq")
    store_batch(ranged, path, Ledger(messages.sparkSession, path).next_batch(writer) if batch is None else batch, writer)


def store_batch(messages: DataFrame, path: str, batch: int, writer: str, claimed: dict[str, Record] | None = None) -> None:
    """Write MESSAGE rows as one batch of a writer, count them, then note that it is complete.

    ``claimed`` are the records of streams whose numbers were claimed before; the others' are made from what was written.
    """
    spark = messages.sparkSession
    rows = messages.select(*MESSAGE.names, F.lit(writer).alias("writer"), F.lit(batch).cast("long").alias("batch"))
    store(rows, path, "stream", *BATCH_KEY.names)
    only = f"stream=*/{batch_folder(spark, '', writer, batch).partition('/')[2]}"
    if claimed:
        only = [batch_folder(spark, stream, writer, batch) for stream in claimed]
    own = read_batches(spark, path, only=only)
    bucket = F.floor(F.col("seq") / COUNT_BUCKET).alias("bucket")
    told = own.groupBy("stream", "subject", bucket).agg(
        F.count("*").alias("rows"), F.min("seq").alias("first"), F.max("seq").alias("last")
    )
    key = [F.lit(writer).alias("writer"), F.lit(batch).cast("long").alias("batch")]
    counts = told.select("*", *key).repartitionByRange("stream", "subject", "bucket")
    store(counts, f"{path}/_counts", "stream", *BATCH_KEY.names)
    ledger = Ledger(spark, path)
    if claimed:
        for stream, record in claimed.items():
            ledger.settle(stream, writer, batch, record)
        return
    kept = read_batches(spark, f"{path}/_counts", COUNTS, only)
    streams = kept.groupBy("stream").agg(F.sum("rows").alias("rows"), F.min("first").alias("first"), F.max("last").alias("last"))
    for r in streams.collect():  # streams of one batch
        record = ledger.claim(r["stream"], writer, batch, r["rows"], r["last"], numbered=False)
        ledger.extend(r["stream"], writer, batch, r["last"] or 0)
        ledger.settle(r["stream"], writer, batch, record._replace(rows=r["rows"], first=r["first"], last=r["last"]))


def store(rows: DataFrame, path: str, *partition_columns: str, packing: str | None = None) -> None:
    """Write partitions so that writing the same ones again replaces them."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if packing:
        writer = writer.option("compression", packing)
    writer.partitionBy(*partition_columns).parquet(path)


def base_sequence(spark: SparkSession, path: str, stream: str, batch: int, writer: str) -> int:
    """The number before the first of a batch: as it was when the batch came, else the stream's last one."""
    ledger = Ledger(spark, path)
    record = ledger.record(stream, writer, batch)
    return record.base if record.slot else ledger.last(stream)


def last_sequence(spark: SparkSession, path: str, stream: str) -> int:
    """Last number of a stream."""
    return Ledger(spark, path).last(stream)
