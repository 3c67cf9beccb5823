"""What the operators of this subpackage share: tables, folders, Arrow columns, caches of a worker."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import materialise, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, a lost executor costs nothing."""
    return materialise(df, scratch_path(df.sparkSession, label))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id is in fold -1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(-1))


def worker_cache(name: str, make: Callable[[], object]) -> object:
    """A value kept for the life of a Python worker.  Functions are pickled by value here, so their own
    module's globals are new in each task."""
    held = sys.modules.setdefault("_subjectlog_worker_cache", types.ModuleType("_subjectlog_worker_cache"))
    if not hasattr(held, name):
        setattr(held, name, make())
    return getattr(held, name)


class Kept:
    """Values made from short keys, kept in two generations of at most ``bound`` entries: what was asked for lately stays."""

    def __init__(self, make: Callable, bound: int, longest: int):
        self.make, self.bound, self.longest = make, bound, longest
        self.recent: dict = {}
        self.older: dict = {}

    def of(self, keys: list) -> list:
        found = list(map(self.recent.get, keys))
        at = -1
        try:
            while True:
                at = found.index(None, at + 1)
                found[at] = self[keys[at]]
        except ValueError:  # none left
            return found

    def __getitem__(self, key):
        value = self.recent.get(key)
        if value is None:
            value = self.older.get(key)
            if value is None:
                value = self.make(key)
            if len(key) <= self.longest:
                if len(self.recent) >= self.bound:
                    self.older, self.recent = self.recent, {}
                self.recent[key] = value
        return value


def utf8_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets of the rows) of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):  # no chunk at all
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Have texts sent to Python workers in batches of at most ``rows``, unless the session asks for fewer.

    Spark's own 10,000 rows of long texts are held several times at once: in the JVM, beside it and in Python.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, rows)


def release() -> None:
    """Give memory that this worker has freed back to the system: workers outlive their tasks, and what each keeps for
    later counts against the executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidied(run: Callable) -> Callable:
    """``run``, a function of an iterator of batches, followed by ``release``."""

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return tidy


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to at most ``rows`` rows, so that a task holds little at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def threshold_sample(labelled: DataFrame, bound: int, key: Column) -> DataFrame:
    """About ``bound`` rows, by the hash of ``key`` and alike at each run: all of them if there are fewer.

    The rows are counted first, then a hash threshold keeps the share wanted; nothing is sorted.
    """
    n = labelled.count()
    if n <= bound:
        return labelled
    scaled = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit("sample"), key.cast("string"))), 1, 12), 16, 10)
    return labelled.where(scaled.cast("double") < float(2**48) * bound / n)
