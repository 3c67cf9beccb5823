"""Shared folder for written intermediates.

A cluster names it in ``spark.checkpoint.dir``; it must be visible to every executor.  Where that is unset
a folder of the warehouse is used, which executors share as well.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

# Of tables of ids: these are digits of random bits, which take half their letters' room where letters are coded by frequency.
PACKING = "zstd"

_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_given: dict[str, str] = {}
_open: Counter[str] = Counter()
_lock = Lock()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Actions in here remove their shuffle files when they end, not when the driver collects garbage: what is left of
    them are their results."""
    session = spark._jsparkSession.sessionUUID()
    with _lock:  # the setting is the session's, which threads share
        if not _open[session]:
            _given[session] = spark.conf.get(_FREED)
            spark.conf.set(_FREED, "true")
        _open[session] += 1
    try:
        yield
    finally:
        with _lock:
            _open[session] -= 1
            if not _open[session]:
                del _open[session]
                spark.conf.set(_FREED, _given.pop(session))


def scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    return root.rstrip("/") if root else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediates"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, path: str, lean: bool = False) -> DataFrame:
    """Write ``df`` once and read it back, so later passes see the same rows.

    ``lean`` ones are mostly ids: they are packed, and the shuffles that made them go.
    """
    if lean:
        with shuffles_freed(df.sparkSession):
            df.write.option("compression", PACKING).parquet(path)
    else:
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove an intermediate of ``scratch_path`` that nothing reads any more."""
    if not path.startswith(scratch_root(spark) + "/"):
        raise ValueError(f"not an intermediate: {path}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
