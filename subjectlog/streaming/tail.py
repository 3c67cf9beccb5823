"""Live subjects: only what is published after the subscription starts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.subscribe import positioned, select_splits
from ..operators.subscriptions import require_subjects, subscriptions
from ..schema import MESSAGE
from ..sources.log import finished_batches, stream_log


def live_marks(spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
    """The batches that were complete when a live subscription first started.

    They are kept beside the query's checkpoint and taken from there when it is started again, in whatever process.
    """
    kept = f"{checkpoint.rstrip('/')}-marks"
    if _absent(spark, kept):
        marks = finished_batches(spark, path).select("stream", "writer", "batch").distinct()
        marks.coalesce(1).write.mode("overwrite").parquet(f"{kept}/taken")
    return spark.read.parquet(f"{kept}/taken")


def _absent(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/taken/_SUCCESS")
    return not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def live_tail(
    spark: SparkSession,
    path: str,
    stream: str,
    subjects: list[str],
    checkpoint: str,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Messages, numbered or not, that come to the log at ``path`` after this was first called for ``checkpoint``.

    Run it with that checkpoint: what is published while the query is down is read when it is back (at least once).
    """
    marks = live_marks(spark, path, checkpoint)
    keys = marks.columns
    coming = stream_log(spark, path, files_per_trigger, with_batch=True).join(marks, keys, "left_anti")
    subs = subscriptions(spark, [{"stream": stream, "subject": s} for s in require_subjects(subjects)])
    hits = select_splits(coming.select(*MESSAGE.names), positioned(subs))
    return hits.select(*MESSAGE.names, "split_id")
