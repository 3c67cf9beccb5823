"""Neighbours in sequence order: quiet periods and order checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import epoch_micros
from ..schema import SEQ_BUCKET
from .attach import attach


def with_previous(rows: DataFrame, value: str, keys: list[str], keep, seq: str = "seq") -> DataFrame:
    """Rows for which ``keep(value, previous value)`` holds, with ``previous``.

    Neighbours are found per (key, sequence bucket).  The first row of a bucket looks at the end
    of the bucket before, of which there is one row, so no task holds a whole key.
    """
    slim = rows.select(*keys, seq, value, F.floor(F.col(seq) / SEQ_BUCKET).alias("__bucket"))
    inside = Window.partitionBy(*keys, "__bucket").orderBy(seq)
    marked = slim.withColumns({"previous": F.lag(value).over(inside), "__first": F.lag(seq).over(inside).isNull()})
    ends = slim.groupBy(*keys, "__bucket").agg(F.max(F.struct(F.col(seq).alias("seq"), F.col(value).alias("value"))).alias("__end"))
    across = Window.partitionBy(*keys).orderBy("__bucket")
    before = ends.select(*keys, "__bucket", F.lag("__end.value").over(across).alias("__before"))
    seam = F.when(F.col("__first"), F.col("__before")).otherwise(F.col("previous"))
    closed = attach(marked, before, [*keys, "__bucket"], "left").withColumn("previous", seam)
    return closed.where(keep(F.col(value), F.col("previous"))).select(*keys, seq, value, "previous")


def quiet_gaps(messages: DataFrame, quiet_micros: int, keys: list[str] | None = None) -> DataFrame:
    """Messages that follow a silence of at least ``quiet_micros``, with its length."""
    keys = keys or ["stream"]
    timed = messages.select(*keys, "seq", epoch_micros(F.col("ts")).alias("at"))
    quiet = with_previous(timed, "at", keys, lambda now, before: now - before >= quiet_micros)
    return quiet.select(*keys, "seq", (F.col("at") - F.col("previous")).alias("gap_micros"))


def before_first_gap(messages: DataFrame, quiet_micros: int, keys: list[str] | None = None) -> DataFrame:
    """What a reader that stops at the first such silence has read."""
    keys = keys or ["stream"]
    stop = quiet_gaps(messages, quiet_micros, keys).groupBy(*keys).agg(F.min("seq").alias("__stop"))
    cut = attach(messages, stop, keys, "left")
    return cut.where(F.col("__stop").isNull() | (F.col("seq") < F.col("__stop"))).drop("__stop")
