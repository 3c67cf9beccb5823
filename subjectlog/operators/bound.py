"""First n messages of each split, in sequence order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import SEQ_BUCKET
from .attach import attach


def first_n(rows: DataFrame, n: str, keys: list[str] | None = None, seq: str = "seq") -> DataFrame:
    """Keep the ``rows[n]`` lowest sequence numbers per key; a null or unset ``n`` keeps all.

    ``n`` is constant within a key.  Only key columns are shuffled: each key's last kept sequence
    number is found first, then the rows are filtered where they are.
    """
    keys = keys or ["split_id"]
    last = last_kept(rows, n, keys, seq)
    cut = attach(rows, last, keys, "left")
    return cut.where(F.col("__last").isNull() | (F.col(seq) <= F.col("__last"))).drop("__last")


def last_kept(rows: DataFrame, n: str, keys: list[str], seq: str = "seq") -> DataFrame:
    """(keys, __last): the n-th lowest sequence number, for keys with more than n rows.

    Counting per (key, bucket) finds the bucket the bound falls into; only that bucket is
    ranked, so no task sorts more than one bucket of a key.
    """
    slim = rows.where(F.col(n) > 0).select(*keys, n, seq, F.floor(F.col(seq) / SEQ_BUCKET).alias("__bucket"))
    counted = slim.groupBy(*keys, "__bucket").agg(F.count("*").alias("__rows"), F.first(n).alias(n))
    upto = Window.partitionBy(*keys).orderBy("__bucket")
    running = counted.withColumn("__upto", F.sum("__rows").over(upto))
    need = F.col(n) - (F.col("__upto") - F.col("__rows"))
    # One bucket per key: the bound is passed there and was not passed before.  need = 0 when
    # the buckets before hold exactly n rows.
    edge = running.where((F.col("__upto") > F.col(n)) & (need >= 0)).select(*keys, "__bucket", need.alias("__need"))
    ranked = (
        attach(slim, edge, [*keys, "__bucket"])
        .withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(seq)))
        .where(F.col("__rn") <= F.greatest(F.col("__need"), F.lit(1)))
    )
    return ranked.groupBy(*keys).agg(
        F.when(F.max("__need") > 0, F.max(seq)).otherwise(F.min(seq) - 1).alias("__last")
    )
