"""Gapless numbering in a global order, without sorting in one task."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import materialise, scratch_path
from .attach import local_frame

_LOW_BITS = 33  # monotonically_increasing_id: partition number above, row in partition below
_OFFSETS = T.StructType([T.StructField("__part", T.LongType()), T.StructField("__offset", T.LongType())])


class Numbered(NamedTuple):
    frame: DataFrame
    last: int  # the highest number given, or the base when there are no rows
    staged: str  # the written rows ``frame`` reads


def number_rows(
    df: DataFrame, order_by: list[str], column: str = "seq", base: int = 0, partitions: int | None = None
) -> Numbered:
    """``df`` with ``column`` = base + 1, base + 2, ... in the order of ``order_by``.

    Rows are range-partitioned and sorted, and written once with their place in their
    partition: a second evaluation could sample other ranges.  The offsets, one row per
    partition, are then added to the written rows.  ``order_by`` should identify a row.
    """
    spark = df.sparkSession
    spread = df.repartitionByRange(partitions, *order_by) if partitions else df.repartitionByRange(*order_by)
    place = F.monotonically_increasing_id()
    staged = scratch_path(spark, "sequence")
    placed = materialise(spread.sortWithinPartitions(*order_by).withColumn("__place", place), staged)
    part = F.shiftright(F.col("__place"), _LOW_BITS)
    row = F.col("__place").bitwiseAND(F.lit((1 << _LOW_BITS) - 1))
    sizes = {r["part"]: r["rows"] for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("rows")).collect()}
    offsets, last = [], base
    for number in sorted(sizes):
        offsets.append((number, last))
        last += sizes[number]
    # As many rows as the shuffle has partitions.
    table = F.broadcast(local_frame(spark, offsets, _OFFSETS))
    numbered = placed.withColumn("__part", part).join(table, "__part")
    frame = numbered.withColumn(column, F.col("__offset") + row + 1).drop("__place", "__part", "__offset")
    return Numbered(frame, last, staged)


def with_sequence(
    df: DataFrame, order_by: list[str], column: str = "seq", base: int = 0, partitions: int | None = None
) -> DataFrame:
    """The numbered rows of ``number_rows``; they stay in the shared folder like a checkpoint."""
    return number_rows(df, order_by, column, base, partitions).frame


def in_order(df: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    """Ordered per key across the partitions of the result; a hot key spans several."""
    return df.repartitionByRange(*keys, seq).sortWithinPartitions(*keys, seq)
