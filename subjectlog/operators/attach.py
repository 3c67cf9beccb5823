"""Joining a small keyed table to a big frame, without trusting it to be small."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..scratch import shuffles_freed

# A side is broadcast only after it was seen to have at most this many rows.
BROADCAST_ROWS = 10_000

# And no more than this.
BROADCAST_BYTES = 32 << 20


def small_rows(df: DataFrame, limit: int | None = None) -> list[Row] | None:
    """All rows of ``df`` when there are at most ``limit``, else None."""
    limit = BROADCAST_ROWS if limit is None else limit
    with shuffles_freed(df.sparkSession):
        rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def arrow_table(rows: list, schema: T.StructType) -> pa.Table:
    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    arrays = [pa.array(list(values), field.type) for values, field in zip(columns, arrow)]
    return pa.Table.from_arrays(arrays, schema=arrow)


def local_frame(spark: SparkSession, rows: list, schema: T.StructType) -> DataFrame:
    """Driver rows as a local relation: Catalyst evaluates what follows at planning time."""
    return spark.createDataFrame(arrow_table(rows, schema), schema)


def attach(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner", limit: int | None = None) -> DataFrame:
    """``big`` joined with ``small`` on ``on``, inner or left; keys are not null.

    A small side within the limits of rows and bytes is broadcast and ``big`` does not move.  Otherwise it is one
    shuffle join, whose hot keys Spark's adaptive execution splits: by ``merge``, as Spark's own estimate goes by the size of
    compressed files and may take a large side for small.
    """
    rows = small_rows(small, limit)
    if rows is not None:
        table = arrow_table(rows, small.schema)
        if table.nbytes <= BROADCAST_BYTES:
            return big.join(F.broadcast(big.sparkSession.createDataFrame(table, small.schema)), on, how)
    return big.join(small.hint("merge"), on, how)
