"""Even distribution of splits over readers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sequence import number_rows


def balance(splits: DataFrame, order_by: list[str], readers: int, column: str = "reader") -> DataFrame:
    """Contiguous chunks in order; the first ``n mod readers`` readers get one split more."""
    counted = number_rows(splits, order_by, "__n")
    numbered = counted.frame.withColumn("__n", F.col("__n") - 1)
    small, larger = divmod(counted.last, readers)
    head = larger * (small + 1)
    in_head = F.floor(F.col("__n") / (small + 1))
    in_rest = larger + F.floor((F.col("__n") - head) / max(small, 1))
    reader = F.when(F.col("__n") < head, in_head).otherwise(in_rest)
    return numbered.withColumn(column, reader.cast("int")).drop("__n")
