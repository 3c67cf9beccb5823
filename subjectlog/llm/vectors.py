"""Vectors of Arrow columns and tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is neither null, empty nor zero and all its components are finite numbers."""
    big = float("inf")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def lengths(vectors: DataFrame, column: str) -> list[int]:
    """The different lengths of the usable vectors, of which there are as many as kinds of embeddings."""
    return sorted(r["d"] for r in vectors.select(F.size(column).alias("d")).distinct().collect())


def matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    """A list column as (rows, dims) doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dims)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; first by their largest component, so that no square overflows or vanishes."""
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True), np.finfo(np.float64).tiny)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))
