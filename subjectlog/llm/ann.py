"""Approximate nearest neighbours by randomly rotated one-bit codes.

A unit vector is turned by a random rotation into ``bits`` lengths, and only the signs are kept, packed.  The
signs, as a unit vector of their own, have a known inner product with the turned vector (the correction
scalar); the inner product of a query with the vector is estimated as that with the signs over this scalar,
and is off by at most about ``ERROR * sqrt(1 - s*s) / s / sqrt(bits - 1)``.  A vector is reranked by its exact
cosine if its upper bound reaches the k-th best lower bound of the query over the whole table.

Every row is indexed.  The stated queries meet all codes in blocks of ``VECTORS`` x ``QUERIES``, which a task goes
through in slices; one pass finds each query's k-th lower bound, one emits what may beat it.  A block of codes takes
about a megabyte, so that a query's vector is copied once for ``VECTORS`` rows only.  Vectors of the table stay out of
these passes; those of the few candidates are joined afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table, written
from .vectors import lengths, matrix, unit, usable

VECTORS, QUERIES = 1 << 14, 1 << 12
SLICE = 512  # codes compared at a time
LEAST_BITS = 512
ERROR = 2.5


def rotation(dims: int, seed: int = 3) -> np.ndarray:
    """(dims, bits): orthonormal rows, so lengths and angles are kept."""
    bits = max(LEAST_BITS, -(-dims // 64) * 64)
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, dims)))
    return q.T


def codes(x: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs and correction scalars of unit vectors."""
    y = x @ turn
    return np.packbits(y > 0, axis=1), np.abs(y).sum(1) / np.sqrt(turn.shape[1])


def bounds(packed: np.ndarray, scalar: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(queries, vectors) cosines estimated from turned queries, and how far off each vector's may be."""
    bits = turned.shape[1]
    signs = np.unpackbits(packed, axis=1, count=bits).astype(np.float32) * 2 - 1
    estimate = (turned @ signs.T) / (np.sqrt(bits) * scalar[None, :])
    return estimate, ERROR * np.sqrt(np.maximum(0, 1 - scalar * scalar)) / scalar / np.sqrt(bits - 1)


def build_index(vectors: DataFrame, dims: int) -> DataFrame:
    """(vec_id, vector) -> (vec_id, code, scalar), written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(dims)
        for batch in batches:
            if batch.num_rows:
                packed, scalar = codes(unit(matrix(batch.column(1), dims)), turn)
                code = pa.array([row.tobytes() for row in packed], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0), code, pa.array(scalar)], names=["vec_id", "code", "scalar"])

    return written(vectors.mapInArrow(run, "vec_id bigint, code binary, scalar double"), "one-bit-codes")


def search(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """(vec_id, vector) -> (query_id, rank, vec_id, score): the ``k`` nearest found of each query.

    Rows without an id, and vectors that are null, empty, zero or not finite, take no part.  Vectors are near to those
    of their own length only.  Rows of one id are candidates each, but never for the query of that id; of repeated
    query rows the least vector asks.  Ties go to the smaller id.  A query with fewer candidates gets them all;
    without vectors there are no rows.
    """
    fine = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("vector"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), "vector"
    )
    first = F.min(F.struct(F.size("vector").alias("d"), "vector")).alias("row")
    queries = fine.where(is_query).groupBy("vec_id").agg(first).select("vec_id", "row.vector")
    found = vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    for dims in lengths(fine, "vector"):
        of_length = F.size("vector") == dims
        found = found.unionByName(_search(fine.where(of_length), queries.where(of_length), dims, k))
    return found


def _search(fine: DataFrame, queries: DataFrame, dims: int, k: int) -> DataFrame:
    """``search`` among usable vectors of one length."""
    index = build_index(fine, dims)
    vector_blocks = max(1, -(-index.count() // VECTORS))
    query_blocks = max(1, -(-queries.count() // QUERIES))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = index.select(
        "*", F.pmod(F.xxhash64("vec_id"), F.lit(vector_blocks)).cast("int").alias("v"), every(query_blocks).alias("q")
    ).groupBy("v", "q")

    def asked(queries: DataFrame):
        return queries.select(
            "*", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int").alias("q"), every(vector_blocks).alias("v")
        ).groupBy("v", "q")

    def estimated(block: pa.Table, asking: pa.Table):
        """For each slice of the block: its ids, the estimates, how far off they may be, and which are the query itself."""
        if not block.num_rows or not asking.num_rows:
            return
        turned = (unit(matrix(asking["vector"], dims)) @ rotation(dims)).astype(np.float32)
        asked_ids = asking["vec_id"].to_numpy()
        for at in range(0, block.num_rows, SLICE):
            part = block.slice(at, SLICE)
            packed = np.array([np.frombuffer(b, np.uint8) for b in part["code"].to_pylist()])
            ids = part["vec_id"].to_numpy()
            estimate, off = bounds(packed, part["scalar"].to_numpy(), turned)
            yield ids, estimate, off, asked_ids[:, None] == ids[None, :]

    def lower(block: pa.Table, asking: pa.Table) -> pa.Table:
        best = np.full((asking.num_rows, k), -np.inf)
        for _, estimate, off, own in estimated(block, asking):
            low = np.where(own, -np.inf, estimate - off[None, :])
            best = -np.partition(-np.concatenate([best, low], axis=1), k - 1, axis=1)[:, :k]
        ids, flat = np.repeat(asking["vec_id"].to_numpy(), k), best.reshape(-1)
        return pa.table({"query_id": pa.array(ids[flat > -np.inf], pa.int64()), "least": pa.array(flat[flat > -np.inf])})

    def reaching(block: pa.Table, asking: pa.Table) -> pa.Table:
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for ids, estimate, off, own in estimated(block, asking):
            a, b = np.nonzero((estimate + off[None, :] >= asking["bar"].to_numpy()[:, None]) & ~own)
            found.append((asking["vec_id"].to_numpy()[a], ids[b]))
        queries_of, ids_of = (np.concatenate(x) for x in zip(*found))
        return pa.table({"query_id": queries_of, "vec_id": ids_of})

    lows = dealt.cogroup(asked(queries)).applyInArrow(lower, "query_id bigint, least double")
    ranked = lows.withColumn("n", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("least"))))
    kth = ranked.where(F.col("n") <= k).groupBy("query_id").agg(F.min("least").alias("least"), F.count("*").alias("n"))
    bar = F.when(F.col("n") == k, F.col("least") - 1e-6).otherwise(F.lit(float("-inf")))
    with_bar = queries.join(kth.select(F.col("query_id").alias("vec_id"), bar.alias("bar")), "vec_id")
    chosen = dealt.cogroup(asked(written(with_bar, "query-bars"))).applyInArrow(reaching, "query_id bigint, vec_id bigint")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = unit(matrix(batch.column(2), dims)), unit(matrix(batch.column(3), dims))
                score = pa.array((a * b).sum(1))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), score], names=["query_id", "vec_id", "score"])

    asking = queries.select(F.col("vec_id").alias("query_id"), F.col("vector").alias("asking"))
    compared = chosen.distinct().join(fine, "vec_id").join(asking, "query_id").select("query_id", "vec_id", "asking", "vector")
    scored = compared.mapInArrow(exact, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_ann(spark, sf_dir):
    """The 5 nearest vectors of every 50th one."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return search(vectors, F.col("vec_id") % 50 == 0)
