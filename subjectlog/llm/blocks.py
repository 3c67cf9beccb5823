"""Blocks of documents and merged sketches of their hashes.

A block is a run of rows of one input partition, with texts of ``BYTES_PER_BLOCK`` at most: long texts are in blocks of
fewer rows.  Blocks are written once, as a table bucketed by block, so every later pass over them, also one together with
what came back for each block, reads its bucket and shuffles no text.  What a block sends about its hashes is packed: one message a block and shard of the hash space.  So a
hash that a third of all rows share is sent once a block, and no task gathers rows by a hot key.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import release, scratch_path

ROW_BITS = 11
ROWS_PER_BLOCK = 1 << ROW_BITS
CLASS_BITS = 3
BYTES_PER_BLOCK = 1 << 24  # of texts; a text that is longer is a block of its own
BLOCKS_PER_BUCKET = 4
MOST_BUCKETS = 100_000  # Spark takes no more; blocks then share them
SHARD_CELLS = 1 << 23
MESSAGE = "block bigint, shard int, cells binary"
ANSWER = "block bigint, shard int, counts binary"


def block_of(row: Column, size: Column) -> Column:
    """The block of a row with a text of ``size`` bytes (null: none).

    Rows are dealt to few classes by size, each of texts up to eight times as long as the class before, and a class
    has an eighth of the rows a block; in the last each row is a block.  So no block needs a look at other rows.
    """
    doublings = F.log2(F.greatest(size, F.lit(1)) / F.lit(BYTES_PER_BLOCK >> ROW_BITS))
    last = -(-ROW_BITS // CLASS_BITS)
    kind = F.least(F.greatest(F.ceil(doublings / CLASS_BITS), F.lit(0)), F.lit(last))
    kind = F.coalesce(kind, F.lit(0)).cast("int")
    run = F.call_function("shiftright", row, F.greatest(F.lit(ROW_BITS) - kind * CLASS_BITS, F.lit(0)))
    return F.shiftleft(run, 3).bitwiseOR(kind.cast("long"))


def blocked(docs: DataFrame, *columns) -> tuple[DataFrame, int]:
    """``columns`` of ``docs``, which include ``text``, with ``row`` and ``block``, as a written table bucketed by block,
    and the bytes of all texts."""
    spark = docs.sparkSession
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), *columns)
    numbered = numbered.withColumn("block", block_of(F.col("row"), F.octet_length("text")))
    rows, size = docs.agg(F.count("*"), F.sum(F.octet_length("text"))).head()
    size = size or 0
    parts = max(rows // ROWS_PER_BLOCK, size // BYTES_PER_BLOCK, 1)
    buckets = min(MOST_BUCKETS, max(1, -(-parts // BLOCKS_PER_BUCKET)))
    name = f"blocks_{uuid.uuid4().hex}"
    numbered.write.bucketBy(buckets, "block").sortBy("row").option("path", scratch_path(spark, "blocks")).saveAsTable(name)
    return spark.table(name), size


def packed_cells(cells: np.ndarray) -> bytes:
    """Sorted numbers below 2**32 as byte planes of their steps; most planes are zeros, which compress away."""
    steps = np.diff(cells, prepend=np.uint64(0)).astype("<u4")
    return steps.view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked_cells(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint64)


class Sketch:
    """A count-min sketch of ``depth`` rows, as wide as its shards together; a block holds only its own cells."""

    def __init__(self, hashes: float, depth: int = 2, sparse: int = 8):
        self.depth = depth
        self.shards = max(1, round(hashes * sparse * depth / SHARD_CELLS))
        self.row_cells = self.shards * SHARD_CELLS // depth

    def cells(self, hashes: np.ndarray) -> np.ndarray:
        """(hashes, depth) cells."""
        width = np.uint64(self.row_cells)
        out = [hashes % width]
        for k in range(1, self.depth):
            again = (hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5 + k)) * np.uint64(0x9E3779B97F4A7C15)
            out.append((again >> np.uint64(7)) % width + np.uint64(k) * width)
        return np.stack(out, 1)

    def messages(self, block: int, hashes: np.ndarray) -> pa.Table:
        """For each shard the sorted cells of a block's hashes, a cell as often as it is hit, twice at most."""
        flat = np.sort(self.cells(hashes).ravel())
        flat = flat[np.r_[True, True, flat[2:] != flat[:-2]][: len(flat)]] if len(flat) > 2 else flat
        edges = np.searchsorted(flat, np.arange(self.shards + 1, dtype=np.uint64) * np.uint64(SHARD_CELLS))
        rows = [
            (k, packed_cells(flat[a:b] - np.uint64(k * SHARD_CELLS)))
            for k, (a, b) in enumerate(zip(edges, edges[1:]))
            if b > a
        ]
        return pa.table(
            {
                "block": pa.array([block] * len(rows), pa.int64()),
                "shard": pa.array([k for k, _ in rows], pa.int32()),
                "cells": pa.array([c for _, c in rows], pa.binary()),
            }
        )

    def merge(self, messages: DataFrame) -> DataFrame:
        """Sum the blocks' sketches; each block gets back, for its different cells in order, the logarithm of the
        count (0: one hit, 1: two or three, …), a byte a cell."""

        def run(group: pa.Table) -> pa.Table:
            counts = np.zeros(SHARD_CELLS, np.uint32)
            sent = [unpacked_cells(data).astype(np.int64) for data in group["cells"].to_pylist()]
            for cells in sent:  # a cell is in a message once or twice
                own, twice = _different(cells)
                counts[own] += twice
            level = np.zeros(SHARD_CELLS, np.uint8)
            more = np.flatnonzero(counts > 1)
            level[more] = np.log2(counts[more]).astype(np.uint8)
            back = [level[_different(cells)[0]].tobytes() for cells in sent]
            release()
            return pa.table({"block": group["block"], "shard": group["shard"], "counts": pa.array(back, pa.binary())})

        return messages.groupBy("shard").applyInArrow(run, ANSWER)

    def levels(self, hashes: np.ndarray, answer: pa.Table) -> np.ndarray:
        """Estimated level of each hash of a block: the least of its cells'."""
        if not len(hashes):
            return np.zeros(0, np.uint8)
        cells = self.cells(hashes)
        own, _ = _different(np.sort(cells.ravel()))
        edges = np.searchsorted(own, np.arange(self.shards + 1, dtype=np.uint64) * np.uint64(SHARD_CELLS))
        got = np.zeros(len(own), np.uint8)
        for shard, data in zip(answer["shard"].to_pylist(), answer["counts"].to_pylist()):
            got[edges[shard] : edges[shard + 1]] = np.frombuffer(data, np.uint8)
        own, got = own[got > 0], got[got > 0]  # few
        out = np.zeros(len(hashes), np.uint8)
        if not len(own):
            return out
        left = np.arange(len(hashes))
        least = np.full(len(hashes), 255, np.uint8)
        for k in range(self.depth):
            asked = cells[left, k]
            at = np.minimum(np.searchsorted(own, asked), len(own) - 1)
            hit = own[at] == asked
            left, at = left[hit], at[hit]
            least[left] = np.minimum(least[left], got[at])
        out[left] = least[left]
        return out


def _different(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(different numbers, 1 or 2 times each) of sorted numbers of which none is there more than twice."""
    first = np.r_[True, cells[1:] != cells[:-1]][: len(cells)]
    at = np.flatnonzero(first)
    return cells[at], np.minimum(np.diff(np.r_[at, len(cells)]), 2).astype(np.uint32)
