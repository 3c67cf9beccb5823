"""Exact substring de-duplication: words covered by repeated windows of words are removed.

First every block of documents sends its part of a count-min sketch of all windows; the parts are summed, and a
window whose least count is one occurs once and is out.  Then only windows estimated to be repeated are
grouped, by two 64-bit hashes, each of another hash of the words.  The sketch never counts too little, so no repeated window is lost.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import Sketch, blocked
from .common import table, utf8_buffer, written
from .words import run_hashes, word_hashes

WINDOW = 35
GROUPED_PER_SHARD = 1_500_000
RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string"


def _windows(group: pa.Table, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first hash, second hash, place, words per row) of a block's windows."""
    buffer = utf8_buffer(group["text"])
    words, counts = word_hashes(*buffer)
    first, places = run_hashes(words, counts, window)
    again, _ = word_hashes(*buffer, salt=1)  # words that are alike in one hash differ in the other
    second, _ = run_hashes(again, counts, window, salt=1)
    return first, second, places, counts


def remove_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, kept_sha256 (and ``kept``, the words kept,
    joined by one space, if ``with_text``).

    A window is ``window`` consecutive words of one row; each word of a window whose words also start elsewhere,
    in the same row too, is removed, all at once.  A null or empty text has no words; a text shorter than a
    window loses none.  Repeated rows are rows: all their windows are repeated.  Other columns are ignored.
    """
    rows, size = blocked(docs, F.col("doc_id").cast("long").alias("doc_id"), "text")
    words = size / 6
    sketch = Sketch(words)
    shards = max(1, round(words / GROUPED_PER_SHARD))

    def sketched(group: pa.Table) -> pa.Table:
        words, counts = word_hashes(*utf8_buffer(group["text"]))
        return sketch.messages(group["block"][0].as_py(), run_hashes(words, counts, window)[0])

    answers = written(sketch.merge(rows.groupBy("block").applyInArrow(sketched, "block bigint, shard int, cells binary")), "sketch")

    def estimated(group: pa.Table, answer: pa.Table) -> pa.Table:
        if not group.num_rows:
            return pa.table({"block": pa.array([], pa.int64()), "shard": pa.array([], pa.int32()), "hashes": pa.array([], pa.binary())})
        first, second, _, _ = _windows(group, window)
        maybe = sketch.levels(first, answer) > 0
        both = np.stack([first[maybe], second[maybe]], 1)
        both = both[np.argsort(both[:, 0], kind="stable")]  # two that share 64 bits and not 128 may stay more often
        # a window as often as it is in the block, twice at most
        same = (both[2:] == both[:-2]).all(1) if len(both) > 2 else np.zeros(0, bool)
        both = both[np.r_[True, True, ~same][: len(both)]]
        shard = (both[:, 0] >> np.uint64(40)) % np.uint64(shards)
        order = np.argsort(shard, kind="stable")
        both, shard = both[order], shard[order]
        edges = np.searchsorted(shard, np.arange(shards + 1, dtype=np.uint64))
        sent = [(k, both[a:b].tobytes()) for k, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]
        return pa.table(
            {
                "block": pa.array([group["block"][0].as_py()] * len(sent), pa.int64()),
                "shard": pa.array([k for k, _ in sent], pa.int32()),
                "hashes": pa.array([h for _, h in sent], pa.binary()),
            }
        )

    def grouped(group: pa.Table) -> pa.Table:
        """To each block those of its windows that are repeated, by their first hash."""
        sent = [np.frombuffer(h, np.uint64).reshape(-1, 2) for h in group["hashes"].to_pylist()]
        both = np.concatenate(sent)
        owner = np.repeat(np.arange(len(sent)), [len(s) for s in sent])
        order = np.lexsort((both[:, 1], both[:, 0]))
        both, owner = both[order], owner[order]
        next_same = (both[1:] == both[:-1]).all(1)
        repeated = np.r_[next_same, False] | np.r_[False, next_same]
        both, owner = both[repeated, 0], owner[repeated]
        order = np.argsort(owner, kind="stable")
        both, owner = both[order], owner[order]
        edges = np.searchsorted(owner, np.arange(len(sent) + 1))
        back = [np.unique(both[a:b]).tobytes() for a, b in zip(edges, edges[1:])]
        return pa.table({"block": group["block"], "hashes": pa.array(back, pa.binary())})

    by_block = rows.groupBy("block")
    maybe = by_block.cogroup(answers.groupBy("block")).applyInArrow(estimated, "block bigint, shard int, hashes binary")
    repeated = maybe.groupBy("shard").applyInArrow(grouped, "block bigint, hashes binary")

    def cleaned(group: pa.Table, back: pa.Table) -> pa.Table:
        words, counts = word_hashes(*utf8_buffer(group["text"]))
        first, places = run_hashes(words, counts, window)
        parts = [np.frombuffer(h, np.uint64) for h in back["hashes"].to_pylist()]
        known = np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)
        starts = places[_among(first, known)]
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, starts, 1)
        np.add.at(change, starts + window, -1)
        covered = np.cumsum(change)[: len(words)] > 0
        ends = np.cumsum(counts)
        running = np.concatenate([[0], np.cumsum(covered)])
        removed = running[ends] - running[ends - counts]
        kept, digests = [], []
        for text, a, b, n in zip(group["text"].to_pylist(), ends - counts, ends, removed):
            own = (text or "").encode("utf-8", "replace").split()  # at the same six characters
            if n:
                own = compress(own, ~covered[a:b])
            joined = b" ".join(own)
            digests.append(hashlib.sha256(joined).hexdigest())
            if with_text:
                kept.append(joined.decode())
        return pa.table(
            {
                "doc_id": group["doc_id"],
                "n_words": pa.array(counts, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "kept_sha256": pa.array(digests, pa.string()),
                "kept": pa.array(kept if with_text else [None] * len(digests), pa.string()),
            }
        )

    out = by_block.cogroup(repeated.groupBy("block")).applyInArrow(cleaned, RESULT)
    return out if with_text else out.drop("kept")


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


def op7_substring_dedup(spark, sf_dir):
    """Every document without the words that repeated windows of 35 words cover."""
    return remove_repeats(table(spark, sf_dir, "documents"))
