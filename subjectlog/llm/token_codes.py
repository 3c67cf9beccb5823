"""Token ids in files of directly addressable codes.

A segment holds the ids of some documents.  Each id is cut into chunks of ``CHUNK_BITS`` bits, low ones first.
Level 0 has the first chunk of every id, level k the (k+1)-th chunk of those ids that have one; a bitmap a
level says which ids go on, and a rank directory counts its ones up to every ``RANK_EVERY``-th position.  So
``token_at`` finds any id by at most one look-up a level, without decoding its neighbours.

Documents are range-partitioned and sorted by id as text, tokenised where they land, and each partition writes
its segments; offsets over the whole table come from the segments' totals.  The images are rows of a Parquet
table, so Spark's committer keeps lost or repeated tasks out and any store that Spark writes to will do.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Kept, scratch_path, slices, table, worker_cache

MAGIC = b"DAC1"
CHUNK_BITS = 8
RANK_EVERY = 512
SEGMENT_IDS = 1_000_000
KEPT_WORDS = 400_000
LONGEST_KEPT = 64
SEGMENT = "part int, segment int, n_tokens bigint, doc_ids array<bigint>, image binary"
# fixed value: how the tokenizer splits a text into pieces
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# the same for printable Latin-1 and white space, whose letters and numbers are these
PLAIN = re.compile("[\t-\r\x20-\x7e\xa1-\xff]+")
_LETTERS, _NUMBERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
PLAIN_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_LETTERS}{_NUMBERS}\t-\r ]+")
TOKEN_DOC = "doc_id bigint, part int, segment int, at bigint, n_tokens bigint, ids_crc32 bigint"


def pack(ids: np.ndarray, lengths: np.ndarray) -> bytes:
    """The image of a segment: ids of all its documents in a row, and how many each has."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest >> CHUNK_BITS
        goes_on = more > 0
        chunks = (rest & ((1 << CHUNK_BITS) - 1)).astype(np.uint8)
        ones = np.concatenate([[0], np.cumsum(goes_on, dtype=np.uint32)])[::RANK_EVERY].astype("<u4")
        levels.append((chunks.tobytes(), np.packbits(goes_on, bitorder="little").tobytes(), ones.tobytes()))
        rest = more[goes_on]
        if not len(rest):
            break
    head = struct.pack("<4sIQQ", MAGIC, len(levels), len(ids), len(lengths))
    sizes = b"".join(struct.pack("<QQQ", *map(len, level)) for level in levels)
    return head + sizes + lengths.astype("<u4").tobytes() + b"".join(b"".join(level) for level in levels)


def _open(image: bytes) -> tuple[int, np.ndarray, list]:
    magic, n_levels, n, docs = struct.unpack_from("<4sIQQ", image)
    if magic != MAGIC:
        raise ValueError("not a segment of token codes")
    at = 24
    sizes = [struct.unpack_from("<QQQ", image, at + 24 * k) for k in range(n_levels)]
    at += 24 * n_levels
    lengths = np.frombuffer(image, "<u4", docs, at)
    at += 4 * docs
    levels = []
    for a, b, c in sizes:
        levels.append(
            (
                np.frombuffer(image, np.uint8, a, at),
                np.frombuffer(image, np.uint8, b, at + a),
                np.frombuffer(image, "<u4", c // 4, at + a + b),
            )
        )
        at += a + b + c
    return n, lengths, levels


def token_at(image: bytes, i: int) -> int:
    """The i-th id of a segment, by one chunk a level."""
    n, _, levels = _open(image)
    if not 0 <= i < n:
        raise IndexError(i)
    value = shift = 0
    for chunks, bits, ones in levels:
        value |= int(chunks[i]) << shift
        if not bits[i >> 3] >> (i & 7) & 1:
            return value
        block = i // RANK_EVERY
        from_byte = block * RANK_EVERY >> 3
        rank = int(ones[block]) + int.from_bytes(bits[from_byte : (i >> 3) + 1].tobytes(), "little").__and__(
            (1 << (i - block * RANK_EVERY)) - 1
        ).bit_count()
        i, shift = rank, shift + CHUNK_BITS
    return value


def unpack(image: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(ids, lengths) of a segment."""
    _, lengths, levels = _open(image)
    value = np.zeros(0, np.uint32)
    for chunks, bits, _ in reversed(levels):
        here = chunks.astype(np.uint32)
        goes_on = np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)
        here[goes_on] |= value << CHUNK_BITS
        value = here
    return value, lengths


class _Words:
    """Ids of texts, by the tokenizers library; the tokenizer treats words between white space apart.

    A text of printable Latin-1 is what normalising makes of it, but for capitals and white space, and the tokenizer's
    own pattern finds its pieces, so only their merges are left to the library.  Of other texts whole words are.
    """

    def __init__(self, description: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(description)
        said = json.loads(description)
        steps = (said.get("pre_tokenizer") or {}).get("pretokenizers") or []
        kinds = [n.get("type") for n in (said.get("normalizer") or {}).get("normalizers") or []]
        pattern = ((steps[0].get("pattern") or {}).get("Regex") if steps else None, [x.get("type") for x in steps])
        self.plain = kinds == ["NFC", "Replace", "Lowercase"] and pattern == (SPLIT, ["Split", "ByteLevel"])
        self.lowers = "Lowercase" in kinds
        self.added = [t["content"].lower() for t in said.get("added_tokens") or []]
        # bytes as the symbols that merges are written in: printable ones stand for themselves
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        self.symbols = {b: 256 + i for i, b in enumerate(others)}
        self.packed = [struct.pack("<I", i) for i in range(self.tokenizer.get_vocab_size())]
        self.pieces = Kept(self._piece, KEPT_WORDS, LONGEST_KEPT)
        self.words = Kept(self._word, KEPT_WORDS // 4, LONGEST_KEPT)

    def _piece(self, piece: str) -> bytes:
        symbols = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.symbols)
        packed = self.packed
        return b"".join([packed[t.id] for t in self.tokenizer.model.tokenize(symbols)])

    def _word(self, word: bytes) -> bytes:
        return b"".join([self.packed[i] for i in self.tokenizer.encode(word.decode(), add_special_tokens=False).ids])

    def encode(self, text: str | None) -> bytes:
        """Little-endian 32-bit ids of a text."""
        if not text:
            return b""
        low = text.lower() if self.lowers else text
        added = any(t in low for t in self.added)  # matched before anything else, and as they are written
        if self.plain and not added and PLAIN.fullmatch(text):
            return b"".join(self.pieces.of(PLAIN_PIECE.findall(low)))
        data = text.encode("utf-8", "replace")
        if self.lowers and not added:
            data = data.lower()  # ASCII capitals: fewer different words
        return b"".join(self.words.of(data.split()))  # at ASCII white space


def splits_at_white_space(description: str) -> bool:
    """Whether the tokenizer drops white space and so treats the words between it apart."""
    said = json.loads(description)
    steps = said.get("pre_tokenizer") or {}
    steps = steps.get("pretokenizers", [steps])
    first = steps[0] if steps else {}
    pattern = (first.get("pattern") or {}).get("Regex", "")
    removed = first.get("behavior") == "Removed" and first.get("invert") is True
    return removed and " " not in pattern and r"[^\s" in pattern


def write_codes(docs: DataFrame, description: str, path: str, end_id: int | None = 2) -> None:
    """Tokenise ``docs`` (doc_id, text) and write their ids, in ascending order of doc_id, to ``path``.

    ``description`` is a tokenizer of the tokenizers library as JSON.  A null or empty text has no ids but the
    end id; a null doc_id comes first; rows of one id stay together, in any order; an empty table writes no
    segment.  Other columns are ignored.
    """
    if not splits_at_white_space(description):
        raise ValueError("the tokenizer must drop white space")
    sent = docs.sparkSession.sparkContext.broadcast(description)
    key = zlib.crc32(description.encode())
    end = b"" if end_id is None else struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, segment = TaskContext.get().partitionId(), 0
        words = worker_cache(f"words_{key}", lambda: _Words(sent.value))
        doc_ids: list = []
        coded: list[bytes] = []
        held = 0

        def flush() -> pa.RecordBatch:
            lengths = np.array([len(c) // 4 for c in coded], np.int64)
            image = pack(np.frombuffer(b"".join(coded), "<u4"), lengths)
            values = [[part], [segment], [int(lengths.sum())], [doc_ids], [image]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
            names = ["part", "segment", "n_tokens", "doc_ids", "image"]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=names)

        for batch in slices(batches, 256):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = words.encode(text)
                doc_ids.append(doc_id)
                coded.append(ids + end)
                held += len(ids) // 4 + 1
                if held >= SEGMENT_IDS:
                    yield flush()
                    doc_ids, coded, held, segment = [], [], 0, segment + 1
        if doc_ids:
            yield flush()

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = narrow.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first()
    )
    ordered.mapInArrow(run, SEGMENT).write.parquet(path)


def segment_starts(spark: SparkSession, path: str) -> DataFrame:
    """The segments of ``path`` with ``start``: ids of all segments before.  Partitions are totalled first, so
    that one row a partition meets in one task."""
    segments = spark.read.schema(SEGMENT).parquet(path)
    whole = segments.groupBy("part").agg(F.sum("n_tokens").alias("in_part"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = whole.select(F.col("part").alias("of_part"), F.coalesce(F.sum("in_part").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = segments.select("part", "segment", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("past"))
    return starts.join(parts, F.col("part") == F.col("of_part")).select(
        "part", "segment", (F.col("base") + F.col("past")).alias("start")
    )


def read_codes(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files at ``path``: doc_id, start, n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, segment, doc_ids, image in zip(*(batch.column(i).to_pylist() for i in range(4))):
                ids, lengths = unpack(image)
                ends = np.cumsum(lengths, dtype=np.int64)
                at = ends - lengths
                data = ids.astype("<u4").tobytes()
                crcs = [zlib.crc32(memoryview(data)[4 * a : 4 * b]) for a, b in zip(at, ends)]
                n = len(doc_ids)
                arrays = [
                    pa.array(doc_ids, pa.int64()),
                    pa.array([part] * n, pa.int32()),
                    pa.array([segment] * n, pa.int32()),
                    pa.array(at, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(crcs, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(
                    arrays, names=["doc_id", "part", "segment", "at", "n_tokens", "ids_crc32"]
                )

    images = spark.read.schema(SEGMENT).parquet(path).select("part", "segment", "doc_ids", "image")
    starts = segment_starts(spark, path)
    # segments are some thousandths of the documents: the join is on (part, segment) and has no hot key
    found = images.mapInArrow(run, TOKEN_DOC)
    return found.join(starts, ["part", "segment"]).select(
        "doc_id", (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def tokens_at(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """(position, token) of each different ``position`` in the files at ``path``, counted over all documents from 0.

    A segment is found by the bins of ``SEGMENT_IDS`` positions that it reaches into, and read once for the positions in it,
    each by one chunk a level.  Null positions, and those before the first or behind the last id, have no row; neither
    has any in an empty table.  Other columns are ignored.
    """
    sizes = spark.read.schema(SEGMENT).parquet(path).select("part", "segment", "n_tokens").where("n_tokens > 0")
    spans = segment_starts(spark, path).join(sizes, ["part", "segment"])
    reach = F.sequence(F.floor(F.col("start") / SEGMENT_IDS), F.floor((F.col("start") + F.col("n_tokens") - 1) / SEGMENT_IDS))
    binned = spans.select("part", "segment", "start", "n_tokens", F.explode(reach).alias("bin"))
    wanted = positions.select(F.col("position").cast("long").alias("position")).where("position >= 0").distinct()
    met = wanted.withColumn("bin", F.floor(F.col("position") / SEGMENT_IDS)).join(binned, "bin")
    inside = met.where("position >= start AND position < start + n_tokens")
    asked = inside.groupBy("part", "segment", "start").agg(F.collect_list("position").alias("positions"))  # a segment's at most
    images = spark.read.schema(SEGMENT).parquet(path).select("part", "segment", "image")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 16):
            for start, places, image in zip(*(batch.column(i).to_pylist() for i in range(3))):
                found = [token_at(image, p - start) for p in places]
                yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(found, pa.int64())], names=["position", "token"])

    return asked.join(images, ["part", "segment"]).select("start", "positions", "image").mapInArrow(run, "position bigint, token bigint")


def public_description(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


def op8_token_codes(spark, sf_dir):
    """Every document's place and checksum in the written token files."""
    path = scratch_path(spark, "token-codes")
    write_codes(table(spark, sf_dir, "documents"), public_description(), path)
    return read_codes(spark, path)
