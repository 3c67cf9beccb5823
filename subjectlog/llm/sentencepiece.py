"""SentencePiece encoding (merge type) by backtracking, and decoding.

A text is encoded as the merges would: the best-scored adjacent pair first, ties to the left.  Instead of
merging, tokens are laid from left to right.  At each position an Aho-Corasick automaton has given the pieces
that start there; the longest is tried first, and a piece may follow another only if merging the text of the
two again gives exactly these two, which the merges of each alone, noted once, tell.  A sequence whose neighbours all pass is the one that merging gives, and a
prefix has only one such sequence, so an end that cannot be continued has failed for good: a field with one
flag a position keeps the search linear.

Parts of a text that no piece can span are encoded apart, and those of short words are kept in a bounded cache
of the Python worker.  The model's bytes travel to the executors, which need no file of their own.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
import string
import struct
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Kept, slices, small_batches, table, tidied, worker_cache

SPACE = "▁"
KEPT_WORDS = 300_000  # cached words of a generation; two generations are held
LONGEST_KEPT = 48
KEPT_ANSWERS = 1_000_000
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
OUTPUTS = {
    "n_tokens": pa.int64(),
    "ids": pa.list_(pa.int32()),
    "ids_sha256": pa.string(),
    "decoded": pa.string(),
    "decoded_sha256": pa.string(),
}
SPARK_TYPES = {
    "n_tokens": "bigint",
    "ids": "array<int>",
    "ids_sha256": "string",
    "decoded": "string",
    "decoded_sha256": "string",
}


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            value = varint()
        elif kind == 2:
            n = varint()
            value, at = data[at : at + n], at + n
        elif kind in (1, 5):
            n = 8 if kind == 1 else 4
            value, at = data[at : at + n], at + n
        else:
            raise ValueError(f"wire type {kind}")
        yield tag >> 3, value


class PieceModel:
    """Pieces and rules of a model file.  Field numbers are fixed values of the file format."""

    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        self.scores: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.kinds: list[int] = []
        trainer, rules = {}, {}
        for number, value in _fields(data):
            if number == 1:
                one = dict(_fields(value))
                piece, kind = one.get(1, b"").decode(), one.get(3, NORMAL)
                if kind == NORMAL:
                    self.ids[piece] = len(self.pieces)
                    self.scores[piece] = struct.unpack("<f", one[2])[0] if 2 in one else 0.0
                self.pieces.append(piece)
                self.kinds.append(kind)
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                rules = dict(_fields(value))
        if trainer.get(3, 1) != 2:
            raise ValueError("only models of the merge type are supported")
        if not set(self.kinds) <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("user-defined and unused pieces are not supported")
        if rules.get(2) or rules.get(4, 1) or not rules.get(5, 1):
            raise ValueError("only texts taken as they are, with marked spaces, are supported")
        self.dummy_prefix = bool(rules.get(3, 1))
        self.byte_ids = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if self.kinds[i] == BYTE}
        self.bytes_of = {i: bytes([b]) for b, i in self.byte_ids.items()}
        unknown = [i for i, k in enumerate(self.kinds) if k == UNKNOWN]
        self.unknown = unknown[0] if unknown else 0


class Piece:
    """A piece of the model, or a character without one, as the encoder goes through them."""

    __slots__ = ("text", "size", "reach", "ids", "shorter", "before", "history")

    def __init__(self, text: str, ids: tuple[int, ...]):
        self.text, self.size, self.reach, self.ids = text, len(text), len(text) - 1, ids
        self.shorter: Piece | None = None  # the next shorter one, at least a character, that it starts with
        self.before: dict[Piece, bool] = {}  # those asked for: may they follow this one?
        self.history: tuple | bool | None = None  # of ``Codec.history``, once asked for


class Codec:
    """Encoder and decoder of one model."""

    def __init__(self, data: bytes):
        import ahocorasick

        self.model = m = PieceModel(data)
        self.automaton = ahocorasick.Automaton()
        self.inside = set()  # adjacent characters that some piece holds
        pieces = {text: Piece(text, (i,)) for text, i in m.ids.items()}
        self.single = {text: piece for text, piece in pieces.items() if piece.size == 1}
        self.strange: dict[str, Piece] = {}  # characters without a piece
        for text, piece in pieces.items():
            self.automaton.add_word(text, piece)
            self.inside.update(zip(text, text[1:]))
            if piece.size > 1:
                shorter = next((p for i in range(piece.reach, 0, -1) if (p := pieces.get(text[:i]))), None)
                piece.shorter = shorter or self.character(text[0])
        self.automaton.make_automaton()
        self.first = Piece("", ())  # what the first piece follows
        self.asked: list[Piece] = []  # those with answers, once for each
        self.answers = 0
        self.kept = Kept(self._encode_part, KEPT_WORDS, LONGEST_KEPT)
        held = {c for pair in self.inside for c in pair}
        lone = "".join(re.escape(c) for c in "\n\t\r\v\f" if c not in held)
        space_starts = all(a == SPACE for a, b in self.inside if b == SPACE)
        lone_class = f"|[{lone}]" if lone else ""
        # words with the spaces before them, if no piece holds a space after something else; punctuation is parted
        # from a word before it, if that has only letters and digits that no piece holds before punctuation
        marks = re.escape(string.punctuation)
        before_marks = "".join({re.escape(a) for a, b in self.inside if a.isalnum() and b in string.punctuation})
        rest = f"(?:(?=[{marks}])|[^{SPACE}{lone}]*)"
        words = rf"{SPACE}*[^\W_{before_marks}]++{rest}|{SPACE}*[^{SPACE}{lone}]+|{SPACE}+{lone_class}"
        self.parts = re.compile(words if space_starts else ".+", re.S)
        self.text_of = [
            p.replace(SPACE, " ") if k == NORMAL else " ⁇ " if k == UNKNOWN else "" for p, k in zip(m.pieces, m.kinds)
        ]
        self.decimal = [str(i) for i in range(len(m.pieces))]

    def character(self, c: str) -> Piece:
        """The piece of one character, or what stands for it."""
        piece = self.single.get(c) or self.strange.get(c)
        if piece is None:
            if len(self.strange) >= 10_000:
                self.strange.clear()
            codes = self.model.byte_ids
            ids = tuple(codes[b] for b in c.encode("utf-8", "replace")) if codes else (self.model.unknown,)
            piece = self.strange[c] = Piece(c, ids)
        return piece

    def merges(self, text: str) -> tuple[list[str], list[tuple[float, str, str]]]:
        """(parts, steps) of plain merging of a few characters; a step has its score and the first and last part then."""
        parts = list(text)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        scores = self.model.scores
        queue, steps, last = [], [], len(parts) - 1

        def offer(i: int) -> None:
            j = after[i]
            if j < len(parts) and (score := scores.get(parts[i] + parts[j])) is not None:
                heapq.heappush(queue, (-score, i, parts[i], parts[j]))

        for i in range(len(parts) - 1):
            offer(i)
        while queue:
            score, i, left, right = heapq.heappop(queue)
            j = after[i]
            if parts[i] != left or j >= len(parts) or parts[j] != right or not left:
                continue
            parts[i], parts[j] = left + right, ""
            after[i] = after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            else:
                last = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
            steps.append((-score, parts[0], parts[last]))
        return [p for p in parts if p], steps

    def history(self, piece: Piece) -> tuple | bool:
        """(scores, first parts, last parts) while a piece is merged from its characters, a part before each score
        and one after the last; False if merging does not give the piece."""
        if piece.history is None:
            parts, steps = self.merges(piece.text)
            text = piece.text
            piece.history = parts == [text] and (
                [*(s for s, _, _ in steps), -math.inf],
                [text[0], *(f for _, f, _ in steps)],
                [text[-1], *(e for _, _, e in steps)],
            )
        return piece.history

    def may_follow(self, left: Piece, right: Piece) -> bool:
        """Does merging the text of the two give these two?  Until something merges across their border each is
        merged as if alone, so their merges are gone through in order of score, ties to the left, and at each
        the last part of the one and the first of the other are asked for a merge that comes before."""
        if self.answers >= KEPT_ANSWERS:
            for piece in self.asked:
                piece.before = {}
            self.asked, self.answers = [], 0
        if not left.before:
            self.asked.append(left)
        self.answers += 1
        known = left.before[right] = self._stay_apart(left, right)
        return known

    def _stay_apart(self, left: Piece, right: Piece) -> bool:
        ahead = self.history(right)
        if not ahead or not left.size:
            return bool(ahead)
        behind = self.history(left)
        if not behind:
            return False
        scores = self.model.scores
        (lefts, _, lasts), (rights, firsts, _) = behind, ahead
        i = j = 0
        while True:
            a, b = lefts[i], rights[j]
            across = scores.get(lasts[i] + firsts[j])
            if across is not None and across > a and across >= b:
                return False
            if a == b == -math.inf:
                return True
            if a >= b:
                i += 1
            else:
                j += 1

    def backtracked(self, text: str) -> list[Piece]:
        longest: list[Piece | None] = [None] * len(text)
        for end, piece in self.automaton.iter(text):
            longest[end - piece.reach] = piece  # longer ones end, and so come, later
        failed = bytearray(len(text) + 1)
        tokens: list[Piece] = []
        last, at, stop = self.first, 0, len(text)
        token = longest[0] or self.character(text[0])
        while True:
            while token is not None:
                if not failed[at + token.size]:
                    fits = last.before.get(token)
                    if fits is None:
                        fits = self.may_follow(last, token)
                    if fits:
                        break
                token = token.shorter
            if token is not None:
                tokens.append(token)
                at += token.size
                if at == stop:
                    return tokens
                last = token
                token = longest[at] or self.character(text[at])
            else:  # no way on from here
                failed[at] = 1
                token = tokens.pop()
                at -= token.size
                last = tokens[-1] if tokens else self.first
                token = token.shorter

    def _encode_part(self, part: str) -> tuple[int, ...]:
        if len(part) <= LONGEST_KEPT:
            return tuple([i for piece in self.backtracked(part) for i in piece.ids])
        out: list[int] = []
        at = 0
        inside = self.inside
        cuts = [i for i, pair in enumerate(zip(part, part[1:]), 1) if pair not in inside]
        for end in [*cuts, len(part)]:
            span, at = part[at:end], end
            if len(span) <= LONGEST_KEPT:
                out += self.kept[span]
            else:
                for piece in self.backtracked(span):
                    out += piece.ids
        return tuple(out)

    def encode(self, text: str | None) -> list[int]:
        """Token ids, without begin or end; none for an empty or null text."""
        if not text:
            return []
        text = text.replace(" ", SPACE)
        if self.model.dummy_prefix:
            text = SPACE + text
        return list(chain.from_iterable(self.kept.of(self.parts.findall(text))))

    def decode(self, ids: list[int]) -> str:
        """The text of ids: marked spaces become spaces, the one put in front goes, byte pieces are joined."""
        if self.model.bytes_of.keys().isdisjoint(ids):
            text = "".join(map(self.text_of.__getitem__, ids))
        else:
            parts, run = [], b""
            for i in ids:
                if (b := self.model.bytes_of.get(i)) is not None:
                    run += b
                    continue
                if run:
                    parts.append(run.decode("utf-8", "replace"))
                    run = b""
                parts.append(self.text_of[i])
            text = "".join(parts) + run.decode("utf-8", "replace")
        return text[1:] if self.model.dummy_prefix and text[:1] == " " and ids[0] not in self.model.bytes_of else text


def encode_documents(
    docs: DataFrame, model: bytes, outputs: tuple = ("ids",), id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, outputs...) of every whole text; ``outputs`` are of ``OUTPUTS``: the ids, the text decoded from them,
    their number and digests.  Null and empty texts have no ids and decode to an empty text.  Repeated rows stay;
    other columns are ignored.  Rows are independent: no shuffle, and a lost task is simply run again.
    """
    small_batches(docs.sparkSession)
    key = hashlib.sha256(model).hexdigest()[:16]
    sent = docs.sparkSession.sparkContext.broadcast(model)
    outputs = tuple(outputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_cache(f"pieces_{key}", lambda: Codec(sent.value))
        for batch in slices(batches):
            made: dict[str, list] = {name: [] for name in outputs}
            for text in batch.column(1).to_pylist():
                ids = codec.encode(text)
                decoded = codec.decode(ids) if {"decoded", "decoded_sha256"} & made.keys() else ""
                for name, values in made.items():
                    if name == "n_tokens":
                        values.append(len(ids))
                    elif name == "ids":
                        values.append(ids)
                    elif name == "ids_sha256":
                        joined = ",".join(map(codec.decimal.__getitem__, ids))
                        values.append(hashlib.sha256(joined.encode()).hexdigest())
                    elif name == "decoded":
                        values.append(decoded)
                    else:
                        values.append(hashlib.sha256(decoded.encode()).hexdigest())
            arrays = [pa.array(made[name], OUTPUTS[name]) for name in outputs]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=[id_column, *outputs])
        codec.kept.older = {}  # a worker that goes on to other work holds less

    schema = ", ".join(
        [f"`{id_column}` {docs.schema[id_column].dataType.simpleString()}", *(f"{n} {SPARK_TYPES[n]}" for n in outputs)]
    )
    return docs.select(id_column, text_column).mapInArrow(tidied(run), schema)


def public_model(name: str = "piece_bpe_32k.model") -> bytes:
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def op4_sentencepiece(spark, sf_dir):
    """Every document encoded and decoded again, as digests."""
    docs = table(spark, sf_dir, "documents")
    return encode_documents(docs, public_model(), ("n_tokens", "ids_sha256", "decoded_sha256"))
