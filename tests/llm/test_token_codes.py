import random
import zlib

import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from subjectlog.llm import token_codes as codes
from subjectlog.scratch import scratch_path

LIBRARY = Tokenizer.from_file(path("word_bpe_49k.json"))


def test_any_id_without_its_neighbours():
    draw = random.Random(1)
    ids = np.array([draw.choice([0, 1, 255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1]) for _ in range(3000)], np.uint32)
    image = codes.pack(ids, np.array([1000, 0, 2000]))
    back, lengths = codes.unpack(image)
    assert (back == ids).all() and list(lengths) == [1000, 0, 2000]
    assert [codes.token_at(image, i) for i in range(3000)] == ids.tolist()
    with pytest.raises(IndexError):
        codes.token_at(image, 3000)
    none, lengths = codes.unpack(codes.pack(np.zeros(0, np.uint32), np.zeros(0, np.int64)))
    assert len(none) == 0 and len(lengths) == 0


def test_words_as_the_library():
    words = codes._Words(codes.public_description())
    draw = random.Random(2)
    letters = [*map(chr, range(33, 127)), *map(chr, range(161, 256)), *"  \n\t\x1c\x85\xa0σΣς́你½ſKİ", "'s", "'ll", "<|endoftext|>"]
    for _ in range(6000):
        text = "".join(draw.choice(letters) for _ in range(draw.randint(1, 16)))
        assert np.frombuffer(words.encode(text), "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_files(spark, edge, clashing, empty, monkeypatch):
    monkeypatch.setattr(codes, "SEGMENT_IDS", 500)
    paths = [scratch_path(spark, "codes") for _ in range(3)]
    for docs, place in zip((edge, clashing, empty), paths):
        codes.write_codes(docs, codes.public_description(), place)
    got = codes.read_codes(spark, paths[0]).orderBy("start").collect()
    texts = {}
    for r in edge.collect():
        texts.setdefault(r["doc_id"], []).append(LIBRARY.encode(r["text"] or "", add_special_tokens=False).ids + [2])
    at = 0
    assert [r["doc_id"] for r in got] == sorted((r["doc_id"] for r in got), key=lambda i: (i is not None, i))
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
        crcs = [(len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for ids in texts[r["doc_id"]]]
        assert (r["n_tokens"], r["ids_crc32"]) in crcs
    assert codes.read_codes(spark, paths[1]).count() == 20
    assert codes.read_codes(spark, paths[2]).collect() == []


def test_other_tokenizers_are_refused(edge):
    with open(path("byte_bpe_50k.json"), encoding="utf-8") as f, pytest.raises(ValueError):
        codes.write_codes(edge, f.read(), "nowhere")


def test_any_position_of_the_files(spark, edge, monkeypatch):
    """Positions of all segments, against the ids of all documents one after the other."""
    monkeypatch.setattr(codes, "SEGMENT_IDS", 500)
    path_ = scratch_path(spark, "codes")
    codes.write_codes(edge, codes.public_description(), path_)
    segments = spark.read.parquet(path_).orderBy("part", "segment").collect()
    every = np.concatenate([codes.unpack(bytes(r["image"]))[0] for r in segments])
    assert len(segments) > 3
    asked = [*range(0, len(every), 7), 0, 0, len(every) - 1, len(every), len(every) + 5000, -1, None]
    positions = spark.createDataFrame([(p, "mine") for p in asked], "position bigint, token string")
    got = dict(codes.tokens_at(spark, path_, positions).collect())
    assert got == {p: int(every[p]) for p in asked if p is not None and 0 <= p < len(every)}
    nothing = scratch_path(spark, "codes")
    codes.write_codes(edge.limit(0), codes.public_description(), nothing)
    assert codes.tokens_at(spark, nothing, positions).collect() == []
