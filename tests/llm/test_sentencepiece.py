import hashlib
import random

import pytest
import sentencepiece
from public_tokenizers import path

from subjectlog.llm import sentencepiece as sentencepiece_module
from subjectlog.llm.sentencepiece import Codec, encode_documents, public_model

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def codec():
    return Codec(public_model())


@pytest.mark.parametrize(
    "text",
    ["", " ", "   ", "a", "\n", "\x00", "▁", "a▁ b", "Hello  world\t\n", "a" * 3000, " " * 500, "ab" * 700, "<s></s><unk><0x41>",
     "é你好😀", "́abc", "x\U000100ab", "=====----....", "\n\n \n"],
)
def test_as_the_library(codec, text):
    ids = codec.encode(text)
    assert ids == LIBRARY.encode(text) and codec.decode(ids) == LIBRARY.decode(ids)


def test_random_texts(codec):
    draw = random.Random(2)
    pieces = list(codec.model.ids)
    for k in range(4000):
        if k % 2:
            text = "".join(draw.choice("abcdehinorst .,=-_▁\n\t0123éß你") for _ in range(draw.randint(1, 40)))
        else:
            text = "".join(draw.choice(pieces) for _ in range(draw.randint(1, 6))).replace("▁", " ")
        ids = codec.encode(text)
        assert ids == LIBRARY.encode(text) and codec.decode(ids) == LIBRARY.decode(ids)


def test_tables(edge, clashing, empty):
    outputs = ("n_tokens", "ids", "ids_sha256", "decoded", "decoded_sha256")
    got = encode_documents(edge, public_model(), outputs).collect()
    want = sorted(str((r["doc_id"], LIBRARY.encode(r["text"] or ""))) for r in edge.collect())
    assert sorted(str((r["doc_id"], r["ids"])) for r in got) == want
    for r in got:
        assert r["n_tokens"] == len(r["ids"]) and r["decoded"] == LIBRARY.decode(r["ids"])
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, r["ids"])).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(r["decoded"].encode()).hexdigest()
    assert encode_documents(clashing, public_model(), outputs).count() == 20
    assert encode_documents(empty, public_model(), outputs).collect() == []


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        Codec(b"")


def test_punctuation_is_parted_from_words(codec):
    """A word is made once, whatever punctuation follows it; letters that a piece holds before punctuation stay with it."""
    assert codec.parts.findall("▁elleai***▁elleai,▁elleai.") == ["▁elleai", "***", "▁elleai", ",", "▁elleai", "."]
    for text in ["x².", "a².,b²)", "“a”.”,", "e.g. i.e.,a_b_1,2.5%", "a.b" * 40, "é,é." * 30, "你,好。" * 30]:
        assert codec.encode(text) == LIBRARY.encode(text)


def test_neighbours_are_checked_without_merging_them(monkeypatch):
    """A piece is merged once, not with every neighbour, and the answer is that of merging both."""
    codec, merged = Codec(public_model()), []
    plain = codec.merges
    monkeypatch.setattr(codec, "merges", lambda text: merged.append(text) or plain(text))
    draw = random.Random(3)
    words = [p for p in codec.model.ids if p.isalpha() and p.isascii() and len(p) <= 4]
    for _ in range(3000):
        codec.encode("".join(draw.choice(words) for _ in range(3)))
    pairs = [(left, right) for left in codec.asked if left.size for right in left.before]
    assert len(pairs) > len(merged) == len(set(merged))
    for left, right in draw.sample(pairs, 2000):
        assert left.before[right] == (plain(left.text + right.text)[0] == [left.text, right.text])


def test_answers_are_bounded(codec, monkeypatch):
    monkeypatch.setattr(sentencepiece_module, "KEPT_ANSWERS", 50)
    draw = random.Random(4)
    for _ in range(300):
        text = "".join(draw.choice("abcdehinorst😀你é") for _ in range(20))
        assert codec.encode(text) == LIBRARY.encode(text)
    assert sum(len(p.before) for p in codec.asked) == codec.answers <= 50
