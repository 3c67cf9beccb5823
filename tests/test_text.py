import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from subjectlog.functions.text import decode_charset, decode_utf8, encode_ascii, encode_charset, payload_bytes

SAMPLES = ["", "plain", "Ελληνικά", "Кириллица", "ქართული", "déjà vu", "⠃⠗", "العربية", "日本語", "a😀b", "tab\tnl\n"]


def torn_bytes():
    rnd = random.Random(7)
    cases = [b"", b"\x80", b"\xc3", b"\xe2\x82", b"\xf0\x9f\x98", b"\xed\xa0\x80", b"\xed\xa0", b"\xed\xa0A", b"\xed\xbf\xbfz"]
    cases += [b"\xe1\xed\xa0\x80", b"\xed\xa0\x80\xed\xb0\x80", b"\xf4\x90\x80\x80", b"\xe0\x80\x80", b"\xc0\xaf", b"\xff\xfe"]
    pool = [0x41, 0x7F, 0x80, 0xA0, 0xBF, 0xC0, 0xC3, 0xE0, 0xE2, 0xED, 0xEF, 0xF0, 0xF4, 0xF5, 0xFF]
    cases += [bytes(rnd.choice(pool) for _ in range(rnd.randint(1, 7))) for _ in range(600)]
    return cases


def jvm_bytes(spark, text, charset):
    made = spark._jvm.java.nio.charset.Charset.forName(charset).encode(text)
    return bytes(made.array())[: made.limit()]


@pytest.mark.parametrize("charset", ["UTF-8", "US-ASCII", "ISO-8859-1"])
def test_malformed_bytes_like_the_jvm(spark, charset):
    cases = torn_bytes()
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, data binary")
    got = dict(df.select("i", decode_charset(F.col("data"), charset)).collect())
    jvm = spark._jvm.java.lang.String
    for i, raw in enumerate(cases):
        assert got[i] == str(jvm(raw, charset)), raw


WIDE = ["UTF-16", "UTF-16BE", "UTF-16LE", "UTF-32", "UTF-32BE", "UTF-32LE"]
SINGLE = ["windows-1252", "windows-1251", "KOI8-R", "ISO-8859-15", "ISO-8859-7", "cp437", "cp037", "mac-roman"]


def torn_units(size):
    rnd = random.Random(size)
    units = [0x41, 0xD83D, 0xDE00, 0xDC00, 0xDBFF, 0xFEFF, 0xFFFE, 0xFFFF, 0x20AC, 0x1F600, 0x110000, 0x10FFFF, 0]
    cases = [b"", b"a", b"\x00", b"\xd8", b"\xd8\x3d\xde", b"\xfe\xff\x00a", b"\xff\xfea\x00", b"\x00\x00\xfe\xff", b"\xff\xfe\x00\x00a\x00\x00\x00"]
    for _ in range(400):
        mixed = [rnd.choice(units) for _ in range(rnd.randint(1, 6))]
        raw = b"".join(u.to_bytes(4, rnd.choice(["big", "little"]))[-size:] if size == 4 else (u & 0xFFFF).to_bytes(2, rnd.choice(["big", "little"])) for u in mixed)
        cases.append(raw[: rnd.randint(0, len(raw))] if rnd.random() < 0.3 else raw)
    return cases


def without_python(df):
    return not any(w in df._jdf.queryExecution().toString() for w in ("Python", "Arrow", "Pandas"))


@pytest.mark.parametrize("charset", WIDE)
def test_torn_wide_units(spark, charset):
    cases = torn_units(4 if "32" in charset else 2)
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, data binary")
    found = df.select("i", decode_charset(F.col("data"), charset))
    got = dict(found.collect())
    plain = charset.replace("BE", "-BE").replace("LE", "-LE")
    for i, raw in enumerate(cases):
        name = plain
        if plain[-1].isdigit():
            marks = {"UTF-16": (b"\xfe\xff", b"\xff\xfe"), "UTF-32": (b"\0\0\xfe\xff", b"\xff\xfe\0\0")}[plain]
            name = plain if raw.startswith(marks) else plain + "-BE"
        assert got[i] == raw.decode(name, "replace"), raw
    assert without_python(found.where("i >= 0"))


@pytest.mark.parametrize("charset", SINGLE)
def test_single_bytes_like_their_tables(spark, charset):
    every = bytes(range(256))
    df = spark.createDataFrame([(every, every.decode(charset, "replace")), (b"", "")], "data binary, s string")
    found = df.select("s", decode_charset(F.col("data"), charset).alias("t"), encode_charset(F.col("s"), charset).alias("b"))
    assert without_python(found)
    for s, t, b in found.collect():
        assert t == s and bytes(b) == s.encode(charset, "replace")
    texts = spark.createDataFrame([(x,) for x in SAMPLES], "s string")
    for s, b in texts.select("s", encode_charset(F.col("s"), charset)).collect():
        assert bytes(b) == s.encode(charset, "replace")


def test_long_wide_texts(spark):
    """Patterns that would recurse a step a character would end here."""
    text = ("\U0001f600ab" * 100_000).encode("utf-16-be") + b"\xd8"
    df = spark.createDataFrame([(text,)], "data binary")
    assert df.select(F.length(decode_charset(F.col("data"), "UTF-16"))).head()[0] == 300_001


@pytest.mark.parametrize("charset", ["UTF-8", "UTF-16", "UTF-16LE", "UTF-16BE", "UTF-32", "GB18030"])
def test_exact_charsets_round_trip(spark, charset):
    df = spark.createDataFrame([(s,) for s in SAMPLES], "s string")
    back = decode_charset(encode_charset(F.col("s"), charset), charset)
    assert df.where(~(back == F.col("s"))).count() == 0
    raw = dict(df.select("s", encode_charset(F.col("s"), charset)).collect())
    for s in SAMPLES:
        if "GB" not in charset:
            assert bytes(raw[s]) == jvm_bytes(spark, s, charset), s


@pytest.mark.parametrize("charset", ["US-ASCII", "ISO-8859-1", "windows-1252"])
def test_lossy_charsets_put_a_question_mark(spark, charset):
    df = spark.createDataFrame([(s,) for s in SAMPLES], "s string")
    got = dict(df.select("s", encode_charset(F.col("s"), charset)).collect())
    for s in SAMPLES:
        assert bytes(got[s]) == jvm_bytes(spark, s, charset), s
    assert any(decoded != s for s, decoded in df.select("s", decode_charset(encode_ascii(F.col("s")), "ASCII")).collect())


def test_absent_payload_is_empty(spark):
    df = spark.createDataFrame([(None,), (bytearray(b""),)], "data binary")
    assert [bytes(r[0]) for r in df.select(payload_bytes(F.col("data"))).collect()] == [b"", b""]
    assert [r[0] for r in df.select(decode_utf8(F.col("data"))).collect()] == ["", ""]


def test_unknown_charset():
    with pytest.raises(LookupError):
        decode_charset(None, "no-such-charset")


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=20), min_size=1, max_size=20))
def test_utf8_is_exact(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    assert df.where(~(decode_utf8(F.encode("s", "UTF-8")) == F.col("s"))).count() == 0
