from dataclasses import dataclass

import pytest
from helpers import log_of, message
from pyspark.sql import functions as F

from subjectlog.functions import payload, registry


@dataclass
class WordCount:
    word: str
    count: int


def test_record_round_trip_and_failure(spark):
    df = spark.createDataFrame([('{"word":"a","count":3}',), ('{"count":4,"word":"ü"}',)], "t string")
    read = df.select(payload.decode_json(F.encode("t", "UTF-8"), WordCount).alias("r"))
    assert sorted((r.word, r["count"]) for r in read.select("r.*").collect()) == [("a", 3), ("ü", 4)]
    text = read.select(payload.encode_json(F.col("r")).cast("string")).collect()
    assert sorted(r[0] for r in text) == ['{"word":"a","count":3}', '{"word":"ü","count":4}']
    bad = spark.createDataFrame([("{nope",)], "t string")
    with pytest.raises(Exception):
        bad.select(payload.decode_json(F.encode("t", "UTF-8"), WordCount)).collect()


def test_headers(spark):
    rows = [message("s", "a", 1, headers={"k": ["1", "2"]}), message("s", "a", 2, headers={}), message("s", "a", 3)]
    df = log_of(spark, rows).orderBy("seq")
    got = df.select(payload.first_header(F.col("headers"), "k"), payload.normalise_headers(F.col("headers"))).collect()
    assert [tuple(r) for r in got] == [("1", {"k": ["1", "2"]}), (None, None), (None, None)]


@pytest.mark.parametrize("doc,complaint", [('{"reply_to":"r"}', "envelope without data"), ('{"data":"d"}', "envelope without reply address"), ("nope", "without data")])
def test_envelope_needs_both_fields(spark, doc, complaint):
    df = spark.createDataFrame([(doc,)], "t string")
    with pytest.raises(Exception, match=complaint):
        df.select(payload.decode_envelope(F.col("t"))).collect()


def test_subject_between_the_first_and_last_marks(spark):
    cases = {"data--a.b--7": "a.b", "data--a--b--7": "a--b", "x----y": "", "a-----b": "-", "a--b": None, "a---b": None, "": None}
    df = spark.createDataFrame([(k,) for k in cases], "p string")
    assert dict(df.select("p", payload.extract_subject(F.col("p"))).collect()) == cases
    with pytest.raises(Exception, match="no subject"):
        df.select(payload.extract_subject(F.col("p"), strict=True)).collect()


def test_converters_by_name_and_as_given(spark):
    log = log_of(spark, [message("s", "a", 1, "dé".encode()), message("s", "a", 2, None)])
    for name, want in {"utf8": ["dé", ""], "ascii": ["d��", ""], "charset:ISO-8859-1": ["dÃ©", ""]}.items():
        got = registry.convert_source(log, name).orderBy("seq").select("value").collect()
        assert [r[0] for r in got] == want
    registry.register_source("shout", lambda m: F.upper(m["data"].cast("string")))
    assert registry.convert_source(log, "shout").orderBy("seq").head().value == "DÉ"
    registry.register_sink("twice", lambda v: registry.sink_message(F.encode(F.concat(v, v), "UTF-8")))
    made = registry.convert_sink(registry.convert_source(log, "shout"), "twice").orderBy("seq")
    assert bytes(made.head().data).decode() == "DÉDÉ"


@pytest.mark.parametrize("given", [None, "nope", "charset:nope", 7])
def test_unknown_converters(given):
    with pytest.raises(ValueError, match="Valid source converter class must be provided."):
        registry.source_converter(given)
    with pytest.raises(ValueError, match="Valid message supplier class must be provided."):
        registry.sink_converter(given)


def test_null_is_not_published(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "")], "seq long, value string")
    made = registry.convert_sink(df, "utf8").orderBy("seq").collect()
    assert [(r.seq, bytes(r.data), r.headers) for r in made] == [(1, b"a", None), (3, b"", None)]


def test_schema_of_nested_records():
    import dataclasses

    import pytest
    from pyspark.sql import types as T

    from subjectlog.functions.payload import record_schema

    @dataclasses.dataclass
    class Inner:
        at: float
        raw: bytes

    Outer = dataclasses.make_dataclass("Outer", [("name", str), ("inner", Inner), ("all", list[Inner]), ("by", dict[str, int]), ("maybe", str | None)])
    inner = T.StructType([T.StructField("at", T.DoubleType()), T.StructField("raw", T.BinaryType())])
    kinds = [T.StringType(), inner, T.ArrayType(inner), T.MapType(T.StringType(), T.LongType()), T.StringType()]
    assert [f.dataType for f in record_schema(Outer)] == kinds
    with pytest.raises(TypeError):
        record_schema(dataclasses.make_dataclass("Odd", [("x", set)]))
