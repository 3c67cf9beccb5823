"""Queries over payload conversion."""

from __future__ import annotations

import dataclasses

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import payload, text
from ..functions.registry import convert_sink, convert_source, sink_message
from ..operators.subscriptions import subscriptions
from ..operators.subscribe import subscribe
from ..sinks.fan_out import relay
from .catalog import query
from .sample_log import EV, LOG, docs, events, number_in, whole_log


def _doc_id() -> Column:
    return (F.col("seq") - 1).alias("doc_id")


def _md5(value: Column, name: str = "h") -> Column:
    return F.md5(value.cast("binary")).alias(name)


@query("decode_utf8", "SELECT doc_id, CAST(length(text) AS INTEGER) AS n, md5(text) AS h FROM documents")
def decode_utf8(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = convert_source(docs(spark, sf_dir), "utf8")
    return read.select(_doc_id(), F.char_length("value").alias("n"), _md5(F.col("value")))


# A text followed by the first byte of a character that never comes.
@query("decode_malformed", "SELECT doc_id, md5(text || chr(65533)) AS h FROM documents")
def decode_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    torn = docs(spark, sf_dir).withColumn("data", F.concat("data", F.lit(b"\xc3")))
    return convert_source(torn, "utf8").select(_doc_id(), _md5(F.col("value")))


@query(
    "decode_ascii",
    r"""SELECT doc_id, CAST(strlen(text) AS INTEGER) AS n, md5(regexp_replace(regexp_replace(regexp_replace(text,
      '[\x{80}-\x{7FF}]', repeat(chr(65533), 2) , 'g'), '[\x{800}-\x{FFFC}\x{FFFE}-\x{FFFF}]', repeat(chr(65533), 3), 'g'),
      '[\x{10000}-\x{10FFFF}]', repeat(chr(65533), 4), 'g')) AS h FROM documents""",
)
def decode_ascii(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = convert_source(docs(spark, sf_dir), "ascii")
    return read.select(_doc_id(), F.char_length("value").alias("n"), _md5(F.col("value")))


@query("decode_bytes", "SELECT doc_id, CAST(strlen(text) AS INTEGER) AS n, md5(text) AS h FROM documents")
def decode_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    copied = convert_sink(convert_source(docs(spark, sf_dir), "bytes"), "bytes")
    return copied.select(_doc_id(), F.octet_length("data").alias("n"), _md5(F.col("data")))


@query("encode_utf8", "SELECT doc_id, CAST(strlen(text) AS INTEGER) AS n, md5(text) AS h FROM documents")
def encode_utf8(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = convert_sink(convert_source(docs(spark, sf_dir), "utf8"), "utf8")
    return made.select(_doc_id(), F.octet_length("data").alias("n"), _md5(F.col("data")))


@query(
    "encode_ascii",
    r"""SELECT doc_id, CAST(length(text) AS INTEGER) AS n, md5(regexp_replace(text, '[^\x00-\x7F]', '?', 'g')) AS h
    FROM documents""",
)
def encode_ascii(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = convert_sink(convert_source(docs(spark, sf_dir), "utf8"), "ascii")
    return made.select(_doc_id(), F.octet_length("data").alias("n"), _md5(F.col("data")))


@query(
    "decode_charset",
    r"""SELECT doc_id, md5(regexp_replace(text, '[^\x{00}-\x{FF}]', '?', 'g')) AS latin1, md5(text) AS utf16,
    md5(text) AS utf32 FROM documents""",
)
def decode_charset(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = convert_source(docs(spark, sf_dir), "utf8")

    def there_and_back(charset: str) -> Column:
        return text.decode_charset(text.encode_charset(F.col("value"), charset), charset)

    return rows.select(
        _doc_id(),
        _md5(there_and_back("ISO-8859-1"), "latin1"),
        _md5(there_and_back("UTF-16"), "utf16"),
        _md5(there_and_back("UTF-32"), "utf32"),
    )


# What the charset has beyond ASCII and the upper half of Latin-1.
_WINDOWS_1252 = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"


@query(
    "decode_single_byte",
    rf"""SELECT doc_id, md5(regexp_replace(text, '[^\x{{00}}-\x{{7F}}\x{{A0}}-\x{{FF}}{_WINDOWS_1252}]', '?', 'g')) AS cp1252,
    md5(regexp_replace(text, '[^\x{{00}}-\x{{7F}}]', '?', 'g')) AS koi8_ascii FROM documents""",
)
def decode_single_byte(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents to bytes of one a character and back; what is not ASCII in the second is dropped before."""
    rows = convert_source(docs(spark, sf_dir), "utf8")
    there_and_back = lambda v, c: text.decode_charset(text.encode_charset(v, c), c)
    ascii_only = F.regexp_replace("value", "[^\\x00-\\x7F]", "?")
    return rows.select(
        _doc_id(), _md5(there_and_back(F.col("value"), "windows-1252"), "cp1252"), _md5(there_and_back(ascii_only, "KOI8-R"), "koi8_ascii")
    )


@query("header_first", "SELECT event_id + 1 AS seq, event_type AS type FROM events")
def header_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = convert_source(events(spark, sf_dir), lambda m: payload.first_header(m["headers"], "type"), "type")
    return read.select("seq", "type")


@query(
    "normalise_headers",
    f"WITH {LOG} SELECT stream, seq, stream <> 'chat' AS has_headers FROM log",
)
def normalise_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = whole_log(spark, sf_dir)
    kept = payload.normalise_headers(F.col("headers"))
    return log.select("stream", "seq", kept.isNotNull().alias("has_headers"))


@query("typed_decode", f"WITH {EV} SELECT seq, k FROM ev")
def typed_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = T.StructType([T.StructField("k", T.LongType())])
    read = convert_source(events(spark, sf_dir), lambda m: payload.decode_json(m["data"], schema), "record")
    return read.select("seq", "record.k")


@dataclasses.dataclass
class Reading:
    """What an event's payload holds."""

    k: int


@dataclasses.dataclass
class Report:
    """A record with another one, a list and a map in it."""

    kind: str
    body: Reading
    parts: list[str]
    counts: dict[str, int]
    note: str | None


@query(
    "record_type",
    f"""WITH {EV} SELECT seq, event_type AS kind, k, 'events' AS first_part, user_id % 4 AS place, CAST(NULL AS VARCHAR) AS note FROM ev""",
)
def record_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested records to JSON payloads, and back by the schema of their class."""
    parts = F.split("subject", r"\.")
    counts = F.create_map(F.lit("place"), F.get(parts, F.lit(2)).cast("long"))
    body = F.struct(number_in(F.col("data")).alias("k"))
    made = F.struct(F.get(parts, F.lit(1)).alias("kind"), body.alias("body"), parts.alias("parts"), counts.alias("counts"))
    sent = convert_sink(events(spark, sf_dir).withColumn("value", made), "json")
    read = convert_source(sent, lambda m: payload.decode_json(m["data"], Report), "r")
    return read.select(
        "seq", "r.kind", "r.body.k", F.get("r.parts", F.lit(0)).alias("first_part"), F.col("r.counts")["place"].alias("place"), "r.note"
    )


@query(
    "typed_encode",
    f"""WITH {EV} SELECT seq, '{{"word":"' || event_type || '","count":' || k || '}}' AS json FROM ev""",
)
def typed_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = F.element_at(F.split("subject", r"\."), 2).alias("word")
    count = number_in(F.col("data")).alias("count")
    made = convert_sink(events(spark, sf_dir).withColumn("value", F.struct(word, count)), "json")
    return made.select("seq", F.col("data").cast("string").alias("json"))


@query("ack_envelope", f"WITH {LOG} SELECT seq, text AS data, reply_to FROM log")
def ack_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrapped = convert_source(whole_log(spark, sf_dir), "ack_envelope")
    opened = wrapped.select("seq", payload.decode_envelope(F.col("value")).alias("e"))
    return opened.select("seq", "e.data", "e.reply_to")


@query("extract_subject", f"WITH {EV} SELECT seq, subject AS source_subject, 'data--' || subject || '--' || seq AS payload FROM ev")
def extract_subject(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = events(spark, sf_dir).withColumn("payload", payload.numbered_payload(F.col("subject"), F.col("seq")))
    return made.select("seq", payload.extract_subject(F.col("payload"), strict=True).alias("source_subject"), "payload")


@F.pandas_udf(T.StringType())
def _reversed_text(values: pd.Series) -> pd.Series:
    return values.str[::-1]


@query(
    "custom_converter",
    f"WITH {EV} SELECT seq, event_type || ':' || reverse(text) AS value FROM ev WHERE k < 50",
)
def custom_converter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A converter with Python row logic, a mapping between, and a sink that drops rows."""

    def read(m: Column) -> Column:
        return _reversed_text(text.decode_utf8(m["data"]))

    def write(value: Column) -> Column:
        return F.when(F.col("k") < 50, sink_message(text.encode_utf8(value), F.col("kept_headers")))

    def between(records: DataFrame) -> DataFrame:
        named = F.concat_ws(":", payload.first_header(F.col("headers"), "type"), "value")
        return records.withColumns(
            {"k": number_in(F.col("data")), "kept_headers": F.col("headers"), "value": named}
        )

    subs = subscriptions(spark, [{"stream": "events", "subject": "events.>"}])
    out = relay(subscribe(events(spark, sf_dir), subs), ["out.custom"], read, write, between)
    return out.select("seq", F.col("data").cast("string").alias("value"))
