"""Source and sink converters, as column functions, by name or as given.

A *source converter* maps a message struct (``m.data``, ``m.headers``, ``m.subject``,
``m.seq``, ``m.reply_to``) to one value column.  A *sink converter* maps a value column to a
struct ``(data binary, headers map)``, or to null for "publish nothing".  Row logic that no
Spark expression covers goes into a ``pandas_udf`` called from such a function.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import payload, text

SourceConverter = Callable[[Column], Column]
SinkConverter = Callable[[Column], Column]

_HEADERS = "map<string,array<string>>"


def sink_message(data: Column, headers: Column | None = None) -> Column:
    """(data, headers); null data means nothing is published."""
    kept = F.lit(None).cast(_HEADERS) if headers is None else payload.normalise_headers(headers)
    return F.when(data.isNotNull(), F.struct(data.alias("data"), kept.alias("headers")))


SOURCE_CONVERTERS: dict[str, SourceConverter] = {
    "utf8": lambda m: text.decode_utf8(m["data"]),
    "ascii": lambda m: text.decode_ascii(m["data"]),
    "bytes": lambda m: text.payload_bytes(m["data"]),
    "ack_envelope": lambda m: payload.encode_envelope(text.decode_utf8(m["data"]), m["reply_to"]),
}

SINK_CONVERTERS: dict[str, SinkConverter] = {
    "utf8": lambda v: sink_message(text.encode_utf8(v)),
    "ascii": lambda v: sink_message(text.encode_ascii(v)),
    "bytes": lambda v: sink_message(v),
    "json": lambda v: sink_message(payload.encode_json(v)),
}


# What these make of a value is null exactly when the value is, and of a message never.
_NULL_FOR_NULL = list(SINK_CONVERTERS.values())
_NEVER_NULL = [SOURCE_CONVERTERS[name] for name in ("utf8", "ascii", "bytes")]


def never_null(converter: str | SourceConverter) -> bool:
    return source_converter(converter) in _NEVER_NULL


def register_source(name: str, converter: SourceConverter) -> None:
    SOURCE_CONVERTERS[name] = converter


def register_sink(name: str, converter: SinkConverter) -> None:
    SINK_CONVERTERS[name] = converter


def _resolve(given, known: dict, charset: Callable, complaint: str):
    if callable(given):
        return given
    if isinstance(given, str):
        if given in known:
            return known[given]
        if given.startswith("charset:"):
            try:
                return charset(given.removeprefix("charset:"))
            except LookupError as e:
                raise ValueError(complaint) from e
    raise ValueError(complaint)


# The complaints about converters that are none.
NO_SOURCE_CONVERTER = "Valid source converter class must be provided."
NO_SINK_CONVERTER = "Valid message supplier class must be provided."


def source_converter(given: str | SourceConverter | None) -> SourceConverter:
    def charset(name: str) -> SourceConverter:
        text._canonical(name)
        return lambda m: text.decode_charset(m["data"], name)

    return _resolve(given, SOURCE_CONVERTERS, charset, NO_SOURCE_CONVERTER)


def sink_converter(given: str | SinkConverter | None) -> SinkConverter:
    def charset(name: str) -> SinkConverter:
        text._canonical(name)
        return lambda v: sink_message(text.encode_charset(v, name))

    return _resolve(given, SINK_CONVERTERS, charset, NO_SINK_CONVERTER)


def convert_source(messages: DataFrame, converter: str | SourceConverter, column: str = "value") -> DataFrame:
    m = F.struct("data", "headers", "subject", "seq", "reply_to")
    return messages.withColumn(column, source_converter(converter)(m))


def convert_sink(
    records: DataFrame, converter: str | SinkConverter, value: str = "value", complete: bool = False
) -> DataFrame:
    """Records to (data, headers); records converted to null are dropped.

    A filter on the converted message is pushed below the conversion and runs it twice, so
    known converters are filtered by their value, or not at all when no value is null
    (``complete``).
    """
    convert = sink_converter(converter)
    message = "__message"
    rest = [c for c in records.columns if c not in (value, "data", "headers")]
    known = convert in _NULL_FOR_NULL
    if known and not complete:
        records = records.where(F.col(value).isNotNull())
    made = records.withColumn(message, convert(F.col(value)))
    if not known:
        made = made.where(F.col(message).isNotNull())
    return made.select(*rest, f"{message}.data", f"{message}.headers")
