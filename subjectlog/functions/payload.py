"""Converters between payloads and typed columns."""

from __future__ import annotations

import dataclasses
import types
import typing

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import decode_utf8, encode_utf8

_FIELD_TYPES = {
    str: T.StringType(),
    int: T.LongType(),
    float: T.DoubleType(),
    bool: T.BooleanType(),
    bytes: T.BinaryType(),
}


def record_schema(record: type) -> T.StructType:
    """Spark schema of a dataclass, field by field: plain types, other dataclasses, ``list`` and ``dict`` of these, and
    each of them or None."""
    hints = typing.get_type_hints(record)
    return T.StructType([T.StructField(f.name, _field_type(hints[f.name])) for f in dataclasses.fields(record)])


def _field_type(hint: type) -> T.DataType:
    if hint in _FIELD_TYPES:
        return _FIELD_TYPES[hint]
    if dataclasses.is_dataclass(hint):
        return record_schema(hint)
    origin, inside = typing.get_origin(hint), [a for a in typing.get_args(hint) if a is not type(None)]
    if origin is list:
        return T.ArrayType(_field_type(inside[0]))
    if origin is dict and inside[0] is str:
        return T.MapType(T.StringType(), _field_type(inside[1]))
    if origin in (typing.Union, types.UnionType) and len(inside) == 1:
        return _field_type(inside[0])
    raise TypeError(f"no Spark type for {hint}")


def decode_json(data: Column, schema: T.StructType | type) -> Column:
    """JSON payload to a struct; malformed JSON fails the job."""
    if isinstance(schema, type):
        schema = record_schema(schema)
    return F.from_json(decode_utf8(data), schema, {"mode": "FAILFAST"})


def encode_json(record: Column) -> Column:
    return encode_utf8(F.to_json(record))


def first_header(headers: Column, name: str) -> Column:
    """First value of a header, null when absent."""
    return F.get(headers[name], F.lit(0))


def normalise_headers(headers: Column) -> Column:
    """No headers and empty headers are the same: null."""
    return F.when(F.size(headers) > 0, headers)


def encode_envelope(data: Column, reply_to: Column) -> Column:
    """Text plus the address its acknowledgement goes to, as JSON."""
    return F.to_json(F.struct(data.alias("data"), reply_to.alias("reply_to")))


def decode_envelope(text: Column) -> Column:
    """Struct (data, reply_to); a document lacking either field fails the job."""
    parsed = F.from_json(text, "data string, reply_to string")

    def required(name: str, complaint: str) -> Column:
        return F.coalesce(parsed[name], F.raise_error(F.concat(F.lit(complaint), F.coalesce(text, F.lit("null")))))

    return F.struct(
        required("data", "envelope without data: ").alias("data"),
        required("reply_to", "envelope without reply address: ").alias("reply_to"),
    )


def numbered_payload(subject: Column, n: Column) -> Column:
    return F.concat_ws("--", F.lit("data"), subject, n.cast("string"))


_BETWEEN = r"(?s)^.*?--(.*)--"


def extract_subject(payload: Column, strict: bool = False) -> Column:
    """Text between the first and the last ``--``; without two of them null, or an error."""
    missing = F.raise_error(F.concat(F.lit("no subject in payload: "), payload)) if strict else F.lit(None).cast("string")
    return F.when(payload.rlike(_BETWEEN), F.regexp_extract(payload, _BETWEEN, 1)).otherwise(missing)
