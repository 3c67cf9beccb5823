"""Payload bytes to text and back, with replacement instead of errors on malformed input."""

from __future__ import annotations

import codecs

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

REPLACEMENT = "\ufffd"


def payload_bytes(data: Column) -> Column:
    """A message without payload reads as empty bytes."""
    return F.coalesce(data, F.lit(b""))


def decode_utf8(data: Column) -> Column:
    raw = payload_bytes(data)
    text = raw.cast("string")
    # An encoded surrogate, whole or cut short, is one malformed unit; make_valid_utf8 alone
    # would replace each of its bytes.
    unit = F.regexp_replace(F.decode(raw, "ISO-8859-1"), "\u00ed[\u00a0-\u00bf][\u0080-\u00bf]?", "\u00ef\u00bf\u00bd")
    repaired = F.make_valid_utf8(F.encode(unit, "ISO-8859-1").cast("string"))
    return F.when(F.is_valid_utf8(text), text).otherwise(repaired)


def encode_utf8(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def decode_ascii(data: Column) -> Column:
    """Every byte from 0x80 up becomes one replacement character."""
    return F.regexp_replace(F.decode(payload_bytes(data), "ISO-8859-1"), "[\u0080-\u00ff]", REPLACEMENT)


def encode_ascii(text: Column) -> Column:
    """Every character outside ASCII becomes ``?``."""
    return F.encode(F.regexp_replace(text, "[^\\x00-\\x7F]", "?"), "US-ASCII")


def _canonical(charset: str) -> str:
    name = charset.upper().replace("_", "-")
    if name in ("UTF-8", "UTF8"):
        return "UTF-8"
    if name in ("US-ASCII", "ASCII"):
        return "US-ASCII"
    if name in ("ISO-8859-1", "LATIN1", "LATIN-1"):
        return "ISO-8859-1"
    codecs.lookup(name)  # LookupError for a name nobody knows
    return name


def _single_byte(name: str) -> list[str | None] | None:
    """The character of each of the 256 bytes, None where the charset has none; None for charsets of more bytes."""
    try:
        if len("\u00e9".encode(name, "replace")) != 1 or len("ab".encode(name, "replace")) != 2:
            return None
        table = [bytes([b]).decode(name, "replace") for b in range(256)]
    except UnicodeError:
        return None
    if any(len(c) != 1 for c in table):
        return None
    found = [None if c == REPLACEMENT else c for c in table]
    # Charsets with shifts or lead bytes give other characters to bytes that stand together.
    return found if all(bytes([b, b]).decode(name, "replace") == (c or REPLACEMENT) * 2 for b, c in enumerate(found)) else None


def _ascii_below(table: list[str | None]) -> bool:
    """Whether the lower half of a charset is ASCII, so that text of ASCII alone is its own bytes."""
    return all(c == chr(b) for b, c in enumerate(table[:128]))


def _known(table: list[str | None]) -> str:
    """The characters of a charset as few ranges of a pattern: each costs every character that is looked at."""
    codes, spans = sorted(ord(c) for c in set(table) if c), []
    for code in codes:
        if spans and spans[-1][1] == code - 1:
            spans[-1][1] = code
        else:
            spans.append([code, code])
    return "".join(f"\\x{{{low:X}}}-\\x{{{high:X}}}" for low, high in spans)


def _hex(data: Column) -> Column:
    return F.hex(payload_bytes(data))


def _decode_utf16(digits: Column) -> Column:
    """Big-endian code units in hex: a surrogate without its other half is one replacement, also at a torn end.

    Quantifiers are possessive: the pattern neither backtracks nor recurses, however long the text.
    """
    torn = F.length(digits) % 4 != 0
    cut = F.when(F.substring(digits, -6, 4).rlike("^D[89AB]"), 6).otherwise(2)
    whole = F.when(torn, F.concat(F.substring(digits, F.lit(1), F.greatest(F.length(digits) - cut, F.lit(0))), F.lit("FFFD"))).otherwise(digits)
    units = "(?:(?!D[89A-F])[0-9A-F]{4}|D[89AB]..D[C-F]..)*+"
    fixed = F.regexp_replace(whole, rf"\G({units})D[89A-F]..", "$1FFFD")
    return F.decode(F.unhex(fixed), "UTF-16BE")


def _decode_utf32(digits: Column) -> Column:
    """Big-endian units in hex: a surrogate, a unit beyond the last character and a torn end are one replacement each."""
    over = F.length(digits) % 8
    whole = F.when(over != 0, F.concat(F.substring(digits, F.lit(1), F.length(digits) - over), F.lit("0000FFFD"))).otherwise(digits)
    units = "(?:0000(?!D[89A-F])[0-9A-F]{4}|000[1-9A-F][0-9A-F]{4}|0010[0-9A-F]{4})*+"
    fixed = F.regexp_replace(whole, rf"\G({units})[0-9A-F]{{8}}", "$10000FFFD")
    # the first mark is not part of the text, so one is put before it
    return F.decode(F.unhex(F.concat(F.lit("0000FEFF"), fixed)), "UTF-32")


def _swapped(digits: Column, size: int) -> Column:
    """Units of ``size`` bytes in hex, read from the other end; what is left over at the end stays."""
    return F.regexp_replace(digits, "(..)" * size, "".join(f"${k}" for k in range(size, 0, -1)))


_WIDE = {"UTF-16": (2, "FEFF", "FFFE", _decode_utf16), "UTF-32": (4, "0000FEFF", "FFFE0000", _decode_utf32)}


def _wide(name: str) -> tuple[str, str] | None:
    """(UTF-16 or UTF-32, byte order if the name says it)."""
    for base in _WIDE:
        rest = name.removeprefix(base)
        if rest != name and rest.strip("-") in ("", "BE", "LE"):
            return base, rest.strip("-")
    return None


def decode_charset(data: Column, charset: str) -> Column:
    """Bytes in any charset to text; malformed input becomes replacement characters.

    The Unicode charsets and all of one byte a character are decoded by Spark's own expressions, the latter by a table
    of 256 entries.  Others, such as GB18030, go through Python in batches.
    """
    name = _canonical(charset)
    if name == "UTF-8":
        return decode_utf8(data)
    if name == "US-ASCII":
        return decode_ascii(data)
    if name == "ISO-8859-1":
        return F.decode(payload_bytes(data), name)
    if wide := _wide(name):
        base, order = wide
        size, big, little, decode_units = _WIDE[base]
        digits = _hex(data)
        if order:
            return decode_units(_swapped(digits, size) if order == "LE" else digits)
        rest = F.substring(digits, F.lit(len(big) + 1), F.length(digits))
        marked = F.when(digits.startswith(little), _swapped(rest, size)).when(digits.startswith(big), rest)
        return decode_units(marked.otherwise(digits))  # no byte order mark: big endian
    if table := _single_byte(name):
        other = [(chr(b), c or REPLACEMENT) for b, c in enumerate(table) if c != chr(b)]
        plain = F.decode(payload_bytes(data), "ISO-8859-1")
        if not other:
            return plain
        found = F.translate(plain, *map("".join, zip(*other)))
        same = F.octet_length(plain) == F.octet_length(payload_bytes(data))
        return F.when(same, plain).otherwise(found) if _ascii_below(table) else found

    @F.pandas_udf(T.StringType())
    def decode(values: pd.Series) -> pd.Series:
        return values.map(lambda raw: raw.decode(name, "replace"))

    return decode(payload_bytes(data))


def encode_charset(text: Column, charset: str) -> Column:
    """Text to bytes; what the charset does not have becomes ``?``."""
    name = _canonical(charset)
    if name == "UTF-8":
        return encode_utf8(text)
    if name == "US-ASCII":
        return encode_ascii(text)
    if name == "ISO-8859-1":
        return F.encode(F.regexp_replace(text, "[^\\x00-\\xFF]", "?"), name)
    if wide := _wide(name):
        base, order = wide
        if base == "UTF-16":
            return F.encode(text, base + order)
        big = F.encode(text, base)
        return F.unhex(_swapped(F.hex(big), 4)) if order == "LE" else big
    if table := _single_byte(name):
        other = [(c, chr(b)) for b, c in enumerate(table) if c and c != chr(b)]
        plain = _ascii_below(table)
        # ASCII leaves the pattern at its first test
        unknown = f"[[^\\x00-\\x7F]&&[^{_known(table)}]]" if plain else f"[^{_known(table)}]"
        kept = F.regexp_replace(text, unknown, "?")
        made = F.encode(F.translate(kept, *map("".join, zip(*other))) if other else kept, "ISO-8859-1")
        return F.when(F.octet_length(text) == F.char_length(text), F.encode(text, "ISO-8859-1")).otherwise(made) if plain else made

    @F.pandas_udf(T.BinaryType())
    def encode(values: pd.Series) -> pd.Series:
        return values.map(lambda s: None if s is None else s.encode(name, "replace"))

    return encode(text)
