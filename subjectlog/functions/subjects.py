"""Subject addressing: dot-separated tokens, ``*`` for one token, a last ``>`` for the rest."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Shape:
    """Where the wildcards of a pattern sit; patterns of one shape compare by equality."""

    lead: int  # tokens before a closing ">", or all of them
    tail: bool  # closes with ">"
    wild: tuple[int, ...]  # positions of "*"

    @property
    def literal(self) -> bool:
        return not self.tail and not self.wild


LITERAL = Shape(0, False, ())


def shape_of(pattern: str) -> Shape:
    tokens = pattern.split(".")
    tail = tokens[-1] == ">"
    lead = len(tokens) - tail
    wild = tuple(i for i, t in enumerate(tokens[:lead]) if t == "*")
    return Shape(lead, tail, wild) if tail or wild else LITERAL


def is_literal(pattern: str) -> bool:
    return shape_of(pattern).literal


def literal_prefix(pattern: str) -> str:
    """The text every matching subject starts with (for pushdown: ``rlike`` is not pushed)."""
    tokens = pattern.split(".")
    shape = shape_of(pattern)
    if shape.literal:
        return pattern
    first = min(shape.wild, default=shape.lead)
    return "".join(t + "." for t in tokens[:first])


def pattern_regex(pattern: str) -> str:
    tokens = pattern.split(".")
    shape = shape_of(pattern)
    body = tokens[:-1] if shape.tail else tokens
    parts = [r"[^.]+" if i in shape.wild else re.escape(t) for i, t in enumerate(body)]
    if shape.tail:
        parts.append(r"[^.]+(?:\.[^.]+)*")
    return r"\A" + r"\.".join(parts) + r"\z"


def subject_matches(subject: Column, pattern: str) -> Column:
    """Predicate for one pattern; the prefix or equality part reaches the Parquet scan."""
    if is_literal(pattern):
        return subject == pattern
    prefix = literal_prefix(pattern)
    hit = subject.rlike(pattern_regex(pattern))
    return subject.startswith(prefix) & hit if prefix else hit


def has_empty_token(subject: Column) -> Column:
    return (subject == "") | subject.contains("..") | subject.startswith(".") | subject.endswith(".")


def pattern_key(subject: Column, shape: Shape) -> Column:
    """The one pattern text of this shape that matches ``subject``, or null.

    Replacing tokens by ``*`` turns wildcard matching into an equality on pattern text, so a
    message is compared with shapes, not with every subscription.
    """
    if shape.literal:
        return subject
    tokens = F.split(subject, r"\.", -1)
    size = F.size(tokens)
    fits = (size > shape.lead) if shape.tail else (size == shape.lead)
    parts = [F.lit("*") if i in shape.wild else F.get(tokens, F.lit(i)) for i in range(shape.lead)]
    if shape.tail:
        parts.append(F.lit(">"))
    return F.when(fits & ~has_empty_token(subject), F.concat_ws(".", *parts))


def is_wildcard(subject: Column) -> Column:
    """True when any token is a wildcard; such subjects cannot be published to."""
    return F.arrays_overlap(F.split(subject, r"\.", -1), F.array(F.lit("*"), F.lit(">")))


def literal_subject(subject: Column) -> Column:
    """``subject``, failing the job on a row whose target is a wildcard."""
    message = F.concat(F.lit("Cannot publish to a wildcard subject: "), subject)
    return F.when(is_wildcard(subject), F.raise_error(message)).otherwise(subject)
