"""Matching messages with subscriptions: one output row per message and matching split."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.subjects import LITERAL, has_empty_token, is_literal, literal_prefix, pattern_key, shape_of
from .attach import attach, local_frame, small_rows

# Up to this many subscriptions become one pushed-down scan filter.
PUSHED_PATTERNS = 64


def match(
    messages: DataFrame, subs: DataFrame, limit: int | None = None, rows: list[Row] | None = None
) -> DataFrame:
    """``messages`` with the columns of every subscription whose stream and subject fit.

    ``rows`` are the rows of ``subs`` if the caller has them already.

    Overlapping subscriptions repeat a message once each.  The work per message grows with
    the number of wildcard shapes, not with the number of subscriptions.
    """
    rows = small_rows(subs, limit) if rows is None else rows
    subs = subs.withColumnRenamed("subject", "pattern")
    if rows is None:
        return _match_large(messages, subs, limit)
    return _match_small(messages, rows, subs.schema)


def scan_filter(rows: list[Row]) -> Column:
    """The parts of the subscriptions Parquet can use: stream, subject or its prefix, start.

    With many subscriptions each stream keeps one alternative: its earliest starts, and its patterns merged.
    """
    if len(rows) > PUSHED_PATTERNS:
        by_stream: dict[str, list[Row]] = {}
        for row in rows:
            by_stream.setdefault(row["stream"], []).append(row)
        if len(by_stream) > PUSHED_PATTERNS:
            return F.col("stream").isin(sorted(by_stream)) & _started(rows) & covered([r["subject"] for r in rows])
        return reduce(
            Column.__or__,
            [(F.col("stream") == s) & _started(own) & covered([r["subject"] for r in own]) for s, own in by_stream.items()],
        )
    alternatives = []
    for row in rows:
        here = (F.col("stream") == row["stream"]) & _started([row])
        prefix = literal_prefix(row["subject"])
        if is_literal(row["subject"]):
            here &= F.col("subject") == row["subject"]
        elif prefix:
            here &= F.col("subject").startswith(prefix)
        alternatives.append(here)
    return reduce(Column.__or__, alternatives)


def merged(patterns: list[str], most: int = PUSHED_PATTERNS) -> tuple[list[str], list[str]] | None:
    """(subjects, prefixes) that cover all patterns: as many leading tokens of each as leave at most ``most`` different
    prefixes.  None if a single token leaves more, or a pattern begins with a wildcard.
    """
    heads = []
    for pattern in set(patterns):
        shape, tokens = shape_of(pattern), pattern.split(".")
        heads.append((tokens if shape.literal else tokens[: min(shape.wild, default=shape.lead)], shape.literal))
    if any(not tokens for tokens, _ in heads):
        return None
    for depth in range(max((len(t) for t, _ in heads), default=0), 0, -1):
        subjects = {".".join(t) for t, literal in heads if literal and len(t) <= depth}
        prefixes = {"".join(x + "." for x in t[:depth]) for t, literal in heads if not (literal and len(t) <= depth)}
        # what lies below a shorter prefix is covered by that
        above = lambda text: any("".join(x + "." for x in text.split(".")[:k]) in prefixes for k in range(1, text.rstrip(".").count(".") + 1))
        prefixes = {p for p in prefixes if not above(p)}
        subjects = {x for x in subjects if not above(x)}
        if len(prefixes) <= most and len(subjects) <= 16 * most:
            return sorted(subjects), sorted(prefixes)
    return None


def covered(patterns: list[str]) -> Column:
    """Whether a subject may match any of ``patterns``, in terms that reach the scan."""
    found = merged(patterns)
    if found is None:
        return F.lit(True)
    subjects, prefixes = found
    parts = [F.col("subject").startswith(p) for p in prefixes] + ([F.col("subject").isin(subjects)] if subjects else [])
    return reduce(Column.__or__, parts)


def _started(rows: list[Row]) -> Column:
    """At or after the earliest start, by number and by time, of some subscriptions."""
    begun = F.lit(True)
    if "from_seq" in rows[0] and (low := min(r["from_seq"] for r in rows)) > 1:
        begun &= F.col("seq") >= low
    if "from_time" in rows[0] and all(r["from_time"] is not None for r in rows):
        begun &= F.col("ts") >= F.lit(min(r["from_time"] for r in rows)).cast("timestamp_ntz")
    return begun


def _match_small(messages: DataFrame, rows: list[Row], schema: T.StructType) -> DataFrame:
    spark = messages.sparkSession
    if not rows:
        return messages.where(F.lit(False)).join(F.broadcast(local_frame(spark, [], schema)), "stream")
    shapes = sorted({shape_of(r["subject"]) for r in rows}, key=lambda s: (s != LITERAL, s.lead, s.tail, s.wild))
    numbered = [(*r, shapes.index(shape_of(r["subject"]))) for r in rows]
    table = local_frame(spark, numbered, T.StructType([*schema, T.StructField("__shape", T.IntegerType())]))
    keys = [pattern_key(F.col("subject"), s) for s in shapes]
    wanted = messages.where(scan_filter(rows))
    if len(keys) == 1:
        keyed = wanted.select("*", F.lit(0).alias("__shape"), keys[0].alias("pattern"))
    else:
        keyed = wanted.select("*", F.posexplode(F.array(*keys)).alias("__shape", "pattern"))
    keyed = keyed.where(F.col("pattern").isNotNull())
    return keyed.join(F.broadcast(table), ["stream", "__shape", "pattern"]).drop("__shape")


def _shape_columns(pattern: Column) -> dict[str, Column]:
    tokens = F.split(pattern, r"\.", -1)
    tail = F.element_at(tokens, -1) == ">"
    lead = F.size(tokens) - tail.cast("int")
    marks = F.transform(F.slice(tokens, 1, lead), lambda t: F.when(t == "*", "1").otherwise("0"))
    mask = F.concat_ws("", marks)
    # All literal patterns share one shape: the key is the subject itself.
    literal = ~tail & ~mask.contains("1")
    return {
        "__tail": tail,
        "__lead": F.when(literal, -1).otherwise(lead),
        "__mask": F.when(literal, "").otherwise(mask),
    }


def _match_large(messages: DataFrame, subs: DataFrame, limit: int | None) -> DataFrame:
    """Too many subscriptions for a local table: the same keys, found for the different subjects, which are far fewer
    than the messages; then one join on (stream, subject).  The scan still gets the streams and the earliest starts."""
    messages = _narrowed(messages, subs)
    found = _match_subjects(messages.select("stream", "subject").distinct(), subs, limit)
    return messages.join(found, ["stream", "subject"])


def _narrowed(messages: DataFrame, subs: DataFrame) -> DataFrame:
    starts = [c for c in ("from_seq", "from_time") if c in subs.columns]
    least = [F.min(c).alias(c) for c in starts] + [(F.count("*") == F.count(c)).alias(f"all_{c}") for c in starts]
    streams = small_rows(subs.select("stream").distinct(), PUSHED_PATTERNS)
    if streams is not None:
        messages = messages.where(F.col("stream").isin(sorted(r["stream"] for r in streams)))
    if least:
        low = subs.agg(*least).head()
        if "from_seq" in starts and (low["from_seq"] or 0) > 1:
            messages = messages.where(F.col("seq") >= low["from_seq"])
        if "from_time" in starts and low["from_time"] is not None and low["all_from_time"]:
            messages = messages.where(F.col("ts") >= F.lit(low["from_time"]).cast("timestamp_ntz"))
    # Fewer leading tokens until the different ones are few; these are merged like a short list of patterns.
    tokens = F.split("pattern", r"\.", -1)
    for depth in (3, 2, 1):
        cut = F.when(F.size(tokens) > depth, F.concat(F.array_join(F.slice(tokens, 1, depth), "."), F.lit(".>"))).otherwise(F.col("pattern"))
        heads = small_rows(subs.select(cut.alias("head")).distinct(), 16 * PUSHED_PATTERNS)
        if heads is not None and (found := merged([r["head"] for r in heads])) is not None:
            messages = messages.where(covered(found[0] + [f"{p}>" for p in found[1]]))
            break
    return messages


def _match_subjects(messages: DataFrame, subs: DataFrame, limit: int | None) -> DataFrame:
    subs = subs.withColumns(_shape_columns(F.col("pattern")))
    shapes = subs.select("__tail", "__lead", "__mask").distinct()
    tokens = F.split("subject", r"\.", -1)
    size = F.size(tokens)
    slot = lambda tail, lead: F.struct(F.lit(tail).alias("tail"), lead.alias("lead"))
    whole = F.array(slot(False, F.lit(-1)))
    wild = F.concat(
        whole, F.array(slot(False, size)), F.transform(F.sequence(F.lit(0), size - 1), lambda k: slot(True, k))
    )
    slots = F.when(has_empty_token(F.col("subject")), whole).otherwise(wild)
    slotted = (
        messages.withColumn("__slot", F.explode_outer(slots))
        .withColumns({"__tail": F.col("__slot.tail"), "__lead": F.col("__slot.lead")})
        .drop("__slot")
    )
    shaped = attach(slotted, shapes, ["__tail", "__lead"], limit=limit)
    body = F.transform(
        F.slice(tokens, 1, F.greatest(F.col("__lead"), F.lit(0))),
        lambda t, i: F.when(F.substring(F.col("__mask"), i + 1, F.lit(1)) == "1", "*").otherwise(t),
    )
    rest = F.when(F.col("__tail"), F.array(F.lit(">"))).otherwise(F.array().cast("array<string>"))
    key = F.when(F.col("__lead") < 0, F.col("subject")).otherwise(F.concat_ws(".", F.concat(body, rest)))
    keys = ["stream", "pattern", "__tail", "__lead", "__mask"]
    joined = attach(shaped.withColumn("pattern", key), subs, keys, limit=limit)
    return joined.drop("__tail", "__lead", "__mask")
