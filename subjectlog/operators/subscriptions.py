"""Operators over a table of subscriptions: coercion, checks, ids, de-duplication."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.subjects import has_empty_token, is_wildcard
from ..schema import ACK_BEHAVIORS, NO_ACK, SUBSCRIPTION
from .attach import local_frame

# The checks of a subscription in the order they apply.
STREAM_REQUIRED = "Stream name is required."
SUBJECT_REQUIRED = "Subject is required."
TWO_STARTS = "Cannot set both start sequence and start time."
ACK_WAIT_WITHOUT_ACK = "Ack Wait cannot be set when Ack Behavior does not ack."
DURABLE_WITHOUT_ACK = "Durable name cannot be set when Ack Behavior does not ack."
DURABLE_AND_PREFIX = "Durable Name and Consumer Name Prefix cannot both be set."
NO_SUBSCRIPTION = "At least 1 managed subject configuration is required."
MIXED_BOUNDS = "All boundedness must be the same."
NO_SUBJECTS = "One or more subjects must be provided."

# Parts of a split id, in order.
ID_PARTS = [
    "subject",
    "stream",
    "consumer_name_prefix",
    "durable_name",
    "start_sequence",
    "start_time",
    "max_messages_to_read",
    "ack_behavior",
    "ack_wait",
    "inactive_threshold",
    "batch_size",
    "threshold_percent",
]


def subscriptions(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """A checked SUBSCRIPTION frame from dicts of its columns; absent columns are unset.

    ``start_time`` may carry a zone: it is kept in UTC.  ``ack_wait_ms`` is accepted as
    another way to give ``ack_wait``.
    """
    full = []
    for row in rows:
        row = dict(row)
        if "ack_wait_ms" in row:
            row["ack_wait"] = row.pop("ack_wait_ms") * 1_000_000
        start = row.get("start_time")
        if isinstance(start, datetime) and start.tzinfo is not None:
            row["start_time"] = start.astimezone(timezone.utc).replace(tzinfo=None)
        unknown = set(row) - set(SUBSCRIPTION.names)
        if unknown:
            raise ValueError(f"unknown subscription columns: {sorted(unknown)}")
        full.append(tuple(row.get(name) for name in SUBSCRIPTION.names))
    return require_valid(with_split_id(coerce(local_frame(spark, full, SUBSCRIPTION))))


# Coercions run before the checks.  Written as SQL: one expression is one call to the JVM.
_KNOWN_BEHAVIORS = " ".join(f"WHEN '{b.lower()}' THEN '{b}'" for b in ACK_BEHAVIORS)
_COERCED = {
    **{n: f"nullif({n}, '')" for n in ("stream", "subject", "consumer_name_prefix", "durable_name")},
    **{n: f"CASE WHEN {n} >= 1 THEN {n} ELSE -1L END" for n in ("start_sequence", "max_messages_to_read")},
    "batch_size": "CASE WHEN batch_size >= 1 THEN batch_size ELSE -1 END",
    "threshold_percent": (
        "CASE WHEN threshold_percent > 100 THEN 100 WHEN threshold_percent >= 1 THEN threshold_percent ELSE -1 END"
    ),
    # Names match in any case; unknown and absent names mean NoAck.
    "ack_behavior": f"CASE lower(ack_behavior) {_KNOWN_BEHAVIORS} ELSE 'NoAck' END",
    **{n: f"CASE WHEN {n} > 0 THEN {n} END" for n in ("ack_wait", "inactive_threshold")},
}


def coerce(subs: DataFrame) -> DataFrame:
    """Out-of-range values become unset, before any check."""
    return subs.selectExpr(*[f"{_COERCED[n]} AS {n}" if n in _COERCED else f"`{n}`" for n in subs.columns])


_SILENT = "ack_behavior IN ({})".format(", ".join(f"'{b}'" for b in NO_ACK))
_CHECKS = " ".join(
    f"WHEN {bad} THEN '{text}'"
    for bad, text in [
        ("stream IS NULL", STREAM_REQUIRED),
        ("subject IS NULL", SUBJECT_REQUIRED),
        ("start_sequence <> -1 AND start_time IS NOT NULL", TWO_STARTS),
        (f"{_SILENT} AND ack_wait IS NOT NULL", ACK_WAIT_WITHOUT_ACK),
        (f"{_SILENT} AND durable_name IS NOT NULL", DURABLE_WITHOUT_ACK),
        ("durable_name IS NOT NULL AND consumer_name_prefix IS NOT NULL", DURABLE_AND_PREFIX),
    ]
)


def validate(subs: DataFrame) -> DataFrame:
    """Adds ``error``: the first failed check of a coerced subscription, or null."""
    return subs.withColumn("error", F.expr(f"CASE {_CHECKS} END"))


def bounded(max_messages: Column) -> Column:
    return max_messages > 0


def mixed_bounds(subs: DataFrame, source: str) -> DataFrame:
    """One row per source whose subscriptions are partly bounded and partly not."""
    flag = F.coalesce(bounded(F.col("max_messages_to_read")), F.lit(False))
    return (
        subs.groupBy(source)
        .agg(F.bool_or(flag).alias("any_bounded"), F.bool_and(flag).alias("all_bounded"))
        .where(F.col("any_bounded") & ~F.col("all_bounded"))
        .select(source, F.lit(MIXED_BOUNDS).alias("error"))
    )


def require_valid(subs: DataFrame) -> DataFrame:
    """The subscriptions of one source, or ValueError with the first complaint."""
    flag = F.coalesce(bounded(F.col("max_messages_to_read")), F.lit(False))
    found = (
        validate(subs)
        .agg(
            F.count("*").alias("rows"),
            F.first("error", ignorenulls=True).alias("error"),
            F.bool_or(flag).alias("any_bounded"),
            F.bool_and(flag).alias("all_bounded"),
        )
        .head()
    )
    if found["error"]:
        raise ValueError(found["error"])
    if not found["rows"]:
        raise ValueError(NO_SUBSCRIPTION)
    if found["any_bounded"] and not found["all_bounded"]:
        raise ValueError(MIXED_BOUNDS)
    return subs


def require_subjects(subjects: list[str] | None) -> list[str]:
    """Subjects of a live source or a sink; null and empty entries of a list are dropped."""
    kept = [s for s in subjects or [] if s]
    if not kept:
        raise ValueError(NO_SUBJECTS)
    return kept


def split_subjects(text: Column) -> Column:
    """The single-string form: split on commas, without trimming; closing commas add nothing."""
    body = F.regexp_replace(text, r",+\z", "")
    return F.when((F.trim(text) != "") & (body != ""), F.split(body, ",", -1))


_EPOCH_SECOND = """unix_date(to_date(start_time)) * 86400L + hour(start_time) * 3600 + minute(start_time) * 60
  + second(start_time)"""
_ID_TEXT = ", ".join(
    f"coalesce(CAST({_EPOCH_SECOND if p == 'start_time' else p} AS STRING), 'na')" for p in ID_PARTS
)
_SHORT_ID = f"hex(crc32(encode(concat_ws('--', {_ID_TEXT}), 'UTF-8')))"


def split_id() -> Column:
    """The key of a subscription's state: its short id and a 128-bit digest of its parts.

    The short id alone is a 32-bit checksum, which many subscriptions do collide in.  Its parts are never null; said so,
    no join on it filters by it, which would make it a second time.
    """
    parts = ", ".join(f"{_EPOCH_SECOND} AS start_time" if p == "start_time" else p for p in ID_PARTS)
    return F.expr(f"coalesce(concat({_SHORT_ID}, '-', md5(encode(to_json(struct({parts})), 'UTF-8'))), '')")


def short_id(of: Column | None = None) -> Column:
    """The id to show: upper-case hex CRC32 over the parts joined by ``--``; times count in whole seconds."""
    return F.expr(_SHORT_ID) if of is None else F.substring_index(of, "-", 1)


_PACKABLE = "split_id RLIKE '^(0|[1-9A-F][0-9A-F]{0,7})-[0-9a-f]{32}\\\\z'"
_PACKED = f"""CASE WHEN {_PACKABLE}
  THEN concat(X'01', unhex(lpad(substring_index(split_id, '-', 1), 8, '0')), unhex(right(split_id, 32)))
  ELSE concat(X'00', CAST(split_id AS BINARY)) END"""
_UNPACKED = """CASE WHEN substring(split_id, 1, 1) = X'01'
  THEN concat(coalesce(nullif(ltrim('0', hex(substring(split_id, 2, 4))), ''), '0'), '-', lower(hex(substring(split_id, 6, 16))))
  ELSE CAST(substring(split_id, 2) AS STRING) END"""


def packed() -> Column:
    """``split_id`` in half of its bytes, to move it: the two numbers it spells, or other ids as they are."""
    return F.expr(_PACKED).alias("split_id")


def unpacked() -> Column:
    """The ``split_id`` that was ``packed``."""
    return F.expr(_UNPACKED).alias("split_id")


def with_split_id(subs: DataFrame) -> DataFrame:
    return subs.withColumn("split_id", split_id())


def dedup(subs: DataFrame) -> DataFrame:
    """One row per split id, that is per different parts."""
    return subs.dropDuplicates(["split_id"])


def add(current: DataFrame, more: DataFrame) -> DataFrame:
    return dedup(current.unionByName(more).where(F.col("split_id").isNotNull()))


def copy_for(subs: DataFrame, subject: Column) -> DataFrame:
    """The same subscription on another subject; the durable name is not copied."""
    return with_split_id(subs.withColumns({"subject": subject, "durable_name": F.lit(None).cast("string")}))


def invalid_targets(df: DataFrame, subject: str = "subject") -> DataFrame:
    """Rows whose subject cannot be published to."""
    return df.where(is_wildcard(F.col(subject)) | has_empty_token(F.col(subject)))


def subscription_json() -> Column:
    """A subscription as JSON; unset and default values are left out."""
    set_long = lambda n: F.when(F.col(n) > 0, F.col(n)).alias(n)
    # The stored local time is UTC; rendering by pattern keeps the session zone out of it.
    when = F.concat(F.date_format("start_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("000Z"))
    return F.to_json(
        F.struct(
            F.col("stream").alias("stream_name"),
            "subject",
            "consumer_name_prefix",
            "durable_name",
            set_long("start_sequence"),
            when.alias("start_time"),
            set_long("max_messages_to_read"),
            F.when(F.col("ack_behavior") != "NoAck", F.col("ack_behavior")).alias("ack_behavior"),
            "ack_wait",
            "inactive_threshold",
            set_long("batch_size"),
            set_long("threshold_percent"),
        )
    )
