"""Queries over tables of subscriptions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import epoch_seconds
from ..operators.progress import split_json
from ..operators.subscriptions import (
    coerce,
    copy_for,
    dedup,
    invalid_targets,
    mixed_bounds,
    validate,
    short_id,
    with_split_id,
)
from ..scratch import scratch_path
from ..schema import SUBSCRIPTION
from ..sources.documents import load_subscriptions, load_targets, parse_subscriptions, source_documents
from .catalog import query
from .sample_log import EV, RAW, event_subject, events, number_in, raw_subscriptions, table

# Unset durations are shown as 0.
_DURATIONS = ["ack_wait", "inactive_threshold"]
_FIELDS = [n for n in SUBSCRIPTION.names if n not in ("split_id", *_DURATIONS)]
_SELECT = ", ".join(_FIELDS + [f"coalesce({n}, 0) AS {n}" for n in _DURATIONS])


def _shown() -> list:
    return [*_FIELDS, *[F.coalesce(F.col(n), F.lit(0).cast("long")).alias(n) for n in _DURATIONS]]


def _coerced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coerce(raw_subscriptions(spark, sf_dir))


@query("coerce_subscriptions", f"WITH {RAW} SELECT id, {_SELECT} FROM coerced")
def coerce_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coerced(spark, sf_dir).select("id", *_shown())


_ERROR = """CASE WHEN stream IS NULL THEN 'Stream name is required.' WHEN subject IS NULL THEN 'Subject is required.'
  WHEN start_sequence <> -1 AND start_time IS NOT NULL THEN 'Cannot set both start sequence and start time.'
  WHEN ack_behavior IN ('NoAck', 'NoAckUnordered') AND ack_wait IS NOT NULL
    THEN 'Ack Wait cannot be set when Ack Behavior does not ack.'
  WHEN ack_behavior IN ('NoAck', 'NoAckUnordered') AND durable_name IS NOT NULL
    THEN 'Durable name cannot be set when Ack Behavior does not ack.'
  WHEN durable_name IS NOT NULL AND consumer_name_prefix IS NOT NULL
    THEN 'Durable Name and Consumer Name Prefix cannot both be set.' END"""


@query("validate_subscriptions", f"WITH {RAW} SELECT id, {_ERROR} AS error FROM coerced")
def validate_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(_coerced(spark, sf_dir)).select("id", "error")


@query(
    "mixed_bounds",
    f"""WITH {RAW} SELECT subject, 'All boundedness must be the same.' AS error FROM coerced WHERE subject IS NOT NULL
    GROUP BY 1 HAVING bool_or(max_messages_to_read > 0) AND NOT bool_and(max_messages_to_read > 0)""",
)
def mixed_bounds_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every subject as one source of all the subscriptions that name it."""
    return mixed_bounds(_coerced(spark, sf_dir).where("subject is not null"), "subject")


# Everything a split id is made of; two subscriptions that agree on it are one.
_ID_SQL = """subject, stream, consumer_name_prefix, durable_name, start_sequence, coalesce(CAST(floor(epoch(start_time)) AS BIGINT), 0) AS start_second,
  max_messages_to_read, ack_behavior, coalesce(ack_wait, 0) AS ack_wait, coalesce(inactive_threshold, 0) AS inactive_threshold, batch_size, threshold_percent"""


@query("dedup_subscriptions", f"WITH {RAW} SELECT DISTINCT {_ID_SQL} FROM coerced")
def dedup_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twice the same subscriptions: each split once."""
    subs = with_split_id(_coerced(spark, sf_dir))
    once = dedup(subs.unionByName(subs))
    second = F.coalesce(epoch_seconds(F.col("start_time")), F.lit(0).cast("long")).alias("start_second")
    return once.select(*_shown(), second).drop("start_time")


# CRC32 spelled out: the table of the reflected polynomial, then one step per byte.
_CRC = """crc AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS tab)"""


@query(
    "subscription_id",
    f"""WITH {RAW}, {_CRC}, t AS (SELECT id, concat_ws('--', coalesce(subject, 'na'), coalesce(stream, 'na'),
      coalesce(consumer_name_prefix, 'na'), coalesce(durable_name, 'na'), start_sequence,
      coalesce(CAST(CAST(floor(epoch(start_time)) AS BIGINT) AS VARCHAR), 'na'), max_messages_to_read, ack_behavior,
      coalesce(CAST(ack_wait AS VARCHAR), 'na'), coalesce(CAST(inactive_threshold AS VARCHAR), 'na'), batch_size,
      threshold_percent) AS text FROM coerced)
    SELECT id, upper(to_hex(xor(list_reduce(list_transform(string_split(text, ''), lambda s: CAST(ascii(s) AS BIGINT)),
      lambda c, b: xor(tab[CAST(xor(c, b) & 255 AS INTEGER) + 1], c >> 8), 4294967295), 4294967295))) AS split_id FROM t, crc""",
)
def subscription_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_split_id(_coerced(spark, sf_dir)).select("id", short_id(F.col("split_id")).alias("split_id"))


@query(
    "copy_subscription",
    f"""WITH {RAW} SELECT id, 'copy.' || subject AS subject, CAST(NULL AS VARCHAR) AS durable_name, ack_behavior, start_sequence
    FROM coerced WHERE subject IS NOT NULL""",
)
def copy_subscription(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = _coerced(spark, sf_dir).where("subject is not null")
    copies = copy_for(given, F.concat(F.lit("copy."), "subject"))
    return copies.select("id", "subject", "durable_name", "ack_behavior", "start_sequence")


def _document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per event, with two subscriptions: a full one, and one that gives
    its numbers as text and an unknown member."""
    raw = raw_subscriptions(spark, sf_dir)
    when = F.concat(F.date_format("start_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("000Z"))
    full = F.struct(
        F.col("stream").alias("stream_name"),
        "subject",
        "consumer_name_prefix",
        "durable_name",
        "start_sequence",
        when.alias("start_time"),
        "max_messages_to_read",
        "ack_behavior",
        "ack_wait",
        "inactive_threshold",
        "batch_size",
        "threshold_percent",
    )
    quoted = F.struct(
        F.lit("quoted").alias("stream_name"),
        F.col("id").cast("string").alias("subject"),
        F.lit("5").alias("start_sequence"),
        F.lit(True).alias("some_mode"),
    )
    parts = F.concat(F.lit('{"converter":"utf8","subscriptions":['), F.to_json(full), F.lit(","), F.to_json(quoted), F.lit("]}"))
    return raw.select("id", parts.alias("value"))


@query(
    "parse_subscriptions",
    f"""WITH {RAW} SELECT id, {_SELECT} FROM coerced UNION ALL
    SELECT id, 'quoted', CAST(id AS VARCHAR), NULL, NULL, -1, NULL, -1, 'NoAck', -1, -1, 0, 0 FROM coerced""",
)
def parse_subscriptions_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_subscriptions(_document(spark, sf_dir)).select("id", *_shown())


@query(
    "load_subscriptions",
    f"WITH {EV} SELECT DISTINCT stream, subject, CAST(-1 AS BIGINT) AS start_sequence, 'NoAck' AS ack_behavior FROM ev",
)
def load_subscriptions_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of documents, one subscription list per subject found in the events."""
    found = table(spark, sf_dir, "events").select(event_subject().alias("subject")).distinct()
    entry = F.to_json(F.struct(F.lit("events").alias("stream_name"), "subject"))
    path = scratch_path(spark, "documents")
    documents = found.select(F.concat(F.lit('{"subscriptions":['), entry, F.lit("]}")).alias("value"))
    documents.repartition("value").write.option("maxRecordsPerFile", 1).text(path)
    return load_subscriptions(spark, path).select("stream", "subject", "start_sequence", "ack_behavior")


@query(
    "source_documents",
    f"WITH {RAW} SELECT id, {_SELECT} FROM coerced WHERE stream IS NOT NULL AND subject IS NOT NULL",
)
def source_documents_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source a hundred events: its subscriptions as one document, and read back."""
    subs = with_split_id(_coerced(spark, sf_dir)).where("stream IS NOT NULL AND subject IS NOT NULL")
    subs = subs.withColumn("source", F.floor(F.col("id") / 100))
    back = parse_subscriptions(source_documents(subs, "source"))
    # every subscription is found by its parts again
    # (both sides grow with the events: neither is broadcast, however small their files are)
    found = subs.select("source", "split_id", "id").join(back.hint("merge"), ["source", "split_id"])
    return found.dropDuplicates(["id"]).select("id", *_shown())


@query(
    "load_targets",
    f"""WITH {EV}, d AS (SELECT DISTINCT event_type, user_id % 4 AS n FROM ev)
    SELECT event_type || '.list' || n AS subject FROM d WHERE n < 2 UNION ALL
    SELECT event_type || s FROM d, (VALUES ('.one'), (' .two')) v(s) WHERE n >= 2""",
)
def load_targets_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sink documents: a list with an empty entry, or one comma-separated text."""
    kinds = table(spark, sf_dir, "events").select("event_type", (F.col("user_id") % 4).alias("n")).distinct()
    listed = F.to_json(F.struct(F.array(F.concat("event_type", F.lit(".list"), "n"), F.lit("")).alias("subjects")))
    single = F.to_json(
        F.struct(F.concat("event_type", F.lit(".one,"), "event_type", F.lit(" .two,,")).alias("subject"))
    )
    path = scratch_path(spark, "documents")
    documents = kinds.select(F.when(F.col("n") < 2, listed).otherwise(single).alias("value"), "n")
    documents.repartition("value", "n").select("value").write.option("maxRecordsPerFile", 1).text(path)
    return load_targets(spark, path)


@query(
    "split_json",
    f"""WITH {RAW} SELECT id, '{{' || CASE WHEN start_sequence > 0 THEN '"last_emitted_seq":' || start_sequence || ',' ELSE '' END
      || '"messages":' || id || ',"subject_config":{{"ack_behavior":"AckAll",' || CASE WHEN ack_wait IS NULL THEN '' ELSE '"ack_wait":' || ack_wait || ',' END
      || CASE WHEN start_time IS NULL THEN '' ELSE '"start_time":"' || strftime(start_time, '%Y-%m-%dT%H:%M:%S.%f') || '000Z",' END
      || '"stream_name":"events","subject":"' || subject || '"}}}}' AS json
    FROM coerced WHERE subject IS NOT NULL""",
)
def split_json_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    unset = F.lit(None)
    splits = (
        _coerced(spark, sf_dir)
        .where("subject is not null")
        .withColumns(
            {
                "last_emitted_seq": F.col("start_sequence"),
                "last_reply_to": unset.cast("string"),
                "messages": F.col("id"),
                "finished": F.lit(False),
                "stream": F.lit("events"),
                "ack_behavior": F.lit("AckAll"),
                "start_sequence": F.lit(-1).cast("long"),
                "max_messages_to_read": F.lit(-1).cast("long"),
                "batch_size": F.lit(-1),
                "threshold_percent": F.lit(-1),
                "consumer_name_prefix": unset.cast("string"),
                "durable_name": unset.cast("string"),
                "inactive_threshold": unset.cast("long"),
            }
        )
    )
    return split_json(splits).select("id", "json")


@query(
    "invalid_targets",
    f"""WITH {EV}, t AS (SELECT seq, CASE WHEN k < 10 THEN 'events.*.' || k WHEN k < 20 THEN event_type || '.>'
      WHEN k < 30 THEN event_type || '..' || k ELSE subject END AS subject FROM ev)
    SELECT seq, subject FROM t WHERE subject LIKE '%*%' OR subject LIKE '%>' OR subject LIKE '%..%'""",
)
def invalid_targets_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = number_in(F.col("data"))
    kind = F.element_at(F.split("subject", r"\."), 2)
    target = (
        F.when(k < 10, F.concat(F.lit("events.*."), k.cast("string")))
        .when(k < 20, F.concat(kind, F.lit(".>")))
        .when(k < 30, F.concat(kind, F.lit(".."), k.cast("string")))
        .otherwise(F.col("subject"))
    )
    return invalid_targets(events(spark, sf_dir).withColumn("subject", target)).select("seq", "subject")
