"""A message log derived from the given tables, and the same rows as SQL.

Stream ``events`` comes from ``events``, ``docs`` from ``documents``, ``chat`` from
``conversations``.  Sequence numbers follow the tables' ids; no clock, nothing random.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import encode_utf8
from ..functions.times import local_time
from ..schema import MESSAGE

EPOCH = datetime(2024, 1, 1)
NOW = datetime(2024, 1, 20)

# Room for the turns of one conversation in the sequence numbers of ``chat``.
TURNS = 1000

_NO_HEADERS = "map<string,array<string>>"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _header(name: str, value: Column) -> Column:
    return F.create_map(F.lit(name), F.array(value))


def _after_epoch(seconds: Column) -> Column:
    return local_time(EPOCH) + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def _message(stream: str, subject: Column, seq: Column, ts: Column, headers: Column, text: Column) -> list[Column]:
    reply_to = F.concat(F.lit(f"$ACK.{stream}."), seq.cast("string"))
    parts = [F.lit(stream), subject, seq, ts, headers, reply_to, encode_utf8(text)]
    return [part.alias(name) for part, name in zip(parts, MESSAGE.names)]


def event_subject() -> Column:
    return F.concat_ws(".", F.lit("events"), "event_type", (F.col("user_id") % 4).cast("string"))


def events(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    seq = F.col("event_id") + 1
    headers = _header("type", F.col("event_type"))
    columns = _message("events", event_subject(), seq, F.col("ts"), headers, F.col("props"))
    return table(spark, sf_dir, "events").select(*columns, *extra)


def docs(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    seq = F.col("doc_id") + 1
    subject = F.concat_ws(".", F.lit("docs"), "lang", "source")
    headers = _header("lang", F.col("lang"))
    columns = _message("docs", subject, seq, _after_epoch(F.col("doc_id")), headers, F.col("text"))
    return table(spark, sf_dir, "documents").select(*columns, *extra)


def chat(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    seq = F.col("conv_id") * TURNS + F.col("turn") + 1
    subject = F.concat_ws(".", F.lit("chat"), "role")
    empty = F.create_map().cast(_NO_HEADERS)
    columns = _message("chat", subject, seq, _after_epoch(seq), empty, F.col("text"))
    return table(spark, sf_dir, "conversations").select(*columns, *extra)


def whole_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).unionByName(docs(spark, sf_dir)).unionByName(chat(spark, sf_dir))


# The same rows in SQL: (stream, subject, seq, ts, type, reply_to, text) and, for events,
# the columns the fixtures use.
EV = """ev AS (SELECT 'events' AS stream, 'events.' || event_type || '.' || (user_id % 4) AS subject,
  event_id + 1 AS seq, ts, '$ACK.events.' || (event_id + 1) AS reply_to, props AS text,
  event_type, user_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events)"""
DOC = """doc AS (SELECT 'docs' AS stream, 'docs.' || lang || '.' || source AS subject, doc_id + 1 AS seq,
  TIMESTAMP '2024-01-01' + to_seconds(doc_id) AS ts, '$ACK.docs.' || (doc_id + 1) AS reply_to, text FROM documents)"""
CHAT = """chat AS (SELECT 'chat' AS stream, 'chat.' || role AS subject, conv_id * 1000 + turn + 1 AS seq,
  TIMESTAMP '2024-01-01' + to_seconds(conv_id * 1000 + turn + 1) AS ts,
  '$ACK.chat.' || (conv_id * 1000 + turn + 1) AS reply_to, text FROM conversations)"""
LOG = f"""{EV}, {DOC}, {CHAT}, log AS (
  SELECT stream, subject, seq, ts, reply_to, text FROM ev
  UNION ALL SELECT stream, subject, seq, ts, reply_to, text FROM doc
  UNION ALL SELECT stream, subject, seq, ts, reply_to, text FROM chat)"""


def number_in(data: Column) -> Column:
    """The number ``k`` an event's payload holds."""
    return F.get_json_object(data.cast("string"), "$.k").cast("long")


def consumer() -> Column:
    """The consumer of an event in the ledger fixtures."""
    return F.concat(F.lit("c"), F.element_at(F.split("subject", r"\."), -1))


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event was delivered once, when it was published."""
    return events(spark, sf_dir).select(
        consumer().alias("consumer"), "stream", "seq", F.col("ts").alias("delivered_at"), F.lit(1).alias("attempt")
    )


def acks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events other than errors were acknowledged."""
    acked = events(spark, sf_dir).where(~F.col("subject").startswith("events.error."))
    return acked.select(consumer().alias("consumer"), "stream", "seq", F.col("ts").alias("acked_at"))


LEDGER = f"""{EV}, delivery AS (SELECT 'c' || (user_id % 4) AS consumer, stream, seq, ts AS delivered_at, 1 AS attempt FROM ev),
  ack AS (SELECT 'c' || (user_id % 4) AS consumer, stream, seq, ts AS acked_at FROM ev WHERE event_type <> 'error')"""


def subject_subscriptions(messages: DataFrame, bound: int | None = None) -> DataFrame:
    """One subscription per subject found in ``messages``."""
    from ..operators.subscriptions import coerce, with_split_id
    from ..schema import SUBSCRIPTION

    found = messages.select("stream", "subject").distinct()
    given = {"max_messages_to_read": F.lit(bound).cast("long")}
    columns = [
        F.col(f.name) if f.name in ("stream", "subject") else given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
        for f in SUBSCRIPTION
    ]
    return with_split_id(coerce(found.select(*columns)))


def raw_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One subscription as a user might write it per event: some fields out of range, some
    combinations forbidden."""
    e = table(spark, sf_dir, "events")
    i = F.col("event_id")
    k = number_in(F.col("props"))
    behaviors = ["NoAck", "noackunordered", "ACKALL", "AllButDoNotAck", "explicitbutdonotack", "someday", None]
    named = F.element_at(F.array(*[F.lit(b) for b in behaviors]), (i % 7 + 1).cast("int"))
    return e.select(
        i.alias("id"),
        F.lit(None).cast("string").alias("split_id"),
        F.when(k == 7, "").otherwise("events").alias("stream"),
        F.when(k != 11, event_subject()).alias("subject"),
        F.when(i % 5 == 0, F.concat(F.lit("p"), F.col("user_id").cast("string"))).otherwise("").alias("consumer_name_prefix"),
        F.when(i % 3 == 0, F.concat(F.lit("d"), F.col("user_id").cast("string"))).alias("durable_name"),
        (k - 50).alias("start_sequence"),
        F.when(F.col("user_id") < 40, F.col("ts")).alias("start_time"),
        (F.col("user_id") - 75).alias("max_messages_to_read"),
        named.alias("ack_behavior"),
        ((i % 4 - 1) * 1_000_000_000).alias("ack_wait"),
        ((i % 3 - 1) * 5_000_000_000).alias("inactive_threshold"),
        (k.cast("int") * 10 - 100).alias("batch_size"),
        (k.cast("int") * 2 - 20).alias("threshold_percent"),
    )


RAW = """raw AS (SELECT event_id AS id, CASE WHEN k = 7 THEN '' ELSE 'events' END AS stream,
  CASE WHEN k <> 11 THEN 'events.' || event_type || '.' || (user_id % 4) END AS subject,
  CASE WHEN event_id % 5 = 0 THEN 'p' || user_id ELSE '' END AS consumer_name_prefix,
  CASE WHEN event_id % 3 = 0 THEN 'd' || user_id END AS durable_name,
  k - 50 AS start_sequence, CASE WHEN user_id < 40 THEN ts END AS start_time,
  user_id - 75 AS max_messages_to_read,
  CASE event_id % 7 WHEN 0 THEN 'NoAck' WHEN 1 THEN 'noackunordered' WHEN 2 THEN 'ACKALL' WHEN 3 THEN 'AllButDoNotAck'
    WHEN 4 THEN 'explicitbutdonotack' WHEN 5 THEN 'someday' END AS ack_behavior,
  (event_id % 4 - 1) * 1000000000 AS ack_wait, (event_id % 3 - 1) * 5000000000 AS inactive_threshold,
  k * 10 - 100 AS batch_size, k * 2 - 20 AS threshold_percent
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events)),
coerced AS (SELECT id, nullif(stream, '') AS stream, nullif(subject, '') AS subject,
  nullif(consumer_name_prefix, '') AS consumer_name_prefix, nullif(durable_name, '') AS durable_name,
  CASE WHEN start_sequence >= 1 THEN start_sequence ELSE -1 END AS start_sequence, start_time,
  CASE WHEN max_messages_to_read >= 1 THEN max_messages_to_read ELSE -1 END AS max_messages_to_read,
  CASE lower(ack_behavior) WHEN 'noackunordered' THEN 'NoAckUnordered' WHEN 'ackall' THEN 'AckAll'
    WHEN 'allbutdonotack' THEN 'AllButDoNotAck' WHEN 'explicitbutdonotack' THEN 'ExplicitButDoNotAck'
    ELSE 'NoAck' END AS ack_behavior,
  CASE WHEN ack_wait > 0 THEN ack_wait END AS ack_wait,
  CASE WHEN inactive_threshold > 0 THEN inactive_threshold END AS inactive_threshold,
  CAST(CASE WHEN batch_size >= 1 THEN batch_size ELSE -1 END AS INTEGER) AS batch_size,
  CAST(CASE WHEN threshold_percent < 1 THEN -1 WHEN threshold_percent > 100 THEN 100 ELSE threshold_percent END AS INTEGER)
    AS threshold_percent FROM raw)"""
