"""Queries that read the log: subjects, subscriptions, positions, bounds."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.payload import first_header
from ..functions.subjects import subject_matches
from ..functions.times import local_time
from ..operators.progress import split_progress
from ..operators.subscribe import subscribe
from ..operators.subscriptions import subscriptions
from ..sinks.fan_out import relay
from .catalog import query
from .sample_log import EV, LOG, events, number_in, subject_subscriptions, whole_log


def _span(rows: DataFrame) -> DataFrame:
    return rows.groupBy("subject").agg(
        F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"), F.count("*").alias("n")
    )


def _named(rows: DataFrame, subs: DataFrame) -> DataFrame:
    """Rows with the pattern of the subscription that delivered them, counted."""
    counted = rows.groupBy("split_id").agg(F.count("*").alias("n"), F.max("seq").alias("last_seq"))
    names = subs.select("split_id", F.col("subject").alias("pattern"))
    return counted.join(names, "split_id").select("pattern", "n", "last_seq")


@query(
    "relay",
    f"""WITH {EV} SELECT t.target, e.subject, count(*) AS n, CAST(sum(strlen(e.text)) AS BIGINT) AS bytes
    FROM ev e CROSS JOIN (VALUES ('out.a'), ('out.b')) t(target)
    WHERE regexp_full_match(e.subject, 'events\\.[^.]+\\.1') GROUP BY 1, 2""",
)
def relay_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    subs = subscriptions(spark, [{"stream": "events", "subject": "events.*.1"}])
    copies = relay(subscribe(events(spark, sf_dir), subs), ["out.a", "out.b"])
    return copies.groupBy(F.col("subject").alias("target"), F.col("source_subject").alias("subject")).agg(
        F.count("*").alias("n"), F.sum(F.octet_length("data")).alias("bytes")
    )


@query("stream_scan", f"WITH {EV} SELECT stream, subject, seq, ts, event_type AS type, reply_to, text FROM ev")
def stream_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    subs = subscriptions(spark, [{"stream": "events", "subject": ">"}])
    rows = subscribe(whole_log(spark, sf_dir), subs)
    kind = first_header(F.col("headers"), "type").alias("type")
    return rows.select("stream", "subject", "seq", "ts", kind, "reply_to", F.col("data").cast("string").alias("text"))


@query("multi_stream", f"WITH {LOG} SELECT stream, count(*) AS n, max(seq) AS last_seq FROM log GROUP BY 1")
def multi_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    subs = subscriptions(spark, [{"stream": s, "subject": f"{s}.>"} for s in ("events", "docs", "chat")])
    rows = subscribe(whole_log(spark, sf_dir), subs)
    return rows.groupBy("stream").agg(F.count("*").alias("n"), F.max("seq").alias("last_seq"))


@query("subject_literal", f"WITH {EV} SELECT subject, seq FROM ev WHERE subject = 'events.click.1'")
def subject_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).where(subject_matches(F.col("subject"), "events.click.1")).select("subject", "seq")


@query(
    "subject_wildcard", f"WITH {EV} SELECT subject, seq FROM ev WHERE regexp_full_match(subject, 'events\\.[^.]+\\.1')"
)
def subject_wildcard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).where(subject_matches(F.col("subject"), "events.*.1")).select("subject", "seq")


MANY = [
    {"stream": "events", "subject": "events.click.*", "start_sequence": 101},
    {"stream": "events", "subject": "events.*.1", "start_time": datetime(2024, 1, 10)},
    {"stream": "events", "subject": "events.>"},
    {"stream": "docs", "subject": "docs.fr.>"},
    {"stream": "docs", "subject": "docs.en.src1"},
    {"stream": "docs", "subject": "docs.*.src2", "start_sequence": 50},
    {"stream": "chat", "subject": "chat.user"},
]


@query(
    "multi_subscription",
    f"""WITH {LOG}, subs(stream, pattern, rx, start_seq, start_time) AS (VALUES
      ('events', 'events.click.*', 'events\\.click\\.[^.]+', 101, TIMESTAMP '1970-01-01'),
      ('events', 'events.*.1', 'events\\.[^.]+\\.1', 1, TIMESTAMP '2024-01-10'),
      ('events', 'events.>', 'events\\..+', 1, TIMESTAMP '1970-01-01'),
      ('docs', 'docs.fr.>', 'docs\\.fr\\..+', 1, TIMESTAMP '1970-01-01'),
      ('docs', 'docs.en.src1', 'docs\\.en\\.src1', 1, TIMESTAMP '1970-01-01'),
      ('docs', 'docs.*.src2', 'docs\\.[^.]+\\.src2', 50, TIMESTAMP '1970-01-01'),
      ('chat', 'chat.user', 'chat\\.user', 1, TIMESTAMP '1970-01-01'))
    SELECT pattern, count(*) AS n, max(seq) AS last_seq FROM log JOIN subs USING (stream)
    WHERE regexp_full_match(subject, rx) AND seq >= start_seq AND ts >= start_time GROUP BY 1""",
)
def multi_subscription(spark: SparkSession, sf_dir: str) -> DataFrame:
    subs = subscriptions(spark, MANY)
    return _named(subscribe(whole_log(spark, sf_dir), subs), subs)


@query(
    "overlap_subscription",
    f"""WITH {EV} SELECT 'events.click.*' AS pattern, seq, subject FROM ev WHERE event_type = 'click'
    UNION ALL SELECT 'events.*.1', seq, subject FROM ev WHERE user_id % 4 = 1""",
)
def overlap_subscription(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = [{"stream": "events", "subject": s} for s in ("events.click.*", "events.*.1")]
    subs = subscriptions(spark, given)
    names = F.broadcast(subs.select("split_id", F.col("subject").alias("pattern")))
    return subscribe(events(spark, sf_dir), subs).join(names, "split_id").select("pattern", "seq", "subject")


@query(
    "bounded_read",
    f"""WITH {EV} SELECT subject, seq FROM (
      SELECT subject, seq, row_number() OVER (PARTITION BY subject ORDER BY seq) AS rn FROM ev) WHERE rn <= 25""",
)
def bounded_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = events(spark, sf_dir)
    return subscribe(log, subject_subscriptions(log, 25)).select("subject", "seq")


@query(
    "start_sequence",
    f"WITH {EV} SELECT subject, seq FROM ev WHERE event_type = 'purchase' AND seq >= 401",
)
def start_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    subs = subscriptions(spark, [{"stream": "events", "subject": "events.purchase.*", "start_sequence": 401}])
    return subscribe(events(spark, sf_dir), subs).select("subject", "seq")


@query("start_time", f"WITH {EV} SELECT subject, seq FROM ev WHERE ts >= TIMESTAMP '2024-01-15'")
def start_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    subs = subscriptions(spark, [{"stream": "events", "subject": "events.>", "start_time": datetime(2024, 1, 15)}])
    return subscribe(events(spark, sf_dir), subs).select("subject", "seq")


@query(
    "resume_progress",
    f"""WITH {EV}, saved AS (SELECT subject, max(seq) AS last, count(*) AS messages FROM ev
      WHERE ts < TIMESTAMP '2024-01-10' GROUP BY 1),
    rest AS (SELECT e.subject, e.seq, s.messages, row_number() OVER (PARTITION BY e.subject ORDER BY e.seq) AS rn
      FROM ev e LEFT JOIN saved s USING (subject) WHERE e.seq > coalesce(s.last, 0))
    SELECT subject, min(seq) AS first_seq, max(seq) AS last_seq, count(*) AS n
    FROM rest WHERE rn <= 300 - coalesce(messages, 0) GROUP BY 1""",
)
def resume_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = events(spark, sf_dir)
    subs = subject_subscriptions(log, 300)
    seen = log.where(F.col("ts") < local_time(datetime(2024, 1, 10)))
    ids = subs.select("stream", "subject", "split_id")
    saved = split_progress(seen.join(ids, ["stream", "subject"]))
    return _span(subscribe(log, subs, progress=saved))


@query(
    "durable_resume",
    f"""WITH {EV}, acked AS (SELECT subject, seq FROM ev WHERE k < 50),
    floors AS (SELECT subject, max(seq) AS floor FROM acked GROUP BY 1),
    open AS (
      SELECT e.subject, e.seq FROM ev e LEFT JOIN floors f USING (subject)
        WHERE e.user_id % 4 < 2 AND e.seq > coalesce(f.floor, 0)
      UNION ALL SELECT e.subject, e.seq FROM ev e ANTI JOIN acked a ON a.seq = e.seq WHERE e.user_id % 4 >= 2)
    SELECT subject, min(seq) AS first_seq, max(seq) AS last_seq, count(*) AS n FROM open GROUP BY 1""",
)
def durable_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = events(spark, sf_dir)
    cumulative = F.col("subject").endswith(".0") | F.col("subject").endswith(".1")
    subs = subject_subscriptions(log).withColumns(
        {
            "durable_name": F.concat(F.lit("d-"), "subject"),
            "ack_behavior": F.when(cumulative, "AckAll").otherwise("ExplicitButDoNotAck"),
            # A durable consumer ignores its start option.
            "start_sequence": F.lit(2_000_000_000).cast("long"),
        }
    )
    acked = log.where(number_in(F.col("data")) < 50)
    ledger = acked.select(F.concat(F.lit("d-"), "subject").alias("consumer"), "stream", "seq", F.col("ts").alias("acked_at"))
    return _span(subscribe(log, subs, acks=ledger))


@query(
    "skip_finished",
    f"WITH {EV} SELECT subject, count(*) AS n FROM ev WHERE subject NOT IN "
    "(SELECT subject FROM ev GROUP BY 1 HAVING count(*) >= 500) GROUP BY 1",
)
def skip_finished(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = events(spark, sf_dir)
    subs = subject_subscriptions(log)
    ids = subs.select("stream", "subject", "split_id", F.lit(500).alias("bound"))
    done = split_progress(log.join(ids, ["stream", "subject"]), bound="bound").where("finished")
    return subscribe(log, subs, progress=done).groupBy("subject").agg(F.count("*").alias("n"))
