"""Queries that write a log and read it back, in batch and as streams."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.payload import decode_envelope
from ..functions.registry import convert_sink, sink_message
from ..functions.text import encode_utf8
from ..functions.times import local_time
from ..operators.acks import ack_last, ack_rows, work_queue_remaining
from ..operators.directory import progress_by_counts, subscribe_stored
from ..operators.sequence import with_sequence
from ..operators.subscribe import positioned, select_splits, subscribe
from ..operators.subscriptions import coerce, packed, subscriptions, with_split_id
from ..schema import ACK, DELIVERY, MESSAGE, SUBSCRIPTION
from ..scratch import discard, materialise, scratch_path
from ..sinks.fan_out import fan_out
from ..sinks.publish import append_acks, publish_core, publish_durable, read_acks
from ..sources.log import noted_batches, read_log, store, stream_log, write_log
from ..streaming.consume import emitted, ledger, progress, start_consumer
from ..streaming.redelivery import redeliver, redeliver_on_timers, redeliver_round, state_settings
from ..streaming.relay import start_relay
from ..streaming.tail import live_tail
from .catalog import query
from .reading import MANY
from .sample_log import EV, LOG, acks, deliveries, events, subject_subscriptions, whole_log

_FIVE_DAYS_MS = 5 * 24 * 3600 * 1000


def _middle():
    return local_time(datetime(2024, 1, 16))


def _per_subject(rows: DataFrame) -> DataFrame:
    return rows.groupBy("subject").agg(F.count("*").alias("n"))


def _stored(spark: SparkSession, messages: DataFrame) -> str:
    path = scratch_path(spark, "log")
    write_log(messages, path)
    return path


@query(
    "fan_out",
    f"WITH {EV} SELECT t.subject, e.seq, e.text FROM ev e CROSS JOIN (VALUES ('out.a'), ('out.b'), ('out.c')) t(subject)",
)
def fan_out_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = fan_out(events(spark, sf_dir), ["out.a", "out.b", "out.c"])
    return copies.select("subject", "seq", F.col("data").cast("string").alias("text"))


@query("drop_null", f"WITH {EV} SELECT seq, text FROM ev WHERE k < 50")
def drop_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sink converter that has nothing to say about large numbers."""
    records = events(spark, sf_dir).withColumn("value", F.col("data").cast("string"))
    small = F.get_json_object("value", "$.k").cast("long") < 50
    kept = convert_sink(records, lambda v: F.when(small, sink_message(encode_utf8(v))))
    return kept.select("seq", F.col("data").cast("string").alias("text"))


@query("log_table", f"WITH {LOG} SELECT stream, subject, seq, ts, reply_to, md5(text) AS h FROM log")
def log_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = read_log(spark, _stored(spark, whole_log(spark, sf_dir)))
    return log.select("stream", "subject", "seq", "ts", "reply_to", F.md5("data").alias("h"))


@query("publish_core", f"WITH {LOG} SELECT 'sink' AS stream, subject, count(*) AS n FROM log GROUP BY 2")
def publish_core_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "sink")
    publish_core(whole_log(spark, sf_dir), path, "sink", F.col("ts"))
    return read_log(spark, path).groupBy("stream", "subject").agg(F.count("*").alias("n"))


@query("publish_seq", f"WITH {EV} SELECT seq, row_number() OVER (ORDER BY subject, seq) AS out_seq FROM ev")
def publish_seq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_sequence(events(spark, sf_dir), ["subject", "seq"], "out_seq").select("seq", "out_seq")


@query(
    "publish_durable",
    f"""WITH {EV}, c AS (SELECT t.subject, e.seq AS source, t.target, e.text, ts >= TIMESTAMP '2024-01-16' AS late
      FROM ev e CROSS JOIN (VALUES ('out.a', 0), ('out.b', 1)) t(subject, target))
    SELECT subject, row_number() OVER (ORDER BY late, source, target) AS seq, md5(text) AS h FROM c""",
)
def publish_durable_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches to two subjects; the second continues the numbers of the first."""
    path = scratch_path(spark, "sink")
    copies = fan_out(events(spark, sf_dir), ["out.a", "out.b"])
    for batch, part in enumerate((F.col("ts") < _middle(), F.col("ts") >= _middle())):
        publish_durable(copies.where(part), path, "sink", ["seq", "target"], F.col("ts"), batch)
    return read_log(spark, path).select("subject", "seq", F.md5("data").alias("h"))


@query("replay_safe", f"WITH {LOG} SELECT subject, row_number() OVER (ORDER BY stream, seq) AS seq FROM log")
def replay_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that is published a second time, as after a crash, changes nothing."""
    path = scratch_path(spark, "sink")
    log = whole_log(spark, sf_dir)
    order = ["stream", "seq"]
    first = F.col("stream").isin("chat", "docs")
    for batch, part in ((0, first), (1, ~first), (1, ~first)):
        publish_durable(log.where(part), path, "sink", order, F.col("ts"), batch)
    return read_log(spark, path).select("subject", "seq")


@query(
    "replay_any_batch",
    f"""WITH {EV}, p AS (SELECT 'one' AS stream, CASE WHEN ts < TIMESTAMP '2024-01-10' THEN 0
        WHEN ts < TIMESTAMP '2024-01-20' THEN 1 ELSE 2 END AS batch, seq, text FROM ev
      UNION ALL SELECT 'two', 0, seq, text FROM ev WHERE event_type = 'view')
    SELECT stream, CAST(batch AS BIGINT) AS batch, row_number() OVER (PARTITION BY stream ORDER BY batch, seq) AS seq, md5(text) AS h,
      count(*) OVER (PARTITION BY stream, batch) AS noted FROM p""",
)
def replay_any_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches 0, 1, 2 of one stream and 0 of another, then 0 and 1 again: numbers stay, and both streams are noted."""
    path, log = scratch_path(spark, "sink"), events(spark, sf_dir)
    first, second = (local_time(datetime(2024, 1, d)) for d in (10, 20))
    parts = [F.col("ts") < first, (F.col("ts") >= first) & (F.col("ts") < second), F.col("ts") >= second]
    for batch in (0, 1, 2, 0, 1):
        publish_durable(log.where(parts[batch]), path, "one", ["seq"], F.col("ts"), batch)
        if not batch:
            publish_durable(log.where(F.col("subject").startswith("events.view.")), path, "two", ["seq"], F.col("ts"), batch)
    notes = noted_batches(spark, path).select("stream", "batch", "first", "last", F.col("rows").alias("noted"))
    rows = read_log(spark, path).join(notes, "stream").where("seq BETWEEN first AND last")
    return rows.select("stream", "batch", "seq", F.md5("data").alias("h"), "noted")


@query(
    "publish_concurrent",
    f"""WITH {EV}, n AS (SELECT 2 * count(*) AS n FROM ev)
    SELECT CAST(unnest(range(1, n + 1)) AS BIGINT) AS seq, CAST(1 AS BIGINT) AS copies, CAST(1 AS BIGINT) AS notes FROM n""",
)
def publish_concurrent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two relays into one stream at the same time: all rows once, no number twice, each number in one noted batch."""
    path, sink, log = scratch_path(spark, "log"), scratch_path(spark, "sink"), events(spark, sf_dir)
    for part in (F.col("ts") < _middle(), F.col("ts") >= _middle()):
        write_log(log.where(part).coalesce(1), path)
    running = [
        start_relay(stream_log(spark, path, files_per_trigger=files), sink, "sink", ["out.a"], scratch_path(spark, "checkpoint"))
        for files in (4, 6)
    ]
    for query_ in running:
        query_.awaitTermination()
    notes = noted_batches(spark, sink).select("first", "last")
    numbers = read_log(spark, sink).groupBy("seq").agg(F.count("*").alias("copies"))
    return numbers.join(notes, F.col("seq").between(F.col("first"), F.col("last"))).groupBy("seq", "copies").agg(F.count("*").alias("notes"))


@query(
    "pull_batches",
    f"""WITH {EV}, n AS (SELECT count(*) // 5 + 1 AS size, min(seq) AS low FROM ev)
    SELECT CAST((seq - low) // size AS BIGINT) AS pull, min(seq) AS first_seq, max(seq) AS last_seq, count(*) AS n FROM ev, n GROUP BY 1""",
)
def pull_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of one large batch, read by a subscription that wants at most a fifth of it at a time."""
    log = events(spark, sf_dir)
    path, out, state = _stored(spark, log), scratch_path(spark, "consumer"), scratch_path(spark, "checkpoint")
    given = {"stream": "events", "subject": ">", "batch_size": log.count() // 5 + 1}
    start_consumer(spark, path, subscriptions(spark, [given]), out, state, F.lit(None).cast("timestamp_ntz")).awaitTermination()
    pulled = spark.read.parquet(f"{out}/data").groupBy(F.col("batch").cast("long").alias("pull"))
    return pulled.agg(F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"), F.count("*").alias("n"))


@query("live_tail", f"WITH {EV} SELECT subject, seq FROM ev WHERE ts >= TIMESTAMP '2024-01-16' AND event_type <> 'error'")
def live_tail_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscribe when half of the log is there, then publish the rest."""
    path, out, state = (scratch_path(spark, n) for n in ("log", "live", "checkpoint"))
    log = events(spark, sf_dir)
    write_log(log.where(F.col("ts") < _middle()), path)
    kinds = ["click", "purchase", "signup", "view"]
    live = live_tail(spark, path, "events", [f"events.{k}.>" for k in kinds], state)
    write_log(log.where(F.col("ts") >= _middle()), path)
    return _drained(live, out, state).select("subject", "seq")


def _drained(stream: DataFrame, out: str, state: str) -> DataFrame:
    """Run a stream over all there is, and read what it wrote."""
    writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
    writer.trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


@query(
    "core_to_live",
    f"""WITH {EV} SELECT 'live' AS way, subject, md5(text) AS h FROM ev WHERE ts >= TIMESTAMP '2024-01-10' AND event_type = 'view'
    UNION ALL SELECT 'all', subject, md5(text) FROM ev WHERE event_type = 'view'""",
)
def core_to_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages without numbers: a live subscription, restarted once, gets those published after it first began; a
    subscription without a start gets all."""
    path, out, state = (scratch_path(spark, n) for n in ("log", "live", "checkpoint"))
    log, (first, second) = events(spark, sf_dir), (local_time(datetime(2024, 1, d)) for d in (10, 20))
    parts = (F.col("ts") < first, (F.col("ts") >= first) & (F.col("ts") < second), F.col("ts") >= second)
    publish_core(log.where(parts[0]), path, "events", F.col("ts"))
    live_tail(spark, path, "events", ["events.view.*"], state)
    for part in parts[1:]:
        publish_core(log.where(part), path, "events", F.col("ts"))
        live = _drained(live_tail(spark, path, "events", ["events.view.*"], state), out, state)
    every = subscribe(read_log(spark, path), subscriptions(spark, [{"stream": "events", "subject": "events.view.*"}]))
    shown = [live.withColumn("way", F.lit("live")), every.withColumn("way", F.lit("all"))]
    return shown[0].unionByName(shown[1]).select("way", "subject", F.md5("data").alias("h"))


@query(
    "publish_twice",
    f"""WITH {EV}, t AS (SELECT *, 0 AS round FROM ev UNION ALL SELECT *, 1 FROM ev)
    SELECT subject, row_number() OVER (ORDER BY round, seq) AS seq, md5(text) AS h FROM t""",
)
def publish_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same call twice adds twice; numbers go on without a gap."""
    path, log = scratch_path(spark, "sink"), events(spark, sf_dir)
    for _ in range(2):
        publish_durable(log, path, "sink", ["seq"], F.col("ts"))
    return read_log(spark, path).select("subject", "seq", F.md5("data").alias("h"))


@query(
    "relay_two_checkpoints",
    f"WITH {EV}, n AS (SELECT 2 * count(*) AS n FROM ev) SELECT CAST(unnest(range(1, n + 1)) AS BIGINT) AS seq FROM n",
)
def relay_two_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two relays into one sink, each with a checkpoint of its own, one after the other: all rows, gapless."""
    log, sink = _stored(spark, events(spark, sf_dir)), scratch_path(spark, "sink")
    for _ in range(2):
        state = scratch_path(spark, "checkpoint")
        start_relay(stream_log(spark, log, files_per_trigger=4), sink, "sink", ["out.a"], state).awaitTermination()
    return read_log(spark, sink).select("seq")


def _shuffled(spark: SparkSession, sf_dir: str) -> str:
    """A log of four batches, each of several files whose times of writing are not their order."""
    path, log = scratch_path(spark, "log"), events(spark, sf_dir)
    quarter = F.ntile(4).over(Window.partitionBy(F.lit(0)).orderBy("day"))
    days = log.select(F.to_date("ts").alias("day")).distinct().select("day", quarter.alias("quarter"))
    log = log.withColumn("day", F.to_date("ts")).join(days, "day")
    for n in range(1, 5):
        write_log(log.where(F.col("quarter") == n).repartition(3, "seq"), path)
    return path


@query(
    "stream_bounded",
    f"""WITH {EV}, r AS (SELECT *, row_number() OVER (PARTITION BY subject ORDER BY seq) AS rn FROM ev)
    SELECT subject, seq FROM r WHERE rn <= 150""",
)
def stream_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bounded consumer of several log batches keeps the first messages, not the first files."""
    path, out = _shuffled(spark, sf_dir), scratch_path(spark, "consumer")
    subs = subject_subscriptions(events(spark, sf_dir), 150)
    at = F.lit(None).cast("timestamp_ntz")
    state = scratch_path(spark, "checkpoint")
    start_consumer(spark, path, subs, out, state, at, batches_per_trigger=2).awaitTermination()
    return emitted(spark, out).select("subject", "seq")


@query(
    "stream_ordered",
    f"""WITH {EV} SELECT subject, count(*) AS n, CAST(0 AS BIGINT) AS behind FROM ev GROUP BY 1""",
)
def stream_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No message of a split comes in an earlier micro-batch than one with a smaller number."""
    path, out = _shuffled(spark, sf_dir), scratch_path(spark, "consumer")
    subs, at = subject_subscriptions(events(spark, sf_dir)), F.lit(None).cast("timestamp_ntz")
    start_consumer(spark, path, subs, out, scratch_path(spark, "checkpoint"), at, batches_per_trigger=1).awaitTermination()
    ends = spark.read.parquet(f"{out}/data").groupBy("subject", "split_id", "batch").agg(
        F.count("*").alias("n"), F.min("seq").alias("low"), F.max("seq").alias("high")
    )
    before = F.max("high").over(Window.partitionBy("split_id").orderBy("batch").rowsBetween(Window.unboundedPreceding, -1))
    late = F.sum((F.col("low") <= F.coalesce("before", F.lit(0))).cast("long"))
    return ends.withColumn("before", before).groupBy("subject").agg(F.sum("n").alias("n"), late.alias("behind"))


@query(
    "stream_durable_explicit",
    f"WITH {EV} SELECT subject, seq FROM ev WHERE event_type IN ('view', 'error') AND event_type = 'error'",
)
def stream_durable_explicit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A durable consumer as a stream does not get again what it acknowledged message by message."""
    path, out = _stored(spark, events(spark, sf_dir)), scratch_path(spark, "consumer")
    given = {"stream": "events", "ack_behavior": "ExplicitButDoNotAck", "durable_name": "worker", "batch_size": 100}
    subs = subscriptions(spark, [given | {"subject": f"events.{k}.*"} for k in ("view", "error")])
    done = acks(spark, sf_dir).withColumn("consumer", F.lit("worker"))
    at, state = F.lit(None).cast("timestamp_ntz"), scratch_path(spark, "checkpoint")
    start_consumer(spark, path, subs, out, state, at, acks=done).awaitTermination()
    return emitted(spark, out).select("subject", "seq")


@query(
    "work_queue_ack_all",
    f"""WITH {EV}, f AS (SELECT max(seq) AS floor FROM ev WHERE event_type = 'view' AND ts < TIMESTAMP '2024-01-16')
    SELECT subject, seq FROM ev, f WHERE NOT (event_type = 'view' AND seq <= coalesce(floor, 0))
      AND NOT (event_type = 'signup' AND seq % 2 = 0)""",
)
def work_queue_ack_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One consumer acknowledges views up to a floor, another every second sign-up by itself."""
    log = events(spark, sf_dir)
    given = [("all", "events.view.*", "AckAll"), ("some", "events.signup.*", "ExplicitButDoNotAck")]
    names = ("durable_name", "subject", "ack_behavior")
    subs = subscriptions(spark, [{"stream": "events", **dict(zip(names, g))} for g in given])
    seen = subscribe(log, subs.where("durable_name = 'all'")).where(F.col("ts") < _middle())
    at = F.lit(None).cast("timestamp_ntz")
    single = log.where(F.col("subject").startswith("events.signup.") & (F.col("seq") % 2 == 0))
    done = ack_last(seen, F.lit("all"), at).unionByName(ack_rows(single, F.lit("some"), at))
    return work_queue_remaining(log, done, subs).select("subject", "seq")


@query(
    "stream_equals_batch",
    f"""WITH {LOG}, subs(stream, pattern, rx, start_seq, start_time) AS (VALUES
      ('events', 'events.click.*', 'events\\.click\\.[^.]+', 101, TIMESTAMP '1970-01-01'),
      ('events', 'events.*.1', 'events\\.[^.]+\\.1', 1, TIMESTAMP '2024-01-10'),
      ('events', 'events.>', 'events\\..+', 1, TIMESTAMP '1970-01-01'),
      ('docs', 'docs.fr.>', 'docs\\.fr\\..+', 1, TIMESTAMP '1970-01-01'),
      ('docs', 'docs.en.src1', 'docs\\.en\\.src1', 1, TIMESTAMP '1970-01-01'),
      ('docs', 'docs.*.src2', 'docs\\.[^.]+\\.src2', 50, TIMESTAMP '1970-01-01'),
      ('chat', 'chat.user', 'chat\\.user', 1, TIMESTAMP '1970-01-01'))
    SELECT pattern, subject, seq FROM log JOIN subs USING (stream)
    WHERE regexp_full_match(subject, rx) AND seq >= start_seq AND ts >= start_time""",
)
def stream_equals_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The subscriptions of ``multi_subscription``, read as a stream in several batches."""
    log = _stored(spark, whole_log(spark, sf_dir))
    out, state = scratch_path(spark, "consumer"), scratch_path(spark, "checkpoint")
    subs = subscriptions(spark, MANY)
    start_consumer(spark, log, subs, out, state, F.lit(None).cast("timestamp_ntz"), batches_per_trigger=4).awaitTermination()
    names = F.broadcast(subs.select("split_id", F.col("subject").alias("pattern")))
    return emitted(spark, out).join(names, "split_id").select("pattern", "subject", "seq")


@query(
    "stream_ack_all",
    f"""WITH {EV}, r AS (SELECT *, row_number() OVER (PARTITION BY subject ORDER BY seq) AS rn FROM ev)
    SELECT 'd-' || subject AS consumer, subject, max(seq) AS floor, max(seq) AS last_emitted_seq,
      max_by(reply_to, seq) AS last_reply_to, count(*) AS messages, count(*) >= 400 AS finished
    FROM r WHERE rn <= 400 GROUP BY subject""",
)
def stream_ack_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bounded durable consumer per subject that acknowledges at the end of each batch."""
    log = events(spark, sf_dir)
    path = scratch_path(spark, "log")
    early = F.col("ts") < _middle()
    write_log(log.where(early), path, 0)
    out, state = scratch_path(spark, "consumer"), scratch_path(spark, "checkpoint")
    subs = subject_subscriptions(log, 400).withColumns(
        {"ack_behavior": F.lit("AckAll"), "durable_name": F.concat(F.lit("d-"), "subject")}
    )
    at = local_time(datetime(2024, 2, 1))
    start_consumer(spark, path, subs, out, state, at).awaitTermination()
    # The same consumer again, from its checkpoint, when the rest has been published.
    write_log(log.where(~early), path, 1)
    start_consumer(spark, path, subs, out, state, at).awaitTermination()
    floors = ledger(spark, out).groupBy("consumer").agg(F.max("seq").alias("floor"))
    named = progress(spark, out).join(subs.select("split_id", "subject", F.col("durable_name").alias("consumer")), "split_id")
    return named.join(floors, "consumer").select(
        "consumer", "subject", "floor", "last_emitted_seq", "last_reply_to", "messages", "finished"
    )


@query(
    "stream_relay",
    f"""WITH {LOG} SELECT t.subject, count(*) AS n, CAST(sum(strlen(text)) AS BIGINT) AS bytes FROM log
    CROSS JOIN (VALUES ('out.a'), ('out.b')) t(subject) GROUP BY 1""",
)
def stream_relay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source log to sink log as a stream, numbered; counts per target, after a gap check."""
    log = _stored(spark, whole_log(spark, sf_dir))
    sink, state = scratch_path(spark, "sink"), scratch_path(spark, "checkpoint")
    start_relay(stream_log(spark, log, files_per_trigger=6), sink, "sink", ["out.a", "out.b"], state).awaitTermination()
    written = read_log(spark, sink)
    found = written.agg(F.min("seq").alias("low"), F.max("seq").alias("high"), F.count_distinct("seq").alias("rows")).head()
    if (found["low"], found["high"]) != (1, found["rows"]):
        raise ValueError(f"numbers with gaps: {found}")
    return written.groupBy("subject").agg(F.count("*").alias("n"), F.sum(F.octet_length("data")).alias("bytes"))


@query(
    "stream_explicit_ack",
    f"""WITH {EV} SELECT 'pending' AS state, subject, count(*) AS n FROM ev WHERE event_type = 'error' GROUP BY 2
    UNION ALL SELECT 'copied', 'out.ack', count(*) FROM ev WHERE event_type <> 'error'""",
)
def stream_explicit_ack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A relay that acknowledges each message it has copied, through envelopes; errors are
    not subscribed to and stay pending in the work queue."""
    log_path, sink, ledger_path, state = (scratch_path(spark, n) for n in ("log", "sink", "ledger", "checkpoint"))
    write_log(events(spark, sf_dir), log_path)
    kinds = ["click", "purchase", "signup", "view"]
    given = {"stream": "events", "ack_behavior": "ExplicitButDoNotAck", "durable_name": "worker"}
    subs = subscriptions(spark, [given | {"subject": f"events.{k}.*"} for k in kinds])
    wanted = select_splits(stream_log(spark, log_path, files_per_trigger=6), positioned(subs))

    def unwrap(records: DataFrame) -> DataFrame:
        return records.withColumn("value", decode_envelope(F.col("value"))["data"])

    start_relay(
        wanted.select(*MESSAGE.names),
        sink,
        "sink",
        ["out.ack"],
        state,
        source="ack_envelope",
        mapper=unwrap,
        consumer="worker",
        ack_path=ledger_path,
    ).awaitTermination()
    left = work_queue_remaining(read_log(spark, log_path), read_acks(spark, ledger_path))
    pending = left.groupBy(F.lit("pending").alias("state"), "subject").agg(F.count("*").alias("n"))
    copied = read_log(spark, sink).groupBy(F.lit("copied").alias("state"), "subject").agg(F.count("*").alias("n"))
    return pending.unionByName(copied)


def _redelivered(spark: SparkSession, sf_dir: str, operator: Callable[..., DataFrame], *mode: str) -> DataFrame:
    """Run a redelivery operator over the ledger fixtures as streams and read its output."""
    sent, done = scratch_path(spark, "deliveries"), scratch_path(spark, "acks")
    out, state = scratch_path(spark, "redelivered"), scratch_path(spark, "checkpoint")
    deliveries(spark, sf_dir).write.parquet(sent)
    acks(spark, sf_dir).write.parquet(done)
    streams = (spark.readStream.schema(schema).parquet(path) for schema, path in ((DELIVERY, sent), (ACK, done)))
    again = operator(*streams, _FIVE_DAYS_MS, *mode)
    writer = again.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
    with state_settings(spark):
        writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(again.schema).parquet(out)


@query(
    "redelivery_attempts",
    f"""WITH {EV}, sent AS (SELECT 'c' || (user_id % 4) AS consumer, seq, ts FROM ev WHERE event_type = 'error')
    SELECT consumer, seq, CAST(n AS INTEGER) AS attempt, TIMESTAMP '2024-02-10' + INTERVAL 10 DAY * (n - 2) AS delivered_at
    FROM sent, (VALUES (2), (3), (4)) r(n)""",
)
def redelivery_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three rounds, ten days apart, with a wait of five: each finds what is still not acknowledged; the last one is
    run twice, as after a failure."""
    sent, done = scratch_path(spark, "deliveries"), scratch_path(spark, "ledger")
    store(deliveries(spark, sf_dir).withColumn("batch", F.lit(0).cast("long")), sent, "batch")
    append_acks(acks(spark, sf_dir), done)
    wait = F.lit(_FIVE_DAYS_MS * 1_000_000)
    for number, day in ((1, 0), (2, 10), (3, 20), (3, 20)):
        redeliver_round(spark, sent, done, wait, local_time(datetime(2024, 2, 10) + timedelta(days=day)), number)
    again = spark.read.parquet(sent).where("batch > 0")
    return again.select("consumer", "seq", "attempt", "delivered_at")


@query(
    "many_subscriptions",
    f"""WITH {EV}, s AS (SELECT seq AS low, subject, event_type, lead(seq) OVER (PARTITION BY event_type ORDER BY seq) AS next FROM ev),
    w AS (SELECT 1 AS bound, low, low AS seq FROM s UNION ALL SELECT 2, low, low FROM s
      UNION ALL SELECT 2, low, next FROM s WHERE next IS NOT NULL)
    SELECT way, CAST(bound AS BIGINT) AS bound, low, ev.subject, ev.seq FROM w JOIN ev USING (seq), (VALUES ('batch'), ('stream')) v(way)""",
)
def many_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two subscriptions per event, for one message of its subject and for two of its kind, from its own number on, read
    as a table and as a stream."""
    log = events(spark, sf_dir)
    given = {"stream": F.col("stream"), "start_sequence": F.col("seq"), "consumer_name_prefix": F.col("seq").cast("string")}
    kind = F.concat(F.substring_index("subject", ".", 2), F.lit(".*"))
    asked = []
    for pattern, bound in ((F.col("subject"), 1), (kind, 2)):
        columns = given | {"subject": pattern, "max_messages_to_read": F.lit(bound)}
        asked.append(log.select(*[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in SUBSCRIPTION]))
    # their ids are reckoned once
    ids = with_split_id(coerce(asked[0].unionByName(asked[1])))
    subs = materialise(ids, scratch_path(spark, "subscriptions"), lean=True)
    path, out, state = _stored(spark, log), scratch_path(spark, "consumer"), scratch_path(spark, "checkpoint")
    start_consumer(spark, path, subs, out, state, F.lit(None).cast("timestamp_ntz")).awaitTermination()
    # an id is never null; said so, none is packed a second time to see that
    key = F.coalesce(packed(), F.lit(b"")).alias("key")
    # written, so that all it takes is gone before both are joined
    steps, read = scratch_path(spark, "subscribed"), scratch_path(spark, "batch")
    batch = materialise(subscribe(log, subs, scratch=steps).select(key, "subject", "seq"), read, lean=True)
    discard(spark, steps)
    stream = emitted(spark, out).select(key, "subject", "seq")
    both = batch.withColumn("way", F.lit("batch")).unionByName(stream.withColumn("way", F.lit("stream")))
    starts = subs.select(key, F.col("start_sequence").alias("low"), F.col("max_messages_to_read").alias("bound"))
    met = both.join(starts.hint("merge"), "key")
    return met.select("way", "bound", "low", "subject", "seq")


@query(
    "bounded_from_directory",
    f"""WITH {EV}, r AS (SELECT *, row_number() OVER (PARTITION BY subject ORDER BY seq) AS rn FROM ev),
    s AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY seq) AS rn FROM ev WHERE seq >= 300)
    SELECT 'subject' AS way, subject, seq FROM r WHERE rn <= 25 UNION ALL SELECT 'kind', subject, seq FROM s WHERE rn <= 700""",
)
def bounded_from_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounded subscriptions whose ends are looked up in the log's counts: the first of each subject, and those of each
    kind from a number on."""
    log = events(spark, sf_dir)
    path = scratch_path(spark, "log")
    for half in (F.col("ts") < _middle(), F.col("ts") >= _middle()):
        write_log(log.where(half), path)
    first = subscribe_stored(spark, path, subject_subscriptions(log, 25)).withColumn("way", F.lit("subject"))
    given = {"stream": "events", "start_sequence": 300, "max_messages_to_read": 700}
    kinds = subscriptions(spark, [given | {"subject": f"events.{k}.*"} for k in ("click", "error", "purchase", "signup", "view")])
    both = first.unionByName(subscribe_stored(spark, path, kinds).withColumn("way", F.lit("kind")))
    return both.select("way", "subject", "seq")


@query(
    "progress_from_directory",
    f"WITH {EV} SELECT subject, max(seq) AS last_emitted_seq, count(*) AS messages FROM ev WHERE seq <= 5000 GROUP BY 1",
)
def progress_from_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far each subject's reader is at a number: whole buckets are not read for it."""
    log = events(spark, sf_dir)
    subs = subject_subscriptions(log)
    told = progress_by_counts(spark, _stored(spark, log), subs, 5000)
    return told.join(subs.select("split_id", "subject"), "split_id").select("subject", "last_emitted_seq", "messages")


@query(
    "stream_unordered",
    f"WITH {EV} SELECT subject, seq FROM ev WHERE event_type = 'click' AND seq >= 50",
)
def stream_unordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, out, state = _stored(spark, events(spark, sf_dir)), scratch_path(spark, "consumer"), scratch_path(spark, "checkpoint")
    given = {"stream": "events", "subject": "events.click.*", "ack_behavior": "NoAckUnordered", "start_sequence": 50}
    start_consumer(spark, path, subscriptions(spark, [given]), out, state, F.lit(None).cast("timestamp_ntz")).awaitTermination()
    return emitted(spark, out).select("subject", "seq")


# The join's clock is the slower of the two watermarks, the acknowledgements' here.
@query(
    "redelivery_stream",
    f"""WITH {EV} SELECT 'c' || (user_id % 4) AS consumer, stream, seq, CAST(2 AS INTEGER) AS attempt FROM ev
    WHERE event_type = 'error' AND ts + INTERVAL 5 DAY <
      (SELECT least(max(ts), max(ts) FILTER (event_type <> 'error')) FROM ev)""",
)
def redelivery_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _redelivered(spark, sf_dir, redeliver).select("consumer", "stream", "seq", "attempt")


@query(
    "redelivery_timers",
    f"""WITH {EV} SELECT 'c' || (user_id % 4) AS consumer, stream, seq FROM ev
    WHERE event_type = 'error' AND ts + INTERVAL 5 DAY < (SELECT max(ts) FROM ev)""",
)
def redelivery_timers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often a message comes again depends on the batches, that it does so does not."""
    again = _redelivered(spark, sf_dir, redeliver_on_timers, "EventTime")
    return again.select("consumer", "stream", "seq").distinct()
