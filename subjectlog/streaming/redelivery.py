"""Redelivery of unacknowledged messages.

``start_redelivery`` looks at the ledger in rounds and delivers again, as attempt 2, 3 and so on, what has
waited too long; a clock starts the rounds, so they go on when nothing else happens.

``redeliver`` joins two streams, deliveries and acknowledgements, inside the wait and hands out those
that found none: JVM state only, the slower of the two watermarks is the clock.  It gives second attempts; fed
back, its output is late by then.

``redeliver_on_timers`` keeps timers.  It runs on the wall clock and so also works while nothing arrives; messages are
kept by buckets of numbers, so that Python state calls are made per bucket that something happens to, not per message.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.times import epoch_seconds, local_time, nanos_interval
from ..operators.acks import MESSAGE_KEY, pending_explicit
from ..operators.attach import small_rows
from ..schema import ACK, DELIVERY, SEQ_BUCKET
from ..scratch import materialise, scratch_path
from ..sources.files import Folder
from ..sources.log import BATCH_KEY, read_batches, store

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_PARTITIONS = "spark.sql.shuffle.partitions"


@contextmanager
def state_settings(spark: SparkSession) -> Iterator[None]:
    """Settings to start a redelivery query with: the state store that keeps large state on
    disk and has timers, and no more state partitions than there are cores.  A query keeps
    the number it was first started with."""
    given = {key: spark.conf.get(key) for key in (_PROVIDER, _PARTITIONS)}
    partitions = min(int(given[_PARTITIONS]), spark.sparkContext.defaultParallelism)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set(_PARTITIONS, partitions)
    try:
        yield
    finally:
        for key, value in given.items():
            spark.conf.set(key, value)


def _zoned(ts: str) -> Column:
    return F.col(ts).cast("timestamp")


def redeliver(deliveries: DataFrame, acks: DataFrame, ack_wait_ms: int, lateness: str = "0 seconds") -> DataFrame:
    """Deliveries no acknowledgement followed within ``ack_wait_ms``, as the next attempt.

    ``lateness`` is how far the two tables may run apart.  Rows come out once the watermark
    has passed the wait; state older than that is dropped.
    """
    sent = deliveries.select(*MESSAGE_KEY, "attempt", _zoned("delivered_at").alias("sent_at"))
    done = acks.select(*[F.col(k).alias(f"ack_{k}") for k in MESSAGE_KEY], _zoned("acked_at").alias("acked_at"))
    wait = F.expr(f"INTERVAL '{ack_wait_ms / 1000:.3f}' SECOND")
    same = [F.col(k) == F.col(f"ack_{k}") for k in MESSAGE_KEY]
    in_time = (F.col("acked_at") >= F.col("sent_at")) & (F.col("acked_at") <= F.col("sent_at") + wait)
    joined = sent.withWatermark("sent_at", lateness).join(
        done.withWatermark("acked_at", lateness), [*same, in_time], "left_outer"
    )
    return joined.where(F.col("acked_at").isNull()).select(
        "consumer",
        "stream",
        "seq",
        (F.col("sent_at") + wait).alias("delivered_at"),
        (F.col("attempt") + 1).cast("int").alias("attempt"),
    )


def redeliver_round(
    spark: SparkSession,
    deliveries: str,
    ledger: str,
    ack_wait: Column,
    now: Column,
    number: int,
    sent: DataFrame | None = None,
) -> None:
    """Add round ``number`` to the delivery table at ``deliveries``: what was last delivered ``ack_wait`` nanoseconds
    before ``now`` and is not acknowledged in ``ledger``.  The same round again replaces itself and sees only
    earlier ones.

    Open deliveries are kept below ``_due``, by the hour in which they fall due and the round that put them there.  The
    first round takes what the table has; a later one reads the hours that have come, the acknowledgements that are new,
    and the older ones of the same 2**20 numbers as what is due, whatever the history.  ``sent`` are first deliveries
    since the last round.
    """
    folder = Folder(spark, f"{deliveries}/_due")
    earlier = [int(n.removesuffix(".json")) for n in folder.names("_rounds")]
    known = max((n for n in earlier if n < number), default=None)
    state = json.loads(folder.read(f"_rounds/{known}.json")) if known is not None else {"open": None, "acks": {}}
    at = spark.range(1).select(now.alias("now"), F.floor(epoch_seconds(now) / _DUE).alias("hour")).head()
    now = local_time(at["now"])
    seen = _mark_new(spark, folder, ledger, state["acks"], number)
    due_at = F.col("delivered_at") + nanos_interval(ack_wait)

    parts = [read_batches(spark, f"{folder.root}/pending", _PENDING, only=due_folders(folder, state["open"], known, at["hour"], number))]
    if known is None:
        first = read_batches(spark, deliveries, T.StructType([*DELIVERY, T.StructField("batch", T.LongType())]))
        parts.append(first.where(F.col("batch") < number))
    if sent is not None:
        parts.append(sent)
    rows = reduce(DataFrame.unionByName, [p.select(*DELIVERY.names) for p in parts])
    last = rows.groupBy(*MESSAGE_KEY).agg(F.max("attempt").alias("attempt"), F.max("delivered_at").alias("delivered_at"))
    left = materialise(pending_explicit(last, _marks_of(spark, folder, last)), scratch_path(spark, "open"))
    late = due_at <= now
    again = left.where(late).select(
        "consumer", "stream", "seq", now.alias("delivered_at"), (F.col("attempt") + 1).cast("int").alias("attempt")
    )
    store(again.select(*DELIVERY.names, F.lit(number).cast("long").alias("batch")), deliveries, "batch")
    waiting = left.where(~late).select(*DELIVERY.names).unionByName(again)
    hour = F.floor(epoch_seconds(due_at) / _DUE).alias("due")
    store(waiting.select(*DELIVERY.names, hour, F.lit(number).cast("long").alias("round")), f"{folder.root}/pending", "due", "round")
    folder.replace(f"_rounds/{number}.json", json.dumps({"open": max(at["hour"], state["open"] or at["hour"]), "acks": seen}))
    for name in folder.names("pending"):  # hours that the round before had done with
        if name.startswith("due=") and state["open"] is not None and int(name[4:]) < state["open"]:
            folder.remove(f"pending/{name}")


_DUE = 3600
_PENDING = T.StructType([*DELIVERY, T.StructField("due", T.LongType()), T.StructField("round", T.LongType())])
_MARK = T.StructType([*[T.StructField(k, ACK[k].dataType) for k in MESSAGE_KEY], T.StructField("part", T.LongType()), T.StructField("round", T.LongType())])
_LEDGER = T.StructType([*ACK, *BATCH_KEY])


def due_folders(folder: Folder, open_hour: int | None, known: int | None, hour: int, number: int) -> list[str]:
    """The folders of open deliveries whose hour has come.  Of the hour up to which the last round came, only what that
    round put back or later ones added is left."""
    found = []
    for name in folder.names("pending"):
        if not name.startswith("due=") or not (open_hour is None or open_hour <= int(name[4:])) or int(name[4:]) > hour:
            continue
        for part in folder.names(f"pending/{name}"):
            at = int(part.removeprefix("round="))
            if at < number and (int(name[4:]) != open_hour or at >= known):
                found.append(f"{name}/{part}")
    return found


def _mark_new(spark: SparkSession, folder: Folder, ledger: str, seen: dict, number: int) -> dict:
    """Put the acknowledgements of new ledger batches beside the open deliveries, by 2**20 numbers; what is seen then."""
    table, now_seen, new = Folder(spark, ledger), dict(seen), []
    for writer in table.names(""):
        for name in table.names(writer) if writer.startswith("writer=") else []:
            if name.startswith("batch=") and int(name[6:]) > seen.get(writer, -1):
                new.append(f"{writer}/{name}")
                now_seen[writer] = max(now_seen.get(writer, -1), int(name[6:]))
    if new:
        acks = read_batches(spark, ledger, _LEDGER, only=new).select(*MESSAGE_KEY)
        part = F.floor(F.col("seq") / SEQ_BUCKET).alias("part")
        store(acks.select("*", part, F.lit(number).cast("long").alias("round")), f"{folder.root}/marks", "part", "round")
    return now_seen


def _marks_of(spark: SparkSession, folder: Folder, rows: DataFrame) -> DataFrame:
    """The acknowledgements that may be of some deliveries; whole when those are of very many parts."""
    parts = small_rows(rows.select(F.floor(F.col("seq") / SEQ_BUCKET).alias("part")).distinct(), 1000)
    there = set(folder.names("marks"))
    only = "" if parts is None else [name for r in parts if (name := f"part={r['part']}") in there]
    return read_batches(spark, f"{folder.root}/marks", _MARK, only)


def start_redelivery(
    spark: SparkSession,
    deliveries: str,
    ledger: str,
    ack_wait: Column,
    checkpoint: str,
    interval: str = "5 seconds",
    now: Callable[[int], Column] | None = None,
) -> StreamingQuery:
    """Run a round per ``interval``; batch n of the clock is round n + 1.  ``now`` gives a round's time."""
    at = now or (lambda _: F.localtimestamp())

    def one_round(_: DataFrame, number: int) -> None:
        redeliver_round(spark, deliveries, ledger, ack_wait, at(number + 1), number + 1)

    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    ticking = clock.writeStream.foreachBatch(one_round).option("checkpointLocation", checkpoint)
    return ticking.trigger(processingTime=interval).start()


_OUT = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("consumer", T.StringType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("due_ms", T.LongType()),
    ]
)


# State is kept by so many numbers of a consumer's stream: one row, one timer and one Python call for all of them.
_TIMED = 1024
_UNNUMBERED = -(1 << 62)
_MESSAGE = [("seq", "<i8"), ("attempt", "<i4"), ("due", "<i8"), ("acked", "?"), ("seen", "<i8")]


class _Redeliver(StatefulProcessor):
    """State per bucket of numbers: (seq, attempt, due, acked, seen) of its messages, by number, and the one timer that is
    set, at the earliest due.  Every call is one state round trip, so the state is read once and written once per visit."""

    def __init__(self, wait_ms: int, acked_ttl_ms: int, event_time: bool):
        self.wait_ms = wait_ms
        self.acked_ttl_ms = acked_ttl_ms
        self.event_time = event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # TTL runs on the wall clock; an event-time run keeps its marks.
        self.ttl = None if self.event_time else max(self.acked_ttl_ms, 2 * self.wait_ms)
        self.state = handle.getValueState("messages", "messages binary, timer bigint", self.ttl)

    def _read(self) -> tuple[np.ndarray, int]:
        held, timer = self.state.get() or (b"", 0)
        return np.frombuffer(held, dtype=_MESSAGE).copy(), timer

    def _write(self, held: np.ndarray, timer: int, now: int) -> None:
        if self.ttl is not None:  # nothing waits for these, and they are not new
            held = held[(held["due"] > 0) | (held["seen"] + self.ttl >= now)]
        waiting = held["due"][held["due"] > 0]
        earliest = int(waiting.min()) if len(waiting) else 0
        if earliest != timer:
            if timer:
                self.handle.deleteTimer(timer)
            if earliest:
                self.handle.registerTimer(earliest)
        self.state.update((held.tobytes(), earliest))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        held, timer = self._read()
        new = pd.concat(list(rows))
        # the messages without a number have a bucket of their own
        new["seq"] = new["seq"].fillna(0).astype("int64")
        seqs = np.union1d(held["seq"], new["seq"].to_numpy())
        kept = np.zeros(len(seqs), dtype=_MESSAGE)
        kept["seq"] = seqs
        kept[np.searchsorted(seqs, held["seq"])] = held
        marked = new["acked"].to_numpy(dtype=bool)
        kept["acked"][np.searchsorted(seqs, new["seq"].to_numpy()[marked])] = True
        sent = new[~marked].groupby("seq").agg(attempt=("attempt", "max"), at_ms=("at_ms", "max"))
        at = np.searchsorted(seqs, sent.index.to_numpy(dtype="int64"))
        newer = sent["attempt"].to_numpy(dtype="int32") >= kept["attempt"][at]
        sent, at = sent[newer], at[newer]
        kept["attempt"][at] = sent["attempt"]
        start = sent["at_ms"] if self.event_time else pd.Series(now, index=sent.index)
        # a delivery without a time falls due at none
        kept["due"][at] = (start + self.wait_ms).fillna(0).astype("int64")
        kept["due"][kept["acked"]] = 0
        kept["seen"][np.searchsorted(seqs, new["seq"].unique())] = now
        self._write(kept, timer, now)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, timer = self._read()
        now = timerValues.getCurrentWatermarkInMs() if self.event_time else timerValues.getCurrentProcessingTimeInMs()
        passed = max(now - 1, expiredTimerInfo.getExpiryTimeInMs())
        late = (held["due"] > 0) & (held["due"] <= passed)
        if not late.any():
            return
        consumer, stream, part = key
        again = held[late]
        out = pd.DataFrame({"stream": stream, "seq": again["seq"], "consumer": consumer, "attempt": again["attempt"] + 1, "due_ms": again["due"]})
        if part == _UNNUMBERED:
            out["seq"] = pd.array([None] * len(out), dtype="Int64")
        held["attempt"][late] += 1
        held["due"][late] = now + self.wait_ms
        held["seen"][late] = timerValues.getCurrentProcessingTimeInMs()
        # the timer that went off is removed by Spark
        self._write(held, 0, timerValues.getCurrentProcessingTimeInMs())
        yield out

    def close(self) -> None:
        pass


def redeliver_on_timers(
    deliveries: DataFrame,
    acks: DataFrame,
    ack_wait_ms: int,
    time_mode: str = "ProcessingTime",
    lateness: str = "0 seconds",
    acked_ttl_ms: int = 24 * 3600 * 1000,
) -> DataFrame:
    """Streaming DELIVERY and ACK to deliveries that are due again, with their attempt.

    An acknowledgement ends a message whichever of the two arrives first.
    """
    sent = deliveries.select(*MESSAGE_KEY, "attempt", _zoned("delivered_at").alias("at"), F.lit(False).alias("acked"))
    done = acks.select(*MESSAGE_KEY, F.lit(0).alias("attempt"), _zoned("acked_at").alias("at"), F.lit(True).alias("acked"))
    both = sent.unionByName(done)
    event_time = time_mode == "EventTime"
    if event_time:
        both = both.withWatermark("at", lateness)
    timed = both.withColumns({"at_ms": F.unix_millis("at"), "part": F.coalesce(F.floor(F.col("seq") / _TIMED), F.lit(_UNNUMBERED))})
    return timed.groupBy("consumer", "stream", "part").transformWithStateInPandas(
        _Redeliver(ack_wait_ms, acked_ttl_ms, event_time), _OUT, "Append", time_mode
    )
