"""Reading a log through subscriptions: where each split starts, and where it stops."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..schema import CUMULATIVE, EXPLICIT
from ..scratch import materialise, scratch_path
from .acks import ack_floor
from .attach import small_rows
from .bound import first_n
from .match import match
from .ranges import read_ranges
from .subscriptions import dedup, unpacked


_RESUMED = "coalesce(last_emitted_seq > 0, false)"
_CUMULATIVE = "ack_behavior IN ({})".format(", ".join(f"'{b}'" for b in CUMULATIVE))
_FROM_SEQ = f"""CASE WHEN durable_name IS NOT NULL THEN CASE WHEN {_CUMULATIVE} THEN floor + 1 END
  WHEN {_RESUMED} THEN last_emitted_seq + 1 WHEN start_sequence > 0 THEN start_sequence END"""


# Bounds count numbered messages only.
WITHIN_BOUND = "remaining IS NULL OR (remaining > 0 AND seq IS NOT NULL)"


def positioned(subs: DataFrame, progress: DataFrame | None = None, acks: DataFrame | None = None) -> DataFrame:
    """Subscriptions with ``from_seq``, ``from_time``, ``remaining``; finished splits left out.

    A saved position beats the start options.  A durable consumer starts after what it has
    acknowledged cumulatively and ignores both.
    """
    subs = dedup(subs)
    absent = {"last_emitted_seq": "CAST(NULL AS BIGINT)", "messages": "0L", "floor": "CAST(NULL AS BIGINT)"}
    if progress is not None:
        known = progress.select("split_id", "last_emitted_seq", "messages", "finished")
        subs = subs.join(known, "split_id", "left").where("NOT coalesce(finished, false)").drop("finished")
    if acks is not None:
        floors = ack_floor(acks).withColumnRenamed("consumer", "durable_name")
        subs = subs.join(floors, ["durable_name", "stream"], "left")
    subs = subs.selectExpr("*", *[f"{value} AS {n}" for n, value in absent.items() if n not in subs.columns])
    return subs.selectExpr(
        "split_id",
        "stream",
        "subject",
        "durable_name",
        "ack_behavior",
        f"coalesce({_FROM_SEQ}, 1L) AS from_seq",
        f"CASE WHEN durable_name IS NULL AND NOT {_RESUMED} THEN start_time END AS from_time",
        "CASE WHEN max_messages_to_read > 0 THEN greatest(max_messages_to_read - coalesce(messages, 0L), 0L) END AS remaining",
    )


def settled(
    positions: DataFrame, limit: int | None = None, path: str | None = None
) -> tuple[DataFrame, list[Row] | None]:
    """Positions and their rows; too many for a local table are written once, as they are read in several places."""
    rows = small_rows(positions, limit)
    if rows is not None:
        return positions, rows
    return materialise(positions, path or scratch_path(positions.sparkSession, "positions"), lean=True), None


def select_splits(
    messages: DataFrame, positions: DataFrame, limit: int | None = None, rows: list[Row] | None = None
) -> DataFrame:
    """Messages at or after each matching split's position; works on streams as well."""
    hits = match(messages, positions, limit, rows)
    # a message without a number has no place to compare: it comes if the split starts at the first
    placed = F.when(F.col("seq").isNull(), F.col("from_seq") <= 1).otherwise(F.col("seq") >= F.col("from_seq"))
    return hits.where(placed & (F.col("from_time").isNull() | (F.col("ts") >= F.col("from_time"))))


def subscribe(
    messages: DataFrame,
    subs: DataFrame,
    progress: DataFrame | None = None,
    acks: DataFrame | None = None,
    limit: int | None = None,
    scratch: str | None = None,
) -> DataFrame:
    """MESSAGE rows plus ``split_id``, one per matching split.

    ``progress`` resumes, ``acks`` positions durable consumers, bounds apply in sequence
    order.  A stream shorter than its bound simply ends.

    With many subscriptions intermediates are written, below ``scratch`` if given: who has read the rows may discard it.
    """
    scratch = scratch or scratch_path(messages.sparkSession, "subscribed")
    positions, rows = settled(positioned(subs, progress, acks), limit, f"{scratch}/positions")
    if rows is None:
        return _subscribe_many(messages, positions, acks, limit, f"{scratch}/taken")
    hits = select_splits(messages, positions, limit, rows)
    if acks is not None and any(explicit_rows(r) for r in rows):
        hits = without_acked(hits, acks)
    if any(r["remaining"] is not None for r in rows):
        hits = first_n(hits.where(WITHIN_BOUND), "remaining")
    return hits.select(*messages.columns, "split_id")


def ranged(with_acks: bool) -> str:
    """Which positions end by their bound alone, so that ranks say what they read."""
    explicit = ", ".join(f"'{b}'" for b in EXPLICIT)
    counts = f"AND NOT (durable_name IS NOT NULL AND ack_behavior IN ({explicit}))" if with_acks else ""
    return f"(remaining IS NOT NULL AND from_time IS NULL {counts})"


def _subscribe_many(
    messages: DataFrame, positions: DataFrame, acks: DataFrame | None, limit: int | None, path: str
) -> DataFrame:
    """Too many subscriptions for a local table.  Bounded ones are joined by rank, the others meet all they match."""
    by_rank = ranged(acks is not None)
    hits = select_splits(messages, positions.where(f"NOT {by_rank}"), limit)
    if acks is not None:
        hits = without_acked(hits, acks)
    hits = first_n(hits.where(WITHIN_BOUND), "remaining").select(*messages.columns, "split_id")
    taken = read_ranges(messages, positions.where(by_rank), limit, path)
    return hits.unionByName(taken.select(*messages.columns, unpacked()))


def explicit_rows(row: Row) -> bool:
    """Whether a subscription acknowledges its messages one by one."""
    return row["durable_name"] is not None and row["ack_behavior"] in EXPLICIT


def without_acked(hits: DataFrame, acks: DataFrame) -> DataFrame:
    """Explicit durable consumers do not see again what they acknowledged.  Acknowledgements are never broadcast: there are
    about as many as messages."""
    acked = acks.select(F.col("consumer").alias("__consumer"), "stream", "seq")
    explicit = F.col("durable_name").isNotNull() & F.col("ack_behavior").isin(EXPLICIT)
    who = F.when(explicit, F.col("durable_name"))
    return hits.withColumn("__consumer", who).join(acked.hint("merge"), ["stream", "seq", "__consumer"], "left_anti").drop("__consumer")
