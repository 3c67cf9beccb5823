"""Many bounded subscriptions: a range join by rank.

Subscriptions share patterns.  Messages are ranked once per pattern, by (pattern, 2**20 numbers); a subscription that reads n
messages from its start wants the ranks r, r + 1, ... r + n - 1 of its pattern.  Ranges meet ranks in bins of about
their own length, so a message meets the subscriptions that take it and few others, however many there are.  Ids of
subscriptions, most of what is moved, go through the joins packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import SEQ_BUCKET
from ..scratch import materialise, scratch_path
from .attach import attach
from .match import match
from .subscriptions import packed, unpacked

_PATTERN = ["stream", "pattern"]


def take_ranges(messages: DataFrame, positions: DataFrame, limit: int | None = None) -> DataFrame:
    """(split_id, stream, seq) of the first ``remaining`` messages at or after ``from_seq`` of each split.

    ``positions`` have split_id, stream, subject (a pattern), from_seq and remaining, which is not null; starts in
    time are not looked at.  Messages without a number do not count.
    """
    return _taken(messages, positions, limit).select(unpacked(), "stream", "seq")


def read_ranges(
    messages: DataFrame, positions: DataFrame, limit: int | None = None, path: str | None = None
) -> DataFrame:
    """The ``messages`` that ``take_ranges`` names, once per split, whose ``split_id`` is still packed.

    What is named is written, to ``path`` if given: the ranks and their joins are gone before messages are moved.
    """
    taken = materialise(_taken(messages, positions, limit), path or scratch_path(messages.sparkSession, "taken"), lean=True)
    return messages.join(taken.hint("merge"), ["stream", "seq"]).select(*messages.columns, "split_id")


def _taken(messages: DataFrame, positions: DataFrame, limit: int | None) -> DataFrame:
    wanted = positions.where("remaining > 0").select(packed(), "stream", F.col("subject").alias("pattern"), "from_seq", "remaining")
    patterns = wanted.select("stream", F.col("pattern").alias("subject")).distinct()
    numbered = messages.where("seq IS NOT NULL").select("stream", "subject", "seq")
    hits = match(numbered, patterns, limit).select(*_PATTERN, "seq", F.lit(1).alias("is_message"))
    starts = wanted.select(*_PATTERN, F.col("from_seq").alias("seq"), F.lit(0).alias("is_message"))
    bucket = F.floor(F.col("seq") / SEQ_BUCKET)
    rows = hits.unionByName(starts.distinct()).withColumn("bucket", bucket)
    # a start stands before the message of its number
    upto = Window.partitionBy(*_PATTERN, "bucket").orderBy("seq", "is_message").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # all starts, as they are few buckets wherever they are; the different ones would be dealt once more
    every = hits.unionByName(starts).withColumn("bucket", bucket)
    sizes = every.groupBy(*_PATTERN, "bucket").agg(F.sum("is_message").alias("size"))
    across = Window.partitionBy(*_PATTERN).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(*_PATTERN, "bucket", F.coalesce(F.sum("size").over(across), F.lit(0)).alias("before"))
    # dealt by its keys already; to see whether the other side is small would match all messages once more
    ranked = rows.withColumn("rank", F.sum("is_message").over(upto)).join(before.hint("merge"), [*_PATTERN, "bucket"])
    ranked = ranked.select(*_PATTERN, "seq", "is_message", (F.col("rank") + F.col("before")).alias("rank"))

    level = F.ceil(F.log2(F.col("remaining").cast("double"))).cast("int").alias("level")
    begins = ranked.where("is_message = 0").select(*_PATTERN, F.col("seq").alias("from_seq"), (F.col("rank") + 1).alias("low"))
    spans = wanted.join(begins.hint("merge"), [*_PATTERN, "from_seq"]).select(
        "split_id", *_PATTERN, level, "low", (F.col("low") + F.col("remaining") - 1).alias("high")
    )
    bin_of = lambda rank: F.expr(f"shiftright({rank}, level)")
    binned = spans.select("*", F.explode(F.sequence(bin_of("low"), bin_of("high"))).alias("bin"))  # one or two
    levels = wanted.select(*_PATTERN, level).distinct()  # without the ranks, which would be made twice
    placed = attach(ranked.where("is_message = 1"), levels, _PATTERN, limit=limit).withColumn("bin", bin_of("rank"))
    met = placed.join(binned.hint("merge"), [*_PATTERN, "level", "bin"]).where("rank BETWEEN low AND high")
    return met.select("split_id", "stream", "seq")
