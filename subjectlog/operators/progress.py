"""How far each split got."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .subscriptions import subscription_json


def split_progress(emitted: DataFrame, key: str = "split_id", bound: str | None = None) -> DataFrame:
    """Last sequence number, its reply-to, message count and whether the bound is reached.

    Splits that emitted nothing have no row.
    """
    measures = [
        F.max("seq").alias("last_emitted_seq"),
        F.max_by("reply_to", "seq").alias("last_reply_to"),
        F.count("*").alias("messages"),
    ]
    if bound is None:
        return emitted.groupBy(key).agg(*measures).withColumn("finished", F.lit(False))
    rows = emitted.groupBy(key).agg(*measures, F.first(bound).alias("__bound"))
    return rows.withColumn("finished", _reached(F.col("messages"), F.col("__bound"))).drop("__bound")


def _reached(messages: Column, bound: Column) -> Column:
    return F.coalesce((bound > 0) & (messages >= bound), F.lit(False))


def merge_progress(parts: DataFrame, subs: DataFrame | None = None) -> DataFrame:
    """One row per split from the progress of several rounds; counts add up."""
    merged = parts.groupBy("split_id").agg(
        F.max("last_emitted_seq").alias("last_emitted_seq"),
        F.max_by("last_reply_to", "last_emitted_seq").alias("last_reply_to"),
        F.sum("messages").alias("messages"),
        F.bool_or("finished").alias("finished"),
    )
    if subs is None:
        return merged
    bounds = subs.select("split_id", F.col("max_messages_to_read").alias("__bound"))
    finished = F.col("finished") | _reached(F.col("messages"), F.col("__bound"))
    return merged.join(bounds, "split_id", "left").withColumn("finished", finished).drop("__bound")


def progress_json(subscription: Column | None = None) -> Column:
    """A progress row as JSON: unset positions and a false ``finished`` are left out.

    ``subscription`` is a JSON column, nested as ``subject_config``.
    """
    fields = [
        F.when(F.col("last_emitted_seq") >= 0, F.col("last_emitted_seq")).alias("last_emitted_seq"),
        F.when(F.col("last_reply_to") != "", F.col("last_reply_to")).alias("last_reply_to"),
        F.when(F.col("messages") >= 0, F.col("messages")).alias("messages"),
        F.when(F.col("finished"), F.col("finished")).alias("finished"),
    ]
    if subscription is not None:
        fields.append(F.parse_json(subscription).alias("subject_config"))
    return F.to_json(F.struct(*fields))


def split_json(splits: DataFrame, name: str = "json") -> DataFrame:
    """SUBSCRIPTION + PROGRESS columns to one JSON document per split."""
    return splits.withColumn(name, progress_json(subscription_json()))
