"""Counts over what was published and received."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOTAL = "TOTAL"


def per_subject(messages: DataFrame, subject: str = "subject") -> DataFrame:
    return messages.groupBy(subject).agg(F.count("*").alias("n"))


def received_report(messages: DataFrame, subject: str = "subject") -> DataFrame:
    """Count per subject plus a total row, listed without regard to case, total last."""
    counts = per_subject(messages, subject)
    # Rolled up from the counts: a rollup of the messages would read each of them twice.
    rolled = counts.rollup(subject).agg(F.sum("n").alias("n"), F.grouping(subject).alias("__total"))
    named = rolled.withColumn(subject, F.when(F.col("__total") == 1, F.lit(TOTAL)).otherwise(F.col(subject)))
    return named.orderBy("__total", F.lower(subject), subject).drop("__total")


def word_count(lines: DataFrame, text: Column, separator: str = r"[^a-z]+") -> DataFrame:
    # The outer form: for the inner one Spark infers a filter that would split a second time.
    words = lines.select(F.explode_outer(F.split(F.lower(text), separator)).alias("word"))
    return words.where(F.col("word") != "").groupBy("word").agg(F.count("*").alias("count"))


def reconcile(expected: DataFrame, received: DataFrame, key: str = "subject") -> DataFrame:
    """Keys whose received count is not the expected count."""
    e = expected.groupBy(key).agg(F.count("*").alias("expected"))
    r = received.groupBy(key).agg(F.count("*").alias("received"))
    return e.join(r, key, "full_outer").where(~F.col("expected").eqNullSafe(F.col("received")))
