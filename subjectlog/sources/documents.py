"""Subscriptions and sink subjects kept as JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import utc
from ..operators.subscriptions import coerce, split_subjects, subscription_json, with_split_id
from ..schema import SUBSCRIPTION

# Member names of a subscription document.
_STRINGS = {
    "stream_name": "stream",
    "subject": "subject",
    "consumer_name_prefix": "consumer_name_prefix",
    "durable_name": "durable_name",
    "ack_behavior": "ack_behavior",
}
_LONGS = ["start_sequence", "max_messages_to_read", "ack_wait", "inactive_threshold"]
_INTS = ["batch_size", "threshold_percent"]


# The list's name, unless the caller has another.
LIST = "subscriptions"

# All members of an entry in one step, each with its JSON type.
_ENTRIES = "array<struct<{}>>".format(", ".join(f"{name}: variant" for name in [*_STRINGS, *_LONGS, *_INTS, "start_time"]))


def _text(member: Column) -> Column:
    return F.when(F.schema_of_variant(member) == "STRING", F.try_variant_get(member, "$", "string"))


def _number(member: Column, target: str) -> Column:
    """Any JSON number, cut to a whole one; a number in quotes does not count."""
    is_text = F.schema_of_variant(member).isin("STRING", "BOOLEAN")
    return F.when(~is_text, F.try_variant_get(member, "$", "double").cast(target))


def parse_subscriptions(documents: DataFrame, text: str = "value", member: str = LIST) -> DataFrame:
    """One SUBSCRIPTION row per entry of the list ``member``, coerced and identified; other columns are kept.

    Unknown members are ignored; malformed JSON and malformed times fail the job.
    """
    rest = [c for c in documents.columns if c != text]
    # The outer form: for the inner one Spark infers a filter that would parse a second time.
    entries = documents.select(*rest, F.explode_outer(F.try_variant_get(F.parse_json(text), f"$['{member}']", _ENTRIES)).alias("__node"))
    node = F.col("__node")
    entries = entries.where(node.isNotNull())
    columns = {target: _text(node[name]) for name, target in _STRINGS.items()}
    columns |= {name: _number(node[name], "bigint") for name in _LONGS}
    columns |= {name: _number(node[name], "int") for name in _INTS}
    columns["start_time"] = utc(_text(node["start_time"]).cast("timestamp"))
    columns["split_id"] = F.lit(None).cast("string")
    read = entries.select(*rest, *[columns[name].alias(name) for name in SUBSCRIPTION.names])
    return with_split_id(coerce(read))


def load_subscriptions(spark: SparkSession, path: str, member: str = LIST) -> DataFrame:
    """Subscriptions of one document or of a folder of them, one document per file."""
    return parse_subscriptions(spark.read.text(path, wholetext=True), member=member).select(*SUBSCRIPTION.names)


def source_documents(subs: DataFrame, *source: str, converter: str = "utf8", member: str = LIST) -> DataFrame:
    """(``source`` columns, value): the document of each source, its subscriptions in the order of their ids.

    ``parse_subscriptions`` reads them back.
    """
    entry = F.struct("split_id", subscription_json().alias("json"))
    listed = F.concat_ws(",", F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["json"]))
    head = F.to_json(F.struct(F.lit(converter).alias("converter")))
    opened = F.concat(F.regexp_replace(head, r"\}$", ""), F.lit(f',"{member}":['))
    return subs.groupBy(*source).agg(F.concat(opened, listed, F.lit("]}")).alias("value"))


def parse_targets(documents: DataFrame, text: str = "value") -> DataFrame:
    """One row per subject of a live source or sink document.

    ``subjects`` is a list whose empty entries do not count; without one ``subject`` is a
    comma-separated text, taken as it is.
    """
    rest = [c for c in documents.columns if c != text]
    node = F.col("__node")
    listed = F.filter(
        F.transform(
            F.try_variant_get(node, "$.subjects", "array<variant>"),
            lambda v: F.when(F.schema_of_variant(v) == "STRING", v.cast("string")),
        ),
        lambda s: F.length(s) > 0,
    )
    # The text form applies when the list is absent or empty, before its entries are looked at.
    has_list = F.coalesce(F.size(F.try_variant_get(node, "$.subjects", "array<variant>")) > 0, F.lit(False))
    single = split_subjects(_text(F.try_variant_get(node, "$.subject", "variant")))
    subjects = F.when(has_list, listed).otherwise(single)
    return documents.select(*rest, F.parse_json(text).alias("__node")).select(
        *rest, F.explode_outer(subjects).alias("subject")
    ).where(F.col("subject").isNotNull())


def load_targets(spark: SparkSession, path: str) -> DataFrame:
    return parse_targets(spark.read.text(path, wholetext=True)).select("subject")
