"""The physical plans over a stored log: what must be pushed, pruned and kept off the network."""

import pytest
from helpers import log_of, message
from pyspark.sql import functions as F

from subjectlog.operators.progress import split_progress
from subjectlog.operators.subscribe import subscribe
from subjectlog.operators.subscriptions import subscriptions
from subjectlog.scratch import scratch_path
from subjectlog.sources.log import read_log, write_log


@pytest.fixture(scope="module")
def log(spark):
    path = scratch_path(spark, "plans")
    rows = [message(s, f"{s}.{k}.{n % 4}", n) for s in ("x", "y") for n in range(1, 200) for k in ("p", "q")]
    write_log(log_of(spark, rows), path)
    return read_log(spark, path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_subscription_reaches_the_scan(spark, log):
    subs = subscriptions(spark, [{"stream": "x", "subject": "x.p.*", "start_sequence": 50}])
    text = plan(subscribe(log, subs).select("seq"))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(stream" in scan and "= x)" in scan
    assert "StringStartsWith(subject,x.p.)" in scan and "GreaterThanOrEqual(seq,50)" in scan
    assert "data:binary" not in scan and "headers" not in scan.split("ReadSchema")[1]
    assert "Exchange hashpartitioning" not in text


def test_literal_subject_reaches_the_scan(spark, log):
    text = plan(subscribe(log, subscriptions(spark, [{"stream": "x", "subject": "x.p.1"}])))
    assert "EqualTo(subject,x.p.1)" in text and "Exchange hashpartitioning" not in text


@pytest.mark.parametrize("bound", [10, 5000])
def test_bound_moves_no_payload(spark, log, bound):
    subs = subscriptions(spark, [{"stream": s, "subject": f"{s}.>", "max_messages_to_read": bound} for s in "xy"])
    text = plan(subscribe(log, subs))
    assert "Exchange hashpartitioning" not in text and "Window" not in text
    assert subscribe(log, subs).count() == min(796, 2 * bound)


@pytest.mark.parametrize("n", [65, 10_001])
def test_starts_reach_the_scan_at_any_number(spark, log, n):
    """Above 64 subscriptions, and above what a local table may have."""
    from datetime import datetime

    from subjectlog.operators.match import match
    from subjectlog.operators.subscriptions import coerce, with_split_id
    from subjectlog.operators.subscribe import positioned, select_splits
    from subjectlog.schema import SUBSCRIPTION

    given = {"stream": F.lit("x"), "subject": F.concat(F.lit("x.p."), F.col("id").cast("string")), "start_sequence": F.lit(150)}
    columns = [given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in SUBSCRIPTION]
    by_number = positioned(with_split_id(coerce(spark.range(n).select(*columns))))
    hits = select_splits(log, by_number)
    scan = next(line for line in plan(hits).splitlines() if "FileScan" in line and "/plans-" in line)
    assert "= x" in scan and "GreaterThanOrEqual(seq,150)" in scan
    assert ("In(subject" if n == 65 else "StringStartsWith(subject,x.p.)") in scan
    assert pairs_of(hits) == [(s,) for s in range(150, 200)]
    given = {**given, "start_sequence": F.lit(None), "start_time": F.lit(datetime(2024, 1, 1, 0, 3))}
    columns = [given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in SUBSCRIPTION]
    hits = select_splits(log, positioned(with_split_id(coerce(spark.range(n).select(*columns)))))
    assert "GreaterThanOrEqual(ts,2024-01-01" in plan(hits) and match is not None
    assert pairs_of(hits) == [(s,) for s in range(180, 200)]


def test_merged_patterns():
    from subjectlog.operators.match import merged

    assert merged(["a.b", "a.b", "a.*.c", "b.>"]) == ([], ["a.", "b."])
    assert merged(["a.b.1", "a.c.>", "d"]) == (["a.b.1", "d"], ["a.c."])
    assert merged([f"a.b{i % 3}.{i}.*" for i in range(500)]) == ([], ["a.b0.", "a.b1.", "a.b2."])
    assert merged([f"a{i}.>" for i in range(65)]) is None and merged(["a.b", ">"]) is None and merged(["*.b"]) is None
    assert merged([f"s.{i}" for i in range(1025)]) == ([], ["s."])


def pairs_of(df):
    return sorted(set(map(tuple, df.select("seq").collect())))


def test_progress_reads_three_columns_and_combines_first(spark, log):
    subs = subscriptions(spark, [{"stream": "x", "subject": "x.>"}])
    text = plan(split_progress(subscribe(log, subs)))
    assert "data:binary" not in text
    assert text.count("Aggregate") >= 2 and "partial_max" in text


def test_no_python_in_the_hot_path(spark, log):
    from subjectlog.sinks.fan_out import relay

    subs = subscriptions(spark, [{"stream": "x", "subject": "x.>"}])
    text = plan(relay(subscribe(log, subs), ["a", "b"]).groupBy("subject").agg(F.count("*")))
    assert "Python" not in text and "Pandas" not in text
