import pytest
from helpers import log_of, message, pairs, sample
from pyspark.sql import functions as F

from subjectlog.scratch import scratch_path
from subjectlog.sinks.fan_out import fan_out, relay
from subjectlog.sinks.publish import publish_core, publish_durable
from subjectlog.sources.lines import read_lines
from subjectlog.sources.log import base_sequence, last_sequence, read_log, write_log


def test_fan_out_keeps_order_per_subject(spark):
    path = scratch_path(spark, "t")
    log = log_of(spark, [message("s", "a", n, f"Message {n}".encode()) for n in (1, 2, 3)])
    publish_durable(relay(log, ["one", "two"]), path, "out", ["seq", "target"], F.col("ts"))
    got = read_log(spark, path).orderBy("seq").collect()
    assert [r.seq for r in got] == [1, 2, 3, 4, 5, 6]
    for subject in ("one", "two"):
        assert [bytes(r.data).decode() for r in got if r.subject == subject] == ["Message 1", "Message 2", "Message 3"]


def test_targets(spark):
    log = sample(spark, 3)
    with pytest.raises(ValueError, match="One or more subjects"):
        fan_out(log, [])
    lazy = fan_out(log, ["ok", "not.*"])  # nothing is checked until the job runs
    with pytest.raises(Exception, match="wildcard"):
        lazy.collect()


def test_publishing_again_replaces_the_batch(spark):
    path = scratch_path(spark, "t")
    log = sample(spark, 30)
    first, second = log.where("seq <= 12"), log.where("seq > 12")
    for batch, part in ((0, first), (1, second), (1, second)):
        publish_durable(part, path, "out", ["seq"], F.col("ts"), batch)
    assert pairs(read_log(spark, path), "seq") == [(n,) for n in range(1, 31)]
    assert last_sequence(spark, path, "out") == 30
    assert base_sequence(spark, path, "out", 1, "main") == 12 and base_sequence(spark, path, "out", 0, "other") == 30
    publish_durable(first, path, "out", ["seq"], F.col("ts"))  # no number: another batch
    publish_durable(first, path, "out", ["seq"], F.col("ts"), 0, "other")
    assert pairs(read_log(spark, path), "seq") == [(n,) for n in range(1, 55)]
    assert last_sequence(spark, path, "none") == 0
    assert last_sequence(spark, scratch_path(spark, "nowhere"), "out") == 0


def test_core_publish_and_headers(spark):
    path = scratch_path(spark, "t")
    rows = [message("s", "a", 1, None, headers={}), message("s", "a", 2, b"x", headers={"k": ["v"]})]
    publish_core(log_of(spark, rows), path, "out", F.col("ts"))
    publish_core(log_of(spark, rows), path, "more", F.col("ts"))
    assert read_log(spark, path).where("stream = 'more'").count() == 2
    got = {bytes(r.data): (r.seq, r.headers) for r in read_log(spark, path).where("stream = 'out'").collect()}
    assert got == {b"": (None, None), b"x": (None, {"k": ["v"]})}


def test_log_round_trip_and_lines(spark):
    path = scratch_path(spark, "t")
    log = sample(spark).unionByName(log_of(spark, [message("z", "q", 1, b"\x00\xff", {"h": ["1", "2"]})]))
    write_log(log, path)
    assert sorted(map(str, read_log(spark, path).collect())) == sorted(map(str, log.collect()))
    text = scratch_path(spark, "lines")
    spark.createDataFrame([("a",), ("b c",)], "value string").write.text(text)
    assert pairs(read_lines(spark, text), "value") == [("a",), ("b c",)]
