import random

import pytest
from helpers import T0, log_of, message, pairs
from pyspark.sql import functions as F

from subjectlog.operators import gaps
from subjectlog.operators.balance import balance
from subjectlog.operators.sequence import in_order, with_sequence


@pytest.mark.parametrize("base", [0, 41])
def test_sequence_is_gapless_in_order(spark, base):
    values = random.Random(1).sample(range(10_000), 700)
    df = spark.createDataFrame([(v // 100, v) for v in values], "a long, b long").repartition(5)
    got = with_sequence(df, ["a", "b"], "n", base, partitions=6).orderBy("n").collect()
    assert [(r.n, r.b) for r in got] == list(zip(range(base + 1, base + 701), sorted(values)))


def test_sequence_of_nothing(spark):
    assert with_sequence(spark.range(0), ["id"]).count() == 0


@pytest.mark.parametrize("readers,splits", [(5, 3), (3, 5), (3, 3), (89, 9), (5, 100), (3, 8), (1, 4), (4, 0)])
def test_balance(spark, readers, splits):
    got = balance(spark.range(splits), ["id"], readers).orderBy("id").collect()
    base, extra = divmod(splits, readers)
    want = [r for r in range(readers) for _ in range(base + (r < extra))]
    assert [r.reader for r in got] == want


def test_order_across_partitions(spark):
    rows = [("hot" if i % 3 else f"k{i % 7}", i) for i in range(900)]
    random.Random(2).shuffle(rows)
    df = in_order(spark.createDataFrame(rows, "split_id string, seq long").repartition(7), ["split_id"])
    got = [(r.split_id, r.seq) for r in df.withColumn("p", F.monotonically_increasing_id()).orderBy("p").collect()]
    assert got == sorted(rows)


@pytest.mark.parametrize("bucket", [3, 10, 1 << 20])
def test_gaps_against_brute_force(spark, monkeypatch, bucket):
    monkeypatch.setattr(gaps, "SEQ_BUCKET", bucket)
    rnd = random.Random(3)
    rows, clock = [], 0
    for seq in sorted(rnd.sample(range(1, 400), 150)):
        clock += rnd.choice([1, 1, 1, 5, 30])
        rows.append(message("s", rnd.choice(["a", "b", "c"]), seq, seconds=clock))
    log = log_of(spark, rows)
    want, last, stopped, read = [], {}, set(), []
    for _, subject, seq, ts, *_ in rows:
        if subject in last and (ts - last[subject]).total_seconds() >= 30:
            want.append((subject, seq, int((ts - last[subject]).total_seconds() * 1_000_000)))
            stopped.add(subject)
        if subject not in stopped:
            read.append((subject, seq))
        last[subject] = ts
    assert pairs(gaps.quiet_gaps(log, 30_000_000, ["subject"]), "subject", "seq", "gap_micros") == sorted(want)
    assert pairs(gaps.before_first_gap(log, 30_000_000, ["subject"]), "subject", "seq") == sorted(read)
    assert T0.year == 2024


def test_gap_length_does_not_depend_on_the_session_zone(spark):
    rows = [message("s", "a", 1, seconds=0), message("s", "a", 2, seconds=70 * 24 * 3600)]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert gaps.quiet_gaps(log_of(spark, rows), 1).head().gap_micros == 70 * 24 * 3600 * 1_000_000
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
