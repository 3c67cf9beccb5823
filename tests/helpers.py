"""Small hand-made logs."""

from datetime import datetime, timedelta

from subjectlog.schema import MESSAGE

T0 = datetime(2024, 1, 1)


def message(stream, subject, seq, data=b"x", headers=None, reply_to=None, seconds=None):
    ts = T0 + timedelta(seconds=seq if seconds is None else seconds)
    return (stream, subject, seq, ts, headers, reply_to or f"$ACK.{stream}.{seq}", data)


def log_of(spark, rows):
    return spark.createDataFrame(rows, MESSAGE)


def sample(spark, n=60):
    """Stream s with subjects a.x, a.y, b.x in turn."""
    subjects = ["a.x", "a.y", "b.x"]
    return log_of(spark, [message("s", subjects[i % 3], i + 1) for i in range(n)])


def pairs(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())
