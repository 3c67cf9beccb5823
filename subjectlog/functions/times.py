"""Time arithmetic on local (zone-less, UTC) timestamps that no session zone can change."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000
NANOS = 1_000_000_000


def local_time(at: datetime) -> Column:
    """A literal without a zone; a datetime literal would pass through the session's."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def epoch_seconds(ts: Column) -> Column:
    clock = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return F.unix_date(F.to_date(ts)) * F.lit(86_400).cast("long") + clock


def epoch_micros(ts: Column) -> Column:
    fraction = F.date_part(F.lit("SECOND"), ts) * MICROS
    return (epoch_seconds(ts) - F.second(ts)) * MICROS + fraction.cast("long")


def nanos_interval(n: Column) -> Column:
    """A nanosecond count as a day-time interval, to the microsecond."""
    seconds = n.cast("decimal(20,0)") / F.lit(NANOS).cast("decimal(10,0)")
    return F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def utc(instant: Column) -> Column:
    """A zoned timestamp as local time in UTC."""
    seconds = F.unix_micros(instant).cast("decimal(20,0)") / F.lit(MICROS).cast("decimal(10,0)")
    return local_time(datetime(1970, 1, 1)) + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
