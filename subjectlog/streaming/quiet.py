"""Stopping a streaming query when nothing more comes."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql.streaming import StreamingQuery


def run_until_quiet(
    query: StreamingQuery,
    quiet_seconds: float,
    expected: int | None = None,
    received: Callable[[], int] | None = None,
    poll_seconds: float = 0.5,
) -> int:
    """Stop ``query`` after ``quiet_seconds`` without input or once ``expected`` rows arrived.

    Rows are counted from the query's progress, or by ``received``.  Returns the count.
    """
    counted: dict[int, int] = {}
    last_change, total = time.monotonic(), 0
    while query.isActive:
        for report in query.recentProgress:
            counted[report["batchId"]] = max(report["numInputRows"], counted.get(report["batchId"], 0))
        now_total = received() if received else sum(counted.values())
        # a batch reports its rows when it ends: while one is at work there is no silence
        if now_total != total or query.status["isTriggerActive"] and query.status["isDataAvailable"]:
            last_change, total = time.monotonic(), now_total
        if (expected is not None and total >= expected) or time.monotonic() - last_change >= quiet_seconds:
            query.stop()
            break
        time.sleep(poll_seconds)
    return total
