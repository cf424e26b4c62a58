"""Long runs at an interval, and what their batches did."""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

BATCHES = "batch long, rows long, started timestamp, ended timestamp"


def run_until_idle(query: StreamingQuery, idle: float, poll: float = 0.2) -> list[tuple]:
    """Let a query run until no batch had rows for ``idle`` seconds, then stop it between batches.

    Returns (batch, rows, start, end) of each batch with rows. Spark keeps the progress of the last
    hundred batches, so the poll must see them before.
    """
    batches: dict[int, tuple] = {}
    last, found_nothing = time.monotonic(), False
    with ThreadPoolExecutor(1) as pool:
        looked = pool.submit(query.processAllAvailable)
        while query.isActive:
            if looked.done():
                found_nothing, looked = True, pool.submit(query.processAllAvailable)
            for p in query.recentProgress:
                if p.numInputRows and p.batchId not in batches:
                    start = datetime.fromisoformat(p.timestamp.replace("Z", "+00:00"))
                    end = start + timedelta(milliseconds=p.durationMs["triggerExecution"])
                    batches[p.batchId] = (p.batchId, p.numInputRows, start, end)
                    last, found_nothing = time.monotonic(), False
            status = query.status
            found_nothing &= not status["isDataAvailable"]
            # A trigger is active while it looks for files, too: over many files that is nearly always so.
            if status["isTriggerActive"] and not found_nothing:
                last = max(last, time.monotonic() - idle / 2)
            if time.monotonic() - last >= idle:
                query.stop()
            query.awaitTermination(poll)
    query.awaitTermination()  # raises what the query has failed with
    return [batches[k] for k in sorted(batches)]


def batches_frame(spark: SparkSession, batches: list[tuple]) -> DataFrame:
    return spark.createDataFrame(batches, BATCHES)
