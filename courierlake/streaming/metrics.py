"""Received against landed, measured by the stream itself.

Counts are observed inside the streaming plan, before and after what may drop rows, and come with the
progress of each micro-batch.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from courierlake.streaming.topics import FLUSH_EVERY, _start

RECEIVED, LANDED = "received", "landed"
#: Seconds between two looks at the progress, of which Spark keeps the last hundred batches.
POLL = 1.0


def observed(df: DataFrame, name: str, by: str, values: Sequence[str]) -> DataFrame:
    """``df`` with a metric for each value of ``by``: how many rows have it."""
    return df.observe(name, *[F.count_if(F.col(by) == v).alias(v) for v in values])


def land_audited(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    topics: Sequence[str],
    keep: Column | None = None,
    drain: bool = True,
) -> StreamingQuery:
    """Land messages by topic, counting them as received and, those that ``keep`` lets pass, as landed."""
    received = observed(messages, RECEIVED, "topic", topics)
    passed = received if keep is None else received.where(F.coalesce(keep, F.lit(False)))
    landed = observed(passed, LANDED, "topic", topics)
    writer = landed.writeStream.format("parquet").partitionBy("topic").option("path", path)
    return _start(writer.option("checkpointLocation", checkpoint), drain, FLUSH_EVERY)


def observed_batches(query: StreamingQuery, poll: float = POLL) -> dict[int, dict[str, dict[str, int]]]:
    """``{batch: {metric: {value: rows}}}`` of a query that runs until it has drained its source.

    A batch that reports twice counts once.
    """
    batches: dict[int, dict[str, dict[str, int]]] = {}

    def look() -> None:
        for p in query.recentProgress:
            if p.observedMetrics:
                batches[p.batchId] = {n: row.asDict() for n, row in p.observedMetrics.items()}

    while query.isActive:
        look()
        query.awaitTermination(poll)
    query.awaitTermination()  # raises what the query has failed with
    look()
    return batches


def received_and_landed(
    spark: SparkSession, batches: dict[int, dict[str, dict[str, int]]], topics: Sequence[str]
) -> DataFrame:
    """(topic, received, landed, lost), one row for each topic."""
    sums: dict[str, dict[str, int]] = {RECEIVED: defaultdict(int), LANDED: defaultdict(int)}
    for metrics in batches.values():
        for name, total in sums.items():
            for topic, n in metrics.get(name, {}).items():
                total[topic] += n
    rows = [(t, sums[RECEIVED][t], sums[LANDED][t], sums[RECEIVED][t] - sums[LANDED][t]) for t in topics]
    return spark.createDataFrame(rows, "topic string, received long, landed long, lost long")
