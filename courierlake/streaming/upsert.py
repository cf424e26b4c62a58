"""Keep-latest over a stream without a table format that can merge.

Batches are appended to a change log, and a reader takes the latest row per key. Writing a
snapshot now and then bounds what that reader has to look at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from courierlake.operators.dedup import keep_latest


def append_batch(batch: DataFrame, batch_id: int, log: str) -> None:
    """Body for ``foreachBatch``. A batch that is replayed replaces itself."""
    batch.write.mode("overwrite").parquet(f"{log}/batch={batch_id}")


def merge_latest(current: DataFrame, batch: DataFrame, keys: list[str], by: str) -> DataFrame:
    """The table after a batch: the latest row per key of both."""
    return keep_latest(current.unionByName(batch), keys, by)


def write_snapshot(log: DataFrame, keys: list[str], by: str, path: str) -> DataFrame:
    """Fold a change log into one row per key at a new path."""
    keep_latest(log, keys, by).write.parquet(path)
    return log.sparkSession.read.schema(log.schema).parquet(path)
