"""Keep-latest as a stateful stream, with versioned snapshots.

The stream folds the rows of each arrival window to the latest one of a key, in the state store. When
the watermark, which follows the time of arrival, has passed a window, its rows are appended to a change
log and leave the state. So the state holds the windows of the last minutes, whatever the size of the table,
and a row is never too late: rows with an old event time arrive in the window of now and compete by event
time. Only a clock that goes back by more than ``CLOCK_SLACK``, as after a restart on another machine, would
make rows late.

The table is the latest row per key of the change log and of the windows still open in the state store,
which Spark reads as a table. A snapshot folds what has been logged since the one before into a new version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from courierlake.operators.dedup import keep_latest, row_hash
from courierlake.session import exists
from courierlake.sources import versions
from courierlake.streaming.topics import FLUSH_EVERY, _start

ARRIVED = "_arrived"
#: Start of the arrival window in seconds, by which the change log is partitioned.
WINDOW = "arrival_window"
#: How far the clock may go back between two micro-batches; windows stay open for so much longer.
CLOCK_SLACK = "10 minutes"


def latest_changes(
    stream: DataFrame,
    keys: list[str] | str,
    by: str,
    every: str = FLUSH_EVERY,
    slack: str = CLOCK_SLACK,
) -> DataFrame:
    """The latest row of each key and arrival window, as ``keep_latest`` takes it."""
    keys = [keys] if isinstance(keys, str) else keys
    # A null time counts as the largest, and equal times go to the smaller row hash.
    order = F.struct(F.col(by).isNull(), F.col(by), F.bitwise_not(row_hash(stream)))
    return (
        stream.select("*", F.current_timestamp().alias(ARRIVED))
        .withWatermark(ARRIVED, slack)
        .groupBy(F.window(ARRIVED, every), *keys)
        .agg(F.max_by(F.struct(*stream.columns), order).alias("row"))
        .select("row.*", F.unix_seconds("window.start").alias(WINDOW))
    )


def start_latest(
    stream: DataFrame,
    keys: list[str] | str,
    by: str,
    log: str,
    checkpoint: str,
    drain: bool = True,
    every: str = FLUSH_EVERY,
    slack: str = CLOCK_SLACK,
) -> StreamingQuery:
    """Append the changes of closed windows to a log, one folder for each window."""
    changes = latest_changes(stream, keys, by, every, slack)
    writer = changes.writeStream.format("parquet").partitionBy(WINDOW).outputMode("append")
    return _start(writer.option("path", log).option("checkpointLocation", checkpoint), drain, every)


def open_rows(spark: SparkSession, checkpoint: str, schema: T.StructType) -> DataFrame:
    """The rows of the windows that are still open after the last committed batch."""
    if not exists(spark, f"{checkpoint}/state"):
        return spark.createDataFrame([], schema)
    state = spark.read.format("statestore").load(checkpoint)
    # The buffer of the aggregate: the row comes first, what it was chosen by second.
    row = state.schema["value"].dataType.names[0]
    rows = state.select(F.col(f"value.`{row}`").alias("row"))
    return rows.select(*[F.col(f"row.`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def write_snapshot(
    spark: SparkSession,
    log: str,
    checkpoint: str,
    keys: list[str] | str,
    by: str,
    root: str,
    schema: T.StructType,
) -> DataFrame:
    """Publish the table as it is now as the next version under ``root``.

    Reads the last version, the windows logged since, and the open windows. These are read first:
    a window that is closed meanwhile is then read twice, which changes nothing, and never missed.
    """
    still_open = open_rows(spark, checkpoint, schema)
    last = versions.current(spark, root)
    covered = last.info["window"] if last else None
    rows = versions.read_current(spark, root, schema).unionByName(still_open)
    if exists(spark, log):
        logged = spark.read.schema(T.StructType([*schema.fields, T.StructField(WINDOW, T.LongType())])).parquet(log)
        new = logged if covered is None else logged.where(F.col(WINDOW) > covered)
        rows = rows.unionByName(new.drop(WINDOW))
        newest = logged.agg(F.max(WINDOW)).first()[0]
        covered = covered if newest is None else newest
    versions.publish(keep_latest(rows, keys, by), root, {"window": covered})
    return versions.read_current(spark, root, schema)
