"""Structured Streaming: message topics to landed files to bronze tables.

Every hop is a native file sink with its own checkpoint. The sink's log makes a restart
add nothing twice, and offsets advance only with the files they stand for.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from courierlake.sources.events import from_messages
from courierlake.session import exists, file_count
from courierlake.sources.schemas import TOPICS, bronze_schema
from courierlake.sources.tables import table_of_path

MESSAGE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("topic", "key", "value")])
FLUSH_EVERY = "15 seconds"
# A flush by size or by time: a micro-batch waits for so many messages, but no longer than the interval.
LEAST_MESSAGES = "1000"
# What one micro-batch takes of a backlog, so that a failure repeats no more than that.
MESSAGES_PER_TRIGGER = "1000000"
FILES_PER_TRIGGER = "1000"
# Files older than the newest one by more than this are still picked up: backfills keep old times.
MAX_FILE_AGE = "3650d"
LOAD_EVERY = "10 minutes"
# A backlog is taken in about so many runs, each of which has a cost of its own.
RUNS = 16


def read_topics(
    spark: SparkSession,
    source: str,
    topics: tuple[str, ...] = TOPICS,
    fmt: str = "kafka",
    **options: str,
) -> DataFrame:
    """Subscribe to topics from their beginning. ``source`` is the broker list or a folder.

    A folder holds one ``topic=<name>`` subfolder per topic, as ``publish`` writes it.
    """
    if fmt == "kafka":
        reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", source)
        reader = reader.option("subscribe", ",".join(topics))
        reader = reader.option("startingOffsets", "earliest")
        bounds = {
            "minOffsetsPerTrigger": LEAST_MESSAGES,
            "maxTriggerDelay": FLUSH_EVERY,
            "maxOffsetsPerTrigger": MESSAGES_PER_TRIGGER,
        }
        reader = reader.options(**bounds | options)
        return reader.load().selectExpr(
            "topic", "CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value"
        )
    bounds = {"maxFilesPerTrigger": FILES_PER_TRIGGER, "maxFileAge": MAX_FILE_AGE}
    reader = spark.readStream.format(fmt).options(**bounds | options)
    if len(topics) == 1:  # list that topic's folder only
        messages = reader.schema("key string, value string").load(f"{source}/topic={topics[0]}")
        return messages.select(F.lit(topics[0]).alias("topic"), "key", "value")
    return reader.schema(MESSAGE_SCHEMA).load(source).filter(F.col("topic").isin(*topics))


def files_per_run(spark: SparkSession, path: str, least: int) -> int:
    """How many of the files below a path one run takes: ``least`` or more, ``FILES_PER_TRIGGER`` at most.

    With a fixed number the runs, and what each costs, grow with the backlog.
    """
    files = file_count(spark, path)
    return min(int(FILES_PER_TRIGGER), max(least, -(-files // RUNS)))


def _start(writer, drain: bool, every: str) -> StreamingQuery:
    """Drain what is there and stop, or keep running at an interval."""
    return (writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=every)).start()


def land_raw(messages: DataFrame, path: str, checkpoint: str, drain: bool = True) -> StreamingQuery:
    """Land undecoded messages, one subfolder per topic."""
    writer = messages.writeStream.format("parquet").partitionBy("topic").option("path", path)
    return _start(writer.option("checkpointLocation", checkpoint), drain, FLUSH_EVERY)


def land_events(
    messages: DataFrame,
    schema: T.StructType,
    path: str,
    checkpoint: str,
    drain: bool = True,
    rows_per_file: int | None = None,
) -> StreamingQuery:
    """Land one topic's decoded events as typed files; bad messages keep their raw text."""
    writer = from_messages(messages, schema).writeStream.format("parquet").option("path", path)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    return _start(writer.option("checkpointLocation", checkpoint), drain, FLUSH_EVERY)


def land_topics(
    spark: SparkSession,
    source: str,
    root: str,
    checkpoints: str,
    topics: tuple[str, ...] = TOPICS,
    fmt: str = "kafka",
    drain: bool = True,
    rows_per_file: int | None = None,
    **options: str,
) -> dict[str, StreamingQuery]:
    """One query per topic, each reading its own topic only. ``options`` go to the reader."""
    queries = {}
    for topic in topics:
        messages = read_topics(spark, source, (topic,), fmt, **options)
        queries[topic] = land_events(
            messages,
            bronze_schema(topic),
            f"{root}/{topic}",
            f"{checkpoints}/{topic}",
            drain,
            rows_per_file,
        )
    return queries


def landed_rows(
    spark: SparkSession,
    landed: str,
    schema: T.StructType,
    clean_source: str = "off",
    archive: str | None = None,
    **options: str,
) -> DataFrame:
    """New files of a folder, a bounded number in each micro-batch."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet")
    bounds = {"maxFilesPerTrigger": FILES_PER_TRIGGER, "maxFileAge": MAX_FILE_AGE}
    reader = reader.options(**bounds | options)
    reader = reader.option("cleanSource", clean_source)
    if archive:
        reader = reader.option("sourceArchiveDir", archive)
    return reader.parquet(landed)


def load_bronze(
    spark: SparkSession,
    landed: str,
    schema: T.StructType,
    table_path: str,
    checkpoint: str,
    clean_source: str = "off",
    archive: str | None = None,
    drain: bool = True,
    **options: str,
) -> StreamingQuery:
    """Append files that have not been loaded yet to a bronze table.

    ``clean_source`` may be "delete", or "archive" with a folder, to take loaded files away.
    ``options`` go to the reader and may change the bounds of a micro-batch.
    """
    rows = landed_rows(spark, landed, schema, clean_source, archive, **options)
    writer = rows.writeStream.format("parquet").option("path", table_path)
    return _start(writer.option("checkpointLocation", checkpoint), drain, LOAD_EVERY)


def load_table(
    spark: SparkSession,
    landed: str,
    schema: T.StructType,
    name: str,
    root: str,
    checkpoint: str,
    drain: bool = True,
    **options: str,
) -> StreamingQuery:
    """Append files that have not been loaded yet to the catalog table ``schema.table``.

    Schema and table are created if they are missing, below ``root``. The sink's log lies with the
    table's files, so readers of the table see committed batches only. It knows batches by their
    numbers, so all runs that load a table share one checkpoint.
    """
    database, table = name.split(".")
    path = f"{root}/{database}/{table}"
    if exists(spark, f"{path}/_spark_metadata") and not exists(spark, f"{checkpoint}/offsets"):
        raise ValueError(f"{name} is loaded by another checkpoint than {checkpoint}")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {database} LOCATION '{root}/{database}'")
    writer = landed_rows(spark, landed, schema, **options).writeStream
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=LOAD_EVERY)
    return writer.toTable(name, format="parquet", outputMode="append", path=path)


def load_zone(
    spark: SparkSession,
    landed: str,
    zone: str,
    checkpoint: str,
    topics: tuple[str, ...] = TOPICS,
    drain: bool = True,
    **options: str,
) -> StreamingQuery:
    """Load a whole landing zone, one folder for each topic, by one query.

    A micro-batch takes new files of all topics and commits them together. Each row goes to the table
    that its file's path names, a partition of the sink. Topics give columns of one name different types,
    so a row fills the column of its topic, a struct, and leaves the others null.
    """
    parts = []
    for topic in topics:
        schema = bronze_schema(topic)
        rows = landed_rows(spark, f"{landed}/{topic}", schema, **options)
        table = table_of_path(landed, F.col("_metadata.file_path")).alias("table")
        parts.append(rows.select(table, F.struct(*schema.names).alias(topic)))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    writer = rows.writeStream.format("parquet").partitionBy("table").option("path", zone)
    return _start(writer.option("checkpointLocation", checkpoint), drain, LOAD_EVERY)


def read_zone(spark: SparkSession, zone: str, topic: str) -> DataFrame:
    """A table of a zone: its partition, and of that its own struct only."""
    schema = T.StructType().add(topic, bronze_schema(topic)).add("table", T.StringType())
    rows = spark.read.schema(schema).parquet(zone)
    return rows.where(F.col("table") == topic.upper()).select(f"{topic}.*")
