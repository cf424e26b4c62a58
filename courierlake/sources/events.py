"""From source rows to messages and back: cleaning, envelope, JSON codec, publishing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courierlake.sources.schemas import PRIMARY_KEYS, bronze_schema, source_schema

ISO_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
CORRUPT = "_corrupt_record"

# Producer settings of a publish that must not lose events.
KAFKA_WRITE = {
    "kafka.acks": "all",
    "kafka.retries": "5",
    "kafka.linger.ms": "50",
    "kafka.batch.size": str(64 * 1024),
}


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV file or folder with a header, read with a declared schema."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_topic_csv(spark: SparkSession, folder: str, topic: str) -> DataFrame:
    return read_csv(spark, f"{folder}/{topic}.csv", source_schema(topic))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN is a missing value at the source; it becomes NULL."""
    floats = (T.DoubleType, T.FloatType)
    return df.select(
        *[
            F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, floats)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def with_envelope(df: DataFrame, topic: str, at: Column | None = None) -> DataFrame:
    """Add the event type and the ISO ingestion time (now, unless given)."""
    time = F.current_timestamp() if at is None else at
    return df.withColumns(
        {"event_type": F.lit(f"{topic}_loaded"), "event_time": F.date_format(time, ISO_TIME)}
    )


def to_messages(events: DataFrame, topic: str, key: str | None = None) -> DataFrame:
    """Rows as keyed JSON messages. The key is the row's first column unless named."""
    key = key or events.columns[0]
    options = {"ignoreNullFields": "false", "timestampFormat": ISO_TIME, "timestampNTZFormat": ISO_TIME}
    return events.select(
        F.lit(topic).alias("topic"),
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*events.columns), options).alias("value"),
    )


def from_messages(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Decode message values; a value that is not valid JSON is kept in its own column."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {
        "columnNameOfCorruptRecord": CORRUPT,
        "timestampFormat": ISO_TIME,
        "timestampNTZFormat": ISO_TIME,
    }
    decoded = F.from_json(F.col("value").cast("string"), with_corrupt, options)
    return messages.select(decoded.alias("event")).select("event.*")


def decode_topic(messages: DataFrame, topic: str) -> DataFrame:
    return from_messages(messages.filter(F.col("topic") == topic), bronze_schema(topic))


def bronze_messages(events: DataFrame, topic: str) -> DataFrame:
    return to_messages(events, topic, PRIMARY_KEYS[topic])


def publish(messages: DataFrame, target: str, fmt: str = "kafka", **options: str) -> None:
    """Send messages: to brokers (``target`` is their address list), or append to files."""
    if fmt == "kafka":
        writer = messages.write.format("kafka").options(**KAFKA_WRITE, **options)
        writer.option("kafka.bootstrap.servers", target).save()
    else:
        writer = messages.write.mode("append").format(fmt).options(**options)
        writer.partitionBy("topic").save(target)
