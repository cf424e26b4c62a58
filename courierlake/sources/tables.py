"""Tables and views of the three zones, and how their files are written."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courierlake.sources.schemas import TOPICS, bronze_schema

FLUSH_ROWS = 1000


def register_bronze(spark: SparkSession, read: Callable[[str], DataFrame]) -> dict[str, str]:
    """Expose the ten bronze tables as temp views named after their topics, in upper case."""
    views = {}
    for topic in TOPICS:
        views[topic] = topic.upper()
        read(topic).createOrReplaceTempView(views[topic])
    return views


def read_bronze(spark: SparkSession, root: str, topic: str) -> DataFrame:
    return spark.read.schema(bronze_schema(topic)).parquet(f"{root}/{topic}")


def table_of_path(root: str, path: Column) -> Column:
    """Upper-cased first folder below ``root``: orders/part-0.parquet belongs to ORDERS."""
    prefix = root.split(":", 1)[-1].rstrip("/") + "/"
    below = path.substr(F.locate(prefix, path) + len(prefix), F.length(path))
    return F.upper(F.substring_index(below, "/", 1))


def read_landed(spark: SparkSession, root: str, topic: str) -> DataFrame:
    """The landed Parquet files of a topic, with its columns and the table that their path names."""
    files = spark.read.schema(bronze_schema(topic)).option("recursiveFileLookup", True)
    rows = files.option("pathGlobFilter", "*.parquet").parquet(f"{root}/{topic}")
    return rows.withColumn("table", table_of_path(root, F.col("_metadata.file_path")))


def landed_files(spark: SparkSession, root: str) -> DataFrame:
    """A row for each landed row below a root: its file.

    Tables differ in their columns, so none is read here; see ``read_landed``.
    """
    files = spark.read.schema("_none string").option("recursiveFileLookup", True)
    rows = files.option("pathGlobFilter", "*.parquet").parquet(root)
    return rows.select(F.col("_metadata.file_path").alias("file"))


def route_landed(spark: SparkSession, root: str) -> DataFrame:
    """A row for each landed row below a root: its file and the table it belongs to."""
    return landed_files(spark, root).select(table_of_path(root, F.col("file")).alias("table"), "file")


def land(df: DataFrame, path: str, rows_per_file: int | None = None) -> None:
    """Append files, of at most ``rows_per_file`` rows if given.

    A limit as low as ``FLUSH_ROWS`` suits a trickle of events. A bulk load should leave the
    file size to its partitions, or else it buries the reader in small files.
    """
    writer = df.write.mode("append")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)


def land_all(tables: dict[str, DataFrame], root: str, rows_per_file: int | None = None) -> None:
    """Land each table in its folder below a root, all at once: a small one does not hold up the rest."""
    with ThreadPoolExecutor(max(1, len(tables))) as pool:
        done = [pool.submit(land, df, f"{root}/{name}", rows_per_file) for name, df in tables.items()]
    for landing in done:
        landing.result()  # raises what the landing has failed with


def compact(spark: SparkSession, path: str, target: str) -> DataFrame:
    """Rewrite many small files as few of Spark's advisory partition size."""
    rows = spark.read.option("recursiveFileLookup", True).parquet(path)
    rows.hint("rebalance").write.parquet(target)
    return spark.read.schema(rows.schema).parquet(target)


def append_table(df: DataFrame, schema: str, table: str, root: str) -> str:
    """Create the schema and table if missing, then append. Returns the table's full name."""
    spark = df.sparkSession
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{root}/{schema}'")
    name = f"{schema}.{table}"
    df.write.mode("append").option("path", f"{root}/{schema}/{table}").saveAsTable(name)
    return name


def overwrite_table(
    df: DataFrame, schema: str, table: str, root: str, partition_by: tuple[str, ...] = ()
) -> str:
    """Full refresh of a table, optionally partitioned. Returns the table's full name."""
    spark = df.sparkSession
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{root}/{schema}'")
    name = f"{schema}.{table}"
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer = writer.option("path", f"{root}/{schema}/{table}")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return name


def rows_by_table(spark: SparkSession, root: str) -> DataFrame:
    """Audit: how many rows, in how many files, each table has below a root."""
    # The table is told once for each file, not for each of its rows.
    per_file = landed_files(spark, root).groupBy("file").agg(F.count("*").alias("rows"))
    return per_file.groupBy(table_of_path(root, F.col("file")).alias("table")).agg(
        F.sum("rows").alias("rows"), F.count("*").alias("files"), F.max("rows").alias("largest_file")
    )
