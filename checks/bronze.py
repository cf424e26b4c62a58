"""Bronze tables on the Spark side, from the same adapter expressions as the SQL oracles."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.adapters import ADAPTERS
from courierlake.plans.pipeline import Pipeline
from courierlake.sources.schemas import bronze_schema

AS_OF = date(2001, 9, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bronze(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """Every source row once, and the re-extracted ones a second time, in a single scan."""
    adapter = ADAPTERS[topic]
    rows = table(spark, sf_dir, adapter.source).selectExpr(
        "*",
        f"{adapter.key} AS k",
        f"explode(CASE WHEN {adapter.key} % 10 = 3 THEN array(0, 1) ELSE array(0) END) AS d",
    )
    columns = adapter.columns | {"event_type": f"'{topic}_loaded'"}
    return rows.selectExpr(
        *[
            f"CAST({columns[f.name]} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in bronze_schema(topic)
        ]
    )


def pipeline(spark: SparkSession, sf_dir: str) -> Pipeline:
    return Pipeline(lambda topic: bronze(spark, sf_dir, topic), AS_OF)


def portable(df: DataFrame) -> DataFrame:
    """Types that compare the same from any engine: bigint, double, text."""

    def cast(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            return c.cast("double").alias(f.name)
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return c.cast("bigint").alias(f.name)
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return c.cast("string").alias(f.name)
        return c

    return df.select(*[cast(f) for f in df.schema.fields])
