"""Data-quality tests as queries: each returns one row per tested column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _labels(table: str, column: str) -> list[Column]:
    return [F.lit(table).alias("table_name"), F.lit(column).alias("column_name")]


def unique(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Values that occur more than once, per ``{table: (rows, key)}``. NULLs do not count."""
    out = []
    for name, (df, key) in tables.items():
        repeated = df.filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1")
        totals = repeated.agg(
            F.count("*").alias("failing_values"),
            F.coalesce(F.sum("count"), F.lit(0)).alias("failing_rows"),
        )
        out.append(totals.select(*_labels(name, key), "failing_values", "failing_rows"))
    return _stack(out)


def not_null(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """NULLs per column, in one pass over each table."""
    out = []
    for name, (df, columns) in tables.items():
        counts = df.agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in columns])
        pairs = [
            F.struct(F.lit(c).alias("column_name"), (F.col("_rows") - F.col(c)).alias("failing_rows"))
            for c in columns
        ]
        out.append(
            counts.select(F.lit(name).alias("table_name"), F.inline(F.array(*pairs)))
        )
    return _stack(out)


def accepted_values(tables: dict[str, tuple[DataFrame, str, list[str]]]) -> DataFrame:
    """Values outside a list with their row counts. NULLs pass."""
    out = []
    for name, (df, column, values) in tables.items():
        outside = df.filter(~F.col(column).isin(*values)).groupBy(F.col(column).alias("value"))
        counted = outside.agg(F.count("*").alias("failing_rows"))
        out.append(counted.select(*_labels(name, column), "value", "failing_rows"))
    return _stack(out)


def relationships(links: dict[tuple[str, str], tuple[DataFrame, DataFrame, str]]) -> DataFrame:
    """Foreign keys without a parent, per ``{(child, parent): (rows, parents, key)}``.

    Child keys are counted before the join, so a key with many rows costs one.
    """
    out = []
    for (child, parent), (rows, parents, key) in links.items():
        keys = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
        orphans = keys.join(parents.select(key), key, "left_anti")
        totals = orphans.agg(
            F.count("*").alias("orphan_keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows")
        )
        out.append(
            totals.select(
                F.lit(child).alias("child_table"),
                F.lit(parent).alias("parent_table"),
                F.lit(key).alias("column_name"),
                "orphan_keys",
                "orphan_rows",
            )
        )
    return _stack(out)


def reconcile(tables: dict[str, tuple[DataFrame, DataFrame, str]]) -> DataFrame:
    """Bronze against silver per ``{table: (bronze, silver, key)}``.

    ``lost_rows`` are keys that bronze has and silver has not; zero unless a rule drops rows.
    """
    out = []
    for name, (bronze, silver, key) in tables.items():
        trimmed = F.trim(key).alias(key)
        per_key = bronze.select(trimmed).groupBy(key).agg(F.count("*").alias("n"))
        before = per_key.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("bronze_rows"),
            F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("keyless_rows"),
            F.count(key).alias("bronze_keys"),
        )
        after = silver.agg(F.count("*").alias("silver_rows"))
        out += [_measures(name, before), _measures(name, after)]
    totals = _stack(out).groupBy("table_name").agg(*[F.sum(c).alias(c) for c in RECONCILED])
    lost = (F.col("bronze_keys") - F.col("silver_rows")).alias("lost_rows")
    return totals.select("table_name", *RECONCILED, lost)


RECONCILED = ("bronze_rows", "keyless_rows", "bronze_keys", "silver_rows")


def _measures(name: str, counts: DataFrame) -> DataFrame:
    """One side of a reconciliation, with zeros for the other side's columns."""
    values = [F.col(c) if c in counts.columns else F.lit(0).alias(c) for c in RECONCILED]
    return counts.select(F.lit(name).alias("table_name"), *values)


def received_and_landed(received: DataFrame, landed: DataFrame, by: str = "topic") -> DataFrame:
    """Messages received against rows landed per topic; a topic missing on one side counts 0."""
    sides = received.select(by, F.lit(1).alias("r"), F.lit(0).alias("l")).unionByName(
        landed.select(by, F.lit(0).alias("r"), F.lit(1).alias("l"))
    )
    counted = sides.groupBy(by).agg(F.sum("r").alias("received"), F.sum("l").alias("landed"))
    return counted.withColumn("lost", F.col("received") - F.col("landed"))
