"""Joins and group statistics that hold up when one key owns a large share of the rows.

Both are plain equi-joins to a side with one row for each key, which Spark plans by itself: a small
side is broadcast, and in a sort-merge join adaptive execution splits the partition of a heavy key
over several tasks. Statistics reach the join through an aggregate, which combines a heavy key's
rows inside each map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup_join(fact: DataFrame, dim: DataFrame, on: str) -> DataFrame:
    """``fact LEFT JOIN dim USING (on)`` for a dim with unique keys. Keeps the fact's columns first."""
    columns = [*fact.columns, *[c for c in dim.columns if c != on]]
    return fact.join(dim, on, "left").select(*columns)


def attach_group_stats(df: DataFrame, stats: dict[str, tuple[str, Column]]) -> DataFrame:
    """Add ``{name: (key, aggregate)}`` computed over each row's own key group.

    The result is that of an unordered window per key; NULL is a group of its own. The aggregate
    reads only the columns it needs.
    """
    rows = df
    for key in dict.fromkeys(key for key, _ in stats.values()):
        own = {name: agg for name, (k, agg) in stats.items() if k == key}
        groups = rows.groupBy(F.col(key).alias("__key")).agg(*[a.alias(n) for n, a in own.items()])
        df = df.join(groups, F.col(key).eqNullSafe(F.col("__key")), "left").drop("__key")
    return df
