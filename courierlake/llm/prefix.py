"""Running sums within groups that may be of any size.

Rows are range-partitioned by group and order, and that layout is written with each row's slice, so that
it can no longer change. A slice is summed by itself; what came before it is the sum of the totals of the
group's earlier slices, one row for each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courierlake.llm.common import stored

_START = Window.unboundedPreceding


def sums_before(
    df: DataFrame, groups: list[str], order: list[Column], sums: dict[str, Column]
) -> DataFrame:
    """``df`` with, for ``{name: value}``, the sum of the value over the rows of the group before this one.

    Null is a group like any other. Rows that are equal in ``order`` are taken in the order in which they
    are stored, so that any number of them spreads over slices.
    """
    given = stored(df.withColumn("__row", F.monotonically_increasing_id()), "rows")
    keys = [F.col(g).asc_nulls_first() for g in groups] + order + [F.col("__row").asc()]
    sliced = stored(
        given.repartitionByRange(*keys).withColumn("__slice", F.spark_partition_id()), "slices"
    )
    totals = sliced.groupBy(*groups, "__slice").agg(
        *[F.sum(value).alias(name) for name, value in sums.items()]
    )
    earlier = Window.partitionBy(*groups).orderBy("__slice").rowsBetween(_START, -1)
    before = totals.select(
        *[F.col(g).alias(f"__g{k}") for k, g in enumerate(groups)],
        F.col("__slice").alias("__s"),
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"__before_{n}") for n in sums],
    )
    same = F.col("__slice") == F.col("__s")
    for k, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"__g{k}"))
    inside = Window.partitionBy(*groups, "__slice").orderBy(*order, "__row").rowsBetween(_START, -1)
    local = {n: F.coalesce(F.sum(value).over(inside), F.lit(0)) for n, value in sums.items()}
    return (
        sliced.withColumns(local)
        .join(before, same)
        .withColumns({n: F.col(n) + F.col(f"__before_{n}") for n in sums})
        .select(*df.columns, *sums)
    )
