"""Windows over long sequences, without bringing a sequence into one task.

Rows are range-partitioned by their full order, which balances any distribution, and sorted; that layout
is written with each row's place in its slice, so that it can no longer change, and is the only copy that is
stored. The ranges are sampled from the input itself: where that is an aggregate, its shuffle is read for
the sample and for the slices. The number of slices is that of the cluster's shuffle partitions.

What a slice needs of the ones before it is their sum, for a running sum. For a lag, rows are numbered
over all slices and dealt to blocks of equal size; the last rows of a block are sent to the next one too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from courierlake.session import materialize

SLICE_ROWS = 1_000_000
# A row's place: its slice above these bits, its number in the slice in them.
_ROW_BITS = 33


def _in_slices(df: DataFrame, keys: list[Column]) -> DataFrame:
    """``df`` in the order of ``keys``, stored with ``_slice`` and ``_row``, the number in the slice from 0."""
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    stored = materialize(ranged.withColumn("_place", F.monotonically_increasing_id()), "slices")
    return stored.withColumns(
        {
            "_slice": F.shiftright("_place", _ROW_BITS),
            "_row": F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
        }
    ).drop("_place")


def _before(df: DataFrame, part: str, value: Column) -> DataFrame:
    """(part, _before, _all): the sum of ``value`` over earlier parts and over all of them.

    A row for each part, of which there is one for about a million rows.
    """
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(part).agg(F.sum(value).alias("_total"))
    return totals.select(
        part,
        F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_total").over(Window.partitionBy()).alias("_all"),
    )


def running_sum(
    df: DataFrame,
    value: str,
    order: list[Column],
    name: str,
    slice_rows: int = SLICE_ROWS,
    total: str | None = None,
) -> DataFrame:
    """Sum of ``value`` over all rows up to this one, and over all rows as ``total`` if that is named.

    ``order`` must be total. A slice of more than ``slice_rows`` rows is summed in several parts.
    """
    part = F.shiftleft("_slice", _ROW_BITS) + F.floor(F.col("_row") / slice_rows)
    parts = _in_slices(df, order).withColumn("_part", part)
    local = Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    sums = {name: F.col("_before") + F.sum(value).over(local)}
    if total:
        sums[total] = F.col("_all")
    joined = parts.join(_before(parts, "_part", F.col(value)), "_part")
    return joined.withColumns(sums).select(*df.columns, *sums)


def lag_rows(
    df: DataFrame,
    groups: list[str],
    order: list[Column],
    lags: dict[str, tuple[str, int]],
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """``LAG(column, offset)`` per group for ``{name: (column, offset)}``; ``order`` must be total.

    The rows of a group stand side by side, so a lag reaches back by its offset in the numbers of all
    rows. A block of ``slice_rows`` rows, or of as many as the longest lag reaches back if that is
    more, needs nothing but the last rows of the block before.
    """
    reach = max(offset for _, offset in lags.values())
    size = max(slice_rows, reach)
    sliced = _in_slices(df, [F.col(g).asc_nulls_first() for g in groups] + order)
    numbered = sliced.join(_before(sliced, "_slice", F.lit(1)), "_slice").withColumn(
        "_at", F.col("_before") + F.col("_row")
    )
    own = F.floor(F.col("_at") / size)
    halo = F.col("_at") % size >= size - reach
    dealt = numbered.select(
        *df.columns,
        "_at",
        F.explode(F.when(halo, F.array(own, own + 1)).otherwise(F.array(own))).alias("_block"),
    )
    in_block = Window.partitionBy(*groups, "_block").orderBy("_at")
    lagged = dealt.withColumns({n: F.lag(c, offset).over(in_block) for n, (c, offset) in lags.items()})
    return lagged.where(own == F.col("_block")).select(*df.columns, *lags)


def lag_days(
    df: DataFrame, groups: list[str], date: str, lags: dict[str, tuple[str, int]]
) -> DataFrame:
    """Value of the group exactly ``offset`` days earlier; NULL if that day has no row.

    Expects one row per group and date, so a window holds at most a calendar of rows.
    """
    numbered = df.withColumn("_day", F.unix_date(date))
    out = []
    for name, (column, offset) in lags.items():
        window = Window.partitionBy(*groups).orderBy("_day").rangeBetween(-offset, -offset)
        out.append(F.when(F.col("_day").isNotNull(), F.sum(column).over(window)).alias(name))
    return numbered.select(*df.columns, *out)
